"""Best-fit packing of token pieces into sequences, with certified partitions.

Documents are tokenised where they lie and cut into pieces. Whole-length pieces are
sequences of their own; the others are dealt to groups of bounded size, and each group is
packed by best-fit decreasing. Dual-feasible functions bound from below how many sequences
any packing of the group needs. A group that meets its bound is certified and done. Groups
with a gap hand their sequences that still have room to groups of the next round, where
pieces of different groups meet and are packed again; the new packing is taken only where
it needs fewer sequences.

Pieces are dealt by a hash, or, where the order of the documents is to last, in runs of that
order: groups are neighbours, pieces of one length are exchanged until sequences hold what
stands together, and sequences are numbered and returned by the place of their middle piece.

Defined results: a NULL text counts as empty and has the closing id alone. Texts of any length
are read whole, runs of millions of blanks included. Repeated rows are packed each. No
document, no rows. Other columns are left aside, whatever their names.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdgrid.llm.common import in_slices
from crowdgrid.session import materialise, small_batches

CAPACITY = 1024
END_ID = 2
GROUP_ITEMS = 20_000
ROUNDS = 3
# In the documents' order, how many neighbouring groups meet in the next round, and how often
# the pieces of a group are exchanged.
GROUPS_MEET = 4
EXCHANGES = 4

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long, certified boolean"
# Where a document stands, and the place of a piece among all.
STANDS = ("_part", "_file", "_row", "_read")
STOOD = "_part long, _file string, _row long, _read long"
PLACE = "_place"


class Encoder:
    """Byte-level BPE from a file of ranks, the same vocabulary and merges as the tokenizer
    file of that name. Where ``added`` names strings with their ids, a text is split at them
    first, as that file does with its added tokens; otherwise they are ordinary text.

    A text that the ranks' pattern gives up on, as it does on a million blanks in a row, is
    encoded by the tokenizer file itself."""

    def __init__(self, path: str, added: Mapping[str, int] | None = None) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        added = dict(added or {})
        encoding = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={k: n for k, n in ranks.items() if n not in added.values()},
            special_tokens=added,
        )
        allowed = set(added)
        self.encode = lambda text: encoding.encode(
            text, allowed_special=allowed, disallowed_special=()
        )
        self.added, self.library = added, None

    def ids(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit numbers."""
        try:
            found = self.encode(text)
        except ValueError:
            found = self._by_library(text)
        return np.array(found, dtype="<u4").tobytes()

    def _by_library(self, text: str) -> list[int]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(tokenizer_file())
            self.library.encode_special_tokens = not self.added
        return self.library.encode(text, add_special_tokens=False).ids


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def added_tokens() -> dict[str, int]:
    """The added tokens of the tokenizer file and their ids."""
    with open(tokenizer_file(), encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError("added tokens that take in their surroundings")
    return {t["content"]: t["id"] for t in added}


def pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    added: Mapping[str, int] | None = None,
    stands: bool = False,
) -> DataFrame:
    """The pieces of every document: only one longer than ``capacity`` is cut, and its
    first piece is the one that may be shorter. ``stands`` adds where the document stands."""
    small_batches(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, added)
        for batch in in_slices(batches):
            rows, cuts = [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = encoder.ids(text.as_py() or "") + end
                total, at, number = len(ids) // 4, 0, 0
                while at < total:
                    length = (total - 1) % capacity + 1 if at == 0 else capacity
                    crc = zlib.crc32(ids[4 * at : 4 * (at + length)])
                    rows.append((doc_id.as_py(), number, at, length, crc))
                    at, number = at + length, number + 1
                cuts.append(number)
            found = _batch(rows)
            if stands:
                of = np.repeat(np.arange(len(cuts)), cuts)
                for name in STANDS:
                    found = found.append_column(name, batch.column(name).take(pa.array(of)))
            yield found

    if stands:
        return _standing(docs).mapInArrow(cut, f"{PIECES}, {STOOD}")
    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def _standing(docs: DataFrame) -> DataFrame:
    """doc_id and text with the file and the row in it that each document was read from, as the
    reader deals files in an order of its own. Other rows stand as their partitions do."""
    read = F.monotonically_increasing_id().alias("_read")

    def of(file: Column, row: Column) -> DataFrame:
        return docs.select(
            "doc_id", "text", _part(file).alias("_part"), file.alias("_file"), row.alias("_row"), read
        )

    try:
        stored = docs.metadataColumn("_metadata")
        return of(stored["file_path"], stored["row_index"])
    except AnalysisException:  # not from Parquet files
        return of(F.lit(None).cast("string"), F.lit(None).cast("long"))


def _part(file: Column) -> Column:
    """The number of a file that Spark wrote."""
    return F.regexp_extract(file, r"part-(\d+)[^/]*$", 1).try_cast("long")


def placed(parts: DataFrame) -> DataFrame:
    """Number the pieces from 0 as their documents stand. They are stored in order, and the
    place follows from the file, of which one row each is counted, and the row in it."""
    ordered = materialise(parts.orderBy(*STANDS, "piece").drop(*STANDS))
    stored = ordered.metadataColumn("_metadata")
    rows = ordered.select("*", stored["file_path"].alias("_file"), stored["row_index"].alias("_row"))
    files = rows.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
    earlier = Window.orderBy(_part(F.col("_file")), "_file").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = rows.join(F.broadcast(before), "_file")
    return numbered.withColumn(PLACE, F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def best_fit_decreasing(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each size. Open bins wait in stacks by the room they have left, and a bit
    for each room that has a bin shows the tightest fit."""
    bins = np.zeros(len(sizes), dtype=np.int64)
    waiting: dict[int, list[int]] = defaultdict(list)
    rooms = made = 0
    for at in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[at])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = waiting[room].pop()
            if not waiting[room]:
                rooms ^= 1 << room
        else:
            room, chosen, made = capacity, made, made + 1
        bins[at] = chosen
        left = room - size
        if left:
            waiting[left].append(chosen)
            rooms |= 1 << left
    return bins


def lower_bound(sizes: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions.

    The first leaves out sizes below a cut and counts those above its complement as whole
    bins; the second rounds each share of a bin to a k-th, keeping exact multiples of
    1/(k+1).
    """
    counts = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1)
    best = -(-int((counts * x).sum()) // capacity)
    for cut in range(1, capacity // 2 + 1):
        value = np.where(x > capacity - cut, capacity, np.where(x < cut, 0, x))
        best = max(best, -(-int((counts * value).sum()) // capacity))
    for k in range(1, 101):
        scaled = (k + 1) * x
        exact = scaled % capacity == 0
        # Both branches over the common denominator k * capacity.
        value = np.where(exact, x * k, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def _offsets(frame: pd.DataFrame) -> pd.Series:
    return frame.groupby("sequence_id", sort=False)["length"].cumsum() - frame["length"]


def pack(
    parts: DataFrame,
    capacity: int = CAPACITY,
    group_items: int = GROUP_ITEMS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces.

    A group holds about ``group_items`` pieces, whatever the number of documents: the
    number of groups follows the number of pieces.
    """
    whole = (
        parts.filter(F.col("length") == capacity)
        .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
        .withColumn("certified", F.lit(True))
    )
    done = [whole]
    rest = parts.filter(F.col("length") < capacity).select(
        "*",
        F.lit(None).cast("long").alias("sequence_id"),
        F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()).alias("_deal"),
    )
    for turn in range(rounds):
        groups = max(1, -(-rest.count() // group_items))
        dealt = rest.withColumn("_group", F.pmod(F.col("_deal"), F.lit(groups)))
        found = materialise(
            dealt.drop("_deal").groupBy("_group").applyInPandas(
                _packer(turn, capacity), PACKED
            )
        )
        last = turn + 1 == rounds or groups == 1
        done.append(found if last else found.filter("certified"))
        if last:
            break
        # Whole sequences move, so that the old packing of a group can be kept.
        rest = (
            found.filter("NOT certified")
            .drop("certified", "offset")
            .withColumn("_deal", F.xxhash64("sequence_id", F.lit(turn)))
        )
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("certified")


def _packer(turn: int, capacity: int):
    def packed(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop(columns="_group").sort_values(
            ["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True]
        )
        sizes = frame["length"].to_numpy()
        bins = best_fit_decreasing(sizes, capacity)
        used, bound = int(bins.max()) + 1, lower_bound(sizes, capacity)
        old = frame["sequence_id"]
        if turn and old.nunique() <= used:
            ids, used = old.to_numpy(), old.nunique()
        else:
            ids = (turn << 56) + (int(key[0]) << 24) + bins
        frame["sequence_id"] = ids
        frame["offset"] = _offsets(frame)
        filled = frame.groupby("sequence_id")["length"].transform("sum")
        # Full sequences are final; the others go on where the group has a gap.
        frame["certified"] = (filled == capacity) | (used == bound)
        return frame

    return packed


def pack_in_order(
    parts: DataFrame,
    capacity: int = CAPACITY,
    group_items: int = GROUP_ITEMS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The same for a table of pieces with their ``PLACE``, so that the order lasts.

    A group is a run of ``group_items`` places; those with a gap meet their neighbours in the
    next round. A sequence has the place of its middle piece as its number, and rows come in
    the order of sequences.
    """
    total = (parts.agg(F.max(PLACE)).first()[0] or 0) + 1
    whole = parts.filter(F.col("length") == capacity)
    done = [
        whole.select(
            *whole.columns,
            F.col(PLACE).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
            F.lit(True).alias("certified"),
        )
    ]
    rest = parts.filter(F.col("length") < capacity).withColumn("sequence_id", F.col(PLACE))
    schema = f"{PACKED}, {PLACE} long"
    for turn in range(rounds):
        width = group_items * GROUPS_MEET**turn
        grouped = rest.withColumn("_group", F.floor(F.col("sequence_id") / F.lit(width)))
        found = materialise(
            grouped.groupBy("_group").applyInPandas(_packer_in_order(turn, capacity), schema)
        )
        last = turn + 1 == rounds or total <= width
        done.append(found if last else found.filter("certified"))
        if last:
            break
        rest = found.filter("NOT certified").drop("certified", "offset")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("certified", PLACE).orderBy("sequence_id", "offset")


def gathered(sizes: np.ndarray, places: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The bin of each piece after exchanges of pieces of one size: bins stay as full as they
    are, and of each size the earlier pieces go to the bins that stand earlier."""
    by_place = np.lexsort((places, sizes))
    weights = np.bincount(bins, sizes)
    out = bins.copy()
    for _ in range(EXCHANGES):
        middle = np.bincount(out, sizes * places.astype(float)) / weights
        slots = np.lexsort((middle[out], sizes))
        out[by_place] = out[slots]
    return out


def _packer_in_order(turn: int, capacity: int):
    def packed(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop(columns="_group").sort_values(["length", PLACE], ascending=[False, True])
        sizes = frame["length"].to_numpy()
        bins = best_fit_decreasing(sizes, capacity)
        used, bound = int(bins.max()) + 1, lower_bound(sizes, capacity)
        if turn and frame["sequence_id"].nunique() <= used:
            used = frame["sequence_id"].nunique()
        else:
            places = frame[PLACE].to_numpy()
            frame["sequence_id"] = gathered(sizes, places - places.min(), bins)
        frame = frame.sort_values(["sequence_id", PLACE])
        by_sequence = frame.groupby("sequence_id", sort=False)
        lower = (by_sequence[PLACE].transform("size") - 1) // 2 == by_sequence.cumcount()
        middle = frame[lower].set_index("sequence_id")[PLACE]
        frame["sequence_id"] = frame["sequence_id"].map(middle)
        frame["offset"] = _offsets(frame)
        filled = frame.groupby("sequence_id")["length"].transform("sum")
        frame["certified"] = (filled == capacity) | (used == bound)
        return frame

    return packed


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    added: Mapping[str, int] | None = None,
    in_order: bool = False,
) -> DataFrame:
    """Tokenise, cut and pack the documents: one row per piece. ``in_order`` keeps the order of
    ``docs`` as they were stored, or else of their partitions."""
    if in_order:
        parts = materialise(pieces(docs, tokenizer, capacity, added=added, stands=True))
        return pack_in_order(placed(parts), capacity)
    return pack(materialise(pieces(docs, tokenizer, capacity, added=added)), capacity)

