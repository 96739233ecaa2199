"""Repeated passages by relative Lempel-Ziv parsing against an index of all documents.

Every document is cut into reference blocks at content-defined anchors: in each run of
``window`` words the eight-word phrase with the least hash is the anchor, so equal runs have
equal anchors wherever they stand. A block is all windows that share one anchor. The index
holds every block of every document under its anchor, so a document is parsed against all
others without being compared with each: consecutive blocks found in the index extend one
factor. Only at the boundaries of a factor, where a block's anchor is in the index but not
the block as a whole, single windows are checked. Factors have at least ``window`` words by
construction, and every word of one is a duplicate.

A word is removed exactly if it stands in a window whose word sequence also starts at
another place, in the same document or elsewhere; windows are judged on the input.

Defined results: a NULL or empty text has no words and nothing is removed. Texts shorter
than a window are never changed. Repeated rows are documents like any others, so a text of
``window`` words or more that is there twice loses all its words. A NULL doc_id is allowed. Texts
of any length are read whole. Columns with the names of helper columns change nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdgrid.llm.common import WORD_PATTERN, free_name, in_slices
from crowdgrid.session import materialise, small_batches

WINDOW = 35
PHRASE = 8
# Bytes of text that a task holds as words at a time; one longer text is held whole.
SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE_BITS = np.uint64(30)
_PLACES = np.uint64((1 << 30) - 1)
IDENTITY = ["c1", "c2"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


class Run:
    """The words of some documents in a row, hashed, with sums from which the hash of any
    stretch follows."""

    def __init__(self, documents: list[list[bytes]]) -> None:
        self.lengths = np.array([len(d) for d in documents], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.total = int(self.lengths.sum())
        each = (xxhash.xxh64_intdigest(w) for d in documents for w in d)
        hashes = np.fromiter(each, dtype=np.uint64, count=self.total)
        powers = np.ones(self.total + 1, dtype=np.uint64)
        powers[1:] = _BASE
        back = np.ones(self.total + 1, dtype=np.uint64)
        back[1:] = _BACK
        powers, self.back = np.cumprod(powers), np.cumprod(back)
        self.sums = np.zeros(self.total + 1, dtype=np.uint64)
        np.cumsum(hashes * powers[:-1], out=self.sums[1:])

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the word sequences from ``start`` to before ``end``."""
        plain = (self.sums[end] - self.sums[start]) * self.back[start]
        return _mixed(plain + _mixed((end - start).astype(np.uint64)))

    def blocks(self, window: int) -> tuple[np.ndarray, ...]:
        """document, first and last window, anchor and whole hash of every block."""
        none = np.zeros(0, dtype=np.int64)
        if self.total < window:
            return none, none, none, none, none
        at = np.arange(self.total - PHRASE + 1)
        phrase = self.stretch(at, at + PHRASE)
        least = (phrase & ~_PLACES) | at.astype(np.uint64)
        width, span = 1, window - PHRASE + 1
        while width * 2 <= span:
            least = np.minimum(least[: len(least) - width], least[width:])
            width *= 2
        rest = span - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        counts = np.maximum(self.lengths - window + 1, 0)
        document = np.repeat(np.arange(len(counts)), counts)
        begun = np.concatenate([[0], np.cumsum(counts)[:-1]])
        start = np.arange(counts.sum()) - np.repeat(begun - self.starts, counts)
        if not len(start):
            return none, none, none, none, none
        anchor = (least[start] & _PLACES).astype(np.int64)
        new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(start)]]) - 1
        whole = self.stretch(start[first], start[last] + window)
        document = document[first]
        return (
            document,
            start[first] - self.starts[document],
            start[last] - self.starts[document],
            phrase[anchor[first]].view(np.int64),
            whole.view(np.int64),
        )


def _identity(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a text; equal texts share all their removals."""
    return [F.xxhash64(text).alias("c1"), F.xxhash64(F.lit("again"), text).alias("c2")]


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select("text", *_identity(F.col("text")))


def reference_blocks(docs: DataFrame, window: int) -> DataFrame:
    """Every block of every row: anchor, whole, c1, c2, first, last (window starts)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, most_bytes=SLICE):
            run = Run([words(t.as_py()) for t in batch.column("text")])
            document, first, last, anchor, whole = run.blocks(window)
            take = pa.array(document)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor),
                    pa.array(whole),
                    batch.column("c1").take(take),
                    batch.column("c2").take(take),
                    pa.array(first.astype(np.int32)),
                    pa.array(last.astype(np.int32)),
                ],
                names=["anchor", "whole", "c1", "c2", "first", "last"],
            )

    return _identified(docs).mapInArrow(
        cut, "anchor long, whole long, c1 long, c2 long, first int, last int"
    )


def _boundary_windows(docs: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """Hashes of the windows of the asked blocks: hash, whole, c1, c2, start."""
    lists = asked.groupBy(*IDENTITY).agg(
        F.collect_list(F.struct("first", "last", "whole")).alias("asked")
    )
    found = _identified(docs).join(lists, IDENTITY).dropDuplicates(IDENTITY)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, most_bytes=SLICE):
            run = Run([words(t.as_py()) for t in batch.column("text")])
            parts = []
            for row, blocks in enumerate(batch.column("asked")):
                first = blocks.values.field("first").to_numpy().astype(np.int64)
                last = blocks.values.field("last").to_numpy().astype(np.int64)
                whole = blocks.values.field("whole").to_numpy()
                counts = last - first + 1
                begun = np.concatenate([[0], np.cumsum(counts)[:-1]])
                start = np.arange(counts.sum()) - np.repeat(begun - first, counts)
                at = start + run.starts[row]
                key = run.stretch(at, at + window).view(np.int64)
                parts.append((key, np.repeat(whole, counts), np.full(len(start), row), start))
            key, whole, row, start = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key),
                    pa.array(whole),
                    batch.column("c1").take(pa.array(row)),
                    batch.column("c2").take(pa.array(row)),
                    pa.array(start.astype(np.int32)),
                ],
                names=["hash", "whole", "c1", "c2", "start"],
            )

    return found.select("text", "asked", *IDENTITY).mapInArrow(
        hashed, "hash long, whole long, c1 long, c2 long, start int"
    )


def removals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The duplicate spans of every distinct text that has any: c1, c2, spans.

    A span is a struct (start, stop) of word places; spans may touch or overlap.
    """
    small_batches(docs.sparkSession)
    blocks = reference_blocks(docs, window)
    # What is counted is stored before it is joined, here and below: adaptive execution splits
    # a crowded anchor, block or window only where both sides come straight from a shuffle.
    met = materialise(
        blocks.groupBy("anchor").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
    )
    shared = materialise(blocks.join(met.select("anchor"), "anchor"))

    kinds = materialise(
        shared.groupBy("anchor", "whole").agg(
            F.count(F.lit(1)).alias("times"), F.min("c1").alias("speaker")
        )
    )
    several = materialise(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")))
    counted = materialise(kinds.join(several, "anchor").filter("times > 1 OR kinds > 1"))
    judged = materialise(
        shared.join(counted, ["anchor", "whole"])
        .groupBy(*IDENTITY, "first", "last", "whole")
        .agg(
            F.first("times").alias("times"),
            F.first("kinds").alias("kinds"),
            F.first("speaker").alias("speaker"),
        )
    )
    # A block found as a whole is part of a factor. Others are checked window by window
    # against the blocks of their anchor, each of which one document speaks for.
    factors = judged.filter("times > 1").select(
        *IDENTITY, F.col("first").alias("start"), (F.col("last") + window).alias("stop")
    )
    asked = judged.filter("kinds > 1 AND (times = 1 OR c1 = speaker)")
    windows = materialise(_boundary_windows(docs, asked, window))
    alike = windows.groupBy("hash").agg(F.min("whole").alias("x"), F.max("whole").alias("y"))
    alike = materialise(alike.filter("x <> y").select("hash"))
    edges = windows.join(alike, "hash", "left_semi").select(
        *IDENTITY, "start", (F.col("start") + window).alias("stop")
    )
    return (
        factors.unionByName(edges)
        .groupBy(*IDENTITY)
        .agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    )


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for s in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and s[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]))
        else:
            out.append(s)
    return out


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after each."""
    places = [m.start() for m in WORD_PATTERN.finditer(text)] + [len(text)]
    out, at = [], 0
    for start, stop in spans:
        out.append(text[at : places[start]])
        at = places[stop]
    return "".join([*out, text[at:]])


def _with_spans(docs: DataFrame, window: int, name: str) -> DataFrame:
    """Every row of ``docs`` with its spans (NULL where there are none)."""
    first, second = free_name(docs, f"{name}_1"), free_name(docs, f"{name}_2")
    spans = removals(docs, window).select(
        F.col("c1").alias(first), F.col("c2").alias(second), F.col("spans").alias(name)
    )
    one, two = _identity(docs["text"])
    match = (one == spans[first]) & (two == spans[second])
    return docs.join(spans, match, "left").drop(first, second)


def find_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the merged removed spans of every row."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:int,stop:int>>"

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, most_bytes=SLICE):
            n_words, n_removed, digests, spans = [], [], [], []
            for text, found in zip(batch.column("text"), batch.column("spans")):
                all_words, gone = words(text.as_py()), merged(found.as_py())
                kept, at = [], 0
                for start, stop in gone:
                    kept += all_words[at:start]
                    at = stop
                kept += all_words[at:]
                n_words.append(len(all_words))
                n_removed.append(len(all_words) - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                spans.append([{"start": s, "stop": e} for s, e in gone])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans"],
            )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _with_spans(plain, window, "spans").select("doc_id", "text", "spans").mapInArrow(told, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` and ``n_chars`` brought up to date.

    Texts without a repeat are unchanged; a text that loses every word stays as an empty one.
    """
    name = free_name(docs, "llm_spans")

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        # It is also called for rows without spans, whose result is not used.
        out = [cut_text(t.as_py() or "", merged(s.as_py())) for t, s in zip(texts, spans)]
        return pa.array(out, pa.string())

    marked = _with_spans(docs, window, name)
    text = F.when(F.col(name).isNull(), F.col("text")).otherwise(cut(F.col("text"), F.col(name)))
    out = marked.withColumn("text", text).drop(name)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(*docs.columns)
