"""Files of token ids: a context-mixing range coder over blocks that stand for themselves.

Documents are dealt into ranges by id and sorted, and each task writes its ids as files of
bounded size. A file has a head, an index of its documents, a table of its blocks, the tables
of their frequencies, and the blocks. Each block holds the same number of ids, is coded by
``block_coder`` with models that start empty, and carries checksums of its code and of its
ids, so any block can be read, and a damaged one is named. Files of the former mark, whose
blocks are those of ``range_coder``, are read as well. The files are the binary cells of a Parquet table, written and
read by Spark, so any store it reaches will do.

Layout, little-endian: ``CGI3``; id bits, ids a block as u32; documents, ids, blocks as u64;
for every document whether it has an id (u8), its id (i64), its number of ids (u64); for
every block its bytes, the CRC-32 of them and of its ids (u32 each); the blocks of a group
(u32), and for every group the bytes of its tables (u32) and these; the CRC-32 of all that;
the blocks. ``CGI2`` has no groups.

Defined results: a NULL text counts as empty and has the closing id alone. Rows with a NULL
``doc_id`` come first; rows of one ``doc_id`` follow each other by the hash of their text,
repeated rows as often as they are there. A document of any length lies in one file. No
document, no file and no rows. Other columns are left aside, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from crowdgrid.llm import block_coder, range_coder
from crowdgrid.llm.common import in_slices
from crowdgrid.llm.token_ids import shared
from crowdgrid.session import scratch

MAGIC, FORMER = b"CGI3", b"CGI2"
END_ID = 1
# Ids in a block; those of a file, from which a new one is begun; blocks coded side by side.
BLOCK_IDS = 2048
FILE_IDS = 1 << 23
LANES = 4096

FILES = "part int, file int, n_docs long, n_ids long, data binary"
READ = "part int, file int, place long, doc_id long, before long, ids binary"
CHECKED = "part int, file int, before long, doc_id long, n_tokens long, ids_crc32 long"

_HEAD = np.dtype([("bits", "<u4"), ("block", "<u4"), ("docs", "<u8"), ("ids", "<u8"), ("blocks", "<u8")])
_DOC = np.dtype([("known", "u1"), ("id", "<i8"), ("ids", "<u8")])
_BLOCK = np.dtype([("bytes", "<u4"), ("code", "<u4"), ("ids", "<u4")])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_file(
    doc_ids: list[int | None], texts: list[bytes], id_bits: int, block_ids: int = BLOCK_IDS
) -> bytes:
    """The file of some documents, given the ids of each as little-endian u32."""
    ids = np.frombuffer(b"".join(texts), dtype="<u4")
    if len(ids) and int(ids.max()) >> id_bits:
        raise ValueError(f"an id has more than {id_bits} binary digits")
    docs = np.zeros(len(texts), dtype=_DOC)
    docs["known"] = [d is not None for d in doc_ids]
    docs["id"] = [d or 0 for d in doc_ids]
    docs["ids"] = [len(t) // 4 for t in texts]
    blocks = [ids[at : at + block_ids] for at in range(0, len(ids), block_ids)]
    codes, groups = [], LANES.to_bytes(4, "little")
    for at in range(0, len(blocks), LANES):
        coded, tables = block_coder.encode(blocks[at : at + LANES], id_bits, block_ids)
        codes += coded
        groups += len(tables).to_bytes(4, "little") + tables
    table = np.zeros(len(blocks), dtype=_BLOCK)
    table["bytes"] = [len(c) for c in codes]
    table["code"] = [zlib.crc32(c) for c in codes]
    table["ids"] = [zlib.crc32(b.tobytes()) for b in blocks]
    head = np.array([(id_bits, block_ids, len(docs), len(ids), len(blocks))], dtype=_HEAD)
    front = MAGIC + head.tobytes() + docs.tobytes() + table.tobytes() + groups
    return b"".join([front, zlib.crc32(front).to_bytes(4, "little"), *codes])


class _Front:
    """Head, documents and blocks of a file, the tables of its groups, and where its first
    block begins. A former file has no tables."""

    def __init__(self, data: bytes) -> None:
        if data[:4] not in (MAGIC, FORMER):
            raise ValueError("not a file of token ids")
        at = 4 + _HEAD.itemsize
        self.head = head = np.frombuffer(data, _HEAD, 1, 4)[0]
        ends = at + int(head["docs"]) * _DOC.itemsize + int(head["blocks"]) * _BLOCK.itemsize
        self.group, self.tables = LANES, []
        if data[:4] == MAGIC:
            self.group = max(1, _number(data, ends))
            ends += 4
            for _ in range(0, int(head["blocks"]), self.group):
                size = _number(data, ends)
                self.tables.append(data[ends + 4 : ends + 4 + size])
                ends += 4 + size
        if zlib.crc32(data[:ends]) != _number(data, ends):
            raise ValueError("the index of a file is damaged")
        self.docs = np.frombuffer(data, _DOC, int(head["docs"]), at)
        self.table = np.frombuffer(data, _BLOCK, int(head["blocks"]), at + self.docs.nbytes)
        self.blocks = ends + 4


def _number(data: bytes, at: int) -> int:
    if at + 4 > len(data):
        raise ValueError("the index of a file is damaged")
    return int.from_bytes(data[at : at + 4], "little")


def read_blocks(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of the blocks from ``first`` to before ``last``; all by default."""
    front = _Front(data)
    head, table, group = front.head, front.table, front.group
    begins = front.blocks + np.concatenate([[0], np.cumsum(table["bytes"], dtype=np.int64)])
    total, size, bits = int(head["ids"]), int(head["block"]), int(head["bits"])
    wanted = range(len(table))[first:last]
    found = [np.zeros(0, dtype="<u4")]
    for start in range(wanted.start // group * group, wanted.stop, group):
        chosen = range(max(start, wanted.start), min(start + group, wanted.stop))
        codes = [data[begins[i] : begins[i + 1]] for i in chosen]
        _same(chosen, [zlib.crc32(c) for c in codes], table["code"], "code")
        sizes = [min(size, total - i * size) for i in chosen]
        if front.tables:
            blocks = block_coder.decode(codes, front.tables[start // group], sizes, bits, size)
        else:
            blocks = range_coder.decode(codes, sizes, bits, size)
        _same(chosen, [zlib.crc32(b.astype("<u4", copy=False)) for b in blocks], table["ids"], "ids")
        found += blocks
    return np.concatenate(found).astype("<u4", copy=False)


def _same(blocks: range, got: list[int], wanted: np.ndarray, what: str) -> None:
    for i, crc in zip(blocks, got):
        if crc != int(wanted[i]):
            raise ValueError(f"block {i} of a file is damaged: its {what} do not match")


def unpack_file(data: bytes) -> Iterator[tuple[int | None, bytes]]:
    """Every document of a file in order, with its ids as little-endian u32."""
    docs, ids = _Front(data).docs, read_blocks(data).tobytes()
    at = 0
    for doc in docs:
        end = at + 4 * int(doc["ids"])
        yield (int(doc["id"]) if doc["known"] else None), ids[at:end]
        at = end


def write_files(
    docs: DataFrame,
    path: str | None = None,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the ids of all documents by ascending ``doc_id``; the table of files.

    Without a ``path`` the files go to the shared folder of the session. The rows of one
    ``doc_id`` may be dealt to several ranges, so that a crowded one does not meet in one task.
    """
    spark = docs.sparkSession
    vocabulary = tokenizer or default_tokenizer()
    end = np.array([end_id], dtype="<u4").tobytes()
    path = path or scratch(spark, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, number = shared(vocabulary), TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def packed() -> pa.RecordBatch:
            data = pack_file(names, texts, max(encoder.id_bits, end_id.bit_length()), block_ids)
            row = {"part": part, "file": number, "n_docs": len(names), "n_ids": held, "data": data}
            return pa.RecordBatch.from_pylist([row], schema=_FILE_SCHEMA)

        for batch in in_slices(batches):
            for name, text in zip(batch.column("doc_id"), batch.column("text").cast(pa.binary())):
                ids = encoder.ids_of(text.as_py() or b"") + end
                names.append(name.as_py())
                texts.append(ids)
                held += len(ids) // 4
                if held >= file_ids:
                    yield packed()
                    names, texts, held, number = [], [], 0, number + 1
        if names:
            yield packed()

    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash"), F.col("_row")]
    dealt = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "text",
            F.xxhash64("text").alias("_hash"),
            F.monotonically_increasing_id().alias("_row"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    dealt.select("doc_id", "text").mapInArrow(write, FILES).write.parquet(path)
    return open_files(spark, path)


_FILE_SCHEMA = pa.schema(
    [("part", pa.int32()), ("file", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())]
)


def open_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILES).parquet(path)


def read_files(files: DataFrame) -> DataFrame:
    """Every document of the files: its file and place, the ids ``before`` it in the file,
    and its ids as little-endian u32."""
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["part", "file", "place", "doc_id", "before", "ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, file, data = (batch.column(c)[row].as_py() for c in ("part", "file", "data"))
                rows, before, size = [], 0, 0
                for place, (doc_id, ids) in enumerate(unpack_file(data)):
                    rows.append((part, file, place, doc_id, before, ids))
                    before, size = before + len(ids) // 4, size + len(ids)
                    if size >= 4 << 20:
                        yield _rows(rows, names, kinds)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows, names, kinds)

    return files.select("part", "file", "data").mapInArrow(read, READ)


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def file_starts(files: DataFrame) -> DataFrame:
    """The ids of all files before each one: sums over parts, then over the files of a part.

    One row for each file, and one for each part in the window without a key.
    """
    sizes = files.select("part", "file", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    return (
        sizes.withColumn("_within", within)
        .join(parts, "part")
        .select("part", "file", (F.col("_before") + F.col("_within")).alias("file_start"))
    )


def placed(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``start`` in place of the file: the ids of all documents before each row's."""
    return (
        rows.join(file_starts(files), ["part", "file"])
        .withColumn("start", F.col("file_start") + F.col("before"))
        .drop("part", "file", "place", "before", "file_start")
    )


def document_ids(files: DataFrame) -> DataFrame:
    """doc_id, ``ids`` and ``start`` of every document, read from files."""
    return placed(read_files(files), files)


def document_checks(files: DataFrame) -> DataFrame:
    """doc_id, the number of ids, their CRC-32 and ``start`` of every document, read from
    files; the ids themselves go no further than the process that reads them."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, file, data = (batch.column(c)[row].as_py() for c in ("part", "file", "data"))
                names, sizes, sums = [], [], []
                for doc_id, ids in unpack_file(data):
                    names.append(doc_id)
                    sizes.append(len(ids) // 4)
                    sums.append(zlib.crc32(ids))
                n_tokens = np.array(sizes, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(names), part, dtype=np.int32)),
                        pa.array(np.full(len(names), file, dtype=np.int32)),
                        pa.array(np.cumsum(n_tokens) - n_tokens),
                        pa.array(names, pa.int64()),
                        pa.array(n_tokens),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["part", "file", "before", "doc_id", "n_tokens", "ids_crc32"],
                )

    return placed(files.select("part", "file", "data").mapInArrow(check, CHECKED), files)
