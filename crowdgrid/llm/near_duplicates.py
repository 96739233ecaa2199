"""MinHash near-duplicates through an LSH forest, confirmed on whole shingle sets.

Documents with the same shingle set form a class; all later work is on classes. Each class
has a signature of ``TREES`` short orders of min-hashes. In each order, classes that share a
prefix of the first depth are neighbours by longest common prefix: they form a region. A
region of few members gives all its pairs as candidates. A region of many members is looked
at again with a longer prefix, so depth grows only where the forest is crowded. Members
that still share the longest prefix are linked to the region's smallest member and dealt to
small sub-regions, other ones in each tree. What these leave apart in such a region is
compared in full, blocks against blocks, so that no pair of its members is passed over.

A byte sketch of the signature rules out pairs whose similarity is far below the threshold
(five standard deviations). The rest is confirmed on full sets, in two turns: the best
candidate of each class first; then only candidates whose ends are not yet connected. A
third of all rows in one group thus costs a bounded number of candidates a row.

Defined results: a NULL or empty text has no shingles, belongs to no group and is kept.
Repeated rows are all returned; rows of one doc_id with different texts are grouped by
their texts. A NULL doc_id is larger than any other; a group of NULL ids alone has a NULL
component and its rows are kept. Texts of any length are compared whole. Columns with the names
of helper columns change nothing.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdgrid.llm.common import free_name
from crowdgrid.session import materialise, small_batches

TREES = 20
DEPTHS = (4, 6, 8)
SKETCH = 64
# Members of a region that may all be paired.
REGION = 16
HELD = 1 << 19  # shingles that a task keeps from earlier pairs
# Members, and shingles, of a block in which a crowded region is compared, about.
BLOCK = 256
BLOCK_SHINGLES = 1 << 20
WIDTH = 2  # bytes of a min-hash in an order
_MASK = (1 << 64) - 1
_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(1, 1 << 63, TREES * DEPTHS[-1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, TREES * DEPTHS[-1], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text.

    Fewer words than a shingle has give the whole sequence as one; no words give none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    each = (xxhash.xxh64_intdigest(w) for w in found)
    hashes = np.fromiter(each, dtype=np.uint64, count=len(found))
    taken = min(words, len(found))
    out = np.full(len(found) - taken + 1, taken, dtype=np.uint64)
    for i in range(taken):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - taken + 1 + i])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least permuted hash of the set, for each function of the forest."""
    least = np.full(len(_FACTORS), _MASK, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        part = shingles[at : at + 1024, None]
        least = np.minimum(least, (part * _FACTORS + _SHIFTS).min(axis=0))
    return _mixed(least)


def _key(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, key of the shingle set, its size, orders and sketch of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, orders, sketches = [], [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), words)
                sizes.append(len(shingles))
                keys.append(_key(shingles))
                if len(shingles):
                    least = signature(shingles)
                    orders.append((least & np.uint64(0xFFFF)).astype(">u2").tobytes())
                    sketches.append((least[:SKETCH] >> np.uint64(32)).astype(np.uint8).tobytes())
                else:
                    orders.append(None)
                    sketches.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(orders, pa.binary()),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "key", "n_shingles", "orders", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sign, "doc_id long, key binary, n_shingles long, orders binary, sketch binary"
    )


def _classes(rows: DataFrame) -> DataFrame:
    """One row per shingle set, numbered; copies combine in the tasks before the shuffle."""
    return materialise(
        rows.filter("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("rep"),
            F.first("n_shingles").alias("n"),
            F.first("orders").alias("orders"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )


def _regions(rows: DataFrame, depth: int) -> DataFrame:
    """Rows whose region of this depth has two or more members, with its size and least node.

    The sizes are a table, as adaptive execution splits a crowded region of the join only
    where both sides come straight from a shuffle.
    """
    prefix = F.substring("order", 1, WIDTH * depth)
    keyed = rows.withColumn("region", F.xxhash64("tree", prefix))
    sizes = materialise(
        keyed.groupBy("region")
        .agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot"))
        .filter("size > 1")
    )
    return keyed.join(sizes, "region")


def candidates(
    classes: DataFrame, percent: int, depths: tuple[int, ...] = DEPTHS, most: int = REGION
) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b, alike) of nodes, a < b, each once; alike counts equal bytes
    of the sketches. And region, tree and node of the members that share the longest prefix
    with too many, not all of whose pairs are candidates."""
    length = WIDTH * depths[-1]
    forest = classes.select(
        "node", "orders", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    ).select("node", "tree", F.expr(f"substring(orders, tree * {length} + 1, {length})").alias("order"))
    traits = classes.select("node", "n", "sketch")
    found, rows = [], forest
    for depth in depths:
        members = materialise(_regions(rows, depth))
        found.append(members.filter(F.col("size") <= most).select("region", "node"))
        rows = members.filter(F.col("size") > most).select("node", "tree", "order")
        crowded = members.filter(F.col("size") > most)
    # The longest prefix is shared by many: sub-regions at random, and the least member.
    part = F.pmod(F.xxhash64("node", "tree"), F.ceil(2 * F.col("size") / F.lit(most)))
    found.append(crowded.select(F.xxhash64("region", part).alias("region"), "node"))
    stars = crowded.filter("node <> pivot").select(
        F.col("pivot").alias("a"), F.col("node").alias("b"), F.lit(SKETCH).alias("alike")
    )
    groups = (
        reduce(DataFrame.unionByName, found)
        .join(traits, "node")
        .groupBy("region")
        .agg(F.collect_list(F.struct("node", "n", "sketch")).alias("members"))
        .filter(F.size("members") > 1)
    )
    pairs = groups.select("members").mapInArrow(_paired(percent), "a long, b long, alike int")
    both = pairs.unionByName(stars).groupBy("a", "b").agg(F.max("alike").alias("alike"))
    return both, crowded.select("region", "tree", "node")


def _least_alike(percent: int) -> int:
    """Equal bytes of a pair at the threshold, less five standard deviations."""
    share = percent / 100
    return int(SKETCH * share - 5 * np.sqrt(SKETCH * share * (1 - share)))


def _paired(percent: int):
    least = _least_alike(percent)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[np.ndarray] = []
            for members in batch.column("members"):
                values = members.values
                node = values.field("node").to_numpy()
                n = values.field("n").to_numpy()
                sketch = np.frombuffer(b"".join(values.field("sketch").to_pylist()), np.uint8)
                sketch = sketch.reshape(len(node), SKETCH)
                i, j = np.triu_indices(len(node), 1)
                sized = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
                i, j = i[sized], j[sized]
                alike = (sketch[i] == sketch[j]).sum(axis=1)
                near = alike >= least
                i, j = i[near], j[near]
                low, high = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
                out.append(np.stack([low, high, alike[near]]))
            a, b, alike = np.hstack(out) if out else np.zeros((3, 0), dtype=np.int64)
            differ = a != b
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[differ]), pa.array(b[differ]), pa.array(alike[differ].astype(np.int32))],
                names=["a", "b", "alike"],
            )

    return pair


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold; ``texts`` has node and text."""
    both = (
        pairs.select("a", "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[int, np.ndarray] = OrderedDict()
        size = 0

        def full(node: int, text: pa.Scalar) -> np.ndarray:
            nonlocal size
            if node not in held:
                held[node] = shingle_set(text.as_py(), words)
                size += len(held[node])
                while len(held) > 1 and (len(held) > 64 or size > HELD):
                    size -= len(held.popitem(last=False)[1])
            return held[node]

        for batch in batches:
            linked = []
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for x, y, s, t in zip(a, b, batch.column("text_a"), batch.column("text_b")):
                one, two = full(x, s), full(y, t)
                same = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(100 * same >= percent * (len(one) + len(two) - same))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def crowd_links(
    crowded: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int
) -> DataFrame:
    """Links (a, b) between components that members of one crowded region prove.

    ``classes`` has node, root, n, orders and sketch. Only members outside the region's
    largest component are open; blocks of them are compared with blocks of all members, each
    pair of blocks in a task of its own.
    """

    def blocks(size: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(size / F.lit(BLOCK)), F.ceil(shingles / F.lit(BLOCK_SHINGLES))).cast("int")

    members = materialise(crowded.join(classes.select("node", "root", "n"), "node"))
    parts = members.groupBy("region", "root").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n"))
    regions = materialise(
        parts.groupBy("region")
        .agg(
            F.sum("size").alias("size"),
            F.sum("n").alias("n"),
            F.max(F.struct("size", "n", "root")).alias("main"),
        )
        .filter("size > main.size")
        .select(
            "region",
            F.col("main.root").alias("main"),
            blocks(F.col("size"), F.col("n")).alias("blocks"),
            blocks(F.col("size") - F.col("main.size"), F.col("n") - F.col("main.n")).alias("open_blocks"),
        )
    )
    rows = members.select("region", "tree", "node").join(regions, "region")
    rows = rows.join(classes.select("node", "root", "n", "orders", "sketch"), "node").join(texts, "node")
    rows = rows.withColumn("open", F.col("root") != F.col("main")).withColumn(
        "deal", F.xxhash64("node", "tree")
    )

    def cells(rows: DataFrame, own: str, other: str, left: bool) -> DataFrame:
        return (
            rows.withColumn(f"{own}_at", F.pmod("deal", own).cast("int"))
            .withColumn(f"{other}_at", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .withColumn("left", F.lit(left))
            .select(
                "region", "tree", "blocks_at", "open_blocks_at",
                "left", "node", "root", "n", "open", "orders", "sketch", "text",
            )
        )

    both = cells(rows.filter("open"), "open_blocks", "blocks", True).unionByName(
        cells(rows, "blocks", "open_blocks", False)
    )
    return both.groupBy("region", "tree", "blocks_at", "open_blocks_at").applyInArrow(
        _compared(words, percent), "a long, b long"
    )


def _compared(words: int, percent: int):
    least = _least_alike(percent)

    def compare(cell: pa.Table) -> pa.Table:
        tree = cell["tree"][0].as_py()
        left = cell["left"].to_numpy()
        unsettled = cell["open"].to_numpy()
        node, root, n = (cell[c].to_numpy() for c in ("node", "root", "n"))
        sketch = np.frombuffer(b"".join(cell["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)
        orders = np.frombuffer(b"".join(cell["orders"].to_pylist()), np.uint8)
        orders = orders.reshape(len(node), TREES, -1).view(np.uint64)
        mine, others = np.flatnonzero(left), np.flatnonzero(~left)
        found = []
        for i in mine:
            # Two open members meet twice, and members that share an earlier order met there.
            j = others[(root[others] != root[i]) & (~unsettled[others] | (node[others] > node[i]))]
            j = j[100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])]
            j = j[(orders[j, :tree] != orders[i, :tree]).any(axis=2).all(axis=1)]
            alike = (sketch[j] == sketch[i]).sum(axis=1)
            near = alike >= least
            found.append(np.stack([alike[near], np.full(near.sum(), i), j[near]]))
        pairs = np.hstack(found) if found else np.zeros((3, 0), dtype=np.int64)
        # The likeliest first: a component found stands for its members from then on.
        pairs = pairs[:, np.argsort(-pairs[0], kind="stable")]
        above: dict[int, int] = {}
        sets: dict[int, np.ndarray] = {}

        def top(x: int) -> int:
            while x in above:
                x = above[x]
            return x

        def full(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = shingle_set(cell["text"][row].as_py(), words)
            return sets[row]

        links = []
        for _, i, j in pairs.T.tolist():
            x, y = top(int(root[i])), top(int(root[j]))
            if x == y:
                continue
            one, two = full(i), full(j)
            same = len(np.intersect1d(one, two, assume_unique=True))
            if 100 * same >= percent * (len(one) + len(two) - same):
                above[max(x, y)] = min(x, y)
                links.append(sorted((int(root[i]), int(root[j]))))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node reachable) of every node that has a link.

    Large-star and small-star steps in turn: every node hands its neighbours to the least of
    them, until only stars are left. Each step is a table in the shared folder.
    """
    links = materialise(links.select("a", "b").distinct())
    while not _stars(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("u"), "m").distinct()
        smallest = large.groupBy("u").agg(F.min("m").alias("r"))
        handed = large.join(smallest, "u")
        links = materialise(
            handed.filter("m <> r")
            .select(F.col("r").alias("a"), F.col("m").alias("b"))
            .unionByName(smallest.select(F.col("r").alias("a"), F.col("u").alias("b")))
            .distinct()
        )
    return links.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _stars(links: DataFrame) -> bool:
    """Whether every link leads from a root, and every other node has one link only."""
    roots = links.select(F.col("a").alias("b")).distinct()
    twice = links.groupBy("b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return links.join(roots, "b", "left_semi").isEmpty() and twice.isEmpty()


def _texts(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node and text of the wanted classes (node, key, rep), one row each.

    A class is found by its representative's doc_id; where ids repeat or are NULL, the key
    of the text itself decides.
    """
    key = _key_of("text", words)
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    named = rows.filter("rep IS NOT NULL").join(wanted.filter("rep IS NOT NULL"), "rep")
    nameless = (
        rows.filter("rep IS NULL")
        .withColumn("key", key)
        .join(wanted.filter("rep IS NULL").drop("rep"), "key")
    )
    named = named.withColumn("found", key).filter("found = key")
    both = named.select("node", "text").unionByName(nameless.select("node", "text"))
    return materialise(both.dropDuplicates(["node"]))


def _key_of(column: str, words: int) -> Column:
    @F.arrow_udf("binary")
    def key(texts: pa.Array) -> pa.Array:
        return pa.array([_key(shingle_set(t.as_py(), words)) for t in texts], pa.binary())

    return key(F.col(column))


def _grouped(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, key and n_shingles of every row; key, rep and component_id of every class."""
    small_batches(docs.sparkSession)
    rows = materialise(_signed(docs, words))
    classes = _classes(rows)
    pairs, crowded = candidates(classes, percent)
    pairs = materialise(pairs)

    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    wanted = classes.select("node", "key", "rep").join(ends.distinct(), "node", "left_semi")
    texts = _texts(docs, wanted, words)

    best = F.max(F.struct("alike", (-F.col("a")).alias("a"))).alias("best")
    first = pairs.groupBy("b").agg(best).select((-F.col("best.a")).alias("a"), "b")
    links = materialise(confirm(first, texts, words, percent))
    roots = components(links)

    def rooted(end: str) -> DataFrame:
        return roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))

    # From here on a component stands for its members, so only links between components count.
    open_ = (
        pairs.select("a", "b")
        .join(rooted("a"), "a", "left")
        .join(rooted("b"), "b", "left")
        .filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
        .join(first, ["a", "b"], "left_anti")
        .select("a", "b")
    )
    more = confirm(open_, texts, words, percent).join(rooted("a"), "a", "left")
    more = more.join(rooted("b"), "b", "left").select(
        F.coalesce("root_a", "a").alias("x"), F.coalesce("root_b", "b").alias("y")
    )
    last = components(more.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    last = last.select(F.col("node").alias("root"), F.col("root").alias("last"))

    named = classes.join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node")).join(last, "root", "left")
    named = materialise(named.withColumn("root", F.coalesce("last", "root")).drop("last"))

    final = components(crowd_links(crowded, named, texts, words, percent))
    final = final.select(F.col("node").alias("root"), F.col("root").alias("final"))
    named = named.select("key", "node", "rep", "root").join(final, "root", "left")
    named = named.withColumn("root", F.coalesce("final", "root")).drop("final")
    ids = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    placed = materialise(named.join(ids, "root").select("key", "rep", "component_id"))
    return rows.select("doc_id", "key", "n_shingles"), placed


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Texts are linked when their shingle sets have ``percent`` per cent of their union in
    common. The smallest doc_id of a group is kept.
    """
    rows, placed = _grouped(docs, words, percent)
    linked = rows.join(placed.drop("rep"), "key", "left")
    alone = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return linked.withColumn("component_id", alone).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each group, all columns unchanged.

    Rows without words stay. Among repeated rows of the kept document any one stays.
    """
    # The least doc_id of a group stands for its class, so the classes alone tell who stays.
    kept = (
        _grouped(docs, words, percent)[1]
        .filter(F.col("rep").eqNullSafe(F.col("component_id")))
        .select(F.col("rep").alias("_kept_id"), F.col("key").alias("_kept_key"))
    )
    name = free_name(docs, "llm_key")
    keyed = docs.withColumn(name, _key_of("text", words))
    worded = keyed.filter(F.col(name).isNotNull())
    match = worded["doc_id"].cast("long").eqNullSafe(kept["_kept_id"]) & (
        worded[name] == kept["_kept_key"]
    )
    chosen = worded.join(kept, match, "left_semi").dropDuplicates(["doc_id", name])
    return chosen.unionByName(keyed.filter(F.col(name).isNull())).drop(name)
