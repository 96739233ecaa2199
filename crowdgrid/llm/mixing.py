"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in an order drawn by a fixed hash, are cut into blocks of equal
size. One block is read in each slot. A source of weight w releases its j-th block at slot
floor((j-1)/w) and wants it read before slot ceil(j/w); of the released blocks the one with
the earliest deadline is read. With weights that add up to one every block meets its
deadline, so at any slot a source has had its share up to less than one block.

Weights are taken as the exact fractions they are. The driver schedules block after block and
stores the plan in parts of bounded size; documents meet it by source and block. When
a source ends, the others go on with their weights scaled up, and every document is read
exactly once.

A caller may ask for weights in whole ``parts`` instead. The schedule then repeats every
``parts`` slots, the driver schedules one period, and the slot of any block follows from its
number alone; but weights that are no such parts are rounded, and drift from the target.

Defined results: a NULL source is a source of its own. Sources without a weight, or with
one that is not positive, follow after all others. Repeated rows are documents like any
others. An empty table gives an empty one. A text, of any length, only serves to tell rows of
one ``doc_id`` apart; columns with the names of helper columns change nothing.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import accumulate, islice

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crowdgrid.llm.common import free_name
from crowdgrid.session import scratch

PARTS = 1000
# Blocks of the exact plan that the driver holds at a time.
PLANNED = 1 << 18
BLOCK_DOCUMENTS = 16
# Documents that are put in order together, about; one source is spread over many such lots.
LOT = 10_000
# With ``parts``, the driver plans with a number per source and phase, and sends the plan to the
# tasks; more sources than this are refused there.
MOST_SOURCES = 1000


def natural_weights(counts: Mapping[str | None, int], power: float = 0.5) -> dict:
    """Weights by a power of the sources' sizes: below 1 the small ones count for more."""
    return {s: float(n) ** power for s, n in counts.items() if n > 0}


def in_parts(weights: Mapping, parts: int) -> dict:
    """Weights as whole parts that add up to ``parts`` (one at least each), by largest
    remainder; what small sources get too much is taken where it is missed least."""
    parts = max(parts, len(weights))
    total = sum(weights.values())
    exact = {s: w / total * parts for s, w in weights.items()}
    out = {s: max(1, math.floor(round(x, 9))) for s, x in exact.items()}
    while sum(out.values()) != parts:
        step = 1 if sum(out.values()) < parts else -1
        able = [s for s in out if step > 0 or out[s] > 1]
        s = max(able, key=lambda s: ((exact[s] - out[s]) * step / out[s], s is not None, str(s)))
        out[s] += step
    return out


def period(parts: Mapping) -> dict:
    """The slots of each source in one period of earliest-deadline-first scheduling.

    The j-th block of a source with a parts of D is released at floor((j-1)D/a) and due
    at ceil(jD/a). Among equal deadlines the one that stays tight goes first: a block whose
    window overlaps the next one's, then the heavier source.
    """
    length = sum(parts.values())
    names = sorted(parts, key=lambda s: (-parts[s], s is None, str(s)))
    released: list[list] = [[] for _ in range(length)]
    for rank, s in enumerate(names):
        for j in range(parts[s]):
            due = -(-(j + 1) * length // parts[s])
            overlaps = (j + 1) * length // parts[s] < due
            released[j * length // parts[s]].append((due, not overlaps, rank, s))
    out: dict = {s: [] for s in parts}
    ready: list = []
    for slot in range(length):
        for block in released[slot]:
            heapq.heappush(ready, block)
        due, _, _, s = heapq.heappop(ready)
        if due <= slot:
            raise RuntimeError("a block missed its deadline")
        out[s].append(slot)
    return out


def phases(blocks: Mapping, weights: Mapping, parts: int = PARTS) -> list[dict]:
    """The phases of the schedule: for each source the number of its first block, how many
    blocks it has in the phase, its slots in a period, and the slot the phase starts at.

    A phase ends with the period in which the first of its sources runs out.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    given = {s: 0 for s in left}
    live = {s: weights[s] for s in left if weights.get(s) and weights[s] > 0}
    rest = {s: 1.0 for s in left if s not in live}
    out, start = [], 0
    while live or rest:
        if not live:
            live, rest = rest, {}
        shares = in_parts(live, parts)
        slots = period(shares)
        rounds = min(Fraction(left[s], shares[s]) for s in live)
        length, turns = sum(shares.values()), math.ceil(rounds)
        phase = {"start": start, "length": length, "sources": {}}
        for s in live:
            count = min(left[s], turns * shares[s])
            phase["sources"][s] = {"first": given[s], "count": count, "slots": slots[s]}
            given[s] += count
            left[s] -= count
        out.append(phase)
        start += turns * length
        live = {s: w for s, w in live.items() if left[s]}
    return out


def exact_plan(blocks: Mapping, weights: Mapping) -> Iterator[tuple]:
    """(source, number, slot) of every block, slot by slot, by earliest deadline first.

    The ideal gives every source its share of each slot until it ends, and the others its
    share from then on. A block is released at the slot in which the ideal begins it, and is
    due when the ideal has read it. All arithmetic is on whole numbers.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    live = {s: Fraction(weights[s]) for s in left if weights.get(s) and weights[s] > 0}
    rest = {s: Fraction(1) for s in left if s not in live}
    start = 0
    for group in (live, rest):
        scale = math.lcm(*(w.denominator for w in group.values()))
        # In the order in which the ideal ends them.
        names = sorted(group, key=lambda s: (left[s] / group[s], s is None, str(s)))
        share = [int(group[s] * scale) for s in names]
        size = [left[s] for s in names]
        ends = [n / w for n, w in zip(size, share)]
        gone = [0, *accumulate(size)]
        all_shares = sum(share)
        speed = [all_shares - x for x in (0, *accumulate(share))]

        def ideal(rank: int, j: int) -> int:
            """When the ideal has read j blocks of a source, times its share."""
            own = share[rank]
            k = bisect_right(ends, j / own)
            while k and size[k - 1] * own > j * share[k - 1]:
                k -= 1
            while k < len(size) and size[k] * own <= j * share[k]:
                k += 1
            return gone[k] * own + j * speed[k]

        # Each source waits for the release of one block, or has one that is due.
        waiting = [(0, rank, 0) for rank in range(len(names))]
        ready: list = []
        for slot in range(sum(size)):
            while waiting and waiting[0][0] <= slot:
                _, rank, j = heapq.heappop(waiting)
                heapq.heappush(ready, (-(-ideal(rank, j + 1) // share[rank]), rank, j))
            due, rank, j = heapq.heappop(ready)
            if due <= slot:
                raise RuntimeError("a block missed its deadline")
            yield names[rank], j, start + slot
            if j + 1 < size[rank]:
                heapq.heappush(waiting, (ideal(rank, j + 1) // share[rank], rank, j + 1))
        start += sum(size)


def _stored_plan(spark: SparkSession, plan: Iterator[tuple], names: list[str], kind: str) -> DataFrame:
    """The plan as a table in the shared folder, written in parts of ``PLANNED`` blocks."""
    path, schema = scratch(spark, "plan"), f"{names[0]} {kind}, {names[1]} long, {names[2]} long"
    spark.createDataFrame([], schema).write.parquet(path)
    while part := list(islice(plan, PLANNED)):
        spark.createDataFrame(part, schema, verifySchema=False).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _numbered(docs: DataFrame, total: int, key: str, number: str, seed: int) -> DataFrame:
    """Number the documents of each source from 0 in the order of a hash, without putting
    a source into one task: hash ranges are counted, and each is numbered from its sum.

    Both sides of the join are dealt by source and lot, so the documents move once.
    """
    draw, lot, before = (free_name(docs, f"llm_{n}") for n in ("draw", "lot", "before"))
    lots = max(1, -(-total // LOT))
    drawn = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 40))
    keyed = docs.withColumn(draw, drawn).withColumn(
        lot, F.floor(F.col(draw) * F.lit(lots) / F.lit(1 << 40)).cast("long")
    )
    counted = keyed.groupBy(key, lot).agg(F.count(F.lit(1)).alias("n"))
    # One row per source and lot, about a ten-thousandth of the documents.
    earlier = Window.partitionBy(key).orderBy(lot).rowsBetween(Window.unboundedPreceding, -1)
    sums = counted.select(key, lot, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    within = Window.partitionBy(key, lot).orderBy(draw, "doc_id", "text")
    return (
        keyed.withColumn(number, F.row_number().over(within) - 1)
        .join(sums, [key, lot])
        .withColumn(number, F.col(number) + F.col(before))
        .drop(draw, lot, before)
    )


def schedule(
    docs: DataFrame,
    weights: Mapping | None = None,
    block_documents: int = BLOCK_DOCUMENTS,
    parts: int | None = None,
    seed: int = 7,
    source: str = "source",
) -> tuple[DataFrame, str, str]:
    """``docs`` with the slot of each row and its place in the block, and their names.

    ``parts`` asks for the periodic plan of weights rounded to whole parts.
    """
    if parts is None:
        return _scheduled_exactly(docs, weights, block_documents, seed, source)
    found = docs.groupBy(source).count().limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    counts = {r[0]: r["count"] for r in found}
    blocks = {s: -(-n // block_documents) for s, n in counts.items()}
    plan = phases(blocks, natural_weights(counts) if weights is None else weights, parts)
    rows = [
        (s, p["first"], p["first"] + p["count"], phase["start"], phase["length"], p["slots"])
        for phase in plan
        for s, p in phase["sources"].items()
    ]
    key, number, slot = (free_name(docs, f"llm_{n}") for n in ("key", "number", "slot"))
    plan_names = [free_name(docs, f"llm_plan_{n}") for n in ("key", "from", "to", "start", "length", "slots")]
    p_key, p_from, p_to, p_start, p_length, p_slots = plan_names
    # A source stands in a struct, where NULL is equal to NULL.
    kind = docs.schema[source].dataType.simpleString()
    table = docs.sparkSession.createDataFrame(
        rows,
        f"{p_key} {kind}, {p_from} long, {p_to} long, {p_start} long, {p_length} long, {p_slots} array<int>",
    ).withColumn(p_key, F.struct(F.col(p_key).alias("s")))
    keyed = docs.withColumn(key, F.struct(F.col(source).alias("s")))
    placed = _numbered(keyed, sum(counts.values()), key, number, seed)
    block = F.floor(F.col(number) / F.lit(block_documents))
    match = (F.col(key) == F.col(p_key)) & (block >= F.col(p_from)) & (block < F.col(p_to))
    nth = block - F.col(p_from)
    turn = F.floor(nth / F.size(p_slots))
    at = F.get(p_slots, (nth % F.size(p_slots)).cast("int"))
    # The plan is bounded by MOST_SOURCES, so it may be sent to every task.
    out = placed.join(F.broadcast(table), match).withColumn(
        slot, F.col(p_start) + turn * F.col(p_length) + at
    )
    return out.drop(key, *plan_names), slot, number


def _scheduled_exactly(
    docs: DataFrame, weights: Mapping | None, block_documents: int, seed: int, source: str
) -> tuple[DataFrame, str, str]:
    # The driver holds a few numbers for each source, however many there are.
    counts = {r[0]: r["count"] for r in docs.groupBy(source).count().toLocalIterator()}
    blocks = {s: -(-n // block_documents) for s, n in counts.items()}
    plan = exact_plan(blocks, natural_weights(counts) if weights is None else weights)
    key, number, slot, block = (free_name(docs, f"llm_{n}") for n in ("key", "number", "slot", "block"))
    table = _stored_plan(
        docs.sparkSession, plan, [key, block, slot], docs.schema[source].dataType.simpleString()
    )
    # A source stands in a struct, where NULL is equal to NULL.
    table = table.withColumn(key, F.struct(F.col(key).alias("s")))
    keyed = docs.withColumn(key, F.struct(F.col(source).alias("s")))
    placed = _numbered(keyed, sum(counts.values()), key, number, seed)
    placed = placed.withColumn(block, F.floor(F.col(number) / F.lit(block_documents)))
    return placed.join(table, [key, block]).drop(key, block), slot, number


def mixed_order(docs: DataFrame, weights: Mapping | None = None, **choice) -> DataFrame:
    """doc_id, source, block, slot and place in the block of every row.

    A text only tells rows of one ``doc_id`` apart, so its hash moves in its place.
    """
    source = choice.get("source", "source")
    size = choice.get("block_documents", BLOCK_DOCUMENTS)
    light = docs.select("doc_id", F.xxhash64("text").alias("text"), source)
    out, slot, number = schedule(light, weights, **choice)
    return out.select(
        "doc_id",
        F.col(source).alias("source"),
        F.floor(F.col(number) / F.lit(size)).alias("block"),
        F.col(slot).alias("slot"),
        (F.col(number) % F.lit(size)).cast("int").alias("place"),
    )


def mix(docs: DataFrame, weights: Mapping | None = None, **choice) -> DataFrame:
    """The rows of ``docs`` in mixed order, all columns unchanged, none lost or repeated."""
    out, slot, number = schedule(docs, weights, **choice)
    return out.orderBy(slot, number).select(*docs.columns)
