"""Periodic runs of words, by a sparse dynamic programme over diagonals.

A run is a stretch of words that repeats with its smallest period q, four times over and six
words long at least, and that no neighbouring word extends. On the diagonal of lag q the
words of a run match the words q before them without a gap.

A text is read once from left to right at every width w = 1, 2, 4 and so on, in units of w
words. The earlier occurrences of a unit at the lags from w to 2w - 1 add to the match
lengths of those lags, which are the active ones; a lag whose next unit does not match ends
its diagonal, and if that was long enough its ends are followed word by word and the run is
emitted. A run of period q shows at the width w with w <= q < 2w, where its diagonal matches
two units in a row at least, so nothing is missed; a unit of a frequent word has few lags to
look at, so a text of n words takes about n log n steps whatever it repeats. Diagonals that
lie inside a run of a shorter period repeat that period and are passed over, so that the ends
of few are followed: runs of periods about w are at most about n / w.

Units are compared by 64-bit names made of the names of their halves, and every run is
checked on the words themselves, so equal names of different units only cost time.

Defined results: a NULL or empty text has no words and no runs. Texts of any length are
read whole, in one task each. Repeated rows are answered each. Of two runs with the same
exponent the one that starts first, then that of the shorter period, is the greatest.
Columns other than ``doc_id`` and ``text`` are left aside, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdgrid.llm.common import in_slices, let, words_of

# A run has this many words at least, and repeats its period this often.
LEAST_WORDS = 6
LEAST_TIMES = 4

FOUND = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed string"
)


def _names(halves: np.ndarray, width: int) -> np.ndarray:
    """Names of the units of ``2 * width`` words at every place, from those of ``width``."""
    left, right = halves[:-width], halves[width:]
    mixed = left * np.uint64(0x9E3779B97F4A7C15) + right
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    return mixed


def runs_of(words: np.ndarray, reach: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a sequence of word numbers, by start, then
    period.

    ``reach[k]`` is how far the sequence must be read at width ``2**k``; all of it by default.
    """
    names, width, level = words.astype(np.uint64), 1, 0
    found: list[tuple[int, int, int]] = []
    while True:
        count = len(words) if reach is None else int(reach[level]) if level < len(reach) else 0
        names = names[: max(0, count - width + 1)]
        if count < LEAST_TIMES * width:
            break
        found += _runs_at(words[:count], names, width, sorted(found))
        names, width, level = _names(names, width), 2 * width, level + 1
    least: dict[tuple[int, int], int] = {}
    for s, e, q in sorted(found, key=lambda r: r[2]):
        least.setdefault((s, e), q)
    return sorted(((s, e - s, q) for (s, e), q in least.items()), key=lambda r: (r[0], r[2]))


def _runs_at(
    words: np.ndarray, names: np.ndarray, width: int, shorter: list[tuple[int, int, int]]
) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) with periods from ``width`` to ``2 * width - 1``, given
    those of shorter periods in order."""
    lags, firsts, lasts = _diagonals(names, width)
    begin, end = firsts * width, (lasts + 1) * width
    # Long runs of shorter periods. As the periods are below a third of their length, no two
    # share that much, and their ends are in the order of their starts.
    covers = [(s, e) for s, e, _ in shorter if e - s >= 3 * width]
    if covers and len(lags):
        starts, ends = (np.array(x) for x in zip(*covers))
        at = np.searchsorted(starts, begin - lags, side="right") - 1
        free = ~((at >= 0) & (ends[at] >= end))
        lags, begin, end = lags[free], begin[free], end[free]
    out: set[tuple[int, int, int]] = set()
    for lag, low, high in zip(lags.tolist(), begin.tolist(), end.tolist()):
        out.update(_followed(words, lag, low, high, width))
    return list(out)


def _diagonals(names: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonals that match enough units in a row: lag, first and last matching unit.

    Unit u begins at ``u * width``; its earlier occurrences at the lags are the places from
    ``(u - 2) * width + 1`` to ``(u - 1) * width``. Unit 1 has but one such place and is left
    out: a run that could begin with it matches two later units.
    """
    units = (len(names) - 1) // width + 1
    if units < 3:
        return (np.zeros(0, np.int64),) * 3
    own = names[2 * width :: width]
    earlier = names[1 : 1 + (units - 2) * width].reshape(units - 2, width)
    # A row for each lag, from the longest to the shortest, bounded by units that do not match.
    match = np.zeros((width, units), dtype=bool)
    np.equal(earlier.T, own, out=match[:, 1:-1])
    turn = np.flatnonzero(match[:, 1:] != match[:, :-1])
    rows, first = np.divmod(turn[::2], units - 1)
    length = turn[1::2] - turn[::2]
    lags = 2 * width - 1 - rows
    needed = np.maximum(2, ((LEAST_TIMES - 1) * lags - width + 1) // width)
    enough = length >= needed
    return lags[enough], first[enough] + 2, (first + length)[enough] + 1


def _followed(
    words: np.ndarray, lag: int, low: int, high: int, width: int
) -> list[tuple[int, int, int]]:
    """The runs of period ``lag`` about a diagonal whose units match from ``low`` to ``high``:
    the words before and after are compared until they differ, within the units next to it."""
    low, high = max(lag, low - 2 * width), min(len(words), high + width)
    same = np.zeros(high - low + 2, dtype=bool)
    np.equal(words[low:high], words[low - lag : high - lag], out=same[1:-1])
    turn = np.flatnonzero(same[1:] != same[:-1]) + low
    least = max(LEAST_WORDS, LEAST_TIMES * lag)
    ends = zip(turn[::2].tolist(), turn[1::2].tolist())
    return [(s - lag, e, lag) for s, e in ends if e - s + lag >= least]


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the ``runs`` by start, then period, and the ``collapsed`` text: the
    words that no run holds after its first period, joined by one space."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            yield _read(batch)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(read, FOUND)


def _read(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = pc.fill_null(batch.column("text"), "")
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    words = split.flatten()
    sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
    sizes[pc.equal(pc.binary_length(pc.ascii_trim_whitespace(texts)), 0).to_numpy(False)] = 0
    words = words.filter(pc.not_equal(words, ""))
    starts = np.cumsum(sizes) - sizes
    numbers = words.dictionary_encode().indices.to_numpy()

    # The texts from the longest, each behind a number that no other place has.
    order = np.argsort(-sizes, kind="stable")
    ends = np.cumsum(sizes[order] + 1)
    places = np.zeros(len(order), dtype=np.int64)
    places[order] = ends - sizes[order]
    line = np.empty(int(ends[-1]), dtype=np.int64)
    line[places - 1] = -1 - np.arange(len(places))
    line[np.repeat(places - starts, sizes) + np.arange(len(numbers))] = numbers
    # At width w only the texts of four times w words are read on.
    widths = 1 << np.arange(1 + int(sizes.max()).bit_length())
    reach = np.append(0, ends)[(sizes[None] >= LEAST_TIMES * widths[:, None]).sum(axis=1)]
    runs = np.array(runs_of(line, reach), dtype=np.int64).reshape(-1, 3)

    row = order[np.searchsorted(ends, runs[:, 0], side="right")]
    runs[:, 0] -= places[row]
    runs, row = (a[np.argsort(row, kind="stable")] for a in (runs, row))
    kept = np.ones(len(numbers), dtype=bool)
    for (start, length, period), at in zip(runs.tolist(), starts[row].tolist()):
        kept[at + start + period : at + start + length] = False
    left = np.append(0, np.cumsum(kept))
    bounds = left[np.append(starts, len(numbers))].astype(np.int32)
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), words.filter(pa.array(kept))), " ")
    fields = pa.StructArray.from_arrays(
        [pa.array(runs[:, i]) for i in range(3)], names=["start", "length", "period"]
    )
    of_row = np.searchsorted(row, np.arange(len(sizes) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(sizes),
            pa.ListArray.from_arrays(pa.array(of_row), fields),
            collapsed,
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def summarise(found: DataFrame) -> DataFrame:
    """The number of runs, the run of greatest exponent, and digests of runs and text."""
    runs = F.col("runs")
    greatest = F.reduce(
        runs,
        F.element_at(runs, 1),
        lambda best, run: F.when(
            run["length"] * best["period"] > best["length"] * run["period"], run
        ).otherwise(best),
    )
    lines = F.transform(
        runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    first = F.when(F.size(runs) > 0, greatest)
    return (
        found.withColumn("_best", first)
        .select(
            "doc_id",
            F.size(runs).cast("long").alias("n_runs"),
            *[F.col(f"_best.{name}").alias(name) for name in ("start", "length", "period")],
            F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
        .withColumn("exponent_milli", F.expr("1000 * length div period"))
    )


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents, by a hash of their id, repeat some of
    their words to the end."""
    code = F.crc32(F.col("doc_id").cast("string"))

    def repeated(words: Column) -> Column:
        n, hashed = F.size(words).cast("long"), F.floor(code / 10)
        at = F.pmod(hashed, n)
        period = 1 + F.floor((n - at) / (3 + F.pmod(hashed, F.lit(8))))
        chosen = F.transform(
            words,
            lambda w, i: F.when(i < at, w).otherwise(
                F.element_at(words, (at + F.pmod(i - at, period) + 1).cast("int"))
            ),
        )
        return F.when(n > 0, F.array_join(chosen, " ")).otherwise(F.lit(""))

    changed = F.coalesce(F.pmod(code, F.lit(10)) == 0, F.lit(False))
    text = F.when(changed, let(words_of(F.col("text")), repeated)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))
