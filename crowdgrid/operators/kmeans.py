"""KMeans over weighted positions, for several k at once, the same on any number of tasks.

Positions are put on a grid of whole numbers about their middle, fine beyond what their
doubles hold, so that the sums of a cluster are exact and do not depend on the order or the
place where they are added. Seeds come from a bounded sample in the order of a hash of the
positions: every position has a priority, its weight over the hash, and the greatest are
taken, first by weight and then by weight times squared distance from a first solution, so
that small far places are met. The driver seeds every k on that sample. The rounds run over
all positions: one job assigns each position in every k that still moves and adds up all
clusters of all of them.

A position may hold any number of visits; it stays one row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import frexp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rounds over all positions at most; a k is done when no centre moves by more than this part
# of half the extent.
ROUNDS = 20
TOLERANCE = 1e-7
# Positions taken by weight, and as many again by distance.
SAMPLE = 1024
# Seedings of each k on the sample, of which the cheapest counts, and rounds on the sample.
SEEDINGS = 4
SAMPLE_ROUNDS = 30
# Binary digits of half the extent on the grid, and of the lower part of a coordinate: sums
# of both parts stay exact up to 2**42 visits.
GRID_BITS = 41
PART_BITS = 21
MOST_VISITS = 1 << 42

SUMS = "k int, cluster int, n long, xh long, xl long, yh long, yl long, near double"
_COLUMNS = [part.split()[0] for part in SUMS.split(", ")]


@dataclass(frozen=True)
class Grid:
    """Whole numbers for coordinates: (value - middle) * scale, rounded."""

    middle: tuple[float, float]
    scale: float

    @staticmethod
    def over(bounds: Sequence[float | None]) -> Grid:
        """For the least of both coordinates and the greatest of both."""
        low, high = bounds[:2], bounds[2:]
        if low[0] is None:
            return Grid((0.0, 0.0), 1.0)
        middle = tuple(a / 2 + b / 2 for a, b in zip(low, high))
        half = max(max(b - m, m - a) for a, b, m in zip(low, high, middle))
        return Grid(middle, 2.0 ** (GRID_BITS - frexp(half)[1]) if half > 0 else 1.0)

    def whole(self, values: np.ndarray, axis: int) -> np.ndarray:
        return np.rint((values - self.middle[axis]) * self.scale)

    def columns(self, names: Sequence[str]) -> list[Column]:
        return [F.rint((F.col(c) - F.lit(m)) * F.lit(self.scale)) for c, m in zip(names, self.middle)]

    def positions(self, centers: np.ndarray) -> list[tuple[float, ...]]:
        return [tuple(float(v / self.scale + m) for v, m in zip(c, self.middle)) for c in centers]


def seeds(
    positions: DataFrame, names: Sequence[str], grid: Grid, ks: Sequence[int], seed: int, sample: int = SAMPLE
) -> dict[int, np.ndarray]:
    """Centres to begin with, for each k, on the grid.

    The sample has ``sample`` positions with the greatest weight over hash, and as many with
    the greatest weight and squared distance over hash. A position stands for its weight, or
    for the least that would have been taken, whichever is more; where all are taken they
    stand for themselves.
    """
    x, y = grid.columns(names)
    rows = positions.select(x.alias("x"), y.alias("y"), F.col("weight").cast("double").alias("w"))
    by_weight = _sample(rows.withColumn("away", F.lit(1.0)), seed, sample)
    if len(by_weight) < sample or not len(by_weight):
        taken = by_weight
    else:
        first = _seed(by_weight, max(ks), np.random.default_rng(seed))
        away = F.least(*[_squared(c) for c in first]) if len(first) > 1 else _squared(first[0])
        by_distance = _sample(rows.withColumn("away", away).filter("away > 0"), seed + 1, sample)
        both = np.vstack([by_weight, by_distance])
        order = np.lexsort((-both[:, 2], both[:, 1], both[:, 0]))
        both = both[order]
        fresh = np.append(True, (both[1:, :2] != both[:-1, :2]).any(axis=1))
        taken = both[fresh]
    return {k: _best_seeds(taken, k, seed) for k in ks}


def _squared(center: np.ndarray) -> Column:
    x, y = (F.col(n) - F.lit(float(v)) for n, v in zip("xy", center))
    return x * x + y * y


def _sample(rows: DataFrame, seed: int, size: int) -> np.ndarray:
    """x, y and the weight a position stands for, of the ``size`` greatest priorities."""
    hashed = F.shiftrightunsigned(F.xxhash64("x", "y", F.lit(seed)), 11)
    uniform = (hashed + F.lit(0.5)) / F.lit(float(1 << 53))
    ranked = rows.withColumn("priority", F.col("w") * F.col("away") / uniform)
    found = ranked.orderBy(F.desc("priority"), "x", "y").limit(size + 1).collect()
    least = found[size]["priority"] if len(found) > size else 0.0
    kept = [(r["x"], r["y"], max(r["w"], least / r["away"])) for r in found[:size]]
    return np.array(sorted(kept), dtype=float).reshape(-1, 3)


def _best_seeds(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """The cheapest of several seedings, each improved by rounds on the sample."""
    best, least = sample[:k, :2], np.inf
    for turn in range(SEEDINGS):
        centers = _seed(sample, k, np.random.default_rng([seed, k, turn]))
        for _ in range(SAMPLE_ROUNDS):
            label = _distances(sample, centers).argmin(axis=1)
            moved = centers.copy()
            for j in np.unique(label):
                mine = sample[label == j]
                moved[j] = np.average(mine[:, :2], axis=0, weights=mine[:, 2])
            if np.array_equal(moved, centers):
                break
            centers = moved
        cost = float((_distances(sample, centers).min(axis=1) * sample[:, 2]).sum())
        if cost < least:
            best, least = centers, cost
    return best


def _seed(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres one after the other, by weight and squared distance from those chosen; of
    several drawn, the one that saves most."""
    weight = sample[:, 2]
    centers = [sample[rng.choice(len(sample), p=weight / weight.sum()), :2]]
    away = _distances(sample, centers[0][None])[:, 0]
    while len(centers) < k and (total := float((weight * away).sum())) > 0:
        drawn = rng.choice(len(sample), size=2 + k.bit_length(), p=weight * away / total)
        left = np.minimum(away[:, None], _distances(sample, sample[drawn, :2]))
        chosen = int((left * weight[:, None]).sum(axis=0).argmin())
        centers.append(sample[drawn[chosen], :2])
        away = left[:, chosen]
    return np.array(centers)


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (points[:, 0:1] - centers[:, 0]) ** 2 + (points[:, 1:2] - centers[:, 1]) ** 2


def _read(batch: pa.RecordBatch, names: Sequence[str], grid: Grid) -> tuple[np.ndarray, np.ndarray]:
    """Points on the grid and their weights."""
    points = np.column_stack(
        [grid.whole(batch.column(c).to_numpy(zero_copy_only=False), i) for i, c in enumerate(names)]
    )
    return points, batch.column("weight").to_numpy(zero_copy_only=False)


def cluster_sums(
    positions: DataFrame, names: Sequence[str], grid: Grid, centers: dict[int, np.ndarray]
) -> dict[int, list]:
    """For each k its clusters that have visits: number, visits, exact sums of both
    coordinates on the grid, and the sum of squared distances from the centre."""
    names = list(names)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            points, weight = _read(batch, names, grid)
            whole, w = points.astype(np.int64), weight.astype(np.int64)
            low = whole & ((1 << PART_BITS) - 1)
            columns = np.column_stack([w, *(w * c for p in zip((whole >> PART_BITS).T, low.T) for c in p)])
            for k, c in centers.items():
                away = _distances(points, c)
                label = away.argmin(axis=1)
                near = away[np.arange(len(label)), label] * weight
                order = np.argsort(label, kind="stable")
                found, first = np.unique(label[order], return_index=True)
                sums = np.add.reduceat(columns[order], first)
                nears = np.add.reduceat(near[order], first)
                for j, s, d in zip(found.tolist(), sums.tolist(), nears.tolist()):
                    old = totals.get((k, j), [0, 0, 0, 0, 0, 0.0])
                    totals[k, j] = [a + b for a, b in zip(old, [*s, d])]
        if totals:
            rows = [(*key, *value) for key, value in totals.items()]
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=_COLUMNS
            )

    parts = positions.select(*names, "weight").mapInArrow(partial, SUMS)
    added = parts.groupBy("k", "cluster").agg(*[F.sum(c).alias(c) for c in _COLUMNS[2:]])
    out: dict[int, list] = {k: [] for k in centers}
    for r in added.collect():
        x, y = ((r[f"{a}h"] << PART_BITS) + r[f"{a}l"] for a in "xy")
        out[r["k"]].append((r["cluster"], r["n"], x, y, r["near"]))
    return {k: sorted(found) for k, found in out.items()}


def rounds(
    positions: DataFrame,
    names: Sequence[str],
    grid: Grid,
    centers: dict[int, np.ndarray],
    most: int = ROUNDS,
    tolerance: float = TOLERANCE,
) -> tuple[dict[int, np.ndarray], dict[int, list]]:
    """Move all centres to the means of their visits until they rest; the last centres of
    each k and the sums about them. A centre without visits stays where it is."""
    centers = {k: np.array(c, dtype=float) for k, c in centers.items()}
    still, sums = dict(centers), {}
    for turn in range(most + 1):
        found = cluster_sums(positions, names, grid, still)
        sums.update(found)
        if turn == most:
            break
        for k, clusters in found.items():
            moved = centers[k].copy()
            for j, n, x, y, _ in clusters:
                moved[j] = x / n, y / n
            if np.abs(moved - centers[k]).max() <= tolerance * 2.0**GRID_BITS:
                del still[k]
            else:
                centers[k] = still[k] = moved
        if not still:
            break
    return centers, sums


def silhouettes(
    positions: DataFrame,
    names: Sequence[str],
    grid: Grid,
    centers: dict[int, np.ndarray],
    sums: dict[int, list],
) -> dict[int, float | None]:
    """The mean silhouette of every k in one pass; None for fewer than two clusters.

    The mean squared distance to the visits of a cluster is that to their mean plus their
    mean squared distance from it, which loses no digits to far tight clusters.
    """
    names = list(names)
    shapes = {}
    for k, clusters in sums.items():
        if len(clusters) < 2:
            continue
        size = np.array([c[1] for c in clusters], dtype=float)
        mean = np.array([(x / n, y / n) for _, n, x, y, _ in clusters])
        used = centers[k][[c[0] for c in clusters]]
        near = np.array([c[4] for c in clusters]) / size
        spread = np.maximum(near - ((mean - used) ** 2).sum(axis=1), 0.0)
        shapes[k] = used, mean, spread, size
    if not shapes:
        return dict.fromkeys(sums)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = dict.fromkeys(shapes, 0.0)
        for batch in batches:
            if not batch.num_rows:
                continue
            points, weight = _read(batch, names, grid)
            rows = np.arange(len(points))
            for k, (used, mean, spread, size) in shapes.items():
                own = _distances(points, used).argmin(axis=1)
                away = _distances(points, mean) + spread
                n = size[own]
                a = away[rows, own] * n / np.maximum(n - 1, 1)
                away[rows, own] = np.inf
                b = away.min(axis=1)
                most = np.maximum(a, b)
                value = np.where((n > 1) & (most > 0), (b - a) / np.where(most > 0, most, 1), 0.0)
                totals[k] += float((value * weight).sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array(list(totals.values()), pa.float64())],
            names=["k", "total"],
        )

    parts = positions.select(*names, "weight").mapInArrow(partial, "k int, total double")
    totals = {r["k"]: r["total"] for r in parts.groupBy("k").agg(F.sum("total").alias("total")).collect()}
    return {k: totals[k] / float(shapes[k][3].sum()) if k in shapes else None for k in sums}


def costs(grid: Grid, sums: dict[int, list]) -> dict[int, float]:
    """The sum of squared distances of all visits from their centres, for every k."""
    return {k: sum(c[4] for c in found) / grid.scale**2 for k, found in sums.items()}
