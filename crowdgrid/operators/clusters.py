"""KMeans on positions: assembling, fitting, scoring and choosing k.

Visits that share a position are fitted as one weighted point. The cost and the
silhouette are the same as over single visits, a crowded spot becomes one row, and
the repeated passes of KMeans run over positions instead of visits. All k of a sweep
are fitted and scored in the same passes (see ``kmeans``), and the result does not
depend on how the positions are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from math import isfinite

from pyspark import StorageLevel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdgrid.operators import kmeans

POSITION = ["lat_visit", "lon_visit"]
SEED = 42
MAX_K = 10
METHODS = ("silhouette_max", "argmin_silhouette", "elbow")


def known(points: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows that have a number in every column."""
    return points.filter(
        reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in columns])
    )


def _bounds(columns: Sequence[str]) -> list[Column]:
    return [f(c).cast("double") for f in (F.min, F.max) for c in columns]


def _halfway(bounds: Sequence[float | None]) -> tuple[float, ...]:
    half = len(bounds) // 2
    return tuple((a + b) / 2 if a is not None else 0.0 for a, b in zip(bounds[:half], bounds[half:]))


def middle(points: DataFrame, columns: Sequence[str] = POSITION) -> tuple[float, ...]:
    """Halfway between the bounds of each column; squares around it lose no digits."""
    return _halfway(list(known(points, columns).agg(*_bounds(columns)).first()))


def assemble(
    visits: DataFrame, columns: Sequence[str] = POSITION, shift: Sequence[float] | None = None
) -> DataFrame:
    """Add the ``features`` vector, less ``shift``.

    Cleaning has already removed NULL and NaN.
    """
    if shift is None:
        return VectorAssembler(inputCols=list(columns), outputCol="features").transform(visits)
    names = {f"_centred{i}": F.col(c) - F.lit(m) for i, (c, m) in enumerate(zip(columns, shift))}
    centred = visits.withColumns(names)
    wide = VectorAssembler(inputCols=list(names), outputCol="features").transform(centred)
    return wide.drop(*names)


@dataclass(frozen=True)
class Positions:
    """Distinct positions with the number of their visits as ``weight``, and their extent."""

    rows: DataFrame
    grid: kmeans.Grid
    distinct: int
    visits: int


@contextmanager
def held_positions(visits: DataFrame) -> Iterator[Positions]:
    """The weighted positions of all visits, persisted once for the passes of a fit."""
    counted = known(visits, POSITION).groupBy(*POSITION)
    held = counted.agg(F.count(F.lit(1)).cast("double").alias("weight"))
    held = held.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        distinct, total, *bounds = held.agg(
            F.count(F.lit(1)), F.sum("weight"), *_bounds(POSITION)
        ).first()
        if (total or 0) > kmeans.MOST_VISITS:
            raise ValueError(f"more than {kmeans.MOST_VISITS} visits in one fit")
        yield Positions(held, kmeans.Grid.over(bounds), distinct, int(total or 0))
    finally:
        held.unpersist()


@dataclass(frozen=True)
class PositionModel:
    """Centres of positions and the cost of the visits they were fitted on."""

    centers: tuple[tuple[float, ...], ...]
    cost: float

    def transform(self, visits: DataFrame, columns: Sequence[str] = POSITION) -> DataFrame:
        return assign_fixed(visits, self.centers, columns)

    def save(self, path: str) -> None:
        row = (self.cost, [list(c) for c in self.centers])
        spark = SparkSession.active()
        frame = spark.createDataFrame([row], "cost double, centers array<array<double>>")
        frame.coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(path: str) -> PositionModel:
        row = SparkSession.active().read.parquet(path).first()
        return PositionModel(tuple(tuple(c) for c in row["centers"]), row["cost"])


def fit(points: Positions, k: int, seed: int = SEED) -> PositionModel:
    """Fit k centres, or as many as positions differ."""
    return _fitted(points, [k], seed)[0][k]


def _fitted(
    points: Positions, ks: Sequence[int], seed: int
) -> tuple[dict[int, PositionModel], dict, dict]:
    """The model of every k, with its centres on the grid and the sums about them."""
    if not points.distinct:
        raise ValueError("there is no position to fit")
    begin = kmeans.seeds(points.rows, POSITION, points.grid, ks, seed)
    centers, sums = kmeans.rounds(points.rows, POSITION, points.grid, begin)
    cost = kmeans.costs(points.grid, sums)
    models = {
        k: PositionModel(tuple(points.grid.positions(c)), cost[k]) for k, c in centers.items()
    }
    return models, centers, sums


def assign(
    model: PositionModel, visits: DataFrame, columns: Sequence[str] = POSITION
) -> DataFrame:
    """Add ``cluster_pred``, the 0-based number of the nearest centre; works on streams too."""
    return model.transform(visits, columns)


def score(predictions: DataFrame) -> float:
    """Silhouette with squared Euclidean distance, from the library evaluator.

    The features should be centred, or tight clusters far from the origin lose their digits.
    """
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster_pred")
    if "weight" in predictions.columns:
        evaluator = evaluator.setWeightCol("weight")
    return evaluator.evaluate(predictions)


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def sweep(
    points: Positions, max_k: int = MAX_K, seed: int = SEED, silhouette: bool = True
) -> list[dict]:
    """Fit k = 2..max_k; k, model, cost and silhouette of each.

    All k share their passes: those that still move are assigned and added up in one job a
    round, and one more job scores them all. A score that is not finite counts as none, and
    a fit with a single cluster has none.
    """
    models, centers, sums = _fitted(points, range(2, max_k + 1), seed)
    scores: dict[int, float | None] = {}
    if silhouette:
        scores = kmeans.silhouettes(points.rows, POSITION, points.grid, centers, sums)
    found = []
    for k, model in models.items():
        value = scores.get(k)
        value = value if value is not None and isfinite(value) else None
        found.append({"k": k, "model": model, "cost": model.cost, "silhouette": value})
    return found


def pick(scores: list[dict], method: str = "silhouette_max") -> int:
    """Choose k from a sweep; the smallest k wins a tie.

    ``silhouette_max`` takes the best separation, ``argmin_silhouette`` the lowest
    value of the same score, ``elbow`` the point of the cost curve furthest below
    the straight line between its ends.
    """
    _check(method)
    if method == "elbow":
        return _elbow([(s["k"], s["cost"]) for s in scores])
    scored = [(s["silhouette"], s["k"]) for s in scores if s["silhouette"] is not None]
    if not scored:
        return scores[0]["k"]
    if method == "argmin_silhouette":
        return min(scored)[1]
    return max(scored, key=lambda s: (s[0], -s[1]))[1]


def _check(method: str) -> None:
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")


def _elbow(curve: list[tuple[int, float]]) -> int:
    (k0, c0), (k1, c1) = curve[0], curve[-1]
    if k0 == k1 or c0 <= c1:
        return k0

    def gap(point: tuple[int, float]) -> float:
        along = (point[0] - k0) / (k1 - k0)
        down = (c0 - point[1]) / (c0 - c1)
        return down - along

    return max(curve, key=lambda p: (gap(p), -p[0]))[0]


def fit_best(
    visits: DataFrame, max_k: int = MAX_K, method: str = "silhouette_max", seed: int = SEED
) -> PositionModel | None:
    """The model of the k that a sweep chooses; None where fewer than two positions differ.

    The sweep never goes beyond the number of distinct positions, where further
    centres could only repeat.
    """
    _check(method)
    with held_positions(visits) as points:
        limit = min(max_k, points.distinct)
        if limit < 2:
            return None
        scores = sweep(points, limit, seed, method != "elbow")
        chosen = pick(scores, method)
        return next(s["model"] for s in scores if s["k"] == chosen)


def select_k(
    visits: DataFrame, max_k: int = MAX_K, method: str = "silhouette_max", seed: int = SEED
) -> int:
    """Choose k; fewer than two visits is an error, identical visits give 1."""
    _check(method)
    with held_positions(visits) as points:
        if points.visits < 2:
            raise ValueError("at least two visits are needed to choose k")
        if points.distinct < 2:
            return 1
        return pick(sweep(points, min(max_k, points.distinct), seed, method != "elbow"), method)


def cluster(visits: DataFrame, **choice) -> DataFrame:
    """Add ``cluster_pred`` to a table of any size, also a degenerate one.

    A single visit keeps a NULL cluster; identical visits are all cluster 0.
    """
    model = fit_best(visits, **choice)
    if model is not None:
        return assign(model, visits)
    alone = visits.limit(2).count() < 2
    return visits.withColumn("cluster_pred", F.lit(None if alone else 0).cast("int"))


def assign_fixed(
    points: DataFrame,
    centers: Sequence[Sequence[float]],
    columns: Sequence[str] = POSITION,
    name: str = "cluster_pred",
) -> DataFrame:
    """Nearest of the given centres by squared distance, smallest number on a tie.

    The centres come with the call, as the centres of a model do, and are folded
    into the expression: no join and no shuffle.
    """
    if not centers:
        raise ValueError("at least one centre is needed")
    away = {f"_d{i}": _squared_distance(columns, center) for i, center in enumerate(centers)}
    measured = points.withColumns(away)
    nearest = F.least(*away) if len(away) > 1 else F.col("_d0")
    measured = measured.withColumn("_near", nearest)
    label = F.coalesce(*[F.when(F.col(d) == F.col("_near"), F.lit(i)) for i, d in enumerate(away)])
    return measured.withColumn(name, label).drop("_near", *away)


def _squared_distance(columns: Sequence[str], center: Sequence[float]) -> Column:
    if len(columns) != len(center):
        raise ValueError("a centre needs one number per column")
    parts = [F.col(c) - F.lit(float(v)) for c, v in zip(columns, center)]
    return reduce(lambda a, b: a + b, [p * p for p in parts])
