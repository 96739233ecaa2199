"""Silhouette from per-cluster sums, as DataFrame aggregates.

For a cluster with N points, sum of squared norms P and vector sum Y, the mean
squared distance from x to its points is ``|x|^2 + P/N - 2 * (x . Y) / N``, so two
passes over the points are enough and no pair of points is ever formed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window
from pyspark.sql import functions as F

from crowdgrid.operators.clusters import known, middle
from crowdgrid.session import materialise

# Up to this many products per point the scoring stays in generated code; beyond it,
# batches of points are multiplied with the cluster sums through Arrow.
GENERATED_TERMS = 64
# Most clusters scored in one pass; more clusters take more passes.
CLUSTERS_PER_PASS = 1000


def cluster_sums(
    points: DataFrame, cluster: str | list[str], columns: Sequence[str]
) -> DataFrame:
    """Per cluster: size, sum of squared norms, and the sum of each column."""
    return points.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(_dot([(F.col(c), F.col(c)) for c in columns])).alias("psi"),
        *[F.sum(c).alias(f"y{i}") for i, c in enumerate(columns)],
    )


def silhouette(
    points: DataFrame,
    cluster: str,
    columns: Sequence[str],
    clusters_per_pass: int = CLUSTERS_PER_PASS,
    generated_terms: int = GENERATED_TERMS,
) -> DataFrame:
    """One row with the mean ``silhouette``; points without a cluster, or without a number
    in each column, are left out.

    The points are taken around the middle of their bounds, which changes no distance and
    keeps the digits of tight clusters far from the origin.

    The sums of at most ``clusters_per_pass`` clusters are sent to the tasks at a
    time. When there are more clusters, the distances met so far are written out and
    the next group of clusters goes on from them.
    """
    columns = list(columns)
    usable = known(points.filter(F.col(cluster).isNotNull()), columns)
    shift = middle(usable, columns)
    usable = usable.select(
        F.col(cluster).alias("own"),
        *[(F.col(c).cast("double") - F.lit(m)).alias(c) for c, m in zip(columns, shift)],
    )
    sums = cluster_sums(usable, "own", columns)
    first = sums.limit(clusters_per_pass + 1).collect()

    scored = usable.withColumns(
        {
            "_a": F.lit(None).cast("double"),
            "_b": F.lit(None).cast("double"),
            "_n": F.lit(None).cast("bigint"),
        }
    )
    if len(first) <= clusters_per_pass:
        scored = _measure(scored, first, columns, generated_terms)
    else:
        stored = materialise(sums)
        groups = -(-2 * stored.count() // clusters_per_pass)
        for g in range(groups):
            mine = stored.filter(F.pmod(F.xxhash64("own"), F.lit(groups)) == g).collect()
            if mine:
                scored = materialise(_measure(scored, mine, columns, generated_terms))

    return scored.agg(F.avg(_value()).alias("silhouette"))


def silhouettes(
    points: DataFrame,
    clusters: Sequence[str],
    columns: Sequence[str],
    clusters_per_pass: int = CLUSTERS_PER_PASS,
    generated_terms: int = GENERATED_TERMS,
) -> DataFrame:
    """One row with the mean silhouette of every labelling, under the name of its column.

    The labellings share three jobs, whatever their number: the bounds, the sums of all
    clusters of all labellings, and the scores. A labelling with more clusters than one pass
    takes is scored by ``silhouette`` after them. Labels are compared as their text.
    """
    columns = list(columns)
    usable = known(points, columns)
    shift = middle(usable, columns)
    labels = {name: f"_label{i}" for i, name in enumerate(clusters)}
    usable = usable.select(
        *[F.col(name).cast("string").alias(own) for name, own in labels.items()],
        *[(F.col(c).cast("double") - F.lit(m)).alias(c) for c, m in zip(columns, shift)],
    )
    each = F.array(*[F.struct(F.lit(name).alias("by"), F.col(own).alias("own")) for name, own in labels.items()])
    told = usable.select(*columns, F.inline(each)).filter("own IS NOT NULL")
    sums = cluster_sums(told, ["by", "own"], columns)
    most = F.count(F.lit(1)).over(Window.partitionBy("by"))
    found: dict[str, list[Row]] = {name: [] for name in labels}
    for row in sums.withColumn("_most", most).filter(F.col("_most") <= clusters_per_pass).collect():
        found[row["by"]].append(row)
    scored, values = usable, {}
    for name, own in labels.items():
        if found[name]:
            ready = scored.withColumns(
                {
                    "own": F.col(own),
                    "_a": F.lit(None).cast("double"),
                    "_b": F.lit(None).cast("double"),
                    "_n": F.lit(None).cast("bigint"),
                }
            )
            value = F.when(F.col("own").isNotNull(), _value())
            measured = _measure(ready, found[name], columns, generated_terms)
            scored = measured.withColumn(f"_score{own}", value).drop("own", "_a", "_b", "_n")
            values[name] = F.avg(f"_score{own}")
    apart = {
        name: silhouette(points, name, columns, clusters_per_pass, generated_terms).first()[0]
        for name in labels
        if not found[name]
    }
    values |= {name: F.lit(value).cast("double") for name, value in apart.items()}
    return scored.agg(F.count(F.lit(1)).alias("_rows"), *[values[n].alias(n) for n in labels]).drop("_rows")


def _value() -> Column:
    """The score of a point from its own and its least other mean distance."""
    a = F.col("_a") * F.col("_n") / (F.col("_n") - 1)
    value = F.when(F.col("_n") == 1, F.lit(0.0)).otherwise(
        F.try_divide(F.col("_b") - a, F.greatest(a, F.col("_b")))
    )
    return F.coalesce(value, F.lit(0.0))


def _measure(
    scored: DataFrame, sums: list[Row], columns: list[str], generated_terms: int
) -> DataFrame:
    """Fold one group of clusters into the own distance and the least other distance."""
    if not sums:
        return scored
    generated = len(sums) * len(columns) <= generated_terms
    found = (_in_generated_code if generated else _in_arrow_batches)(scored, sums, columns)
    return found.withColumns(
        {
            "_a": F.coalesce("_a", "_own_d"),
            "_b": F.least("_b", "_other_d"),
            "_n": F.coalesce("_n", "_own_n"),
        }
    ).drop("_own_d", "_other_d", "_own_n")


def _in_generated_code(scored: DataFrame, sums: list[Row], columns: list[str]) -> DataFrame:
    norm = scored.withColumn("_norm", _dot([(F.col(c), F.col(c)) for c in columns]))
    away = {f"_c{i}": _mean_distance(s, columns) for i, s in enumerate(sums)}
    own = [F.col("own") == F.lit(s["own"]) for s in sums]
    never = F.lit(None).cast("double")
    return (
        norm.withColumns(away)
        .withColumns(
            {
                "_own_d": F.coalesce(*[F.when(o, F.col(d)) for o, d in zip(own, away)]),
                "_other_d": F.least(never, *[F.when(~o, F.col(d)) for o, d in zip(own, away)]),
                "_own_n": F.coalesce(*[F.when(o, F.lit(s["n"])) for o, s in zip(own, sums)]),
            }
        )
        .drop("_norm", *away)
    )


def _in_arrow_batches(scored: DataFrame, sums: list[Row], columns: list[str]) -> DataFrame:
    labels = [s["own"] for s in sums]
    sizes = np.array([s["n"] for s in sums], dtype="float64")
    psi = np.array([s["psi"] for s in sums]) / sizes
    means = np.array([[s[f"y{i}"] for i in range(len(columns))] for s in sums]) / sizes[:, None]

    @F.arrow_udf("own_d double, other_d double, own_n bigint")
    def measure(own: pa.Array, features: pa.Array) -> pa.Array:
        x = features.flatten().to_numpy(zero_copy_only=False).reshape(len(own), len(columns))
        norm = np.einsum("ij,ij->i", x, x)
        away = norm[:, None] + psi - 2.0 * (x @ means.T)
        at = pc.index_in(own, value_set=pa.array(labels, type=own.type))
        here = at.is_valid().to_numpy(zero_copy_only=False)
        rows, at = np.flatnonzero(here), at.drop_null().to_numpy()
        own_d = np.full(len(own), np.nan)
        own_d[rows] = away[rows, at]
        own_n = np.zeros(len(own), dtype="int64")
        own_n[rows] = sizes[at]
        away[rows, at] = np.inf
        other = away.min(axis=1)
        return pa.StructArray.from_arrays(
            [
                pa.array(own_d, mask=~here),
                pa.array(other, mask=np.isinf(other)),
                pa.array(own_n, mask=~here),
            ],
            names=["own_d", "other_d", "own_n"],
        )

    found = scored.withColumn("_found", measure(F.col("own"), F.array(*columns)))
    names = ["own_d", "other_d", "own_n"]
    return found.select(*scored.columns, *[F.col(f"_found.{n}").alias(f"_{n}") for n in names])


def _mean_distance(s: Row, columns: list[str]) -> Column:
    n = float(s["n"])
    dot = _dot([(F.col(c), F.lit(s[f"y{i}"] / n)) for i, c in enumerate(columns)])
    return F.col("_norm") + F.lit(s["psi"] / n) - F.lit(2.0) * dot


def _dot(pairs: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a + b, [x * y for x, y in pairs])
