"""Cell counts, their spread over days, and the two crowding flags."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdgrid.functions.hexgrid import with_cell
from crowdgrid.functions.visits import visit_time

DEFAULT_RESOLUTION = 10
DEFAULT_SIGMA = 2
RED_WAVE_THRESHOLD = 1500

# Adds a ``cell`` column at a resolution.
Place = Callable[[DataFrame, int], DataFrame]


def with_calendar(visits: DataFrame) -> DataFrame:
    """Add the ``date`` and ``hour`` that ``date_visit`` falls into.

    A table partitioned by ``visit_date`` already knows the date, and the hour is
    then two characters of the text; otherwise the text is parsed once.
    """
    if "visit_date" in visits.columns:
        hour = F.substring("date_visit", 12, 2).try_cast("int")
        return visits.withColumns({"date": F.col("visit_date"), "hour": hour})
    return (
        visits.withColumn("_at", visit_time(F.col("date_visit")))
        .withColumns({"date": F.to_date("_at"), "hour": F.hour("_at")})
        .drop("_at")
    )


def timed(visits: DataFrame) -> DataFrame:
    """Visits that have a time, with their ``date`` and ``hour``.

    Without a partition date the parsed time goes through a generator: the filter on
    it stays above, and neither the parse nor what ``date_visit`` is made from runs twice.
    """
    if "visit_date" in visits.columns:
        return with_calendar(visits.filter(F.col("visit_date").isNotNull()))
    parsed = F.array(F.struct(visit_time(F.col("date_visit")).alias("_at")))
    return (
        visits.select("*", F.inline(parsed))
        .filter(F.col("_at").isNotNull())
        .withColumns({"date": F.to_date("_at"), "hour": F.hour("_at")})
        .drop("_at")
    )


def date_range(visits: DataFrame, start: str, end: str) -> DataFrame:
    """Visits from the first second of ``start`` to the last second of ``end``.

    The column stays bare: a date range prunes the partitions of the stored table,
    and elsewhere a half-open text range reaches the Parquet statistics.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    if "visit_date" in visits.columns:
        return visits.filter(F.col("visit_date").between(first, last))
    text = F.col("date_visit")
    return visits.filter(
        (text >= first.cast("string")) & (text < F.date_add(last, 1).cast("string"))
    )


def cell_counts(
    visits: DataFrame, resolution: int = DEFAULT_RESOLUTION, place: Place = with_cell
) -> DataFrame:
    """Pings per (cell, hour, date); rows without a position or a time count nowhere.

    The key is 16 bytes of fixed width and every task sends each key at most once,
    so a crowded cell costs the shuffle no more than a quiet one. NULLs are removed
    from the inputs: a filter on the cell would be pushed below it and compute it twice.
    ``place`` adds the ``cell`` column and may be another grid.
    """
    placed = visits.filter(F.col("lat_visit").isNotNull() & F.col("lon_visit").isNotNull())
    return (
        timed(place(placed, resolution))
        .groupBy("cell", "hour", "date")
        .agg(F.count(F.lit(1)).alias("pings"))
    )


def hour_stats(counts: DataFrame) -> DataFrame:
    """Mean and sample deviation of the daily counts, per (cell, hour)."""
    return counts.groupBy("cell", "hour").agg(
        F.avg("pings").alias("mean"), F.stddev_samp("pings").alias("std")
    )


def join_stats(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """Counts with the statistics of their (cell, hour), from a separate table."""
    return counts.join(stats, ["cell", "hour"], "left")


def with_flags(
    counts: DataFrame,
    sigma: int | float | str = DEFAULT_SIGMA,
    threshold: int = RED_WAVE_THRESHOLD,
) -> DataFrame:
    """Add mean, std, alert and red_wave to daily counts in one window, with no join.

    A window partition holds one row per observed date of a (cell, hour). Everything
    follows from three whole numbers: n days, sum S and sum of squares Q. The alert
    ``p > S/n + sigma * std`` is tested without division or root, so ties are exact:
    ``n*p > S and (n*p - S)^2 * (n - 1) > sigma^2 * n * (n*Q - S^2)``, with sigma^2 as a
    ratio of whole numbers. One day alone gives 0 > 0, hence False, and has no std.
    """
    ratio = Fraction(str(sigma)) ** 2
    exact = max(ratio.numerator, ratio.denominator) < 10**38
    if float(sigma) < 0:
        raise ValueError("sigma must not be negative")
    days = Window.partitionBy("cell", "hour")
    pings, wide = F.col("pings").cast("decimal(19,0)"), "decimal(38,0)"
    summed = counts.withColumns(
        {
            "_n": F.count(F.lit(1)).over(days),
            "_s": F.sum("pings").over(days),
            "_q": F.sum(pings * pings).over(days),
        }
    )
    n, total = F.col("_n").cast("decimal(10,0)"), F.col("_s").cast("decimal(19,0)")
    measured = summed.withColumns(
        {
            "_excess": (n * pings - total).cast(wide),
            "_moment": (n * F.col("_q") - total * total).cast(wide),
        }
    )
    excess, moment = F.col("_excess"), F.col("_moment")
    # Doubles decide where the sides differ by more than their rounding; whole numbers where
    # they do not, unless a product leaves their range.
    e, m, days_ = excess.cast("double"), moment.cast("double"), F.col("_n").cast("double")
    left, right = e * e * (days_ - 1), days_ * m * F.lit(float(sigma)) * F.lit(float(sigma))
    near = F.abs(left - right) <= F.lit(1e-9) * F.greatest(left, right)
    over = left > right
    if exact:
        whole = F.try_multiply(F.try_multiply(excess, excess), (n - F.lit(1)).cast(wide))
        whole = F.try_multiply(whole, F.lit(Decimal(ratio.denominator)).cast(wide))
        other = F.try_multiply(F.try_multiply(n.cast(wide), moment), F.lit(Decimal(ratio.numerator)).cast(wide))
        over = F.when(near, F.coalesce(whole > other, over)).otherwise(over)
    pairs = F.col("_n").cast("double") * (F.col("_n") - 1)
    return measured.select(
        *counts.columns,
        (F.col("_s").cast("double") / F.col("_n")).alias("mean"),
        F.when(F.col("_n") > 1, F.sqrt(moment.cast("double") / pairs)).alias("std"),
        ((excess > 0) & over).alias("alert"),
        red_wave(F.col("pings"), threshold).alias("red_wave"),
    )


def red_wave(pings: Column, threshold: int = RED_WAVE_THRESHOLD) -> Column:
    return pings > F.lit(threshold)


def hotspots(
    visits: DataFrame,
    resolution: int = DEFAULT_RESOLUTION,
    sigma: int | float | str = DEFAULT_SIGMA,
    threshold: int = RED_WAVE_THRESHOLD,
    place: Place = with_cell,
) -> DataFrame:
    """The full report: cell, hour, date, pings, mean, std, alert, red_wave."""
    return with_flags(cell_counts(visits, resolution, place), sigma, threshold)
