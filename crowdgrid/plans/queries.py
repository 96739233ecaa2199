"""Registered queries: each runs an operator over the whole of a supplied table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crowdgrid.functions import globe
from crowdgrid.functions.hexgrid import cell_text, with_cell, with_center
from crowdgrid.functions.visits import (
    epoch_to_text,
    heat_popup,
    mask_device_id,
    marker_color,
    number,
    valid_position,
)
from crowdgrid.operators import clusters, hotspots, journeys, markers, totals
from crowdgrid.operators.clean import visits_from_messages
from crowdgrid.operators.silhouette import silhouette, silhouettes
from crowdgrid.schema import CLUSTERED_COLUMNS, VISIT_COLUMNS
from crowdgrid.session import pin, scratch
from crowdgrid.sources import messages as msg
from crowdgrid.sources import tables
from crowdgrid.sources.connectors import ConnectorSink
from crowdgrid.sources.kept import KEPT
from crowdgrid.sources.testtables import (
    event_labellings,
    event_messages,
    event_pings,
    event_visits,
    read_table,
    stream_in_parts,
    stream_table,
)
from crowdgrid.streaming.ingest import ClusterBatch, run_batches, save_model, score_stream
from crowdgrid.streaming.live import live_counts, store_counts, watch_counts

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the oracle SQL.
START, END = "2024-01-05", "2024-01-12"
DEVICE = "+447000000042"
DEVICE_HASH = hashlib.sha256(DEVICE.encode()).hexdigest()
SUBSTITUTION = ("0123456789", "7415920386")
THRESHOLD = 1
COARSE = 8
POINTS_PER_ROW = 50
CENTERS = [(53.5437, -2.4377), (53.5521, -2.4371), (53.5466, -2.4302), (53.5583, -2.4291)]
LATENESS = "1 hour"
GROUPS = 5
BATCHES = 4
SPLIT = "2024-01-15 00:00:00"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(pin(spark), sf_dir, "events")


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_visits(_events(spark, sf_dir))


def _stream_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits_from_messages(event_messages(stream_table(pin(spark), sf_dir, "events")))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots.cell_counts(_visits(spark, sf_dir))


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots.hotspots(_visits(spark, sf_dir), threshold=THRESHOLD)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Sources, sinks, codecs


def publish_and_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages published to text files, streamed back, cleaned, appended and read."""
    inbox, out, state = (scratch(spark, n) for n in ("inbox", "visits", "checkpoint"))
    msg.publish(event_pings(_events(spark, sf_dir)), "text", inbox)
    stream = visits_from_messages(msg.read_messages(spark, "text", path=inbox))
    run_batches(stream, lambda df, _: tables.append(df, out), state, once=True).awaitTermination()
    return spark.read.parquet(out).select(*VISIT_COLUMNS)


def decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = msg.decode(event_messages(_events(spark, sf_dir)))
    return decoded.select(
        "device_id",
        "timezone_visit",
        "day_of_week_visit",
        number(F.col("time_stamp")).alias("time_stamp"),
        number(F.col("lat_visit")).alias("lat_visit"),
        F.coalesce("date_visit", F.lit("absent")).alias("date_visit"),
        "time_visit",
        number(F.col("lon_visit")).alias("lon_visit"),
    )


def malformed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prose sent as messages: every one decodes to NULLs and none has a position."""
    prose = read_table(pin(spark), sf_dir, "documents").select(F.col("text").alias("value"))
    decoded = msg.decode(prose)
    usable = valid_position(number(F.col("lat_visit")), number(F.col("lon_visit")))
    return decoded.agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(usable).alias("visits")
    )


def append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "append")
    tables.append(_visits(spark, sf_dir), out)
    return spark.read.parquet(out).select(*CLUSTERED_COLUMNS, "visit_date")


def micro_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch written twice, as after a lost commit; the table holds it once."""
    out, state = scratch(spark, "batches"), scratch(spark, "checkpoint")

    def twice(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(batch, batch_id, out)
        tables.write_batch(batch, batch_id, out)

    run_batches(_stream_visits(spark, sf_dir), twice, state, once=True).awaitTermination()
    return tables.read_visits(spark, out).select(*VISIT_COLUMNS, "visit_date")


def compacted_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several batches, compacted twice with replays between; every visit is there once."""
    out, state = scratch(spark, "compacted"), scratch(spark, "checkpoint")

    def keep(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(batch, batch_id, out)
        if batch_id == BATCHES - 2:
            tables.compact(spark, out)
            tables.write_batch(batch, 0, out)
        tables.write_batch(batch, batch_id, out)

    parts = stream_in_parts(spark, _events(spark, sf_dir), scratch(spark, "parts"), BATCHES)
    visits = visits_from_messages(event_messages(parts))
    run_batches(visits, keep, state, once=True).awaitTermination()
    tables.compact(spark, out, full=True)
    tables.tidy(spark, out)
    return tables.read_visits(spark, out).select(*VISIT_COLUMNS, "visit_date")


def connector_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits appended through a connector and read back with the same options."""
    through = {"fmt": "json", "options": {"path": scratch(spark, "connector")}}
    tables.append(_visits(spark, sf_dir), **through)
    return tables.read_visits(spark, **through).select(*CLUSTERED_COLUMNS, "visit_date")


def connector_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches through two connectors: one is appended in part before it is written, as after
    a crash, and all are written twice. Every visit is there once in each."""
    events, shown = _events(spark, sf_dir), []
    for fmt, more in (("json", {}), ("csv", {"header": "true"})):
        options = {"path": scratch(spark, fmt), **more}
        sink = ConnectorSink(fmt, scratch(spark, "commits"), options)

        def keep(batch: DataFrame, batch_id: int, sink: ConnectorSink = sink) -> None:
            if batch_id == 1:
                staged = sink.stage(batch, batch_id)
                sink.begin(spark, batch_id)
                some = staged.filter(F.pmod(F.xxhash64("date_visit"), F.lit(3)) == 0)
                tables.append(some, None, sink.fmt, sink.options)
            sink.write(batch, batch_id)
            sink.write(batch, batch_id)

        parts = stream_in_parts(spark, events, scratch(spark, "parts"), BATCHES)
        visits = visits_from_messages(event_messages(parts))
        run_batches(visits, keep, scratch(spark, "checkpoint"), once=True).awaitTermination()
        back = tables.read_visits(spark, fmt=fmt, options=options)
        batches = back.select(F.countDistinct("batch_id").alias("batches"))
        back = back.select(F.lit(fmt).alias("connector"), *VISIT_COLUMNS, "visit_date")
        shown.append(back.join(F.broadcast(batches)))
    return shown[0].unionByName(shown[1])


def _kept_table(spark: SparkSession, sf_dir: str) -> str:
    """A table of several batches with its kept tables: batches written in no order, some
    twice, the second time with other rows first, and compacted between."""
    out, keep = scratch(spark, "kept"), tuple(KEPT)
    visits = event_visits(_events(spark, sf_dir)).select(*CLUSTERED_COLUMNS)
    share = F.pmod(F.xxhash64(*CLUSTERED_COLUMNS), F.lit(BATCHES + 2))
    for batch in (1, 0, 2, 1, 3, 5, 4):
        if batch == 2:  # a first try with fewer rows
            tables.write_batch(visits.filter((share == 2) & (F.col("lon_visit") > -2.4333)), 2, out, keep=keep)
        tables.write_batch(visits.filter(share == batch), batch, out, keep=keep)
        if batch == 3:
            tables.compact(spark, out)
    tables.compact(spark, out, through=4, full=True)
    return out


def device_by_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One device from the partitions of the dates it was seen on."""
    found = tables.device_visits(spark, _kept_table(spark, sf_dir), DEVICE_HASH)
    return found.select(*CLUSTERED_COLUMNS)


def report_from_stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hotspot report from counts kept batch by batch."""
    counts = tables.stored_counts(spark, _kept_table(spark, sf_dir))
    return _rounded(hotspots.with_flags(counts, threshold=THRESHOLD), "mean", "std")


def encode_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits_from_messages(msg.encode(event_pings(_events(spark, sf_dir))))


def view_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.register_view(_visits(spark, sf_dir))
    return spark.sql(
        "SELECT lat_visit, lon_visit, date_visit, cluster_pred FROM visits "
        "WHERE visit_date BETWEEN DATE(:start) AND DATE(:end)",
        args={"start": START, "end": END},
    )


# Projections, filters, scalar functions


def masked_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    pings = event_pings(_events(spark, sf_dir))
    return pings.select("time_stamp", mask_device_id(F.col("device_id")).alias("device_id"))


def substituted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    pings = event_pings(_events(spark, sf_dir))
    return pings.select(
        "time_stamp", mask_device_id(F.col("device_id"), SUBSTITUTION).alias("device_id")
    )


def epoch_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pings = event_pings(_events(spark, sf_dir))
    text = F.col("time_stamp").cast("string")
    return pings.select("time_stamp", epoch_to_text(text).alias("date_visit"))


def numbers_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        "event_id",
        number(F.col("value").cast("string")).alias("value"),
        number(F.col("props")).isNull().alias("props_is_bad"),
        number(F.col("event_type")).isNull().alias("type_is_bad"),
    )


def usable_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` and ``user_id`` read as coordinates: those off the globe go."""
    points = _events(spark, sf_dir).select(
        "event_id", F.col("value").alias("lat"), F.col("user_id").cast("double").alias("lon")
    )
    return points.filter(valid_position(F.col("lat"), F.col("lon")))


def stored_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visits(spark, sf_dir).select(*CLUSTERED_COLUMNS)


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = vector_to_array("features")
    return clusters.assemble(_visits(spark, sf_dir)).select(
        "date_visit", parts[0].alias("lat"), parts[1].alias("lon")
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = _visits(spark, sf_dir).select("device_id", "date_visit")
    return hotspots.with_calendar(visits)


def dates_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots.date_range(_visits(spark, sf_dir), START, END).select(*CLUSTERED_COLUMNS)


def dates_between_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = _visits(spark, sf_dir).select(*CLUSTERED_COLUMNS)
    return hotspots.date_range(visits, START, END)


def one_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = _visits(spark, sf_dir).select(*CLUSTERED_COLUMNS)
    return journeys.device_visits(visits, DEVICE_HASH)


def emptiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = _visits(spark, sf_dir)
    never = hotspots.date_range(visits, "1999-01-01", "1999-12-31")
    return totals.total_visits(visits).select(
        F.lit(clusters.is_empty(visits)).alias("all_empty"),
        F.lit(clusters.is_empty(never)).alias("never_empty"),
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).select("cell", "hour", "date", "alert")


def fractional_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = hotspots.with_flags(_counts(spark, sf_dir), sigma="1.5")
    return flagged.select("cell", "hour", "date", "alert")


def red_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _counts(spark, sf_dir)
    wave = hotspots.red_wave(F.col("pings"), THRESHOLD)
    return counts.select("cell", "hour", "date", wave.alias("red_wave"))


def colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    wave = hotspots.red_wave(F.col("pings"), THRESHOLD)
    return _counts(spark, sf_dir).select("cell", "hour", "date", marker_color(wave).alias("color"))


def popups(spark: SparkSession, sf_dir: str) -> DataFrame:
    wave = hotspots.red_wave(F.col("pings"), THRESHOLD)
    text = heat_popup(wave, F.col("pings"), F.col("date"), F.col("hour"))
    return _counts(spark, sf_dir).select("cell", "hour", "date", text.alias("popup"))


# Cells


def hex_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = with_cell(_visits(spark, sf_dir).select("date_visit", "lat_visit", "lon_visit"))
    return placed.select("date_visit", "cell", cell_text(F.col("cell")).alias("cell_text"))


def coarse_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = with_cell(_visits(spark, sf_dir), COARSE)
    return placed.groupBy("cell").agg(F.count(F.lit(1)).alias("pings"))


def cell_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = with_cell(_visits(spark, sf_dir)).select("cell").distinct()
    return _rounded(with_center(cells), "lat", "lon")


def _around_the_globe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event at a place of its own, from pole to pole and from -180 to 180 degrees."""
    number = F.col("event_id")
    return _events(spark, sf_dir).select(
        number,
        (F.pmod(number * 7919, F.lit(180_001)) / F.lit(1000.0) - F.lit(90.0)).alias("lat_visit"),
        (F.pmod(number * 104_729, F.lit(360_001)) / F.lit(1000.0) - F.lit(180.0)).alias("lon_visit"),
    )


def globe_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return globe.with_cell(_around_the_globe(spark, sf_dir)).select("event_id", "cell")


def globe_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the centre of its cell, which lies within one edge of it."""
    placed = globe.with_center(globe.with_cell(_around_the_globe(spark, sf_dir)))
    return _rounded(placed.select("event_id", "cell", "lat", "lon"), "lat", "lon")


# Aggregations, joins, sorts


def spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(hotspots.hour_stats(_counts(spark, sf_dir)), "mean", "std")


def counts_with_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _counts(spark, sf_dir)
    return _rounded(hotspots.join_stats(counts, hotspots.hour_stats(counts)), "mean", "std")


def hotspot_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_report(spark, sf_dir), "mean", "std")


def pings_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.hourly_pings(_visits(spark, sf_dir))


def pings_by_hour_from_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.hourly_from_counts(_counts(spark, sf_dir))


def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.cluster_distribution(_visits(spark, sf_dir))


def cluster_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.cluster_count(_visits(spark, sf_dir))


def visit_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.total_visits(_visits(spark, sf_dir))


def map_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(totals.mean_position(_visits(spark, sf_dir)), "mean_lat", "mean_lon")


def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(totals.overview(_visits(spark, sf_dir)), "mean_lat", "mean_lon")


def device_journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.register_view(_visits(spark, sf_dir))
    return journeys.journey_sql(spark, DEVICE_HASH)


def first_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journeys.first_visits(_visits(spark, sf_dir))


def journey_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journeys.journey_segments(_visits(spark, sf_dir))


def journey_segments_by_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same segments with devices above the average cut into range blocks."""
    visits = _visits(spark, sf_dir)
    total, devices = visits.agg(F.count(F.lit(1)), F.countDistinct("device_id")).first()
    sizes = {"busy_visits": total // devices, "block_visits": -(-total // 32)}
    return journeys.journey_segments(visits, **sizes)


def journey_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = journeys.journey_paths(_visits(spark, sf_dir), POINTS_PER_ROW)
    lines = F.transform(
        "path",
        lambda p: F.concat_ws(
            " ",
            p["lat"].cast("decimal(9,6)").cast("string"),
            p["lon"].cast("decimal(9,6)").cast("string"),
        ),
    )
    return paths.select("device_id", "part", F.array_join(lines, ";").alias("path"))


# Clustering


def _grouped_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits in five clearly separated places."""
    return event_visits(_events(spark, sf_dir), grouped=True)


def _numbered(labelled: DataFrame, *batch: str) -> DataFrame:
    """Visits with their label as the number of its cluster in the order of mean latitude."""
    means = labelled.groupBy(*batch, "cluster_pred").agg(F.avg("lat_visit").alias("_mean"))
    order = Window.partitionBy(*batch).orderBy("_mean")
    ranks = means.withColumn("place", F.row_number().over(order) - 1).drop("_mean")
    return labelled.join(F.broadcast(ranks), [*batch, "cluster_pred"])


def kmeans_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = _grouped_visits(spark, sf_dir).select(*VISIT_COLUMNS)
    with clusters.held_positions(visits) as points:
        model = clusters.fit(points, GROUPS)
    return _numbered(clusters.assign(model, visits)).select(*VISIT_COLUMNS, "place")


def fixed_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = _visits(spark, sf_dir).select(*VISIT_COLUMNS)
    return clusters.assign_fixed(visits, CENTERS)


def silhouette_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = _visits(spark, sf_dir)
    return _rounded(silhouette(visits, "cluster_pred", clusters.POSITION), "silhouette")


def silhouette_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = _visits(spark, sf_dir)
    visits = clusters.assemble(visits, shift=clusters.middle(visits))
    value = clusters.score(visits)
    return totals.total_visits(visits).select("total", F.round(F.lit(value), 6).alias("silhouette"))


def silhouette_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(pin(spark), sf_dir, "embeddings")
    width = vectors.select(F.max(F.size("embedding"))).first()[0]
    names = [f"x{i}" for i in range(width)]
    wide = vectors.selectExpr("label", *[f"embedding[{i}] AS {n}" for i, n in enumerate(names)])
    return _rounded(silhouette(wide, "label", names), "silhouette")


def chosen_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ways of choosing k find the five places."""
    visits = _grouped_visits(spark, sf_dir)
    with clusters.held_positions(visits) as points:
        scores = clusters.sweep(points, min(clusters.MAX_K, points.distinct))
    picked = [F.lit(clusters.pick(scores, m)).alias(m) for m in ("silhouette_max", "elbow")]
    return totals.total_visits(visits).select("total", *picked)


def argmin_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's own choice of k, the lowest silhouette, over fixed labellings: every
    visit is labelled by its user's number modulo k. With the scores it chooses from."""
    ks = range(2, clusters.MAX_K + 1)
    labelled = event_labellings(_events(spark, sf_dir), ks)
    row = silhouettes(labelled, [f"k{k}" for k in ks], clusters.POSITION).first()
    scores = [{"k": k, "cost": None, "silhouette": row[f"k{k}"]} for k in ks]
    chosen = F.lit(clusters.pick(scores, "argmin_silhouette")).alias("argmin_silhouette")
    shown = [F.round(F.lit(s["silhouette"]), 6).alias(f"k{s['k']}") for s in scores]
    return totals.total_visits(labelled).select("total", chosen, *shown)


def degenerate_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All visits moved to one position get cluster 0; a table of one row gets none."""
    visits = _visits(spark, sf_dir)
    middle = totals.mean_position(visits).select(
        F.col("mean_lat").alias("lat_visit"), F.col("mean_lon").alias("lon_visit")
    )
    moved = visits.select(F.lit(53.55).alias("lat_visit"), F.lit(-2.4333).alias("lon_visit"))
    parts = {"one_row": clusters.cluster(middle), "one_position": clusters.cluster(moved)}
    named = [df.select(F.lit(n).alias("rows"), "cluster_pred") for n, df in parts.items()]
    label = F.coalesce(F.col("cluster_pred"), F.lit(-1)).alias("label")
    return named[0].unionByName(named[1]).groupBy("rows", label).agg(
        F.count(F.lit(1)).alias("visits")
    )


def _stream_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = stream_in_parts(spark, _events(spark, sf_dir), scratch(spark, "parts"), BATCHES)
    return visits_from_messages(event_messages(parts, grouped=True))


def clustered_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustering stream over several batches; each batch finds the five places anew."""
    out, state = scratch(spark, "clustered"), scratch(spark, "checkpoint")
    callback = ClusterBatch(path=out, choice={"max_k": GROUPS + 1})
    run_batches(_stream_grouped(spark, sf_dir), callback, state, once=True).awaitTermination()
    stored = tables.read_visits(spark, out)
    batches = stored.select(F.countDistinct("batch_id").alias("batches"))
    labelled = _numbered(stored, "batch_id").select(*VISIT_COLUMNS, "visit_date", "place")
    return labelled.join(F.broadcast(batches))


def saved_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model fitted on the stored visits labels the same visits, streamed in batches."""
    path, out, state = (scratch(spark, n) for n in ("model", "scored", "checkpoint"))
    save_model(_grouped_visits(spark, sf_dir), path, max_k=GROUPS + 1)
    scored = score_stream(_stream_grouped(spark, sf_dir), path)
    run_batches(scored, lambda df, _: tables.append(df, out), state, once=True).awaitTermination()
    return _numbered(spark.read.parquet(out)).select(*VISIT_COLUMNS, "place")


# Streams and markers


def batch_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits_from_messages(event_messages(_events(spark, sf_dir)))


def closed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, state = scratch(spark, "live"), scratch(spark, "checkpoint")
    counts = live_counts(_stream_visits(spark, sf_dir), lateness=LATENESS)
    store_counts(counts, out, state, once=True).awaitTermination()
    return spark.read.schema(counts.schema).parquet(out)


def late_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of a stream stopped and resumed: before SPLIT, users of odd numbers come
    after all others, and count only where their hour is still open."""
    inbox, out, state = (scratch(spark, n) for n in ("late", "live", "checkpoint"))
    events = _events(spark, sf_dir)
    early, odd = F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"), F.col("user_id") % 2 == 1
    for part in (early & ~odd, early & odd, ~early):
        events.filter(part).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(events.schema).parquet(inbox)
        counts = live_counts(visits_from_messages(event_messages(stream)), lateness=LATENESS)
        store_counts(counts, out, state, once=True).awaitTermination()
    return spark.read.schema(counts.schema).parquet(out)


def open_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode over the whole table: every hour, the open ones too, as last reported."""
    out, state = scratch(spark, "open"), scratch(spark, "checkpoint")

    def keep(changed: DataFrame, batch_id: int) -> None:
        changed.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(out)

    counts = live_counts(_stream_visits(spark, sf_dir), lateness=LATENESS)
    watch_counts(counts, keep, state, once=True).awaitTermination()
    reported = spark.read.parquet(out)
    latest = F.max_by("pings", "batch").alias("pings")
    return reported.groupBy("cell", "hour", "date").agg(latest)


def heat_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(markers.heat_markers(_report(spark, sf_dir)), "lat", "lon")


def journey_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markers.journey_markers(_visits(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "s1_publish_and_stream": publish_and_stream,
    "s2_decode_messages": decode_messages,
    "s2_malformed_messages": malformed_messages,
    "s3_append_table": append_table,
    "s4_micro_batches": micro_batches,
    "s4_compacted_batches": compacted_batches,
    "s4_connector_replays": connector_replays,
    "s5_encode_round_trip": encode_round_trip,
    "s6_view_scan": view_scan,
    "s6_connector_round_trip": connector_round_trip,
    "p1_masked_ids": masked_ids,
    "p2_substituted_ids": substituted_ids,
    "p3_epoch_texts": epoch_texts,
    "p4_numbers_from_text": numbers_from_text,
    "p5_usable_positions": usable_positions,
    "p6_stored_columns": stored_columns,
    "p7_feature_vectors": feature_vectors,
    "p8_calendar": calendar,
    "p9_dates_between": dates_between,
    "p9_dates_between_text": dates_between_text,
    "p10_one_device": one_device,
    "p10_device_by_dates": device_by_dates,
    "p11_emptiness": emptiness,
    "p12_alerts": alerts,
    "p12_fractional_alerts": fractional_alerts,
    "p13_red_waves": red_waves,
    "p14_colors": colors,
    "p15_popups": popups,
    "g1_hex_cells": hex_cells,
    "g1_coarse_cells": coarse_cells,
    "g1_globe_cells": globe_cells,
    "g2_cell_centers": cell_centers,
    "g2_globe_centers": globe_centers,
    "a1_cell_counts": _counts,
    "a2_spread": spread,
    "a3_counts_with_spread": counts_with_spread,
    "a4_hotspot_report": hotspot_report,
    "a4_report_from_stored_counts": report_from_stored_counts,
    "a5_pings_by_hour": pings_by_hour,
    "a5_pings_by_hour_from_counts": pings_by_hour_from_counts,
    "a6_cluster_sizes": cluster_sizes,
    "a7_cluster_number": cluster_number,
    "a8_visit_total": visit_total,
    "a9_map_center": map_center,
    "a9_overview": overview,
    "a10_device_journey": device_journey,
    "a11_first_visits": first_visits,
    "a12_journey_segments": journey_segments,
    "a12_journey_segments_by_block": journey_segments_by_block,
    "a12_journey_paths": journey_paths,
    "m1_kmeans_labels": kmeans_labels,
    "m2_fixed_centers": fixed_centers,
    "m3_silhouette_visits": silhouette_visits,
    "m3_silhouette_library": silhouette_library,
    "m3_silhouette_embeddings": silhouette_embeddings,
    "m4_chosen_k": chosen_k,
    "m4_argmin_silhouette": argmin_silhouette,
    "m5_degenerate_tables": degenerate_tables,
    "m6_clustered_batches": clustered_batches,
    "m7_saved_model_scores": saved_model_scores,
    "w1_batch_visits": batch_visits,
    "w2_closed_hours": closed_hours,
    "w2_late_hours": late_hours,
    "w2_open_hours": open_hours,
    "v1_heat_markers": heat_markers,
    "v2_journey_markers": journey_markers,
}
