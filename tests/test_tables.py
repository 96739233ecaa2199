"""The stored table: what reaches the scan, and writing a batch twice."""

import os
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F

from crowdgrid.operators import hotspots, journeys
from crowdgrid.schema import CLUSTERED_COLUMNS, STORED_VISIT_SCHEMA
from crowdgrid.session import SETTINGS, pin, scratch, shared_dir
from crowdgrid.sources import files, kept, tables
from crowdgrid.sources.connectors import ConnectorSink
from crowdgrid.sources.testtables import event_visits, read_table


@pytest.fixture(scope="module")
def visits(spark, sf_dir):
    return event_visits(read_table(spark, sf_dir, "events")).select(*CLUSTERED_COLUMNS)


@pytest.fixture(scope="module")
def table(spark, visits):
    path = scratch(spark, "table")
    tables.write_batch(visits, 0, path)
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_read_back(spark, visits, table):
    stored = tables.read_visits(spark, table, CLUSTERED_COLUMNS)
    assert sorted(stored.collect(), key=str) == sorted(visits.collect(), key=str)


def test_writing_a_batch_again_changes_nothing(spark, visits):
    path = scratch(spark, "replay")
    tables.write_batch(visits, 3, path)
    tables.write_batch(visits, 4, path)
    tables.write_batch(visits, 3, path)
    counted = tables.read_visits(spark, path).groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in counted} == {3: visits.count(), 4: visits.count()}


def files_of(spark, path):
    stored = tables.read_visits(spark, path).select(F.input_file_name().alias("file"))
    return stored.distinct().count()


def test_compaction_returns_each_visit_once(spark, visits):
    path = scratch(spark, "compacted")
    parts = visits.randomSplit([1.0] * 5, seed=7)
    dates = visits.select(F.substring("date_visit", 1, 10)).distinct().count()

    def right(batches):
        got = tables.read_visits(spark, path).groupBy("batch_id").count().collect()
        return {r.batch_id: r["count"] for r in got} == {b: parts[b].count() for b in batches}

    assert tables.compact(spark, path) is None
    for b in range(3):
        tables.write_batch(parts[b], b, path)
    before = files_of(spark, path)
    assert tables.compact(spark, path) == 1 and right(range(3))
    assert tables.compact(spark, path) == 1 and right(range(3))
    for b in (0, 2, 1):  # replays of published batches and of the latest
        tables.write_batch(parts[b], b, path)
    assert right(range(3))
    assert tables.tidy(spark, path) > 0 and right(range(3))
    tables.write_batch(parts[1], 1, path)
    for b in (3, 4):
        tables.write_batch(parts[b], b, path)
    assert tables.compact(spark, path) == 3 and right(range(5))
    assert tables.compact(spark, path, through=4, full=True, stopped=True) == 4 and right(range(5))
    tables.tidy(spark, path)
    assert right(range(5)) and tables.tidy(spark, path) == 0
    assert files_of(spark, path) == dates < before


def test_a_failed_compaction_changes_nothing(spark, visits):
    path = scratch(spark, "failed")
    for b in range(2):
        tables.write_batch(visits, b, path)
    # A segment whose entry was never written, as after a crash.
    orphan = os.path.join(path, tables.SEGMENTS, "0-0")
    tables.with_visit_date(visits).write.partitionBy("visit_date").parquet(orphan)
    assert tables.read_visits(spark, path).count() == 2 * visits.count()
    assert tables.compact(spark, path) == 0
    assert tables.read_visits(spark, path).count() == 2 * visits.count()


def test_the_latest_batch_is_published_only_once_the_stream_has_stopped(spark, visits):
    path = scratch(spark, "latest")
    for b in range(3):
        tables.write_batch(visits.limit(20), b, path)
    for through in (2, 9):
        with pytest.raises(ValueError):
            tables.compact(spark, path, through=through)
    assert tables.segments(spark, path).live == ()
    assert tables.compact(spark, path, through=0) == 0
    assert tables.compact(spark, path, stopped=True) == 2
    assert tables.read_visits(spark, path).count() == 60


def test_compactions_at_once_lose_and_repeat_nothing(spark, visits):
    """Some over the same batches, some with all segments merged, from several threads."""
    path = scratch(spark, "at-once")
    few = visits.limit(50).cache()
    for turn in range(3):
        for b in range(3 * turn, 3 * turn + 3):
            tables.write_batch(few, b, path)
        with ThreadPool(4) as pool:
            done = pool.map(lambda i: tables.compact(spark, path, full=i % 2 == 1), range(4))
        assert max(done) == 3 * turn + 1
        live = tables.segments(spark, path).live
        assert all(a[1] < b[0] for a, b in zip(live, live[1:])) and live[0][0] == 0
        counted = tables.read_visits(spark, path).groupBy("batch_id").count().collect()
        assert {r.batch_id: r["count"] for r in counted} == dict.fromkeys(range(3 * turn + 3), 50)
    tables.tidy(spark, path)
    assert tables.read_visits(spark, path).count() == 9 * 50


def test_an_overtaken_compaction_starts_again(spark, visits, monkeypatch):
    """Another one publishes more batches while this one writes its segment."""
    path = scratch(spark, "overtaken")
    few = visits.limit(30).cache()
    for b in range(3):
        tables.write_batch(few, b, path)
    real, turns = tables._publish, []

    def late(spark_, path_, known, *more):
        if not turns:
            turns.append(1)
            tables.write_batch(few, 3, path)
            assert tables.compact(spark, path) == 2
        return real(spark_, path_, known, *more)

    monkeypatch.setattr(tables, "_publish", late)
    assert tables.compact(spark, path, full=True) == 2
    assert len(tables.segments(spark, path).live) == 1
    assert tables.read_visits(spark, path).count() == 4 * 30


def test_merging_joins_what_others_published_meanwhile(spark, visits, monkeypatch):
    path = scratch(spark, "joined")
    few = visits.limit(30).cache()
    for b in range(3):
        tables.write_batch(few, b, path)
        tables.compact(spark, path)
    assert len(tables.segments(spark, path).live) == 2
    real, turns = tables._publish, []

    def late(spark_, path_, known, *more):
        if not turns:
            turns.append(1)
            tables.write_batch(few, 3, path)
            tables.compact(spark, path)
        return real(spark_, path_, known, *more)

    monkeypatch.setattr(tables, "_publish", late)
    plan_ = tables._plan(spark, path, tables.segments(spark, path), None, True, False)
    assert plan_[:2] == (0, 1)
    assert tables.compact(spark, path, full=True) == 1
    assert [s[:2] for s in tables.segments(spark, path).live] == [(0, 1), (2, 2)]
    assert tables.read_visits(spark, path).count() == 4 * 30


def test_files_are_created_once(spark, tmp_path):
    path = str(tmp_path / "a" / "b")
    with ThreadPool(8) as pool:
        made = pool.map(lambda i: files.create_new(spark, path, f"text {i}"), range(40))
    assert sum(made) == 1 and files.read_text(spark, path) == f"text {made.index(True)}"
    assert not files.exists(spark, path + "x") and list(files.matching(spark, path + "*")) == [f"file:{path}"]
    assert os.listdir(tmp_path / "a") == ["b"]
    assert files.delete(spark, path) and not files.exists(spark, path)


KEEP = tuple(kept.KEPT)


def same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def partition_filters(df):
    return [part.split("]")[0] for part in plan(df).split("PartitionFilters: [")[1:]]


def test_kept_tables_follow_any_order_of_batches(spark, visits):
    """Batches in any order, written twice, compacted in between: reports and lookups equal
    those of the visits at every step."""
    path = scratch(spark, "kept")
    share = F.pmod(F.xxhash64(*visits.columns), F.lit(6))
    odd = spark.createDataFrame([(None, None, 53.5, -2.4, 1), ("z", None, 53.5, -2.4, 1)], visits.schema)
    whole = visits.unionByName(odd).cache()
    devices = [r[0] for r in whole.select("device_id").distinct().limit(2).collect()] + ["z", "nobody"]
    written = set()

    def right():
        stored = tables.read_visits(spark, path).select(*CLUSTERED_COLUMNS)
        known = whole.filter(share.isin(sorted(written)))
        assert same_rows(stored, known)
        counts = hotspots.cell_counts(known)
        assert same_rows(tables.stored_counts(spark, path), counts)
        ranged = hotspots.date_range(tables.with_visit_date(known), "2024-01-05", "2024-01-09")
        got = tables.stored_counts(spark, path, "2024-01-05", "2024-01-09")
        assert same_rows(hotspots.with_flags(got), hotspots.hotspots(ranged))
        for device in devices:
            one = tables.device_visits(spark, path, device).select(*CLUSTERED_COLUMNS)
            assert same_rows(one, journeys.device_visits(known, device))

    for step in (2, 0, 2, 1, "compact", 3, 0, "full", 5, 4, "compact", "tidy", "last"):
        if isinstance(step, int):
            tables.write_batch(whole.filter(share == step), step, path, keep=KEEP)
            written.add(step)
            if tables.segments(spark, path).done is not None:
                continue
        elif step == "tidy":
            assert tables.tidy(spark, path) > 0
        else:
            tables.compact(spark, path, full=step == "full", stopped=step == "last")
        if not isinstance(step, int):
            right()
    left = files.matching(spark, os.path.join(path, kept.FOLDER, "*", kept.LANDED, "*"))
    tables.tidy(spark, path)
    after = files.matching(spark, os.path.join(path, kept.FOLDER, "*", kept.LANDED, "*"))
    assert len(left) > len(after) == 0
    right()


def test_a_lookup_opens_the_partitions_of_its_dates(spark, visits):
    path = scratch(spark, "lookup")
    device = visits.select("device_id").first()[0]
    some = visits.filter((F.col("device_id") != device) | F.col("date_visit").between("2024-01-03", "2024-01-05"))
    dates = some.filter(F.col("device_id") == device).select(F.substring("date_visit", 1, 10).alias("d")).distinct()
    days = sorted(r.d for r in dates.collect())
    for b in range(2):
        tables.write_batch(some, b, path, keep=KEEP)
        tables.compact(spark, path)
    found = tables.device_visits(spark, path, device)
    filters = partition_filters(found)
    assert len(filters) == 2 and len(days) in (1, 2, 3)
    assert all(d in f for d in days for f in filters)
    assert {str(r[0]) for r in found.select("visit_date").distinct().collect()} == set(days)
    opened = {r[0].split("visit_date=")[1][:10] for r in found.select(F.input_file_name()).distinct().collect()}
    assert opened == set(days)
    dated = tables._kept(spark, path, "device_dates", F.col("bucket") == kept.bucket_of(F.lit(device)))
    assert any("bucket" in f for f in partition_filters(dated))


def test_tables_that_are_not_kept_whole_are_not_used(spark, visits):
    path = scratch(spark, "partly")
    device = visits.select("device_id").first()[0]
    tables.write_batch(visits, 0, path, keep=KEEP)
    tables.write_batch(visits, 1, path)
    want = 2 * visits.filter(F.col("device_id") == device).count()
    for _ in range(2):
        assert tables.device_visits(spark, path, device).count() == want
        with pytest.raises(ValueError):
            tables.stored_counts(spark, path)
        tables.compact(spark, path, stopped=True)


CONNECTORS = [("json", {}), ("csv", {"header": "true"}), ("parquet", {})]


@pytest.mark.parametrize(("fmt", "more"), CONNECTORS)
def test_a_batch_goes_through_a_connector_once(spark, visits, tmp_path, fmt, more):
    odd = spark.createDataFrame([(None, None, 0.1 + 0.2, -1e-300, None)] * 3, visits.schema)
    rows = visits.limit(40).unionByName(odd).cache()
    options = {"path": str(tmp_path / "t"), **more}
    sink = ConnectorSink(fmt, str(tmp_path / "log"), options)

    def stored(batch_id):
        back = tables.read_visits(spark, fmt=fmt, options=options).filter(F.col("batch_id") == batch_id)
        return sorted(back.select(*CLUSTERED_COLUMNS).collect(), key=str)

    want = sorted(rows.collect(), key=str)
    sink.write(rows, 0)
    sink.write(rows.limit(1), 0)
    assert stored(0) == want
    # Begun but nothing appended; appended in part; appended in whole but not noted.
    for batch_id, share in ((1, None), (2, 0.5), (3, 1.0)):
        staged = sink.stage(rows, batch_id)
        assert sink.begin(spark, batch_id) and not sink.begin(spark, batch_id)
        if share:
            part = staged if share == 1 else staged.filter("device_id IS NULL").limit(2)
            tables.append(part, None, fmt, options)
        sink.write(rows.limit(5), batch_id)  # the staged rows count, not those of the replay
        assert stored(batch_id) == want
    assert not list(files.matching(spark, str(tmp_path / "log" / "staged" / "*")))


def test_a_first_batch_that_stored_nothing(spark, visits, tmp_path):
    options = {"path": str(tmp_path / "never")}
    sink = ConnectorSink("json", str(tmp_path / "log"), options)
    sink.begin(spark, 0)
    sink.write(visits.limit(4), 0)
    assert tables.read_visits(spark, fmt="json", options=options).count() == 4


def test_compacted_dates_prune_partitions(spark, visits):
    path = scratch(spark, "pruned")
    for b in range(2):
        tables.write_batch(visits, b, path)
    tables.compact(spark, path)
    kept = hotspots.date_range(tables.read_visits(spark, path), "2024-01-05", "2024-01-06")
    scans = plan(kept).split("PartitionFilters: [")[1:]
    assert len(scans) == 2 and all("isnotnull(visit_date" in s.split("]")[0] for s in scans)


def test_read_back_through_a_connector(spark, visits):
    through = {"fmt": "json", "options": {"path": scratch(spark, "connector")}}
    tables.append(visits, **through)
    back = tables.read_visits(spark, **through)
    assert back.columns == STORED_VISIT_SCHEMA.names and back.filter("batch_id IS NULL").count()
    assert back.select(*CLUSTERED_COLUMNS).exceptAll(visits).isEmpty()
    assert back.count() == visits.count()


def test_visits_without_a_time_are_stored(spark, visits):
    path = scratch(spark, "untimed")
    tables.write_batch(visits.limit(5).withColumn("date_visit", F.lit(None).cast("string")), 0, path)
    stored = tables.read_visits(spark, path)
    assert stored.count() == 5 and stored.filter("visit_date is null").count() == 5


def test_date_range_prunes_partitions(spark, table):
    kept = hotspots.date_range(tables.read_visits(spark, table), "2024-01-05", "2024-01-06")
    text = plan(kept)
    assert "PartitionFilters: [isnotnull(visit_date" in text
    assert kept.select("visit_date").distinct().count() == 2


def test_device_lookup_is_pushed_down(spark, table):
    one = journeys.journey(tables.read_visits(spark, table), "abc")
    assert "EqualTo(device_id,abc)" in plan(one)


def test_files_are_sorted_by_device(spark, table):
    stored = tables.read_visits(spark, table)
    files = stored.select("device_id", "visit_date", F.input_file_name().alias("file")).collect()
    by_file = {}
    for r in files:
        by_file.setdefault(r.file, []).append(r.device_id)
    assert len(by_file) == len({r.visit_date for r in files})
    assert all(ids == sorted(ids) for ids in by_file.values())


def test_text_range_is_pushed_down(spark, table):
    bare = tables.read_visits(spark, table).drop("visit_date")
    text = plan(hotspots.date_range(bare, "2024-01-05", "2024-01-06"))
    assert "GreaterThanOrEqual(date_visit,2024-01-05)" in text
    assert "LessThan(date_visit,2024-01-07)" in text


def test_report_reads_only_its_columns(spark, table):
    report = plan(hotspots.hotspots(tables.read_visits(spark, table)))
    schema = report.split("ReadSchema: ")[1].split("\n")[0]
    assert "device_id" not in schema and "cluster_pred" not in schema


def test_append_through_a_connector(spark, visits, tmp_path):
    out = str(tmp_path / "json")
    tables.append(visits.limit(3), fmt="json", options={"path": out})
    tables.append(visits.limit(3), fmt="json", options={"path": out})
    assert spark.read.json(out).count() == 6


def test_view(spark, table):
    tables.register_view(tables.read_visits(spark, table), "table_test")
    assert spark.sql("SELECT lat_visit, cluster_pred FROM table_test").count() > 0


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x") != scratch(spark, "x")


def test_settings(spark):
    pin(spark)
    for name in ("spark.sql.ansi.enabled", "spark.sql.session.timeZone"):
        assert spark.conf.get(name).lower() == SETTINGS[name].lower()


def test_scratch_is_cleaned(spark, visits, monkeypatch):
    from crowdgrid import session

    monkeypatch.setattr(session, "_made", [])
    held = session.materialise(visits.limit(3))
    assert held.count() == 3
    (path,) = session._made
    assert os.path.isdir(path)
    assert session.clean_scratch(spark) == 1
    assert not os.path.exists(path) and session.clean_scratch(spark) == 0
