"""Streams over text files, each with a fresh checkpoint."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from crowdgrid.operators import hotspots
from crowdgrid.operators.clean import visits_from_messages
from crowdgrid.plans import ingest_job
from crowdgrid.schema import CLUSTERED_COLUMNS, VISIT_COLUMNS
from crowdgrid.sources import tables
from crowdgrid.sources.messages import publish, read_messages
from crowdgrid.sources.testtables import event_pings, event_visits, read_table, stream_in_parts
from crowdgrid.streaming.ingest import ClusterBatch, StoreBatch, run_batches, save_model, score_stream
from crowdgrid.streaming.live import live_counts, store_counts, watch_counts


class Inbox:
    """A folder of message files and the stream over it."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0
        folder.mkdir()

    def send(self, *rows):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
        (self.folder / f"{self.files:03}.txt").write_text("\n".join(lines))
        self.files += 1

    def visits(self):
        return visits_from_messages(read_messages(self.spark, "text", path=str(self.folder)))


def ping(lat, lon, at=1704099600.0, device="d"):
    return {"device_id": device, "time_stamp": at, "lat_visit": lat, "lon_visit": lon}


@pytest.fixture
def inbox(spark, tmp_path):
    return Inbox(spark, tmp_path / "inbox")


def work(stream, callback, checkpoint):
    run_batches(stream, callback, str(checkpoint), once=True).awaitTermination()


def test_small_and_identical_batches_survive(spark, inbox, tmp_path):
    out, state = str(tmp_path / "out"), tmp_path / "state"
    callback = ClusterBatch(path=out, choice={"max_k": 3})
    for batch in (
        [ping(1, 1)],
        [ping(2, 2)] * 4,
        ["junk"],
        [ping(0, 0), ping(0, 0.1), ping(50, 50), ping(50, 50.1)],
    ):
        inbox.send(*batch)
        work(inbox.visits(), callback, state)
    rows = tables.read_visits(spark, out).collect()
    by_batch = {}
    for r in rows:
        by_batch.setdefault(r.batch_id, []).append(r.cluster_pred)
    assert by_batch.pop(0) == [None]
    assert by_batch.pop(1) == [0] * 4
    (last,) = by_batch.values()
    assert sorted(last) == [0, 0, 1, 1]
    assert {str(r.visit_date) for r in rows} == {"2024-01-01"}


def test_a_replayed_batch_replaces_itself(spark, inbox, tmp_path):
    out = str(tmp_path / "out")
    callback = ClusterBatch(path=out, choice={"max_k": 3})
    inbox.send(*[ping(i, i, 1704099600.0 + 86400 * i) for i in range(6)])
    seen = []

    def twice(df, batch_id):
        callback(df, batch_id)
        callback(df, batch_id)
        seen.append(batch_id)

    work(inbox.visits(), twice, tmp_path / "state")
    assert seen == [0]
    assert tables.read_visits(spark, out).count() == 6


def test_a_failed_batch_is_tried_again(spark, inbox, tmp_path):
    out, state = str(tmp_path / "out"), tmp_path / "state"
    callback = ClusterBatch(path=out, choice={"max_k": 3})
    inbox.send(*[ping(i, i) for i in range(6)])

    def breaks(df, batch_id):
        callback(df, batch_id)
        raise RuntimeError("lost after writing")

    with pytest.raises(Exception, match="lost after writing"):
        work(inbox.visits(), breaks, state)
    work(inbox.visits(), callback, state)
    assert tables.read_visits(spark, out).count() == 6


def test_connector_sink(spark, inbox, tmp_path):
    out = str(tmp_path / "json")
    inbox.send(*[ping(i, i) for i in range(4)])
    callback = ClusterBatch(connector="json", options={"path": out}, choice={"max_k": 2})
    work(inbox.visits(), callback, tmp_path / "state")
    stored = spark.read.json(out)
    assert stored.count() == 4 and {*CLUSTERED_COLUMNS, "batch_id"} <= set(stored.columns)


def test_a_connector_gets_a_failed_batch_once(spark, inbox, tmp_path):
    out, state = {"path": str(tmp_path / "json")}, tmp_path / "state"
    inbox.send(*[ping(i, i) for i in range(6)])
    callback = ClusterBatch(
        connector="json", options=out, log=str(tmp_path / "log"), choice={"max_k": 3}
    )

    def breaks(df, batch_id):
        callback(df, batch_id)
        raise RuntimeError("lost after appending")

    with pytest.raises(Exception, match="lost after appending"):
        work(inbox.visits(), breaks, state)
    work(inbox.visits(), callback, state)
    assert tables.read_visits(spark, fmt="json", options=out).count() == 6


def test_a_stream_keeps_its_tables(spark, inbox, tmp_path):
    out = str(tmp_path / "out")
    callback = StoreBatch(path=out, keep=("device_dates", "cell_counts"))
    for turn in range(2):
        inbox.send(*[ping(turn, i % 2, 1704099600.0 + 86400 * i) for i in range(6)])
        work(inbox.visits(), lambda df, b: callback(df.withColumn("cluster_pred", F.lit(0)), b), tmp_path / "state")
    assert tables.stored_counts(spark, out).agg(F.sum("pings")).first()[0] == 12
    assert tables.stored_counts(spark, out, "2024-01-02", "2024-01-03").agg(F.sum("pings")).first()[0] == 4


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    box, out = str(tmp_path / "box"), str(tmp_path / "out")
    events = read_table(spark, sf_dir, "events")
    publish(event_pings(events), "text", box)
    stream = visits_from_messages(read_messages(spark, "text", path=box))
    work(stream, lambda df, _: tables.append(df, out), tmp_path / "state")
    streamed = spark.read.parquet(out).select(*VISIT_COLUMNS).collect()
    batch = event_visits(events).select(*VISIT_COLUMNS).collect()
    assert sorted(streamed, key=str) == sorted(batch, key=str)


def test_saved_model_keeps_its_labels(spark, inbox, tmp_path):
    model_path, out = str(tmp_path / "model"), str(tmp_path / "out")
    inbox.send(*[ping(la, lo) for la, lo in [(0, 0), (0, 1), (50, 50), (50, 51)]])
    history = visits_from_messages(
        read_messages(spark, "text", path=str(inbox.folder), streaming=False)
    )
    model = save_model(history, model_path, max_k=2)
    inbox.send(ping(49, 50))
    work(score_stream(inbox.visits(), model_path),
         lambda df, _: tables.append(df, out), tmp_path / "state")
    label = {r.lat_visit: r.cluster_pred for r in spark.read.parquet(out).collect()}
    assert label[49.0] == label[50.0] != label[0.0]
    assert len(model.centers) == 2
    assert save_model(history.limit(1), str(tmp_path / "none")) is None


HOUR = 3600.0
START = 1704099600.0  # 2024-01-01 09:00:00


def test_late_visits(spark, inbox, tmp_path):
    """A late visit counts one batch after the watermark moved, and not two after."""
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def step(*rows):
        inbox.send(*rows)
        # one file, one batch: no empty batch may close hours in between
        stream = live_counts(inbox.visits(), lateness="1 hour")
        store_counts(stream, out, state, once=True).awaitTermination()

    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        step(ping(1, 1, START))
        step(ping(1, 1, START + 5 * HOUR))
        step(ping(1, 1, START + 60))
        step(ping(1, 1, START + 5 * HOUR + 1))
        step(ping(1, 1, START + 120))
        step(ping(1, 1, START + 9 * HOUR))
        step(ping(1, 1, START + 20 * HOUR))
    finally:
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    closed = {(r.hour, r.pings) for r in spark.read.parquet(out).collect()}
    assert (9, 2) in closed
    assert (14, 2) in closed


def test_open_hours_are_reported_as_they_grow(spark, inbox, tmp_path):
    seen, state = [], str(tmp_path / "state")
    for rows in ([ping(1, 1, START)] * 2, [ping(1, 1, START + 5)], [ping(1, 1, START + HOUR)]):
        inbox.send(*rows)
        stream = live_counts(inbox.visits())
        watch_counts(
            stream, lambda df, _: seen.append([(r.hour, r.pings) for r in df.collect()]),
            state, once=True,
        ).awaitTermination()
    assert [batch for batch in seen if batch] == [[(9, 2)], [(9, 3)], [(10, 1)]]


def test_closed_hours_equal_batch_counts_and_can_be_flagged(spark, sf_dir, tmp_path):
    out = str(tmp_path / "live")
    events = read_table(spark, sf_dir, "events")
    box = str(tmp_path / "box")
    publish(event_pings(events), "text", box)
    stream = visits_from_messages(read_messages(spark, "text", path=box))
    store_counts(live_counts(stream), out, str(tmp_path / "state"), once=True).awaitTermination()
    stored = spark.read.parquet(out).select("cell", "hour", "date", "pings")
    batch = hotspots.cell_counts(event_visits(events))
    assert stored.exceptAll(batch.select(*stored.columns)).isEmpty()
    missing = batch.select(*stored.columns).exceptAll(stored)
    assert missing.select("date", "hour").distinct().count() <= 3
    assert hotspots.with_flags(stored).count() == stored.count()


def test_submit_script(spark, inbox, tmp_path):
    inbox.send(*[ping(i, i) for i in range(5)])
    out = str(tmp_path / "out")
    ingest_job.main(
        ["--source", "text", "--path", str(inbox.folder), "--table", out, "--once",
         "--checkpoint", str(tmp_path / "state"), "--max-k", "3", "--method", "elbow",
         "--substitute", "d", "e"]
    )
    rows = tables.read_visits(spark, out).collect()
    assert [r.device_id for r in rows] == [hashlib.sha256(b"e").hexdigest()] * 5


def test_submit_script_saved_model_and_counts(spark, tmp_path, sf_dir):
    events = read_table(spark, sf_dir, "events")
    visits = event_visits(events).select(*CLUSTERED_COLUMNS)
    folder = {n: str(tmp_path / n) for n in ("inbox", "history", "model", "out", "hours", "s1", "s2")}
    tables.write_batch(visits, 0, folder["history"])
    ingest_job.main(
        ["--mode", "fit", "--table", folder["history"], "--model", folder["model"], "--max-k", "3"]
    )
    publish(event_pings(events), "text", folder["inbox"])
    source = ["--source", "text", "--path", folder["inbox"], "--once"]
    ingest_job.main(
        ["--mode", "score", *source, "--model", folder["model"], "--table", folder["out"],
         "--checkpoint", folder["s1"]]
    )
    scored = tables.read_visits(spark, folder["out"])
    assert scored.count() == visits.count() and scored.filter("cluster_pred IS NULL").isEmpty()
    ingest_job.main(
        ["--mode", "counts", *source, "--table", folder["hours"], "--checkpoint", folder["s2"]]
    )
    hours = spark.read.parquet(folder["hours"])
    assert 0 < hours.agg({"pings": "sum"}).first()[0] <= visits.count()


@pytest.mark.parametrize("mode", ["fit", "score"])
def test_saved_model_modes_need_a_model(mode):
    with pytest.raises(SystemExit):
        ingest_job.arguments(
            ["--mode", mode, "--source", "text", "--table", "t", "--checkpoint", "c"]
        )


def test_submit_script_bounds_a_batch(monkeypatch, spark):
    seen = {}
    monkeypatch.setattr(
        ingest_job, "read_messages", lambda s, source, options, path: seen.update(options) or s.range(0)
    )
    monkeypatch.setattr(ingest_job, "visits_from_messages", lambda messages, substitution: messages)
    ingest_job._visits(spark, ingest_job.arguments(
        ["--checkpoint", "c", "--table", "t", "--bootstrap", "h:1", "--topic", "x",
         "--max-messages", "500"]
    ))
    assert seen["maxOffsetsPerTrigger"] == "500" and seen["subscribe"] == "x"


def test_submit_script_arguments():
    with pytest.raises(SystemExit):
        ingest_job.arguments(["--checkpoint", "c", "--table", "t"])
    with pytest.raises(SystemExit):
        ingest_job.arguments(["--checkpoint", "c", "--source", "text"])
    args = ingest_job.arguments(
        ["--checkpoint", "c", "--table", "t", "--bootstrap", "h:1", "--topic", "x"]
    )
    assert (args.interval, args.max_k, args.seed) == ("10 seconds", 10, 42)


def test_parts_of_a_stream_have_files_by_their_rows(spark, tmp_path):
    """Also where rows repeat: always as many batches, each of several files."""
    rows = spark.range(400).select((F.col("id") % 2).alias("x"))
    for file_rows, files in ((100, 1), (20, 5)):
        path, seen = str(tmp_path / f"parts{files}"), []

        def note(batch, _, seen=seen):
            seen.append((batch.select("file").distinct().count(), batch.count()))

        distinct = spark.range(400) if files == 1 else rows
        stream = stream_in_parts(spark, distinct, path, 4, file_rows=file_rows)
        named = stream.withColumn("file", F.input_file_name())
        run_batches(named, note, str(tmp_path / f"state{files}"), once=True).awaitTermination()
        assert [n for n, _ in seen] == [files] * 4
        assert sum(n for _, n in seen) == 400
    assert spark.read.parquet(path).groupBy("x").count().orderBy("x").collect() == [(0, 200), (1, 200)]
