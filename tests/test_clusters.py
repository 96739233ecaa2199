"""Choosing k, degenerate input, and the two forms of the silhouette."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdgrid.operators import clusters, kmeans
from crowdgrid.operators.silhouette import silhouette, silhouettes

SCHEMA = "device_id string, date_visit string, lat_visit double, lon_visit double"


def frame(spark, points):
    return spark.createDataFrame([("d", "2024-01-01 00:00:00", *p) for p in points], SCHEMA)


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(5)
    centers = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0)]
    points = [
        (la + rng.gauss(0, 0.2), lo + rng.gauss(0, 0.2)) for la, lo in centers for _ in range(40)
    ]
    return frame(spark, points).cache()


def test_three_blobs(blobs):
    with clusters.held_positions(blobs) as points:
        assert (points.distinct, points.visits) == (120, 120)
        scores = clusters.sweep(points)
    assert [s["k"] for s in scores] == list(range(2, 11))
    assert clusters.pick(scores, "silhouette_max") == 3
    assert clusters.pick(scores, "elbow") == 3
    worst = clusters.pick(scores, "argmin_silhouette")
    assert worst != 3
    assert worst == min(scores, key=lambda s: (s["silhouette"], s["k"]))["k"]


def test_select_k(blobs):
    assert clusters.select_k(blobs, max_k=5) == 3
    assert clusters.select_k(blobs, max_k=2) == 2
    assert clusters.select_k(blobs, max_k=5, method="elbow") == 3


def test_ties_take_the_smallest_k():
    tied = [{"k": k, "cost": 1.0, "silhouette": 0.5} for k in (2, 3, 4)]
    assert [clusters.pick(tied, m) for m in clusters.METHODS] == [2, 2, 2]
    assert clusters.pick([{"k": 2, "cost": 0.0, "silhouette": None}], "silhouette_max") == 2
    with pytest.raises(ValueError):
        clusters.pick(tied, "best")


def test_too_few_rows(spark):
    with pytest.raises(ValueError):
        clusters.select_k(frame(spark, [(1.0, 1.0)]))
    with pytest.raises(ValueError):
        clusters.select_k(frame(spark, [(1.0, 1.0)]).limit(0))
    assert clusters.select_k(frame(spark, [(1.0, 1.0)] * 5)) == 1
    assert clusters.select_k(frame(spark, [(1.0, 1.0), (2.0, 2.0)])) == 2


def test_degenerate_tables_are_clustered(spark):
    def labels(points):
        return [r.cluster_pred for r in clusters.cluster(frame(spark, points)).collect()]

    assert labels([(1.0, 1.0)]) == [None]
    assert labels([(1.0, 1.0)] * 4) == [0] * 4
    assert sorted(labels([(1.0, 1.0), (2.0, 2.0)])) == [0, 1]
    assert len(labels([(1.0, 1.0)] * 3 + [(9.0, 9.0)])) == 4


def test_labels_are_nearest(blobs):
    model = clusters.fit_best(blobs, max_k=4)
    for r in clusters.assign(model, blobs).collect():
        away = [(r.lat_visit - a) ** 2 + (r.lon_visit - b) ** 2 for a, b in model.centers]
        assert away[r.cluster_pred] == pytest.approx(min(away))


def fitted(visits, k):
    with clusters.held_positions(visits) as points:
        return clusters.fit(points, k)


def test_weights_stand_for_repeated_visits(spark, blobs):
    doubled = blobs.unionByName(blobs)
    labelled = clusters.assign(fitted(blobs, 3), blobs)
    per_visit = clusters.score(clusters.assemble(labelled))
    weighted = labelled.groupBy(*clusters.POSITION, "cluster_pred").agg(
        F.count(F.lit(1)).cast("double").alias("weight")
    )
    assert clusters.score(clusters.assemble(weighted)) == pytest.approx(per_visit)
    once, twice = fitted(blobs, 3), fitted(doubled, 3)
    assert twice.cost == pytest.approx(2 * once.cost)
    assert sorted(twice.centers) == sorted(once.centers)


def moments(points, centers):
    """Plain rounds of KMeans to the end; centres and cost."""
    x = np.array(points)
    c = np.array(centers)
    for _ in range(200):
        label = ((x[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)
        c = np.array([x[label == j].mean(axis=0) if (label == j).any() else c[j] for j in range(len(c))])
    return c, ((x[:, None] - c) ** 2).sum(axis=2).min(axis=1).sum()


def test_centres_rest_where_plain_rounds_do(blobs):
    points = [(r.lat_visit, r.lon_visit) for r in blobs.collect()]
    with clusters.held_positions(blobs) as held:
        for s in clusters.sweep(held):
            centers, cost = moments(points, s["model"].centers)
            assert np.allclose(centers, s["model"].centers, atol=1e-5)
            assert s["cost"] == pytest.approx(cost, rel=1e-6)


def test_scores_of_a_sweep_equal_single_evaluators(spark, blobs):
    doubled = blobs.unionByName(blobs.limit(30))
    with clusters.held_positions(doubled) as points:
        scores = clusters.sweep(points)
    for s in scores:
        labelled_ = clusters.assign(s["model"], doubled)
        assert s["silhouette"] == pytest.approx(clusters.score(clusters.assemble(labelled_)), abs=1e-9)
        plain = silhouette(labelled_, "cluster_pred", clusters.POSITION).first().silhouette
        assert s["silhouette"] == pytest.approx(plain, abs=1e-9)


def test_the_jobs_of_a_sweep_do_not_grow_with_k(spark, blobs, monkeypatch):
    """Seeding takes two jobs at most, each round one for all k, and scoring one."""
    counts = {}
    for most in (3, 10):
        turns = []
        real = kmeans.cluster_sums
        monkeypatch.setattr(kmeans, "cluster_sums", lambda *a: turns.append(len(a[3])) or real(*a))
        with clusters.held_positions(blobs) as points:
            clusters.sweep(points, most)
        monkeypatch.setattr(kmeans, "cluster_sums", real)
        assert turns == sorted(turns, reverse=True)
        counts[most] = len(turns)
    assert max(counts.values()) <= kmeans.ROUNDS + 1


def test_small_far_places_are_met(spark):
    """One position in a hundred thousand stands for a far place that a sample by weight
    would hardly meet."""
    near = spark.range(100_000).selectExpr(
        "'d' AS device_id", "'2024-01-01 00:00:00' AS date_visit",
        "10 + pmod(xxhash64(id), 1000) / 10000 AS lat_visit", "pmod(xxhash64(id, 1), 1000) / 10000 AS lon_visit",
    )
    far = frame(spark, [(60.0, 60.0), (-60.0, 80.0)])
    model = fitted(near.unionByName(far), 3)
    assert {tuple(round(v) for v in c) for c in model.centers} >= {(60, 60), (-60, 80)}


def test_a_grid_keeps_sums_exact(spark):
    """Sums over many orders of magnitude of weight, against whole-number arithmetic."""
    rng = random.Random(3)
    rows = [(rng.uniform(-80, 80), rng.uniform(-170, 170), float(rng.randint(1, 1 << 30))) for _ in range(3000)]
    frame_ = spark.createDataFrame(rows, "lat_visit double, lon_visit double, weight double")
    grid = kmeans.Grid.over([min(r[0] for r in rows), min(r[1] for r in rows), max(r[0] for r in rows), max(r[1] for r in rows)])
    center = {1: np.zeros((1, 2))}
    found = {
        n: kmeans.cluster_sums(frame_.repartition(n), clusters.POSITION, grid, center)[1][0][1:4] for n in (1, 7, 40)
    }
    whole = [[int(grid.whole(np.array([r[i]]), i)[0]) for r in rows] for i in range(2)]
    weight = [int(r[2]) for r in rows]
    want = (sum(weight), *[sum(a * b for a, b in zip(weight, w)) for w in whole])
    assert found[1] == found[7] == found[40] == want


def test_nothing_to_fit(spark):
    with clusters.held_positions(frame(spark, [(1.0, 1.0)]).limit(0)) as points:
        assert (points.distinct, points.visits) == (0, 0)
        with pytest.raises(ValueError):
            clusters.fit(points, 2)
    assert len(fitted(frame(spark, [(1.0, 1.0)] * 3), 4).centers) == 1


def test_fixed_centres(spark):
    df = frame(spark, [(0.0, 0.0), (4.0, 0.0), (2.0, 0.0), (9.0, 9.0)])
    out = clusters.assign_fixed(df, [(0.0, 0.0), (4.0, 0.0), (9.0, 8.0)])
    assert [r.cluster_pred for r in out.collect()] == [0, 1, 0, 2]
    assert {r.cluster_pred for r in clusters.assign_fixed(df, [(1.0, 1.0)]).collect()} == {0}
    with pytest.raises(ValueError):
        clusters.assign_fixed(df, [])
    with pytest.raises(ValueError):
        clusters.assign_fixed(df, [(1.0,)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def labelled(spark, n=300, k=9, d=3):
    rng = random.Random(2)
    rows = [(i % k if i % 50 else None, *[rng.gauss(i % k, 1.5) for _ in range(d)])
            for i in range(n)]
    rows.append((99, *[rng.gauss(0, 1) for _ in range(d)]))  # a cluster of one
    names = [f"x{i}" for i in range(d)]
    return spark.createDataFrame(rows, "c int, " + ", ".join(f"{x} double" for x in names)), rows, names


def brute_force(rows):
    points = [r for r in rows if r[0] is not None]
    scores = []
    for i, p in enumerate(points):
        sums = {}
        for j, q in enumerate(points):
            if i != j:
                total, n = sums.get(q[0], (0.0, 0))
                away = sum((a - b) ** 2 for a, b in zip(p[1:], q[1:]))
                sums[q[0]] = (total + away, n + 1)
        if p[0] not in sums:
            scores.append(0.0)
            continue
        a = sums[p[0]][0] / sums[p[0]][1]
        b = min(t / n for c, (t, n) in sums.items() if c != p[0])
        scores.append((b - a) / max(a, b))
    return sum(scores) / len(scores)


@pytest.mark.parametrize(
    "options",
    [{"generated_terms": 1000}, {"generated_terms": 0},
     {"clusters_per_pass": 3, "generated_terms": 1000},
     {"clusters_per_pass": 3, "generated_terms": 0}],
)
def test_silhouette_forms(spark, options):
    df, rows, names = labelled(spark)
    value = silhouette(df, "c", names, **options).first().silhouette
    assert value == pytest.approx(brute_force(rows), abs=1e-9)


def test_silhouette_equals_the_evaluator(spark):
    df, _, names = labelled(spark)
    known = df.filter("c is not null and c <> 99")
    ours = silhouette(known, "c", names).first().silhouette
    library = clusters.assemble(known, names).withColumnRenamed("c", "cluster_pred")
    assert ours == pytest.approx(clusters.score(library), abs=1e-9)


def test_silhouette_without_points(spark):
    df, _, names = labelled(spark)
    assert silhouette(df.limit(0), "c", names).first().silhouette is None


def tight(spark, spread, copies=1):
    """Three blobs a few metres apart, far from the origin, each point repeated."""
    rng = random.Random(9)
    points = [
        (53.55 + 4 * spread * c + rng.gauss(0, spread / 20), -2.4333 + rng.gauss(0, spread / 20))
        for c in range(3)
        for _ in range(60)
    ]
    rows = [("d", "2024-01-01 00:00:00", *p) for p in points]
    return spark.createDataFrame(rows * copies, SCHEMA), points


@pytest.mark.parametrize(("spread", "copies"), [(1e-4, 1), (1e-4, 200), (1e-5, 200), (1e-6, 50)])
def test_tight_positions_keep_their_score_and_k(spark, spread, copies):
    df, points = tight(spark, spread, copies)
    assert clusters.select_k(df, max_k=6) == 3
    labelled_ = clusters.cluster(df, max_k=6).cache()
    value = silhouette(labelled_, "cluster_pred", clusters.POSITION).first().silhouette
    rows = [(i // 60, *p) for i, p in enumerate(points)]
    if copies == 1:
        assert value == pytest.approx(brute_force(rows), abs=1e-6)
    assert 0.9 < value <= 1


def test_null_and_nan_points_leave_both_forms_alike(spark):
    rows = [(0, 1.0, 1.0), (0, 1.1, 1.0), (1, 5.0, 5.0), (1, 5.1, 5.0), (1, None, 5.0), (0, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "c int, x double, y double")
    want = brute_force(rows[:4])
    for terms in (0, 1000):
        value = silhouette(df, "c", ["x", "y"], generated_terms=terms).first().silhouette
        assert value == pytest.approx(want, abs=1e-9)


def test_scores_that_are_not_finite_are_left_out():
    scores = [{"k": 2, "cost": 1.0, "silhouette": 0.5}, {"k": 3, "cost": 1.0, "silhouette": None}]
    assert clusters.pick(scores) == 2


def test_fits_do_not_depend_on_tasks(spark):
    """Equal centres, costs and scores to the last digit, whatever the partitions."""
    rng = random.Random(11)
    points = [(53 + rng.random(), -2 + rng.gauss(0, 1)) for _ in range(3000)]
    visits = frame(spark, points + points[:700])
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in ("1", "8", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            with clusters.held_positions(visits.repartition(int(n))) as held:
                assert held.rows.rdd.getNumPartitions() == int(n)
                found.append([s["model"].centers for s in clusters.sweep(held, 7)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert found[0] == found[1] == found[2]


def test_several_labellings_in_shared_passes(spark):
    df, rows, names = labelled(spark)
    df = df.withColumns({"half": F.col("c") % 2, "text": F.concat(F.lit("t"), F.col("c") % 3), "one": F.lit(1)})
    none = df.withColumn("never", F.lit(None).cast("int"))
    for options in ({}, {"generated_terms": 0}, {"clusters_per_pass": 4}):
        got = silhouettes(none, ["c", "half", "text", "one", "never"], names, **options).first()
        for name in ("c", "half", "text"):
            alone = silhouette(df, name, names).first().silhouette
            assert got[name] == pytest.approx(alone, abs=1e-9)
        assert got["one"] == 0 and got["never"] is None
    assert got["c"] == pytest.approx(brute_force(rows), abs=1e-9)
    empty = silhouettes(df.limit(0), ["c", "half"], names).collect()
    assert [tuple(r) for r in empty] == [(None, None)]


def test_saved_models_come_back(spark, blobs, tmp_path):
    model = clusters.fit_best(blobs, max_k=3)
    model.save(str(tmp_path / "m"))
    again = clusters.PositionModel.load(str(tmp_path / "m"))
    assert again == model
    model.save(str(tmp_path / "m"))
