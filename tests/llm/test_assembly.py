"""Mixing, packing, url lists and the pipeline."""

import random
import zlib
from datetime import date, timedelta
from fractions import Fraction

import brute
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdgrid.llm import mixing, packing, url_lists
from crowdgrid.llm.common import table
from crowdgrid.llm.queries import QUERIES
from crowdgrid.session import materialise

DOCS = "doc_id long, text string, source string"


@pytest.mark.parametrize("seed", range(20))
def test_period_keeps_every_source_within_one_block(seed):
    r = np.random.default_rng(seed)
    parts = {f"s{i}": int(n) for i, n in enumerate(r.integers(1, 60, r.integers(1, 30)))}
    slots, length = mixing.period(parts), sum(parts.values())
    assert sorted(t for s in slots.values() for t in s) == list(range(length))
    for s, taken in slots.items():
        done = np.zeros(length + 1)
        done[np.array(taken) + 1] = 1
        away = np.cumsum(done) - np.arange(length + 1) * parts[s] / length
        assert np.abs(away).max() < 1


def test_phases_read_every_block_once():
    blocks = {"a": 5000, "b": 10, "c": 300, None: 77, "unweighted": 4}
    plan = mixing.phases(blocks, {"a": 1, "b": 5, "c": 2.5, None: 0.1}, parts=100)
    taken = {s: 0 for s in blocks}
    for phase in plan:
        for s, p in phase["sources"].items():
            assert p["first"] == taken[s]
            taken[s] += p["count"]
    assert taken == blocks
    assert [p["start"] for p in plan] == sorted({p["start"] for p in plan})


def test_in_parts_adds_up():
    parts = mixing.in_parts({"a": 1 / 3, "b": 1 / 3, "c": 1 / 3, "d": 1e-9}, 1000)
    assert sum(parts.values()) == 1000 and parts["d"] == 1


def test_exact_plan_does_not_drift():
    for weights in (
        {"a": 1 / 3, "b": 2 / 3},
        {"a": 0.9999, "b": 0.0001},
        {"a": 2**0.5, "b": 3**0.5, "c": 0.01, None: 7},
        {f"s{i}": (i + 1) ** 0.5 for i in range(60)},
    ):
        total, done = sum(weights.values()), dict.fromkeys(weights, 0)
        plan = mixing.exact_plan(dict.fromkeys(weights, 10**6), weights)
        for s, block, slot in (next(plan) for _ in range(20_000)):
            assert block == done[s]
            done[s] += 1
            for x in weights if slot % 97 == 0 or slot > 19_900 else ():
                assert abs(done[x] - weights[x] / total * (slot + 1)) < 1 + 1e-6
    blocks = {"a": 500, "b": 10, None: 77, "unweighted": 4}
    out = list(mixing.exact_plan(blocks, {"a": 1, "b": 5, None: 0.1}))
    assert [t for _, _, t in out] == list(range(591)) and len({x[:2] for x in out}) == 591
    assert [s for s, _, _ in out[-4:]] == ["unweighted"] * 4


def _shares(blocks, weights, slots):
    """What each source has read before each slot by its exact share, slot after slot."""
    left = {s: Fraction(n) for s, n in blocks.items()}
    for _ in range(slots + 1):
        yield {s: blocks[s] - n for s, n in left.items()}
        time = Fraction(1)
        while time and any(left.values()):
            live = [s for s in left if left[s]]
            total = sum(Fraction(weights[s]) for s in live)
            step = min(time, *(left[s] * total / Fraction(weights[s]) for s in live))
            for s in live:
                left[s] -= step * Fraction(weights[s]) / total
            time -= step


@pytest.mark.parametrize("seed", range(12))
def test_exact_plan_keeps_every_source_within_one_block(seed):
    draw = random.Random(seed)
    names = [None, *(f"s{i}" for i in range(draw.randint(0, 6)))]
    blocks = {s: draw.randint(1, 60) for s in names}
    weights = {s: draw.choice([1, 5, 1 / 3, 0.001, draw.random() + 1e-9]) for s in names}
    total, done = sum(blocks.values()), dict.fromkeys(names, 0)
    ideal = list(_shares(blocks, weights, total))
    plan = list(mixing.exact_plan(blocks, weights))
    assert [t for _, _, t in plan] == list(range(total))
    for s, block, slot in plan:
        assert block == done[s]
        done[s] += 1
        assert all(abs(done[x] - ideal[slot + 1][x]) < 1 for x in names)
    assert done == blocks


def test_mixing_follows_weights_that_are_no_whole_parts(spark):
    rows = [(i, f"text {i}", "a" if i < 4000 else "b") for i in range(13_000)]
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.mixed_order(docs, {"a": 1 / 3, "b": 2 / 3}, block_documents=1).collect()
    taken = {r.slot for r in out if r.source == "a"}
    assert len(out) == 13_000 and len({r.slot for r in out}) == 13_000
    done = 0
    for t in range(12_000):
        done += t in taken
        assert abs(done - (t + 1) / 3) < 1 + 1e-6


def test_mixing_takes_any_number_of_sources(spark):
    rows = [(i, f"text {i}", f"site{i % 1500}.org") for i in range(4000)]
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.mixed_order(docs, block_documents=2).collect()
    assert sorted((r.doc_id, r.source) for r in out) == [(i, s) for i, _, s in rows]
    slots = {(r.source, r.block): r.slot for r in out}
    assert sorted(slots.values()) == list(range(len(slots)))
    assert mixing.mix(docs).count() == 4000


def test_mixed_documents_keep_to_the_weights(spark):
    rows = [(i, f"text {i}", "big" if i % 3 else f"small{i % 5}") for i in range(3000)]
    docs = spark.createDataFrame([*rows, (None, None, None), (0, "text 0", "small0")], DOCS)
    weights = {"big": 0.5, "small0": 0.1, "small1": 0.1, "small2": 0.1, "small3": 0.1, "small4": 0.1}
    out = mixing.mixed_order(docs, weights, block_documents=4, parts=10).collect()
    assert len(out) == 3002
    blocks = {(r.source, r.block): r.slot for r in out}
    assert len(set(blocks.values())) == len(blocks)
    sizes = {}
    for r in out:
        sizes[r.source, r.block] = sizes.get((r.source, r.block), 0) + 1
    assert max(sizes.values()) == 4
    # Up to the first source's end every source is within a block of its share.
    first_end = min(max(t for (s, _), t in blocks.items() if s == x) for x in weights)
    for t in range(first_end):
        for s, w in weights.items():
            got = sum(1 for (x, _), u in blocks.items() if x == s and u < t)
            assert abs(got - w * t) < 1 + 1e-9
    assert next(t for (s, _), t in blocks.items() if s is None) == max(blocks.values())


def test_mixing_keeps_rows_and_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("llm_slot", F.lit(1)).withColumn("_key", F.lit(2))
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert sorted(tuple(r) for r in out.collect()) == sorted(tuple(r) for r in docs.collect())
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_does_not_depend_on_partitions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    one = sorted(tuple(r) for r in mixing.mixed_order(docs).collect())
    assert sorted(tuple(r) for r in mixing.mixed_order(docs.repartition(13)).collect()) == one


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_and_its_bound(seed):
    r = np.random.default_rng(seed)
    sizes = r.integers(1, 1024, 2000)
    bins = packing.best_fit_decreasing(sizes)
    filled = np.bincount(bins, weights=sizes)
    assert filled.max() <= 1024 and len(filled) == bins.max() + 1
    assert packing.lower_bound(sizes) <= len(filled) <= 11 / 9 * packing.lower_bound(sizes) + 1
    # A plain search for the fullest bin that still has room gives as many.
    rooms = []
    for s in sorted(sizes.tolist(), reverse=True):
        fit = [x for x in rooms if x >= s]
        if fit:
            rooms[rooms.index(min(fit))] -= s
        else:
            rooms.append(1024 - s)
    assert len(rooms) == len(filled)


def test_bounds_see_more_than_the_sum():
    assert packing.lower_bound(np.array([600] * 10)) == 10
    assert packing.lower_bound(np.array([513] * 7)) == 7
    assert packing.lower_bound(np.array([342] * 9)) == 5
    assert packing.lower_bound(np.array([400, 300, 324])) == 1


def _check_packed(rows, docs, capacity=1024):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = []
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        ends = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(ends, ends[1:])):
            want.append((d, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values(), default=0) <= capacity
    return len(at)


def test_packed_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = QUERIES["op8_packing"](spark, sf_dir).collect()
    used = _check_packed(rows, [tuple(r) for r in docs.collect()])
    assert used <= 1.02 * -(-sum(r.length for r in rows) // 1024) + 1


def test_packing_odd_texts(spark):
    docs = [(1, None), (2, ""), (2, ""), (None, "no id"), (5, "x" * 50000), (6, "<|endoftext|>  \n\n 你好 😀 it's")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("piece", F.lit(1))
    _check_packed(packing.pack_documents(df).collect(), docs)
    assert packing.pack_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("run", [" ", "\n", "a", "\t "])
def test_packing_runs_of_millions(spark, run):
    """As long as the dealt tokenizer takes them; ordinary words stand around."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "Some words " + run * (2_000_000 // len(run)) + "<|endoftext|> and more."
    for added in (packing.added_tokens(), None):
        tokenizer.encode_special_tokens = added is None
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        encoder = packing.Encoder(packing.default_tokenizer(), added)
        assert encoder.ids(text) == ids.tobytes()
    df = spark.createDataFrame([(1, text), (2, "plain")], "doc_id long, text string")
    assert {r.doc_id for r in packing.pack_documents(df).collect()} == {1, 2}


def test_packing_added_tokens_as_the_tokenizer_does(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end} x", f"word{end}word  \n{end}", "<|endoftext", f"你好 {end}é"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    want = [(d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in enumerate(ids)]
    docs = table(spark, str(tmp_path), "documents")
    for out in (
        QUERIES["op8_packing"](spark, str(tmp_path)),
        corpus_pipeline.pack(spark, docs, str(tmp_path)),
    ):
        assert sorted((r.doc_id, r.length, r.ids_crc32) for r in out.collect()) == want


def test_rounds_exchange_without_loss(spark):
    r = np.random.default_rng(1)
    rows = [(i, 0, 0, int(n), 0) for i, n in enumerate(r.integers(1, 1025, 3000))]
    parts = spark.createDataFrame(rows, packing.PIECES)
    out = packing.pack(parts, group_items=200).collect()
    assert sorted((x.doc_id, x.length) for x in out) == sorted((x[0], x[3]) for x in rows)
    filled = {}
    for x in sorted(out, key=lambda x: (x.sequence_id, x.offset)):
        assert x.offset == filled.get(x.sequence_id, 0)
        filled[x.sequence_id] = x.offset + x.length
    assert max(filled.values()) <= 1024
    once = {x.sequence_id for x in packing.pack(parts, group_items=200, rounds=1).collect()}
    assert len(filled) <= len(once)


def test_packing_keeps_the_mixed_order(spark, tmp_path):
    r = np.random.default_rng(3)
    docs = [(i, " ".join(["word"] * int(n)), "ab"[i % 2]) for i, n in enumerate(r.integers(0, 2500, 600))]
    docs += [(7, "one more", "a"), (7, "one more", "a"), (None, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    mixed = materialise(corpus_pipeline.mix(spark, df, str(tmp_path)))
    order = [x.doc_id for x in corpus_pipeline.mix(spark, df, str(tmp_path)).collect()]
    rows = corpus_pipeline.pack(spark, mixed, str(tmp_path)).collect()
    used = _check_packed(rows, [d[:2] for d in docs])
    assert used <= 1.03 * -(-sum(x.length for x in rows) // 1024) + 1
    assert [x.sequence_id for x in rows] == sorted(x.sequence_id for x in rows)
    once = [x for x in rows if x.doc_id not in (7, None)]
    at = np.array([order.index(x.doc_id) for x in once]).argsort(kind="stable").argsort()
    assert np.corrcoef(at, np.arange(len(once)))[0, 1] > 0.7


def test_rounds_in_order_lose_nothing(spark):
    r = np.random.default_rng(1)
    rows = [(i, 0, 0, int(n), 0, i) for i, n in enumerate(r.integers(1, 1025, 3000))]
    parts = spark.createDataFrame(rows, f"{packing.PIECES}, {packing.PLACE} long")
    out = packing.pack_in_order(parts, group_items=200).collect()
    assert sorted((x.doc_id, x.length) for x in out) == sorted((x[0], x[3]) for x in rows)
    filled, places = {}, {}
    for x in out:
        assert x.offset == filled.get(x.sequence_id, 0)
        filled[x.sequence_id] = x.offset + x.length
        places.setdefault(x.sequence_id, []).append(x.doc_id)
    assert max(filled.values()) <= 1024
    assert all(p[(len(p) - 1) // 2] == q and p == sorted(p) for q, p in places.items())
    once = packing.pack_in_order(parts, group_items=200, rounds=1).select("sequence_id").distinct()
    assert len(filled) <= once.count()


def _blocked(captures, entries):
    """Whether, and by which key, each capture is blocked: every entry's history replayed."""
    out = []
    for cid, url, day in captures:
        hit = None
        if url and day and (normal := _normal(url)):
            host = normal.split("/")[0].split(".")
            keys = [".".join(host[i:]) for i in range(len(host))]
            ranked = [(1 << 30, f"url:{normal}")] + [(len(k), k) for k in keys]
            for rank, key in ranked:
                changes = sorted({(e[2], e[1]) for e in entries if e[0] == key and e[2] and e[2] <= day})
                if changes and changes[-1][1] == "add":
                    hit = max(hit or (0, ""), (rank, key))
        out.append((cid, url, day, hit is not None, hit and hit[1]))
    return out


def _normal(url):
    bare = url.strip().split("://")[-1].split("?")[0].split("#")[0]
    host, slash, path = bare.partition("/")
    host = host.split("@")[-1].lower().split(":")[0].removeprefix("www.")
    return host + (slash + path).rstrip("/") if host else None


def test_url_lists_against_replay(spark):
    d0 = date(2024, 1, 1)
    r = np.random.default_rng(2)
    hosts = ["a.com", "b.a.com", "WWW.a.com", "c.net", "x.y.c.net", "a.com:80", "u@c.net"]
    captures = [
        (i, f"http://{hosts[r.integers(7)]}/{'p' * int(r.integers(3))}{'/?q' * int(r.integers(2))}",
         d0 + timedelta(int(r.integers(40))))
        for i in range(400)
    ]
    captures += [(900, None, d0), (901, "http://a.com", None), (901, "http://c.net", d0), (902, "", d0), (903, "://", d0)]
    keys = ["a.com", "b.a.com", "c.net", "net", "url:a.com/p", "url:c.net/pp", "zzz.org"]
    entries = [
        (keys[r.integers(7)], ["add", "remove"][r.integers(2)], d0 + timedelta(int(r.integers(40))), "r")
        for _ in range(60)
    ]
    entries += [(None, "add", d0, "r"), ("net", None, d0, "r"), ("net", "add", None, "r"), ("net", "allow", d0, "r")]
    usable = [e for e in entries if e[0] and e[1] in ("add", "remove") and e[2]]
    c = spark.createDataFrame(captures, "capture_id long, url string, day date").withColumn("key", F.lit(1))
    e = spark.createDataFrame(entries, "key string, action string, day date, reason string")
    got = url_lists.filter_captures(c, e).collect()
    found = [(x.capture_id, x.url, x.day, x.blocked, x.matched_key) for x in got]
    assert sorted(found, key=repr) == sorted(_blocked(captures, usable), key=repr)
    assert url_lists.filter_captures(c, e.limit(0)).filter("blocked").count() == 0
    assert url_lists.filter_captures(c.limit(0), e).count() == 0


def test_stages_keep_columns_and_good_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").cache()
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    names = docs.columns
    stages = [f for _, f in corpus_pipeline.STAGES]

    kept = stages[0](spark, docs, sf_dir).cache()
    assert kept.columns == names
    ids = {r.doc_id for r in kept.collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in ids for d in good) / len(good) > 0.95

    single = stages[1](spark, kept, sf_dir).cache()
    rows = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    assert single.columns == names
    assert sorted(r.doc_id for r in single.collect()) == sorted(
        {c for _, _, c in brute.groups(rows, 5, 80)}
    )

    cut = stages[2](spark, single, sf_dir).cache()
    assert cut.columns == names and cut.schema == docs.schema
    rows = [(r.doc_id, r.text) for r in single.select("doc_id", "text").collect()]
    want = {d: (n - gone) for d, n, gone, _ in brute.repeats(rows, 35)}
    assert {r.doc_id: len(brute.words(r.text)) for r in cut.collect()} == want

    mixed = stages[3](spark, cut, sf_dir)
    assert mixed.columns == names
    assert sorted(tuple(r) for r in mixed.collect()) == sorted(tuple(r) for r in cut.collect())

    rows = stages[4](spark, cut, sf_dir).collect()
    _check_packed(rows, [(r.doc_id, r.text) for r in cut.collect()])


def test_run_ends_with_packed_pieces(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns[:2] == ["doc_id", "piece"] and out.count() > 0
