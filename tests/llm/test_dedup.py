"""Near-duplicates and repeated passages against brute force."""

import random

import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crowdgrid.llm import near_duplicates, repeated_passages
from crowdgrid.llm.common import table
from crowdgrid.session import BATCH_BYTES

SCHEMA = "doc_id long, text string"


def _copies(seed, families=6, each=40, words=60):
    """Families of near copies with growing numbers of edits, among unrelated texts."""
    r = random.Random(seed)

    def text(n):
        return [f"w{r.randrange(4000)}" for _ in range(n)]

    rows = []
    for f in range(families):
        base = text(words + 30 * f)
        for c in range(each):
            copy = list(base)
            for _ in range(c % 9):
                copy[r.randrange(len(copy))] = f"e{r.randrange(10**6)}"
            rows.append(" ".join(copy))
        rows += [" ".join(base)] * 5
    rows += [" ".join(text(r.randrange(1, 90))) for _ in range(100)]
    return list(enumerate(rows))


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two"),
    (5, "ONE Two"),
    (5, "ONE Two"),
    (None, "one two"),
    (None, "nobody else says this here"),
    (7, "É é à word"),
    (8, "é é à word"),
    (9, "a " * 3000),
    (10, "a b " * 3000),
]


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_groups_of_the_documents(spark, sf_dir, words, percent):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    want = sorted(brute.groups([tuple(r) for r in docs.collect()], words, percent))
    got = near_duplicates.near_duplicates(docs, words, percent)
    assert sorted(tuple(r)[:3] for r in got.collect()) == want


def test_groups_of_large_families(spark):
    rows = _copies(1)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = near_duplicates.near_duplicates(docs, 3, 85)
    assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(brute.groups(rows, 3, 85))


def test_copies_that_only_their_original_links(spark):
    r = random.Random(3)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for c in range(400):
        copy = list(base)
        # Apart from each other, as no two edits share a shingle: 0.90 to the original, 0.81 between copies.
        for at in r.sample(range(3, 397, 4), 7):
            copy[at] = f"e{c}x{at}"
        rows.append(" ".join(copy))
    rows = list(enumerate([*rows, " ".join(base)]))
    want = sorted(brute.groups(rows, 3, 85))
    assert {c for _, _, c in want} == {0}
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, SCHEMA), 3, 85)
    assert sorted(tuple(x)[:3] for x in got.collect()) == want


def test_odd_texts_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    key = repr
    got = near_duplicates.near_duplicates(docs, 3, 85).collect()
    want = brute.groups(ODD, 3, 85)
    assert sorted((tuple(r)[:3] for r in got), key=key) == sorted(want, key=key)
    assert {r.kept for r in got if r.doc_id is None} == {False, True}


def test_one_of_each_group_stays_with_all_columns(spark):
    docs = spark.createDataFrame(ODD, SCHEMA).withColumn("llm_key", F.lit(1)).withColumn("rep", F.lit(2))
    kept = near_duplicates.keep_one(docs, 3, 85)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, (r.text or "")[:12]) for r in kept.collect()), key=repr)
    # 4, 5, 5 and a NULL id are one group; 7 and 8 differ, as only A-Z are lower-cased.
    assert found == sorted(
        [(1, ""), (2, ""), (3, " \n\t "), (4, "one two"), (None, "nobody else "), (7, "É é à word"),
         (8, "é é à word"), (9, "a a a a a a "), (10, "a b a b a b ")], key=repr
    )


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)]
    got = near_duplicates.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {
        **{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 40)}
    }


def test_texts_go_to_python_a_few_mb_at_a_time(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    wide = spark.range(3000, numPartitions=1).select(F.expr("repeat('word ', 2000) AS text"))
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    try:
        spark.conf.unset(BATCH_BYTES)
        near_duplicates.keep_one(docs).collect()
        largest = wide.mapInArrow(sizes, "bytes long").agg(F.max("bytes")).first()[0]
        assert largest < 6 << 20
        spark.conf.set(BATCH_BYTES, "2m")
        assert near_duplicates.keep_one(docs).count() == 2
        assert spark.conf.get(BATCH_BYTES) == "2m"
    finally:
        spark.conf.unset(BATCH_BYTES)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near_duplicates.near_duplicates(docs).count() == 0
    assert near_duplicates.keep_one(docs).count() == 0
    assert repeated_passages.find_repeats(docs).count() == 0
    assert repeated_passages.remove_repeats(docs).count() == 0


def test_repeats_of_the_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    want = brute.repeats([tuple(r) for r in docs.collect()], 35)
    got = repeated_passages.find_repeats(docs).drop("spans")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def _passages(seed, window):
    """Texts that share passages just below, at and above the window, at any place."""
    r = random.Random(seed)
    passages = [[f"p{p}x{i}" for i in range(r.randrange(window - 3, 3 * window))] for p in range(8)]
    rows = []
    for d in range(80):
        text = []
        for _ in range(r.randrange(4)):
            text += [f"u{r.randrange(10**6)}" for _ in range(r.randrange(window))]
            p = r.choice(passages)
            start = r.randrange(len(p) // 2)
            text += p[start : start + r.randrange(window - 2, 2 * window)]
        rows.append((d, r.choice([" ", "\n", "  "]).join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_of_made_passages(spark, seed):
    rows = _passages(seed, 12)
    got = repeated_passages.find_repeats(spark.createDataFrame(rows, SCHEMA), 12).drop("spans")
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute.repeats(rows, 12))


def test_repeats_in_odd_texts(spark):
    loop = " ".join(f"w{i % 10}" for i in range(80))
    rows = [*ODD, (20, "x " * 34), (21, "x " * 36), (22, loop), (None, "z " * 40)]
    got = repeated_passages.find_repeats(spark.createDataFrame(rows, SCHEMA)).drop("spans")
    want = brute.repeats(rows, 35)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_cut_texts_keep_their_form_and_columns(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, f"a  b\n{passage} c\td", 9), (2, f"{passage}\nx", 9), (3, "left  alone\n", 9), (4, None, 9)]
    docs = spark.createDataFrame(rows, f"{SCHEMA}, n_chars int").withColumn("c1", F.lit("kept"))
    out = repeated_passages.remove_repeats(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    found = {r.doc_id: (r.text, r.n_chars, r.c1) for r in out.collect()}
    assert found == {
        1: ("a  b\nc\td", 8, "kept"), 2: ("x", 1, "kept"), 3: ("left  alone\n", 12, "kept"), 4: (None, None, "kept")
    }


def test_cut_texts_keep_columns_named_like_helpers(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = spark.createDataFrame([(1, passage + " a"), (2, passage + " b")], SCHEMA)
    for name in ("llm_spans", "llm_spans_1", "LLM_SPANS_2", "spans"):
        docs = docs.withColumn(name, F.col("doc_id") * 10)
    rows = repeated_passages.remove_repeats(docs).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [(1, "a", 10, 10, 10, 10), (2, "b", 20, 20, 20, 20)]
