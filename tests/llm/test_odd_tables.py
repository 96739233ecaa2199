"""Every operator over tables that bring columns with clashing names, and very long texts."""

import hashlib
import inspect
import re

import brute
import pytest
from pyspark.sql import functions as F

from crowdgrid.llm import (
    fingerprints,
    mixing,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    repeated_passages,
    token_counts,
    token_files,
)

PHRASE = " ".join(f"w{n}" for n in range(60))
LABELS = [(n, n % 2) for n in range(1, 9)]


def _documents(spark):
    rows = [(n, f"word{n} {PHRASE} and the end of number {n}", "ab"[n % 2]) for n in range(1, 7)]
    rows += [(7, None, None), (8, "", "a"), (9, "one two three", "b"), (9, "one two three", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def _labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int")


OPERATORS = {
    "mixing": (mixing, lambda docs, labels: mixing.mixed_order(docs)),
    "quality_rules": (quality_rules, quality_rules.judge),
    "near_duplicates": (
        near_duplicates, lambda docs, labels: near_duplicates.near_duplicates(docs, words=3, percent=85)
    ),
    "quality_classifier": (quality_classifier, quality_classifier.classify),
    "fingerprints": (fingerprints, lambda docs, labels: fingerprints.compare_with_edits(docs)),
    "packing": (packing, lambda docs, labels: packing.pieces(docs)),
    "repeated_passages": (repeated_passages, lambda docs, labels: repeated_passages.find_repeats(docs)),
    "token_counts": (token_counts, lambda docs, labels: token_counts.count_tokens(docs)),
    "token_files": (
        token_files, lambda docs, labels: token_files.document_checks(token_files.write_files(docs))
    ),
}


def _rows(df):
    """The rows without columns that may differ between equal runs."""
    return sorted(repr(r.asDict()) for r in df.drop("file", "path").collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_with_clashing_names_change_nothing(spark, name):
    """The table brings a column for every name that stands in the operator's code."""
    module, operator = OPERATORS[name]
    docs, labels = _documents(spark), _labels(spark)
    used = {n.lower() for n in re.findall(r"[\"']([A-Za-z_]\w*)[\"']", inspect.getsource(module))}
    extra = sorted(used - {"doc_id", "text", "source"}) + ["llm_key", "llm_slot", "value", "key"]
    crowded = docs.select("*", *(F.lit("x").alias(n) for n in dict.fromkeys(extra)))
    assert _rows(operator(crowded, labels)) == _rows(operator(docs, labels))


def _long_text(spark):
    # 50,000 different words; what a task hands to the driver stays below a megabyte.
    words = [f"x{n * 7919 % 100_003}" for n in range(50_000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "more"])), (3, "y" * 3_000_000), (4, "short text")]
    return spark.createDataFrame(rows, "doc_id long, text string"), dict(rows)


def test_very_long_texts_are_judged_whole(spark):
    docs, texts = _long_text(spark)
    got = {r.doc_id: r for r in quality_rules.judge(docs, _labels(spark)).collect()}
    scored = {r.doc_id: r for r in quality_classifier.classify(docs, _labels(spark)).collect()}
    for doc_id, text in texts.items():
        words = brute.words(text)
        assert got[doc_id].n_words == len(words)
        assert got[doc_id].word_chars == sum(map(len, words))
        assert 0 <= scored[doc_id].score <= 1
    assert got[1].n_repeat_words == 0 and not got[1].base_failed


def test_very_long_texts_are_linked_and_cut_whole(spark):
    docs, texts = _long_text(spark)
    found = near_duplicates.near_duplicates(docs, words=3, percent=85)
    near = {r.doc_id: r for r in found.collect()}
    assert [near[n].component_id for n in (1, 2, 3, 4)] == [1, 1, 3, 4]
    assert near[1].n_shingles == len({*zip(*(texts[1].split()[n:] for n in range(3)))})
    found = repeated_passages.find_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
    cut = {r.doc_id: r for r in found.collect()}
    assert (cut[1].n_words, cut[1].n_removed) == (50_000, 50_000)
    assert (cut[2].n_words, cut[2].n_removed) == (50_001, 50_000)
    assert cut[2].kept_sha256 == hashlib.sha256(b"more").hexdigest()
    assert (cut[3].n_removed, cut[4].n_removed) == (0, 0)


def test_very_long_texts_are_counted_and_printed_whole(spark):
    docs, texts = _long_text(spark)
    printed = {r.doc_id: r for r in fingerprints.compare_with_edits(docs).collect()}
    counted = {r.doc_id: r for r in token_counts.count_tokens(docs).collect()}
    assert set(counted) == set(texts)
    for doc_id, text in texts.items():
        assert printed[doc_id].n_chars == len(text)
    assert printed[2].near_next > 0.9  # the next by falling id is the first
