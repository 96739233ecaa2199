"""The registered queries of the text operators, over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdgrid.llm import (
    fingerprints,
    main_text,
    mixing,
    near_duplicates,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    repeated_passages,
    token_counts,
    token_files,
    url_lists,
    whitening,
)
from crowdgrid.llm.common import table
from crowdgrid.llm.oracles import ORACLES as SQL


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_order(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def captures_and_lists(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures and a list history, both derived from the urls of all pages.

    A page was fetched on a day that follows from its id. Hosts whose first page has an id
    divisible by 3 are listed for 60 days, some once more later; every fifth page's url is
    listed from a day on.
    """
    first = F.lit("2024-01-01").cast("date")
    captures = pages.select(
        F.col("page_id").alias("capture_id"),
        "url",
        F.date_add(first, F.pmod(F.col("page_id") * 7, F.lit(365)).cast("int")).alias("day"),
    )
    normal = url_lists.normalised(F.col("url"))
    hosts = (
        pages.select(url_lists.host_of(normal).alias("key"), F.col("page_id").alias("n"))
        .groupBy("key")
        .agg(F.min("n").alias("n"))
        .filter("n % 3 = 0")
    )

    def on(days, action: str, reason: str, rows: DataFrame) -> DataFrame:
        return rows.select(
            "key",
            F.lit(action).alias("action"),
            F.date_add(first, days.cast("int")).alias("day"),
            F.lit(reason).alias("reason"),
        )

    start = F.col("n") % 200
    urls = pages.filter("page_id % 5 = 1").select(
        F.concat(F.lit("url:"), normal).alias("key"), F.col("page_id").alias("n")
    )
    entries = (
        on(start, "add", "spam", hosts)
        .unionByName(on(start + 60, "remove", "spam", hosts))
        .unionByName(on(start + 120, "add", "malware", hosts.filter("n % 2 = 0")))
        .unionByName(on(F.col("n") % 300, "add", "removed on request", urls))
    )
    return captures, entries


def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures, entries = captures_and_lists(table(spark, sf_dir, "pages").select("page_id", "url"))
    return url_lists.filter_captures(captures, entries)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, added=packing.added_tokens())


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages.find_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.planted(table(spark, sf_dir, "documents"))
    return periodic_runs.summarise(periodic_runs.find_runs(docs))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(
        vectors.select("vec_id", whitening.whole_entries(F.col("embedding")).alias("x"))
    )


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_files(table(spark, sf_dir, "documents"))
    return token_files.document_checks(files).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_mixing": op2_mixing,
    "op3_quality_rules": op3_quality_rules,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_url_lists": op6_url_lists,
    "op7_fingerprints": op7_fingerprints,
    "op8_packing": op8_packing,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_whitening": op12_whitening,
    "op13_token_files": op13_token_files,
}

# Given where SQL can say what the query returns; the tests hold the others against a
# brute-force version, an exact round trip or held-out accuracy.
ORACLES: dict[str, str] = SQL
