"""Quality rules in SQL functions: surface rules, then a hashed n-gram log-likelihood ratio.

Base statistics of every whole text decide ``base_failed``. The rest is judged by two
multinomials over hashed one- and two-word sequences: one of the trusted documents (label
quality 1), one of all documents. A text's ratio is the sum over its n-grams of
``log(p_trusted / p_raw)``, divided by their number; it is kept when the ratio reaches a
fixed threshold. Nothing is drawn at random.

Only DataFrame functions run here. The table of bucket weights has a fixed number of
buckets, so it goes to the tasks as one constant whatever the number of documents.

Defined results: a NULL or empty text has no words, fails the base rules and is not kept.
Without trusted documents the ratio is 0 for every text, which is kept. Repeated rows are
judged each, and count each in the corpus model. Texts of any length are read whole. Other
columns are left aside, whatever their names.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdgrid.llm.common import let, words_of

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 14
# A mean log ratio per n-gram below this drops a text. Labelled good texts of 20 words and more
# lie around 0 with a deviation of 0.01 to 0.04, so this is far below them.
THRESHOLD = -0.1
# Added to every bucket's count, so that no weight is infinite.
SMOOTHING = 1.0


def _repeat_words(words: Column, window: int) -> Column:
    """Words in a window of ``window`` words that is found twice or more in the text.

    Windows are compared by a 64-bit hash of the hashes of their words. Texts whose window
    hashes are all distinct end there. For the others the hashes are sorted with their
    places, those equal to a neighbour are kept, and their places, in order, are added up
    without counting a word twice.
    """
    place = F.struct
    total = F.size(words)

    def windows(hashed: Column) -> Column:
        last = F.size(hashed) - window
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(hashed, i + 1, window)))

    def covered(keys: Column) -> Column:
        placed = F.array_sort(F.transform(keys, lambda h, i: place(h.alias("h"), i.alias("i"))))

        def repeated(sorted_: Column) -> Column:
            def twin(x: Column, i: Column) -> Column:
                before = F.get(sorted_, i - 1)["h"]
                after = F.get(sorted_, i + 1)["h"]
                return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(
                    after == x["h"], F.lit(False)
                )

            return F.array_sort(F.transform(F.filter(sorted_, twin), lambda x: x["i"]))

        def summed(places: Column) -> Column:
            spans = F.transform(
                places,
                lambda p, i: F.least(F.lit(window), F.coalesce(F.get(places, i + 1) - p, F.lit(window))),
            )
            return F.aggregate(spans, F.lit(0), lambda a, s: a + s)

        return let(let(placed, repeated), summed)

    def from_keys(keys: Column) -> Column:
        distinct = F.size(F.array_distinct(keys)) == F.size(keys)
        return F.when(distinct, F.lit(0)).otherwise(covered(keys))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(total < window, F.lit(0)).otherwise(let(let(hashes, windows), from_keys))


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the words and the base columns of every row; other columns are not read."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.translate("text", " \t\n\x0b\x0c\r", "")
    lines = F.filter(
        F.split("text", "\n"), lambda line: F.length(F.translate(line, " \t\n\x0b\x0c\r", "")) > 0
    )
    return (
        docs.select("doc_id", text.alias("text"))
        .withColumn("words", words_of(F.col("text")))
        .select(
            "doc_id",
            "words",
            F.size("words").cast("long").alias("n_words"),
            F.length(bare).cast("long").alias("word_chars"),
            (F.length("text") - F.length(F.translate("text", SYMBOLS, "")))
            .cast("long")
            .alias("n_symbols"),
            let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))
            .cast("long")
            .alias("n_dup_lines"),
            _repeat_words(F.col("words"), WINDOW).cast("long").alias("n_repeat_words"),
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def hashed_grams(words: Column, buckets: int = BUCKETS) -> Column:
    """The buckets of the one- and two-word sequences of a text, repeats included."""

    def grams(hashed: Column) -> Column:
        ones = F.transform(hashed, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
        twos = F.transform(
            F.slice(hashed, 1, F.greatest(F.size(hashed) - 1, F.lit(0))),
            lambda h, i: F.pmod(F.xxhash64(h, F.get(hashed, i + 1)), F.lit(buckets)).cast("int"),
        )
        return F.concat(ones, twos)

    return let(F.transform(words, lambda w: F.xxhash64(w)), grams)


def bucket_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n_raw, n_trusted over every n-gram of every text.

    ``trusted`` has one row per trusted doc_id. Counts combine in the tasks, so each sends
    at most one row per bucket, however common a word is.
    """
    marked = (
        docs.select("doc_id", "text")
        .join(trusted.withColumn("_trusted", F.lit(1)).hint("shuffle_hash"), "doc_id", "left")
        .select(
            F.coalesce("_trusted", F.lit(0)).alias("trusted"),
            F.explode(hashed_grams(words_of(F.col("text")), buckets)).alias("bucket"),
        )
    )
    return marked.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_raw"), F.sum("trusted").cast("long").alias("n_trusted")
    )


def trusted_documents(labels: DataFrame) -> DataFrame:
    """The documents labelled as good and never as bad, one row each."""
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    return known.groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")


def weights(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> list[float]:
    """Log ratios by bucket; the driver receives at most one row per bucket."""
    raw, good = [0] * buckets, [0] * buckets
    for r in counts.collect():
        raw[r["bucket"]], good[r["bucket"]] = r["n_raw"], r["n_trusted"]
    if not sum(good):
        return [0.0] * buckets
    all_raw, all_good = sum(raw) + smoothing * buckets, sum(good) + smoothing * buckets
    return [
        round(math.log((g + smoothing) / all_good) - math.log((r + smoothing) / all_raw), 6)
        for g, r in zip(good, raw)
    ]


def ratio(words: Column, by_bucket: list[float], buckets: int = BUCKETS) -> Column:
    """Length-normalised log-likelihood ratio of a text's n-grams."""
    table = F.from_json(F.lit(json.dumps(by_bucket)), "array<double>")

    def mean(grams: Column) -> Column:
        total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(table, g))
        return F.when(F.size(grams) == 0, F.lit(0.0)).otherwise(total / F.size(grams))

    return let(hashed_grams(words, buckets), mean)


def judge(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS
) -> DataFrame:
    """Base columns, ratio and verdict of every row of ``docs``."""
    by_bucket = weights(bucket_counts(docs, trusted_documents(labels), buckets), buckets)
    return (
        base_statistics(docs)
        .withColumn("log_ratio", ratio(F.col("words"), by_bucket, buckets))
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= F.lit(threshold)))
        .drop("words")
    )
