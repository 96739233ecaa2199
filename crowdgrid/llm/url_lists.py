"""URL filters from dated lists, in SQL functions.

A list is a history: on some day an entry is put on it ("add") or taken off ("remove"). The
history becomes validity intervals, half open in days. A capture carries the day it was
fetched; an as-of join finds, for each of its keys, the newest change not after that day.
Keys of a capture are its normalised url and every domain suffix of its host. Of the
entries in force the longest decides: a url over a domain, a longer domain over a shorter.

Captures are first reduced to distinct urls and days, then to distinct keys and days, so a
host that holds a third of all captures costs one row per day in the as-of join. Only urls,
keys and days are shuffled, never pages.

Defined results: a capture without a url or without a day matches nothing and is not
blocked. Repeated captures are judged each. Of several changes of one entry on one day the
action that sorts last ("remove") counts; an entry with a NULL field is ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdgrid.session import materialise


def normalised(url: Column) -> Column:
    """The url without scheme, user, port, query and fragment; host in lower case and
    without "www."; no slash at the end. NULL where there is no host."""
    bare = F.regexp_replace(F.trim(url), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, "[?#].*$", "")
    host = F.lower(F.regexp_replace(F.split(bare, "/")[0], "^.*@", ""))
    host = F.regexp_replace(F.regexp_replace(host, ":[0-9]*$", ""), "^www[.]", "")
    path = F.regexp_replace(F.regexp_extract(bare, "(/.*)$", 1), "/+$", "")
    return F.when(host != "", F.concat(host, path))


def host_of(normal: Column) -> Column:
    return F.split(normal, "/")[0]


def domain_suffixes(host: Column) -> Column:
    """The host and every domain above it, the longest first."""
    parts = F.split(host, "[.]")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."),
    )


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals of a list history (key, action, day, reason).

    Columns key, valid_from, valid_to (NULL while in force), reason.
    """
    usable = entries.filter("key IS NOT NULL AND day IS NOT NULL AND action IN ('add', 'remove')")
    # One change a day: the action that sorts last, and of its reasons the one that does.
    daily = (
        usable.groupBy("key", "day")
        .agg(F.max(F.struct("action", F.coalesce("reason", F.lit("")).alias("reason"))).alias("c"))
        .select("key", "day", "c.action", "c.reason")
    )
    history = Window.partitionBy("key").orderBy("day")
    changes = daily.withColumn("was", F.lag("action").over(history)).filter(
        (F.col("action") == "add") & (F.coalesce("was", F.lit("remove")) == "remove")
        | (F.col("action") == "remove") & (F.col("was") == "add")
    )
    return (
        changes.withColumn("valid_to", F.lead("day").over(history))
        .filter("action = 'add'")
        .select("key", F.col("day").alias("valid_from"), "valid_to", "reason")
    )


def capture_keys(visits: DataFrame) -> DataFrame:
    """url, day and one row per key, with the rank of the key (a url ranks highest)."""
    usable = visits.select("url", "day", normalised(F.col("url")).alias("normal"))
    suffixes = domain_suffixes(host_of(F.col("normal")))
    keys = F.transform(suffixes, lambda s: F.struct(s.alias("key"), F.length(s).alias("rank")))
    whole = F.struct(
        F.concat(F.lit("url:"), F.col("normal")).alias("key"), F.lit(1 << 30).alias("rank")
    )
    return (
        usable.filter("normal IS NOT NULL AND day IS NOT NULL")
        .withColumn("k", F.explode(F.concat(keys, F.array(whole))))
        .select("url", "day", "k.key", "k.rank")
    )


def as_of(wanted: DataFrame, valid: DataFrame) -> DataFrame:
    """The interval in force for each distinct (key, day), where there is one.

    Both sides are put in order of day by key; the newest start at or before a day is
    carried to it. No day is compared with more than its own key's history, and each row
    is read once.
    """
    starts = valid.select(
        "key",
        F.col("valid_from").alias("day"),
        F.struct("valid_from", "valid_to", "reason").alias("entry"),
        F.lit(0).alias("side"),
    )
    asks = wanted.select("key", "day", F.lit(None).cast(starts.schema["entry"].dataType).alias("entry"), F.lit(1).alias("side"))
    running = (
        Window.partitionBy("key").orderBy("day", "side").rowsBetween(Window.unboundedPreceding, 0)
    )
    found = starts.unionByName(asks).withColumn("now", F.last("entry", ignorenulls=True).over(running))
    return found.filter(
        (F.col("side") == 1)
        & F.col("now").isNotNull()
        & (F.col("now.valid_to").isNull() | (F.col("day") < F.col("now.valid_to")))
    ).select("key", "day", "now.valid_from", "now.reason")


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """capture_id, url, day, blocked, matched_key, valid_from and reason of every capture.

    ``captures`` has capture_id, url and day; ``entries`` has key, action, day and reason.
    A key is a domain, or "url:" and a normalised url. Captures of one url on one day are
    judged once.
    """
    valid = intervals(entries)
    keys = capture_keys(captures.select("url", "day").distinct())
    # Stored, so that the days of a crowded key are made distinct before they are dealt by key.
    days = materialise(keys.select("key", "day").distinct())
    # Keys that were never listed leave before the as-of join.
    listed = days.join(valid.select("key").distinct(), "key", "left_semi")
    force = as_of(listed, valid)
    hits = (
        keys.join(force, ["key", "day"])
        .groupBy("url", "day")
        .agg(F.max(F.struct("rank", "key", "valid_from", "reason")).alias("hit"))
    )
    judged = captures.select("capture_id", "url", "day").join(hits, ["url", "day"], "left")
    return judged.select(
        "capture_id",
        "url",
        "day",
        F.col("hit").isNotNull().alias("blocked"),
        F.col("hit.key").alias("matched_key"),
        F.col("hit.valid_from").alias("valid_from"),
        F.col("hit.reason").alias("reason"),
    )
