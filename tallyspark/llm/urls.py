"""URL filters as of the fetch time.

A list is a log of dated changes: an entry is added, and may be removed and added again. For each entry its changes
become validity intervals, kept as one sorted history per pattern. A capture has a bounded number of patterns: its host
and the host's parent domains, and its address cut at each path segment. It joins each pattern's history once, and the
as-of step picks the last change at or before the fetch time. So a host with a third of all captures, or a pattern with
a long history, multiplies no rows: a capture stays one row per pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADD, REMOVE = "add", "remove"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)?", 1)


def patterns_of(url: Column) -> Column:
    """('domain', host and each parent) and ('prefix', host and path up to each segment), without repeats."""
    host, labels = host_of(url), F.split(host_of(url), r"\.")
    parts = F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("value")),
    )
    prefixes = F.transform(
        F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts))).otherwise(F.expr("array()").cast("array<int>")),
        lambda i: F.struct(F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")).alias("value")),
    )
    return F.when(host != "", F.array_distinct(F.concat(domains, prefixes)))


def histories(changes: DataFrame) -> DataFrame:
    """kind, value and the sorted intervals (from, until, active) of each pattern.

    changes: kind, value, changed_at, action. Changes of one pattern at one time count once, a removal last. Rows with
    a null in any of these say nothing.
    """
    known = changes.select("kind", "value", "changed_at", "action").dropna().where(F.col("action").isin(ADD, REMOVE))
    # One state per time: inactive if any change of that time removes.
    states = known.groupBy("kind", "value", "changed_at").agg((F.max("action") == ADD).alias("active"))
    changes_of = F.array_sort(F.collect_list(F.struct(F.col("changed_at").alias("from"), "active")))
    logs = states.groupBy("kind", "value").agg(changes_of.alias("log"))  # one list's history of one pattern
    until = F.transform(
        "log", lambda x, i: F.struct(x["from"].alias("from"), F.get("log", i + 1)["from"].alias("until"), x["active"].alias("active"))
    )
    return logs.select("kind", "value", until.alias("history"))


def judge(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """capture_id, fetched_at, n_active, first_match (smallest active 'kind:value'), blocked for every capture.

    captures: capture_id, url, fetched_at. A capture without a readable host, or without a fetch time, matches nothing.
    Rows that repeat capture_id, url and time return one row each with the same result. An empty list blocks nothing.
    """
    rows = captures.select("capture_id", "url", "fetched_at")
    keyed = rows.distinct().select("*", F.explode(patterns_of(F.col("url"))).alias("p"))
    log = histories(changes).withColumnsRenamed({"kind": "_kind", "value": "_value"})
    met = keyed.join(log, (F.col("p.kind") == F.col("_kind")) & (F.col("p.value") == F.col("_value")))
    begun = F.filter("history", lambda x: x["from"] <= F.col("fetched_at"))
    active = met.where(F.coalesce(F.try_element_at(begun, F.lit(-1))["active"], F.lit(False)))
    found = active.groupBy("capture_id", "url", "fetched_at").agg(
        F.count(F.lit(1)).alias("n_active"), F.min(F.concat_ws(":", "p.kind", "p.value")).alias("first_match")
    )
    found = found.withColumnsRenamed({"capture_id": "_id", "url": "_url", "fetched_at": "_at"})
    same = F.col("capture_id").eqNullSafe(F.col("_id")) & (F.col("url") == F.col("_url")) & (F.col("fetched_at") == F.col("_at"))
    return rows.join(found, same, "left").select(
        "capture_id", "fetched_at", F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"), "first_match",
        F.col("n_active").isNotNull().alias("blocked"),
    )


# The given tables have neither fetch times nor lists: both are derived from the pages.

START = "2024-01-01"
DAYS = 365


def drawn(text: Column) -> Column:
    """A number from 0 to 2 ** 28 - 1 that the text decides."""
    return F.conv(F.substr(F.md5(text.cast("binary")), F.lit(1), F.lit(7)), 16, 10).cast("bigint")


def dated_captures(pages: DataFrame) -> DataFrame:
    """capture_id, url and a fetch day that page_id decides."""
    day = F.pmod(drawn(F.concat(F.lit("fetch"), F.col("page_id").cast("string"))), F.lit(DAYS)).cast("int")
    return pages.select(
        F.col("page_id").alias("capture_id"), F.col("url").cast("string").alias("url"), F.date_add(F.lit(START).cast("date"), day).alias("fetched_at")
    )


def dated_changes(pages: DataFrame) -> DataFrame:
    """A list over the pages' own patterns; a pattern's text decides whether and when it is listed, and for how long."""
    patterns = pages.select(F.explode(patterns_of(F.col("url").cast("string"))).alias("p")).select("p.kind", "p.value").distinct()
    draw = drawn(F.concat_ws(":", "kind", "value"))
    day = lambda d: F.date_add(F.lit(START).cast("date"), F.pmod(d, F.lit(DAYS)).cast("int"))
    share = F.when(F.col("kind") == "domain", 5).otherwise(17)
    listed = patterns.withColumn("draw", draw).where(F.pmod(F.col("draw"), share) == 0)
    stay = (F.pmod(F.floor(F.col("draw") / 131), F.lit(90)) + 1).cast("int")
    added = day(F.floor(F.col("draw") / 7))
    changes = [
        F.struct(added.alias("changed_at"), F.lit(ADD).alias("action")),
        F.struct(F.date_add(added, stay).alias("changed_at"), F.lit(REMOVE).alias("action")),
        F.struct(F.date_add(added, stay * 2).alias("changed_at"), F.lit(ADD).alias("action")),
    ]
    return listed.select("kind", "value", F.explode(F.array(*changes)).alias("c")).select("kind", "value", "c.changed_at", "c.action")
