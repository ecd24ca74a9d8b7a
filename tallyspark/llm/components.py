"""Connected components of a link table, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.tables import settle


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with a link; component is the smallest node reachable.

    Each step is two aggregations and joins and is stored; steps grow with the logarithm of the longest path. Nothing
    but a count and a checksum reaches the driver. Null ends and self-links are left out.
    """
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = settle(edges, "links")
    state = _state(edges)
    while True:
        both = edges.select(F.col("u").alias("node"), F.col("v").alias("other")).unionByName(
            edges.select(F.col("v").alias("node"), F.col("u").alias("other"))
        )
        lowest = both.groupBy("node").agg(F.min("other").alias("m")).withColumn("m", F.least("m", "node"))
        large = both.join(lowest, "node").where(F.col("other") > F.col("node")).select(F.col("other").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), checksum).first())


def grouped(
    members: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    alike: Callable[[str, str], Column] | None = None,
    sketched: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(node, component) over confirmed links among members that share a key.

    members: key, rep and what `alike` reads. `confirm` keeps the links among pairs (a, b), a < b. First each member is
    compared with the smallest of its key's group, at a cost linear in the group. Where a group's members are then
    still in different components, its pairs across components are compared, those for which `alike` can't rule a link
    out; `sketched` may add columns for it to these members. So every candidate pair is confirmed, ruled out, or joined
    already, and no group is gathered in one task.
    """
    shared = members.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("last")).where("centre < last")
    held = settle(members.join(shared.select("key", "centre"), "key"), "members")
    stars = held.where("rep > centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    stars = settle(stars, "stars")
    links = settle(confirm(stars), "confirmed")
    component = connected(links, "a", "b")

    placed = held.drop("centre").join(component, F.col("rep") == F.col("node"), "left").drop("node")
    placed = placed.withColumn("component", F.coalesce("component", "rep"))
    split = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    open_groups = settle(placed.join(split, "key", "left_semi"), "open")
    if sketched:
        sketches = settle(sketched(open_groups.select("rep").distinct()), "sketches")
        open_groups = open_groups.join(sketches.withColumnRenamed("rep", "_rep"), F.col("rep") == F.col("_rep")).drop("_rep")
    p, q = open_groups.alias("p"), open_groups.alias("q")
    meets = (F.col("p.key") == F.col("q.key")) & (F.col("p.component") < F.col("q.component"))
    across = p.join(q, meets & alike("p", "q") if alike else meets)
    across = across.select(F.least("p.rep", "q.rep").alias("a"), F.greatest("p.rep", "q.rep").alias("b")).distinct()
    across = settle(across.join(stars, ["a", "b"], "left_anti"), "across")
    return connected(links.unionByName(confirm(across)), "a", "b")
