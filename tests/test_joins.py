import pytest
from pyspark.sql import functions as F

from tallyspark.operators import joins
from tests.conftest import rows


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(0, 3000, 1, 6).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))
        ).alias("k"),
        (F.col("id") % 10).alias("day"),
    )
    right = spark.createDataFrame(
        [("hot", "h1", 0, 5), ("hot", "h2", 5, 10)] + [(f"k{i}", f"v{i}", 0, 10) for i in range(0, 50, 2)],
        "rk string, value string, lo bigint, hi bigint",
    )
    return left, right


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain(sides, how):
    left, right = sides
    inside = (F.col("day") >= F.col("lo")) & (F.col("day") < F.col("hi"))
    plain = left.join(right, (F.col("k") == F.col("rk")) & inside, how)
    salted = joins.salted_join(left, right, "k", "rk", ["id"], how=how, condition=inside)
    assert rows(salted.select(plain.columns)) == rows(plain)


def test_lookup_falls_back_to_salting(sides):
    left, right = sides
    right = right.where("lo = 0")
    small = joins.lookup_join(left, right, "k", "rk", ["id"])
    large = joins.lookup_join(left, right, "k", "rk", ["id"], max_broadcast_rows=1)
    assert rows(small) == rows(large.select(small.columns))


def test_multi_key_lookup_both_ways(sides):
    left, right = sides
    left = left.withColumn("d", F.col("day") % 2)
    right = right.where("value <> 'h2'").withColumn("e", F.lit(0).cast("bigint"))
    keys = [("k", "rk"), ("d", "e")]
    small = joins.multi_key_lookup(left, right, keys, ["id"])
    large = joins.multi_key_lookup(left, right, keys, ["id"], max_broadcast_rows=1)
    assert rows(small) == rows(large.select(small.columns))


def test_hot_keys_are_found_and_bounded(sides):
    left, _ = sides
    hot = {r.hot_key: r.salts for r in joins.hot_keys(left, "k", parts=20).collect()}
    assert "hot" in hot and hot["hot"] >= 6
    assert len(hot) <= 20


def test_hot_key_rows_spread_over_tasks(spark, sides):
    left, right = sides
    copies = left.where("k = 'hot'").select(F.lit(1).alias("id"), "k", "day").repartition(16)
    hot = joins.hot_keys(copies, "k", parts=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.salted_join(copies, right, "k", "rk", ["id"], parts=8, hot=hot)
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(per_task) == 2 * copies.count()
    assert max(per_task) < sum(per_task)


def test_rows_within(sides):
    left, _ = sides
    assert joins.rows_within(left, 3000)
    assert not joins.rows_within(left, 2999)
