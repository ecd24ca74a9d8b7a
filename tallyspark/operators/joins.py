"""Joins that stay safe when one key holds a large share of the rows.

``lookup_join`` broadcasts the right side only after counting it. Past the limit
both sides are shuffled, and keys that hold more than 1/HOT_PARTS of the left rows
are spread over several salts, so no task receives a whole hot key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
HOT_PARTS = 400
SKETCH_ITEMS = 20_000
#: Rows a task holds where a caller asks for tasks cut by rows.
TASK_ROWS = 500_000


def rows_within(df: DataFrame, limit: int) -> bool:
    """Whether a table has at most ``limit`` rows.

    Asks for the row past the limit: Spark opens partitions a few at a time until it
    has seen that many rows, so a huge table is recognised from its first splits."""
    return not df.select(F.lit(1).alias("one")).offset(limit).take(1)


def hot_keys(df: DataFrame, key: str, parts: int = HOT_PARTS) -> DataFrame:
    """(hot_key, salts) for keys holding over 1/parts of the rows.

    One map-side-combined sketch pass over one column. At most ``parts`` keys can
    exceed the share, which bounds the result whatever the table size. The counts
    are estimates; they only decide how far a key is spread, never the result.
    """
    found, _ = _sketched(df, key, parts)
    return found


def _sketched(df: DataFrame, key: str, parts: int) -> tuple[DataFrame, int]:
    """The hot keys as values of a plan, and how many rows there are; both from one pass."""
    known = F.col(key).isNotNull()
    sketch = df.agg(
        F.expr(f"approx_top_k({key}, {parts}, {SKETCH_ITEMS}) FILTER (WHERE {key} IS NOT NULL)").alias("top"),
        F.count_if(known).alias("total"),
        F.count(F.lit(1)).alias("rows"),
    ).first()
    total = sketch["total"]
    share = [(e["item"], -(-e["count"] * parts // total)) for e in sketch["top"] or [] if e["count"] * parts > total]
    schema = T.StructType([T.StructField("hot_key", df.schema[key].dataType), T.StructField("salts", T.IntegerType())])
    return df.sparkSession.createDataFrame(share, schema), sketch["rows"]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    row_id: list[str],
    how: str = "left",
    condition: Column | None = None,
    parts: int = HOT_PARTS,
    hot: DataFrame | None = None,
    base: DataFrame | None = None,
    by_rows: bool = False,
) -> DataFrame:
    """Equi-join spreading hot and null left keys over salts.

    Right rows of a hot key are copied once per salt; every left row meets exactly
    one copy, so results equal the plain join for left, semi and anti joins.

    The sketch runs once, now, and its at most ``parts`` keys join the plan as values:
    chained lookups plan one scan of the left table, not one per use. ``base`` is a
    stored table with the same key column to sketch instead of the plan so far; a join
    in between may have changed the counts, but they only steer the layout. Pass
    ``hot`` when the keys are known.

    With ``by_rows`` a table of many rows is dealt to tasks of at most some TASK_ROWS: for a caller who widens the rows
    and sorts them in the same task, of which the sizes measured in the shuffle tell nothing.
    """
    rows = None
    if hot is None:
        hot, rows = _sketched(left if base is None else base, left_key, parts)
    hot = F.broadcast(hot)
    spread = F.when(F.col(left_key).isNull(), F.lit(parts)).otherwise(F.coalesce("salts", F.lit(1)))
    # The task number spreads exact copies too; it is the same when a task is retried.
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *row_id), spread).cast("int")
    salted_left = (
        left.join(hot, F.col(left_key) == F.col("hot_key"), "left")
        .withColumn("_salt", salt)
        .drop("hot_key", "salts")
    )
    copies = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    salted_right = (
        right.join(hot, F.col(right_key) == F.col("hot_key"), "left")
        .withColumn("_copy", F.explode(copies))
        .drop("hot_key", "salts")
    )
    spark = left.sparkSession
    large = by_rows and rows is not None and rows > TASK_ROWS * spark.sparkContext.defaultParallelism
    if large and left.schema[left_key].dataType == right.schema[right_key].dataType:
        # Numbers that a plan names are not joined to fewer, larger tasks.
        tasks = max(-(-rows // TASK_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
        salted_left = salted_left.repartition(tasks, left_key, "_salt")
        salted_right = salted_right.repartition(tasks, right_key, "_copy")
    match = (F.col(left_key) == F.col(right_key)) & (F.col("_salt") == F.col("_copy"))
    if condition is not None:
        match = match & condition
    return salted_left.join(salted_right, match, how).drop("_salt", "_copy")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    row_id: list[str],
    how: str = "left",
    condition: Column | None = None,
    max_broadcast_rows: int = BROADCAST_ROWS,
    bound: DataFrame | None = None,
    base: DataFrame | None = None,
    by_rows: bool = False,
) -> DataFrame:
    """Join a table to a lookup of unknown size. Column names must not overlap.

    ``bound`` is a table known to hold at least as many rows as ``right`` (the stored
    table a plan filters or looks up into); counting it is cheaper than the plan.
    ``base`` is a stored table that holds the left key, and ``by_rows`` cuts large tasks, both for `salted_join`."""
    if rows_within(right if bound is None else bound, max_broadcast_rows):
        match = F.col(left_key) == F.col(right_key)
        if condition is not None:
            match = match & condition
        return left.join(F.broadcast(right), match, how)
    return salted_join(left, right, left_key, right_key, row_id, how, condition, base=base, by_rows=by_rows)


def multi_key_lookup(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    row_id: list[str],
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left lookup on several columns: broadcast within the limit, else salted on
    one text key built from all of them."""
    if rows_within(right, max_broadcast_rows):
        match = reduce(lambda a, b: a & b, [F.col(l) == F.col(r) for l, r in keys])
        return left.join(F.broadcast(right), match, "left")
    lkey = [l for l, _ in keys]
    rkey = [r for _, r in keys]
    tagged_left = left.withColumn("_lkey", _joint_key(lkey))
    tagged_right = right.withColumn("_rkey", _joint_key(rkey))
    return salted_join(tagged_left, tagged_right, "_lkey", "_rkey", row_id).drop("_lkey", "_rkey")


def _joint_key(cols: list[str]) -> Column:
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return F.when(whole, F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(cols)])))
