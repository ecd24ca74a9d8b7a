import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tallyspark.operators import scd
from tallyspark.plans import gold
from tests.conftest import rows

D = dt.date
T = dt.datetime
EXTRACTS = [D(2022, 2, 1), D(2023, 2, 1), D(2024, 2, 1)]


def customers(spark, *data):
    schema = "customer_id string, extract_date date, customer_name string, customer_segment string, region string, signup_date date"
    return spark.createDataFrame([(*r, D(2021, 1, 1)) for r in data], schema)


def test_segment_change_opens_a_version(spark):
    df = customers(
        spark,
        ("C1", EXTRACTS[0], "Ann", "Consumer", "West"),
        ("C1", EXTRACTS[1], "Ann B", "SMB", "West"),
        ("C1", EXTRACTS[2], "Ann C", "SMB", "West"),
    )
    got = gold.customer_versions(df).orderBy("valid_from").collect()
    assert [(r.customer_segment, r.customer_name, r.valid_from, r.valid_to) for r in got] == [
        ("Consumer", "Ann", D(1900, 1, 1), D(2023, 2, 1)),
        ("SMB", "Ann B", D(2023, 2, 1), D(9999, 12, 31)),
    ]


def test_two_changes_at_once_open_one_version(spark):
    df = customers(spark, ("C1", EXTRACTS[0], "A", "SMB", "West"), ("C1", EXTRACTS[1], "A", "Enterprise", "Midwest"))
    assert gold.customer_versions(df).count() == 2


def test_change_and_return_is_kept_and_nulls_compare(spark):
    df = customers(
        spark,
        ("C1", EXTRACTS[0], "A", "SMB", None),
        ("C1", EXTRACTS[1], "A", "SMB", "West"),
        ("C1", EXTRACTS[2], "A", "SMB", None),
        ("C2", EXTRACTS[0], "B", None, "West"),
        ("C2", EXTRACTS[1], "B", None, "West"),
    )
    counts = dict(rows(gold.customer_versions(df).groupBy("customer_id").count()))
    assert counts == {"C1": 3, "C2": 1}


def test_unknown_member_and_current_flag(spark):
    dim = gold.dim_customer(customers(spark, ("C1", EXTRACTS[0], "A", "SMB", "West")))
    got = {r.customer_id: r for r in dim.collect()}
    assert got["UNKNOWN"].is_current and got["UNKNOWN"].customer_name == "Unknown Customer"
    assert got["UNKNOWN"].valid_from == D(1900, 1, 1) and got["UNKNOWN"].signup_date is None


def products(spark, data):
    schema = (
        "product_id string, extract_date date, description string, category string, subcategory string, "
        "list_price decimal(18,4), standard_cost decimal(18,4)"
    )
    return spark.createDataFrame([(*r[:5], Decimal(r[5]), Decimal(r[6])) for r in data], schema)


def history(spark, seed):
    """Random extracts with gaps, unchanged re-extracts and unchecked changes."""
    rng = random.Random(seed)
    out = []
    for p in range(12):
        for day in EXTRACTS:
            if rng.random() < 0.75:
                out.append(
                    (f"P{p}", day, f"d{rng.randint(0, 2)}", rng.choice(["A", "B", None]), f"s{rng.randint(0, 1)}",
                     rng.randint(1, 2), rng.randint(1, 3))
                )
    return products(spark, out)


def looped(df, captures):
    snapshot = None
    for day in captures:
        state = scd.state_as_of(df, "product_id", "extract_date", day)
        snapshot = scd.check_snapshot(snapshot, state, "product_id", gold.PRODUCT_CHECKED, T.combine(day, dt.time()))
    return snapshot


def test_replay_equals_looped_captures(spark):
    for seed in (1, 2):
        df = history(spark, seed)
        for captures in (EXTRACTS, [D(2022, 6, 1), D(2024, 6, 1)]):
            want = looped(df, captures)
            got = scd.replay_snapshots(df, "product_id", "extract_date", gold.PRODUCT_CHECKED, captures)
            assert rows(got.select(want.columns)) == rows(want)


def test_snapshot_rerun_changes_nothing(spark):
    df = history(spark, 3)
    once = looped(df, EXTRACTS)
    assert rows(looped(df, [*EXTRACTS, EXTRACTS[-1]])) == rows(once)


def test_product_dimension(spark):
    one = ("P1", EXTRACTS[0], "old", "A", "s", 10, 6)
    df = products(spark, [
        one, ("P1", EXTRACTS[1], "new", "A", "s", 10, 7), ("P2", EXTRACTS[0], "x", "A", "s", 100, 60),
        ("P2", EXTRACTS[1], "x", "A", "s", 108, 60),
    ])
    dim = gold.dim_product(gold.product_snapshot(df, EXTRACTS), df)
    got = sorted(((r.product_id, r.description, int(r.list_price), int(r.standard_cost), r.valid_from, r.is_current) for r in dim.collect()))
    assert got == [
        ("P1", "new", 10, 6, T(2022, 2, 1), True),  # description follows, cost stays as captured
        ("P2", "x", 100, 60, T(2022, 2, 1), False),
        ("P2", "x", 108, 60, T(2023, 2, 1), True),
    ]
    assert dim.where(F.col("valid_to") == F.lit(T(9999, 12, 31))).count() == 2
    keys = {r.product_sk for r in dim.collect()}
    assert len(keys) == 3 and {r.product_sk for r in gold.dim_product(gold.product_snapshot(df, EXTRACTS), df).collect()} == keys
