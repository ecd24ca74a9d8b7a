"""Each assertion passes on clean tables and finds seeded faults."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyspark.operators import quality
from tallyspark.plans import checks
from tallyspark.plans.build import GOLD, MARTS
from tests.conftest import SMALL, rows


@pytest.fixture(scope="module")
def w(spark):
    return entry.workbench(spark, SMALL)


def test_declared_counts():
    every = checks.CHECKS.values()
    assert sum(len(c.required) for c in every) == 141
    assert sum(len(c.unique) for c in every) == 14
    assert sum(len(c.accepted) for c in every) == 20
    assert sum(len(c.parents) for c in every) == 7
    assert sum(bool(c.combination) for c in every) == 5
    assert sum(bool(c.expression) for c in every) == 1


def test_suite_on_built_tables(w):
    tables = w.tables("silver_orders", "silver_gl", *GOLD, *MARTS)
    failing = checks.run_checks(tables).where("failures > 0")
    # Only the accepted-values lists of another business fail here.
    assert {r.test for r in failing.collect()} == {"accepted_values"}


def test_rules_run_over_built_tables(w):
    tables = {"raw_pos_orders": w.landed("pos_orders")} | w.tables(*GOLD, *MARTS)
    found = checks.run_rules(tables).collect()
    assert len(found) == 10 and not any(r.failures for r in found)
    spoilt = tables | {"fact_sales": tables["fact_sales"].where("not is_return").withColumn("region_sk", F.lit("none"))}
    broken = {r.column_name for r in checks.run_rules(spoilt).where("failures > 0").collect()}
    assert {"ties_to_sales", "no_orphan_keys"} <= broken
    with pytest.raises(ValueError, match="fact_gl"):
        checks.run_rules({k: v for k, v in tables.items() if k != "fact_gl"})


def test_business_rules_pass_on_clean_tables(w):
    fact, ledger = w.table("fact_sales"), w.table("fact_gl")
    dims = {k: w.table(t) for k, t in checks.CHECKS["fact_sales"].parents.items()}
    assert quality.rowcount_within(w.bronze("pos_orders"), fact).count() == 0
    assert quality.gl_ties_to_sales(fact, ledger).count() == 0
    assert quality.margin_in_range(w.table("gross_margin_by_segment"), w.table("monthly_revenue_bridge")).count() == 0
    assert quality.negative_sales(fact).count() == 0
    assert quality.orphan_keys(fact, dims).count() == 0
    assert quality.overlapping_windows(w.table("dim_customer"), "customer_id").count() == 0
    assert quality.not_one_current({"customer_id": w.table("dim_customer"), "product_id": w.table("dim_product")}).count() == 0


def test_seeded_faults_are_found(w):
    fact, ledger = w.table("fact_sales"), w.table("fact_gl")
    assert quality.rowcount_within(w.bronze("pos_orders"), fact.where("date_key % 2 = 0")).count() == 1
    assert quality.gl_ties_to_sales(fact.where("not is_return"), ledger).count() == 1
    dims = {"customer_sk": w.table("dim_customer").where("customer_id <> 'UNKNOWN'"), "date_key": w.table("dim_date")}
    want = fact.where("is_unknown_customer").count()
    assert quality.orphan_keys(fact, dims).count() == want > 0
    assert quality.orphan_keys(fact, dims, max_broadcast_rows=0).count() == want
    assert quality.orphan_keys(fact, dims, max_broadcast_rows=0, max_lost_keys=0).count() == want


def test_orphans_of_large_dimensions(spark):
    """Lost key values are broadcast, or rows and dimensions shuffled: either way the same rows, nulls and text keys too."""
    fact = spark.createDataFrame([("l1", 1, "a"), ("l2", 2, "a"), ("l3", None, "b"), ("l4", 3, "z"), ("l5", 1, None)], "order_line_id string, n int, s string")
    dims = {"n": spark.createDataFrame([(1,), (2,), (2,)], "n bigint"), "s": spark.createDataFrame([("a",), ("b",), (None,)], "s string")}
    want = [("l3", None, "b"), ("l4", 3, "z"), ("l5", 1, None)]
    for limits in ({}, {"max_broadcast_rows": 0}, {"max_broadcast_rows": 0, "max_lost_keys": 0}):
        assert sorted(tuple(r) for r in quality.orphan_keys(fact, dims, **limits).collect()) == want, limits
    assert quality.orphan_keys(fact.limit(0), dims, max_broadcast_rows=0).count() == 0


def test_overlap_beyond_the_neighbour(spark):
    d = dt.date
    dim = spark.createDataFrame(
        [("a", d(2020, 1, 1), d(2023, 1, 1)), ("a", d(2020, 6, 1), d(2020, 7, 1)), ("a", d(2022, 1, 1), d(2024, 1, 1)), ("b", d(2020, 1, 1), d(2021, 1, 1)), ("b", d(2021, 1, 1), d(2022, 1, 1))],
        "k string, valid_from date, valid_to date",
    )
    assert sorted(r.valid_from for r in quality.overlapping_windows(dim, "k").collect()) == [d(2020, 6, 1), d(2022, 1, 1)]


def test_current_versions(spark):
    dim = spark.createDataFrame([("a", True), ("b", True), ("b", True), ("c", False)], "k string, is_current boolean")
    assert rows(quality.not_one_current({"k": dim})) == [("b", 2), ("c", 0)]


def test_generic_assertions(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (2, "y"), (None, "y"), (None, "z")], "a int, b string")
    assert rows(quality.null_counts(df, ["a", "b"])) == [("a", 2), ("b", 1)]
    assert quality.not_null(df, "a").count() == 2
    assert rows(quality.unique(df, "a")) == [(1, 2)]
    assert rows(quality.unique_combination(df, ["a"])) == [(1, 2), (None, 2)]
    assert rows(quality.accepted_values(df, "b", ["x", "y"])) == [("z", 1)]
    parent = spark.createDataFrame([("y",)], "p string")
    assert rows(quality.relationships(df, "b", parent, "p")) == [("x", 1), ("z", 1)]
    assert quality.expression_true(df, F.col("a") > 1).count() == 2


@pytest.mark.parametrize("hours, status", [(1, "pass"), (37, "warn"), (73, "error")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2025, 1, 10)
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),), (dt.datetime(2020, 1, 1),)], "_loaded_at timestamp")
    got = quality.freshness(df, now).first()
    assert got.status == status and got.age_hours == hours
    assert quality.freshness(df.limit(0), now).first().status == "error"


def test_missing_rates(w):
    got = quality.missing_rates(w.table("silver_orders"), w.table("silver_fx_rates")).collect()
    assert [(str(r.order_month), r.currency) for r in got] in ([("1996-02-01", "EUR")], [])
