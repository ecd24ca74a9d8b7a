import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyspark.operators.metrics import READERS, MetricError, capped, metric, resolve
from tallyspark.plans import metric_registry as reg
from tests.conftest import SMALL, rows


@pytest.fixture(scope="module")
def tables(spark):
    w = entry.workbench(spark, SMALL)
    return w.tables("fact_sales", "fact_gl", "dim_region", "dim_channel", "dim_customer", "dim_product", "dim_date")


def test_by_region(tables):
    df = metric(tables, "net_revenue", ["region"], time_grain="none")
    assert df.columns == ["region", "net_revenue"]
    assert df.count() == 6


def test_grain_dimensions_come_first_and_once():
    _, groups, _ = resolve("net_revenue", ["region", "fiscal_year"], {}, "fiscal_quarter")
    assert groups == ["fiscal_year", "fiscal_quarter", "region"]
    assert resolve("customer_count", None, None, None)[1] == ["fiscal_year"]


def test_no_groups_gives_one_row(tables):
    assert metric(tables, "customer_count", time_grain="none").count() == 1
    assert metric(tables, "gl_expense_total", time_grain="none").count() == 1


def test_filter_values_are_only_values(tables):
    for text in ("ASIA' OR 'a' = 'a", "%", "ASIA\"", "lower('asia')"):
        assert metric(tables, "net_revenue", ["region"], {"region": text}, "none").count() == 0


@pytest.mark.parametrize(
    "request_, says",
    [
        (("gross_turnover", None, None, None), "no such metric: gross_turnover"),
        (("customer_count", ["account_name"], None, None), "no such slice: account_name"),
        (("average_order_value", ["customer"], None, None), "slice: customer"),
        (("revenue_per_customer", None, {"currency": "EUR"}, None), "no such filter: currency"),
        (("gl_expense_total", None, {"region": ()}, None), "filter without values: region"),
        (("gl_expense_total", None, {"fiscal_year": ["1998", "MCMXCIX"]}, None), "unreadable filter value: fiscal_year='MCMXCIX'"),
        (("net_revenue", None, None, "fortnight"), "no such grain: fortnight"),
    ],
)
def test_requests_out_of_reach_are_refused(request_, says):
    with pytest.raises(MetricError, match=says):
        resolve(*request_)


def test_all_objections_come_at_once():
    with pytest.raises(MetricError) as refused:
        resolve("net_revenue", ["account_name"], {"planet": 3, "region": []}, "fortnight")
    assert str(refused.value).count(";") == 3


def test_filter_values_are_read_by_kind():
    assert READERS["int"]("41") == 41 and READERS["number"]("0.5") == 0.5 and READERS["string"](41) == "41"
    assert [READERS["bool"](v) for v in (True, False, "Yes ", "1", 1, "true", "off", "")] == [True, False, True, True, True, True, False, False]


@pytest.mark.parametrize(
    "name, dims, filters",
    [
        ("average_order_value", ["customer_segment", "region"], {"channel": ["Online", "Retail"]}),
        ("revenue_per_customer", ["product_category"], {"customer_segment": "BUILDING"}),
        ("net_revenue", ["channel"], {"currency": "EUR", "is_return": "false"}),
    ],
)
def test_salted_lookups_agree(tables, name, dims, filters):
    small = metric(tables, name, dims, filters)
    large = metric(tables, name, dims, filters, max_broadcast_rows=0)
    assert rows(small) == rows(large) and small.count() > 0


def test_cap_and_truncation(tables):
    assert metric(tables, "net_revenue", ["region"], time_grain="none", cap=2).count() == 2
    every = metric(tables, "net_revenue", ["region"], time_grain="none")
    assert capped(every, 6)[1] is False
    kept, cut = capped(every, 5)
    assert cut is True and kept.schema == every.schema and [tuple(r) for r in kept.collect()] == [tuple(r) for r in every.collect()][:5]


def test_no_group_is_lost_without_a_cap(spark, tables):
    n = 2600
    regions = spark.range(n).select(F.concat(F.lit("k"), "id").alias("region_sk"), F.concat(F.lit("r"), "id").alias("region_name"))
    lines = regions.select("region_sk", F.lit(1).cast("decimal(18,2)").alias("net_revenue"))
    own = dict(tables) | {"fact_sales": lines, "dim_region": regions}
    assert metric(own, "net_revenue", ["region"], time_grain="none").count() == n


def test_registry_is_checked():
    good = reg.METRICS["net_revenue"]
    from dataclasses import replace

    for wrong in (
        replace(good, base="raw_pos_orders"),
        replace(good, grain="weekly"),
        replace(good, dimensions=("planet",)),
        replace(good, filters=("planet",)),
        replace(good, required=("planet",)),
    ):
        with pytest.raises(ValueError):
            reg.check_registry({"m": wrong})
