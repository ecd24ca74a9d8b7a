from dataclasses import replace
from functools import reduce

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import gate
from tallyspark.sources.contracts import CONTRACTS, ColumnRule, FeedContract

POS = CONTRACTS["pos_orders"]
GOOD = {
    "order_line_id": "OL-00004217", "order_id": "ORD-0000853", "order_date": "2023-05-19", "customer_id": "CUST-000064",
    "product_id": "PROD-0207", "region": "Midwest", "channel": "Wholesale", "quantity": "5", "unit_price": "8.40",
    "discount_pct": "0.25", "gross_revenue": "42.00", "discount_amount": "10.50", "net_revenue": "31.50", "currency": "USD",
}


def landed(spark, *rows, contract=POS, drop=()):
    cols = [c for c in contract.names if c not in drop]
    extra = [c for r in rows for c in r if c not in contract.names]
    cols += extra
    data = [tuple(r.get(c) for c in cols) for r in rows]
    schema = ", ".join(f"`{c}` string" for c in cols)
    return spark.createDataFrame(data, schema).withColumn("_source_file", F.lit("f.csv"))


def broken(df, contract=POS):
    return {(r.column, r.rule): r.n for r in gate.violations(df, contract).collect()}


def passes(df, contract=POS):
    return gate.verdicts(df, contract).first().passed


def test_clean_row_passes(spark):
    assert passes(landed(spark, GOOD))
    assert broken(landed(spark, GOOD)) == {}


def test_allowed_dirt_passes(spark):
    dirt = GOOD | {"region": "mid west", "customer_id": "", "quantity": "-5", "discount_amount": "-10.50", "net_revenue": "-31.50"}
    df = landed(spark, GOOD, GOOD, dirt)
    assert passes(df) and broken(df) == {}


CORRUPT = [
    ({"currency": "usd"}, "currency", "accepted_values"),
    ({"channel": "Kiosk"}, "channel", "accepted_values"),
    ({"order_date": "2021-12-31"}, "order_date", "min"),
    ({"order_date": "2025-02-01"}, "order_date", "max"),
    ({"order_date": "31st of May"}, "order_date", "dtype"),
    ({"order_line_id": "OL-4217"}, "order_line_id", "regex"),
    ({"quantity": "five"}, "quantity", "dtype"),
    ({"quantity": "4.25"}, "quantity", "dtype"),
    ({"quantity": "9" * 30}, "quantity", "dtype"),
    ({"unit_price": "8.4f"}, "unit_price", "dtype"),
    ({"unit_price": "8d"}, "unit_price", "dtype"),
    ({"unit_price": "99999999999999.99996"}, "unit_price", "dtype"),
    ({"net_revenue": "123456789012345.5"}, "net_revenue", "dtype"),
    ({"discount_pct": "Infinity"}, "discount_pct", "dtype"),
    ({"order_id": None}, "order_id", "not_null"),
    ({"region": "null"}, "region", "not_null"),
    ({"discount_pct": "2"}, "discount_pct", "max"),
    ({"unit_price": "-3"}, "unit_price", "min"),
]


def test_corruption_is_named_per_file(spark):
    """One file per kind of corruption, beside a clean one."""
    files = [landed(spark, GOOD, GOOD | change).withColumn("_source_file", F.lit(str(i))) for i, (change, _, _) in enumerate(CORRUPT)]
    df = reduce(lambda a, b: a.unionByName(b), [landed(spark, GOOD), *files])
    found = {(r.file, r.column, r.rule, r.n) for r in gate.violations(df, POS).collect()}
    assert found == {(str(i), c, r, 1) for i, (_, c, r) in enumerate(CORRUPT)}
    assert {v.file: v.passed for v in gate.verdicts(df, POS).collect()} == {"f.csv": True} | {str(i): False for i in range(len(CORRUPT))}


def test_accepted_forms(spark):
    df = landed(spark, GOOD | {"quantity": "5.0"}, GOOD | {"quantity": " 5e0 "}, GOOD | {"order_date": "05/19/2023"}, GOOD | {"order_date": "2023-05-19 08:15:00"}, GOOD | {"unit_price": "+8.4000"}, GOOD | {"unit_price": "8.400010009"})
    assert broken(df) == {}


def test_missing_and_extra_columns(spark):
    assert broken(landed(spark, GOOD, drop=("currency",))) == {("currency", "missing_column"): 0}
    extra = landed(spark, GOOD | {"note": "x"})
    assert broken(extra) == {("note", "unexpected_column"): 0}
    assert not passes(extra)
    tolerant = replace(POS, allow_extra=True)
    verdict = gate.verdicts(extra, tolerant).first()
    assert verdict.passed and verdict.warnings == 1


def test_keys(spark):
    gl = CONTRACTS["gl_extract"]
    row = {
        "gl_id": "GL-0000001", "posting_date": "2023-05-28", "account_code": "4000", "account_name": "Product Revenue",
        "region": "West", "cost_center": "Retail", "amount_usd": "-10", "currency": "USD", "source_system": "ERP",
    }
    df = landed(spark, row, row, row, contract=gl)
    assert broken(df, gl) == {("gl_id", "primary_key_unique"): 2}
    column_unique = gl.with_rules(gl_id={"unique": True})
    assert broken(df, column_unique)[("gl_id", "unique")] == 2


def test_boolean_rule(spark):
    c = FeedContract("f", "S", "f.csv", "raw_f", ("flag",), (ColumnRule("flag", "boolean"),))
    df = spark.createDataFrame([("true",), ("0",), ("False",), ("TRUE",), ("yes",)], "flag string")
    assert broken(df.withColumn("_source_file", F.lit("f.csv")), c) == {("flag", "dtype"): 2}


def test_samples_are_sorted_and_limited(spark):
    df = landed(spark, *[GOOD | {"currency": c} for c in "HGFEDCBA"], *[GOOD | {"currency": "A"}] * 50)
    found = gate.violations(df, POS).where("rule = 'accepted_values'").first()
    assert found.n == 58
    assert found.detail.endswith("A, B, C, D, E")


def test_contract_is_checked_when_made():
    with pytest.raises(ValueError):
        replace(POS, primary_key=("nope",))
    with pytest.raises(ValueError):
        ColumnRule("x", "money")
    with pytest.raises(TypeError):
        ColumnRule("x", "string", colour="red")
    with pytest.raises(ValueError):
        POS.with_rules(nope={"min": 1})


def test_rules_of_a_number_share_its_reading(spark):
    rule = ColumnRule("amount", "numeric", min=0, max=9)
    assert not [r.rule for r in gate.column_rules(rule) if "round" in str(r.broken).lower()]
    contract = FeedContract("amounts", "POS", "*", "raw_amounts", (), (rule,))
    cells = [("1",), ("-1",), ("10",), ("999999999999999999",), ("x",), (None,)]
    raw = spark.createDataFrame([(c, "f") for (c,) in cells], "amount string, _source_file string")
    found = {r["rule"]: r["n"] for r in gate.violations(raw, contract).collect()}
    assert found == {"dtype": 2, "not_null": 1, "min": 1, "max": 1}
