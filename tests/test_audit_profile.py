import pytest

import __spark_entry__ as entry
from tallyspark.operators import audit, profile
from tests.conftest import SMALL, rows


@pytest.fixture
def calls(spark):
    lines = [
        '{"event": "tool_call", "timestamp": "t1", "tool": "query_metric", "arguments": {"metric": "net_revenue", "n": 3}, "decision": "allow", "reason": "ok", "rows": 4, "sql": "x", "latency_ms": 12.5}',
        '{"event": "tool_call", "timestamp": "t2", "tool": "query_metric", "arguments": {"metric": "net_revenue"}, "decision": "deny", "reason": "bad filter", "rows": null, "latency_ms": 1.0}',
        '{"event": "tool_call", "timestamp": "t3", "tool": "preview", "arguments": {"table": "fact_gl", "metric": "ignored"}, "decision": "allow", "reason": "ok", "rows": 2}',
        '{"event": "startup", "timestamp": "t0"}',
        "not json",
        '["a", "list"]',
        "",
        '{"event": "tool_call", "timestamp": "t4", "tool": "run_query", "decision": "deny", "latency_ms": 99.0}',
    ]
    return audit.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_noise_is_skipped(calls):
    assert calls.count() == 4
    one = calls.where("timestamp = 't1'").first()
    assert (one.arguments.metric, one.rows, one.sql, one.latency_ms) == ("net_revenue", 4, "x", 12.5)


def test_summaries(calls):
    assert rows(audit.by_decision(calls)) == [("allow", 2), ("deny", 2)]
    assert [tuple(r) for r in audit.by_tool(calls).collect()] == [("query_metric", 2), ("preview", 1), ("run_query", 1)]
    assert [tuple(r) for r in audit.top_denials(calls).collect()] == [("", 1), ("bad filter", 1)]
    assert [tuple(r) for r in audit.top_metrics(calls).collect()] == [("net_revenue", 2)]
    assert [r.latency_ms for r in audit.slowest(calls, 3).collect()] == [99.0, 12.5, 1.0]
    assert audit.slowest(calls, 4).collect()[3].latency_ms == 0.0


@pytest.mark.parametrize(
    "sql, says",
    [
        ("select channel, max(quantity) from lines", "fine"),
        ("With m as (select 7 as seven) select seven from m ;", "fine"),
        ("\t/* why */ Select now() -- when", "fine"),
        ("select uploads, recreated, altered_at from lines", "fine"),
        ("select 5 ; select 6", "parts:2"),
        ("select 5 /* one; two */ ; ;; select 6 ; select 7", "parts:3"),
        (";;;", "parts:0"),
        ("table lines", "opening"),
        ("selected", "opening"),
        ("(select 5)", "opening"),
        ("/* select */ truncate lines", "opening"),
        ("with gone as (delete from lines) select 5", "word:DELETE"),
        ("select 'we merge later' as note", "word:MERGE"),
        ("select * from Read_Parquet('x')", "word:READ_PARQUET"),
        ("select 5 as load, 6 as copy", "word:LOAD"),
        ("select '/*' from lines where note = '*/' ; vacuum", "parts:2"),
        ("select 5 -- /* six\n; select 7 */", "fine"),
        ("select 5 /* -- six */ ; select 7", "parts:2"),
        (None, "blank"),
        ("", "blank"),
        ("\n \t", "blank"),
        ("/* a */ -- b", "comments"),
    ],
)
def test_screening(spark, sql, says):
    got = audit.screen_statements(spark.createDataFrame([(sql,)], "sql string")).first()
    assert got.screen_reason == says
    assert got.allowed == (says == "fine")


def test_totals_fill_in_zero(spark, calls):
    want = {"all": 4, "allow": 2, "deny": 2, "other": 0, "without_tool": 0}
    assert dict(map(tuple, audit.totals(calls).collect())) == want
    assert dict(map(tuple, audit.totals(calls.limit(0)).collect())) == dict.fromkeys(want, 0)


def test_profile_covers_the_whole_table(spark):
    rows_ = [(i, None if i < 300 else f"v{i % 5}", i % 2 == 0) for i in range(400)]
    df = spark.createDataFrame(rows_, "id int, s string, b boolean").repartition(5)
    got = {r.column_name: (r.data_type, r.nullable, r.samples) for r in profile.column_profile(df).collect()}
    assert got["id"] == ("int", True, ["0", "1", "10"])
    assert got["s"] == ("string", True, ["v0", "v1", "v2"])
    assert got["b"][2] == ["false", "true"]
    assert [r.samples for r in profile.column_profile(df.where("id < 0")).collect()] == [[], [], []]
    with_nulls = df.where("id < 300")
    assert {r.column_name: r.samples for r in profile.column_profile(with_nulls).collect()}["s"] == []


def test_profile_describes_every_governed_column(spark):
    df = spark.createDataFrame([(1, "a")], "quantity int, other string")
    assert {r.column_name: r.description for r in profile.column_profile(df).collect()}["other"] == ""
    assert {r.column_name: r.description for r in profile.column_profile(df, {"other": "x"}).collect()} == {"quantity": "", "other": "x"}
    w = entry.workbench(spark, SMALL)
    for name, table in w.tables(*entry.GOLD, *entry.MARTS).items():
        assert set(table.columns) <= set(profile.COLUMN_DESCRIPTIONS), name


def test_preview_is_clamped(spark):
    df = spark.range(100)
    assert profile.preview(df, 500, ["id"]).count() == 50
    assert profile.preview(df, 0, ["id"]).count() == 1
    assert [r.id for r in profile.preview(df, 3, ["id"]).collect()] == [0, 1, 2]


def test_listing(spark):
    got = {r.table_name: (r.row_count, r.description) for r in profile.table_listing({"dim_date": spark.range(7), "x": spark.range(0)}).collect()}
    assert got["dim_date"][0] == 7 and got["dim_date"][1] and got["x"] == (0, "")
