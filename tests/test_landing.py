import datetime as dt
from dataclasses import replace

import pytest

from tallyspark.plans.bronze import typed
from tallyspark.sources import feeds, landing
from tallyspark.sources.contracts import CONTRACTS
from tallyspark.sources.store import TableStore
from tests.test_gate import GOOD, POS

FX = CONTRACTS["fx_rates"]
CUST = CONTRACTS["customer_master"]
NOW = dt.datetime(2025, 2, 1, 12, 0, 0)
FX_HEADER = "rate_date,from_currency,to_currency,rate\n"
CUST_HEADER = "extract_date,customer_id,customer_name,customer_segment,region,signup_date\n"


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    return folder


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "warehouse"))


def land(spark, store, drop, contract, **kw):
    return [(r.file, r.action, r.rows) for r in landing.land_feed(spark, store, str(drop), contract, NOW, **kw)]


def write_pos(drop, *rows, name="pos_orders.csv"):
    cols = list(GOOD)
    text = ",".join(cols) + "\n" + "".join(",".join('"%s"' % r[c] if "," in r[c] else r[c] for c in cols) + "\n" for r in rows)
    (drop / name).write_text(text)


def test_lands_text_with_metadata_and_keeps_blanks(spark, store, drop):
    write_pos(drop, GOOD, GOOD | {"customer_id": "", "region": 'N/A, "x"'.replace('"', "'")})
    report = land(spark, store, drop, POS)
    assert report == [("pos_orders.csv", "append", 2)]
    raw = store.read("raw.raw_pos_orders")
    got = {r.region: r for r in raw.collect()}
    assert got["N/A, 'x'"].customer_id == ""  # landing keeps blanks as text
    one = got["Midwest"]
    assert (one._source_file, one._source_system, one._loaded_at) == ("pos_orders.csv", "POS", NOW)
    assert len(one._batch_id) == 16
    assert all(f.dataType.simpleString() == "string" for f in raw.schema if not f.name.startswith("_loaded"))
    assert typed(raw, POS).schema["net_revenue"].dataType.simpleString() == "decimal(28,9)"


def ids(spark, drop, **kw):
    files = feeds.discover(spark, str(drop), replace(FX, file_glob="*.csv")).collect()
    return {r.path.rsplit("/", 1)[1]: (r.batch_id, r.header) for r in feeds.manifest(spark, files, **kw).collect()}


def test_batch_id_follows_every_byte_and_their_order(spark, drop):
    lines = [f"2023-{m:02d}-01,EUR,USD,1.{m}" for m in range(1, 13)]
    body = FX_HEADER + "\n".join(lines)
    bodies = {
        "a": body, "copy": body, "value": body.replace("1.12", "1.13"), "swapped": FX_HEADER + "\n".join([lines[1], lines[0], *lines[2:]]),
        "end": body + "\n", "return": body.replace("\n", "\r\n"), "blank": body.replace("EUR", " EUR"), "more": body + "\n\n",
    }
    for name, text in bodies.items():
        (drop / f"{name}.csv").write_bytes(text.encode())
    found = ids(spark, drop, block_lines=4)
    assert found["a.csv"] == found["copy.csv"] and len({i for i, _ in found.values()}) == len(bodies) - 1
    assert found["a.csv"][1] == FX_HEADER.strip() and all(len(i) == 16 for i, _ in found.values())


def test_batch_id_ignores_how_a_file_is_split(spark, drop):
    (drop / "fx_rates.csv").write_text(FX_HEADER + "".join(f"2023-01-01,EUR,USD,{i}\n" for i in range(3000)))
    whole = ids(spark, drop)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert ids(spark, drop) == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_headers_of_any_length(spark, drop):
    names = ",".join(f"spalte_ü_{i}" for i in range(9000))
    (drop / "wide.csv").write_text(names + "\n1\n")
    assert ids(spark, drop)["wide.csv"][1] == names


def test_second_run_is_a_no_op(spark, store, drop):
    (drop / "customer_master_2022.csv").write_text(CUST_HEADER + "2022-02-01,CUST-000001,A,SMB,West,2021-01-01\n")
    assert land(spark, store, drop, CUST) == [("customer_master_2022.csv", "append", 1)]
    assert land(spark, store, drop, CUST) == [("customer_master_2022.csv", "skip", None)]
    (drop / "customer_master_2023.csv").write_text(CUST_HEADER + "2023-02-01,CUST-000001,A,SMB,West,2021-01-01\n")
    assert land(spark, store, drop, CUST) == [
        ("customer_master_2022.csv", "skip", None),
        ("customer_master_2023.csv", "append", 1),
    ]
    assert store.read("raw.raw_customer_master").count() == 2


def test_same_bytes_under_two_names_land_once(spark, store, drop):
    body = CUST_HEADER + "2022-02-01,CUST-000001,A,SMB,West,2021-01-01\n"
    (drop / "customer_master_a.csv").write_text(body)
    (drop / "customer_master_b.csv").write_text(body)
    assert land(spark, store, drop, CUST) == [("customer_master_b.csv", "skip", None), ("customer_master_a.csv", "append", 1)]
    assert store.read("raw.raw_customer_master").count() == 1


def test_dry_run_knows_copies_of_earlier_waves(spark, store, drop, monkeypatch):
    body = CUST_HEADER + "2022-02-01,CUST-000001,A,SMB,West,2021-01-01\n"
    for name in "abc":
        (drop / f"customer_master_{name}.csv").write_text(body)
    monkeypatch.setattr(feeds.waves, "__defaults__", (1,))
    assert [a for _, a, _ in land(spark, store, drop, CUST, dry_run=True)] == ["would append", "skip", "skip"]


def test_malformed_rows_reject_their_file(spark, store, drop):
    good = "2022-02-01,CUST-000001,A,SMB,West,2021-01-01\n"
    (drop / "customer_master_more.csv").write_text(CUST_HEADER + good + good.replace("\n", ",surplus,cells\n"))
    (drop / "customer_master_less.csv").write_text(CUST_HEADER + good + "2022-02-01,CUST-000002\n")
    (drop / "customer_master_ok.csv").write_text(CUST_HEADER + good)
    actions = {f: a for f, a, _ in land(spark, store, drop, CUST)}
    assert actions == {"customer_master_more.csv": "reject", "customer_master_less.csv": "reject", "customer_master_ok.csv": "append"}
    raw = store.read("raw.raw_customer_master")
    assert raw.count() == 1 and "_malformed" not in raw.columns
    found = {(r.file, r.rule, r.n) for t in landing.gate_report(spark, str(drop), CUST) for r in t.collect()}
    assert {("customer_master_more.csv", "malformed_row", 1), ("customer_master_less.csv", "malformed_row", 1)} <= found


def test_a_file_without_any_contract_column_is_rejected(spark, store, drop):
    (drop / "customer_master_odd.csv").write_text("alpha,beta\n1,2\n")
    assert land(spark, store, drop, CUST) == [("customer_master_odd.csv", "reject", 1)]


def test_one_bad_layout_does_not_stop_the_run(spark, store, drop):
    row = "2022-02-01,CUST-000001,A,SMB,West,2021-01-01\n"
    (drop / "customer_master_twice.csv").write_text(CUST_HEADER.replace("region", "Customer_ID") + row)
    (drop / "customer_master_nothing.csv").write_text("")
    (drop / "customer_master_ok.csv").write_text(CUST_HEADER + row)
    (drop / "holiday photos.txt").write_text("x")
    run = landing.land_folder(spark, store, str(drop), [CUST, FX], NOW)
    assert {(r.file, r.action, r.reason) for r in run.files} == {
        ("holiday photos.txt", "reject", "no_feed"), ("customer_master_nothing.csv", "reject", "no_bytes"),
        ("customer_master_twice.csv", "reject", "duplicate_column"), ("customer_master_ok.csv", "append", None),
    }
    assert not run.passed and len(run.failed) == 3
    assert store.read("raw.raw_customer_master").count() == 1


def test_bad_file_is_rejected_and_others_land(spark, store, drop):
    (drop / "customer_master_bad.csv").write_text(CUST_HEADER + "2022-02-01,12345,A,SMB,West,2021-01-01\n")
    (drop / "customer_master_short.csv").write_text("extract_date,customer_id\n2022-02-01,CUST-000001\n")
    # Same columns in another order: read by name, not by position.
    (drop / "customer_master_ok.csv").write_text(
        "customer_id,extract_date,customer_name,customer_segment,region,signup_date\nCUST-000002,2022-02-01,B,SMB,West,2021-01-01\n"
    )
    actions = {f: a for f, a, _ in land(spark, store, drop, CUST)}
    assert actions == {"customer_master_bad.csv": "reject", "customer_master_short.csv": "reject", "customer_master_ok.csv": "append"}
    assert [r.customer_id for r in store.read("raw.raw_customer_master").collect()] == ["CUST-000002"]
    rules = {(r.column, r.rule) for t in landing.gate_report(spark, str(drop), CUST) for r in t.collect()}
    assert ("customer_id", "regex") in rules and ("region", "missing_column") in rules


def test_dry_run_writes_nothing(spark, store, drop):
    (drop / "fx_rates.csv").write_text(FX_HEADER + "2023-01-01,EUR,USD,1.1\n")
    assert land(spark, store, drop, FX, dry_run=True) == [("fx_rates.csv", "would append", 1)]
    assert not store.exists("raw.raw_fx_rates")


def test_no_files_is_not_an_error(spark, store, drop):
    assert land(spark, store, drop, FX) == []


def test_waves_are_bounded(spark, drop):
    for i in range(5):
        (drop / f"customer_master_{i}.csv").write_text(CUST_HEADER)
    sizes = [len(w) for w in feeds.waves(feeds.discover(spark, str(drop), CUST), size=2)]
    assert sizes == [2, 2, 1]


def test_header_parsing():
    assert feeds.header_columns('\ufeffa,"b c",d\r') == ("a", "b c", "d")
