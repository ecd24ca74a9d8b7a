import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.shuffles import RELEASE
from tallyspark.sources.store import TableStore
from tests.conftest import rows


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def frame(spark, data):
    return spark.createDataFrame(data, "id string, month string, v bigint")



def test_replace_and_append(spark, store):
    assert store.read("gold.t") is None and not store.exists("gold.t")
    store.replace("gold.t", frame(spark, [("a", "1", 1)]))
    store.append("gold.t", frame(spark, [("b", "1", 2)]), batches=["x"])
    assert rows(store.read("gold.t")) == [("a", "1", 1), ("b", "1", 2)]
    assert [r.batch_id for r in store.batches("gold.t").collect()] == ["x"]
    store.replace("gold.t", store.read("gold.t").where("id = 'b'"))
    assert rows(store.read("gold.t")) == [("b", "1", 2)]


def test_upsert_touches_only_its_partitions(spark, store):
    first = frame(spark, [("a", "2024-01", 1), ("b", "2024-02", 2), ("c", "2024-03", 3)])
    store.upsert("gold.f", first, ["id"], F.col("month"))
    before = dict(store._live("gold.f").parts)
    second = frame(spark, [("b", "2024-02", 20), ("d", "2024-02", 4)])
    out = store.upsert("gold.f", second, ["id"], F.col("month"))
    assert rows(out) == [("a", "2024-01", 1), ("b", "2024-02", 20), ("c", "2024-03", 3), ("d", "2024-02", 4)]
    after = dict(store._live("gold.f").parts)
    assert before["2024-01"] == after["2024-01"] and before["2024-03"] == after["2024-03"]
    assert before["2024-02"] != after["2024-02"]
    again = store.upsert("gold.f", second, ["id"], F.col("month"))
    assert rows(again) == rows(out)


def test_upsert_moves_a_key_between_partitions(spark, store):
    store.upsert("gold.f", frame(spark, [("a", "2024-01", 1), ("b", "2024-01", 2), ("z", "2024-05", 9)]), ["id"], F.col("month"))
    out = store.upsert("gold.f", frame(spark, [("a", "2024-02", 10), ("z", "2024-06", 90)]), ["id"], F.col("month"))
    assert rows(out) == [("a", "2024-02", 10), ("b", "2024-01", 2), ("z", "2024-06", 90)]
    assert "2024-05" not in dict(store._live("gold.f").parts)


def test_upsert_appends_new_columns(spark, store):
    store.upsert("gold.f", frame(spark, [("a", "2024-01", 1), ("b", "2024-02", 2)]), ["id"], F.col("month"))
    wider = frame(spark, [("c", "2024-02", 3)]).withColumn("extra", F.lit("x"))
    out = store.upsert("gold.f", wider, ["id"], F.col("month")).select("id", "extra")
    assert rows(out) == [("a", None), ("b", None), ("c", "x")]
    back = store.upsert("gold.f", frame(spark, [("d", "2024-02", 4)]), ["id"], F.col("month")).select("id", "extra")
    assert ("d", None) in rows(back) and ("c", "x") in rows(back)


def test_readers_keep_their_version(spark, store):
    old = store.replace("gold.t", frame(spark, [("a", "1", 1)]))
    store.replace("gold.t", frame(spark, [("b", "1", 2)]))
    assert rows(old) == [("a", "1", 1)]


def test_upsert_of_nothing_and_of_null_partitions(spark, store):
    none = frame(spark, [("a", "2024-01", 1)]).limit(0)
    assert store.upsert("gold.f", none, ["id"], F.col("month")).count() == 0
    out = store.upsert("gold.f", frame(spark, [("a", None, 1), ("b", "2024-01", 2)]), ["id"], F.col("month"))
    assert rows(out) == [("a", None, 1), ("b", "2024-01", 2)]
    assert rows(store.upsert("gold.f", none, ["id"], F.col("month"))) == rows(out)
    assert rows(store.upsert("gold.f", frame(spark, [("a", None, 5)]), ["id"], F.col("month"))) == [("a", None, 5), ("b", "2024-01", 2)]


def test_upsert_into_a_replaced_table(spark, store):
    store.replace("gold.f", frame(spark, [("a", "2024-01", 1), ("b", "2024-02", 2)]))
    out = store.upsert("gold.f", frame(spark, [("b", "2024-03", 20)]), ["id"], F.col("month"))
    assert rows(out) == [("a", "2024-01", 1), ("b", "2024-03", 20)]


def test_upsert_reads_no_other_part(spark, store):
    """Months that hold none of a batch's keys are neither read nor rewritten: their folders are gone here."""
    months = [f"2024-{m:02d}" for m in range(1, 10)]
    store.upsert("gold.f", frame(spark, [(f"k{m}", m, 1) for m in months]), ["id"], F.col("month"))
    parts = dict(store._live("gold.f").parts)
    for m in months[4:]:
        for f in Path(parts[m]).glob("*.parquet"):
            f.write_bytes(b"not a parquet file")
    # k1 moves from 2024-01, k2 stays, new is new.
    batch = [("k2024-01", "2024-03", 7), ("k2024-02", "2024-02", 8), ("new", "2024-04", 9)]
    store.upsert("gold.f", frame(spark, batch), ["id"], F.col("month"))
    live = store._live("gold.f")
    assert [p for v, p in live.parts if v in months[4:]] == [parts[m] for m in months[4:]]
    rest = store._load("gold.f", live.schema, [(v, p) for v, p in live.parts if v not in months[4:]])
    assert rows(rest) == [("k2024-01", "2024-03", 7), ("k2024-02", "2024-02", 8), ("k2024-03", "2024-03", 1), ("k2024-04", "2024-04", 1), ("new", "2024-04", 9)]
    store.insert("gold.f", frame(spark, [("k2024-02", "2024-03", 0), ("newer", "2024-03", 5)]), ["id"], F.col("month"))
    assert store.read("gold.f", parts=True).where("_part = '2024-03' and id = 'newer'").count() == 1


def test_index_is_built_anew_after_other_writes(spark, store):
    store.upsert("gold.f", frame(spark, [("a", "2024-01", 1)]), ["id"], F.col("month"))
    store.replace("gold.f", frame(spark, [("b", "2024-02", 2)]), F.col("month"))
    out = store.upsert("gold.f", frame(spark, [("b", "2024-03", 20)]), ["id"], F.col("month"))
    assert rows(out) == [("b", "2024-03", 20)]
    store.append("gold.f", frame(spark, [("c", "2024-04", 3)]))
    out = store.upsert("gold.f", frame(spark, [("c", "2024-05", 30), ("b", "2024-03", 21)]), ["id"], F.col("month"))
    assert rows(out) == [("b", "2024-03", 21), ("c", "2024-05", 30)]


def test_insert_keeps_the_rows_there_are(spark, store):
    assert rows(store.insert("gold.f", frame(spark, []), ["id"], F.col("month"))) == []
    store.insert("gold.f", frame(spark, [("a", "2024-01", 1), ("b", None, 2)]), ["id"], F.col("month"))
    version, before = store.version("gold.f"), store._live("gold.f").parts
    out = store.insert("gold.f", frame(spark, [("a", "2024-07", 9), ("b", "2024-01", 9), ("c", "2024-01", 3)]), ["id"], F.col("month"))
    assert rows(out) == [("a", "2024-01", 1), ("b", None, 2), ("c", "2024-01", 3)]
    assert store._live("gold.f").parts[: len(before)] == before
    assert rows(store.read_since("gold.f", version)) == [("c", "2024-01", 3)]
    again = store.insert("gold.f", frame(spark, [("c", "2024-01", 4)]), ["id"], F.col("month"))
    assert rows(again) == rows(out) and store.read_since("gold.f", store.version("gold.f")) is None


def test_filters_on_the_part_prune_folders(spark, store):
    store.replace("gold.f", frame(spark, [(f"k{m}", f"2024-{m:02d}", m) for m in range(1, 10)]), F.col("month"))
    one = store.read("gold.f", parts=True).where("_part = '2024-05'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan and rows(one.drop("_part")) == [("k5", "2024-05", 5)]
    assert len(one.inputFiles()) == 9 and "2024-05" in plan


def log_files(tmp_path, name):
    return sorted(Path(tmp_path).glob(f"{name.replace('.', '/')}/log/commit=*/*.json"))


def test_a_landing_reads_one_manifest(spark, store, tmp_path):
    """Older manifests are broken here, and so are the ids of other prefixes: none of them is opened."""
    ids = ["00aa", "1e10", "ff01", "ff02"]
    for i, batch in enumerate(ids):
        store.append("raw.t", frame(spark, [(f"k{i}", "m", i)]), batches=[batch])
    for old in log_files(tmp_path, "raw.t")[:-1]:
        old.write_text('{"version": 99, "schema": "broken"')
    for other in Path(tmp_path).glob("raw/t/batches/_prefix=00/*.parquet"):
        other.write_bytes(b"not a parquet file")
    assert store.known_batches("raw.t", ["1e10", "ff02", "ff03"]) == {"1e10", "ff02"}
    assert store.version("raw.t") == 4 and store.read("raw.t").count() == 4
    store.append("raw.t", frame(spark, [("k9", "m", 9)]), batches=["ff03"])
    assert store.version("raw.t") == 5 and store.known_batches("raw.t", ["ff03", "ab00"]) == {"ff03"}
    assert store.known_batches("raw.t", []) == store.known_batches("raw.none", ["ff03"]) == set()


def test_ids_without_their_commit_do_not_count(spark, store, tmp_path):
    store.append("raw.t", frame(spark, [("a", "m", 1)]), batches=["aa01"])
    lost = spark.createDataFrame([("aa02", "0" * 32, "aa")], "batch_id string, mark string, _prefix string")
    lost.write.mode("append").partitionBy("_prefix").parquet(f"{tmp_path}/raw/t/batches")
    assert store.known_batches("raw.t", ["aa01", "aa02"]) == {"aa01"}
    assert [r.batch_id for r in store.batches("raw.t").collect()] == ["aa01"]


def test_purge_deletes_what_is_not_live(spark, store):
    assert store.purge("gold.f") == []
    store.upsert("gold.f", frame(spark, [("a", "2024-01", 1), ("b", "2024-02", 2)]), ["id"], F.col("month"))
    store.upsert("gold.f", frame(spark, [("b", "2024-02", 3), ("c", "2024-03", 4)]), ["id"], F.col("month"))
    parts = store._live("gold.f").parts
    gone = store.purge("gold.f")
    assert len(gone) == 3 and sum("staging" in g for g in gone) == 2  # the first 2024-02 and two staged copies
    assert store._live("gold.f").parts == parts and store.purge("gold.f") == []
    assert rows(store.read("gold.f")) == [("a", "2024-01", 1), ("b", "2024-02", 3), ("c", "2024-03", 4)]
    store.replace("gold.f", frame(spark, [("z", "2024-01", 9)]))
    assert any("/keys/" in g for g in store.purge("gold.f"))
    out = store.upsert("gold.f", frame(spark, [("z", "2024-04", 8)]), ["id"], F.col("month"))
    assert rows(out) == [("z", "2024-04", 8)]


def test_stored_columns_are_made_after_the_shuffle(spark, store):
    data = [("a", "2024-01", 1), ("b", "2024-02", 2), ("c", None, 3), ("a", "2024-01", 1)]
    columns = ["id", F.md5("id").alias("key"), (F.col("v") * 2).alias("twice")]
    out = store.replace("gold.f", frame(spark, data), F.col("month"), columns)
    assert rows(out) == rows(frame(spark, data).select(*columns)) and out.columns == ["id", "key", "twice"]
    assert [v for v, _ in store._live("gold.f").parts] == ["2024-01", "2024-02", "none"]
    assert all(f.endswith(".zstd.parquet") for f in out.inputFiles())
    empty = store.replace("gold.f", frame(spark, []), F.col("month"), columns)
    assert empty.columns == ["id", "key", "twice"] and empty.count() == 0


def test_a_first_insert_is_written_once(spark, store):
    store.insert("gold.f", frame(spark, [("a", "2024-01", 1), ("b", "2024-02", 2)]), ["id"], F.col("month"))
    assert not store._folders(f"{store._home('gold.f')}.staging")
    late = frame(spark, [("a", "2024-03", 9), ("c", "2024-03", 3)])  # the index knows where "a" is
    assert rows(store.insert("gold.f", late, ["id"], F.col("month"))) == [("a", "2024-01", 1), ("b", "2024-02", 2), ("c", "2024-03", 3)]
    bare = store.insert("gold.e", frame(spark, []), ["id"], F.col("month"))
    assert bare.columns == ["id", "month", "v"] and bare.count() == 0


def test_a_first_upsert_looks_for_no_key(spark, store, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(store, "_reach", None)
        first = store.upsert("gold.f", frame(spark, [("a", "2024-01", 1), ("b", "2024-02", 2)]), ["id"], F.col("month"))
    assert rows(first) == [("a", "2024-01", 1), ("b", "2024-02", 2)] and store._live("gold.f").keys
    late = frame(spark, [("a", "2024-02", 9), ("c", None, 3)])  # the index knows where "a" was
    assert rows(store.upsert("gold.f", late, ["id"], F.col("month"))) == [("a", "2024-02", 9), ("b", "2024-02", 2), ("c", None, 3)]
    bare = store.upsert("gold.e", frame(spark, []), ["id"], F.col("month"))
    assert bare.columns == ["id", "month", "v"] and bare.count() == 0


def test_a_lookup_reads_no_entries_of_the_batchs_own_parts(spark, store, monkeypatch):
    store.upsert("gold.f", frame(spark, [("a", "2024-01", 1), ("b", "2024-02", 2)]), ["id"], F.col("month"))
    looked, frames = [], type(store.read("gold.f"))
    join = frames.join

    def watched(self, other, on=None, how=None):
        if how == "left_semi" and "_part" in self.columns:
            looked.extend(r["_part"] for r in self.collect())
        return join(self, other, on, how)

    monkeypatch.setattr(frames, "join", watched)
    out = store.upsert("gold.f", frame(spark, [("a", "2024-02", 9), ("b", "2024-02", 8)]), ["id"], F.col("month"))
    assert rows(out) == [("a", "2024-02", 9), ("b", "2024-02", 8)]
    assert set(looked) <= {"2024-01"}


def shuffle_bytes(spark):
    """Bytes of shuffle files on this machine's disk, by the number of their shuffle."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [found.apply(i) for i in range(found.size())]
    held = {}
    for f in (f for f in files if f.getName().startswith("shuffle_")):
        number = int(f.getName().split("_")[1])
        held[number] = held.get(number, 0) + f.length()
    return held


def test_a_stored_step_leaves_no_shuffle_files(spark, store):
    """Those of its rows go when the write has ended, not when the driver happens to collect its garbage."""
    spark.range(10).repartition(3, "id").count()
    before = max(shuffle_bytes(spark), default=-1)
    lines = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("id"), F.lit("2024-01").alias("month"), F.col("id").alias("v"))
    store.replace("gold.t", lines.repartition(3, "id"))
    store.replace("gold.f", lines, F.col("month"))
    for rate in (1, 2):
        out = store.upsert("gold.u", lines.withColumn("v", F.col("v") * rate), ["id"], F.col("month"))
    until = time.time() + 20
    while (left := {n: b for n, b in shuffle_bytes(spark).items() if n > before and b > 100_000}) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(RELEASE) == "false" and out.agg(F.sum("v")).first()[0] == 2 * sum(range(20_000))


def test_a_staged_batch_is_freed_with_its_commit(spark, store):
    store.upsert("gold.f", frame(spark, [("a", "2024-01", 1)]), ["id"], F.col("month"))
    store.upsert("gold.f", frame(spark, [("a", "2024-02", 2)]), ["id"], F.col("month"))
    store.insert("gold.f", frame(spark, [("b", "2024-02", 3)]), ["id"], F.col("month"))
    assert not list(Path(store.root).glob("gold/f.staging/*/*.parquet"))
    assert rows(store.read("gold.f")) == [("a", "2024-02", 2), ("b", "2024-02", 3)]


def test_lying_rows_are_stored_without_a_shuffle(spark, store, monkeypatch):
    months = [f"2024-{m:02d}" for m in range(1, 13)]
    data = [(f"k{m}{i}", m, i) for m in months for i in range(3)] + [("n", None, 1)]
    source = store.replace("gold.f", frame(spark, data), F.col("month"))
    expected = dict(store._live("gold.f").parts).keys()
    monkeypatch.setattr(type(source), "hint", None)  # what shuffles rows to their parts
    out = store.replace("gold.copy", source, F.col("month"), lying=True)
    assert rows(out) == rows(source) and dict(store._live("gold.copy").parts).keys() == expected
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_rows_that_are_there_go_before_they_are_made(spark, store):
    """Offered rows repeat, one has no key and one no part; the table's rows stay and new ones are written once."""
    given = []

    def made_of(offered):
        def made(held):
            given.append(None if held is None else {r[0] for r in held.collect()})
            new = offered.dropDuplicates(["id"])
            return new if held is None else new.join(held, "id", "left_anti").select(*offered.columns)

        return made

    columns = lambda carried: [*carried, (F.col("v") * 2).alias("twice")]
    first = frame(spark, [("a", "2024-01", 1), ("a", "2024-01", 1), ("b", None, 2)])
    out = store.insert_of("gold.f", first, made_of(first), ["id"], F.col("month"), columns)
    assert rows(out) == [("a", "2024-01", 1, 2), ("b", None, 2, 4)]
    before, version = store._live("gold.f").parts, store.version("gold.f")
    late = frame(spark, [("a", "2024-07", 9), ("b", "2024-01", 9), ("c", "2024-01", 3), ("c", "2024-01", 3), (None, "2024-02", 5)])
    out = store.insert_of("gold.f", late, made_of(late), ["id"], F.col("month"), columns)
    assert given[0] is None and given[1] == {"a", "b"}
    assert sorted(rows(out), key=str) == [("a", "2024-01", 1, 2), ("b", None, 2, 4), ("c", "2024-01", 3, 6), (None, "2024-02", 5, 10)]
    assert store._live("gold.f").parts[: len(before)] == before and not store._folders(f"{store._home('gold.f')}.staging")
    assert len(rows(store.read_since("gold.f", version))) == 2
    again = store.insert_of("gold.f", first, made_of(first), ["id"], F.col("month"), columns)
    assert again.count() == 4 and store._live("gold.f").parts[: len(before)] == before
    moved = store.upsert("gold.f", frame(spark, [("c", "2024-05", 7)]).withColumn("twice", F.lit(0).cast("bigint")), ["id"], F.col("month"))
    assert rows(moved.where("id = 'c'")) == [("c", "2024-05", 7, 0)]  # the index knows where "c" was


def test_upserted_rows_are_staged_narrow(spark, store, monkeypatch):
    staged, kept = [], store._staged

    def watched(name, new, partition):
        staged.append(new.columns)
        return kept(name, new, partition)

    monkeypatch.setattr(store, "_staged", watched)
    columns = ["id", "month", F.md5("id").alias("key")]
    for data in ([("a", "2024-01", 1), ("b", "2024-02", 2)], [("a", "2024-02", 3)], [("c", "2024-07", 4)]):
        out = store.upsert("gold.f", frame(spark, data), ["id"], F.col("month"), columns)
    expected = frame(spark, [("a", "2024-02", 0), ("b", "2024-02", 0), ("c", "2024-07", 0)]).select(*columns)
    assert rows(out) == rows(expected) and out.columns == ["id", "month", "key"]
    assert staged == [["id", "month", "v"]] * 3
