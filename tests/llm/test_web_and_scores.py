"""Archives, URL lists, license scans, toxicity and the pipeline."""

import base64
import datetime as dt
import hashlib
import importlib
import zlib

import duckdb
import numpy as np
import pytest

from tallyspark.llm import archive, licenses, oracles, queries, toxicity, urls
from tests.conftest import SMALL, rows
from tests.llm.conftest import ODD_ROWS, documents
from tools.compare import compare, database


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_queries_match_their_statements(spark, name):
    ok, note = compare(spark, database(SMALL), SMALL, name, queries.QUERIES[name], oracles.ORACLES[name])
    assert ok, note


@pytest.fixture
def beside(spark, tmp_path):
    """Whether a query over given texts equals its statement over the same texts."""

    def check(name, texts):
        path = f"{tmp_path}/documents.parquet"
        documents(spark, list(enumerate(texts))).write.mode("overwrite").parquet(path)
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
        return compare(spark, con, str(tmp_path), name, queries.QUERIES[name], oracles.ORACLES[name])

    return check


def test_license_statement_covers_all_wordings(beside):
    texts = []
    for _, wording in licenses.TEMPLATES:
        words = wording.split()
        texts += [wording, "Some file. " + wording + " More text after it. " * 3, " ".join(words[: len(words) * 9 // 10]), " ".join(words[: len(words) // 2])]
    texts += [None, "", "Licensed", "word " * 7000 + "Licensed under the MIT License. " + "word " * 9000]
    ok, note = beside("op6_licenses", texts)
    assert ok, note


def test_statements_on_odd_texts(beside):
    line = "a line of words that goes on beyond fifty bytes and stands in several of the texts\n"
    # The statement for passages takes a slice per byte, so the text of 200,000 characters is left to the test by force.
    texts = [t for _, t in ODD_ROWS if t is None or ("\x00" not in t and len(t) < 10_000)]
    texts += [line * 3, "x" + line, line[:50], line[:49], "Ü" * 60, "y" + "Ü" * 40, line + "\x0b tail", line + "\u00a0tail", line.upper()]
    for name in ("op7_suffix_array_dedup", "op9_near_duplicates"):
        ok, note = beside(name, texts)
        assert ok, (name, note)


# Archive

PAGES = [(5, "http://a/", "x"), (3, "http://b/\r\nEvil: 1", "x"), (9, None, "x"), (4, "http://c/", None), (2, "http://d/", ""), (7, "u", "Ü" * 50_000),
         (7, "u", "Ü" * 50_000), (None, "v", "x"), (None, "w", "alone")]


def pages(spark, some=PAGES):
    return spark.createDataFrame([(*p, "q") for p in some], "page_id bigint, url string, html string, sha256 string")


def test_archive_round_trip(spark):
    first = {}
    for page, _, html in PAGES:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        of = first.get(html or "")
        revisit = of is not None and of != page
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((page, len(data), digest, "revisit" if revisit else "response", of if revisit else None))
    assert rows(archive.archived_pages(pages(spark))) == sorted(want, key=repr)
    assert rows(archive.archived_pages(pages(spark).limit(0))) == []


def test_archive_stores_a_payload_once_and_rebuilds_records(spark):
    made = archive.write_archive(pages(spark))
    assert spark.read.parquet(made.payloads).count() == 4
    records = [bytes(r["record"]) for r in archive.warc_records(spark, made).collect()]
    assert len(records) == len(PAGES) and sum(b"WARC-Type: response" in r for r in records) == 5
    for r in records:
        head, _, rest = r.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert b"Evil" not in fields and rest.endswith(b"\r\n\r\n") and len(rest) - 4 == int(fields[b"Content-Length"])
        assert fields[b"WARC-Date"] == archive.NO_DATE.encode()
        if fields[b"WARC-Type"] == b"response":
            status, _, body = rest[:-4].partition(b"\r\n\r\n")
            lines = status.split(b"\r\n")
            assert fields[b"Content-Type"] == b"application/http;msgtype=response" and lines[0] == b"HTTP/1.1 200 OK"
            assert lines[-1] == b"Content-Length: %d" % len(body)
            assert fields[b"WARC-Payload-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(body).digest())


def test_records_carry_fetch_times(spark):
    timed = spark.sql("SELECT 1L AS page_id, 'u' AS url, 'x' AS html, timestamp'2024-02-29 12:00:00+02:00' AS at UNION ALL SELECT 2L, 'v', 'y', NULL")
    made = archive.write_archive(timed, fetched="at")
    dates = {r["header"].split("<urn:page:")[1][0]: r["header"].split("WARC-Date: ")[1][:20] for r in archive.read_records(spark, made).collect()}
    assert dates == {"1": "2024-02-29T10:00:00Z", "2": archive.NO_DATE}


def test_short_payloads_are_never_revisited(spark):
    got = {r["page_id"]: r["record_type"] for r in archive.archived_pages(pages(spark), least_bytes=2).collect()}
    assert got[5] == got[3] == got[4] == got[2] == "response"


def test_a_changed_payload_is_found(spark):
    made = archive.write_archive(pages(spark))
    wrong = spark.read.parquet(made.payloads).selectExpr("sha256", "concat(payload, X'00') AS payload")
    path = made.payloads + "-wrong"
    wrong.write.parquet(path)
    with pytest.raises(Exception, match="doesn't match its digest"):
        archive.captures(spark, archive.Archive(made.records, path)).collect()


# URL lists


def test_lists_are_read_as_of_the_fetch(spark):
    day = lambda n: dt.date(2024, 1, n)
    changes = [("domain", "bad.org", day(5), "add"), ("domain", "bad.org", day(10), "remove"), ("domain", "bad.org", day(20), "add"),
               ("prefix", "ok.org/x", day(1), "add"), ("domain", "both.org", day(3), "add"), ("domain", "both.org", day(3), "remove"),
               (None, "c.org", day(1), "add"), ("domain", "d.org", None, "add"), ("domain", "e.org", day(1), "shrug")]
    captures = [(1, "http://a.BAD.org/q", day(4)), (2, "http://a.bad.org/q", day(5)), (3, "https://me@bad.org:8080/q", day(9)),
                (4, "http://bad.org", day(10)), (5, "http://bad.org#x", day(25)), (6, "http://ok.org/x/y?z", day(2)), (7, "http://ok.org/xy", day(2)),
                (8, "http://both.org/", day(4)), (9, None, day(4)), (10, "nonsense", day(4)), (11, "http://bad.org/", None), (None, "http://bad.org/", day(6)),
                (12, "http://d.org", day(9)), (13, "http://e.org", day(9)), (2, "http://a.bad.org/q", day(5))]
    listed = spark.createDataFrame(changes, "kind string, value string, changed_at date, action string")
    got = spark.createDataFrame([(*c, "h") for c in captures], "capture_id bigint, url string, fetched_at date, history string")
    blocked = [(r["capture_id"], r["first_match"]) for r in urls.judge(got, listed).collect() if r["blocked"]]
    want = [(2, "domain:bad.org"), (2, "domain:bad.org"), (3, "domain:bad.org"), (5, "domain:bad.org"), (6, "prefix:ok.org/x"), (None, "domain:bad.org")]
    assert sorted(blocked, key=repr) == sorted(want, key=repr)
    assert urls.judge(got, listed).count() == len(captures)
    assert not [r for r in urls.judge(got, listed.limit(0)).collect() if r["blocked"]]
    assert urls.judge(got.limit(0), listed).count() == 0


# License scans


def test_notices_are_found_wherever_they_stand(spark, odd, none):
    notice = dict(licenses.TEMPLATES)
    docs = [(i, "word " * i + notice["gpl-3.0"].upper() + " tail" * (i % 5)) for i in range(60)]
    docs += [(100, notice["apache-2.0"] + " " + notice["mit"]), (101, "Released under the MIT"), (102, None), (103, ""), (104, "w " * 5038 + notice["mpl-2.0"])]
    docs += [(105, "x " * 12_000 + notice["apache-2.0"]), (106, "This work is licensed under the GNU General Public License, version three.")]
    got = {(r["doc_id"], r["license"]): r["containment"] for r in licenses.licensed(documents(spark, docs)).collect()}
    want = {(i, "gpl-3.0") for i in range(60)} | {(100, "apache-2.0"), (100, "mit"), (104, "mpl-2.0"), (105, "apache-2.0"), (106, "gpl-3.0")}
    assert set(got) == want and got[105, "apache-2.0"] == 1.0 and got[106, "gpl-3.0"] == 7 / 8
    assert rows(licenses.licensed(odd)) == [] and rows(licenses.licensed(none)) == []


def test_licenses_are_found_by_their_own_wording(spark):
    def text(name):
        return (licenses.TEXTS / f"{name}.txt").read_text(encoding="utf-8")

    names = sorted(f.stem for f in licenses.TEXTS.glob("*.txt"))
    docs = [(i, "Copyright 2020 Someone. " * 7 + text(n) + " and code follows" * 9) for i, n in enumerate(names)]
    mit = text("mit").split()
    docs += [(100, "Licensed under the MIT License"), (101, " ".join(mit[: len(mit) * 9 // 10])), (102, " ".join(mit[: len(mit) // 2]))]
    docs += [(103, "it is distributed under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version")]
    docs += [(104, "w " * 9_000 + "\n# ".join(text("gpl-3.0").splitlines()) + " w" * 9_000), (105, "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.")]
    got = {(r["doc_id"], r["license"]): r["containment"] for r in licenses.licensed(documents(spark, docs)).collect()}
    assert all(got.get((i, n)) == 1.0 for i, n in enumerate(names))
    assert not [r for r in got if r[0] < 100 and got[r] == 1.0 and names[r[0]] != r[1] and (names[r[0]], r[1]) != ("bsd-3-clause", "bsd-2-clause")]
    assert {r for r in got if r[0] >= 100} == {(100, "mit"), (101, "mit"), (103, "lgpl-2.1"), (104, "gpl-3.0"), (105, "cc-by-sa-4.0")}
    assert got[104, "gpl-3.0"] == 1.0 and 0.8 <= got[101, "mit"] < 1


def test_license_plan_has_no_python(spark):
    plan = licenses.licensed(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in ("Python", "Arrow", "Pandas", "ExistingRDD", "Cartesian") if n in plan]


# Toxicity


def some_terms(draw, n, chance):
    """Texts of terms 100 and up, and with the given chances terms 1 and 2."""
    rows = []
    for _ in range(n):
        own = {k for k, p in enumerate(chance, 1) if draw.random() < p}
        rows.append(np.array(sorted(own | set(draw.integers(100, 400, 12).tolist()))))
    return rows


def score(machine, rows):
    return machine.score([np.sort(machine.kept[r][machine.kept[r] >= 0]) for r in rows])


def test_machine_learns_a_pair_of_which_neither_term_tells():
    """Toxic is exactly one of two terms: each alone is in as many clean texts as toxic ones."""
    draw = np.random.default_rng(1)
    texts = some_terms(draw, 6000, (0.5, 0.5))
    one = np.array([(1 in t) != (2 in t) for t in texts])
    for term in (1, 2):
        assert abs(one[[term in t for t in texts]].mean() - one.mean()) < 0.05
    machine = toxicity.fit(texts[:4000], one[:4000])
    assert machine.kept[1] >= 0 and machine.kept[2] >= 0
    assert ((score(machine, texts[4000:]) >= 0.5) == one[4000:]).mean() > 0.98


def test_machine_learns_a_neutral_mention_beside_an_insult():
    draw = np.random.default_rng(2)
    texts = some_terms(draw, 6000, (0.1, 0.2))  # 1 insults, 2 mentions a group
    chance = [0.95 if 1 in t and 2 in t else 0.3 if 1 in t else 0.02 for t in texts]
    machine = toxicity.fit(texts, draw.random(len(texts)) < chance)
    both, insult, mention, none = score(machine, [np.array(x, int) for x in ([1, 2], [1], [2], [])])
    assert both > 0.8 and insult < 0.5 and mention < 0.1 and none < 0.1
    assert (machine.kept >= 0).sum() < 12  # words that say nothing stay out


def test_raw_score_by_force():
    draw = np.random.default_rng(3)
    machine = toxicity.Machine(np.arange(20), 0.3, draw.normal(size=20), draw.normal(size=(20, 4)))
    rows = [np.flatnonzero(draw.random(20) < p) for p in (0, 0.2, 0.5, 1)]
    want = [
        0.3 + sum(machine.weights[r]) + sum(machine.vectors[a] @ machine.vectors[b] for i, a in enumerate(r) for b in r[i + 1 :]) for r in rows
    ]
    assert np.allclose(machine.raw(rows), want)


def test_pair_counts_by_force(monkeypatch):
    draw = np.random.default_rng(4)
    rows = some_terms(draw, 300, (0.3, 0.6))
    labels = (draw.random(300) < 0.4).astype(float)
    left, right = np.array([1, 2, 101]), np.arange(100, 140)
    want = [[sum(w for r, w in zip(rows, weight) if a in r and b in r) for b in right] for weight in (np.ones(300), labels) for a in left]
    for frequent in (1024, 8):  # as matrices, and row by row
        monkeypatch.setattr(toxicity, "FREQUENT_SLOTS", frequent)
        monkeypatch.setattr(toxicity, "BLOCK_ROWS", 70)
        assert np.concatenate(toxicity.pair_counts(rows, labels, left, right)).tolist() == want


def test_toxicity_of_given_labels(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.toxicity(docs, labels)
    held = got.where("held_out").join(labels, "doc_id").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    right = sum(r["predicted"] == r["toxic"] for r in held) / len(held)
    assert right > 0.97 and sum(r["predicted"] for r in held) > 0.7 * sum(r["toxic"] for r in held)


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(3, 1, "a"), (3, 0, "b"), (4, None, "c"), (None, 1, "d"), (7, 0, "e")], "doc_id bigint, toxic int, score string")
    got = toxicity.toxicity(odd, labels).collect()
    assert len(got) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert rows(toxicity.toxicity(none, labels)) == []
    assert all(r["predicted"] == 0 for r in toxicity.toxicity(odd, labels.limit(0)).collect())
    kept = toxicity.drop_toxic(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == len(ODD_ROWS)


# Pipeline


def test_pipeline_stages(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"]
    kept = docs.select("*")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, kept, SMALL)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}-{np.random.randint(1 << 30)}"
        out.write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.count() > 0.7 * docs.count()
    assert {r["doc_id"] for r in pipeline.run(spark, SMALL).collect()} == {r["doc_id"] for r in kept.collect()}


def test_pipeline_takes_odd_rows_and_nothing(spark, odd, none):
    pipeline = importlib.import_module("corpus_pipeline")
    for docs in (odd, none):
        for _, stage in pipeline.STAGES:
            stage(spark, docs, SMALL).collect()
