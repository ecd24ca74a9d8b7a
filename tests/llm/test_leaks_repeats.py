"""Decontamination and passage removal against brute force."""

import hashlib
import random
import re
import tracemalloc

import pytest

from tallyspark.llm import decontaminate, repeats
from tests.conftest import rows
from tests.llm.conftest import ODD_ROWS, documents

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def leaks_by_force(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + width]), set()).update([] if item is None else [str(item)])
    out = []
    for doc, text in docs:
        w = words(text)
        hit, held = [False] * len(w), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                found = windows.get(tuple(w[k : k + size]))
                if found is not None:
                    held |= found
                    hit[k : k + size] = [True] * size
        out.append((doc, len(w), sum(hit), len(held), sorted(held)))
    return sorted(out, key=repr)


def test_index_finds_all_phrases():
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choice("ab") for _ in range(n))
    for _ in range(200):
        items = [(j, text(draw.randint(0, 6))) for j in range(draw.randint(0, 4))]
        docs = [(j, text(draw.randint(0, 40))) for j in range(5)]
        spans, held = decontaminate.search_shard([words_bytes(t) for _, t in docs], decontaminate.Phrases(items, 3))
        got = [(d, len(words(t)), sum(n for _, n in s), len(set(h)), sorted(set(h))) for (d, t), s, h in zip(docs, spans, held, strict=True)]
        assert sorted(got, key=repr) == leaks_by_force(docs, items, 3)


def words_bytes(text):
    return decontaminate.words_of(text)


ITEMS = [
    (1, "The same text twice, long enough to be ONE of the longer ones"),
    (2, "plain words"),
    (2, "plain words"),
    (3, None),
    (4, ""),
    (None, "no id but words in it"),
    (10, "words that go on plain words that go on plain words that go"),
]


@pytest.mark.parametrize("block", [1, 8 << 20])
def test_leaks_of_odd_rows(spark, odd, none, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block * (1 if block > 1 else 40))
    bench = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id bigint, text string, spans string")
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], sorted(r["items"])) for r in decontaminate.leaks(odd, bench).collect()]
    assert sorted(got, key=repr) == leaks_by_force(ODD_ROWS, ITEMS)
    assert rows(decontaminate.leaks(none, bench)) == []
    assert all(r["n_hit"] == 0 for r in decontaminate.leaks(odd, bench.limit(0)).collect())


def test_removal_keeps_clean_rows_and_columns(spark, odd):
    bench = spark.createDataFrame([(1, "plain words that go on"), (2, "long enough to be one")], "item_id bigint, text string")
    out = decontaminate.remove_leaks(odd, bench)
    assert out.schema.simpleString() == odd.schema.simpleString()
    texts = {r["doc_id"]: r for r in out.collect()}
    assert len(out.collect()) == len(ODD_ROWS)
    assert texts[7]["text"] == "the same text twice,  of the longer ones here" and texts[7]["n_chars"] == len(texts[7]["text"])
    assert texts[6]["text"].strip() == ""
    assert texts[5]["text"] == dict(ODD_ROWS[:5])[5] and texts[5]["n_chars"] == len(texts[5]["text"])


def removed_by_force(docs):
    first = {}
    for doc, text in docs:
        data = (text or "").encode()
        for i in range(len(data) - 49 if doc is not None else 0):
            key = data[i : i + 50]
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 49 if doc is not None else 0):
            if first[data[i : i + 50]] < doc:
                gone[i : i + 50] = b"\1" * 50
        spans = sum(1 for i in range(len(data)) if gone[i] and (not i or not gone[i - 1]))
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def mixed_passages():
    draw = random.Random(5)
    base = ["".join(draw.choice("abcde é ") for _ in range(400)) for _ in range(5)]

    def piece():
        text = draw.choice(base)
        at = draw.randrange(len(text))
        return text[at : at + draw.randint(1, 200)]

    docs = [
        (i, "".join(draw.choice([piece(), "xyz"[i % 3] * draw.randint(0, 120), "".join(draw.choice("abcdefgh") for _ in range(60))]) for _ in range(draw.randint(0, 5))))
        for i in range(90)
    ]
    return docs + [(500, None), (502, "a" * 50), (503, "a" * 49), (504, "a" * 51), (3, docs[3][1]), (4, "zz" + base[0]), (None, base[0]), (505, "a" * 9000)]


@pytest.mark.parametrize("docs", [ODD_ROWS, mixed_passages()], ids=["odd", "passages"])
def test_repeats_against_brute_force(spark, docs):
    assert rows(repeats.repeats(documents(spark, docs)).drop("spans")) == removed_by_force(docs)


def test_shards_and_buckets_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 900)
    monkeypatch.setattr(repeats, "BUCKET_TEXT", 3000)
    docs = mixed_passages()
    assert rows(repeats.repeats(documents(spark, docs)).drop("spans")) == removed_by_force(docs)


def test_repeats_of_nothing(spark, none):
    assert rows(repeats.repeats(none)) == []


def test_remove_repeats_keeps_rows_and_columns(spark, odd):
    out = repeats.remove_repeats(odd)
    assert out.schema.simpleString() == odd.schema.simpleString()
    got = out.collect()
    assert len(got) == len(ODD_ROWS)
    assert {r["text"] for r in got if r["doc_id"] == 8} == {""} and {r["n_chars"] for r in got if r["doc_id"] == 8} == {0}
    assert {r["text"] for r in got if r["doc_id"] == 11} == {dict(ODD_ROWS)[11]}


def bucket_of_texts(texts):
    """A bucket's entries: all phrases of each text, sent by a shard of its own."""
    found = []
    for doc, text in enumerate(texts):
        batch = repeats.pa.RecordBatch.from_pydict({"doc_id": [doc], "tag": [0], "text": [text]})
        of, start, size, hi, lo = repeats.Shard([text]).phrases()
        order = repeats.np.lexsort((lo, hi))
        bucket = repeats.np.zeros(len(hi), repeats.np.int64)
        found.append(repeats.entries(batch, of, start, size, hi, lo, bucket, order, repeats.runs_of(order, hi, lo), later=True))
    return repeats.pa.Table.from_batches(found)


def test_a_bucket_takes_few_times_its_own_size():
    draw = random.Random(5)
    own = ["".join(draw.choices("abcdefghij ", k=400_000)) for _ in range(8)]
    table = bucket_of_texts([*own, own[0][:300_000]])
    tracemalloc.start()
    out = repeats.answers(later=True)(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.column("doc_id").to_pylist() == [8]
    assert peak < 3 * table.nbytes


def test_a_bucket_without_shared_digests_answers_nothing():
    draw = random.Random(6)
    table = bucket_of_texts(["".join(draw.choices("abcdefghij ", k=5_000)) for _ in range(3)])
    assert repeats.answers(later=True)(table).num_rows == 0
