"""Near-duplicates, components and edit fingerprints."""

import hashlib
import random
import re

import pytest

from tallyspark.llm import fingerprints, neardup
from tallyspark.llm.components import connected
from tests.conftest import SMALL, rows
from tests.llm.conftest import ODD_ROWS, documents

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, width):
    w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def components_by_force(docs, width):
    held = {}
    for doc, text in docs:
        held.setdefault(doc, []).append(shingles(text, width))
    parent = {d: d for d in held if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(parent)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in held[a] for y in held[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted(
        ((d, len(shingles(t, width)), None if d is None else root(d), d is None or root(d) == d) for d, t in docs), key=repr
    )


def families(seed=2):
    """Families of edited copies, with similarities on both sides of the threshold."""
    draw = random.Random(seed)
    docs = []
    for _ in range(6):
        base = [draw.choice("abcdefghijklmnop") + draw.choice("xyz") for _ in range(60)]
        for copy in range(12):
            text = list(base)
            for _ in range(draw.randint(0, 7)):
                text[draw.randrange(60)] = "new%d" % draw.randrange(50)
            docs.append((len(docs), " ".join(text).upper() if copy % 2 else "\n".join(text)))
    draw.shuffle(docs)
    return docs


@pytest.mark.parametrize("width", [2, 5])
def test_families_against_brute_force(spark, width):
    docs = families()
    assert rows(neardup.near_duplicates(documents(spark, docs), width)) == components_by_force(docs, width)


def test_odd_rows(spark, odd, none):
    assert rows(neardup.near_duplicates(odd, 2)) == components_by_force(ODD_ROWS, 2)
    assert rows(neardup.near_duplicates(none, 2)) == []


def test_dropping_keeps_one_of_each_group(spark, odd):
    out = neardup.drop_near_duplicates(odd)
    assert out.columns == odd.columns
    want = [d for d, _, _, kept in components_by_force(ODD_ROWS, 5) if kept]
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_miss_probabilities():
    assert (1 - 0.8**neardup.BAND_ROWS) ** neardup.BANDS < 1e-6
    assert neardup.differing_bits(80) < 64 * neardup.SKETCH_WORDS * 0.15


def test_components_of_paths_and_rings(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(60, 50), (50, 70), (70, 60), (5, 5), (None, 3), (80, 81), (81, 80)]
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(links, "x bigint, y bigint"), "x", "y").collect()}
    assert got == {**dict.fromkeys(range(41), 0), 50: 50, 60: 50, 70: 50, 80: 80, 81: 80}


# Fingerprints


def edited_by_force(docs):
    """(doc_id, n_chars, sha) with the next document in descending order."""
    ordered = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [t or "" for _, t in ordered]
    out = []
    for i, (doc, _) in enumerate(ordered):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        out.append((doc, len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_fingerprints_of_odd_rows(spark, odd, none):
    got = fingerprints.document_fingerprints(odd).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == edited_by_force(ODD_ROWS)
    texts = dict(ODD_ROWS)
    same = {r["fingerprint"] for r in got if texts[r["doc_id"]] == texts[7]}
    assert len(same) == 1 and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert rows(fingerprints.document_fingerprints(none)) == []
    one = fingerprints.document_fingerprints(documents(spark, [(1, "alone here")])).collect()
    assert [(r["near_next"], r["n_chars"]) for r in one] == [(1.0, 10)]


def test_fingerprints_over_partitions(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = fingerprints.document_fingerprints(documents(spark, docs, 7)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == edited_by_force(docs)
    alone = dict(zip((d for d, _ in docs), fingerprints.fingerprints([t or "" for _, t in docs]), strict=True))
    assert all(alone[r["doc_id"]] == r["fingerprint"] for r in got)


def test_likeness_follows_edits():
    draw = random.Random(4)
    text = "".join(draw.choice("abcdefgh ") for _ in range(4000))

    def edited(n):
        chars = list(text)
        for _ in range(n):
            at = draw.randrange(len(chars))
            if draw.random() < 0.5:
                del chars[at]
            else:
                chars.insert(at, draw.choice("abcdefgh "))
        return "".join(chars)

    mean = lambda n: sum(fingerprints.likeness(*fingerprints.fingerprints([text, edited(n)])) for _ in range(12)) / 12
    few, some, many = mean(2), mean(40), mean(1500)
    assert few > some > many and few > 0.8
    half = fingerprints.likeness(*fingerprints.fingerprints([text, text[:2000] + "z" * 2000]))
    assert 0.4 < half < 0.6
    assert fingerprints.likeness(*fingerprints.fingerprints(["", ""])) == 1.0
    assert fingerprints.likeness(*fingerprints.fingerprints(["", text])) == 0.0


def test_near_documents_share_bands(spark):
    draw = random.Random(9)
    base = ["".join(draw.choice("abcdefgh ") for _ in range(1500)) for _ in range(10)]
    docs = [(i, t) for i, t in enumerate(base)] + [(100 + i, t[:1400] + "!" + t[1400:]) for i, t in enumerate(base)] + [(200, base[0]), (None, base[1]), (201, "")]
    got = {r["doc_id"]: r["component_id"] for r in fingerprints.near_documents(documents(spark, docs)).collect()}
    assert got[200] == 0 and got[None] is None and got[201] == 201
    assert sum(got[100 + i] == i for i in range(10)) >= 8 and len({got[i] for i in range(10)}) == 10


@pytest.mark.parametrize("where", ["front", "middle", "end", "longer"])
def test_bands_find_what_brute_force_finds(where):
    """Pairs of likeness 0.8 to 0.9, of lengths on both sides of levels' edges, wherever the edit stands."""
    draw = random.Random(where)
    some = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    near = found = 0
    for k in range(400):
        n = draw.choice([180, 250, 330, 345, 420, 600, 680, 700, 1100, 1365, 1400, 2000])
        a, m = some(n), int(n * draw.uniform(0.1, 0.22))
        at = {"front": 0, "middle": n // 2 - m // 2, "end": n - m, "longer": n}[where]
        b = a + some(m) if where == "longer" else a[:at] + some(m) + a[at + m :]
        x, y = fingerprints.fingerprints([a, b])
        if 0.8 <= fingerprints.likeness(x, y) <= 0.9:
            near += 1
            found += bool(set(fingerprints.bands(x)) & set(fingerprints.bands(y)))
    assert near >= 30 and found >= 0.95 * near, (near, found)
