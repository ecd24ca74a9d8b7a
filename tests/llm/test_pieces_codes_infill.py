"""SentencePiece ids, vector codes and fill-in-middle against the library, plain arithmetic and round trips."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.llm import codes, infill, pieces
from tallyspark.llm.queries import QUERIES
from tests.conftest import SMALL, rows
from tests.llm.conftest import ODD_ROWS

SP = public_tokenizers.path(pieces.MODEL)
LIBRARY = pieces.processor(SP)
VOCABULARY = [LIBRARY.id_to_piece(i) for i in range(259, 32_000, 7)]
LETTERS = list("ab .,\n\t▁é日本\x00'<|>1Ωж") + ["the", " of ", "  ", "</s>", "<0x0A>", "\U0001f600"]


# SentencePiece


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(LETTERS), max_size=40).map("".join))
def test_ids_of_any_text(text):
    assert pieces.unpacked(pieces.word_ids(SP).of_text(text)) == LIBRARY.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(VOCABULARY), min_size=1, max_size=10).map("".join))
def test_table_alone_gives_the_ids(text):
    """Vocabulary strings side by side, not cut at spaces: every kind of merge across them."""
    table = pieces.word_ids(SP).table
    assert table.of_text("▁" + text) == LIBRARY.encode(text)


def test_each_prefix_has_the_last_token_of_its_own_encoding():
    table = pieces.word_ids(SP).table
    text = "▁unbelievably▁preencoded,▁日本x"
    for end, token in enumerate(table.last_tokens(text), 1):
        if token is not None:
            own = table.bare.encode(text[:end])
            assert own[-len(table.ids[token]) :] == table.ids[token]


def test_long_text_without_a_space():
    text = "abcdefghijklmnopqrstuvwxyz" * 8000
    assert pieces.unpacked(pieces.word_ids(SP).of_text(text)) == LIBRARY.encode(text)


def test_encoding_and_decoding_of_odd_rows(spark, odd, none):
    ids = {(d, t): [1, *LIBRARY.encode(t or ""), 2] for d, t in ODD_ROWS}
    got = [(r[0], pieces.unpacked(bytes(r[1])), r[2]) for r in pieces.decode(pieces.encode(odd)).collect()]
    want = [(d, i, LIBRARY.decode(i)) for (d, _), i in ids.items()]
    want.append(next(w for w in want if w[0] == 7))  # the repeated row
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert rows(pieces.decode(pieces.encode(none))) == []


def test_decoding_of_absent_ids(spark):
    encoded = spark.createDataFrame([(1, None), (2, b"")], "doc_id bigint, ids binary")
    assert rows(pieces.decode(encoded)) == [(1, None, None), (2, bytearray(), "")]


def test_op11_over_its_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r in docs:
        ids = [1, *LIBRARY.encode(r["text"] or ""), 2]
        want.append((r["doc_id"], len(ids), hashlib.sha256(pieces.packed(ids)).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    assert rows(QUERIES["op11_sentencepiece"](spark, SMALL)) == sorted(want, key=repr)


# Vector codes


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_tree_finds_the_nearest_and_lowest_entry(data):
    width = data.draw(st.integers(1, 4))
    size = data.draw(st.sampled_from([1, 3, 40, codes.LARGEST]))
    vectors = st.lists(st.integers(-size, size), min_size=width, max_size=width)
    entries = np.array(data.draw(st.lists(vectors, min_size=1, max_size=16)))
    queries = np.concatenate([entries, np.array(data.draw(st.lists(vectors, min_size=1, max_size=20)))])
    entry, squared = codes.Search(entries).nearest(queries)
    all_squared = ((queries[:, None] - entries[None]) ** 2).sum(2)
    assert entry.tolist() == all_squared.argmin(1).tolist() and squared.tolist() == all_squared.min(1).tolist()


def test_tree_rules_subtrees_out():
    rng = np.random.default_rng(1)
    centres = rng.integers(-100_000, 100_000, (16, 2))
    queries = centres[rng.integers(0, 16, 5000)] + rng.integers(-50, 50, (5000, 2))
    search = codes.Search(centres)
    search.nearest(queries)
    assert search.computed < 0.6 * 16 * len(queries)


def by_force(table, parts=8, entries=16, rounds=6):
    """(vec_id, label, vector) rows to query rows, in Python integers."""
    kept = [(i, l, [int(np.floor(4096 * x)) for x in v]) for i, l, v in table if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0]))
    width = len(kept[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in kept]
    books = [[cut[e][p] for e in range(min(entries, len(kept)))] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for c in cut:
                held.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for e, own in held.items():
                books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = []
    for (i, l, _), c in zip(kept, cut):
        found = [nearest(part, books[p]) for p, part in enumerate(c)]
        coded.append((i, l, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    sums = {}
    for _, l, _, e in coded:
        sums[l] = sums.get(l, 0) + e
    return sorted([(i, c, e, sums[l], digest) for i, l, c, e in coded], key=repr)


EMBEDDINGS = "vec_id bigint, embedding array<float>, label int, code string, error bigint, numbers string, _label string"


def embeddings(spark, table, parts=3):
    df = spark.createDataFrame([(i, v, l, "x", None, None, "y") for i, l, v in table], EMBEDDINGS)
    return df.repartition(parts) if table else df


def some_vectors(n, width=16, seed=3):
    rng = np.random.default_rng(seed)
    table = [(int(i), int(i) % 3 or None, [float(x) for x in rng.normal(0, 0.2, width).astype("f4")]) for i in rng.permutation(n)]
    return table + [(-5, 1, None), (-4, 1, [0.5, None] * (width // 2)), (-3, None, [float("nan")] * width), (-2, 2, [0.1] * (width - 1) + [float("inf")])]


def test_codes_by_force(spark):
    table = some_vectors(120)
    table += [table[5], (None, 2, table[6][2]), (500, None, table[7][2]), (501, None, table[7][2])]  # repeats, ties, a null id
    assert rows(codes.compress(embeddings(spark, table))) == by_force(table)


def test_codes_of_few_and_no_vectors(spark):
    table = [(3, 1, [0.25] * 8), (1, None, [-0.5] * 8), (2, 1, None), (4, 1, [])]
    assert rows(codes.compress(embeddings(spark, table))) == by_force(table)
    assert rows(codes.compress(embeddings(spark, []))) == []
    assert rows(codes.compress(embeddings(spark, [(1, 1, None)]))) == []
    # A vector of another length than the first has no codebook.
    assert rows(codes.compress(embeddings(spark, [*table, (9, 1, [0.1] * 16)]))) == by_force(table)


def test_codes_do_not_follow_the_partitions(spark):
    table = some_vectors(60, seed=8)
    assert rows(codes.compress(embeddings(spark, table, parts=1))) == rows(codes.compress(embeddings(spark, table, parts=7)))


def test_labels_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr("tallyspark.operators.joins.rows_within", lambda *a: False)
    table = some_vectors(60)
    assert rows(codes.compress(embeddings(spark, table))) == by_force(table)


def test_large_components_raise():
    import pyarrow as pa

    with pytest.raises(ValueError, match="magnitude"):
        codes.whole_numbers(pa.array([[1e30]]), codes.SCALE)


# Fill-in-middle


def arranged_by_force(doc_id, text, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<P>|<S>|<M>", text) or h3 % 100 >= fim:
        return doc_id, n, "plain", None, None, text, text
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


LINES = st.lists(st.sampled_from(["\n", "a", "é日", "\r", "<", "P>", "<P", "S>", "\x0b ", "\U0001f600 ", "\x00"]), max_size=14).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), LINES), max_size=8), st.integers(0, 2**31), st.sampled_from([(100, 50), (60, 0), (100, 100)]))
def test_any_texts_are_arranged_and_restored(texts, first, percent):
    import pyarrow as pa

    ids = list(range(first, first + len(texts)))
    digests = [hashlib.sha256(f"7:{i}".encode()).hexdigest() for i in ids]
    draws = [np.array([int(d[8 * k : 8 * k + 8], 16) for d in digests], np.int64) for k in range(4)]
    got = infill.arrange(pa.array(ids, pa.int64()), pa.array(texts, pa.string()), draws, *percent)
    restored = infill.rebuild(got.column("output"), got.column("form")).to_pylist()
    found = [(*r.values(), t) for r, t in zip(got.to_pylist(), restored, strict=True)]
    assert found == [arranged_by_force(i, t, *percent) for i, t in zip(ids, texts, strict=True)]


def test_fill_in_middle_of_odd_rows(spark, odd, none):
    lined = odd.withColumn("text", F.replace("text", F.lit(" "), F.lit("\n")))
    want = sorted((arranged_by_force(d, t and t.replace(" ", "\n")) for d, t in ODD_ROWS), key=repr)
    assert rows(infill.restore(infill.fill_in_middle(lined))) == want
    assert rows(infill.restore(infill.fill_in_middle(none))) == []


def test_sentinels_in_texts_stay_plain(spark):
    docs = spark.createDataFrame([(i, f"a\nb{s}\nc") for i, s in enumerate(("<P>", "<S>", "<M>", "<X>"))], "doc_id bigint, text string")
    forms = {r["doc_id"]: r["form"] for r in infill.fill_in_middle(docs).collect()}
    assert [forms[i] == "plain" for i in range(4)] == [True, True, True, False]
