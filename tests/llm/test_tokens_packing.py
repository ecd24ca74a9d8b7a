"""Token counts and packing against the tokenizers themselves."""

import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import packing, tokens
from tests.conftest import SMALL, rows
from tests.llm.conftest import ODD_ROWS

SP = public_tokenizers.path(tokens.MODEL)
WORD = public_tokenizers.path(packing.MODEL)


def test_proof_covers_the_vocabulary():
    proof = tokens.prove(SP)
    assert proof.cuts_at_spaces and len(proof.whole) > 10_000
    assert all(len(tokens.processor(SP).encode(w)) == 1 for w in list(proof.whole)[:500])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list("ab .,\n\t▁é日\x00'<|>1") + ["the", " of ", "  ", "<s>"]), max_size=40).map("".join))
def test_counts_and_ids_of_any_text(text):
    counts = tokens.word_counts(SP, tokens.prove(SP))
    assert counts.of_text(text) == len(tokens.processor(SP).encode(text))
    want = packing.tokenizer(WORD).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.word_ids(WORD).of_texts([text])[0], "<u4").tolist() == want


def test_words_are_learnt_from_their_bytes():
    words = ["naïve,", "été!?", "été", "ŋa", "ɐb", "ɐb.", "ªº", "ǆ|", "...", "x1", "日", "a\u0301,"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}é;" for i in range(600)]
    found = packing.WordIds(WORD).learn([w.encode() for w in words])
    for word in words:
        want = packing.tokenizer(WORD).encode(word, add_special_tokens=False).ids
        assert np.frombuffer(found[word.encode()], "<u4").tolist() == want
    assert "été".encode() in found


def test_words_stand_alone_only_where_the_file_proves_it(spark, odd, tmp_path):
    assert packing.word_by_word(WORD)
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert not packing.word_by_word(other)
    texts = ["The  quick\tfox's <|x 12", "", None, "one\n two"]
    want = [packing.tokenizer(other).encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.word_ids(other).of_texts(texts)] == want
    spec = json.loads(open(WORD, encoding="utf-8").read())
    changes = [("normalizer", None), ("pre_tokenizer", None), ("model", spec["model"] | {"end_of_word_suffix": None})]
    for number, (part, value) in enumerate(changes):
        changed = tmp_path / f"{number}.json"
        changed.write_text(json.dumps(spec | {part: value}), encoding="utf-8")
        assert not packing.word_by_word(str(changed)), part
    cutting = tmp_path / "cutting.json"
    cutting.write_text(json.dumps(spec | {"truncation": {"direction": "Right", "max_length": 4, "strategy": "LongestFirst", "stride": 0}}), encoding="utf-8")
    assert len(packing.tokenizer(str(cutting)).encode("a b c d e f g h", add_special_tokens=False).ids) == 8


def test_token_counts_of_odd_rows(spark, odd, none):
    want = sorted(
        ((d, len((t or "").encode()), n := len(tokens.processor(SP).encode(t or "")), n > 4096) for d, t in ODD_ROWS), key=repr
    )
    assert rows(tokens.token_counts(odd)) == want
    assert rows(tokens.token_counts(none)) == []


def pieces_of(text, capacity):
    ids = packing.tokenizer(WORD).encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
    for k, b in enumerate(range(0, len(ids), capacity)):
        part = ids[b : b + capacity]
        yield k, b, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_of_odd_rows(spark, odd, none, capacity):
    got = rows(packing.pack(odd, capacity=capacity))
    assert sorted((r[:5] for r in got), key=repr) == sorted(((d, *p) for d, t in ODD_ROWS for p in pieces_of(t, capacity)), key=repr)
    check_sequences(got, capacity)
    assert rows(packing.pack(none)) == []


def check_sequences(got, capacity):
    sequences = defaultdict(list)
    for r in got:
        sequences[r[5]].append((r[6], r[3]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r[3] for r in got) // capacity)
    return len(sequences), least


def test_packing_is_near_the_bound(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    used, least = check_sequences(rows(packing.pack(docs)), 4096)
    assert used <= least + 2


def test_packed_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "some words, and more " * i) for i in range(40)], "doc_id bigint, text string")
    placed = {(r["sequence_id"], r["offset"]): r for r in packing.pack(docs, capacity=50).collect()}
    for row in packing.packed_sequences(docs, capacity=50).collect():
        at = 0
        while at < len(row["ids"]):
            piece = placed[row["sequence_id"], at]
            assert zlib.crc32(np.asarray(row["ids"][at : at + piece["length"]], "<u4").tobytes()) == piece["ids_crc32"]
            at += piece["length"]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 100), st.integers(1, 300), max_size=30))
def test_plan_covers_every_rank_once(histogram):
    runs = packing.plan(histogram, capacity=100)
    seen = defaultdict(list)
    for run in runs:
        at = 0
        for length, first, offset in run.slots:
            assert offset == at
            at += length
            seen[length].append((first, run.count))
        assert at + run.room == 100
    for length, count in histogram.items():
        at = 0
        for first, n in sorted(seen[length]):
            assert first == at
            at += n
        assert at == count


def test_linear_program_beats_greedy_on_thirds():
    histogram = {1500: 1000, 2596: 1000, 1365: 3000}
    assert sum(r.count for r in packing.plan(histogram)) == 2000
