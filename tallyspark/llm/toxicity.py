"""Toxicity scores by a factorization machine over hashed terms.

A document's terms are its distinct lower-cased words and their first letters (long compounds share them), hashed to a
fixed number of slots. The model is a bias, a weight and a short vector per slot: a pair of terms adds the product of
their vectors, which no sum of single weights can say. It is fitted on a bounded sample of labelled rows. Slots are kept
whose presence tells the classes apart in the sample, alone or together with another slot: of a pair whose rows are
toxic more or less often than its two slots lead to expect, both stay, even if neither says anything alone. The rest
goes, so that long texts don't drown in slots that say nothing. Scoring reads every whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.decontaminate import words_of
from tallyspark.llm.tables import arrow_rows, own_prefix

#: Labelled rows the model is fitted on at most: those with the smallest hash of doc_id.
SAMPLE_ROWS = 12_000
SLOT_BITS = 18
PREFIXES = (4, 5, 6, 7)
FACTORS = 4
EPOCHS = 12
BATCH = 64
RATE = 0.1
SHRINK = 2e-4
#: A slot is kept if it occurs in so many sample rows and its chi-square statistic is so large (p < 1e-6).
LEAST_ROWS = 5
LEAST_CHI2 = 24.0
#: Pairs are looked for between so many of the slots that tell most alone and every slot, and among so many of the most
#: frequent slots. A pair counts if its statistic is so large (p < 3e-10: there are millions of pairs).
TELLING_SLOTS = 64
FREQUENT_SLOTS = 1024
LEAST_PAIR_CHI2 = 40.0
#: Rows whose slots are laid out as a matrix at a time, and slots whose pairs are weighed at a time.
BLOCK_ROWS = 1000
BLOCK_SLOTS = 8192
SEED = 7
CACHE_WORDS = 150_000
FOLDS = 5


class Terms:
    """Slots of a text's terms; with `kept` (a slot's number or -1), only numbers of kept ones."""

    def __init__(self, kept: np.ndarray | None = None) -> None:
        self.kept = kept
        self.known: dict[bytes, tuple[int, ...]] = {}

    def slots(self, word: bytes) -> tuple[int, ...]:
        text = word.decode(errors="ignore")
        terms = [word] + [b"^" + text[:n].encode() for n in PREFIXES if len(text) > n]
        found = {zlib.crc32(t) & ((1 << SLOT_BITS) - 1) for t in terms}
        out = tuple(found) if self.kept is None else tuple(int(k) for k in self.kept[list(found)] if k >= 0)
        if len(self.known) < CACHE_WORDS and len(word) <= 48:
            self.known[word] = out
        return out

    def of(self, text: str | None) -> np.ndarray:
        known, slots = self.known.get, self.slots
        out: set[int] = set()
        for word in set(words_of((text or "").lower())):
            found = known(word)
            out.update(slots(word) if found is None else found)
        return np.fromiter(out, np.int64, len(out))


@dataclass
class Machine:
    """bias + sum of weights + sum over pairs of vector products, over the kept slots a text has."""

    kept: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def raw(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        sizes = np.array([len(r) for r in rows])
        filled = np.flatnonzero(sizes)
        if len(filled):
            ids = np.concatenate([rows[i] for i in filled])
            at = np.concatenate(([0], np.cumsum(sizes[filled])[:-1]))
            v = self.vectors[ids]
            total, squares = np.add.reduceat(v, at), np.add.reduceat(v * v, at)
            out[filled] += np.add.reduceat(self.weights[ids], at) + 0.5 * (total**2 - squares).sum(axis=1)
        return out

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(rows), -30, 30)))


def surprising(have: np.ndarray, toxic: np.ndarray, left: np.ndarray, right: np.ndarray, rate: float) -> np.ndarray:
    """Pairs that are toxic more often, or less, than either slot and than both slots' log odds added.

    Words that only come together, or of which one only comes with the other, lie between the slots' own rates."""

    def odds(p: np.ndarray | float) -> np.ndarray:
        return np.log(p) - np.log1p(-p)

    def beyond(p: np.ndarray, sign: int) -> np.ndarray:
        apart = sign * (toxic - have * p)
        return (apart > 0) & (apart**2 >= LEAST_PAIR_CHI2 * (have * p * (1 - p) + 1))

    have, toxic = have.astype(np.float32), toxic.astype(np.float32)
    left, right, rate = left[:, None].astype(np.float32), right[None, :].astype(np.float32), np.float32(rate)
    added = 1 / (1 + np.exp(-np.clip(odds(left) + odds(right) - odds(rate), -30, 30)))
    above = beyond(np.maximum(left, right), 1) & beyond(added, 1)
    return (have >= LEAST_ROWS) & (above | beyond(np.minimum(left, right), -1) & beyond(added, -1))


def pair_counts(rows: list[np.ndarray], labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows, and toxic rows, that hold a slot of `left` and one of `right`."""
    number = np.uint16 if len(rows) < 1 << 16 else np.uint32
    dense = len(right) <= FREQUENT_SLOTS  # slots so frequent that matrices are full
    have, toxic = (np.zeros((len(left), len(right)), np.float32 if dense else number) for _ in range(2))
    at = []
    for slots in (left, right):
        at.append(np.full(1 << SLOT_BITS, -1, np.int32))
        at[-1][slots] = np.arange(len(slots))
    for b in range(0, len(rows), BLOCK_ROWS):
        part, label = rows[b : b + BLOCK_ROWS], labels[b : b + BLOCK_ROWS]
        if dense:
            there = []
            for column, n in zip(at, (len(left), len(right)), strict=True):
                block = np.zeros((len(part), n + 1), np.float32)
                block[np.repeat(np.arange(len(part)), [len(r) for r in part]), column[np.concatenate(part)]] = 1
                there.append(block[:, :n])
            have += there[0].T @ there[1]
            toxic += there[0].T @ (there[1] * label[:, None].astype(np.float32))
            continue
        for r, y in zip(part, label, strict=True):
            own = at[0][r]
            own = own[own >= 0]
            if len(own):
                pairs = np.ix_(own, at[1][r][at[1][r] >= 0])
                have[pairs] += 1
                if y:
                    toxic[pairs] += 1
    return have, toxic


def telling_slots(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """For each slot its number among the kept ones, or -1."""
    n, positive = len(labels), labels.sum()
    have, both = np.zeros((2, 1 << SLOT_BITS))
    for b in range(0, n, BLOCK_ROWS):
        part = rows[b : b + BLOCK_ROWS]
        ids = np.concatenate(part).astype(np.int64)
        have += np.bincount(ids, minlength=1 << SLOT_BITS)
        both += np.bincount(ids, weights=np.repeat(labels[b : b + BLOCK_ROWS], [len(r) for r in part]), minlength=1 << SLOT_BITS)
    expected = have * positive / max(n, 1)
    spread = expected * (1 - positive / max(n, 1)) * (1 - have / max(n, 1))
    chi2 = np.where(spread > 0, (both - expected) ** 2 / np.maximum(spread, 1e-9), 0)
    keep = (have >= LEAST_ROWS) & (chi2 >= LEAST_CHI2)
    if 0 < positive < n:
        known = np.flatnonzero(have >= LEAST_ROWS)
        alone = np.flatnonzero(keep)
        alone = alone[np.argsort(-chi2[alone], kind="stable")[:TELLING_SLOTS]]
        frequent = known[np.argsort(-have[known], kind="stable")[:FREQUENT_SLOTS]]
        rate = positive / n
        own = (both + rate) / (have + 1)
        for left, right in ((alone, known), (frequent, frequent)):
            pairs, toxic_pairs = pair_counts(rows, labels, left, right)
            for b in range(0, len(right), BLOCK_SLOTS):
                block, some = slice(b, b + BLOCK_SLOTS), right[b : b + BLOCK_SLOTS]
                told = surprising(pairs[:, block], toxic_pairs[:, block], own[left], own[some], rate)
                told &= left[:, None] != some[None, :]
                keep[left[told.any(axis=1)]] = True
                keep[some[told.any(axis=0)]] = True
    return np.where(keep, np.cumsum(keep) - 1, -1)


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Logistic loss, adaptive steps over mini-batches in a seeded order. Without both classes: the base rate alone."""
    labels = labels.astype(float)
    kept = telling_slots(rows, labels)
    size = int(kept.max(initial=-1)) + 1
    rate = (labels.sum() + 0.5) / (len(labels) + 2.0)
    draw = np.random.default_rng(SEED)
    m = Machine(kept, float(np.log(rate / (1 - rate))), np.zeros(size), draw.normal(0, 0.01, (size, FACTORS)))
    rows = [np.sort(kept[r][kept[r] >= 0]) for r in rows]
    if not size:
        return m
    g_bias, g_w, g_v = 1e-8, np.full(size, 1e-8), np.full((size, FACTORS), 1e-8)
    for _ in range(EPOCHS):
        order = draw.permutation(len(rows))
        for b in range(0, len(order), BATCH):
            part = order[b : b + BATCH]
            error = m.score([rows[i] for i in part]) - labels[part]
            sizes = [len(rows[i]) for i in part]
            ids = np.concatenate([rows[i] for i in part])
            g_bias += error.mean() ** 2
            m.bias -= RATE * error.mean() / np.sqrt(g_bias)
            if not len(ids):
                continue
            of = np.repeat(np.arange(len(part)), sizes)
            v = m.vectors[ids]
            total = np.zeros((len(part), FACTORS))
            np.add.at(total, of, v)
            slots, inverse = np.unique(ids, return_inverse=True)
            step_w, step_v = np.zeros(len(slots)), np.zeros((len(slots), FACTORS))
            np.add.at(step_w, inverse, error[of])
            np.add.at(step_v, inverse, error[of][:, None] * (total[of] - v))
            step_w = step_w / len(part) + SHRINK * m.weights[slots]
            step_v = step_v / len(part) + SHRINK * m.vectors[slots]
            g_w[slots] += step_w**2
            g_v[slots] += step_v**2
            m.weights[slots] -= RATE * step_w / np.sqrt(g_w[slots])
            m.vectors[slots] -= RATE * step_v / np.sqrt(g_v[slots])
    return m


def fold(doc_id: str = "doc_id") -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """The model from labelled rows outside the held-out fold, from a bounded sample of them."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic")
    )
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(fold() != 0)
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")  # at most sample_rows rows
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("slots", pa.binary())])

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Terms().of
        for batch in batches:
            slots = [np.sort(of(t)).astype(np.int32).tobytes() for t in batch.column(2).to_pylist()]
            yield arrow_rows(schema, doc_id=batch.column(0), toxic=batch.column(1), slots=slots)

    # Repeated doc_ids may give more rows than the sample has ids; the smallest hashes stay.
    gathered = joined.mapInArrow(terms, "doc_id bigint, toxic int, slots binary")
    sample = gathered.orderBy(F.xxhash64("doc_id"), "doc_id", "slots").limit(sample_rows).collect()
    toxic = np.array([r["toxic"] for r in sample], float)
    rows = [np.frombuffer(r["slots"], np.int32) for r in sample]
    del sample  # the rows share its bytes; the driver holds them once
    return fit(rows, toxic)


def scored(docs: DataFrame, machine: Machine, score: str) -> DataFrame:
    """docs, all columns, and a score column."""
    model = docs.sparkSession.sparkContext.broadcast(machine)  # a number per slot and the kept slots
    names = docs.columns
    at = names.index("text")
    schema = docs.withColumn(score, F.lit(0.0)).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Terms(model.value.kept).of
        for batch in batches:
            scores = model.value.score([of(t) for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*names, score])

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(add, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    A null or empty text has no terms and gets the score of the bias. A null doc_id is scored and not held out.
    Without labels, or with one class only, the score is the smoothed base rate. Repeated rows each return a row.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = scored(rows, train(docs, labels), "score")
    held = F.coalesce(fold() == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that the model rejects."""
    score = own_prefix(docs) + "score"
    text_type = docs.schema["text"].dataType
    kept = scored(docs, train(docs, labels), score).where(F.col(score) < 0.5)
    return kept.withColumn("text", F.col("text").cast(text_type)).select(*docs.columns)
