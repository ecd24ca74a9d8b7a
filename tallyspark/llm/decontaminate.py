"""Benchmark decontamination with an FM-index per training shard.

A shard is one Arrow batch of documents. Its words become symbols: the words that occur in benchmark phrases, and one
separator for all others. Runs of phrase words shorter than the shortest phrase can't hold one, so only the other runs
enter the index. Phrases are searched backwards through the ranks of a wavelet matrix over the shard's
Burrows-Wheeler transform, all phrases at once; occurrences are located by walking to sampled suffix positions; hit
words merge into removal spans.

The benchmark goes out in blocks of bounded size; every block meets every document, and the documents' rows are never
shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.tables import own_prefix

PHRASE_WORDS = 10
#: Benchmark text broadcast at a time, in bytes (a longer single item goes alone).
BLOCK_BYTES = 8 << 20
SAMPLE_EVERY = 8
TEXTS_AT_ONCE = 4000

#: Byte table: A-Z become a-z, every other ASCII byte that isn't a digit or small letter becomes a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WORD = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


class WaveletMatrix:
    """Rank and access over a sequence of symbols, one bit plane at a time from the highest bit."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits = bits
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(bits)):
            plane = (symbols >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(plane, dtype=np.int64))).astype(np.int32))
            self.zeros.append(int(len(plane) - self.ones[-1][-1]))
            symbols = symbols[np.argsort(plane, kind="stable")]

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        low, high = np.zeros_like(upto), upto
        for ones, zeros, level in zip(self.ones, self.zeros, reversed(range(self.bits)), strict=True):
            bit = ((symbol >> level) & 1).astype(bool)
            one_low, one_high = ones[low], ones[high]
            low = np.where(bit, zeros + one_low, low - one_low)
            high = np.where(bit, zeros + one_high, high - one_high)
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            one = ones[at]
            bit = ones[at + 1] - one
            out = out * 2 + bit
            at = np.where(bit == 1, zeros + one, at - one)
        return out


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; a suffix that ends first comes first."""
    rank = symbols.astype(np.int64)
    n, width = len(rank), 1
    while True:
        after = np.full(n, -1, np.int64)
        after[: max(n - width, 0)] = rank[width:]
        key = rank * (rank.max() + 2) + after + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        width *= 2
        if width >= n or rank[order[-1]] == n - 1:
            return order


class FMIndex:
    """Counts and locates phrases of symbols >= 1 in a sequence; 0 marks its end."""

    def __init__(self, symbols: np.ndarray, top: int) -> None:
        symbols = np.append(symbols, 0)
        order = suffix_order(symbols)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=top + 1))))
        self.wavelet = WaveletMatrix(symbols[order - 1], max(1, int(top).bit_length()))
        sampled = order % SAMPLE_EVERY == 0
        self.sampled = sampled
        self.sample_rank = np.cumsum(sampled) - 1
        self.samples = order[sampled]
        self.n = len(symbols)

    def step(self, row: np.ndarray) -> np.ndarray:
        symbol = self.wavelet.access(row)
        return self.before[symbol] + self.wavelet.rank(symbol, row)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase number, start) of every occurrence; phrases are right-aligned rows."""
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.n, np.int64)
        live = np.arange(len(lengths))
        for back in range(1, phrases.shape[1] + 1):
            live = live[(lengths[live] >= back) & (high[live] > low[live])]
            symbol = phrases[live, -back]
            low[live] = self.before[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.wavelet.rank(symbol, high[live])
        found = np.maximum(high - low, 0)
        phrase = np.repeat(np.arange(len(lengths)), found)
        row = np.repeat(low, found) + np.arange(len(phrase)) - np.repeat(np.cumsum(found) - found, found)
        start, steps = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        todo = np.arange(len(row))
        while len(todo):
            done = self.sampled[row[todo]]
            start[todo[done]] = self.samples[self.sample_rank[row[todo[done]]]] + steps[todo[done]]
            todo = todo[~done]
            row[todo] = self.step(row[todo])
            steps[todo] += 1
        return phrase, start


class Phrases:
    """The distinct phrases of a block of items, and which items hold them."""

    def __init__(self, items: Sequence[tuple[object, str | None]], width: int = PHRASE_WORDS) -> None:
        holders: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - width + 1) if words else 0):
                held = holders.setdefault(tuple(words[i : i + width]), set())
                if item is not None:
                    held.add(str(item))
        self.holders = [sorted(h) for h in holders.values()]
        vocabulary = sorted({w for p in holders for w in p})
        self.symbol = {w: i + 2 for i, w in enumerate(vocabulary)}  # 0 ends a shard, 1 separates
        self.top = len(vocabulary) + 1
        self.lengths = np.array([len(p) for p in holders], np.int64)
        self.rows = np.zeros((len(holders), max(self.lengths, default=0)), np.int64)
        for row, phrase in zip(self.rows, holders, strict=True):
            row[len(row) - len(phrase) :] = [self.symbol[w] for w in phrase]


def search_shard(words: list[list[bytes]], phrases: Phrases) -> tuple[list[list[tuple[int, int]]], list[list[str]]]:
    """For each document of a shard: hit word spans (first, length), merged, and the items that hit it."""
    spans: list[list[tuple[int, int]]] = [[] for _ in words]
    items: list[list[str]] = [[] for _ in words]
    counts = np.array([len(w) for w in words], np.int64)
    if not len(phrases.lengths) or not counts.sum():
        return spans, items
    # One word between documents keeps spans and runs apart.
    symbols = np.ones(int(counts.sum() + len(words)), np.int64)
    first = np.cumsum(counts + 1) - counts - 1
    of = phrases.symbol.get
    for at, own in zip(first.tolist(), words, strict=True):
        symbols[at : at + len(own)] = [of(w, 1) for w in own]
    inside = np.concatenate(([0], symbols > 1, [0])).astype(np.int8)
    edge = np.diff(inside)
    begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = stop - begin >= phrases.lengths.min()
    begin, stop = begin[long], stop[long]
    if not len(begin):
        return spans, items
    sizes = stop - begin + 1  # with the separator after each run
    place = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    phrase, start = FMIndex(symbols[place], phrases.top).search(phrases.rows, phrases.lengths)
    if not len(phrase):
        return spans, items
    start = place[start]
    change = np.zeros(len(symbols) + 1, np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, start + phrases.lengths[phrase], -1)
    edge = np.diff(np.concatenate(([0], np.cumsum(change) > 0)).astype(np.int8))
    for b, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        doc = int(np.searchsorted(first, b, "right") - 1)
        spans[doc].append((b - int(first[doc]), e - b))
    pair = np.unique((np.searchsorted(first, start, "right") - 1) * len(phrases.lengths) + phrase)
    for doc, p in zip((pair // len(phrases.lengths)).tolist(), (pair % len(phrases.lengths)).tolist(), strict=True):
        items[doc] += phrases.holders[p]
    return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that overlap or touch made one."""
    out: list[list[int]] = []
    for b, n in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + n)
        else:
            out.append([b, b + n])
    return [(b, e - b) for b, e in out]


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from each span's first word to its last."""
    data = text.encode()
    at = [m.span() for m in WORD.finditer(data.translate(FOLD))]
    kept, last = [], 0
    for b, n in spans:
        kept.append(data[last : at[b][0]])
        last = at[b + n - 1][1]
    return b"".join([*kept, data[last:]]).decode()


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str | None]]]:
    """The items in blocks of about BLOCK_BYTES, one block in the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    blocks = -(-size // BLOCK_BYTES)
    for block in range(blocks):
        part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        yield [(r["item_id"], r["text"]) for r in items.where(part).collect()]


def mark(docs: DataFrame, benchmark: DataFrame, cut: bool) -> DataFrame:
    """docs and three columns after its own: word count, hit word spans, hit item ids (as strings, sorted).

    With `cut`, the spans are also cut out of the text. All columns of docs pass through.
    """
    spark, names, own = docs.sparkSession, docs.columns, own_prefix(docs)
    schema = T.StructType(
        docs.schema.fields
        + [
            T.StructField(own + "words", T.LongType()),
            T.StructField(own + "spans", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField(own + "items", T.ArrayType(T.StringType())),
        ]
    )
    empty = F.expr("array()")
    marked = docs.select(
        *names,
        F.lit(0).cast("bigint").alias(own + "words"),
        empty.cast("array<array<bigint>>").alias(own + "spans"),
        empty.cast("array<string>").alias(own + "items"),
    )
    at = names.index("text")
    blocks = list(spark.sparkContext.broadcast(Phrases(b)) for b in item_blocks(benchmark)) or [spark.sparkContext.broadcast(Phrases([]))]
    for number, block in enumerate(blocks):
        last = number == len(blocks) - 1

        def scan(batches: Iterator[pa.RecordBatch], block=block, last=last) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for begin in range(0, whole.num_rows, TEXTS_AT_ONCE):
                    batch = whole.slice(begin, TEXTS_AT_ONCE)
                    texts = batch.column(at).to_pylist()
                    words = [words_of(t) for t in texts]
                    spans, items = search_shard(words, block.value)
                    old = zip(batch.column(len(names) + 1).to_pylist(), batch.column(len(names) + 2).to_pylist(), strict=True)
                    for i, (old_spans, old_items) in enumerate(old):
                        if old_spans or spans[i]:
                            spans[i] = merged([(b, n) for b, n in old_spans] + spans[i])
                            items[i] = sorted({*old_items, *items[i]})
                    columns = batch.columns[: len(names)]
                    if cut and last:
                        new = [without_words(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
                        columns[at] = pa.array(new, batch.schema.field(at).type)
                    columns += [
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array([[list(x) for x in s] for s in spans], pa.list_(pa.list_(pa.int64()))),
                        pa.array(items, pa.list_(pa.string())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        marked = marked.mapInArrow(scan, schema)
    return marked


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, spans of every document.

    A window is 10 consecutive item words, or all words of a shorter item. A null or empty text has no words; an item
    without words has no window; repeated items count once by id, repeated rows each return a row. Windows of an item
    with a null id mark words but can't be listed. An empty benchmark hits nothing.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = mark(docs, benchmark, cut=False)
    words, spans, items = marked.columns[-3:]
    hit = F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s[1])
    return marked.select(
        "doc_id", F.col(words).alias("n_words"), hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.col(items).alias("items"), F.col(spans).alias("spans"),
    )


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs with benchmark passages cut out of the texts, and n_chars, if there is one, set anew for these."""
    text_type = docs.schema["text"].dataType
    marked = mark(docs.withColumn("text", F.col("text").cast("string")), benchmark, cut=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        was_cut = F.size(marked.columns[-2]) > 0
        marked = marked.withColumn("n_chars", F.when(was_cut, F.char_length("text")).otherwise(F.col("n_chars")).cast(kind))
    return marked.withColumn("text", F.col("text").cast(text_type)).select(*docs.columns)
