"""Best-fit packing of token pieces into sequences of a fixed length.

1. Texts become ids; texts over the sequence length are cut into full pieces and a rest. Only a light row per piece
   (document, place, length, checksum) is kept.
2. The histogram of piece lengths, at most one entry per length, goes to the driver. There a configuration linear
   program (how often to use each way of filling a sequence) is solved by multiplicative weights: prices on length
   classes, the best configuration at these prices by a knapsack dynamic program, prices of what it covers lowered.
3. The solution is rounded down to whole sequences; what is left, and the short pieces, which the program leaves out,
   go best-fit, longest first, into the gaps and then into new sequences. Both work on runs of equal sequences, so the plan's size depends on the number of lengths only.
4. The plan says which ranks of a length go where. Ranks come from salted windows, so a length that a third of all
   pieces share is split, and pieces look their place up in the broadcast plan.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyspark.llm.tables import arrow_rows, settle, texts

MODEL = "word_bpe_49k.json"
END_ID = 1
CAPACITY = 4096
#: Length classes and steps of the linear program: its time doesn't depend on the corpus.
CLASSES = 128
STEPS = 600
STEP_SIZE = 0.1
#: Pieces up to this share of a sequence are left out of the program: they fill the gaps that rounding leaves.
SMALL = 1 / 16
PIECES_PER_SALT = 20_000
#: Words a worker process keeps, over all its tasks.
CACHE_WORDS = 400_000
CACHE_BYTES = 48
#: Texts tokenised together.
TEXTS_AT_ONCE = 400
ID = np.dtype("<u4")
#: Marks that may follow a word; none of them begins or continues a match with letters.
PUNCTUATION = b"!%#*&$,.;:?|"
#: Whether a word in UTF-8 has letters below U+0250 only: each of them ends its word in an end-of-word token.
LATIN = re.compile(b"(?:" + b"|".join(re.escape(chr(c).encode()) for c in range(0x250) if chr(c).isalpha()) + b")+").fullmatch


#: The normaliser and the pattern under which a text's ids are those of its words in turn.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PATTERN = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
WORD_END = "</w>"
SPECIAL_OPENING = "<|"


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """The library's tokenizer, without truncation or padding that its file may ask for."""
    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


def word_by_word(path: str) -> bool:
    """Whether a tokenizer's file proves that ids follow words: its normaliser and pattern let nothing reach across white
    space, merges are plain ones within a match that ends in an end-of-word token, and added tokens share their opening."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    model = spec["model"]
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    merges = model["type"] == "BPE" and model.get("end_of_word_suffix") == WORD_END and plain
    added = all(t["content"].startswith(SPECIAL_OPENING) and not t["lstrip"] and not t["rstrip"] for t in spec["added_tokens"])
    return merges and added and spec["normalizer"] == NORMALIZER and spec["pre_tokenizer"] == PATTERN


class WordIds:
    """Ids of texts as little-endian bytes, word by word.

    The tokenizer's pattern keeps no match across white space and its normaliser changes nothing across it, so a text's
    ids are those of its words in turn. Texts with a special token's opening go to the tokenizer whole, and so do all
    texts where the tokenizer's file doesn't prove this.
    """

    def __init__(self, path: str) -> None:
        self.proven = word_by_word(path)
        self.encode = tokenizer(path).encode
        self.known: dict[bytes, bytes] = {b"": b""}
        self.tails: dict[bytes, bytes] = {}
        self.ends = np.zeros(max(tokenizer(path).get_vocab().values()) + 1, bool)
        for token, i in tokenizer(path).get_vocab().items():
            self.ends[i] = token.endswith(WORD_END)

    def whole(self, text: str) -> bytes:
        return np.asarray(self.encode(text, add_special_tokens=False).ids, ID).tobytes()

    def learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words not known yet.

        A word of Latin letters ends in its one end-of-word token, so such words go to the tokenizer together. So do
        the letters of a word with punctuation after them, which the tokenizer's pattern parts from letters.
        """
        found: dict[bytes, bytes] = {}
        letters: dict[bytes, bytes] = {}
        ending: list[tuple[bytes, bytes]] = []
        known = self.known.get
        for word in words:
            core = word.rstrip(PUNCTUATION)
            if not (core.isalpha() or LATIN(core)):
                found[word] = self.whole(word.decode())
                continue
            letters[core] = b""
            if len(core) < len(word):
                letters[core] = known(core) or b""
                ending.append((word, core))
        open_ = [c for c, ids in letters.items() if not ids]
        for i in range(0, len(open_), 500):
            part = open_[i : i + 500]
            ids = np.asarray(self.encode(b" ".join(part).decode(), add_special_tokens=False).ids, ID)
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) == len(part):
                data = ids.tobytes()
                letters.update(zip(part, (data[b:e] for b, e in zip([0, *stops], stops, strict=False)), strict=True))
            else:
                letters.update((core, self.whole(core.decode())) for core in part)
        found.update((word, letters[core] + self.of_tail(word[len(core) :])) for word, core in ending)
        found.update(letters)
        return found

    def of_tail(self, tail: bytes) -> bytes:
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails.clear()
            self.tails[tail] = self.whole(tail.decode())
        return self.tails[tail]

    def of_texts(self, texts: list[str | None]) -> list[bytes]:
        if not self.proven:
            return [self.whole(text or "") for text in texts]
        split: list[list[bytes] | None] = []
        for text in texts:
            data = (text or "").encode()
            # only ASCII letters are lowered here, which the tokenizer does too
            split.append(None if SPECIAL_OPENING.encode() in data else data.lower().replace(b"\n", b" ").split(b" "))
        # A small dictionary of these texts' own words stays in the processor's cache; the large one doesn't.
        used = set(chain.from_iterable(w for w in split if w is not None))
        own = dict(zip(used, map(self.known.get, used), strict=True))
        new = self.learn([w for w, ids in own.items() if ids is None])
        own.update(new)
        short = (item for item in new.items() if len(item[0]) <= CACHE_BYTES)
        self.known.update(islice(short, max(0, CACHE_WORDS - len(self.known))))
        return [
            self.whole(text or "") if words is None else b"".join(map(own.__getitem__, words))
            for text, words in zip(texts, split, strict=True)
        ]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def token_pieces(docs: DataFrame, model: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, if asked for) of every piece of every whole text.

    A null or empty text is the end id alone. Repeated rows each give their pieces.
    """
    path = model or public_tokenizers.path(MODEL)
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))
    end = np.asarray([END_ID], ID).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                out: dict[str, list] = {f.name: [] for f in schema}
                for doc, ids in zip(part.column(0).to_pylist(), words.of_texts(part.column(1).to_pylist()), strict=True):
                    ids += end
                    for k, b in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[b : b + 4 * capacity]
                        row = (doc, k, b // 4, len(piece) // 4, zlib.crc32(piece))
                        for f, v in zip(schema, (*row, np.frombuffer(piece, ID).astype(np.int32)), strict=False):
                            out[f.name].append(v)
                yield arrow_rows(schema, **out)

    spark_schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return texts(docs).mapInArrow(cut, spark_schema)


# The plan, from the histogram alone


@dataclass
class Run:
    """`count` equal sequences with `room` left; slots are (length, first rank, offset)."""

    count: int
    room: int
    slots: list[tuple[int, int, int]]


def price(values: np.ndarray, sizes: np.ndarray, limits: np.ndarray, capacity: int) -> np.ndarray:
    """Bounded knapsack by dynamic programming: how many of each class fill the capacity at the highest value."""
    best = np.zeros(capacity + 1)
    taken = []
    for value, size, limit in zip(values, sizes, limits, strict=True):
        lots, k = [], 1
        limit = int(min(limit, capacity // size))
        while limit > 0:
            lots.append(min(k, limit))
            limit -= lots[-1]
            k *= 2
        for lot in lots:
            width = lot * int(size)
            if width > capacity:
                continue
            better = best[:-width] + lot * value > best[width:] + 1e-15
            best[width:] = np.where(better, best[:-width] + lot * value, best[width:])
            taken.append((len(taken), int(size), lot, width, better, value))
    out = np.zeros(len(sizes), np.int64)
    of_size = {int(s): i for i, s in enumerate(sizes)}
    room = capacity
    for _, size, lot, width, better, _ in reversed(taken):
        if room >= width and better[room - width]:
            out[of_size[size]] += lot
            room -= width
    return out


def configurations(counts: np.ndarray, sizes: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Covering program by multiplicative weights: (how many of each class, how many sequences), scaled to cover."""
    weights = 1.0 / counts
    covered = np.zeros(len(counts))
    used: dict[bytes, float] = {}
    for _ in range(STEPS):
        pattern = price(weights, sizes, counts, capacity)
        share = pattern / counts
        amount = 1.0 / share.max()  # sequences that cover the tightest class once
        used[pattern.tobytes()] = used.get(pattern.tobytes(), 0.0) + amount
        covered += amount * share
        weights *= np.exp(-STEP_SIZE * amount * share)
        weights /= weights.max()
    # Largest multiples that use no class beyond its count; the rest is packed best-fit.
    return [(np.frombuffer(p, np.int64), n / covered.max()) for p, n in used.items()]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Where each rank of each length goes. Runs are disjoint and cover every piece once."""
    left = dict(histogram)
    next_rank = dict.fromkeys(histogram, 0)
    runs: list[Run] = []
    lengths = sorted(left, reverse=True)
    if not lengths:
        return runs

    def take(length: int, n: int) -> int:
        first = next_rank[length]
        next_rank[length] += n
        left[length] -= n
        return first

    # Classes hold about equal numbers of tokens; a class's size is its longest length.
    large = [length for length in lengths if length > SMALL * capacity]
    total = sum(histogram[length] * length for length in large)
    classes: list[list[int]] = [[]] if large else []
    held = 0
    for length in large:
        if classes[-1] and held >= total / CLASSES:
            classes.append([])
            held = 0
        classes[-1].append(length)
        held += length * left[length]
    counts = np.array([sum(left[length] for length in c) for c in classes])
    sizes = np.array([c[0] for c in classes])

    def fill(run: Run, group: list[int]) -> list[Run]:
        """One more piece of a class for each sequence of a run, its longest first; the run splits by length."""
        out, todo = [], run.count
        while todo:
            length = next((x for x in group if left[x]), None)
            if length is None:
                out.append(Run(todo, run.room, shifted(run, run.count - todo)))
                break
            n = min(todo, left[length])
            slots = shifted(run, run.count - todo) + [(length, take(length, n), capacity - run.room)]
            out.append(Run(n, run.room - length, slots))
            todo -= n
        return out

    def shifted(run: Run, by: int) -> list[tuple[int, int, int]]:
        return [(length, first + by, offset) for length, first, offset in run.slots]

    solved = configurations(counts, sizes, capacity) if large else []
    for pattern, amount in sorted(solved, key=lambda c: -c[1]):
        if int(amount) < 1:
            continue
        made = [Run(int(amount), capacity, [])]
        for group, n in zip(classes, pattern.tolist(), strict=True):
            for _ in range(n):
                made = list(chain.from_iterable(fill(run, group) for run in made))
        runs += [run for run in made if run.slots]

    # Best fit, longest first: the open sequences with the least room that is enough.
    by_room: dict[int, list[Run]] = {}
    rooms: list[int] = []

    def reopen(run: Run) -> None:
        if run.room not in by_room:
            by_room[run.room] = []
            bisect.insort(rooms, run.room)
        by_room[run.room].append(run)

    for run in runs:
        reopen(run)
    runs = []
    for length in lengths:
        while left[length]:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                per = capacity // length
                n, rest = divmod(left[length], per)
                for count, each in ((n, per), (1, rest)):
                    if count and each:
                        slots = [(length, take(length, count), k * length) for k in range(each)]
                        reopen(Run(count, capacity - each * length, slots))
                continue
            room = rooms[at]
            run = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
            n = min(run.count, left[length])
            if n < run.count:
                reopen(Run(run.count - n, room, shifted(run, n)))
            reopen(Run(n, room - length, run.slots + [(length, take(length, n), capacity - room)]))
    return [run for held_runs in by_room.values() for run in held_runs]


def lookup(runs: list[Run]) -> dict[str, np.ndarray]:
    """The plan as sorted ranges of (length, rank)."""
    base, rows = 0, []
    for run in runs:
        rows += [(length << 44 | first, base, offset) for length, first, offset in run.slots]
        base += run.count
    rows.sort()
    key, sequence, offset = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 3
    return {"key": key, "sequence": sequence, "offset": offset}


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces with (doc_id, piece, length); pieces must be a stored table."""
    per_length = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan(per_length, capacity)
    salts = max(1, sum(per_length.values()) // PIECES_PER_SALT)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    held = salted.groupBy(F.col("length").alias("_length"), F.col("_salt").alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select("_length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.join(bases, (F.col("length") == F.col("_length")) & (F.col("_salt") == F.col("_part"))).select(
        *pieces.columns, (F.col("_base") + F.row_number().over(inside) - 1).alias("_rank")
    )
    table = pieces.sparkSession.sparkContext.broadcast(lookup(runs))  # bounded by the number of lengths
    at_length, at_rank = ranked.columns.index("length"), len(ranked.columns) - 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        for batch in batches:
            rank = batch.column(at_rank).to_numpy()
            key = (batch.column(at_length).to_numpy().astype(np.int64) << 44) | rank
            row = np.searchsorted(t["key"], key, "right") - 1
            sequence = t["sequence"][row] + key - t["key"][row]
            columns = batch.columns[:at_rank] + [pa.array(sequence, pa.int64()), pa.array(t["offset"][row], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:at_rank], "sequence_id", "offset"])

    schema = pieces.schema.simpleString()[len("struct<") : -1]
    return ranked.mapInArrow(place, f"{schema},sequence_id:bigint,offset:bigint")


def pack(docs: DataFrame, model: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece's place, gapless in its sequence.

    An empty table gives no rows. Repeated rows are packed as often as they occur; a null doc_id stays null.
    """
    return assign(settle(token_pieces(docs, model, capacity), "pieces"), capacity)


def packed_sequences(docs: DataFrame, model: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id and its ids, of at most `capacity` tokens. doc_id must be a key of docs."""
    placed = pack(docs, model, capacity).select("doc_id", "piece", "sequence_id", "offset")
    ids = token_pieces(docs, model, capacity, with_ids=True).select("doc_id", "piece", "ids")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` parts
    joined = placed.join(ids, ["doc_id", "piece"]).groupBy("sequence_id").agg(parts.alias("parts"))
    return joined.select("sequence_id", F.flatten("parts.ids").alias("ids"))
