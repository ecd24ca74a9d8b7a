"""Document fingerprints by randomised edit embedding.

A walk goes over a text's characters. At each step it emits the character it stands on and, by a shared random bit for
this step and character, stays or moves on. Two texts that differ by few edits fall into step again after each edit, so
a small edit distance becomes a small Hamming distance of the emitted strings.

A fingerprint keeps a hashed bit of the emitted character at sampled steps: one step in each stratum of 2 ** level
steps, with the level that leaves 512 to 1023 samples. A coarser level's step is one of the two of the level below, so
fingerprints of texts of any two lengths have sampled steps in common. Likeness is the agreement on these, freed of what
chance agrees on: 1 for equal emitted strings, about 0 for unrelated ones.

Candidates for near-duplicate search come from bands of sampled bits; likeness verifies them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.components import grouped
from tallyspark.llm.tables import arrow_rows, settle

SEED = 99_371
#: Characters fall into so many classes, which share their random bits; bits repeat after PERIOD steps.
CLASSES = 64
PERIOD = 4096
LEAST_SAMPLES = 512
#: Characters walked at a time, over all texts of a group.
GROUP_CHARS = 3_000_000
BAND_BITS = 24
BANDS = 42
#: Bands read prefixes whose numbers of samples stand on a ladder of so many rungs to a doubling: the largest that the
#: text reaches and the next lower ones. A likeness of 0.8 takes 0.8 of the longer's samples, less than two rungs.
RUNGS = 6
RUNGS_READ = 3

MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX[0]
    x = (x ^ (x >> np.uint64(29))) * MIX[1]
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def stays() -> np.ndarray:
    """For each class and step (of a period): steps until the walk leaves a character it reaches there."""
    move = np.random.default_rng(SEED).random((CLASSES, PERIOD)) < 0.5
    move[:, -1] = True
    out = np.empty((CLASSES, PERIOD), np.int32)
    out[:, -1] = 1
    for step in reversed(range(PERIOD - 1)):
        out[:, step] = np.where(move[:, step], 1, out[:, step + 1] + 1)
    return out.reshape(-1)


def coarser(level: int, k: np.ndarray) -> np.ndarray:
    """Which of strata 2k and 2k + 1 of the level below a stratum's step comes from."""
    return (2 * k + (mixed(k.astype(np.uint64) * MIX[2] + np.uint64(level)) & np.uint64(1)).astype(np.int64)).astype(np.int64)


@lru_cache(maxsize=64)
def sampled_steps(level: int) -> np.ndarray:
    """The sampled step of the first 2 * LEAST_SAMPLES strata of a level."""
    k = np.arange(2 * LEAST_SAMPLES)
    for below in range(level, 0, -1):
        k = coarser(below, k)
    return k


def level_of(steps: int) -> int:
    return max(0, (steps // LEAST_SAMPLES).bit_length() - 1)


def groups_of(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of the texts with characters, longest first, in groups that fill a table of GROUP_CHARS."""
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    at = 0
    while at < len(order):
        group = order[at : at + max(1, GROUP_CHARS // int(sizes[order[at]]))]
        at += len(group)
        yield group


def walked(codes: list[np.ndarray]) -> np.ndarray:
    """The step at which the walk leaves each character: a column per text, of falling lengths, walking side by side."""
    table = stays()
    sizes = np.array([len(c) for c in codes], np.int64)
    base = np.zeros((int(sizes[0]), len(codes)), np.int32)
    for column, c in enumerate(codes):
        base[: len(c), column] = (mixed(c.astype(np.uint64)) >> np.uint64(58)).astype(np.int32) * PERIOD
    live = np.searchsorted(-sizes, -np.arange(len(base)), "left").tolist()  # texts that have an i-th character
    step = np.zeros(len(codes), np.int32)
    for row, n in zip(base, live, strict=True):
        s = step[:n]
        s += table.take(row[:n] + (s & (PERIOD - 1)))
        row[:n] = s
    return base


def fingerprints(texts: list[str]) -> list[str]:
    """Level, number of samples and sampled bits of each text, in hexadecimal."""
    out = ["000000"] * len(texts)
    for group in groups_of(np.array([len(t) for t in texts], np.int64)):
        codes = [np.frombuffer(texts[i].encode("utf-32-le"), np.uint32) for i in group]
        left = walked(codes)
        for column, (i, code) in enumerate(zip(group.tolist(), codes, strict=True)):
            own = np.ascontiguousarray(left[: len(code), column])
            level = level_of(int(own[-1]))
            count = int(own[-1]) >> level
            where = sampled_steps(level)[:count]
            emitted = code[np.searchsorted(own, where, "right")]
            bits = mixed(emitted.astype(np.uint64) * MIX[2] + where.astype(np.uint64)) & np.uint64(1)
            out[i] = f"{level:02x}{count:04x}" + np.packbits(bits.astype(np.uint8)).tobytes().hex()
    return out


def opened(fingerprint: str) -> tuple[int, np.ndarray]:
    level, count = int(fingerprint[:2], 16), int(fingerprint[2:6], 16)
    return level, np.unpackbits(np.frombuffer(bytes.fromhex(fingerprint[6:]), np.uint8), count=count)


def at_level(level: int, bits: np.ndarray, wanted: int) -> np.ndarray:
    """The same fingerprint on the samples of a coarser level."""
    for above in range(level + 1, wanted + 1):
        bits = bits[coarser(above, np.arange(len(bits) // 2))]
    return bits


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints, about 0 for unrelated ones. Steps only the longer has count as agreeing by chance."""
    if a == b:
        return 1.0
    (la, x), (lb, y) = opened(a), opened(b)
    x, y = at_level(la, x, max(la, lb)), at_level(lb, y, max(la, lb))
    most, both = max(len(x), len(y)), min(len(x), len(y))
    if not both:
        return 0.0
    return max(0.0, (2 * int((x[:both] == y[:both]).sum()) - both) / most)


def rung_size(rung: int) -> int:
    return int(LEAST_SAMPLES * 2 ** (rung / RUNGS) + 1e-9)


def rungs(level: int, count: int) -> list[tuple[int, int]]:
    """Levels and numbers of samples that a text's bands read: nearly all of it, and at most two rungs less.

    Rungs below 0 hold for texts that lack samples of the level below; a text just under a level's edge reads them too.
    """
    top = max(r for r in range(-10 * RUNGS, RUNGS) if rung_size(r) <= count)
    own = [(level, rung_size(r)) for r in range(top, top - RUNGS_READ, -1)]
    above = [(level + 1, rung_size(r - RUNGS)) for r in range(top, top - RUNGS_READ, -1) if r - RUNGS > -RUNGS_READ]
    return [x for x in dict.fromkeys(own + above) if x[1]]


@lru_cache(maxsize=512)
def picks(level: int, size: int) -> np.ndarray:
    return np.random.default_rng((SEED, level, size)).integers(0, size, (BANDS, BAND_BITS))


def bands(fingerprint: str) -> list[int]:
    """Keys of bit-sampled bands, over the own level's rungs and the next level's: near texts share at least one rung."""
    level, bits = opened(fingerprint)
    keys = []
    for own, size in rungs(level, len(bits)) if len(bits) else []:
        chosen = at_level(level, bits, own)[picks(own, size)]
        for band, row in enumerate(chosen):
            digest = hashlib.blake2b(row.tobytes() + f"{own} {size} {band}".encode(), digest_size=8).digest()
            keys.append(int.from_bytes(digest, "little", signed=True))
    return keys


def edited_text(text: str, following: str) -> str:
    """The last half replaced by as many of the following text's first characters, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = pa.schema(
    [("kind", pa.string()), ("part", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string()), ("n_chars", pa.int64()),
     ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
     ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
DDL = (
    "kind string, part bigint, doc_id bigint, text string, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compared(text: str, following: str, own: str, edit: str, after: str) -> dict:
    """Result columns of one document, from its fingerprint, its edited text's and the next one's."""
    sha = hashlib.sha256(edited_text(text, following).encode()).hexdigest()
    return {
        "n_chars": len(text), "edited_sha256": sha, "fingerprint": own, "edited_fingerprint": edit,
        "near_edited": likeness(own, edit), "near_next": likeness(own, after),
    }


def rows_of(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{f.name: r.get(f.name) for f in COLUMNS} for r in rows], schema=COLUMNS)


def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition: each document with the next. The first and the last go out with their texts as well."""
    part = TaskContext.get().partitionId()
    held: tuple[int | None, str, str] | None = None  # document, text, fingerprint
    for batch in batches:
        docs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        chain = ([] if held is None else [held[:2]]) + list(zip(docs, texts, strict=True))
        edits = [edited_text(a, b) for (_, a), (_, b) in zip(chain[:-1], chain[1:], strict=True)]
        made = fingerprints(texts + edits)
        own = ([] if held is None else [held[2]]) + made[: len(texts)]
        out = []
        if held is None and chain:
            out.append({"kind": "head", "part": part, "doc_id": docs[0], "text": texts[0], "fingerprint": own[0]})
        for i, edit in enumerate(made[len(texts) :]):
            row = compared(chain[i][1], chain[i + 1][1], own[i], edit, own[i + 1])
            out.append({"kind": "row", "part": part, "doc_id": chain[i][0]} | row)
        if chain:
            held = (*chain[-1], own[-1])
        yield rows_of(out)
    if held is not None:
        yield rows_of([{"kind": "tail", "part": part, "doc_id": held[0], "text": held[1], "fingerprint": held[2]}])


def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents whose next one lies in another partition."""
    for batch in batches:
        rows = batch.to_pylist()
        edits = fingerprints([edited_text(r["text"], r["next_text"]) for r in rows])
        yield rows_of(
            [
                {"kind": "row", "doc_id": r["doc_id"]} | compared(r["text"], r["next_text"], r["fingerprint"], e, r["next_fingerprint"])
                for r, e in zip(rows, edits, strict=True)
            ]
        )


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    The next document is that with the next smaller doc_id; after the last comes the first. Null texts count as empty.
    Null doc_ids come last; rows with equal doc_ids stand in the order of their texts. A single row follows itself.
    Texts cross the network once, ranged by doc_id; only partitions' edge rows are joined.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").asc()]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    done = settle(rows.repartitionByRange(order[0]).sortWithinPartitions(*order).mapInArrow(along, DDL), "fingerprints")

    heads = done.where("kind = 'head'").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    parts = heads.select("part")  # a number per partition
    ordered = Window.orderBy("part")
    following = parts.select(
        F.col("part").alias("_part"), F.coalesce(F.lead("part").over(ordered), F.min("part").over(Window.partitionBy())).alias("_next")
    )
    tails = done.where("kind = 'tail'").join(following, F.col("part") == F.col("_part")).drop("part")
    edges = tails.join(heads, F.col("_next") == F.col("part")).select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")
    out = done.where("kind = 'row'").unionByName(edges.mapInArrow(across, DDL))
    return out.drop("kind", "part", "text")


def near_documents(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id and component_id: documents joined by links of a verified likeness of at least `least`.

    Candidates share a band; equal fingerprints fold into one document first. Every candidate pair is verified or joined
    by verified links already. Null and empty texts, and null doc_ids, are linked with nothing.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string()), ("keys", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fingerprints([t or "" for t in batch.column(1).to_pylist()])
            yield arrow_rows(schema, doc_id=batch.column(0), fingerprint=made, keys=[bands(f) for f in made])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = settle(rows.mapInArrow(sign, "doc_id bigint, fingerprint string, `keys` array<bigint>"), "signed")
    usable = signed.where("doc_id IS NOT NULL AND size(keys) > 0")
    first = usable.groupBy("fingerprint").agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"))
    first = settle(first, "first")

    def verify(pairs: DataFrame) -> DataFrame:
        prints = first.select(F.col("rep").alias("_rep"), "fingerprint")
        both = pairs.join(prints, F.col("a") == F.col("_rep")).select("a", "b", F.col("fingerprint").alias("x"))
        both = both.join(prints, F.col("b") == F.col("_rep")).select("a", "b", "x", F.col("fingerprint").alias("y"))

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                near = pa.array([likeness(p, q) >= least for p, q in zip(x, y, strict=True)], pa.bool_())
                yield batch.select(["a", "b"]).filter(near)

        return both.mapInArrow(keep, "a bigint, b bigint")

    component = grouped(first.select("rep", F.explode("keys").alias("key")), verify)
    named = first.select(F.col("fingerprint").alias("_print"), "rep").join(component, F.col("rep") == F.col("node"), "left")
    named = named.select("_print", F.coalesce("component", "rep").alias("component"))
    out = signed.join(named, F.col("fingerprint") == F.col("_print"), "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", own.alias("component_id"))
