"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

Two permutations of one universe make every signature coordinate: the first scatters shingles, the second, shifted
circularly by k, gives coordinate k. A shingle's values in all coordinates are then one contiguous slice of the second
permutation, and a signature is the minimum over slices.

Equal shingle sets fold into one representative first. Representatives that share a band's key are candidates:

1. each is compared with the smallest of its bucket, which joins most groups at a cost linear in their size;
2. of buckets whose members are still in different components, the pairs between these components are compared,
   unless their sizes, or sketches of one bit for each of 3072 more coordinates, rule a link out.

Every candidate pair is thus confirmed on full sets, joined by confirmed links already, or ruled out. With 40 bands of 5
coordinates a pair at a similarity of exactly 0.8 shares no band with probability (1 - 0.8 ** 5) ** 40, about 1e-7; its
sketches differ in more bits than allowed with about the same probability (five standard deviations).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.components import grouped
from tallyspark.llm.tables import arrow_rows, own_prefix, settle

BANDS = 40
BAND_ROWS = 5
UNIVERSE_BITS = 20
SEED = 20240607
#: A similarity of PERCENT / 100 or more is a link; kept in whole numbers to be exact.
PERCENT = 80
SKETCH_WORDS = 48
#: Ids of texts to compare that are broadcast, 8 bytes each; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
CACHE_WORDS = 150_000
#: Members compared with one centre in one task.
MEMBERS_PER_SALT = 2000

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)


@lru_cache(maxsize=2)
def permutations(shifts: int) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and rows of the circulant one: row s is its value at s under every shift."""
    draw, size = np.random.default_rng(SEED), 1 << UNIVERSE_BITS
    scatter = draw.permutation(size).astype(np.int32)
    values = draw.permutation(size).astype(np.int32)
    wound = np.concatenate((values[-(shifts - 1) :], values))
    return scatter, np.lib.stride_tricks.sliding_window_view(wound, shifts)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX[0]
    x = (x ^ (x >> np.uint64(29))) * MIX[1]
    return x ^ (x >> np.uint64(32))


class Shingles:
    """Sets of word shingles as sorted 64-bit numbers."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.known: dict[bytes, int] = {}

    def number(self, word: bytes) -> int:
        n = xxhash.xxh3_64_intdigest(word)
        if len(self.known) < CACHE_WORDS and len(word) <= 48:
            self.known[word] = n
        return n

    def of(self, text: str | None) -> np.ndarray:
        """Distinct shingles; all words as one where there are fewer than the width; none without words."""
        words = (text or "").encode().translate(LOWER).split()
        if not words:
            return np.zeros(0, np.uint64)
        known, number = self.known.get, self.number
        h = np.array([known(w) or number(w) for w in words], np.uint64)
        width = min(self.width, len(h))
        out = np.full(len(h) - width + 1, width, np.uint64)
        for k in range(width):
            out = mixed(out + h[k : len(h) - width + 1 + k])
        return np.unique(out)


def signature(places: np.ndarray, shifts: int) -> np.ndarray:
    """Smallest value under every shift, over places of the universe."""
    scatter, slices = permutations(shifts)
    at, step = scatter[places.astype(np.int64)], (1 << 20) // shifts
    out = slices[at[:step]].min(axis=0)
    for i in range(step, len(at), step):
        np.minimum(out, slices[at[i : i + step]].min(axis=0), out=out)
    return out


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One number per band of the set's signature."""
    places = shingles >> np.uint64(64 - UNIVERSE_BITS)
    rows = signature(places, BANDS * BAND_ROWS).reshape(BANDS, BAND_ROWS).astype(np.uint64)
    out = np.arange(BANDS, dtype=np.uint64)
    for k in range(BAND_ROWS):
        out = mixed(out * MIX[2] + rows[:, k])
    return out.view(np.int64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit digest (hi, lo) and its band keys."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("keys", pa.list_(pa.int64()))]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                out: dict[str, list] = {f.name: [] for f in schema}
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    own = shingles.of(text)
                    hi, lo = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64).tolist()
                    keys = band_keys(own) if len(own) else np.zeros(0, np.int64)
                    for f, v in zip(schema, (doc, len(own), hi, lo, keys), strict=True):
                        out[f.name].append(v)
                yield arrow_rows(schema, **out)

    return _rows(docs).mapInArrow(sign, "doc_id bigint, n_shingles bigint, hi bigint, lo bigint, `keys` array<bigint>")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id and its set as packed numbers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        schema = pa.schema([("doc_id", pa.int64()), ("packed", pa.binary())])
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                sets = [shingles.of(t).tobytes() for t in batch.column(1).to_pylist()]
                yield arrow_rows(schema, doc_id=batch.column(0), packed=sets)

    return _rows(docs).mapInArrow(pack, "doc_id bigint, packed binary")


def chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and text of the documents named in ids (doc_id, each once)."""
    few = ids.count() <= BROADCAST_IDS
    return _rows(docs).join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def sketches(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """rep and one bit for each of 64 * SKETCH_WORDS coordinates, for the documents named in ids (rep)."""
    names = [f"s{i}" for i in range(SKETCH_WORDS)]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for batch in batches:
            rows = np.zeros((batch.num_rows, SKETCH_WORDS), np.int64)
            for row, text in zip(rows, batch.column(1).to_pylist(), strict=True):
                places = np.unique(shingles.of(text) & np.uint64((1 << UNIVERSE_BITS) - 1))
                if len(places):
                    bits = (signature(places, 64 * SKETCH_WORDS) & 1).astype(np.uint8)
                    row[:] = np.frombuffer(np.packbits(bits).tobytes(), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in rows.T.copy())], names=["rep", *names])

    wanted = settle(ids.select(F.col("rep").alias("doc_id")), "ids")
    return chosen(docs, wanted).mapInArrow(sketch, "rep bigint, " + ", ".join(f"{n} bigint" for n in names))


def shortened(key: Column) -> Column:
    return key.bitwiseXOR(F.shiftright(key, 32)).bitwiseAND(0x7FFFFFFF).cast("int")


def differing_bits(percent: int) -> int:
    """Bits in which sketches of a pair at the threshold differ at most, but for five standard deviations."""
    bits, chance = 64 * SKETCH_WORDS, (1 - percent / 100) / 2
    return math.ceil(bits * chance + 5 * math.sqrt(bits * chance * (1 - chance)))


def confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that are links, on full shingle sets.

    A centre's set travels once for each salt of its members, a member's once for each of its pairs. Tasks read a
    stream sorted by centre and hold one centre's set at a time.
    """
    involved = settle(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    sets = settle(shingle_sets(chosen(docs, involved), width), "sets")
    centres = pairs.groupBy("a").agg((F.floor(F.count(F.lit(1)) / MEMBERS_PER_SALT) + 1).cast("int").alias("salts"))
    members = pairs.join(centres, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
    held = F.col("doc_id")
    left = centres.join(sets, F.col("a") == held).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("bigint").alias("b"), "packed"
    )
    right = members.join(sets, F.col("b") == held).select("a", "salt", "b", "packed")
    stream = left.unionByName(right).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        centre, centre_sets, links_open = None, [], False
        for batch in batches:
            links: list[tuple[int, int]] = []
            for a, b, packed in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                own = np.frombuffer(packed, np.uint64)
                if b is None:  # repeated ids may have several texts
                    centre_sets = [*centre_sets, own] if a == centre and not links_open else [own]
                    centre, links_open = a, False
                    continue
                links_open = True
                for other in centre_sets:
                    small, large = sorted((len(own), len(other)))
                    if 100 * small < percent * large:
                        continue
                    common = len(np.intersect1d(own, other, assume_unique=True))
                    if 100 * common >= percent * (small + large - common):
                        links.append((a, b))
                        break
            yield arrow_rows(schema, a=[x for x, _ in links], b=[y for _, y in links])

    return stream.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (doc_id is its component's).

    A null or empty text has no shingles and is linked with nothing. A null doc_id is linked with nothing: its
    component is null and it is kept. Rows that repeat a doc_id share a node; each returns a row.
    """
    signed = settle(signatures(docs, width), "signatures")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "n_shingles", "keys")).alias("first"))
    classes = settle(classes.select("hi", "lo", F.col("first.doc_id").alias("rep"), F.col("first.n_shingles").alias("n"), F.col("first.keys").alias("keys")), "classes")

    def alike(p: str, q: str) -> Column:
        x, y = F.col(f"{p}.n"), F.col(f"{q}.n")
        differ = sum((F.bit_count(F.col(f"{p}.s{i}").bitwiseXOR(F.col(f"{q}.s{i}"))) for i in range(SKETCH_WORDS)), F.lit(0))
        # A pair may share many keys: it counts under the first.
        first = F.array_min(F.array_intersect(f"{p}.short", f"{q}.short")) == shortened(F.col(f"{p}.key"))
        return (x * 100 >= y * percent) & (y * 100 >= x * percent) & (differ <= differing_bits(percent)) & first

    def sketched(ids: DataFrame) -> DataFrame:
        keys = classes.select("rep", F.transform("keys", shortened).alias("short"))
        return sketches(docs, ids, width).join(keys, "rep")

    component = grouped(
        classes.select("rep", "n", F.explode("keys").alias("key")),
        lambda pairs: confirmed(pairs, docs, width, percent),
        alike,
        sketched,
    )

    named = classes.select("hi", "lo", "rep").join(component, F.col("rep") == F.col("node"), "left")
    named = named.select("hi", "lo", F.coalesce("component", "rep").alias("component"))
    # A hot class is one wide row on the right; the left side's rows of it may be split.
    found = signed.join(named, ["hi", "lo"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")))
    return found.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """docs without those that have a component's smaller doc_id; rows without doc_id, words or links stay."""
    name = own_prefix(docs) + "gone"
    gone = near_duplicates(docs, width, percent).where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    gone = settle(gone, "gone")
    few = gone.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, F.col("doc_id") == F.col(name), "left_anti")
