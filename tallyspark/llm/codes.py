"""Vector codes: each vector becomes a byte per part, the nearest entry of that part's learnt codebook.

Everything is integer arithmetic, so results are the same on any number of tasks. A codebook's nearest entries are
found by a geometric near-neighbour access tree: a node holds a few split entries, the other entries belong to the
split nearest to them, and for each split and each subtree the node stores the range of distances between them. A
query's distance to one split rules out every subtree whose range, widened by the best distance so far, it misses.
Roots are rounded outwards and only strictly farther subtrees go; what remains is decided by exact squared distances,
ties by the lower entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.tables import arrow_rows, settle
from tallyspark.operators.joins import lookup_join

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Split entries of a tree node.
DEGREE = 4
#: Relative widening of rounded roots; far above the rounding of a root, a sum and a comparison together.
WIDEN = 1e-12
#: Components at most this large: squared distances of a part of up to 1,024 components fit 64 bits.
LARGEST = 1 << 25
WIDEST_PART = 1024


@dataclass(frozen=True)
class Node:
    splits: list[int]
    #: Least and greatest distance from split i to the entries of subtree j, split j included.
    low: np.ndarray
    high: np.ndarray
    children: list[Node | None]


def distances(rows: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Squared distances of whole-number rows to one entry; exact, as floats hold what is asked of them (`Search`)."""
    apart = rows - entry
    return np.einsum("ij,ij->i", apart, apart)


def exact_in_floats(*arrays: np.ndarray) -> bool:
    """Whether squared distances between rows of these stay below 2 ** 53."""
    largest = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    return 4 * largest * largest * arrays[0].shape[-1] < 1 << 53


def tree(entries: np.ndarray, own: list[int] | None = None, degree: int = DEGREE) -> Node:
    """The access tree over a codebook: splits are chosen each farthest from those before it."""
    own = list(range(len(entries))) if own is None else own
    splits = own[:1]
    nearest = distances(entries[own], entries[splits[0]])
    held = [splits[0]] * len(own)
    while len(splits) < min(degree, len(own)):
        rest = [k for k, e in enumerate(own) if e not in splits]
        new = own[max(rest, key=lambda k: (nearest[k], -k))]
        to_new = distances(entries[own], entries[new])
        held = [new if to_new[k] < nearest[k] else held[k] for k in range(len(own))]
        nearest = np.minimum(nearest, to_new)
        splits.append(new)
    groups = [[e for e, h in zip(own, held, strict=True) if h == s and e not in splits] for s in splits]
    spread = [[np.sqrt(distances(entries[[s, *g]], entries[p]).astype(np.float64)) for s, g in zip(splits, groups, strict=True)] for p in splits]
    low = np.array([[d.min() * (1 - WIDEN) for d in row] for row in spread])
    high = np.array([[d.max() * (1 + WIDEN) for d in row] for row in spread])
    return Node(splits, low, high, [tree(entries, g, degree) if g else None for g in groups])


class Search:
    """Nearest entries of many rows; counts the distances it computes."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.root = tree(entries)
        self.computed = 0

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row."""
        number = np.float64 if exact_in_floats(self.entries, rows) else np.int64
        entries, rows = self.entries.astype(number), rows.astype(number)
        best = np.full(len(rows), np.iinfo(np.int64).max, number)
        entry = np.full(len(rows), len(entries))
        self._visit(self.root, entries, rows, np.arange(len(rows)), best, entry)
        return entry, best.astype(np.int64)

    def _visit(self, node: Node, entries: np.ndarray, rows: np.ndarray, who: np.ndarray, best: np.ndarray, entry: np.ndarray) -> None:
        """One node for the queries `who`; `rows` holds theirs alone."""
        k = len(node.splits)
        alive = np.ones((k, len(who)), bool)
        apart = np.full((k, len(who)), np.nan)
        radius, found = best[who], entry[who]
        for i, split in enumerate(node.splits):
            at = slice(None) if alive[i].all() else np.flatnonzero(alive[i])
            squared = distances(rows[at], entries[split])
            self.computed += len(squared)
            closer = (squared < radius[at]) | ((squared == radius[at]) & (split < found[at]))
            radius[at], found[at] = np.where(closer, squared, radius[at]), np.where(closer, split, found[at])
            apart[i, at] = np.sqrt(squared.astype(np.float64, copy=False))
            for j in range(i + 1, k):
                alive[j, at] &= self._within(node, i, j, apart[i, at], radius[at])
        best[who], entry[who] = radius, found
        for j, child in enumerate(node.children):
            if child is None:
                continue
            for i in range(k):  # again, with the radius the last split left; no distance, no verdict
                alive[j] &= self._within(node, i, j, apart[i], radius)
            if alive[j].any():
                self._visit(child, entries, rows[alive[j]], who[alive[j]], best, entry)

    def _within(self, node: Node, i: int, j: int, apart: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Whether subtree j may hold an entry as near as the best, or nearer, by the distances from split i."""
        radius = np.sqrt(best.astype(np.float64, copy=False)) * (1 + WIDEN)
        return ~((apart * (1 - WIDEN) - radius > node.high[i, j]) | (apart * (1 + WIDEN) + radius < node.low[i, j]))


def whole_numbers(column: pa.Array, scale: int) -> tuple[np.ndarray, list[bytes]]:
    """Rows whose vector is usable, and each one's components floor(scale * x) as little-endian 64-bit integers."""
    column = column.cast(pa.list_(pa.float64()))
    width = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column)
    owner = pc.list_parent_indices(column).to_numpy(zero_copy_only=False)
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
    bad = ~np.isfinite(values)
    usable = width > 0
    usable[owner[bad]] = False
    numbers = np.floor(values[~bad] * scale)
    if len(numbers) and np.abs(numbers).max() > LARGEST:
        raise ValueError(f"vector components of magnitude over {LARGEST / scale} have no exact 64-bit distances here")
    out = np.zeros(len(values), "<i8")
    out[~bad] = numbers
    starts = np.cumsum(np.maximum(width, 0)) - np.maximum(width, 0)
    kept = np.flatnonzero(usable)
    return kept, [out[starts[r] : starts[r] + width[r]].tobytes() for r in kept]


def usable_vectors(embeddings: DataFrame, vector: str, scale: int) -> DataFrame:
    """vec_id, label (as text that tells null apart) and whole-number components of the rows that can be coded."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("numbers", pa.binary())])
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("null"))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), F.col(vector).cast("array<double>").alias("vector"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, numbers = whole_numbers(batch.column(2), scale)
            at = pa.array(kept)
            yield arrow_rows(schema, vec_id=batch.column(0).take(at), label=batch.column(1).take(at), numbers=numbers)

    return rows.mapInArrow(work, "vec_id bigint, label string, numbers binary")


def matrix(numbers: pa.Array) -> np.ndarray:
    """Rows of one length as a matrix."""
    rows = numbers.to_pylist()
    return np.frombuffer(b"".join(rows), "<i8").reshape(len(rows), -1) if rows else np.zeros((0, 0), np.int64)


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """parts x entries x width: the parts of the vectors with the smallest ids, at most `entries` rows in the driver."""
    order = [F.asc_nulls_last("vec_id"), "numbers"]
    first = vectors.orderBy(*order).select(F.octet_length("numbers").alias("n")).first()
    if first is None:
        return None
    dims = first["n"] // 8
    if dims % parts or dims // parts > WIDEST_PART:
        raise ValueError(f"{dims} components do not make {parts} equal parts of at most {WIDEST_PART}")
    same = vectors.where(F.octet_length("numbers") == first["n"])
    seeds = [r["numbers"] for r in same.orderBy(*order).select("vec_id", "numbers").limit(entries).collect()]
    return np.array([np.frombuffer(s, "<i8") for s in seeds]).reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()


def learnt(vectors: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, every entry to the floored mean of its parts.

    Tasks send a sum per component and a count per entry; what reaches the driver is as large as the codebooks."""
    parts, entries, width = codebooks.shape
    cells = parts * entries * (width + 1)
    schema = pa.schema([("cell", pa.int32()), ("total", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Search(c) for c in codebooks]
        totals = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            rows = matrix(batch.column(0))
            for p in range(parts if len(rows) else 0):
                own = rows[:, p * width : (p + 1) * width]
                entry, _ = search[p].nearest(own)
                order = np.argsort(entry, kind="stable")
                used, first = np.unique(entry[order], return_index=True)
                totals[p, used, :-1] += np.add.reduceat(own[order], first)
                totals[p, used, -1] += np.diff(np.append(first, len(entry)))
        yield arrow_rows(schema, cell=np.arange(cells, dtype=np.int32), total=totals.ravel())

    sums = vectors.select("numbers").mapInArrow(work, "cell int, total bigint").groupBy("cell").agg(F.sum("total").alias("total"))
    totals = np.zeros(cells, np.int64)
    for r in sums.collect():  # one row per codebook component and count
        totals[r["cell"]] = r["total"]
    totals = totals.reshape(parts, entries, width + 1)
    counts = totals[:, :, -1:]
    return np.where(counts > 0, totals[:, :, :-1] // np.maximum(counts, 1), codebooks)


def coded(vectors: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of every vector."""
    parts, _, width = codebooks.shape
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])
    digits = np.array([f"{i:02x}" for i in range(256)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Search(c) for c in codebooks]
        for batch in batches:
            rows = matrix(batch.column(2))
            found = [search[p].nearest(rows[:, p * width : (p + 1) * width]) for p in range(parts)] if len(rows) else []
            names = digits[np.array([e for e, _ in found], int).reshape(parts, -1)]
            code = ["".join(c) for c in names.T] if len(rows) else []
            error = np.sum([d for _, d in found], axis=0) if len(rows) else np.zeros(0, np.int64)
            yield arrow_rows(schema, vec_id=batch.column(0), label=batch.column(1), code=code, error=error)

    return vectors.select("vec_id", "label", "numbers").mapInArrow(work, "vec_id bigint, label string, code string, error bigint")


def codebooks_text(codebooks: np.ndarray) -> str:
    return ",".join(map(str, codebooks.ravel().tolist()))


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    codebooks = first_codebooks(vectors, parts, entries)
    if codebooks is None:
        return None
    same = vectors.where(F.octet_length("numbers") == codebooks.shape[0] * codebooks.shape[2] * 8)
    for _ in range(rounds):
        codebooks = learnt(same, codebooks)
    return codebooks


def compress(
    embeddings: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable vector.

    Vectors that are null, empty or hold a null or non-finite component go; so do those of another length than the
    vector with the smallest vec_id, as no part of theirs has a codebook. Repeated rows each count and each return a
    row; rows of one vec_id are taken in the order of their components; null ids come last. With fewer vectors than
    entries the codebooks are as short. An empty table gives no rows. A component over `LARGEST` / scale raises an
    error. Other columns are not read. Labels are compared as text; nulls are one label, however many rows have it.
    """
    if entries > 256:
        raise ValueError("a code has one byte a part: at most 256 entries")
    spark = embeddings.sparkSession
    vectors = settle(usable_vectors(embeddings, vector, scale), "vectors")
    codebooks = train(vectors, parts, entries, rounds)
    out = T.StructType.fromDDL("vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    if codebooks is None:
        return spark.createDataFrame([], out)
    same = vectors.where(F.octet_length("numbers") == codebooks.shape[0] * codebooks.shape[2] * 8)
    rows = settle(coded(same, codebooks), "codes")
    errors = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = lookup_join(rows, errors, "label", "_label", ["vec_id"], bound=None, base=rows)
    digest = hashlib.sha256(codebooks_text(codebooks).encode()).hexdigest()
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
