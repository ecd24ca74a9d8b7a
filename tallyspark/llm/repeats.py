"""Removal of passages that an earlier document has, by prefix-free parsing.

Texts are bytes; a match is a string of 50 bytes that also starts in a document with a smaller doc_id.

0. A text that an earlier document has whole is removed as a whole.
1. Parse: a rolling hash over 8 bytes triggers the end of a phrase, so equal passages cut into equal phrases. A phrase
   reaches 49 bytes into what follows: every 50-byte string lies whole in the phrase it starts in. The parse is a
   96-bit digest per phrase; a phrase that an earlier document has is removed as a whole.
2. What remains, the first occurrences, is the dictionary. Two entries can still share a string where a passage begins
   or ends inside a phrase. Every string holds a window-minimal 26-byte anchor; only starts around anchors that two
   documents share are compared further.
3. Suffixes of the dictionary at these starts are sorted: each task orders its shard's suffixes to the match length and
   keeps the earliest document of every run of equal ones; runs of all shards
   meet by digest; no order of the corpus is formed.
   A suffix that is not in its earliest document is removed.

Entries travel as packed arrays by digest bucket. A shard sends one document's entries per digest at most and settles
the others itself, so a passage that a third of all documents share doesn't gather in one bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.tables import arrow_rows, own_prefix, settle

MATCH = 50
ANCHOR = 26
TRIGGER = 8
#: A phrase ends after one trigger window in 2 ** PHRASE_BITS.
PHRASE_BITS = 4
#: Phrases without a trigger for so long are cut all the same, counted from their start.
LONGEST = 4096
#: Text that one shard holds and one bucket answers for, in bytes.
SHARD_BYTES = 1 << 20
BUCKET_TEXT = 16 << 20
#: Buckets at least, so that small tables keep a cluster busy, too.
LEAST_BUCKETS = 48
#: Copies that are left out by a broadcast, some 60 bytes each; more are by a shuffle.
BROADCAST_COPIES = 250_000
KNOWN = 0xFFFF  # in place of a size: the shard knows two documents that share the digest

MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)

#: A row of the table by its content: rows that share a doc_id but not a text stay apart.
TAG = "xxhash64(text) & 2147483647"


#: Starts and sizes of ranges in a document.
Ranges = tuple[np.ndarray, np.ndarray]


class Shard:
    """Texts in one buffer; places are offsets into it."""

    def __init__(self, texts: list[str | None]) -> None:
        data = [(t or "").encode() for t in texts]
        self.sizes = np.array([len(d) for d in data], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.n = int(self.ends[-1]) if len(data) else 0
        self.bytes = b"".join(data) + bytes(64)

    def word(self, offset: int) -> np.ndarray:
        """The eight bytes from each place, shifted by an offset, as a number."""
        return np.ndarray((self.n,), "<u8", self.bytes, offset, (1,))

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right")

    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document number, start and size of the phrases in which a match can start, and their digests (hi, lo)."""
        hit = np.flatnonzero((self.word(0) * MIX[0]) >> np.uint64(64 - PHRASE_BITS) == 0)
        hit = hit[self.ends[self.doc_of(hit)] >= hit + TRIGGER] + TRIGGER
        bounds = np.unique(np.concatenate((hit, self.starts, self.ends)))
        if len(bounds) < 2:
            bounds = np.zeros(1, np.int64)
        parts = (np.diff(bounds) + LONGEST - 1) // LONGEST
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(bounds[:-1], parts) + inner * LONGEST
        end = np.append(begin[1:], bounds[-1:])[: len(begin)]
        doc = self.doc_of(begin)
        stop = np.minimum(end + MATCH - 1, self.ends[doc])
        whole = stop - begin >= MATCH
        begin, end, doc, stop = begin[whole], end[whole], doc[whole], stop[whole]
        view = memoryview(self.bytes)
        digest = xxhash.xxh3_128_digest
        digests = np.frombuffer(b"".join([digest(view[b:e]) for b, e in zip(begin.tolist(), stop.tolist(), strict=True)]), "<u8").reshape(-1, 2)
        return doc, begin - self.starts[doc], end - begin, digests[:, 0].copy(), (digests[:, 1] >> np.uint64(32)).astype(np.uint32)

    def open_starts(self, removed: list[Ranges]) -> np.ndarray:
        """Places where a match may start, without the ranges given for each document."""
        change = np.zeros(self.n + 1, np.int32)
        room = self.sizes >= MATCH
        np.add.at(change, self.starts[room], 1)
        np.add.at(change, self.ends[room] - MATCH + 1, -1)
        for start, (b, n) in zip(self.starts.tolist(), removed, strict=True):
            np.add.at(change, start + b, -2)
            np.add.at(change, np.minimum(start + b + n, self.n), 2)
        return np.cumsum(change[:-1]) > 0

    def anchors(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the window-minimal anchors of the matches that start at the marked places."""
        h = self.word(0) * MIX[0]
        h ^= h >> np.uint64(31)
        for k, at in enumerate((8, 16, ANCHOR - 8)):
            h = (h + self.word(at)) * MIX[k + 1]
            h ^= h >> np.uint64(31)
        width = MATCH - ANCHOR + 1
        least = sliding(np.concatenate((h, np.full(width - 1, ~np.uint64(0)))), width, np.minimum)
        least[~starts] = 0
        top = sliding(np.concatenate((np.zeros(width - 1, np.uint64), least)), width, np.maximum)
        place = np.flatnonzero((top == h) & (top > 0))
        return place, h[place]

    def suffixes(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The suffix array of the places, to the match length: order, start of each run of equal ones, and digests
        (hi, lo)."""
        words = [self.word(at)[places].byteswap() for at in (*range(0, MATCH - 7, 8), MATCH - 8)]
        order = np.lexsort(words[::-1])
        new = np.zeros(len(places), bool)
        new[:1] = True
        for w in words:
            ordered = w[order]
            new[1:] |= ordered[1:] != ordered[:-1]
        digest = np.zeros((2, len(places)), np.uint64)
        for row, seed in zip(digest, (MIX[2], MIX[3]), strict=True):
            for w in words:
                row[:] = (row + w) * seed
                row ^= row >> np.uint64(29)
        return order, np.flatnonzero(new), digest[0], (digest[1] >> np.uint64(32)).astype(np.uint32)


def sliding(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """pick over every `width` values in turn."""
    n, have = len(values) - width + 1, 1
    while 2 * have <= width:
        values = pick(values[:-have], values[have:])
        have *= 2
    return pick(values[:n], values[width - have : width - have + n])


def shards(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to about SHARD_BYTES of text."""
    for batch in batches:
        size = np.cumsum([len(t or "") for t in batch.column(text).to_pylist()])
        cut = np.searchsorted(size, np.arange(0, (size[-1] if len(size) else 0) + SHARD_BYTES, SHARD_BYTES))
        edges = np.unique(np.clip([0, *cut, batch.num_rows], 0, batch.num_rows))
        edges = np.unique(np.concatenate((edges, np.arange(0, batch.num_rows, KNOWN - 1))))
        for b, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield batch.slice(b, e - b)


ENTRY_FIELDS = ("docs", "hi", "lo", "of", "places", "sizes")
ENTRIES = pa.schema([("bucket", pa.int64()), *((n, pa.binary()) for n in ENTRY_FIELDS)])
ENTRIES_DDL = "bucket bigint, " + ", ".join(f"`{n}` binary" for n in ENTRY_FIELDS)
FOUND = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("places", pa.binary()), ("sizes", pa.binary())])
FOUND_DDL = "doc_id bigint, tag bigint, places binary, sizes binary"


def planes(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane: high bytes that are all alike then compress to nothing."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unplaned(data: bytes | pa.Buffer, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).reshape(-1)


def steps(of: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Places as distances within each document; entries are in order of document and place."""
    out = place.copy()
    same = of[1:] == of[:-1]
    out[1:][same] -= place[:-1][same]
    return out.astype(np.uint32)


def unstepped(of: np.ndarray, step: np.ndarray) -> np.ndarray:
    total = np.cumsum(step.astype(np.int64))
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
    return total - np.repeat(total[first] - step[first], np.diff(np.append(first, len(of))))


def runs_of(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start in their order."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def entries(batch: pa.RecordBatch, doc: np.ndarray, place: np.ndarray, size: np.ndarray, hi: np.ndarray, lo: np.ndarray,
            bucket: np.ndarray, order: np.ndarray, runs: np.ndarray, later: bool) -> pa.RecordBatch:
    """A shard's entries by bucket; those that the shard can settle alone are answers already (without digests).

    `order` sorts the entries by digest, `runs` are the starts of equal digests in it. Without `later`, hi stays here.
    """
    ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    out: dict[str, list] = {f.name: [] for f in ENTRIES}

    def row(number: int, rows: np.ndarray, digests: bool = True) -> None:
        """Entries of one bucket, in order of place."""
        own, of = np.unique(doc[rows], return_inverse=True)
        values = (
            number, ids[own].tobytes() + tags[own].astype(np.int32).tobytes(),
            hi[rows].tobytes() if digests and later else b"", lo[rows].tobytes() if digests else b"",
            of.astype(np.uint16).tobytes(), planes(steps(of, place[rows])), planes(np.where(known[rows], KNOWN, size[rows]).astype(np.uint16)),
        )
        for f, v in zip(ENTRIES, values, strict=True):
            out[f.name].append(v)

    known = np.zeros(len(doc), bool)
    if len(order):
        own = ids[doc[order]]
        low, high = np.minimum.reduceat(own, runs), np.maximum.reduceat(own, runs)
        sizes = np.diff(np.append(runs, len(order)))
        several = np.repeat(low != high, sizes)
        settled = own > np.repeat(low, sizes) if later else several
        answered = np.sort(order[settled])
        if len(answered):
            row(int(bucket[answered[0]]), answered, digests=False)
        if later:
            sent = np.sort(order[~settled])
        else:
            # one entry stands for those that the shard has answered
            known[order[runs[low != high]]] = True
            sent = np.sort(np.concatenate((order[~several], np.flatnonzero(known))))
        by = np.argsort(bucket[sent], kind="stable")
        edge = np.flatnonzero(np.diff(bucket[sent][by])) + 1
        for part in np.split(by, edge) if len(by) else []:
            row(int(bucket[sent[part[0]]]), sent[part])
    return arrow_rows(ENTRIES, **out)


def answers(later: bool) -> Callable[[pa.Table], pa.Table]:
    """For a bucket: the entries whose digest another (with `later`: an earlier) document has."""
    def settle_bucket(table: pa.Table) -> pa.Table:
        ids, tags, base, at = [], [], 0, 0
        known_parts = []
        # The open entries are laid out once, in the widths they travel in; cells are read in place.
        open_entries = pc.sum(pc.binary_length(table.column("lo"))).as_py() // 4
        hi = np.zeros(open_entries if later else 0, np.uint64)
        lo, open_of = np.zeros(open_entries, np.uint32), np.zeros(open_entries, np.int32)
        open_place, open_size = np.zeros(open_entries, np.uint32), np.zeros(open_entries, np.uint16)
        for batch in table.to_batches():
            for docs, *cells in zip(*(batch.column(n) for n in ENTRY_FIELDS), strict=True):
                docs, *cells = docs.as_buffer(), *(c.as_buffer() for c in cells)
                count = len(docs) // 12
                ids.append(np.frombuffer(docs, np.int64, count))
                tags.append(np.frombuffer(docs, np.int32, count, 8 * count).astype(np.int64))
                of = np.frombuffer(cells[2], np.uint16)
                place, size = unstepped(of, unplaned(cells[3], np.uint32)), unplaned(cells[4], np.uint16)
                of = np.where(size == KNOWN, -1, of.astype(np.int64) + base)
                n = len(cells[1]) // 4
                if n:
                    here = slice(at, at + n)
                    if later:
                        hi[here] = np.frombuffer(cells[0], np.uint64)
                    lo[here] = np.frombuffer(cells[1], np.uint32)
                    open_of[here], open_place[here], open_size[here] = of, place, size
                    at += n
                else:
                    known_parts.append((of, place, size))
                base += count
        ids, tags = np.concatenate(ids), np.concatenate(tags)
        if open_entries:
            keys = (hi, lo) if later else (lo,)
            order = np.argsort(keys[0], kind="stable")
            runs = runs_of(order, *keys)
            if later and len(runs) != len(runs_of(order, hi)):
                order = np.lexsort((lo, hi))
                runs = runs_of(order, *keys)
            # Most digests are alone in their bucket and share with nobody.
            sizes = np.diff(np.append(runs, len(order)))
            order = order[np.repeat(sizes > 1, sizes)]
            sizes = sizes[sizes > 1]
            runs = np.cumsum(sizes) - sizes
            del hi, lo, keys
            of, place, size = open_of[order], open_place[order], open_size[order]
            del open_of, open_place, open_size, order
            own = ids[of]
            known = np.repeat(np.minimum.reduceat(of, runs) < 0, sizes)
            low, high = np.minimum.reduceat(own, runs), np.maximum.reduceat(own, runs)
            shared = own > np.repeat(low, sizes) if later else (known | np.repeat(low != high, sizes)) & (of >= 0)
            known_parts.append((of[shared], place[shared], size[shared]))
        of, place, size = (np.concatenate(c) for c in zip(*known_parts, strict=True))
        order = np.lexsort((place, of))
        first = runs_of(order, of)
        doc = of[order][first]

        def parts(values: np.ndarray) -> pa.Array:
            return pa.array([x.tobytes() for x in np.split(values[order], first[1:])] if len(first) else [], pa.binary())

        place, size = place.astype(np.uint32), size.astype(np.uint16)

        return pa.table({"doc_id": ids[doc], "tag": tags[doc], "places": parts(place), "sizes": parts(size)}, schema=FOUND)

    return settle_bucket


def per_row(found: DataFrame, name: str) -> DataFrame:
    """All ranges of a document in one row: at most as many as its bytes."""
    cells = F.collect_list(F.struct("places", "sizes"))
    return found.groupBy(F.col("doc_id").alias("_doc"), F.col("tag").alias("_tag")).agg(cells.alias(name))


def with_rows(docs: DataFrame, more: DataFrame, how: str) -> DataFrame:
    return docs.join(more, (F.col("doc_id") == F.col("_doc")) & (F.col("tag") == F.col("_tag")), how).drop("_doc", "_tag")


def ranges_of(cell: list | None) -> Ranges:
    if not cell:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = np.concatenate([np.frombuffer(c["places"], np.uint32) for c in cell]).astype(np.int64)
    return places, np.concatenate([np.frombuffer(c["sizes"], np.uint16) for c in cell]).astype(np.int64)


def repeated_phrases(rows: DataFrame, buckets: int) -> DataFrame:
    """doc_id, tag, places, sizes: phrases that an earlier document has. rows: doc_id, tag, text."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shards(batches, 2):
            doc, start, size, hi, lo = Shard(batch.column(2).to_pylist()).phrases()
            order = np.lexsort((lo, hi))
            bucket = (hi % np.uint64(buckets)).astype(np.int64)
            yield entries(batch, doc, start, size, hi, lo, bucket, order, runs_of(order, hi, lo), later=True)

    return rows.mapInArrow(emit, ENTRIES_DDL).groupBy("bucket").applyInArrow(answers(later=True), FOUND_DDL)


def shared_anchors(rows: DataFrame, buckets: int) -> DataFrame:
    """doc_id, tag, places, sizes: anchors of the dictionary that two documents share.

    rows: doc_id, tag, text, phrases. Within a bucket 32 bits tell anchors apart: two that agree by chance cost a
    comparison, no more.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shards(batches, 2):
            shard = Shard(batch.column(2).to_pylist())
            place, h = shard.anchors(shard.open_starts([ranges_of(c) for c in batch.column(3).to_pylist()]))
            doc = shard.doc_of(place)
            order = np.argsort(h, kind="stable")
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            lo = (h >> np.uint64(32)).astype(np.uint32)
            yield entries(batch, doc, place - shard.starts[doc], np.zeros(len(doc), np.int64), h, lo, bucket, order, runs_of(order, h), later=False)

    return rows.mapInArrow(emit, ENTRIES_DDL).groupBy("bucket").applyInArrow(answers(later=False), FOUND_DDL)


def repeated_suffixes(rows: DataFrame, buckets: int) -> DataFrame:
    """doc_id, tag, places, sizes: starts near shared anchors whose match an earlier document has.

    rows: doc_id, tag, text, phrases, anchors.
    """
    reach = MATCH - ANCHOR

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shards(batches, 2):
            shard = Shard(batch.column(2).to_pylist())
            near = np.zeros(shard.n + 1, np.int32)
            for start, cell in zip(shard.starts.tolist(), batch.column(4).to_pylist(), strict=True):
                at = start + ranges_of(cell)[0]
                np.add.at(near, np.maximum(at - reach, start), 1)
                np.add.at(near, at + 1, -1)
            starts = shard.open_starts([ranges_of(c) for c in batch.column(3).to_pylist()])
            place = np.flatnonzero(starts & (np.cumsum(near[:-1]) > 0))
            doc = shard.doc_of(place)
            order, runs, hi, lo = shard.suffixes(place)
            bucket = (hi % np.uint64(buckets)).astype(np.int64)
            yield entries(batch, doc, place - shard.starts[doc], np.ones(len(doc), np.int64), hi, lo, bucket, order, runs, later=True)

    return rows.mapInArrow(emit, ENTRIES_DDL).groupBy("bucket").applyInArrow(answers(later=True), FOUND_DDL)


def whole_copies(rows: DataFrame) -> DataFrame:
    """_doc, _tag of the texts that an earlier document has whole; texts are compared by 128 bits."""
    light = rows.select("doc_id", "tag", F.xxhash64("text").alias("x"), F.xxhash64(F.lit(MATCH), "text").alias("y"))
    first = light.groupBy("x", "y").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    again = light.join(first, ["x", "y"]).where("doc_id > first")
    return again.select(F.col("doc_id").alias("_doc"), F.col("tag").alias("_tag"), F.lit(True).alias("whole")).distinct()


def removal(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What to remove, by row: whole texts, phrases, and further starts. rows: doc_id, tag, text, without nulls."""
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("bigint").alias("n")).first()["n"]
    buckets = max(LEAST_BUCKETS, size // BUCKET_TEXT)
    copies = settle(whole_copies(rows), "copies")
    named = copies.select("_doc", "_tag")
    rows = with_rows(rows, F.broadcast(named) if copies.count() <= BROADCAST_COPIES else named, "left_anti")
    phrases = settle(per_row(repeated_phrases(rows, buckets), "phrases"), "phrases")
    anchors = settle(per_row(shared_anchors(with_rows(rows, phrases, "left"), buckets), "anchors"), "anchors")
    near = with_rows(with_rows(rows, anchors, "inner"), phrases, "left").select("doc_id", "tag", "text", "phrases", "anchors")
    starts = settle(per_row(repeated_suffixes(near, buckets), "starts"), "starts")
    return copies, phrases, starts


def removed_bytes(data: bytes, whole: bool | None, *cells: list | None) -> np.ndarray:
    """A mask of the bytes that the matches cover."""
    if whole:
        return np.full(len(data), len(data) >= MATCH)
    change = np.zeros(len(data) + 1, np.int32)
    for b, n in map(ranges_of, cells):
        np.add.at(change, b, 1)
        np.add.at(change, np.minimum(b + n + MATCH - 1, len(data)), -1)
    return np.cumsum(change[:-1]) > 0


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).select(
        "doc_id", F.expr(TAG).alias("tag"), "text"
    )


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans of every document.

    A null or empty text has no bytes; a document without doc_id has no place in the order: it loses nothing and
    takes nothing from others. Rows that share a doc_id aren't earlier than each other; each returns a row.
    """
    rows = keyed(docs)
    copies, phrases, starts = removal(rows.where("doc_id IS NOT NULL AND text IS NOT NULL"))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
         ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))]
    )

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            for doc, text, *found in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)), strict=True):
                data = (text or "").encode()
                spans, kept, removed = [], data, 0
                if any(found):
                    gone = removed_bytes(data, *found)
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                    spans = [[b, e - b] for b, e in edge.reshape(-1, 2).tolist()]
                    kept, removed = np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum())
                for f, v in zip(schema, (doc, len(data), removed, len(spans), hashlib.sha256(kept).hexdigest(), spans), strict=True):
                    out[f.name].append(v)
            yield arrow_rows(schema, **out)

    marked = with_rows(with_rows(with_rows(rows, copies, "left"), phrases, "left"), starts, "left")
    marked = marked.select("doc_id", "tag", "text", "whole", "phrases", "starts")
    return marked.mapInArrow(
        report, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<array<bigint>>"
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """docs without the repeated passages, and n_chars, if there is one, set anew where a text changed.

    A match may begin or end inside a character; what is left of such a character goes, too.
    """
    names, text_type, own = docs.columns, docs.schema["text"].dataType, own_prefix(docs)
    copies, phrases, starts = removal(keyed(docs).where("doc_id IS NOT NULL AND text IS NOT NULL"))
    rows = docs.withColumn("text", F.col("text").cast("string"))
    rows = rows.withColumns({own + "id": F.col("doc_id").cast("bigint"), own + "tag": F.expr(TAG)})
    for more, column in ((copies, "whole"), (phrases, "phrases"), (starts, "starts")):
        more = more.select(F.col("_doc").alias(own + "d"), F.col("_tag").alias(own + "t"), F.col(column).alias(own + column))
        same = (F.col(own + "id") == F.col(own + "d")) & (F.col(own + "tag") == F.col(own + "t"))
        rows = rows.join(more, same, "left").drop(own + "d", own + "t")
    at, schema = names.index("text"), T.StructType([*rows.select(*names).schema.fields, T.StructField(own + "cut", T.BooleanType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, changed = [], []
            n = len(names)
            for text, *found in zip(*(batch.column(i).to_pylist() for i in (at, n + 2, n + 3, n + 4)), strict=True):
                changed.append(any(found))
                if changed[-1]:
                    data = text.encode()
                    gone = removed_bytes(data, *found)
                    text = np.frombuffer(data, np.uint8)[~gone].tobytes().decode(errors="ignore")
                texts.append(text)
            columns = batch.columns[:n]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(changed, pa.bool_())], names=schema.names)

    out = rows.mapInArrow(cut, schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(own + "cut"), F.char_length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.withColumn("text", F.col("text").cast(text_type)).select(*names)
