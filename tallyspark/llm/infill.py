"""Fill-in-middle: a text's lines dealt into prefix, middle and suffix, rearranged around sentinels, and put back.

Every step runs over a whole batch in pyarrow: texts become lists of lines, the lists are flattened beside the number
of their text, each line's place in its text follows from the lists' lengths, places decide the part, and the lines of
a part are gathered into lists again and joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.tables import arrow_rows, texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: The order in which a form's pieces follow their sentinels.
ORDER = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
SEED = 7
DRAWS = ("h1", "h2", "h3", "h4")

ARRANGED = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
)
RESTORED = pa.schema([*list(ARRANGED), ("restored", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'bigint'}" for f in schema)


def _whole(column: pa.Array) -> pa.Array:
    return pc.fill_null(column.cast(pa.string()), "")


def lines(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Every line of every text with its line break; the text each is of, its place there, and lines per text."""
    parts = pc.split_pattern(column, "\n")
    lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    parent = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(parts)
    place = np.arange(len(flat), dtype=np.int64) - (np.cumsum(lengths) - lengths)[parent]
    last = place == lengths[parent] - 1
    # What follows a text's last line break is a line only if there is something.
    real = ~(last & (pc.binary_length(flat).to_numpy(zero_copy_only=False) == 0))
    broken = pc.binary_join_element_wise(flat, pc.if_else(pa.array(last), "", "\n"), "")
    return broken.filter(pa.array(real)), parent[real], place[real], np.bincount(parent[real], minlength=len(column))


def gathered(units: pa.Array, parent: np.ndarray, chosen: np.ndarray, n: int) -> pa.Array:
    """The chosen lines of each of n texts, joined."""
    counts = np.bincount(parent[chosen], minlength=n)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), units.filter(pa.array(chosen))), "")


def arrange(doc_ids: pa.Array, column: pa.Array, draws: list[np.ndarray], fim_percent: int, spm_percent: int) -> pa.RecordBatch:
    column = _whole(column)
    units, parent, place, n = lines(column)
    h1, h2, h3, h4 = draws
    first, second = h1 % (n + 1), h2 % (n + 1)
    start, end = np.minimum(first, second), np.maximum(first, second)
    before, inside = place < start[parent], (place >= start[parent]) & (place < end[parent])
    piece = {
        PREFIX: gathered(units, parent, before, len(column)),
        MIDDLE: gathered(units, parent, inside, len(column)),
        SUFFIX: gathered(units, parent, ~before & ~inside, len(column)),
    }
    plain = (n == 0) | (h3 % 100 >= fim_percent)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        plain |= pc.match_substring(column, sentinel).to_numpy(zero_copy_only=False)
    form = np.where(plain, PLAIN, np.where(h4 % 100 < spm_percent, SPM, PSM))
    joined = {f: pc.binary_join_element_wise(*[x for s in order for x in (s, piece[s])], "") for f, order in ORDER.items()}
    output = pc.if_else(pa.array(plain), column, pc.if_else(pa.array(form == SPM), joined[SPM], joined[PSM]))
    moved = pa.array(~plain)
    sizes = {s: pc.if_else(moved, pc.utf8_length(piece[s]).cast(pa.int64()), pa.scalar(None, pa.int64())) for s in (PREFIX, MIDDLE)}
    return arrow_rows(
        ARRANGED, doc_id=doc_ids, n=n, form=form, prefix_chars=sizes[PREFIX], middle_chars=sizes[MIDDLE], output=output
    )


def rebuild(output: pa.Array, form: pa.Array) -> pa.Array:
    """Texts from outputs and forms alone. A piece holds no sentinel, and no sentinel overlaps another, so each piece
    ends at the first sentinel after it."""
    for name, order in ORDER.items():
        mask = pc.equal(form, name)
        rest, piece = output.filter(mask), {}
        if not len(rest):
            continue
        held = None
        for sentinel in order:
            halves = pc.split_pattern(rest, sentinel, max_splits=1)
            if held:
                piece[held] = pc.list_element(halves, 0)
            rest, held = pc.list_element(halves, 1), sentinel
        piece[held] = rest
        output = pc.replace_with_mask(output, mask, pc.binary_join_element_wise(piece[PREFIX], piece[MIDDLE], piece[SUFFIX], ""))
    return output


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim_percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars and output of every whole text.

    Texts are cut at line breaks only; where is drawn from the SHA-256 of `seed:doc_id`, so a rerun cuts alike. An
    empty or null text, one that holds a sentinel already, and (100 - fim_percent) % of the others stay as they are
    (form plain, sizes null). Repeated rows each return a row; rows of one doc_id share its draws; a null doc_id stays
    null and draws as an empty one. Other columns are not read. Each row is one row's work, so no key can be hot.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(h) for i, h in enumerate(DRAWS)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(len(DRAWS))]
            yield arrange(batch.column(0), batch.column(1), drawn, fim_percent, spm_percent)

    return texts(docs).select("doc_id", "text", *draws).mapInArrow(work, _ddl(ARRANGED))


def restore(arranged: DataFrame) -> DataFrame:
    """The rows of `fill_in_middle` with the text rebuilt from output and form alone (column restored)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {f.name: batch.column(i) for i, f in enumerate(ARRANGED)}
            yield arrow_rows(RESTORED, **columns, restored=rebuild(columns["output"].cast(pa.string()), columns["form"].cast(pa.string())))

    return arranged.select(*ARRANGED.names).mapInArrow(work, _ddl(RESTORED))
