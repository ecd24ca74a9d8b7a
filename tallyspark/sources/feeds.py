"""CSV feed files: discovery, content hashes, headers and all-text reading."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Sequence
from fnmatch import fnmatch
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.gate import MALFORMED
from tallyspark.sources.contracts import FeedContract
from tallyspark.sources.records import ends_inside, numbered_lines, records

WAVE_FILES = 1000
#: Lines whose digests are folded together.
BLOCK_LINES = 10_000
# Stands for "no text at all": landing turns it back into ''.
NEVER = "\u0001"
FILE_PATH = "_metadata.file_path"
CORRUPT = "_corrupt_record"


def discover(spark: SparkSession, folder: str, contract: FeedContract) -> DataFrame:
    """(path, name, length) of a feed's files; no file contents are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", contract.file_glob).load(folder)
    return files.select(
        F.col(FILE_PATH).alias("path"), F.col("_metadata.file_name").alias("name"), F.col("length").alias("length")
    )


def unmatched(spark: SparkSession, folder: str, contracts: Iterable[FeedContract]) -> list[str]:
    """Names of a folder's files that fit no feed."""
    names = (path.rsplit("/", 1)[-1] for path in spark.read.format("binaryFile").load(folder).inputFiles())
    globs = [c.file_glob for c in contracts]
    return sorted(name for name in map(unquote, names) if not any(fnmatch(name, g) for g in globs))


def empty_files(spark: SparkSession, folder: str, contract: FeedContract) -> list[str]:
    """Names of a feed's files without a byte, which no scan returns."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", contract.file_glob).load(folder)
    seen = {_place(r["path"]) for r in files.select(F.col(FILE_PATH).alias("path")).toLocalIterator()}
    return sorted(place.rsplit("/", 1)[-1] for place in map(_place, files.inputFiles()) if place not in seen)


def _place(path: str) -> str:
    """A path without its scheme's slashes and escapes, which Spark writes in two ways."""
    return unquote(path).split(":", 1)[-1].lstrip("/")


def waves(files: DataFrame, size: int = WAVE_FILES) -> Iterator[list]:
    """File names in path order, a bounded number at a time."""
    wave: list = []
    for row in files.orderBy("path").toLocalIterator():
        wave.append(row)
        if len(wave) == size:
            yield wave
            wave = []
    if wave:
        yield wave


def content_batch_id(content: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the bytes."""
    return F.substring(F.sha2(content, 256), 1, 16)


def manifest(spark: SparkSession, files: Sequence, block_lines: int = BLOCK_LINES) -> DataFrame:
    """(path, batch_id, header, broken) of a wave of files, of any size; a file without bytes has neither id nor header.

    `broken` tells whether quoted cells may hold line breaks, which takes another way to read a file.

    The id is one definition for every size: lines are numbered over the file's splits, each line's bytes are hashed,
    digests of `block_lines` lines in order are folded, then the blocks' digests in order with the file's length. It
    depends on every byte and on the order of lines, not on where splits fall, and no task holds a file.
    """
    sizes = spark.createDataFrame([(f.path, f.length) for f in files], "path string, bytes bigint")
    lines = numbered_lines(spark, [f.path for f in files])
    hashed = lines.select("path", "split", "at", F.sha2(F.col("value").cast("binary"), 256).alias("digest"))
    counts = lines.groupBy("path", "split").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("path").alias("_path"), F.col("split").alias("_split"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    # A split is one task's lines, in the order of its ids.
    inside = F.row_number().over(Window.partitionBy("path", "split").orderBy("at")) - 1
    numbered = hashed.withColumn("inside", inside).join(starts, (F.col("path") == F.col("_path")) & (F.col("split") == F.col("_split")))
    numbered = numbered.select("path", (F.col("start") + F.col("inside")).alias("line"), "digest")
    block = F.floor(F.col("line") / block_lines).alias("block")

    def folded(place: str, text: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(place, text)))
        return F.sha2(F.array_join(F.transform(ordered, lambda x: x[text]), ",").cast("binary"), 256)

    blocks = numbered.groupBy("path", block).agg(folded("line", "digest").alias("digest"))
    whole = blocks.groupBy("path").agg(folded("block", "digest").alias("digest"))
    first = lines.groupBy("path").agg(
        F.min_by("value", F.struct("split", "at")).alias("header"), F.max(ends_inside(F.col("value"))).alias("broken")
    )
    ids = F.substring(F.sha2(F.concat_ws("|", F.col("bytes").cast("string"), "digest").cast("binary"), 256), 1, 16)
    found = sizes.join(whole, "path", "left").join(first, "path", "left")
    return found.select("path", F.when(F.col("digest").isNotNull(), ids).alias("batch_id"), "header", F.coalesce("broken", F.lit(False)).alias("broken"))


def header_columns(header: str) -> tuple[str, ...]:
    """Column names of a header line."""
    line = header.lstrip("\ufeff").rstrip("\r\n")
    return tuple(name.strip() for name in next(csv.reader([line])))


def header_fault(columns: Sequence[str]) -> str | None:
    """Why rows under a header can't be told apart by column; None if they can."""
    folded = [c.lower() for c in columns]
    if not any(folded):
        return "no_header"
    return "duplicate_column" if len(set(folded)) < len(folded) else None


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def read_text_columns(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], broken: bool = False) -> DataFrame:
    """CSV files of one header layout with every column text, nothing inferred and
    blanks kept as '' (landing's null policy); adds the file path as ``_path`` and
    whether a row has more or fewer cells than the header as ``_malformed``. Files
    stay splittable; those with line breaks in quoted cells are read as ``broken``."""
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in columns), T.StructField(CORRUPT, T.StringType())])
    options = {"escape": '"', "nullValue": NEVER, "emptyValue": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if broken:
        cells = F.from_csv("text", _ddl(schema), options | {"multiLine": "true"})
        found = records(numbered_lines(spark, paths)).select(cells.alias("r"), F.col("path").alias("_path"))
        raw, path = found.select("r.*", "_path"), F.col("_path")
    else:
        raw, path = spark.read.schema(schema).options(header=True, **options).csv(list(paths)), F.col(FILE_PATH).alias("_path")
    texts = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns]
    # Spark refuses to read the mark alone, so it is always read beside a cell.
    malformed = (F.length(F.coalesce(F.col(f"`{columns[0]}`"), F.lit(""))) >= 0) & F.col(CORRUPT).isNotNull()
    return raw.select(*texts, malformed.alias(MALFORMED), path)


def stamp(rows: DataFrame, loaded_at: Column, source_file: Column, batch_id: Column, source_system: str) -> DataFrame:
    """Add the four load-metadata columns."""
    return rows.withColumns(
        {
            "_loaded_at": loaded_at.cast("timestamp"),
            "_source_file": source_file,
            "_batch_id": batch_id,
            "_source_system": F.lit(source_system),
        }
    )
