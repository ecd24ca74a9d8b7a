"""Layered tables as Parquet with a commit log.

Every write goes to a fresh folder and becomes visible when one log row names it, so
a reader never sees a half-written table and a rerun after a lost executor or driver
starts clean. One writer per table at a time.

The log is ``<table>/log/commit=<version>-<mark>``, one row a folder: a reader lists names and opens the newest only.
Ids of landed batches are ``<table>/batches/_prefix=<first two characters>``, each with the mark of the commit it
belongs to. They are written before it, and count only once the log names the mark.

Folders are ``<table>/data/_write=<id>/_part=<value>``, so a filter on ``_part`` prunes folders.
A keyed table keeps beside its data which part each key was put into: a batch's keys are searched
in the batch's own parts and in those this index names, and no other part is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.shuffles import released_shuffles, setting
from tallyspark.operators.upsert import upsert

LOG_SCHEMA = "version bigint, schema string, parts array<struct<value:string,path:string>>, keys string"
BATCH_SCHEMA = "batch_id string, mark string, _prefix string"
PREFIX, PREFIX_LENGTH = "_prefix", 2
PART, WRITE = "_part", "_write"
NO_PARTITION = "none"
#: The part of a folder written without a partition: it may hold rows of any.
WHOLE = "all"
#: Folders of a key index by the keys' hash; a lookup opens those of its own keys.
KEY_BUCKETS = 64
#: Hashes in hex fill the wide tables; zstd halves them, the default codec leaves them as they are.
CODEC = "zstd"
BUCKET, KEY = "_bucket", "_key"
#: Files that a task keeps open at once, one a partition, where its rows lie by partition.
OPEN_FILES, LYING_PARTS = "spark.sql.maxConcurrentOutputFileWriters", "8"


@dataclass(frozen=True)
class Version:
    """What one commit makes live."""

    number: int
    schema: T.StructType | None
    parts: list[tuple[str, str]]
    #: Folder of the key index that covers these parts, if there is one.
    keys: str | None = None


def widened(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Old columns, then columns only the new rows have."""
    fields = list(old.fields) if old is not None else []
    names = {f.name for f in fields}
    return T.StructType([*fields, *[f for f in new.fields if f.name not in names]])


def commit_name(version: int, mark: str) -> str:
    return f"commit={version:012d}-{mark}"


class TableStore:
    """Tables under one root: ``<root>/<layer>/<table>``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _home(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _read_folder(self, path: str, read: Callable[[str], DataFrame]) -> DataFrame | None:
        """A folder's files, or None before its first one."""
        try:
            return read(path)
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" in str(missing):
                return None
            raise

    def log(self, name: str) -> DataFrame | None:
        """All commits of a table, with ``commit``, their folder's name."""
        return self._read_folder(f"{self._home(name)}/log", self.spark.read.schema(f"{LOG_SCHEMA}, commit string").json)

    def commits(self, name: str) -> DataFrame | None:
        """(path, version, mark) of each commit, from the names of files alone."""
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
        files = self._read_folder(f"{self._home(name)}/log", listed.load)
        if files is None:
            return None
        part = lambda i: F.regexp_extract("path", r"/commit=(\d+)-([0-9a-f]+)/[^/]*$", i)
        return files.select("path", part(1).cast("bigint").alias("version"), part(2).alias("mark"))

    def _live(self, name: str) -> Version:
        """Live version, its columns and its folders: one log row."""
        commits = self.commits(name)
        newest = None if commits is None else commits.agg(F.max_by("path", "version")).first()[0]
        if newest is None:
            return Version(0, None, [])
        last = self.spark.read.schema(LOG_SCHEMA).json(newest).first()
        return Version(last.version, T.StructType.fromJson(json.loads(last.schema)), [(p.value, p.path) for p in last.parts], last.keys)

    def version(self, name: str) -> int:
        return self._live(name).number

    def exists(self, name: str) -> bool:
        return self._live(name).number > 0

    def read(self, name: str, parts: bool = False) -> DataFrame | None:
        """The live table, or None before its first commit; with ``parts``, its partition column is kept."""
        live = self._live(name)
        return self._load(name, live.schema, live.parts, parts) if live.parts else None

    def read_since(self, name: str, version: int, parts: bool = False) -> DataFrame | None:
        """Rows of the folders that became live after a version; None if there are none. Only these are opened."""
        live = self._live(name)
        log = self.log(name)
        name_of = F.col("commit").startswith(f"{version:012d}-")  # opens this commit's folder only
        before = None if log is None else log.where(name_of).select("parts").first()
        seen = set() if before is None else {p.path for p in before.parts}
        added = [(v, p) for v, p in live.parts if p not in seen]
        return self._load(name, live.schema, added, parts) if added else None

    def _load(self, name: str, schema: T.StructType, parts: Sequence[tuple[str, str]], keep: bool = False) -> DataFrame:
        # The logged schema saves reading every footer; columns a file lacks are NULL.
        placed = T.StructType([*schema.fields, T.StructField(WRITE, T.StringType()), T.StructField(PART, T.StringType())])
        rows = self.spark.read.schema(placed).option("basePath", f"{self._home(name)}/data").parquet(*[p for _, p in parts])
        return rows.drop(WRITE) if keep else rows.drop(WRITE, PART)

    def batches(self, name: str) -> DataFrame:
        """Ids of every batch ever committed to a table."""
        entries = self._read_folder(f"{self._home(name)}/batches", self.spark.read.schema(BATCH_SCHEMA).parquet)
        commits = self.commits(name)
        if entries is None or commits is None:
            return self.spark.createDataFrame([], "batch_id string")
        return entries.join(commits.select("mark"), "mark", "left_semi").select("batch_id").distinct()

    def known_batches(self, name: str, ids: Sequence[str]) -> set[str]:
        """Which of a wave's ids were committed. Opens the folders of their prefixes only."""
        if not ids:
            return set()
        entries = self._read_folder(f"{self._home(name)}/batches", self.spark.read.schema(BATCH_SCHEMA).parquet)
        if entries is None:
            return set()
        prefixes = sorted({i[:PREFIX_LENGTH] for i in ids})
        own = entries.where(F.col(PREFIX).isin(prefixes) & F.col("batch_id").isin(list(ids)))
        return {r.batch_id for r in own.join(self.commits(name).select("mark"), "mark", "left_semi").select("batch_id").collect()}

    def _commit(self, name: str, version: Version, batches: Sequence[str] = ()) -> None:
        mark = uuid.uuid4().hex
        if batches:
            entries = self.spark.createDataFrame([(i, mark, i[:PREFIX_LENGTH]) for i in batches], BATCH_SCHEMA)
            entries.coalesce(1).write.mode("append").partitionBy(PREFIX).parquet(f"{self._home(name)}/batches")
        parts = [{"value": v, "path": p} for v, p in version.parts]
        row = [(version.number, version.schema.json(), parts, version.keys)]
        self.spark.createDataFrame(row, LOG_SCHEMA).coalesce(1).write.json(f"{self._home(name)}/log/{commit_name(version.number, mark)}")

    def _write(
        self, name: str, df: DataFrame, partition: Column | None = None, columns: Sequence[Column | str] = ("*",),
        lying: bool = False,
    ) -> list[tuple[str, str]]:
        """Rows into a fresh folder, by partition if there is one; returns its parts. Partition values must be plain
        words, as they name folders, and few (months). ``columns`` are taken of the rows after their shuffle; rows
        ``lying`` by partition are not shuffled."""
        path = f"{self._home(name)}/data/{WRITE}={uuid.uuid4().hex}"
        # Tasks of lying rows meet few partitions, so they keep a file open for each instead of sorting; past that they sort.
        with released_shuffles(df.sparkSession), setting(df.sparkSession, OPEN_FILES, LYING_PARTS if lying else None):
            if partition is None:
                df.select(*columns).write.option("compression", CODEC).parquet(f"{path}/{PART}={WHOLE}")
                return [(WHOLE, f"{path}/{PART}={WHOLE}")]
            # Adaptive execution splits a month that holds most rows by size, and joins small ones.
            dealt = df.withColumn(PART, partition)
            dealt = dealt if lying else dealt.hint("rebalance", PART)
            stored = dealt if tuple(columns) == ("*",) else dealt.select(*columns, PART)
            stored.write.option("compression", CODEC).partitionBy(PART).parquet(path)
        filled = self.spark.read.schema(stored.schema).parquet(path).select(PART).distinct().collect()
        return [(r[0], f"{path}/{PART}={r[0]}") for r in sorted(filled)]

    def replace(
        self, name: str, df: DataFrame, partition: Column | None = None, columns: Sequence[Column | str] = ("*",),
        lying: bool = False,
    ) -> DataFrame:
        """Publish a new full version; the old one stays readable until then. ``columns`` are what is stored of the rows,
        made after the shuffle by partition, so that wide columns that follow from narrow ones aren't shuffled. Rows
        ``lying`` by partition, as those of a stored table do, need no such shuffle."""
        parts = self._write(name, df, None if partition is None else part_of(partition), columns, lying)
        # A table without rows still has a folder, so that it can be read.
        parts = parts or self._write(name, df, columns=columns)
        self._commit(name, Version(self._live(name).number + 1, df.select(*columns).schema, parts))
        return self.read(name)

    def append(self, name: str, df: DataFrame, batches: Sequence[str] = ()) -> None:
        """Add rows, recording the batches they came from in the same commit."""
        parts = self._write(name, df)
        live = self._live(name)
        self._commit(name, Version(live.number + 1, widened(live.schema, df.schema), [*live.parts, *parts]), batches)

    def _staged(self, name: str, new: DataFrame, partition: Column) -> tuple[DataFrame, str]:
        """The batch with its parts, written once, so that it is not computed again for each use, and its folder."""
        path = f"{self._home(name)}.staging/{uuid.uuid4().hex}"
        with released_shuffles(new.sparkSession):
            new.withColumn(PART, part_of(partition)).write.option("compression", CODEC).parquet(path)
        return self.spark.read.parquet(path), path

    def _emptied(self, path: str) -> None:
        """Free a staged batch's rows, once what was made of them is committed. Its folder stays for `purge`."""
        place, files = self._place(path)
        files.delete(place, True)
        files.mkdirs(place)

    def _index(self, entries: DataFrame, folder: str) -> DataFrame:
        """Add (key, part) entries to a key index; returns them. An entry that no commit follows only names a part
        too many, so an index needs no log."""
        path = f"{folder}/{WRITE}={uuid.uuid4().hex}"
        with released_shuffles(entries.sparkSession):
            bucketed = entries.withColumn(BUCKET, F.pmod(F.xxhash64(KEY), F.lit(KEY_BUCKETS)).cast("int"))
            bucketed.hint("rebalance", BUCKET).write.option("compression", CODEC).partitionBy(BUCKET).parquet(path)
        return self.spark.read.schema(f"{KEY} string, {PART} string, {BUCKET} int").parquet(path)

    def _first(
        self, name: str, live: Version, new: DataFrame, keys: Sequence[str], partition: Column, columns: Sequence[Column | str] = ("*",)
    ) -> DataFrame:
        """Rows of a table that holds none yet: written once, to their parts, and indexed from there."""
        parts, schema = self._write(name, new, part_of(partition), columns), new.select(*columns).schema
        if not parts:
            return self.replace(name, self.spark.createDataFrame([], schema))
        folder = f"{self._home(name)}/keys/{uuid.uuid4().hex}"
        key = F.to_json(F.struct(*keys)).alias(KEY)
        self._index(self._load(name, schema, parts, keep=True).select(key, PART), folder)
        self._commit(name, Version(live.number + 1, schema, parts, folder))
        return self.read(name)

    def _reach(
        self, name: str, live: Version, batch: DataFrame, keys: Sequence[str], partition: Column, repeated: bool = False
    ) -> tuple[set[str], str]:
        """Parts that may hold rows with a batch's keys, the batch's own included, and the index folder. Keys that may be
        ``repeated`` collapse within the map tasks before they meet others."""
        key, value = F.to_json(F.struct(*keys)).alias(KEY), part_of(partition).alias(PART)
        own = {r[0] for r in batch.select(PART).distinct().collect()}
        folder = live.keys
        if folder is None:  # no index yet, or rows came in past it: one pass over the key columns
            folder = f"{self._home(name)}/keys/{uuid.uuid4().hex}"
            if live.parts:
                self._index(self._load(name, live.schema, live.parts).select(key, value), folder)
        near = [(v, p) for v, p in live.parts if v in own]
        places = batch.select(key, PART)
        places = places.distinct() if repeated else places
        if near:
            held = self._load(name, live.schema, near, keep=True).select(key, PART)
            places = places.join(held, [KEY, PART], "left_anti")
        fresh = self._index(places, folder)
        buckets = [r[0] for r in fresh.select(BUCKET).distinct().collect()]  # at most KEY_BUCKETS
        known = self.spark.read.schema(f"{KEY} string, {PART} string, {WRITE} string, {BUCKET} int").parquet(folder)
        # Entries of the batch's own parts, its new ones among them, name no other part and need not be shuffled.
        known = known.where(F.col(BUCKET).isin(buckets) & ~F.col(PART).isin(own))
        with released_shuffles(self.spark):
            named = known.join(fresh.select(KEY), KEY, "left_semi").select(PART).distinct().collect()
        return own | {r[0] for r in named} | {WHOLE}, folder

    def upsert(
        self, name: str, new: DataFrame, keys: Sequence[str], partition: Column, columns: Sequence[Column | str] = ("*",)
    ) -> DataFrame:
        """Keyed upsert that rewrites only the parts it touches.

        A part is touched when a new row falls into it or when it may hold the old row of a replaced key; all others
        are carried over by path, unread. Both sides hold a key once. ``columns``, with keys and partition among them,
        are what is stored of the new rows, which are staged and shuffled as they come.
        """
        live = self._live(name)
        batch, staged = self._staged(name, new, partition)
        if not live.parts:  # no key can be there already, so none is looked for
            out = self._first(name, live, batch.drop(PART), keys, partition, columns)
            self._emptied(staged)
            return out
        if not batch.take(1):
            return self.read(name)
        hit, folder = self._reach(name, live, batch, keys, partition)
        touched = [(v, p) for v, p in live.parts if v in hit]
        rows, schema = batch.drop(PART), widened(live.schema, new.select(*columns).schema)
        if touched:
            merged = upsert(self._load(name, live.schema, touched), rows.select(*columns), keys)
            written = self._write(name, merged, part_of(partition))
        else:
            written = self._write(name, rows, part_of(partition), columns)
        kept = [(v, p) for v, p in live.parts if v not in hit]
        self._commit(name, Version(live.number + 1, schema, kept + written, folder))
        self._emptied(staged)
        return self.read(name)

    def purge(self, name: str) -> list[str]:
        """Delete what the live version doesn't name: replaced folders, those of writes that never ended, staged copies
        and old key indexes. Run it while nobody writes the table or reads an older version. Returns what it deleted."""
        home, live = self._home(name), self._live(name)
        kept = {"/".join(p.rstrip("/").rsplit("/", 2)[1:]) for _, p in live.parts}
        gone = [p for write in self._folders(f"{home}/data") for p in self._folders(write) if "/".join(p.rsplit("/", 2)[1:]) not in kept]
        gone += self._folders(f"{home}.staging")
        index = None if live.keys is None else live.keys.rstrip("/").rsplit("/", 1)[1]
        gone += [p for p in self._folders(f"{home}/keys") if p.rsplit("/", 1)[1] != index]
        for path in gone:
            place, files = self._place(path)
            files.delete(place, True)
        return gone

    def _place(self, path: str) -> tuple:
        """A path and its file system."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _folders(self, path: str) -> list[str]:
        """Folders right under one."""
        place, files = self._place(path)
        if not files.exists(place):
            return []
        return [f.getPath().toString() for f in files.listStatus(place) if f.isDirectory()]

    def insert(self, name: str, new: DataFrame, keys: Sequence[str], partition: Column) -> DataFrame:
        """Add the rows whose key the table does not hold yet; rows it holds stay as they are, and no folder is
        rewritten. ``new`` holds a key once."""
        live = self._live(name)
        if not live.parts:
            return self._first(name, live, new, keys, partition)
        batch, staged = self._staged(name, new, partition)
        hit, folder = self._reach(name, live, batch, keys, partition)
        near = [(v, p) for v, p in live.parts if v in hit]
        added = batch.drop(PART)
        if near:
            added = added.join(self._load(name, live.schema, near).select(*keys), list(keys), "left_anti")
        parts = self._write(name, added, part_of(partition))
        if parts:
            self._commit(name, Version(live.number + 1, widened(live.schema, new.schema), [*live.parts, *parts], folder))
        self._emptied(staged)
        return self.read(name)

    def insert_of(
        self,
        name: str,
        offered: DataFrame,
        made: Callable[[DataFrame | None], DataFrame],
        keys: Sequence[str],
        partition: Column,
        columns: Callable[[Sequence[str]], Sequence[Column | str]] = lambda _: ("*",),
    ) -> DataFrame:
        """`insert` of rows that are costly to make of stored ones.

        ``offered`` are the stored rows, with the keys, perhaps repeated, and what the partition follows from. ``made``
        gets the keys that the table may hold of these, or None, and returns the rows to add, without these and each key
        once; so rows that are there already go before they are made, and the others are written once. ``columns`` gives
        what is stored of the columns made."""
        live = self._live(name)
        if not live.parts:
            new = made(None)
            return self._first(name, live, new, keys, partition, columns(new.columns))
        brought = offered.select(*keys, part_of(partition).alias(PART))
        hit, folder = self._reach(name, live, brought, keys, partition, repeated=True)
        near = [(v, p) for v, p in live.parts if v in hit]
        new = made(self._load(name, live.schema, near).select(*keys) if near else None)
        stored = columns(new.columns)
        parts = self._write(name, new, part_of(partition), stored)
        if parts:
            schema = widened(live.schema, new.select(*stored).schema)
            self._commit(name, Version(live.number + 1, schema, [*live.parts, *parts], folder))
        return self.read(name)


def part_of(partition: Column) -> Column:
    return F.coalesce(partition.cast("string"), F.lit(NO_PARTITION))
