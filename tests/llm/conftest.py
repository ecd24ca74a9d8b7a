from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tallyspark.llm.tables import reachable

#: Columns whose names the operators use themselves.
CLASHING = ("n_tokens", "kept", "score", "tag", "rep", "key", "length", "_doc", "_gone", "spans", "component", "n", "fingerprint")


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    reachable(spark)


def documents(spark, rows, parts=3):
    """A documents table of (doc_id, text) with the usual columns and clashing ones, some of them null."""
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields] + [T.StructField(n, T.StringType()) for n in CLASHING])
    full = [(d, t, None, "src0", None if t is None else len(t), *(n if (d or 0) % 2 else None for n in CLASHING)) for d, t in rows]
    df = spark.createDataFrame(full, schema)
    return df.repartition(parts) if rows else df


ODD_ROWS = [
    (1, None),
    (2, ""),
    (3, "one"),
    (4, "  two\t words \n"),
    (5, "Ünïcödé — ß 日本語 " * 40),
    (6, "plain words that go on " * 9000),  # 200,000 characters
    (7, "the same text twice, long enough to be one of the longer ones here"),
    (7, "the same text twice, long enough to be one of the longer ones here"),
    (8, "the same text twice, long enough to be one of the longer ones here"),
    (9, "the same id, another text, of a length that could match: " + "x" * 60),
    (9, "the same id, another text, of a length that could match: " + "y" * 60),
    (None, "no id but words in it, and as many as it takes to be a match with 11"),
    (11, "no id but words in it, and as many as it takes to be a match with 11"),
    (12, "<|endoftext|> <s> ▁▁ \x00 tail"),
]


@pytest.fixture
def odd(spark):
    return documents(spark, ODD_ROWS)


@pytest.fixture
def none(spark):
    return documents(spark, [])
