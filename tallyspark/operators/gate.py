"""Contract validation as aggregates: every rule is a conditional count per file.

One pass counts all column rules, one more per uniqueness rule; both combine inside
map tasks, so a file (or key) that holds most rows costs no more than another.
Result tables hold one row per file or per file and broken rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.casting import AMOUNT, FALSE_WORDS, TRUE_WORDS, null_safe_cast, parse_timestamp
from tallyspark.plans.bronze import META_COLUMNS
from tallyspark.sources.contracts import ColumnRule, FeedContract

FILE = "_source_file"
SAMPLE_VALUES = 5

# Words the gate reads as null (the public pandas defaults). Landing
# keeps them as text.
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

STRUCTURAL = ("missing_column", "unexpected_column")

#: A reader's mark on rows whose cells don't fit the header.
MALFORMED = "_malformed"
#: Plain decimal or exponent notation; engines differ on what else they call a number.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
#: Decimals read before a value is held against its landed type.
WIDE = "decimal(38,9)"


@dataclass(frozen=True)
class Rule:
    column: str
    rule: str
    detail: str
    broken: Column
    severity: str = "error"


def gate_nulls(raw: DataFrame, contract: FeedContract) -> DataFrame:
    """The gate's reading of landed text: NA words are null."""
    present = [n for n in contract.names if n in raw.columns]
    return raw.withColumns({n: F.when(~F.col(n).isin(*NA_WORDS), F.col(n)) for n in present})


def _parsed(rule: ColumnRule) -> Column:
    """A cell in comparable form, NULL when it does not parse."""
    col = F.col(rule.name)
    if rule.dtype in ("date", "timestamp"):
        return parse_timestamp(col)
    if rule.dtype == "boolean":
        return F.when(col.isin(*TRUE_WORDS, *FALSE_WORDS), col)
    return F.when(col.rlike(NUMBER), col.try_cast("double"))


def _kept(rule: ColumnRule) -> Column:
    """Whether typing keeps a number to nine decimals: bronze's own cast finds room for it, and silver's for amounts."""
    col = F.col(rule.name)
    if rule.dtype == "float":
        return F.lit(True)
    wide, landed = col.try_cast(WIDE), null_safe_cast(col, rule.dtype, rule.scale)
    kept = wide == landed.try_cast(WIDE)
    if rule.dtype == "numeric" and rule.scale is None:
        kept = kept & F.round(landed, 4).try_cast(AMOUNT).isNotNull()
    return F.coalesce(kept, F.lit(False))


def _bound(value: float | str, dtype: str) -> Column:
    return F.lit(value).cast("timestamp" if dtype in ("date", "timestamp") else "double")


def _value(rule: ColumnRule) -> str:
    return f"_parsed_{rule.name}"


def _lands(rule: ColumnRule) -> str:
    return f"_lands_{rule.name}"


def readings(rule: ColumnRule) -> dict[str, Column]:
    """What the rules of one column read beside its text: the parsed value, and whether typing keeps it."""
    if rule.dtype == "string":
        return {}
    kept = {_lands(rule): _kept(rule)} if rule.dtype in ("integer", "float", "numeric") else {}
    return {_value(rule): _parsed(rule)} | kept


def column_rules(rule: ColumnRule) -> list[Rule]:
    """Row conditions of one column, over its text and its `readings`. Range,
    domain and pattern rules skip nulls."""
    col = F.col(rule.name)
    value = F.col(_value(rule))
    good = F.lit(True)
    out = []
    if rule.dtype != "string":
        good = value.isNotNull()
        if rule.dtype in ("integer", "float", "numeric"):
            good = good & F.col(_lands(rule))
        out.append(Rule(rule.name, "dtype", f"cells that can't be landed as {rule.dtype}", col.isNotNull() & ~good))
    if not rule.nullable:
        out.append(Rule(rule.name, "not_null", "cells left empty", col.isNull()))
    if rule.allowed is not None:
        out.append(Rule(rule.name, "accepted_values", "outside the accepted values", ~col.isin(*rule.allowed)))
    if rule.min is not None:
        low = good & (value < _bound(rule.min, rule.dtype))
        out.append(Rule(rule.name, "min", f"below {rule.min}", low))
    if rule.max is not None:
        high = good & (value > _bound(rule.max, rule.dtype))
        out.append(Rule(rule.name, "max", f"above {rule.max}", high))
    if rule.regex is not None:
        out.append(Rule(rule.name, "regex", f"does not match {rule.regex}", ~col.rlike(f"^(?:{rule.regex})")))
    return out


def duplicate_count(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Per file: rows beyond the first of each key (nulls compare equal)."""
    per_key = df.groupBy(FILE, *keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(FILE).agg(F.sum(F.col("n") - 1).alias(name))


@dataclass(frozen=True)
class FileCounts:
    """Per-file counts: one row per file, one column per rule."""

    counts: DataFrame
    rules: list[tuple[str, Rule]]


def count_broken(raw: DataFrame, contract: FeedContract) -> FileCounts:
    """Count rows per file and rows breaking each rule."""
    df = gate_nulls(raw, contract)
    present = [c for c in contract.columns if c.name in raw.columns]
    rules = [r for c in present for r in column_rules(c)]
    if MALFORMED in raw.columns:
        rules.append(Rule("*", "malformed_row", "more or fewer cells than the header names", F.col(MALFORMED)))
    named = [(f"r{i}", r) for i, r in enumerate(rules)]
    # Read once per row here; every rule of the column takes the result.
    values = df.withColumns({name: value for c in present for name, value in readings(c).items()})
    counts = values.groupBy(FILE).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(r.broken).alias(n) for n, r in named],
    )

    parts = [counts]

    def add_duplicates(keys: list[str], column: str, rule: str, nulls: bool) -> None:
        name = f"r{len(named)}"
        source = df if nulls else df.where(F.col(keys[0]).isNotNull())
        parts.append(duplicate_count(source, keys, name))
        named.append((name, Rule(column, rule, "repeated", F.lit(None))))

    for c in present:
        if c.unique:
            add_duplicates([c.name], c.name, "unique", nulls=False)
    keys = list(contract.primary_key)
    if contract.unique_key and keys and all(k in raw.columns for k in keys):
        add_duplicates(keys, "+".join(keys), "primary_key_unique", nulls=True)

    if len(parts) > 1:
        # Every part holds one row per file; laid over each other by file.
        wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        counts = wide.groupBy(FILE).agg(*[F.max(c).alias(c) for c in wide.columns if c != FILE])

    missing = sorted(set(contract.names) - set(raw.columns))
    extra = sorted(set(raw.columns) - set(contract.names) - {*META_COLUMNS, MALFORMED})
    structural = [Rule(c, "missing_column", "required column absent", F.lit(1)) for c in missing]
    severity = "warning" if contract.allow_extra else "error"
    structural += [Rule(c, "unexpected_column", "column not in the contract", F.lit(1), severity) for c in extra]
    for rule in structural:
        name = f"r{len(named)}"
        counts = counts.withColumn(name, F.lit(0).cast("bigint"))
        named.append((name, rule))
    return FileCounts(counts, named)


def _is_broken(name: str, rule: Rule) -> Column:
    return F.lit(True) if rule.rule in STRUCTURAL else F.coalesce(F.col(name), F.lit(0)) > 0


def sample_values(raw: DataFrame, contract: FeedContract) -> DataFrame:
    """Up to five smallest offending values per file and accepted-values column.

    Repeats collapse before the shuffle and the top-five cut happens in the map
    tasks, so no task sees more than five values per column from another."""
    df = gate_nulls(raw, contract)
    domains = [c for c in contract.columns if c.allowed is not None and c.name in raw.columns]
    if not domains:
        empty = "file string, column string, samples array<string>"
        return raw.sparkSession.createDataFrame([], empty)
    pairs = F.array(
        *[
            F.when(~F.col(c.name).isin(*c.allowed), F.struct(F.lit(c.name).alias("column"), F.col(c.name).alias("value")))
            for c in domains
        ]
    )
    bad = df.select(F.col(FILE).alias("file"), F.explode(F.array_compact(pairs)).alias("bad"))
    values = bad.select("file", "bad.column", "bad.value").distinct()
    w = Window.partitionBy("file", "column").orderBy("value")
    ranked = values.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= SAMPLE_VALUES)
    return ranked.groupBy("file", "column").agg(F.sort_array(F.collect_list("value")).alias("samples"))


def violations(raw: DataFrame, contract: FeedContract) -> DataFrame:
    """(feed, file, column, rule, severity, n, detail) for every broken rule."""
    measured = count_broken(raw, contract)
    entries = [
        F.when(
            _is_broken(name, r),
            F.struct(
                F.lit(r.column).alias("column"),
                F.lit(r.rule).alias("rule"),
                F.lit(r.severity).alias("severity"),
                F.col(name).alias("n"),
                F.lit(r.detail).alias("detail"),
            ),
        )
        for name, r in measured.rules
    ]
    long = measured.counts.select(
        F.lit(contract.feed).alias("feed"), F.col(FILE).alias("file"), F.inline(F.array_compact(F.array(*entries)))
    )
    if not any(c.allowed is not None for c in contract.columns):
        return long
    samples = sample_values(raw, contract).withColumn("rule", F.lit("accepted_values"))
    detail = F.when(
        F.col("samples").isNotNull(), F.concat("detail", F.lit(": "), F.array_join("samples", ", "))
    ).otherwise(F.col("detail"))
    return long.join(samples, ["file", "column", "rule"], "left").select(
        "feed", "file", "column", "rule", "severity", "n", detail.alias("detail")
    )


def verdicts(raw: DataFrame, contract: FeedContract) -> DataFrame:
    """Per file: rows, broken error and warning rules, and whether it passes."""
    measured = count_broken(raw, contract)

    def broken(severity: str) -> Column:
        hits = [_is_broken(n, r).cast("bigint") for n, r in measured.rules if r.severity == severity]
        return reduce(lambda a, b: a + b, hits, F.lit(0).cast("bigint"))

    return measured.counts.select(
        F.lit(contract.feed).alias("feed"),
        F.col(FILE).alias("file"),
        F.col("rows"),
        broken("error").alias("errors"),
        broken("warning").alias("warnings"),
    ).withColumn("passed", F.col("errors") == 0)
