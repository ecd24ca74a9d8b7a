"""Answer a metric request as a DataFrame plan.

Filter values become literals, so a value is never more than a value. Each dimension
joins once, even when used both as slice and as filter: by broadcast when counted
small, otherwise after the fact has been aggregated by its own key columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.joins import BROADCAST_ROWS, rows_within, salted_join
from tallyspark.plans.metric_registry import DIMENSIONS, FILTERS, METRICS, TIME_GRAINS, Metric

# Words that mean yes in a boolean filter.
YES = ("true", "1", "yes")


#: Months of a calendar's days, named as the parts of facts stored by month.
PART = "_part"
MONTHS: dict[str, Callable[[], Column]] = {"dim_date": lambda: F.date_format("date_day", "yyyy-MM")}


class MetricError(ValueError):
    """A request that the registry doesn't offer; the text lists everything that is wrong with it."""


#: How a filter's values are read, by the filter's kind.
READERS: dict[str, Callable[[Any], Any]] = {
    "int": int,
    "number": float,
    "bool": lambda v: v is True or str(v).strip().lower() in YES,
    "string": str,
}


def listed(value: Any) -> list[Any]:
    return list(value) if isinstance(value, (list, tuple)) else [value]


def readable(value: Any, kind: str) -> bool:
    try:
        READERS[kind](value)
    except (TypeError, ValueError):
        return False
    return True


def objections(spec: Metric, grain: str, groups: Sequence[str], filters: Mapping[str, Any]) -> list[str]:
    """Everything in a request that its metric doesn't offer."""
    offered = [k for k in filters if k in spec.filters]
    found = {
        "no such grain": [grain] if grain not in TIME_GRAINS else [],
        "no such slice": [d for d in groups if d not in spec.dimensions],
        "not a slice": [d for d in groups if d in spec.dimensions and not DIMENSIONS[d].groupable],
        "no such filter": [k for k in filters if k not in spec.filters],
        "filter without values": [k for k in filters if not listed(filters[k])],
        "unreadable filter value": [f"{k}={v!r}" for k in offered for v in listed(filters[k]) if not readable(v, FILTERS[k].kind)],
    }
    return [f"{rule}: {', '.join(map(str, which))}" for rule, which in found.items() if which]


def resolve(
    name: str, dimensions: Sequence[str] | None, filters: Mapping[str, Any] | None, time_grain: str | None
) -> tuple[Metric, list[str], dict[str, list[Any]]]:
    """(metric, group columns, typed filter values) of a request; a grain's columns come first."""
    if name not in METRICS:
        raise MetricError(f"no such metric: {name}; there are {', '.join(sorted(METRICS))}")
    spec, filters = METRICS[name], filters or {}
    grain = time_grain or spec.grain
    groups = list(dict.fromkeys((*TIME_GRAINS.get(grain, ()), *(dimensions or ()))))
    wrong = objections(spec, grain, groups, filters)
    if wrong:
        raise MetricError(f"{name}: " + "; ".join(wrong))
    return spec, groups, {k: [READERS[FILTERS[k].kind](v) for v in listed(filters[k])] for k in filters}


def metric(
    tables: Mapping[str, DataFrame],
    name: str,
    dimensions: Sequence[str] | None = None,
    filters: Mapping[str, Any] | None = None,
    time_grain: str | None = None,
    cap: int | None = None,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per group, ordered by the group columns. ``cap`` keeps the first rows only; `capped` tells whether it cut."""
    spec, groups, wanted = resolve(name, dimensions, filters, time_grain)
    base = tables[spec.base]
    if spec.base_filter is not None:
        base = base.where(spec.base_filter())
    for key, values in wanted.items():
        dim = FILTERS[key].dimension
        if dim.table is None:
            base = base.where(F.col(dim.column).isin(*values))

    # Dimension tables this request needs, each with the columns it needs.
    used = [DIMENSIONS[d] for d in [*groups, *spec.required]] + [FILTERS[k].dimension for k in wanted]
    lookups: dict[tuple[str, str], set[str]] = {}
    for dim in used:
        if dim.table is not None:
            lookups.setdefault((dim.table, dim.key), set()).add(dim.column)

    rows, large = base, []
    for (table, key), columns in sorted(lookups.items()):
        narrowing = [k for k in wanted if FILTERS[k].dimension.table == table]
        # Where the fact is stored by month, a filter on the calendar also joins on the month, which prunes folders.
        by_month = bool(narrowing) and table in MONTHS and PART in base.columns
        month = [MONTHS[table]().alias("_month")] if by_month else []
        side = tables[table].select(F.col(key).alias(f"_{key}"), *sorted(columns), *month)
        for k in narrowing:
            side = side.where(F.col(FILTERS[k].dimension.column).isin(*wanted[k]))
        # A filter on a dimension drops unmatched rows, which an inner join does sooner.
        how = "inner" if narrowing else "left"
        if rows_within(side, max_broadcast_rows):
            match = F.col(key) == F.col(f"_{key}")
            rows = rows.join(F.broadcast(side), match & (F.col(PART) == F.col("_month")) if by_month else match, how)
        else:
            large.append((key, side.drop("_month"), how))

    if large:
        # Too large to broadcast: shrink the fact to one row per key combination.
        own = [DIMENSIONS[d].column for d in groups if DIMENSIONS[d].table is None]
        joined = [c for (_, key), cols in lookups.items() if key not in {k for k, _, _ in large} for c in cols]
        keys = sorted({*own, *joined, *(key for key, _, _ in large), *([spec.distinct] if spec.distinct else [])})
        rows = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in spec.sums]) if spec.sums else rows.select(*keys).distinct()
        for key, side, how in large:
            # Hot keys are looked for in the stored fact: in the rows, the fact would be summed once more for it.
            rows = salted_join(rows, side, key, f"_{key}", keys, how=how, base=base)

    out = rows.groupBy(*[F.col(DIMENSIONS[d].column).alias(d) for d in groups]).agg(spec.value().alias(name))
    if groups:
        out = out.orderBy(*groups)
    return out if cap is None else out.limit(cap)


def capped(result: DataFrame, cap: int) -> tuple[DataFrame, bool]:
    """The first ``cap`` rows and whether there are more. The result runs once: it stops one row past the cap, and
    these few rows pass through the driver."""
    first = result.limit(cap + 1).collect()
    return result.sparkSession.createDataFrame(first[:cap], result.schema), len(first) > cap
