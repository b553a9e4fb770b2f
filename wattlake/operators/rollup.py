"""Grouped measures whose distinct counts do not multiply the input.

Spark plans several ``count(DISTINCT ...)`` over raw rows by expanding every row once per
distinct column.  ``rollup`` groups first by the keys plus the counted columns (a map-side
combine down to, say, one row per transformer), keeping sums and counts, and combines
those few rows in a second step where the distinct counts are cheap.  A key holding a
third of all rows costs each map task only one partial row.

Totals and means of doubles are exact (``functions.exact``): one partition and a thousand, one
step and two, give the same digits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.exact import exact_avg, exact_parts, exact_sum, merged

EXACT = ("thousandths", "rest", "beyond")


@dataclass(frozen=True)
class Measure:
    alias: str
    kind: str
    value: Column | str
    condition: Column | None = None
    otherwise: str | None = None


def avg(alias: str, value: Column | str) -> Measure:
    return Measure(alias, "avg", value)


def total(alias: str, value: Column | str) -> Measure:
    return Measure(alias, "sum", value)


def peak(alias: str, value: Column | str) -> Measure:
    return Measure(alias, "max", value)


def low(alias: str, value: Column | str) -> Measure:
    return Measure(alias, "min", value)


def rows(alias: str) -> Measure:
    return Measure(alias, "count", F.lit(1))


def rows_where(alias: str, condition: Column) -> Measure:
    return Measure(alias, "count", F.when(condition, 1))


def distinct(alias: str, column: str) -> Measure:
    return Measure(alias, "distinct", column)


def distinct_where(alias: str, column: str, condition: Column) -> Measure:
    """Distinct values of ``column`` having at least one row that meets the condition."""
    return Measure(alias, "distinct", column, condition)


def most_frequent(alias: str, column: str, condition: Column, otherwise: str) -> Measure:
    """Most frequent value of ``column`` among rows meeting the condition; ties go to the first value.

    The column must also be counted with ``distinct`` so that it is part of the inner keys.
    """
    return Measure(alias, "mode", column, condition, otherwise)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _doubles(df: DataFrame, measures: list[Measure]) -> set[str]:
    """Aliases of the totals and means over doubles, which are added exactly."""
    added = [m for m in measures if m.kind in ("sum", "avg")]
    types = df.select(*[_column(m.value).alias(m.alias) for m in added]).dtypes if added else []
    return {name for name, kind in types if kind in ("double", "float")}


def _direct(m: Measure, exact: bool) -> Column:
    if exact:
        return (exact_sum if m.kind == "sum" else exact_avg)(_column(m.value))
    fn = {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min, "count": F.count}[m.kind]
    return fn(_column(m.value))


def _group(df: DataFrame, keys: list[str]):
    return df.groupBy(*keys) if keys else df.groupBy()


def _counted(measures: list[Measure]) -> list[str]:
    return list(dict.fromkeys(m.value for m in measures if m.kind == "distinct"))


def _inner_keys(keys: list[str], measures: list[Measure]) -> list[str]:
    return keys + [c for c in _counted(measures) if c not in keys]


def _parts(m: Measure, exact: bool) -> dict[str, tuple[Column, str]]:
    """Partial columns of a measure over raw rows, and how each of them merges."""
    p = f"_{m.alias}"
    count = {f"{p}_n": (F.count(_column(m.value)), "sum")} if m.kind == "avg" else {}
    if exact:
        return {f"{p}_{part}": (expr, "sum") for part, expr in exact_parts(_column(m.value)).items()} | count
    if m.kind == "avg":
        return {p: (F.sum(_column(m.value)), "sum")} | count
    if m.kind == "distinct":
        return {} if m.condition is None else {p: (F.max(F.when(m.condition, 1)), "max")}
    if m.kind == "mode":
        return {p: (F.count(F.when(m.condition, 1)), "sum")}
    if m.kind == "count":
        return {p: (F.count(_column(m.value)), "sum")}
    return {p: (_direct(m, False), m.kind)}


def _final(m: Measure, exact: bool) -> Column:
    """The measure from partial rows that are unique per keys and counted columns."""
    p = f"_{m.alias}"
    if exact or m.kind == "avg":
        summed = merged(*[F.sum(f"{p}_{part}") for part in EXACT]) if exact else F.sum(p).cast("double")
        return F.try_divide(summed, F.sum(f"{p}_n")) if m.kind == "avg" else summed
    if m.kind == "distinct":
        return F.count_distinct(F.col(m.value) if m.condition is None else F.when(F.col(p) == 1, F.col(m.value)))
    if m.kind == "mode":
        best = F.min(F.when(F.col(p) > 0, F.struct((-F.col(p)).alias("rank"), F.col(m.value).alias("value"))))
        return F.coalesce(best["value"], F.lit(m.otherwise))
    if m.kind == "count":
        return F.coalesce(F.sum(p), F.lit(0))
    return {"sum": F.sum, "max": F.max, "min": F.min}[m.kind](p)


def partials(df: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """Mergeable partial results of raw rows per key combination."""
    exact = _doubles(df, measures)
    columns = {name: expr for m in measures for name, (expr, _) in _parts(m, m.alias in exact).items()}
    return _group(df, keys).agg(*[e.alias(n) for n, e in columns.items()] or [F.count(F.lit(1)).alias("_rows")])


def combine(parts: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """Final measures from partial rows, which may be finer than the keys."""
    inner = _inner_keys(keys, measures)
    exact = {m.alias for m in measures if f"_{m.alias}_{EXACT[0]}" in parts.columns}
    how = {"sum": F.sum, "max": F.max, "min": F.min}
    merges = {name: how[kind](name) for m in measures for name, (_, kind) in _parts(m, m.alias in exact).items()}
    if merges and inner != keys:
        parts = _group(parts, inner).agg(*[e.alias(n) for n, e in merges.items()])
    return combine_unique(parts, keys, measures)


def rollup(df: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """One row per key combination with the measures in the order given."""
    if not _counted(measures):
        exact = _doubles(df, measures)
        return _group(df, keys).agg(*[_direct(m, m.alias in exact).alias(m.alias) for m in measures])
    return combine_unique(partials(df, _inner_keys(keys, measures), measures), keys, measures)


def combine_unique(parts: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """``combine`` for partial rows already unique per keys and counted columns."""
    exact = {m.alias for m in measures if f"_{m.alias}_{EXACT[0]}" in parts.columns}
    return _group(parts, keys).agg(*[_final(m, m.alias in exact).alias(m.alias) for m in measures])
