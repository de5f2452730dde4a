"""Row filters (FLT-1..9). Plain predicates, so Catalyst pushes them into
the scan (``PushedFilters``) wherever the source supports it."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col_


def drop_sentinel(df: DataFrame, column: str, sentinel: str = "*") -> DataFrame:
    """FLT-1: drop rows whose value is the sentinel. SQL ``!=`` is null on a
    null value, so null rows go too (the source then required non-null)."""
    return df.filter(F.col(column) != sentinel)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """FLT-2: keep rows where every key column is non-null."""
    return df.dropna(subset=list(columns))


def drop_totals(df: DataFrame, column: str, label: str = "Totals") -> DataFrame:
    """FLT-3: drop the totals row; null labels stay (pandas ``!=`` meaning)."""
    return df.filter(~F.col(column).eqNullSafe(label))


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """FLT-4: drop rows in which every column is null."""
    return df.dropna(how="all")


def route_by_category(df: DataFrame, column: str,
                      routes: Mapping[str, Iterable[str]]) -> dict[str, DataFrame]:
    """FLT-5: one source split into several targets by category values."""
    return {name: df.filter(F.col(column).isin(*list(vals))) for name, vals in routes.items()}


def rows_matching(df: DataFrame, column: str, pattern: str = r"(\d+)\s?star",
                  lower: bool = True) -> DataFrame:
    """FLT-6: keep rows whose (lower-cased) text matches the regex."""
    c = F.col(column)
    return df.filter((F.lower(c) if lower else c).rlike(pattern))


def for_year(df: DataFrame, column: str, year: int) -> DataFrame:
    """FLT-7: rows dated within ``year``, written as a range on the raw column
    so that Parquet statistics and partition pruning still apply."""
    lo = _dt.date(year, 1, 1)
    hi = _dt.date(year + 1, 1, 1)
    c = F.col(column)
    return df.filter((c >= F.lit(lo)) & (c < F.lit(hi)))


def value_equals(df: DataFrame, column: str, value) -> DataFrame:
    """FLT-8: metadata lookup by one value."""
    return df.filter(F.col(column) == F.lit(value))


def drop_empty_cells(df: DataFrame, name: str | Column, value: str | Column) -> DataFrame:
    """FLT-9: skip cells with a null or empty measure name or a null value."""
    n, v = col_(name), col_(value)
    return df.filter(n.isNotNull() & (n != "") & v.isNotNull())
