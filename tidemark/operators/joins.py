"""Joins (JON-1..5). Strategy is left to Catalyst and AQE except where a side
has one row per file: adaptive execution broadcasts a side whose measured size
is below the session's threshold; otherwise both sides shuffle on the keys and
its skew-join split handles hot keys on the fact side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col_
from .aggregates import Order, one_per_key


def enrich(fact: DataFrame, attrs: DataFrame, keys: Sequence[str],
           order: Order | None = None) -> DataFrame:
    """JON-1: left join of attributes after reducing them to one row per key
    (deterministic pick, AGG-6), so the join never multiplies fact rows."""
    return fact.join(one_per_key(attrs, keys, order), list(keys), "left")


def attach_dictionary(fact: DataFrame, dictionary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JON-2: left join of a distinct dictionary. Adaptive execution broadcasts
    the dictionary when its measured size is below the session's threshold."""
    return fact.join(dictionary.distinct(), list(keys), "left")


def attach_labels(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  null_safe: bool = False) -> DataFrame:
    """JON-3: left join on ``keys``. ``null_safe=True`` matches null keys to
    each other, as a pandas merge does."""
    keys = list(keys)
    if not null_safe:
        return left.join(right, keys, "left")
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, "left").drop(*[f"__r_{k}" for k in keys])


def not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JON-4 / INC-1: rows of ``df`` whose keys do not occur in ``other``."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def only_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JON-4: rows of ``df`` whose keys occur in ``other`` (no duplication)."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def remap(df: DataFrame, column: str, mapping: Mapping[str, str] | DataFrame,
          from_col: str = "from", to_col: str = "to") -> DataFrame:
    """JON-5: replace values found in ``mapping``; others stay. One pass:
    a replaced value is not looked up again.

    A Python dict becomes a literal map (fixed, small); a DataFrame mapping
    is reduced to one row per key and joined (adaptive execution picks the
    join from its measured size)."""
    if isinstance(mapping, DataFrame):
        m = one_per_key(mapping.select(F.col(from_col).alias("__from"), F.col(to_col).alias("__to")),
                        ["__from"])
        j = df.join(m, F.col(column) == F.col("__from"), "left")
        return j.withColumn(column, F.coalesce(F.col("__to"), F.col(column))).drop("__from", "__to")
    if not mapping:
        return df
    lit_map = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(column, remap_col(column, lit_map))


def remap_col(c: str | Column, lit_map: Column) -> Column:
    """Column form of JON-5 over a literal map."""
    c = col_(c)
    return F.coalesce(lit_map[c], c)
