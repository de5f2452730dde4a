"""Header and column operators (PRJ-1..12) and lineage (PTH-1).

Renames and drops are metadata-only projections: Catalyst folds them into
the scan, so column pruning still reaches the Parquet/CSV reader.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import camel_name, dedupe_names, normalize_name
from ..functions.scalars import parse_number
from ..functions.dates import base_name
from ..sources.files import FILE_PATH, metadata_name

LINEAGE_COLUMNS = ("src_file_date", "src_file_name", "load_date")


def normalize_headers(df: DataFrame, fn: Callable[[str], str] = normalize_name) -> DataFrame:
    """PRJ-1: every column name through ``fn`` (default: trim, no
    punctuation, lower case, ``_`` for whitespace)."""
    return df.toDF(*[fn(c) for c in df.columns])


def camel_headers(df: DataFrame) -> DataFrame:
    """PRJ-2: ``CMSContractNumber`` -> ``c_m_s_contract_number``."""
    return df.toDF(*[camel_name(c) for c in df.columns])


def dedupe_headers(df: DataFrame) -> DataFrame:
    """PRJ-11: repeated names get ``.1``, ``.2`` suffixes."""
    return df.toDF(*dedupe_names(df.columns))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ-3: rename aliases to canonical names; absent keys are ignored.
    Call once per pass when passes must apply in order."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def rename_matching(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """PRJ-4: the first rule whose substring occurs in a name renames it."""
    mapping = {}
    for c in df.columns:
        for needle, new in rules:
            if needle in c:
                mapping[c] = new
                break
    return rename(df, mapping)


def drop_unnamed(df: DataFrame, prefix: str = "unnamed") -> DataFrame:
    """PRJ-5: drop columns whose name starts with ``unnamed``."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def all_null_columns(df: DataFrame) -> list[str]:
    """Names of columns without a single non-null value: one aggregation
    job returning one count per column."""
    if not df.columns:
        return []
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if row[f"c{i}"] == 0]


def drop_all_null_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """PRJ-6: drop every column that is null in all rows."""
    keep = set(keep)
    return df.drop(*[c for c in all_null_columns(df) if c not in keep])


def conform_to(df: DataFrame, target: T.StructType,
               parsers: Mapping[str, Callable[[Column], Column]] | None = None
               ) -> tuple[DataFrame, list[str]]:
    """PRJ-7: keep the target's columns that exist in ``df`` (target order),
    parse text into the target type (``double`` via ``parse_number`` unless a
    parser is given) and report the target columns the source lacks."""
    parsers = dict(parsers or {})
    parsers.setdefault("double", parse_number)
    have = {c: t for c, t in df.dtypes}
    cols, missing = [], []
    for f in target.fields:
        if f.name not in have:
            missing.append(f.name)
            continue
        c = F.col(f"`{f.name}`")
        tname = f.dataType.simpleString()
        if have[f.name] == "string" and tname in parsers:
            c = parsers[tname](c)
        elif have[f.name] != tname:
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols), missing


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """PRJ-8: keep these columns in this order."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """PRJ-8: drop these columns (absent ones ignored)."""
    return df.drop(*names)


def swap_columns_if(df: DataFrame, a: str, b: str, threshold: float,
                    by: Sequence[str] = ("src_file_name",)) -> DataFrame:
    """PRJ-9: where the median of ``a`` within a group (one source file)
    exceeds ``threshold`` the two columns were exported in swapped order;
    swap them back for that group only.

    The test "median > threshold" is exact and skew-proof (``median_exceeds``:
    fixed-size partial aggregates, no group gathered in one task). The flags
    form one row per group and are joined back; adaptive execution broadcasts
    them when they are small and splits a hot group otherwise."""
    from .aggregates import median_exceeds
    flags = median_exceeds(df, list(by), a, threshold, "_swap")
    j = df.join(flags, list(by), "left")
    swap = F.coalesce(F.col("_swap"), F.lit(False))
    out = j.withColumns({a: F.when(swap, F.col(b)).otherwise(F.col(a)),
                         b: F.when(swap, F.col(a)).otherwise(F.col(b))})
    return out.select(*df.columns)


def cast_columns(df: DataFrame, fn: Callable[[Column], Column],
                 names: Iterable[str] = (), suffixes: Iterable[str] = ()) -> DataFrame:
    """PRJ-10: apply ``fn`` to the named columns and to every column whose
    name ends with one of ``suffixes``, in one projection."""
    names = set(names)
    suffixes = tuple(suffixes)
    todo = {c: fn(F.col(f"`{c}`")) for c in df.columns
            if c in names or (suffixes and c.endswith(suffixes))}
    return df.withColumns(todo) if todo else df


def keep_raw(df: DataFrame, column: str, fn: Callable[[Column], Column],
             raw_suffix: str = "_raw") -> DataFrame:
    """PRJ-12: parsed value in ``column``, the original text beside it."""
    raw = column + raw_suffix
    return df.withColumns({raw: F.col(column), column: fn(F.col(column))})


def with_lineage(df: DataFrame, file_date: Column | _dt.date | str | None = None,
                 load_date: _dt.date | str | None = None,
                 file_name: Column | str | None = None) -> DataFrame:
    """PTH-1: ``src_file_date``, ``src_file_name``, ``load_date``.

    ``file_name`` defaults to the name of the file each row was read from: of
    its ``src_file_path`` if the rows have one, else ``_metadata.file_name``
    (of rows straight from a file source). ``load_date`` is an
    argument so reruns are reproducible; it defaults to today."""
    def as_date(v):
        if isinstance(v, Column):
            return v
        if v is None:
            return F.lit(None).cast("date")
        return F.lit(str(v)).cast("date")

    name = (file_name if isinstance(file_name, Column)
            else F.lit(file_name) if file_name is not None
            else base_name(F.col(FILE_PATH)) if FILE_PATH in df.columns
            else metadata_name())
    ld = as_date(load_date if load_date is not None else _dt.date.today())
    return df.withColumns({
        "src_file_date": as_date(file_date),
        "src_file_name": name,
        "load_date": ld,
    })
