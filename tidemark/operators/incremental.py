"""Incremental file selection (INC-1..6) over file listings held as
DataFrames (see ``sources.files.list_files``). A listing of millions of
files is filtered, anti-joined and ranked on the executors."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col_
from .aggregates import one_per_key


def unprocessed(files: DataFrame, loaded: DataFrame | None, key: str,
                loaded_key: str | None = None) -> DataFrame:
    """INC-1 / INC-2: files whose key (file name or snapshot date) is not yet
    in the target. A missing target (first load) means every file is new."""
    if loaded is None:
        return files
    lk = loaded_key or key
    done = loaded.select(F.col(lk).alias(key)).distinct()
    return files.join(done, [key], "left_anti")


def latest_per_snapshot(files: DataFrame, snapshot: str, mtime: str = "modificationTime",
                        path: str = "path") -> DataFrame:
    """INC-3: the newest file (by modification time, then path) for each
    snapshot date; files without a snapshot date are dropped."""
    f = files.filter(F.col(snapshot).isNotNull())
    return one_per_key(f, [snapshot], [(mtime, "desc"), (path, "asc")])


def since(files: DataFrame, column: str, threshold) -> DataFrame:
    """INC-4: snapshot date at or after ``threshold``."""
    return files.filter(F.col(column) >= F.lit(threshold))


def exclude_files(files: DataFrame, name: str | Column = "name",
                  prefixes: Iterable[str] = (), folder: str | Column | None = None,
                  deny_folders: Iterable[str] = (), year: str | Column | None = None,
                  min_year: int | None = None) -> DataFrame:
    """INC-5: drop files by name prefix (hidden ``.`` files, ``Raw*``), by a
    folder deny-list and below a year floor."""
    cond = F.lit(True)
    n = col_(name)
    for p in prefixes:
        cond = cond & ~F.coalesce(n.startswith(p), F.lit(False))
    deny = list(deny_folders)
    if folder is not None and deny:
        cond = cond & ~F.coalesce(col_(folder).isin(*deny), F.lit(False))
    if year is not None and min_year is not None:
        cond = cond & (col_(year) >= min_year)
    return files.filter(cond)


def pair_files(files: DataFrame, group: str, kind_prefixes: Mapping[str, str],
               name: str = "name", path: str = "path", strict: bool = True) -> DataFrame:
    """INC-6: per group (a year), the path of each kind of file, chosen by name
    prefix (``HEDIS`` data, ``MADictionary`` dictionary). With ``strict`` a
    group missing a partner fails the job instead of being loaded half."""
    n = F.col(name)
    aggs = [F.max(F.when(n.startswith(prefix), F.col(path))).alias(kind)
            for kind, prefix in kind_prefixes.items()]
    out = files.groupBy(group).agg(*aggs)
    if strict:
        missing = None
        for kind in kind_prefixes:
            m = F.col(kind).isNull()
            missing = m if missing is None else missing | m
        out = out.withColumn(
            "_check", F.when(missing, F.raise_error(F.concat(F.lit("file without partner in group "),
                                                              F.col(group).cast("string")))))
        # filtering on the check column forces its evaluation
        out = out.filter(F.col("_check").isNull()).drop("_check")
    return out
