"""Enrollment-family tables: compositions of the operators,
no logic of their own. Every function reads a landing folder, keeps only
files not yet in the target (INC-1/2), and replaces their slices (SNK-1/2).
``load_date`` is an argument so reruns are reproducible."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import base_name, compact_date, parent_name, stem, year_month_suffix, year_range
from ..functions.names import normalize_name, normalize_name_col
from ..functions.scalars import date_prefix, parse_int, parse_int_commas, parse_number, parse_us_date, zfill
from ..operators import filters as flt
from ..operators import incremental as inc
from ..operators import joins as jn
from ..operators import projections as prj
from ..session import cut_lineage
from ..sinks import tables as snk
from ..sources import files as src


def _loaded(spark: SparkSession, target: str, key: str) -> DataFrame | None:
    """Keys of the loaded slices, from the target's partition listing."""
    return snk.loaded_slices(spark, target, key) if snk.path_exists(spark, target) else None


def _new_files(spark: SparkSession, root: str, pattern: str, target: str, key: str, key_col) -> DataFrame:
    files = src.list_files(spark, root, pattern).withColumn(key, key_col)
    return inc.unprocessed(files.filter(F.col(key).isNotNull()), _loaded(spark, target, key), key)


def _paths(files: DataFrame) -> list[str]:
    """The new files' paths: what the reader must be told, one per file."""
    return [r[0] for r in files.select("path").toLocalIterator()]


def cpsc_enrollment(spark: SparkSession, root: str, target: str, load_date: _dt.date) -> int:
    """cpsc_enrollment: INC-2, SRC-1, PRJ-1, FLT-1, SCL-7, PTH-1/2, SNK-2, SNK-4."""
    new = _new_files(spark, root, "CPSC_Enrollment_*.csv", target, "src_file_date",
                     year_month_suffix(stem("name")).cast("string"))
    paths = _paths(new)
    if not paths:
        return 0
    df = prj.normalize_headers(src.read_csv_text(spark, paths))
    df = flt.drop_sentinel(df, "enrollment", "*").withColumn("enrollment", parse_int("enrollment"))
    name = base_name(F.col(src.FILE_PATH))
    df = prj.with_lineage(df, file_date=year_month_suffix(stem(name)), load_date=load_date, file_name=name).drop(src.FILE_PATH)
    df = flt.require(df, ["enrollment"])
    snk.replace_slice(df, target, "src_file_date")
    return len(paths)


def cpsc_contract(spark: SparkSession, root: str, target: str, load_date: _dt.date) -> int:
    """cpsc_contract: INC-2, SRC-1, PRJ-1, SCL-9, PTH-1/2, SNK-2, SNK-4."""
    new = _new_files(spark, root, "CPSC_Contract_*.csv", target, "src_file_date",
                     year_month_suffix(stem("name")).cast("string"))
    paths = _paths(new)
    if not paths:
        return 0
    df = prj.normalize_headers(src.read_csv_text(spark, paths))
    df = df.withColumn("contract_effective_date", date_prefix("contract_effective_date"))
    name = base_name(F.col(src.FILE_PATH))
    df = prj.with_lineage(df, file_date=year_month_suffix(stem(name)), load_date=load_date, file_name=name).drop(src.FILE_PATH)
    snk.replace_slice(df, target, "src_file_date")
    return len(paths)


def cpsc_combined(spark: SparkSession, enrollment: str, contract: str, target: str, everything: bool = False) -> int:
    """cpsc_combined: FLT-2, AGG-6, JON-1, SNK-3, INC-2. One row per enrollment
    record; the contract side is reduced to one row per key first.

    The join is by snapshot date, so a date of the result follows from that
    date's slices of the two tables alone. Their fingerprints (the names, sizes
    and times of their files, from the listing) are kept beside the target;
    only dates whose fingerprint changed are joined again and only their
    slices written. Dates that are gone are removed. ``everything`` rebuilds
    the table. Returns the number of dates written or removed.

    The fingerprints are stored last: if a run breaks off, the next one joins
    the same dates again."""
    key = "src_file_date"
    now = snk.slice_fingerprints(spark, [enrollment, contract], key)
    kept = snk.read_note(spark, target, _SOURCES)
    if everything or kept is None or not snk.path_exists(spark, target):
        snk.replace_table(_combined(spark, enrollment, contract), target, partition_by=[key])
        snk.write_note(spark, target, _SOURCES, now)
        return len(now)
    changed = [d for d, mark in now.items() if kept.get(d) != mark]
    gone = [d for d in kept if d not in now]
    if changed:
        out = cut_lineage(_combined(spark, enrollment, contract, changed), spark, "combined")
        snk.replace_slice(out, target, key)
        written = {r[0] for r in out.select(key).distinct().collect()}
        gone += [d for d in changed if d not in written]  # slices that have become empty
    for d in gone:
        snk.remove_slice(spark, target, key, d)
    snk.write_note(spark, target, _SOURCES, now)
    return len({*changed, *gone})


#: Where the fingerprints of the joined slices are kept, beside the target.
_SOURCES = "_joined_slices.json"


def _combined(spark: SparkSession, enrollment: str, contract: str, dates: list[str] | None = None) -> DataFrame:
    keys = ["contract_id", "plan_id", "src_file_date"]
    e = snk.read_table(spark, enrollment).withColumnRenamed("contract_number", "contract_id")
    c = snk.read_table(spark, contract)
    if dates is not None:  # partition values: the scans list their folders alone
        e, c = e.where(F.col("src_file_date").isin(dates)), c.where(F.col("src_file_date").isin(dates))
    e = flt.require(e, ["enrollment"])
    c = flt.require(c, ["contract_id", "plan_id"]).drop("src_file_name", "load_date")
    return jn.enrich(e, c, keys)


def mapd_plan_directory(spark: SparkSession, root: str, target: str, load_date: _dt.date) -> int:
    """mapd_plan_directory: INC-1, SRC-1, PRJ-1/3, SCL-2, SCL-10, PTH-1/2, SNK-1."""
    new = _new_files(spark, root, "*.csv", target, "src_file_name", F.col("name"))
    paths = _paths(new)
    if not paths:
        return 0
    df = prj.normalize_headers(src.read_csv_text(spark, paths))
    df = prj.rename(df, {"legal_entity_st2": "legal_entity_street2"})
    df = df.withColumns({"enrollment": parse_int_commas("enrollment"),
                         "contract_effective_date": parse_us_date("contract_effective_date"),
                         "directory_contact_last_update": parse_us_date("directory_contact_last_update")})
    name = base_name(F.col(src.FILE_PATH))
    df = prj.with_lineage(df, file_date=year_month_suffix(stem(name)), load_date=load_date, file_name=name).drop(src.FILE_PATH)
    snk.replace_slice(df, target, "src_file_name")
    return len(paths)


def grandparent_name(path_col: str):
    """Name of the folder two levels above a file."""
    return F.regexp_extract(F.col(path_col), r"([^/]*)/[^/]*/[^/]*$", 1)


def plan_crosswalk(spark: SparkSession, root: str, target: str, load_date: _dt.date) -> int:
    """plan_crosswalk: INC-1, SRC-7 (sheet 0), PRJ-1/3, SCL-8, PTH-7, PTH-12,
    SNK-1. A workbook lands as ``<folder ending in YYYY>/<workbook>/0__<sheet>.csv``
    (``<workbook>`` = ``PlanCrosswalk2024_01022024.xlsx``)."""
    sheets = src.read_sheets(spark, root, 0)
    sheets = sheets.withColumn("src_file_name", F.col("workbook"))
    sheets = inc.unprocessed(sheets, _loaded(spark, target, "src_file_name"), "src_file_name")
    meta = {src.FILE_PATH, "workbook", "sheet_index", "sheet_name", "src_file_name"}
    df = sheets.toDF(*[c if c in meta else normalize_name(c) for c in sheets.columns])
    df = prj.rename(df, {"description": "status"})
    start, end = year_range(F.substring(grandparent_name(src.FILE_PATH), -4, 4))
    df = df.withColumns({"current_plan_id": zfill("current_plan_id", 3),
                         "previous_plan_id": zfill("previous_plan_id", 3),
                         "performance_date_start": start, "performance_date_end": end})
    df = prj.with_lineage(df, file_date=compact_date(stem(F.col("src_file_name"))),
                          load_date=load_date, file_name=F.col("src_file_name"))
    df = df.drop(src.FILE_PATH, "workbook", "sheet_index", "sheet_name")
    if df.isEmpty():
        return 0
    snk.replace_slice(df, target, "src_file_name")
    return 1


def snpdata(spark: SparkSession, root: str, target: str, load_date: _dt.date, width: int | None = None) -> int:
    """snpdata: INC-5, INC-1, SRC-5, SRC-4 (header row found per file),
    PRJ-1/3/5, SCL-3, PTH-2, SNK-1, SNK-4. Files land as
    ``<..._YYYY_MM>/<name>.csv``; ``Raw*`` files are excluded; in the
    ``2023_10`` folder the header is one row lower and names the column
    ``Enrollment``. Files of several layouts load together by their names."""
    files = inc.exclude_files(src.list_files(spark, root, "*.csv"), prefixes=["Raw"])
    files = files.withColumn("src_file_name", F.concat(F.col("parent"), F.lit("/"), F.col("name")))
    files = inc.unprocessed(files, _loaded(spark, target, "src_file_name"), "src_file_name")
    paths = _paths(files)
    if not paths:
        return 0
    m = src.read_matrix(spark, paths, width, stage=True)
    folder = parent_name(F.col(src.FILE_PATH))
    hdr = src.detect_header(m, "Contract Number")
    hdr = hdr.withColumn("header_row", F.col("header_row")
                         + F.when(F.substring(folder, -7, 7) == "2023_10", 1).otherwise(0))

    def names(header):
        def known(x):
            n = normalize_name_col(x)
            return F.when(n == "enrollment", F.lit("plan_enrollment")).otherwise(n)
        return F.transform(src.report_names(header), known)

    df = src.by_header(m.join(hdr, src.FILE_PATH), "header_row", names).drop("row_idx")
    df = prj.drop_unnamed(df).withColumn("plan_enrollment", parse_number("plan_enrollment"))
    df = prj.rename(df, {"plan_geographic_name": "geographic_name"})
    name = F.concat(folder, F.lit("/"), base_name(F.col(src.FILE_PATH)))
    df = prj.with_lineage(df, file_date=year_month_suffix(folder), load_date=load_date, file_name=name)
    snk.replace_slice(df.drop(src.FILE_PATH), target, "src_file_name")
    return len(paths)
