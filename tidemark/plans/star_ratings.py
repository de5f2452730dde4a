"""Star-rating tables: measure values and stars (RSH-2),
display measures (RSH-3), cut points (RSH-4) and overall summaries. All
files of a family are read by one scan; per-file differences (layout,
encoding, offset, part type, dates) are columns, not driver loops."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import (
    base_name,
    classify_name,
    paren_text_date,
    parenthesised_date,
    path_year,
    stem,
    underscore_date,
)
from ..functions.names import normalize_name, normalize_name_col
from ..functions.scalars import parse_number
from ..operators import projections as prj
from ..operators.aggregates import union_by_name
from ..operators.reshape import cutpoints_to_long, display_matrix_to_long, matrix_to_long
from ..sinks import tables as snk
from ..sources import files as src

MEASURE_OUTPUT = ("contract_id", "organization_type", "contract_name", "organization_marketing_name",
                  "parent_organization", "measure_code", "measure_desc", "measure_start", "measure_end",
                  "measure_value_raw", "measure_value")


def _year_folder(path_col: str = src.FILE_PATH):
    """Performance year: leading 4 digits of the first folder under the
    landing root that starts with a year (``.../2024 Star Ratings/...``)."""
    return F.regexp_extract(F.col(path_col), r"/(\d{4})[^/]*/", 1).cast("int")


def _required_date(d, name):
    return F.coalesce(d, F.raise_error(F.concat(F.lit("no file date in "), name)).cast("date"))


def measure_file_date(name):
    """File date of a measure data / stars file: ``(... date)`` in the name,
    or ``YYYY_MM_DD`` before a ``_data`` / ``_stars`` suffix; required."""
    return _required_date(F.coalesce(paren_text_date(name), underscore_date(stem(name))), name)


# Which files make a table, and folders of other layouts.
MEASURE_PATTERNS = ("*Master[_ ]Table*data.csv", "*Measure Data*.csv")
MASTER_TABLES = r"Master[_ ]Table.*data\.csv$"
MASTER_DENY_FOLDERS = (
    "2007_plan_ratings", "2008_plan_ratings", "2009_plan_ratings", "2010_plan_ratings_and_display_measures",
    "2011_plan_ratings_and_display_measures", "2012_plan_ratings_and_display_measures", "2013_plan_ratings_and_display_measures",
)
DISPLAY_PATTERNS = ("*Display_Measure*.csv", "*HEDIS*.csv")
DISPLAY_AFTER = "2013"


def _paths(spark: SparkSession, root: str, patterns: Sequence[str], exclude: Sequence[str] = (), deny_folders: Sequence[str] = (),
           denied: str = "", after: str | None = None) -> list[str]:
    """Files by name pattern, but for those whose name holds a word of
    ``exclude``, those that lie anywhere below a folder of ``deny_folders``
    (only names like ``denied``, if given), and those whose name does not
    begin with a year ``after`` the given one."""
    listings = [src.list_files(spark, root, p) for p in patterns]
    files = union_by_name(listings).dropDuplicates(["path"])
    for word in exclude:
        files = files.filter(~F.col("name").contains(word))
    if deny_folders:
        below = F.arrays_overlap(F.split("path", "/"), F.array(*[F.lit(d) for d in deny_folders]))
        files = files.filter(~(below & F.col("name").rlike(denied)))
    if after is not None:
        files = files.filter(F.substring("name", 1, 4) > after)
    rows = files.select("path").collect()  # what the reader must be told, one per file
    return [r[0] for r in rows]


def measure_values(spark: SparkSession, root: str, patterns: Sequence[str], load_date: _dt.date,
                   exclude: Sequence[str] = (), width: int | None = None, encoding: str = "ISO-8859-1",
                   deny_folders: Sequence[str] = (), denied: str = "") -> DataFrame:
    """starrating_measure_value / _star: every matching file through
    read_matrix + matrix_to_long, with performance year and file date.
    Of the values, ``MEASURE_PATTERNS`` without the master tables
    (``denied=MASTER_TABLES``) of the ``MASTER_DENY_FOLDERS``."""
    paths = _paths(spark, root, patterns, exclude, deny_folders, denied)
    m = src.read_matrix(spark, paths, width, encoding, stage=True, files=True)
    name = base_name(F.col(src.FILE_PATH))
    long = matrix_to_long(m, file_columns={"performance_year": _year_folder(),
                                           "src_file_date": measure_file_date(name), "src_file_name": name})
    out = long.select(*MEASURE_OUTPUT, "performance_year", "src_file_date", "src_file_name")
    return out.withColumn("load_date", F.lit(load_date))


def display_measures(spark: SparkSession, root: str, load_date: _dt.date, pattern: str | None = None,
                     width: int | None = None, encoding: str = "ISO-8859-1") -> DataFrame:
    """starrating_display_hedis_measure: the files of ``DISPLAY_PATTERNS``
    whose name begins with a year after ``DISPLAY_AFTER`` (or those of
    ``pattern``); offset 0 for files whose stem holds ``HEDIS``, 1 otherwise;
    file date from the trailing ``YYYY_MM_DD``."""
    paths = _paths(spark, root, [pattern]) if pattern else _paths(spark, root, DISPLAY_PATTERNS, after=DISPLAY_AFTER)
    m = src.read_matrix(spark, paths, width, encoding, stage=True, files=True)
    name = base_name(F.col(src.FILE_PATH))
    offset = F.when(stem(name).contains("HEDIS"), 0).otherwise(1)
    long = display_matrix_to_long(m, offset, file_columns={
        "performance_year": _year_folder(), "src_file_date": _required_date(underscore_date(stem(name)), name), "src_file_name": name})
    return long.select("contract_id", "contract_name", "organization_marketing_name", "parent_organization",
                       "measure_code", "measure_desc", "measure_value_raw", "measure_value",
                       "performance_year", "src_file_date", "src_file_name", F.lit(load_date).alias("load_date"))


def cutpoints(spark: SparkSession, root: str, load_date: _dt.date, width: int | None = None) -> DataFrame:
    """star_ratings_cutpoints: files named ``*Cut Points*`` or ``*Cutpoints*``;
    encoding chosen per file (SRC-6); part type, year and generation date
    from the name (PTH-8/10/11); an unknown part type fails the job."""
    paths = _paths(spark, root, ["*Cut Points*.csv", "*Cut_Points*.csv", "*Cutpoints*.csv"])
    enc = src.decode_with_fallback(spark, paths).collect()
    groups: dict[str, list[str]] = {}
    for r in enc:
        groups.setdefault(r["encoding"], []).append(r["path"])
    parts = []
    for encoding, group in sorted(groups.items()):
        # (Spark's CSV reader already drops a UTF-8 byte-order mark)
        m = src.read_matrix(spark, group, width, encoding, stage=True, files=True)
        name = base_name(F.col(src.FILE_PATH))
        part = classify_name(name)
        part = F.when(part == "Unknown", F.raise_error(F.concat(F.lit("unknown cut-point format: "), name))
                      .cast("string")).otherwise(part)
        parts.append(cutpoints_to_long(m, part, file_columns={
            "performance_year": path_year(name), "src_file_date": parenthesised_date(name), "src_file_name": name}))
    long = union_by_name(parts)
    return long.select("performance_year", "part_type", "org_type", "measure_code",
                       "measure_name", "measure_period_start", "measure_period_end", "star",
                       "lower_bound", "upper_bound", "original_text", "src_file_date", "src_file_name",
                       F.lit(load_date).alias("load_date"))


SUMMARY_COLUMNS = ("contract_number", "organization_type", "contract_name", "organization_marketing_name",
                   "parent_organization", "snp", "part_c_summary", "part_d_summary", "overall_summary",
                   "part_c_summary_raw", "part_d_summary_raw", "overall_summary_raw",
                   "disaster_py_minus_2", "disaster_py_minus_3")


def overall_summary(spark: SparkSession, paths: Sequence[str], performance_year: int,
                    load_date: _dt.date, encoding: str = "ISO-8859-1") -> DataFrame:
    """starrating_overall_summary for the files of one performance year:
    one title row, then the header (SRC-3); headers renamed by substring
    rules relative to the year (PRJ-4); parsed values beside the raw text
    (PRJ-12); file date from ``(...)`` in the name."""
    df = src.read_with_preamble(spark, list(paths), 1, encoding=encoding)
    df = df.toDF(*[c if c in (src.FILE_PATH, "row_idx") else normalize_name(c) for c in df.columns])
    rules = [("part_c_summary", "part_c_summary_raw"), ("part_d_summary", "part_d_summary_raw"),
             ("overall", "overall_summary_raw"),
             (f"{performance_year - 2}_disaster", "disaster_py_minus_2"),
             (f"{performance_year - 3}_disaster", "disaster_py_minus_3")]
    df = prj.rename_matching(df, rules)
    df = df.withColumns({"part_c_summary": parse_number("part_c_summary_raw"),
                         "part_d_summary": parse_number("part_d_summary_raw"),
                         "overall_summary": parse_number("overall_summary_raw")})
    for c in SUMMARY_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    name = base_name(F.col(src.FILE_PATH))
    date = _required_date(paren_text_date(name), name)
    return df.select(*SUMMARY_COLUMNS, F.lit(performance_year).alias("performance_year"),
                     date.alias("src_file_date"), name.alias("src_file_name"), F.lit(load_date).alias("load_date"))


def overall_summaries(spark: SparkSession, root: str, load_date: _dt.date, encoding: str = "ISO-8859-1") -> DataFrame:
    """starrating_overall_summary from its folder: all ``*Summary Rating*``
    files of any year in one read. The year of a file is the first four
    characters of its name; its header is renamed relative to that year
    (PRJ-4) on the one header row a file, so the years load by name."""
    paths = _paths(spark, root, ["*Summary Rating*.csv"])
    year = F.substring(base_name(F.col(src.FILE_PATH)), 1, 4).cast("int")
    disaster = lambda back: F.concat((year - back).cast("string"), F.lit("_disaster"))

    def names(header):
        def renamed(x):
            n = normalize_name_col(x)
            return (F.when(n.contains("part_c_summary"), "part_c_summary_raw").when(n.contains("part_d_summary"), "part_d_summary_raw")
                    .when(n.contains("overall"), "overall_summary_raw").when(F.contains(n, disaster(2)), "disaster_py_minus_2")
                    .when(F.contains(n, disaster(3)), "disaster_py_minus_3").otherwise(n))
        return F.transform(src.report_names(header), renamed)

    df = src.by_header(src.read_matrix(spark, paths, None, encoding, stage=True), 1, names)
    missing = [c for c in SUMMARY_COLUMNS if c not in df.columns and c not in SUMMARY_PARSED]
    df = df.withColumns({c: F.lit(None).cast("string") for c in missing})
    df = df.withColumns({c: parse_number(f"{c}_raw") for c in SUMMARY_PARSED})
    name = base_name(F.col(src.FILE_PATH))
    return df.select(*SUMMARY_COLUMNS, year.alias("performance_year"), _required_date(paren_text_date(name), name).alias("src_file_date"),
                     name.alias("src_file_name"), F.lit(load_date).alias("load_date"))


SUMMARY_PARSED = ("part_c_summary", "part_d_summary", "overall_summary")


def write_full(df: DataFrame, target: str) -> None:
    """SNK-3: the star-rating tables are rebuilt whole."""
    snk.replace_table(df, target)
