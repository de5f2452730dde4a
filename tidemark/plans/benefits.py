"""Plan-benefit tables and documents: the data dictionary
(``pbp_metadata``), dictionary-typed benefit text files, Section A with
zoned submission times, plan areas, and the nested benefit documents.

Benefit files land as ``<folder>/<name>.txt`` where the folder is
``pbp-benefits-YYYY`` (annual) or ``pbp-benefits-YYYY-quarter-N``; the
newest file (by modification time) of each snapshot date wins (INC-3)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parent_name, quarter_start
from ..functions.names import normalize_name
from ..functions.scalars import parse_number_strict, parse_thousands, parse_zoned_timestamp
from ..operators import dictionary as D
from ..operators import incremental as inc
from ..operators import nested as N
from ..operators import projections as prj
from ..operators.aggregates import one_per_key
from ..session import cut_lineage
from ..sinks import tables as snk
from ..sources import files as src
from .benefit_categories import DEFAULT_CATEGORY_LABELS


def latest_files(spark: SparkSession, root: str, pattern: str, since: _dt.date | None = None) -> DataFrame:
    """INC-3/INC-4: newest file per snapshot date, snapshot date at or after
    ``since`` (the threshold is honoured, unlike the source's copy)."""
    files = src.list_files(spark, root, pattern).withColumn("src_file_date", quarter_start("parent"))
    files = inc.latest_per_snapshot(files, "src_file_date")
    return inc.since(files, "src_file_date", since) if since else files


def pbp_metadata(raw_sheets: DataFrame, load_date: _dt.date) -> DataFrame:
    """pbp_metadata: dictionary sheet rows (text, file order in ``row_idx``)
    to one row per described column with ``code_and_values`` (DIC-1)."""
    df = raw_sheets.toDF(*[c if c in (src.FILE_PATH, "row_idx") else normalize_name(c) for c in raw_sheets.columns])
    d = D.build_dictionary(df.drop(src.FILE_PATH), order="row_idx")
    return prj.drop_all_null_columns(prj.with_lineage(d, file_date=None, load_date=load_date, file_name="dictionary"))


def _name_of(path_col):
    return F.concat(F.regexp_extract(path_col, r"([^/]*)/[^/]*$", 1), F.lit("/"),
                    F.regexp_extract(path_col, r"([^/]*)$", 1))


def _file_name(df: DataFrame):
    """``folder/file`` of the file a row was read from."""
    return _name_of(F.col(src.FILE_PATH) if src.FILE_PATH in df.columns else src.metadata_path())


def _snapshots(spark: SparkSession, files: DataFrame) -> DataFrame | None:
    """The rows of all snapshot files, text by name (SRC-2, SET-1), with the
    path of each row's file: one read, however many files and layouts."""
    paths = [r["path"] for r in files.select("path").collect()]  # a reader must be told them
    return src.read_tsv_text(spark, paths) if paths else None


def snapshot_date():
    """The snapshot date of a row's file, from its folder (PTH-6)."""
    return quarter_start(parent_name(F.col(src.FILE_PATH)))


def _write_slices(df: DataFrame, target: str) -> int:
    """Replace the slice of every date that ``df`` holds, in one job; their
    number."""
    snk.replace_slice(df, target, "src_file_date")
    return df.select("src_file_date").distinct().count()


def dictionary_typed(spark: SparkSession, files: DataFrame, dictionary: DataFrame, file: str,
                     target: str, load_date: _dt.date) -> int:
    """The dictionary-driven benefit tables (DIC-5): all snapshot files of a
    table in one read, TSV Latin-1 with literal quotes (SRC-2), numeric
    columns by the dictionary (SCL-5), each row with the date and name of its
    file, all-null columns dropped (PRJ-6), the date slices replaced together
    (SNK-2). A file without rows leaves its slice as it is. The number of jobs
    does not depend on the number of files."""
    text = _snapshots(spark, files)
    if text is None:
        return 0
    out = D.load_by_dictionary(text, dictionary, file, file_date=snapshot_date(), file_name=_file_name(text),
                               load_date=load_date, stage=True)
    return _write_slices(out.drop(src.FILE_PATH), target) if out is not None else 0


# The dictionary-driven benefit tables, by file name.
BENEFIT_TABLES = (
    "pbp_b15_partb_rx_drugs", "pbp_Section_D", "pbp_Section_D_opt", "pbp_b13i_b19b_services_vbid_ssbci",
    "pbp_b14c_b19b_preventive_vbid_uf", "pbp_b16_dental", "pbp_b16_b19b_dental_vbid_uf", "pbp_mrx", "pbp_mrx_vbid",
    "pbp_mrx_gapCoverage", "pbp_mrx_p", "pbp_mrx_p_vbid", "pbp_mrx_tier", "pbp_mrx_tier_vbid", "pbp_b10_amb_trans",
    "pbp_b17_eye_exams_wear", "pbp_b18_hearing_exams_aids", "pbp_b18_b19b_hearing_exams_aids_vbid_uf",
)
# Columns whose type the dictionary of some year gives wrongly.
TYPE_OVERRIDES = (("mrx_formulary_tiers_num", "CHAR", "NUM"),)
PLAN_AREA_FILES = ("PlanArea", "PlanRegionArea")


def load_benefit_table(spark: SparkSession, root: str, file: str, dictionary: DataFrame, target: str,
                       load_date: _dt.date, since: _dt.date | None = None) -> int:
    """One of ``BENEFIT_TABLES``, end to end: the newest file of each snapshot
    date under ``root`` (INC-3/4), the dictionary with its corrections
    (DIC-4), typed and written slice by slice (DIC-5, SNK-2)."""
    for name, wrong, right in TYPE_OVERRIDES:
        dictionary = D.override_types(dictionary, name, wrong, right)
    return dictionary_typed(spark, latest_files(spark, root, f"{file}.txt", since), dictionary, file, target, load_date)


def load_snapshots(spark: SparkSession, root: str, file: str, target: str, transform, since: _dt.date | None = None) -> int:
    """The newest file of each snapshot date, all read at once, given to
    ``transform(text, file_date)`` (Section A, plan areas; ``file_date`` is
    the column of each row's snapshot date), and written as their dates'
    slices (SNK-2)."""
    text = _snapshots(spark, latest_files(spark, root, f"{file}.txt", since))
    if text is None:
        return 0
    out = transform(text, snapshot_date())
    return _write_slices(cut_lineage(out, spark, "snapshots"), target)


def section_a(text: DataFrame, dictionary: DataFrame, file_date: _dt.date | Column, load_date: _dt.date,
              file: str = "pbp_Section_A") -> DataFrame:
    """pbp_section_a: headers normalised, numeric columns where any
    dictionary row says NUM (DIC-3, strict after comma removal), ``*_time``
    columns as zoned timestamps (SCL-11), ``pbp_a_snp_pct`` /
    ``pbp_a_contract_period`` strict numbers, last entry date as a
    timestamp; only columns the file has are touched."""
    df = prj.normalize_headers(text)
    numeric = [c for c in D.any_numeric_columns(dictionary, file) if c in df.columns]
    df = prj.cast_columns(df, parse_thousands, names=numeric)
    df = prj.cast_columns(df, parse_number_strict,
                          names=[c for c in ("pbp_a_contract_period", "pbp_a_snp_pct") if c in df.columns])
    df = prj.cast_columns(df, parse_zoned_timestamp, suffixes=("_time",))
    if "pbp_a_last_data_entry_date" in df.columns:
        df = df.withColumn("pbp_a_last_data_entry_date", F.to_timestamp("pbp_a_last_data_entry_date"))
    df = prj.with_lineage(df, file_date=file_date, load_date=load_date, file_name=_file_name(df))
    return prj.drop_all_null_columns(df.drop(src.FILE_PATH))


def plan_area(text: DataFrame, file_date: _dt.date | Column, load_date: _dt.date) -> DataFrame:
    """pbp_plan_area / pbp_plan_region_area: ``contract_year`` strict int."""
    df = text.withColumn("contract_year", F.col("contract_year").cast("int"))
    df = prj.with_lineage(df, file_date=file_date, load_date=load_date, file_name=_file_name(df))
    return prj.drop_all_null_columns(df.drop(src.FILE_PATH))


def category_labels(metadata: DataFrame, year: int,
                    defaults: Mapping[str, str] = DEFAULT_CATEGORY_LABELS,
                    title: str = "Opt Sup Deduct Cats") -> DataFrame:
    """NST-6: code -> label for benefit categories: the dictionary rows of
    ``year`` titled ``title`` (as a date range, FLT-7), split and merged over
    the fixed defaults."""
    rows = metadata.filter((F.col("src_file_date") >= F.lit(_dt.date(year, 1, 1)))
                           & (F.col("src_file_date") < F.lit(_dt.date(year + 1, 1, 1)))
                           & (F.col("title") == title))
    labels = N.labels_from_dictionary(rows.select("code_and_values"))
    return N.merge_labels(defaults, labels)


def benefit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """benefits documents: one row per plan (NST-1), parent year pushed down
    (NST-3), plan characteristics lifted (NST-2), category codes replaced at
    any depth (NST-4), empty fields removed (NST-5). Returns the plan keys
    beside the cleaned JSON document."""
    keep = ["contractYear"] + [src.FILE_PATH] * (src.FILE_PATH in docs.columns)
    plans = N.explode_children(docs, "pbp", keep=keep, alias="plan")
    plans = plans.select(*keep, "plan.*")
    if "planCharacteristics" in plans.columns:
        plans = N.lift_struct(plans, "planCharacteristics")
    plans = N.remap_field_deep(plans, "categoryCode", N.labels_map(labels))
    return _with_keys(plans)


def _with_keys(plans: DataFrame) -> DataFrame:
    pruned = N.prune_empty_deep(plans, json_column=None)
    doc = F.to_json(F.struct(*[F.col(f"`{c}`") for c in pruned.columns if c != src.FILE_PATH]))
    path = [src.FILE_PATH] * (src.FILE_PATH in pruned.columns)
    return pruned.select("contractId", "planId", "segmentId", "contractYear", doc.alias("document"), *path)


def export_documents(documents: DataFrame, target: str) -> None:
    """SNK-5/SNK-8: one document per plan key. Of several for one key the
    last in the order of source folders and files wins (Q20), and it replaces
    the stored one."""
    keys = ["contractId", "planId", "segmentId", "contractYear"]
    if src.FILE_PATH in documents.columns:
        documents = one_per_key(documents, keys, [(src.FILE_PATH, "desc"), ("document", "asc")]).drop(src.FILE_PATH)
    snk.upsert(documents, target, keys, order=[("document", "asc")])
