"""Report-workbook tables: landscape, payments, HEDIS,
low-income enrollment and benefit summaries. Workbooks land as one CSV per
sheet (``<workbook>/<idx>__<sheet>.csv``, SRC-7); everything else is
composition of the operators."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import stem, tagged_year, two_digit_year, year_end, year_start
from ..functions.names import camel_name, normalize_name
from ..functions.scalars import flag_codes, parse_int_commas, parse_money, parse_number, zfill
from ..operators import filters as flt
from ..operators import projections as prj
from ..operators.aggregates import union_by_name
from ..operators.entities import apply_canonical, canonical_names
from ..operators.joins import attach_dictionary, remap
from ..operators.reshape import melt
from ..sources import files as src

META = (src.FILE_PATH, "workbook", "sheet_index", "sheet_name")

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

LANDSCAPE_COMMON = {
    "state_territory_name": "state",
    "state_name": "state",
    "county_name": "county",
    "special_needs_plan_snp_indicator": "special_needs_plan",
    "snp_type": "special_needs_plan_type",
    "part_d_basic_premium_at_or_below_regional_benchmark": "part_d_basic_premium_below_regional_benchmark",
    "offers_drug_tier_with_no_part_d_deductible": "tiers_not_subject_to_deductible",
    "part_d_low_income_beneficiary_premium_amount": "part_d_premium_obligation_with_full_premium_assistance",
    "part_d_outof_pocket_oop_threshold": "increased_initial_coverage_limit",
    "in_network_maximum_outof_pocket_moop_amount": "innetwork_moop_amount",
    "monthly_consolidated_premium_part_c_d": "monthly_consolidated_premium_includes_part_c_d",
    "low_income_subsidy_lis_auto_enrollment": "0_premium_with_full_low_income_subsidy",
    "dual_eligible_snp_dsnp_integration_status": "integration_status",
    "dsnp_applicable_integrated_plan_aip_identifier": "aip_status",
}
LANDSCAPE_PREMIUM = {
    "parent_organization_name": "organization_name",
    "annual_part_d_deductible_amount": "part_d_drug_deductible",
    "drug_benefit_type": "benefit_type",
}
# per target from 2024 on: renames after the common ones, the contract
# categories it takes (None: all), and whether plan types and organisation
# names are replaced in it
LANDSCAPE_AFTER_2024 = {
    "landscape_plan_premium_report": (LANDSCAPE_PREMIUM, None, True, True),
    "landscape_medicare_advantage": ({
        "parent_organization_name": "organization_name",
        "plan_type": "type_of_medicare_health_plan",
        "annual_part_d_deductible_amount": "annual_drug_deductible",
    }, ("MA", "MAPD", "MA-PD"), False, True),
    "landscape_prescription_drug_plan": ({
        "parent_organization_name": "company_name",
        "drug_benefit_type": "benefit_type",
        "annual_part_d_deductible_amount": "annual_drug_deductible",
        "part_d_total_premium": "monthly_drug_premium",
    }, ("PDP",), True, False),
    "landscape_special_needs_plan": ({
        "part_d_total_premium": "monthly_drug_premium",
        "parent_organization_name": "organization_name",
        "plan_type": "type_of_medicare_health_plan",
        "annual_part_d_deductible_amount": "annual_drug_deductible",
    }, ("SNP",), False, True),
}
PLAN_TYPE_REMAP = {
    "HMO C-SNP": "HMO", "HMO D-SNP": "HMO", "HMO I-SNP": "HMO",
    "HMO-POS": "HMOPOS", "HMO-POS C-SNP": "HMOPOS", "HMO-POS D-SNP": "HMOPOS", "HMO-POS I-SNP": "HMOPOS",
    "PPO": "Local PPO", "PPO C-SNP": "Local PPO", "PPO D-SNP": "Local PPO", "PPO I-SNP": "Local PPO",
    "Regional PPO C-SNP": "Regional PPO", "Regional PPO D-SNP": "Regional PPO",
    "PDP": "Medicare Prescription Drug Plan", "Cost": "1876 Cost",
}
PREMIUM_RENAMES = {
    "part_c_premium2": "part_c_premium",
    "part_c_premium_2": "part_c_premium",
    "part_d_basic_premium3": "part_d_basic_premium",
    "part_d_supplemental_premium4": "part_d_supplemental_premium",
    "part_d_total_premium5": "part_d_total_premium",
    "part_d_premium_obligation_with_full_premium_assistance6": "part_d_premium_obligation_with_full_premium_assistance",
    "part_d_premium_obligation_with_full_premium_assistance_6": "part_d_premium_obligation_with_full_premium_assistance",
    "tiers_not_subject_to_deductible7": "tiers_not_subject_to_deductible",
    "increased_initial_coverage_limit8": "increased_initial_coverage_limit",
    "part_d_supplemental_premium_4": "part_d_supplemental_premium",
    "2024_star_rating_part_c": "star_rating_part_c",
    "2024_star_rating_part_d": "star_rating_part_d",
    "2024_overall_star_rating": "overall_star_rating",
}
# money / rating columns of the premium report (the source's missing comma
# between the last two names is fixed: both are parsed)
PREMIUM_NUMERIC = (
    "part_c_premium", "part_d_basic_premium", "part_d_supplemental_premium", "part_d_total_premium",
    "part_d_premium_obligation_with_full_premium_assistance",
    "part_d_premium_obligation_with_75_premium_assistance",
    "part_d_premium_obligation_with_50_premium_assistance",
    "part_d_premium_obligation_with_25_premium_assistance",
    "part_d_drug_deductible", "star_rating_part_c", "star_rating_part_d", "overall_star_rating",
)
# per target to 2024: file name pattern, renames, number columns, and the title
# rows by the date that ends a file's name (the first entry that holds)
LANDSCAPE_BEFORE_2024 = {
    "landscape_plan_premium_report": ("*Premium_Report*", PREMIUM_RENAMES, PREMIUM_NUMERIC, (("before", "20230701", 3),)),
    "landscape_medicare_advantage": (
        "*_MA_*", {"2024_overall_star_rating": "overall_star_rating"},
        ("monthly_consolidated_premium_includes_part_c_d", "annual_drug_deductible", "overall_star_rating",
         "innetwork_moop_amount"), (("before", "20230701", 5),)),
    "landscape_prescription_drug_plan": (
        "*_PDP_*", {"2024_star_rating_part_d": "summary_star_rating", "organization_name": "company_name"},
        ("monthly_drug_premium", "annual_drug_deductible", "summary_star_rating"), (("before", "20230701", 3),)),
    "landscape_special_needs_plan": (
        "*_SNP_*", {"2024_overall_star_rating": "overall_star_rating", "drug_benefit_type1": "drug_benefit_type_detail"},
        ("monthly_consolidated_premium_includes_part_c_d", "annual_drug_deductible", "overall_star_rating"),
        (("on", "20221014", 6), ("before", "20221014", 4))),
}
COUNTY_HEADER = ("county_code", "state", "county_name", "plan_type", "snp_plan_type", "avg_risk_score",
                 "avg_ab_pmpm_payment", "avg_rebate_pmpm_payment")
MSA_TAIL = ("avg_msa_monthly_deposit_payment",)
RECONCILIATION_HEADER = ("contract_number", "contract_name", "number_of_plans", "reconciliation_amount",
                         "lics_amount", "reinsurance_amount", "risk_sharing_amount")
PARENT_RECONCILIATION_HEADER = ("parent_organization_name", "number_of_contracts", "reconciliation_amount",
                                "lics_amount", "reinsurance_amount", "risk_sharing_amount")
LIS_HEADER = ("contract_id", "contract_name", "pbp_id", "pbp_name", "enrolled", "lis_enrolled")
PARTC_PLAN_HEADER = ("contract_number", "plan_benefit_package", "contract_name", "plan_type",
                     "avg_partc_risk_score", "avg_ab_pmpm_payment", "avg_rebate_pmpm_payment")
PARTD_PLAN_HEADER = ("contract_number", "plan_benefit_package", "contract_name", "organization_type",
                     "avg_partd_direct_subsidy_pmpm_payment", "avg_partd_risk_score",
                     "avg_reinsurance_pmpm_payment", "avg_low_income_cost_sharing_pmpm_payment")
RAU_NUMERIC = ("denominator", "observed_count", "expected_count", "member_count", "outlier_member_count",
               "non_outlier_member_count", "count_variance")
GENERAL_COLUMNS = {
    "general0010": "organization_type",
    "general0011": "plan_type",
    "general0014": "snp_offered",
    "general0015": "partd_offered",
    "general0016": "partd_offered",
    "general0020": "line_of_business",
    "general0050": "enrollment_yearend",
    "general0060": "cms_region_number",
    "general0070": "cms_region_name",
    "general_0070": "cms_region_name",
    "general0080": "population_type",
    "general0085": "sumitted_to_ncqa",
    "general0087": "hos_included",
}
NATIONAL_COLUMNS = {
    "n_r0010": "hedis_year",
    "n_r0020": "measure_name",
    "n_r0030": "indicator_description",
    "n_r0040": "indicator_key",
    "n_r0050": "rate",
    "n_r0060": "num_reporting_contracts",
    "n_r0070": "tot_num_enrollees",
}
HOS_RATES = {
    "FRM": {"rate1": "discussing_fall_risk_rate", "rate2": "managing_fall_risk_rate"},
    "PAO-HOS": {"rate1": "discussing_physical_activity_rate", "rate2": "advising_physical_activity_rate"},
    "MUI-HOS": {"rate1": "discussing_urinary_incontinence_rate", "rate2": "treatment_of_urinary_incontinence_rate",
                "rate3": "impact_of_urinary_incontinence_rate"},
}


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in META and c != "src_file_name"]


def landscape(df: DataFrame, target_schema: T.StructType, organization_map: DataFrame | None,
              file_name: str, year: int, load_date: _dt.date,
              renames: Mapping[str, str] = LANDSCAPE_PREMIUM, plan_types: bool = True) -> tuple[DataFrame, list[str]]:
    """landscape tables (from 2024): PRJ-1/3 renames in two ordered passes,
    JON-5 plan-type remap (if the target has it), ENT-4 canonical organisation names, PRJ-7 conform
    to the target table's schema (double columns through SCL-1 money
    parsing), lineage. Returns the table rows and the target columns the
    file lacks."""
    df = prj.normalize_headers(df.select(*_data_columns(df)))
    df = prj.rename(df, LANDSCAPE_COMMON)
    df = prj.rename(df, renames)
    if plan_types and "plan_type" in df.columns:
        df = remap(df, "plan_type", PLAN_TYPE_REMAP)
    if organization_map is not None and "organization_name" in df.columns:
        df = apply_canonical(df, "organization_name", organization_map)
    out, missing = prj.conform_to(df, target_schema, {"double": parse_money})
    out = prj.with_lineage(out, file_date=_dt.date(year, 1, 1), load_date=load_date, file_name=file_name)
    return out, missing


def organization_names(history: DataFrame, column: str = "organization_name") -> DataFrame:
    """ENT-3 over the names already in a landscape table."""
    return canonical_names(history, column)


def route_landscape(df: DataFrame, column: str = "contract_category_type") -> dict[str, DataFrame]:
    """FLT-5: one landscape file feeds the MA, PDP and SNP tables."""
    return flt.route_by_category(df, column, {
        table: list(categories) for table, (_, categories, _, _) in LANDSCAPE_AFTER_2024.items() if categories})


def landscape_before_2024(spark: SparkSession, paths: Sequence[str], skip_rows: int, year: int,
                          money_columns: Sequence[str], load_date: _dt.date,
                          renames: Mapping[str, str] | None = None) -> DataFrame:
    """landscape tables (to 2024): SRC-3 title rows, PRJ-11 duplicate headers,
    PRJ-1/3, PRJ-5, FLT-4 blank rows, SCL-1 money columns, PTH-3 year start."""
    df = src.read_with_preamble(spark, list(paths), skip_rows, encoding="ISO-8859-1")
    data = [c for c in df.columns if c not in (src.FILE_PATH, "row_idx")]
    df = df.select(src.FILE_PATH, *[F.col(f"`{c}`") for c in data]).toDF(
        src.FILE_PATH, *[normalize_name(c) for c in data])
    df = prj.rename(df, dict(renames or {}))
    df = prj.drop_unnamed(df)
    df = _drop_blank(df)
    df = prj.cast_columns(df, parse_money, names=[c for c in money_columns if c in df.columns])
    name = F.regexp_extract(F.col(src.FILE_PATH), r"([^/]*)$", 1)
    return prj.with_lineage(df, file_date=_dt.date(year, 1, 1), load_date=load_date, file_name=name) \
        .drop(src.FILE_PATH)


def landscape_table_before_2024(spark: SparkSession, paths: Sequence[str], table: str, load_date: _dt.date) -> DataFrame:
    """One landscape table (to 2024) from its files, named
    ``CYyyyy_..._<yyyymmdd>.csv``. The title rows follow from the date in the
    name; files are grouped by (year, title rows) from their names (metadata
    only), each group is one read, and the groups are unioned by name (SET-1)."""
    import os

    _, renames, numeric, titles = LANDSCAPE_BEFORE_2024[table]
    groups: dict[tuple[int, int], list[str]] = {}
    for path in paths:
        stem_ = os.path.splitext(os.path.basename(path))[0]
        day = stem_[-8:]
        skip = next((n for how, at, n in titles if (day == at if how == "on" else day < at)), 0)
        groups.setdefault((int(stem_[2:6]), skip), []).append(path)
    parts = [landscape_before_2024(spark, group, skip, year, numeric, load_date, renames)
             for (year, skip), group in sorted(groups.items())]
    return union_by_name(parts)


def landscape_premium_report(spark: SparkSession, paths: Sequence[str], load_date: _dt.date) -> DataFrame:
    """landscape_plan_premium_report (to 2024)."""
    return landscape_table_before_2024(spark, paths, "landscape_plan_premium_report", load_date)


def load_landscape_before_2024(spark: SparkSession, root: str, table: str, target: str, load_date: _dt.date) -> int:
    """A landscape table (to 2024), end to end: its files under ``root`` make
    the whole table anew (SNK-3), as these years are closed."""
    from ..sinks import tables as snk

    paths = [r[0] for r in src.list_files(spark, root, LANDSCAPE_BEFORE_2024[table][0]).select("path").collect()]
    if paths:
        snk.replace_table(landscape_table_before_2024(spark, paths, table, load_date), target)
    return len(paths)


def _drop_blank(df: DataFrame) -> DataFrame:
    """FLT-4 on the data columns only (the path column is never null)."""
    data = [c for c in df.columns if c != src.FILE_PATH]
    keep = F.lit(False)
    for c in data:
        keep = keep | F.col(f"`{c}`").isNotNull()
    return df.filter(keep)


LANDED = (*META, "landed")


def _landed_name(df: DataFrame):
    """The name a workbook's rows are kept under: with its folder if the load
    gives one (column ``landed``), so that equal names in two folders stay
    apart, in their slices and in what is decided by file."""
    return F.col("landed") if "landed" in df.columns else F.col("workbook")


def payment_county(sheets: DataFrame, load_date: _dt.date) -> DataFrame:
    """partc_payment_county_level for one workbook's chosen sheet (header
    already skipped): SRC-12 with the optional MSA column, SCL-8 county code,
    PRJ-10 numbers, PRJ-9 swap check by file, PTH-3 year end."""
    df = src.assign_header(sheets, COUNTY_HEADER, MSA_TAIL, ignore=LANDED)
    df = df.withColumn("county_code", zfill("county_code", 5))
    df = prj.cast_columns(df, parse_number, suffixes=("payment", "score"))
    df = df.withColumn("src_file_name", _landed_name(df))
    df = prj.swap_columns_if(df, "avg_risk_score", "avg_ab_pmpm_payment", 100.0, by=["src_file_name"])
    year = F.substring(F.col("workbook"), 1, 4)
    out = prj.with_lineage(df, file_date=year_end(year), load_date=load_date, file_name=F.col("src_file_name"))
    return out.drop(*META, "landed")


def payment_plan_partc(sheets: DataFrame, load_date: _dt.date) -> DataFrame:
    """partc_payment_plan_level: as the county table without code padding."""
    df = src.assign_header(sheets, PARTC_PLAN_HEADER, MSA_TAIL, ignore=LANDED)
    df = prj.cast_columns(df, parse_number, suffixes=("payment", "score"))
    df = df.withColumn("src_file_name", _landed_name(df))
    df = prj.swap_columns_if(df, "avg_partc_risk_score", "avg_ab_pmpm_payment", 100.0, by=["src_file_name"])
    year = F.substring(F.col("workbook"), 1, 4)
    out = prj.with_lineage(df, file_date=year_end(year), load_date=load_date, file_name=F.col("src_file_name"))
    return out.drop(*META, "landed")


def payment_plan_partd(sheets: DataFrame, load_date: _dt.date) -> DataFrame:
    """partd_payment_plan_level: positional header, numbers; no swap check."""
    df = src.assign_header(sheets, PARTD_PLAN_HEADER, ignore=LANDED)
    df = prj.cast_columns(df, parse_number, suffixes=("payment", "score"))
    year = F.substring(F.col("workbook"), 1, 4)
    out = prj.with_lineage(df, file_date=year_end(year), load_date=load_date, file_name=_landed_name(df))
    return out.drop(*META, "landed")


def reconciliation(sheets: DataFrame, load_date: _dt.date, header: Sequence[str] = RECONCILIATION_HEADER,
                   label: str = "contract_number") -> DataFrame:
    """partd_reconciliation_*: SRC-12, FLT-3 totals row, PRJ-10 amounts,
    PTH-4 year from the name's characters 3-4."""
    df = src.assign_header(sheets, header, ignore=LANDED)
    df = flt.drop_totals(df, label, "Totals")
    df = prj.cast_columns(df, parse_number, suffixes=("amount",))
    year = year_end(two_digit_year(stem(F.col("workbook")), 3))
    return prj.with_lineage(df.drop(src.FILE_PATH, "sheet_index", "sheet_name"), file_date=year,
                            load_date=load_date, file_name=_landed_name(df)).drop("workbook", "landed")


def reconciliation_parent(sheets: DataFrame, load_date: _dt.date) -> DataFrame:
    """partd_reconciliation_parent_level: the workbook's second sheet, one
    row per parent organisation; totals row dropped by the parent name."""
    return reconciliation(sheets, load_date, PARENT_RECONCILIATION_HEADER, "parent_organization_name")


def lis_enrollment(sheets: DataFrame, year: int, load_date: _dt.date) -> DataFrame:
    """lis_enrollment_by_plan: both sheets (SET-1), positional header,
    comma numbers (SCL-2), PTH-3 year end."""
    df = src.assign_header(sheets, LIS_HEADER, ignore=META)
    df = df.withColumns({"enrolled": parse_int_commas("enrolled"), "lis_enrolled": parse_int_commas("lis_enrolled")})
    return prj.with_lineage(df.drop(src.FILE_PATH, "sheet_index", "sheet_name"), file_date=year_end(F.lit(year)),
                            load_date=load_date, file_name=F.col("workbook")).drop("workbook")


def mpf_benefit_summary(sheets: DataFrame, load_date: _dt.date) -> DataFrame:
    """mpf_benefit_summary: PRJ-1/3, PTH-5 contract year from ``CYdddd``."""
    df = sheets.toDF(*[c if c in META else normalize_name(c) for c in sheets.columns])
    df = prj.rename(df, {"service_name": "service_desc"})
    year = tagged_year(F.col("workbook"))
    return prj.with_lineage(df.drop(src.FILE_PATH, "sheet_index", "sheet_name"), file_date=year_start(year),
                            load_date=load_date, file_name=F.col("workbook")).drop("workbook")


def hos_rates(sheet: DataFrame, code: str) -> DataFrame:
    """RSH-1: one row for each rate of a HOS sheet (FRM and PAO-HOS have two,
    MUI-HOS three), without confidence limits."""
    return melt(sheet, ["contract_number"], HOS_RATES[code], "indicator_key", "rate",
                constants={"measure_code": F.lit(code), "lcl": F.lit(None).cast("string"),
                           "ucl": F.lit(None).cast("string")})


def hedis_measures(measures: DataFrame, hos: Mapping[str, DataFrame], dictionary: DataFrame, year: int,
                   load_date: _dt.date, workbook: str) -> DataFrame:
    """hedis_measures: PRJ-2 camel headers, RSH-1 rates of the HOS sheets (by
    measure code: FRM, PAO-HOS, MUI-HOS) to rows, SET-1,
    JON-2 dictionary, SCL-17 flags from the raw rate text (not after
    coercion), SCL-3 numbers, PTH-3."""
    m = camel_headers_only(measures)
    m = prj.rename(m, {"c_m_s_contract_number": "contract_number"})
    rates = [hos_rates(camel_headers_only(sheet), code) for code, sheet in hos.items()]
    allm = union_by_name([m, *rates]).withColumn("hedis_year", F.lit(year))
    d = camel_headers_only(dictionary).select("measure_code", "indicator_key", "measure_name",
                                              "short_indicator_name")
    allm = attach_dictionary(allm, d, ["measure_code", "indicator_key"])
    allm = allm.withColumns(flag_codes("rate"))
    allm = prj.cast_columns(allm, parse_number, names=["rate", "lcl", "ucl", "numerator", "denominator"])
    return prj.with_lineage(allm, file_date=_dt.date(year, 12, 31), load_date=load_date, file_name=workbook)


def camel_headers_only(df: DataFrame) -> DataFrame:
    """PRJ-2 on data columns; sheet metadata columns dropped."""
    data = _data_columns(df)
    return df.select(*[F.col(f"`{c}`").alias(camel_name(c)) for c in data])


def hedis_rau(rau: DataFrame, dictionary: DataFrame, year: int, load_date: _dt.date,
              workbook: str) -> DataFrame:
    """hedis_rau_measures: PRJ-2, JON-2 dictionary, SCL-3 counts, PTH-3."""
    df = prj.rename(camel_headers_only(rau), {"c_m_s_contract_number": "contract_number"})
    df = df.withColumn("hedis_year", F.lit(year))
    d = camel_headers_only(dictionary).select("measure_code", "indicator_key", "measure_name",
                                              "short_indicator_name")
    df = attach_dictionary(df, d, ["measure_code", "indicator_key"])
    df = prj.cast_columns(df, parse_number, names=RAU_NUMERIC)
    return prj.with_lineage(df, file_date=_dt.date(year, 12, 31), load_date=load_date, file_name=workbook)


def hedis_general(general: DataFrame, year: int, load_date: _dt.date, workbook: str) -> DataFrame:
    """hedis_general: PRJ-2 then the general-code names (PRJ-3), year-end
    enrollment as a number."""
    df = camel_headers_only(general)
    df = df.toDF(*[GENERAL_COLUMNS.get(c, c) for c in df.columns])
    df = prj.rename(df, {"c_m_s_contract_number": "contract_number"})
    if "enrollment_yearend" in df.columns:
        df = df.withColumn("enrollment_yearend", parse_number("enrollment_yearend"))
    df = df.withColumn("hedis_year", F.lit(year))
    return prj.with_lineage(df, file_date=_dt.date(year, 12, 31), load_date=load_date, file_name=workbook)


def hedis_national_rates(rates: DataFrame, year: int, load_date: _dt.date, workbook: str) -> DataFrame:
    """hedis_national_rates: PRJ-2 then the national-rate code names; the
    measure name column holds the measure code."""
    df = camel_headers_only(rates)
    df = df.toDF(*[NATIONAL_COLUMNS.get(c, c) for c in df.columns])
    df = prj.rename(df, {"measure_name": "measure_code"})
    return prj.with_lineage(df, file_date=_dt.date(year, 12, 31), load_date=load_date, file_name=workbook)


def load_landscape_after_2024(spark: SparkSession, csv_path: str, targets: Mapping[str, str],
                              organization_history: DataFrame | None, year: int,
                              load_date: _dt.date) -> dict[str, list[str]]:
    """The landscape tables from 2024 on, end to end: the file is read once in
    its own encoding (SRC-6) and staged in the shared folder (SURVEY §4: one
    read for several sinks); the premium report gets every row, the other
    targets those of their categories (FLT-5), each with its own renames and
    replacements, conformed to that table's own schema (PRJ-7), and the file's
    slice replaced (SNK-1, SNK-4). Returns, per target, the table columns the
    file lacks."""
    from ..session import cut_lineage
    from ..sinks import tables as snk

    name = csv_path.rstrip("/").split("/")[-1]
    mapping = organization_names(organization_history) if organization_history is not None else None
    encoding = src.decode_with_fallback(spark, csv_path).select("encoding").first()[0]
    raw = cut_lineage(src.read_csv_text(spark, csv_path, encoding=encoding), spark, "landscape")
    raw = prj.normalize_headers(raw)
    routes = route_landscape(raw)
    missing: dict[str, list[str]] = {}
    for table_name, (renames, categories, plan_types, names) in LANDSCAPE_AFTER_2024.items():
        path = targets.get(table_name)
        if path is None:
            continue
        schema = snk.read_table(spark, path).schema if snk.path_exists(spark, path) else None
        if schema is None:
            raise ValueError(f"{table_name}: the target table must exist to conform to it")
        data = [f for f in schema.fields if f.name not in ("src_file_date", "src_file_name", "load_date")]
        rows = routes[table_name] if categories else raw
        out, miss = landscape(rows, T.StructType(data), mapping if names else None, name, year, load_date, renames, plan_types)
        snk.replace_slice(out, path, "src_file_name", value=name)
        missing[table_name] = miss
    return missing


def load_workbooks(spark: SparkSession, root: str, target: str, sheet: str | int | None, transform, load_date: _dt.date) -> int:
    """A table of workbooks, end to end: those under ``root`` that the target
    has no slice of (INC-1), their sheets of one kind read together (SRC-7),
    ``transform(sheets, load_date)``, and their slices replaced (SNK-1).
    Returns how many workbooks were new."""
    from ..operators.incremental import unprocessed
    from ..sinks import tables as snk

    listed = src.list_sheets(spark, root)
    if isinstance(sheet, int):
        listed = listed.filter(F.col("sheet_index") == sheet)
    elif sheet is not None:
        listed = listed.filter(F.col("sheet_name") == sheet)
    done = snk.loaded_slices(spark, target, "src_file_name") if snk.path_exists(spark, target) else None
    new = unprocessed(listed.withColumn("src_file_name", F.col("workbook")), done, "src_file_name")
    found = new.select("workbook", "path").collect()  # what the reader must be told, one per sheet
    if not found:
        return 0
    sheets = src.sheet_columns(src.read_csv_text(spark, [r["path"] for r in found]))
    snk.replace_slice(transform(sheets, load_date), target, "src_file_name")
    return len({r["workbook"] for r in found})


def _of_year(table):
    """A HEDIS or LIS table whose year is in the workbook's name."""
    def run(sheets: DataFrame, load_date: _dt.date) -> DataFrame:
        books = [r[0] for r in sheets.select("workbook").distinct().collect()]
        return union_by_name([table(sheets.filter(F.col("workbook") == b), int(_year_in(b)), load_date, b) for b in books])
    return run


def _year_in(workbook: str) -> str:
    import re

    return re.search(r"(\d{4})(?=\.[^.]*$|$)", workbook)[1]


# The sheet and the transform of each table of workbooks.
WORKBOOK_TABLES = {
    "lis_enrollment_by_plan": (None, _of_year(lambda s, y, d, b: lis_enrollment(s, y, d))),
    "mpf_benefit_summary": (None, mpf_benefit_summary),
    "hedis_general": ("general", _of_year(hedis_general)),
    "hedis_national_rates": ("national_rates", _of_year(hedis_national_rates)),
}


# Of each payment table the workbooks, the transform, the columns
# at most, the sheet (the first named so, else sheet 0; or a number), the rows
# before the data, and those of years that land otherwise.
PAYMENT_TABLES = {
    "partc_payment_county_level": (r"PartCCountyLevel\.xlsx$", payment_county, len(COUNTY_HEADER) + len(MSA_TAIL), "result", 3, {"2011": 0}),
    "partc_payment_plan_level": (r"PartCPlan.*Level\.xlsx$", payment_plan_partc, len(PARTC_PLAN_HEADER) + len(MSA_TAIL), "result", 3, {}),
    "partd_payment_plan_level": (r"PartDPlans\.xlsx$", payment_plan_partd, len(PARTD_PLAN_HEADER), "result", 3, {}),
    "partd_reconciliation_contract_level": (r"PartD Reconciliation\.xlsx$|PartDReconcilia.*\.xlsx$", reconciliation,
                                            len(RECONCILIATION_HEADER), 0, 1, {}),
    "partd_reconciliation_parent_level": (r"PartD Reconciliation\.xlsx$|PartDReconcilia.*\.xlsx$", reconciliation_parent,
                                          len(PARENT_RECONCILIATION_HEADER), 1, 1, {}),
}


def load_payments(spark: SparkSession, root: str, target: str, table: str, load_date: _dt.date) -> int:
    """One of ``PAYMENT_TABLES``, end to end: the table's workbooks under
    ``root`` that the target has no slice of (INC-1), of each the sheet that
    holds the result (SRC-8), its title rows skipped, columns by position
    (SRC-12), kept as ``folder/workbook`` (SNK-1). Returns how many workbooks
    were new."""
    from ..operators.incremental import unprocessed
    from ..sinks import tables as snk

    pattern, transform, width, sheet, skip, other = PAYMENT_TABLES[table]
    folder = F.regexp_extract("path", r"([^/]*)/[^/]*/[^/]*$", 1)
    listed = src.list_sheets(spark, root).filter(F.col("workbook").rlike(pattern))
    listed = listed.withColumn("src_file_name", F.concat(folder, F.lit("/"), F.col("workbook")))
    done = snk.loaded_slices(spark, target, "src_file_name") if snk.path_exists(spark, target) else None
    listed = unprocessed(listed, done, "src_file_name")
    if isinstance(sheet, int):
        picked = listed.filter(F.col("sheet_index") == sheet)
    else:
        best = src.pick_sheet(listed, sheet, workbook="src_file_name")
        picked = listed.join(best, ["src_file_name", "sheet_index"], "left_semi")
    paths = [r["path"] for r in picked.select("path").collect()]  # what the reader must be told, one per workbook
    if not paths:
        return 0
    m = src.sheet_columns(src.read_matrix(spark, paths, width, stage=True))
    first = F.lit(skip)
    for year, rows in other.items():
        first = F.when(F.col("workbook").startswith(year), rows).otherwise(first)
    name = F.concat(F.regexp_extract(src.FILE_PATH, r"([^/]*)/[^/]*/[^/]*$", 1), F.lit("/"), F.col("workbook"))
    cells = m.filter((F.col("row_idx") >= first) & (F.concat_ws("", "cells") != ""))
    rows = cells.select(*[F.col("cells")[i].alias(f"c{i}") for i in range(width)], *META, name.alias("landed"))
    snk.replace_slice(transform(rows, load_date), target, "src_file_name")
    return len(paths)


def hedis_pairs(spark: SparkSession, root: str, min_year: str = "2024", loaded: DataFrame | None = None) -> DataFrame:
    """INC-6 for HEDIS, without the data workbooks that ``loaded`` names in
    ``src_file_name`` (INC-1): per year, the data workbook (``HEDIS<yyyy>``) and its
    dictionary (``MADictionary<yyyy>``), from the sheet landing folders; a
    year missing either fails the job."""
    sheets = src.list_sheets(spark, root).select("workbook").distinct()
    year = F.regexp_extract(F.regexp_replace("workbook", r"\.[^.]*$", ""), r"(\d{4})$", 1)
    files = sheets.select(year.alias("year"), F.col("workbook").alias("name"),
                          F.col("workbook").alias("path")).filter((F.col("year") != "") & (F.col("year") >= min_year))
    from ..operators.incremental import pair_files
    pairs = pair_files(files, "year", {"data": "HEDIS", "dictionary": "MADictionary"})
    if loaded is not None:
        pairs = pairs.join(loaded.select(F.col("src_file_name").alias("data")), "data", "left_anti")
    return pairs


# The HOS sheet of each measure code.
HOS_SHEETS = {"FRM": "hedishos_frm", "PAO-HOS": "hedishos_pao", "MUI-HOS": "hedishos_mui"}


def load_hedis(spark: SparkSession, root: str, measures: str, rau: str, load_date: _dt.date, min_year: str = "2024") -> int:
    """hedis_measures and hedis_rau_measures, end to end: the workbooks under
    ``root`` that either table lacks, each with its year's dictionary
    (INC-6, INC-1); their sheets (SRC-7) to rows with dictionary names; all
    years of a table written as their slices at once (SNK-1, SNK-4). Years
    are few, their sheets distributed reads. Returns how many workbooks were
    new to either table."""
    from ..sinks import tables as snk

    seen = set()

    def sheet(workbook: str, kind: str | int) -> DataFrame:
        return src.read_sheets(spark, f"{root.rstrip('/')}/{workbook}", kind)

    def measures_of(r) -> DataFrame:
        hos = {code: sheet(r["data"], kind) for code, kind in HOS_SHEETS.items()}
        return hedis_measures(sheet(r["data"], "hedis_measures"), hos, sheet(r["dictionary"], 0), int(r["year"]), load_date, r["data"])

    def rau_of(r) -> DataFrame:
        return hedis_rau(sheet(r["data"], "hedis_rau_measures"), sheet(r["dictionary"], 0), int(r["year"]), load_date, r["data"])

    for target, table in ((measures, measures_of), (rau, rau_of)):
        done = snk.loaded_slices(spark, target, "src_file_name") if snk.path_exists(spark, target) else None
        pairs = hedis_pairs(spark, root, min_year, done).collect()
        if pairs:
            snk.replace_slice(union_by_name([table(r) for r in pairs]), target, "src_file_name")
            seen |= {r["data"] for r in pairs}
    return len(seen)
