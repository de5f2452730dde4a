"""Star-rating tables over file fixtures (FIXTURES.md 2.9, 2.10)."""

import datetime as dt
import os

from tidemark.plans import star_ratings as S

LOAD = dt.date(2024, 5, 1)


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


MEASURE = (
    "2024 Star Ratings Data Table - Measure Data,,,,,,,\n"
    "CONTRACT_ID,Organization Type,Contract Name,Organization Marketing Name,Parent Organization,,,\n"
    ',,,,,C01: Breast Cancer Screening,"C02: Colorectal\nCancer Screening",\n'
    ",,,,,01/01/2022 - 12/31/2022,(Monday - Friday) 01/01/2022 \x96 12/31/2022,\n"
    "H1, Local CCP ,Plan One,Brand One,Parent A,85%,4,\n"
    ",,,,,,,\n"
    "H2,PDP,Plan Two,Brand Two,,Plan too new to be measured,,\n"
)


def test_measure_values(spark, tmp_dir):
    root = os.path.join(tmp_dir, "stars")
    write(f"{root}/2024 Star Ratings/2024 Star Ratings Measure Data (Oct 11 2023).csv", MEASURE, "latin-1")
    df = S.measure_values(spark, root, ["*Measure Data*.csv"], LOAD, width=16)
    rows = sorted(df.collect(), key=lambda r: (r.contract_id, r.measure_code))
    assert [(r.contract_id, r.measure_code) for r in rows] == [("H1", "C01"), ("H1", "C02"), ("H2", "C01"),
                                                               ("H2", "C02")]
    h1c01, h1c02, h2c01, h2c02 = rows
    assert h1c01.organization_type == "Local CCP"  # stripped
    assert h1c01.measure_desc == "breast_cancer_screening"
    assert h1c02.measure_desc == "colorectal_cancer_screening"  # quoted newline is whitespace
    assert h1c01.measure_value == 85.0 and h1c02.measure_value == 4.0
    assert h2c01.measure_value is None and h2c01.measure_value_raw == "Plan too new to be measured"
    assert h2c02.measure_value_raw is None  # a null cell stays null
    assert h1c02.measure_start == dt.date(2022, 1, 1) and h1c02.measure_end == dt.date(2022, 12, 31)
    assert h1c01.performance_year == 2024 and h1c01.src_file_date == dt.date(2023, 10, 11)
    assert h2c01.parent_organization is None


DISPLAY = (
    "2024 Display Measures,,,,,\n"
    "CONTRACT_ID,Contract Name,Organization Marketing Name,Parent Organization,,\n"
    ",,,,Call Center Foreign Language DMC01,Appeals Upheld DMD02\n"
    "H1,Plan One,Brand One,Parent A,95%,80\n"
)
DISPLAY_HEDIS = (
    "2024 Display HEDIS,,,,\n"
    "CONTRACT_ID,Contract Name,Organization Marketing Name,Parent Organization,Flu Shots DMC10\n"
    "H1,Plan One,Brand One,Parent A,70%\n"
)


def test_display_measures(spark, tmp_dir):
    root = os.path.join(tmp_dir, "display")
    write(f"{root}/2024 Display/2024_Display_Measures_2023_10_11.csv", DISPLAY, "latin-1")
    write(f"{root}/2024 Display/2024_Display_HEDIS_2023_10_12.csv", DISPLAY_HEDIS, "latin-1")
    df = S.display_measures(spark, root, LOAD, width=16)
    rows = {(r.measure_code, r.src_file_date): r for r in df.collect()}
    assert set(rows) == {("DMC01", dt.date(2023, 10, 11)), ("DMD02", dt.date(2023, 10, 11)),
                         ("DMC10", dt.date(2023, 10, 12))}
    assert rows[("DMC01", dt.date(2023, 10, 11))].measure_desc == "call_center_foreign_language"
    assert rows[("DMC01", dt.date(2023, 10, 11))].measure_value == 95.0
    assert rows[("DMC10", dt.date(2023, 10, 12))].measure_value == 70.0
    assert all(r.contract_id == "H1" for r in rows.values())


PART_C = (
    "﻿Part C,,,\n"
    "skip,,,\n"
    ",C01: Breast Cancer Screening,C02: Colorectal Cancer Screening,C03: Annual Flu Vaccine\n"
    ",02/2019 – 02/2019,01/01/2022 - 12/31/2022,Not Applicable\n"
    "1star,< 55,>= 62 to < 71,\n"
    "2 stars,>= 55 to < 62,0.5-0.8,no number\n"
    "Total,1,2,3\n"
)
PART_D = (
    "Part D,,,\n"
    "skip,,,\n"
    ",,D01: Call Center,D02: Appeals\n"
    ",,01/2020 \xf1 03/2020,01/01/2021 - 06/30/2021\n"
    "MAPD,5 star,>= 90,>= 95\n"
    "PDP,4 Star,>= 80 to < 90,\n"
)


def test_cutpoints(spark, tmp_dir):
    root = os.path.join(tmp_dir, "cut")
    write(f"{root}/2020 Star Ratings Data Table - Part C Cut Points (Oct 21 2019).csv", PART_C, "utf-8")
    write(f"{root}/2026_Star_Ratings_Data_Table_-_Part_D_Cut_Points__Oct_8_2025_.csv", PART_D, "latin-1")
    df = S.cutpoints(spark, root, LOAD)
    rows = {(r.part_type, r.star, r.measure_code): r for r in df.collect()}
    c1 = rows[("Part_C", 1, "C01")]
    assert c1.org_type == "MA-PD" and c1.lower_bound is None and c1.upper_bound == 55.0
    assert c1.measure_period_start == dt.date(2019, 2, 1) and c1.measure_period_end == dt.date(2019, 2, 28)
    assert c1.performance_year == 2020 and c1.src_file_date == dt.date(2019, 10, 21)
    c2 = rows[("Part_C", 1, "C02")]
    assert (c2.lower_bound, c2.upper_bound) == (62.0, 71.0)
    assert rows[("Part_C", 2, "C02")].lower_bound == 0.5 and rows[("Part_C", 2, "C02")].upper_bound == -0.8
    c3 = rows[("Part_C", 2, "C03")]
    assert c3.measure_period_start is None and (c3.lower_bound, c3.upper_bound) == (None, None)
    assert ("Part_C", 1, "C03") not in rows  # empty value skipped
    assert not any(k[1] is None for k in rows)  # "Total" row skipped
    d = rows[("Part_D", 5, "D01")]
    assert d.org_type == "MAPD" and d.lower_bound == 90.0 and d.upper_bound is None
    assert d.measure_period_start == dt.date(2020, 1, 1) and d.measure_period_end == dt.date(2020, 3, 31)
    assert d.performance_year == 2026 and d.src_file_date == dt.date(2025, 10, 8)
    assert ("Part_D", 4, "D02") not in rows
    assert rows[("Part_D", 4, "D01")].org_type == "PDP"
    assert len(rows) == 8


SUMMARY = (
    "2024 Star Ratings Summary\n"
    "Contract Number,Organization Type,Contract Name,Organization Marketing Name,Parent Organization,SNP,"
    "2024 Part C Summary,2024 Part D Summary,2024 Overall,2022 Disaster %,2021 Disaster %\n"
    "H1,Local CCP,Plan One,Brand,Parent,Yes,4.5,4,Plan too new,0,100\n"
)


def test_overall_summary(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sum", "2024 Star Ratings Summary Rating (Oct 11 2023).csv")
    write(path, SUMMARY, "latin-1")
    r = S.overall_summary(spark, [path], 2024, LOAD).collect()[0]
    assert r.part_c_summary == 4.5 and r.part_d_summary == 4.0 and r.overall_summary is None
    assert r.overall_summary_raw == "Plan too new"
    assert r.disaster_py_minus_2 == "0" and r.disaster_py_minus_3 == "100"
    assert r.src_file_date == dt.date(2023, 10, 11) and r.performance_year == 2024


def test_overall_summaries_of_all_years(spark, tmp_dir):
    """Years with other headers load together, each renamed by its own year."""
    root = os.path.join(tmp_dir, "years")
    head = "Contract Number,Organization Type,Contract Name,Organization Marketing Name,Parent Organization,SNP,"
    write(f"{root}/2024 Star Ratings/2024 Star Ratings Data Table - Summary Rating (Oct 13 2023).csv",
          "Title\n" + head + "2022 Disaster %,2021 Disaster %,2024 Part C Summary,2024 Part D Summary,2024 Overall\n"
          "H1,Local,\"Plan, one\",Market,Parent,No,5,6,4.5,4,Plan too new\n")
    write(f"{root}/2022 Star Ratings/2022 Star Ratings Data Table - Summary Rating (Oct 8 2021).csv",
          "Title\n" + head + "2022 Overall,2022 Part D Summary,2022 Part C Summary,2020 Disaster %\nH2,Local,Two,Market,Parent,Yes,3.5,3,2.5,9\n")
    write(f"{root}/2022 Star Ratings/2022 Other (Oct 8 2021).csv", "x\n")
    rows = {r.contract_number: r for r in S.overall_summaries(spark, root, LOAD).collect()}
    a, b = rows["H1"], rows["H2"]
    assert (a.performance_year, a.part_c_summary, a.overall_summary, a.overall_summary_raw) == (2024, 4.5, None, "Plan too new")
    assert (a.disaster_py_minus_2, a.disaster_py_minus_3, a.contract_name) == ("5", "6", "Plan, one")
    assert (b.performance_year, b.part_c_summary, b.part_d_summary, b.overall_summary) == (2022, 2.5, 3.0, 3.5)
    assert (b.disaster_py_minus_2, b.disaster_py_minus_3, b.src_file_date) == ("9", None, dt.date(2021, 10, 8))


def test_star_rating_files_by_rule(spark, tmp_dir):
    root = os.path.join(tmp_dir, "rules")
    for name in ("2012_plan_ratings_and_display_measures/x/2012 Master_Table a data.csv", "2015_ratings/2015 Master Table a data.csv",
                 "2012_plan_ratings_and_display_measures/2012 Measure Data.csv", "d/2013_Display_Measure.csv", "d/2014_Display_Measure_b.csv",
                 "d/2016 HEDIS c.csv", "d/2012 HEDIS.csv", "d/2020 Display.csv"):
        write(f"{root}/{name}", "x\n")
    names = lambda paths: sorted(os.path.basename(p) for p in paths)
    assert names(S._paths(spark, root, S.MEASURE_PATTERNS, deny_folders=S.MASTER_DENY_FOLDERS, denied=S.MASTER_TABLES)) == [
        "2012 Measure Data.csv", "2015 Master Table a data.csv"]
    assert names(S._paths(spark, root, S.DISPLAY_PATTERNS, after=S.DISPLAY_AFTER)) == ["2014_Display_Measure_b.csv", "2016 HEDIS c.csv"]
