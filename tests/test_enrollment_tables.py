"""Enrollment-family tables over file fixtures (FIXTURES.md 2.1, 2.2, 2.5, 2.6)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tidemark.plans import enrollment as P
from tidemark.sinks import tables as snk

LOAD = dt.date(2024, 5, 1)


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_cpsc_enrollment_contract_combined(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src", "cpsc")
    write(f"{src}/2024_01/CPSC_Enrollment_Info_2024_01.csv",
          "Contract Number,Plan ID,Enrollment\nH1,001,12\nH1,002,*\nH2,001,\nH3,001,abc\nH4,001,7\n")
    write(f"{src}/2024_02/CPSC_Enrollment_Info_2024_02.csv",
          "Contract Number,Plan ID,Enrollment\nH1,001,13\n")
    write(f"{src}/2024_01/CPSC_Contract_Info_2024_01.csv",
          "Contract ID,Plan ID,Organization Type,Contract Effective Date\n"
          "H1,001,Local CCP,01/01/2024 0:00:00\nH1,001,Duplicate,01/01/2023 0:00:00\n"
          "H2,,Missing plan,01/01/2024 0:00:00\n")
    enroll, contract, combined = (os.path.join(tmp_dir, t) for t in ("enroll", "contract", "combined"))
    assert P.cpsc_enrollment(spark, src, enroll, LOAD) == 2
    assert P.cpsc_enrollment(spark, src, enroll, LOAD) == 0  # nothing new
    assert P.cpsc_contract(spark, src, contract, LOAD) == 1
    e = snk.read_table(spark, enroll)
    got = sorted((r.contract_number, r.plan_id, r.enrollment, r.src_file_date) for r in e.collect())
    assert got == [("H1", "001", 12, "2024-01-01"), ("H1", "001", 13, "2024-02-01"),
                   ("H4", "001", 7, "2024-01-01")]
    c = snk.read_table(spark, contract)
    assert c.filter(F.col("contract_effective_date") == F.lit("2024-01-01").cast("date")).count() == 2
    P.cpsc_combined(spark, enroll, contract, combined)
    out = snk.read_table(spark, combined)
    assert out.count() == 3
    row = out.filter((F.col("contract_id") == "H1") & (F.col("src_file_date") == "2024-01-01")).collect()
    assert len(row) == 1
    # deterministic pick among the duplicate contract rows: smallest remaining columns
    assert row[0].organization_type == "Duplicate"


def test_combined_joins_changed_months_alone(spark, tmp_dir):
    """One changed month rewrites one slice; headers may drift between months."""
    root = os.path.join(tmp_dir, "cpsc")
    for m in range(1, 5):
        write(f"{root}/a/CPSC_Enrollment_Info_2024_0{m}.csv", f"Contract Number,Plan ID,Enrollment\nH1,001,{m}\nH2,002,{m}0\n" if m != 3
              else "Plan ID,Region,Contract Number,Enrollment\n001,West,H1,3\n002,East,H2,30\n")
        write(f"{root}/b/CPSC_Contract_Info_2024_0{m}.csv", "Contract ID,Plan ID,Organization Type,Contract Effective Date\nH1,001,Local CCP,01/01/2024 0:00:00\n")
    enroll, contract, combined = (os.path.join(tmp_dir, t) for t in ("e", "c", "j"))
    assert P.cpsc_enrollment(spark, f"{root}/a", enroll, LOAD) == 4 and P.cpsc_contract(spark, f"{root}/b", contract, LOAD) == 4
    names = {r[0] for r in snk.read_table(spark, enroll).select("src_file_name").distinct().collect()}
    assert names == {f"CPSC_Enrollment_Info_2024_0{m}.csv" for m in range(1, 5)}  # the file's own name, drift or not
    march = {r.contract_number: (r.enrollment, r.region) for r in snk.read_table(spark, enroll).where("src_file_date = '2024-03-01'").collect()}
    assert march == {"H1": (3, "West"), "H2": (30, "East")}

    def files():
        return {d: sorted(n for n in os.listdir(os.path.join(combined, d)) if n.endswith(".parquet")) for d in os.listdir(combined) if "=" in d}

    def whole():
        return sorted(map(tuple, snk.read_table(spark, combined).select("contract_id", "plan_id", "src_file_date", "enrollment", "organization_type").collect()))

    assert P.cpsc_combined(spark, enroll, contract, combined) == 4
    before = files()
    assert P.cpsc_combined(spark, enroll, contract, combined) == 0 and files() == before
    day = dt.date(2024, 2, 1)
    late = snk.read_table(spark, contract).where("src_file_date = '2024-02-01'").withColumn("organization_type", F.lit("PFFS"))
    snk.replace_slice(late.withColumn("src_file_date", F.col("src_file_date").cast("date")), contract, "src_file_date", value=day)
    assert P.cpsc_combined(spark, enroll, contract, combined) == 1
    after = files()
    assert [d for d in before if before[d] != after[d]] == ["src_file_date=2024-02-01"]
    assert [r[4] for r in whole() if r[:3] == ("H1", "001", "2024-02-01")] == ["PFFS"]
    snk.remove_slice(spark, enroll, "src_file_date", dt.date(2024, 1, 1))
    snk.remove_slice(spark, contract, "src_file_date", dt.date(2024, 1, 1))
    snk.remove_slice(spark, enroll, "src_file_date", dt.date(2024, 4, 1))  # its contracts stay: an empty slice
    assert P.cpsc_combined(spark, enroll, contract, combined) == 2
    assert {r[2] for r in whole()} == {"2024-02-01", "2024-03-01"}
    changed = whole()
    assert P.cpsc_combined(spark, enroll, contract, combined, everything=True) == 3 and whole() == changed


def test_snp_files_of_several_layouts(spark, tmp_dir):
    root, target = os.path.join(tmp_dir, "snp_many"), os.path.join(tmp_dir, "snp_many_t")
    write(f"{root}/SNP_2023_09/a.csv", "Title\nContract Number,Plan ID,Plan Enrollment,Plan Geographic Name,\nH1,001,120,Statewide,\n")
    write(f"{root}/SNP_2023_10/a.csv", "Title\nContract Number\nEnrollment,Contract Number,State\n7,H2,Ohio\n")
    assert P.snpdata(spark, root, target, LOAD) == 2
    rows = {r.contract_number: r for r in snk.read_table(spark, target).collect()}
    assert (rows["H1"].plan_enrollment, rows["H1"].geographic_name, rows["H1"].state) == (120.0, "Statewide", None)
    assert (rows["H2"].plan_enrollment, rows["H2"].state, rows["H2"].src_file_date) == (7.0, "Ohio", dt.date(2023, 10, 1))


def test_plan_directory(spark, tmp_dir):
    src = os.path.join(tmp_dir, "dir")
    write(f"{src}/MA_Contract_directory_2024_03.csv",
          "Contract Number,Legal Entity St2,Enrollment,Contract Effective Date,Directory Contact Last Update\n"
          'H1,Suite 2,"1,234",1/5/2024,12/31/2023\nH2,,*,02/01/2024,1/1/2024\n')
    target = os.path.join(tmp_dir, "directory")
    assert P.mapd_plan_directory(spark, src, target, LOAD) == 1
    rows = {r.contract_number: r for r in snk.read_table(spark, target).collect()}
    assert rows["H1"].enrollment == 1234 and rows["H2"].enrollment is None
    assert rows["H1"].legal_entity_street2 == "Suite 2"
    assert rows["H1"].contract_effective_date == dt.date(2024, 1, 5)
    assert rows["H1"].src_file_date == dt.date(2024, 3, 1)


def test_plan_crosswalk(spark, tmp_dir):
    root = os.path.join(tmp_dir, "crosswalk")
    write(f"{root}/Crosswalk_2024/PlanCrosswalk2024_01022024.xlsx/0__Sheet1.csv",
          "Previous Contract ID,Previous Plan ID,Current Contract ID,Current Plan ID,Description\n"
          "H1,1,H1,001,Renewal\nH2,1234,H2,,Terminated\nH3,-1,H3,01,New\n")
    target = os.path.join(tmp_dir, "crosswalk_t")
    assert P.plan_crosswalk(spark, root, target, LOAD) == 1
    assert P.plan_crosswalk(spark, root, target, LOAD) == 0
    rows = {r.previous_contract_id: r for r in snk.read_table(spark, target).collect()}
    assert rows["H1"].previous_plan_id == "001" and rows["H1"].current_plan_id == "001"
    assert rows["H2"].previous_plan_id == "1234" and rows["H2"].current_plan_id is None
    assert rows["H3"].previous_plan_id == "-01" and rows["H3"].current_plan_id == "001"
    assert rows["H1"].status == "Renewal"
    assert rows["H1"].performance_date_start == dt.date(2024, 1, 1)
    assert rows["H1"].performance_date_end == dt.date(2024, 12, 31)
    assert rows["H1"].src_file_date == dt.date(2024, 1, 2)


def test_snpdata_header_detection(spark, tmp_dir):
    root = os.path.join(tmp_dir, "snp")
    write(f"{root}/SNP_2024_03/SNP_Comprehensive_Report.csv",
          "Special Needs Plan Report\nMarch 2024\n\n"
          "Contract Number,Plan ID,Plan Enrollment,Plan Geographic Name,\n"
          "H1,001,120,Statewide,\nH2,002,*,County,\n")
    write(f"{root}/SNP_2024_03/Raw_data.csv", "junk\n")
    target = os.path.join(tmp_dir, "snp_t")
    assert P.snpdata(spark, root, target, LOAD) == 1
    rows = {r.contract_number: r for r in snk.read_table(spark, target).collect()}
    assert rows["H1"].plan_enrollment == 120.0 and rows["H2"].plan_enrollment is None
    assert rows["H1"].geographic_name == "Statewide"
    assert not any(c.startswith("unnamed") for c in snk.read_table(spark, target).columns)
    assert rows["H1"].src_file_date == dt.date(2024, 3, 1)


def test_bad_strict_date_fails_the_load(spark, tmp_dir):
    import pytest
    src = os.path.join(tmp_dir, "dir_bad")
    write(f"{src}/MA_Contract_directory_2024_04.csv",
          "Contract Number,Legal Entity St2,Enrollment,Contract Effective Date,Directory Contact Last Update\n"
          "H1,,1,13/45/2024,1/1/2024\n")
    with pytest.raises(Exception):
        P.mapd_plan_directory(spark, src, os.path.join(tmp_dir, "directory_bad"), LOAD)


def test_missing_header_row_fails_the_load(spark, tmp_dir):
    import pytest
    root = os.path.join(tmp_dir, "snp_bad")
    write(f"{root}/SNP_2024_05/SNP_Report.csv", "Title only\nno header here\nH1,001,5\n")
    with pytest.raises(Exception, match="no header row"):
        P.snpdata(spark, root, os.path.join(tmp_dir, "snp_bad_t"), LOAD)
