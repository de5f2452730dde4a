"""Workbook, landscape, benefit and streaming recipes over file fixtures
(FIXTURES.md 2.3, 2.4, 2.7, 2.8, 2.11, 2.12, 2.13)."""

import datetime as dt
import json
import os

from pyspark.sql import types as T

from pyspark.sql import functions as F

from tidemark.plans import benefits as B
from tidemark.plans import reports as R
from tidemark.sinks import tables as snk
from tidemark.sources import files as src
from tidemark.streaming.file_loader import run_csv_load

LOAD = dt.date(2024, 5, 1)


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_payment_county_swap_and_msa(spark, tmp_dir):
    root = os.path.join(tmp_dir, "pay")
    # 2024 workbook: two sheets, the "result" one is picked; score/payment swapped
    write(f"{root}/2024PartCCountyLevel.xlsx/0__notes.csv", "a\nb\n")
    write(f"{root}/2024PartCCountyLevel.xlsx/1__result.csv",
          "c1,c2,c3,c4,c5,c6,c7,c8,c9\n1001,AL,Autauga,HMO,,900.5,1.02,50,\n2,AK,X,PPO,,950,0.98,40,12\n")
    write(f"{root}/2023PartCCountyLevel.xlsx/0__Sheet1.csv",
          "c1,c2,c3,c4,c5,c6,c7,c8\n1001,AL,Autauga,HMO,,1.05,880.25,30\n")
    chosen = src.pick_sheet(src.list_sheets(spark, root), "result")
    got = {r.workbook: r.sheet_index for r in chosen.collect()}
    assert got == {"2024PartCCountyLevel.xlsx": 1, "2023PartCCountyLevel.xlsx": 0}
    s24 = src.read_sheets(spark, root, "result")
    out = {r.county_code: r for r in R.payment_county(s24, LOAD).collect()}
    assert out["01001"].avg_risk_score == 1.02 and out["01001"].avg_ab_pmpm_payment == 900.5
    assert out["00002"].avg_msa_monthly_deposit_payment == 12.0
    assert out["01001"].src_file_date == dt.date(2024, 12, 31)
    s23 = src.read_sheets(spark, root, "Sheet1")
    r23 = R.payment_county(s23, LOAD).collect()[0]
    assert r23.avg_risk_score == 1.05 and "avg_msa_monthly_deposit_payment" not in R.payment_county(s23, LOAD).columns


def test_reconciliation_totals(spark, tmp_dir):
    root = os.path.join(tmp_dir, "rec")
    write(f"{root}/PD23Reconciliation.xlsx/0__contract.csv",
          "a,b,c,d,e,f,g\nH1,Plan,2,100.5,1,2,3\nTotals,,,999,,,\n,Null label,1,5,,,\n")
    write(f"{root}/PD23Reconciliation.xlsx/1__parent.csv",
          "a,b,c,d,e,f\nParent A,3,10,1,2,3\nTotals,3,10,1,2,3\n")
    out = R.reconciliation(src.read_sheets(spark, root, 0), LOAD).collect()
    assert sorted(r.contract_name for r in out) == ["Null label", "Plan"]
    assert {r.src_file_date for r in out} == {dt.date(2023, 12, 31)}
    parent = R.reconciliation_parent(src.read_sheets(spark, root, 1), LOAD).collect()
    assert [(r.parent_organization_name, r.reconciliation_amount) for r in parent] == [("Parent A", 10.0)]


def test_lis_and_mpf(spark, tmp_dir):
    root = os.path.join(tmp_dir, "lis")
    for i in range(2):
        write(f"{root}/LIS by Contract 2015.xlsx/{i}__S{i}.csv",
              'a,b,c,d,e,f\nH1,Plan,001,PBP,"1,234",56\n')
    out = R.lis_enrollment(src.read_sheets(spark, root), 2015, LOAD).collect()
    assert len(out) == 2 and out[0].enrolled == 1234 and out[0].src_file_date == dt.date(2015, 12, 31)
    mroot = os.path.join(tmp_dir, "mpf")
    write(f"{mroot}/MPF_Benefit_CY2024.xlsx/0__Sheet1.csv", "Service Name,Copay\nDental,$5\n")
    m = R.mpf_benefit_summary(src.read_sheets(spark, mroot), LOAD).collect()[0]
    assert m.service_desc == "Dental" and m.src_file_date == dt.date(2024, 1, 1)


def test_hedis_measures(spark, tmp_dir):
    root = os.path.join(tmp_dir, "hedis")
    write(f"{root}/HEDIS2024.xlsx/0__hedis_measures.csv",
          "CMSContractNumber,MeasureCode,IndicatorKey,Rate,Lcl,Ucl,Numerator,Denominator\n"
          "H1,BCS,bcs_rate,0.81,0.7,0.9,81,100\nH2,BCS,bcs_rate,NQ,,,,\nH3,BCS,bcs_rate,NA,,,,\n")
    write(f"{root}/HEDIS2024.xlsx/1__hedishos_frm.csv", "ContractNumber,Rate1,Rate2\nH1,NR,0.5\n")
    write(f"{root}/MADictionary2024.xlsx/0__Sheet1.csv",
          "MeasureCode,IndicatorKey,MeasureName,ShortIndicatorName\nBCS,bcs_rate,Breast,BCS\n"
          "BCS,bcs_rate,Breast,BCS\nFRM,managing_fall_risk_rate,Falls,FRM\n")
    meas = src.read_sheets(spark, root, "hedis_measures")
    frm = src.read_sheets(spark, root, "hedishos_frm")
    write(f"{root}/HEDIS2024.xlsx/2__hedishos_pao.csv", "ContractNumber,Rate1,Rate2\nH1,0.4,0.3\n")
    write(f"{root}/HEDIS2024.xlsx/3__hedishos_mui.csv", "ContractNumber,Rate1,Rate2,Rate3\nH1,0.1,0.2,0.9\n")
    pao, mui = src.read_sheets(spark, root, "hedishos_pao"), src.read_sheets(spark, root, "hedishos_mui")
    dic = src.read_sheets(spark, os.path.join(root, "MADictionary2024.xlsx"), 0)
    out = {(r.contract_number, r.indicator_key): r
           for r in R.hedis_measures(meas, {"FRM": frm, "PAO-HOS": pao, "MUI-HOS": mui}, dic, 2024, LOAD, "HEDIS2024.xlsx").collect()}
    assert len(out) == 10
    assert out[("H1", "impact_of_urinary_incontinence_rate")].rate == 0.9
    assert out[("H1", "advising_physical_activity_rate")].measure_code == "PAO-HOS"
    h1 = out[("H1", "bcs_rate")]
    assert h1.rate == 0.81 and h1.measure_name == "Breast" and not h1.rate_nq
    assert out[("H2", "bcs_rate")].rate_nq and out[("H2", "bcs_rate")].rate is None
    assert out[("H1", "discussing_fall_risk_rate")].rate_nr  # flag from the raw HOS text
    assert out[("H1", "managing_fall_risk_rate")].measure_name == "Falls"
    assert out[("H1", "discussing_fall_risk_rate")].measure_name is None


def test_landscape_after_2024(spark, tmp_dir):
    hist = spark.createDataFrame([("Humana Inc.",)] * 5 + [("HUMANA INC",)] * 2 + [("Humama Inc",)]
                                 + [("Aetna Life",)] * 3 + [("Aetna Lfe",)], "organization_name STRING")
    mapping = R.organization_names(hist)
    m = {r.raw_name: r.canonical_name for r in mapping.collect()}
    assert m["HUMANA INC"] == "Humana Inc." and m["Aetna Lfe"] == "Aetna Life"
    path = os.path.join(tmp_dir, "land", "CY2026_Landscape_202509.csv")
    write(path, "Contract Category Type,Parent Organization Name,Plan Type,Monthly Premium,Drug Benefit Type\n"
                "MA,Aetna Lfe,PPO D-SNP,$12.30,Basic\nPDP,Humama Inc,PDP,($5.00),Enhanced\n"
                "SNP,New Org,HMO,\"$1,234\",Basic\n")
    target = T.StructType([T.StructField("contract_category_type", T.StringType()),
                           T.StructField("organization_name", T.StringType()),
                           T.StructField("plan_type", T.StringType()),
                           T.StructField("monthly_premium", T.DoubleType()),
                           T.StructField("benefit_type", T.StringType()),
                           T.StructField("star_rating", T.DoubleType())])
    df = src.read_csv_text(spark, path)
    out, missing = R.landscape(df, target, mapping, "CY2026_Landscape_202509.csv", 2026, LOAD)
    assert missing == ["star_rating"]
    rows = {r.contract_category_type: r for r in out.collect()}
    assert rows["MA"].organization_name == "Aetna Life" and rows["MA"].plan_type == "Local PPO"
    assert rows["PDP"].monthly_premium == -5.0 and rows["SNP"].monthly_premium == 1234.0
    assert rows["PDP"].organization_name == "Humana Inc." and rows["SNP"].organization_name == "New Org"
    routes = R.route_landscape(out)
    assert {k: v.count() for k, v in routes.items()} == {
        "landscape_medicare_advantage": 1, "landscape_prescription_drug_plan": 1, "landscape_special_needs_plan": 1}


def test_landscape_before_2024(spark, tmp_dir):
    path = os.path.join(tmp_dir, "old", "2023LandscapeSource.csv")
    write(path, "Title\nSubtitle\nState,Drug Benefit Type,Drug Benefit Type,Monthly Premium,\n"
                "AL,Basic,Enhanced,$12.30,\n,,,,\nAK,Basic,Basic,Not Applicable,\n")
    out = R.landscape_before_2024(spark, [path], 2, 2023, ["monthly_premium"], LOAD)
    assert "drug_benefit_type1" in out.columns and not any(c.startswith("unnamed") for c in out.columns)
    rows = {r.state: r for r in out.collect()}
    assert set(rows) == {"AL", "AK"}
    assert rows["AL"].monthly_premium == 12.3 and rows["AK"].monthly_premium is None
    assert rows["AL"].src_file_date == dt.date(2023, 1, 1)


def test_benefit_tables(spark, tmp_dir):
    root = os.path.join(tmp_dir, "ben")
    write(f"{root}/pbp-benefits-2024-quarter-3/pbp_b1.txt",
          'pbp_a_hnumber\tversion\tpbp_b1_amt\tpbp_b1_note\tempty\nH1\t1\t1,234\tsays "hi" é\t\n',
          "latin-1")
    write(f"{root}/pbp-benefits-2024/pbp_b1.txt", "pbp_a_hnumber\tpbp_b1_amt\nH1\t5\n", "latin-1")
    write(f"{root}/pbp-other-shape-2024-x-y-z/pbp_b1.txt", "x\n1\n", "latin-1")
    write(f"{root}/pbp-benefits-2024-quarter-2/pbp_b1.txt", "pbp_a_hnumber\tpbp_b1_amt\n", "latin-1")  # empty
    files = B.latest_files(spark, root, "pbp_b1.txt", since=dt.date(2024, 1, 1))
    assert sorted(r.src_file_date for r in files.collect()) == [dt.date(2024, 1, 1), dt.date(2024, 4, 1),
                                                                dt.date(2024, 7, 1)]
    dictionary = spark.createDataFrame(
        [("pbp_b1", "pbp_b1_amt", "NUM"), ("pbp_b1", "version", "NUM"), ("pbp_b1", "empty", "NUM"),
         ("pbp_b1", "pbp_b1_note", "CHAR")], "file STRING, name STRING, type STRING")
    target = os.path.join(tmp_dir, "pbp_b1")
    assert B.dictionary_typed(spark, files, dictionary, "pbp_b1", target, LOAD) == 2  # the empty file is skipped
    rows = {r.src_file_date: r for r in snk.read_table(spark, target).collect()}
    q3 = rows["2024-07-01"]
    assert q3.pbp_b1_amt == 1234.0 and q3.version == "1" and q3.pbp_b1_note == 'says "hi" é'
    assert q3.src_file_name == "pbp-benefits-2024-quarter-3/pbp_b1.txt"
    assert rows["2024-01-01"].pbp_b1_amt == 5.0


def test_snapshots_load_in_a_fixed_number_of_jobs(spark, tmp_dir):
    """Layouts and numbers differ from file to file; all files of a table are
    one read, one count and one write."""
    dictionary = spark.createDataFrame([("pbp_b1", "amt", "NUM"), ("pbp_b1", "n", "NUM"), ("pbp_b1", "note", "CHAR")],
                                       "file STRING, name STRING, type STRING")
    heads = (["hnumber", "amt", "note"], ["NOTE", "hnumber", "extra"], ["n", "amt", "hnumber"])
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for snapshots in (3, 11):
        root, target = os.path.join(tmp_dir, f"in{snapshots}"), os.path.join(tmp_dir, f"t{snapshots}")
        for k in range(snapshots):
            head = heads[k % 3]
            line = "\t".join({"amt": f"1,{k:03d}", "n": str(k), "extra": "x"}.get(h.lower(), f"{h.lower()} {k}") for h in head)
            write(f"{root}/pbp-benefits-{2010 + k}/pbp_b1.txt", "\t".join(head) + "\n" + line + "\n", "latin-1")
        spark.sparkContext.setJobGroup(f"snapshots {snapshots}", "")
        files = B.latest_files(spark, root, "pbp_b1.txt")
        assert B.dictionary_typed(spark, files, dictionary, "pbp_b1", target, LOAD) == snapshots
        jobs.append(len(tracker.getJobIdsForGroup(f"snapshots {snapshots}")))
        rows = {r.src_file_date: r for r in snk.read_table(spark, target).collect()}
        for k in range(snapshots):
            r = rows[f"{2010 + k}-01-01"]
            have = {h.lower() for h in heads[k % 3]}
            assert r.hnumber == f"hnumber {k}" and r.src_file_name == f"pbp-benefits-{2010 + k}/pbp_b1.txt"
            assert r.amt == (1000.0 + k if "amt" in have else None) and r.n == (float(k) if "n" in have else None)
            assert r.note == (f"note {k}" if "note" in have else None) and r.extra == ("x" if "extra" in have else None)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1], jobs


def test_section_a_times(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pbp-benefits-2024", "pbp_Section_A.txt")
    write(path, "PBP_A_HNUMBER\tPBP_A_SNP_PCT\tPBP_A_ENTRY_TIME\tPBP_A_COUNT\n"
                "H1\t12.5\t01/02/2024 03:04:05 PM Central Standard Time\t1,200\n"
                "H2\t0\t01/02/2024 03:04:05 PM\t3\n"
                "H3\t1\t02-Jan-24\t4\n"
                "H4\t2\t01/02/2024 03:04:05 PM Unknown Zone\t5\n", "latin-1")
    dictionary = spark.createDataFrame([("pbp_Section_A", "pbp_a_count", "NUM"),
                                        ("pbp_Section_A", "pbp_a_count", "CHAR")], "file STRING, name STRING, type STRING")
    out = B.section_a(src.read_tsv_text(spark, path, with_path=False), dictionary, dt.date(2024, 1, 1), LOAD)
    rows = {r.pbp_a_hnumber: r for r in out.collect()}
    assert rows["H1"].pbp_a_count == 1200.0 and rows["H1"].pbp_a_snp_pct == 12.5
    assert rows["H1"].pbp_a_entry_time == dt.datetime(2024, 1, 2, 21, 4, 5)
    assert rows["H2"].pbp_a_entry_time == dt.datetime(2024, 1, 2, 20, 4, 5)  # Eastern by default
    assert rows["H3"].pbp_a_entry_time == dt.datetime(2024, 1, 2, 0, 0)
    assert rows["H4"].pbp_a_entry_time is None
    assert rows["H1"].src_file_name == "pbp-benefits-2024/pbp_Section_A.txt"


def test_benefit_documents(spark, tmp_dir):
    docs_dir = os.path.join(tmp_dir, "json-2024")
    doc1 = {"contractYear": 2024, "pbp": [
        {"contractId": "H1", "planId": "001", "segmentId": "0", "note": "",
         "planCharacteristics": {"planName": "Gold", "note": None, "contractId": "H1"},
         "benefits": [{"categoryCode": "RICS", "items": [{"categoryCode": "X9", "v": None}], "tags": []},
                      {"categoryCode": "ZZ", "items": [], "tags": ["", None]}]},
        {"contractId": "H2", "planId": "002", "segmentId": "0", "note": "keep",
         "planCharacteristics": {"planName": "", "note": "n", "contractId": "H2"},
         "benefits": []}]}
    doc2 = {"contractYear": 2024, "pbp": []}
    write(f"{docs_dir}/a.json", json.dumps(doc1))
    write(f"{docs_dir}/b.json", json.dumps(doc2))
    docs = src.read_json_docs(spark, docs_dir)
    meta = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "Opt Sup Deduct Cats", "X9: Extra: nine; RICS: Reduced"),
         (dt.date(2023, 1, 1), "Opt Sup Deduct Cats", "X9: old")],
        "src_file_date DATE, title STRING, code_and_values STRING")
    labels = B.category_labels(meta, 2024, {"RICS": "Reductions in Cost Sharing", "ZZ": "Zed"})
    lab = {r.code: r.label for r in labels.collect()}
    assert lab == {"RICS": "Reduced", "X9": "Extra: nine", "ZZ": "Zed"}
    out = {r.contractId: json.loads(r.document) for r in B.benefit_documents(docs, labels).collect()}
    assert set(out) == {"H1", "H2"}
    h1 = out["H1"]
    assert "note" not in h1 and h1["planName"] == "Gold" and h1["contractYear"] == 2024
    assert h1["benefits"][0]["categoryCode"] == "Reduced"
    assert h1["benefits"][0]["items"][0] == {"categoryCode": "Extra: nine"}
    assert h1["benefits"][1]["categoryCode"] == "Zed" and h1["benefits"][1]["items"] == []
    assert h1["benefits"][1]["tags"] == ["", None]
    assert out["H2"]["note"] == "n" and "planName" not in out["H2"] and out["H2"]["benefits"] == []
    target = os.path.join(tmp_dir, "docs_out")
    B.export_documents(B.benefit_documents(docs, labels), target)
    assert snk.read_table(spark, target).count() == 2


def test_streaming_incremental_load(spark, tmp_dir):
    src_dir = os.path.join(tmp_dir, "landing")
    target = os.path.join(tmp_dir, "stream_table")
    ckpt = os.path.join(tmp_dir, "ckpt")
    write(f"{src_dir}/dir_2024_01.csv", "Contract,Enrollment\nH1,10\nH2,20\n")
    write(f"{src_dir}/dir_2024_02.csv", "Contract,Enrollment\nH1,11\n")
    run_csv_load(spark, src_dir, ["Contract", "Enrollment"], target, checkpoint=ckpt)
    assert snk.read_table(spark, target).count() == 3
    write(f"{src_dir}/dir_2024_03.csv", "Contract,Enrollment\nH3,30\n")
    run_csv_load(spark, src_dir, ["Contract", "Enrollment"], target, checkpoint=ckpt)  # only the new file
    other = os.path.join(tmp_dir, "stream_table_default_ckpt")
    run_csv_load(spark, src_dir, ["Contract", "Enrollment"], other)
    write(f"{src_dir}/dir_2024_04.csv", "Contract,Enrollment\nH4,40\n")
    run_csv_load(spark, src_dir, ["Contract", "Enrollment"], other)  # default checkpoint is stable
    assert snk.read_table(spark, other).count() == 5
    t = snk.read_table(spark, target)
    assert t.count() == 4
    assert sorted(r.src_file_name for r in t.select("src_file_name").distinct().collect()) == [
        "dir_2024_01.csv", "dir_2024_02.csv", "dir_2024_03.csv"]


def test_plan_level_payments_and_hedis_sheets(spark, tmp_dir):
    root = os.path.join(tmp_dir, "plans")
    write(f"{root}/2024PartCPlanLevel.xlsx/0__result.csv",
          "a,b,c,d,e,f,g\nH1,001,Plan,HMO,950.5,1.1,20\nH2,002,Plan,PPO,900,0.9,30\n")
    write(f"{root}/2024PartDPlans.xlsx/0__Sheet1.csv", "a,b,c,d,e,f,g,h\nS1,001,Plan,PDP,10,0.95,5,2\n")
    c = {r.contract_number: r for r in R.payment_plan_partc(src.read_sheets(spark, root, "result"), LOAD).collect()}
    assert c["H1"].avg_partc_risk_score == 1.1 and c["H1"].avg_ab_pmpm_payment == 950.5
    d = R.payment_plan_partd(src.read_sheets(spark, root, "Sheet1"), LOAD).collect()[0]
    assert d.avg_partd_risk_score == 0.95 and d.src_file_date == dt.date(2024, 12, 31)
    h = os.path.join(tmp_dir, "hedis2")
    write(f"{h}/HEDIS2024.xlsx/0__hedis_rau_measures.csv",
          "CMSContractNumber,MeasureCode,IndicatorKey,Denominator,ObservedCount\nH1,AHU,ahu_rate,100,x\n")
    write(f"{h}/HEDIS2024.xlsx/1__general.csv", "CMSContractNumber,General-0010,General-0050\nH1,HMO,1200\n")
    write(f"{h}/HEDIS2024.xlsx/2__national_rates.csv", "N-R0010,N-R0020,N-R0050\n2024,BCS,0.7\n")
    write(f"{h}/MADictionary2024.xlsx/0__Sheet1.csv",
          "MeasureCode,IndicatorKey,MeasureName,ShortIndicatorName\nAHU,ahu_rate,Acute,AHU\n")
    dic = src.read_sheets(spark, os.path.join(h, "MADictionary2024.xlsx"), 0)
    rau = R.hedis_rau(src.read_sheets(spark, h, "hedis_rau_measures"), dic, 2024, LOAD, "HEDIS2024.xlsx").collect()[0]
    assert rau.contract_number == "H1" and rau.denominator == 100.0 and rau.measure_name == "Acute"
    gen = R.hedis_general(src.read_sheets(spark, h, "general"), 2024, LOAD, "HEDIS2024.xlsx").collect()[0]
    assert gen.organization_type == "HMO" and gen.enrollment_yearend == 1200.0 and gen.contract_number == "H1"
    nat = R.hedis_national_rates(src.read_sheets(spark, h, "national_rates"), 2024, LOAD, "HEDIS2024.xlsx")
    row = nat.collect()[0]
    assert row.measure_code == "BCS" and row.rate == "0.7" and row.hedis_year == "2024"


def test_landscape_premium_report(spark, tmp_dir):
    old = os.path.join(tmp_dir, "prem", "CY2023_Landscape_Plan_Premium_Report_20221001.csv")
    new = os.path.join(tmp_dir, "prem", "CY2024_Landscape_Plan_Premium_Report_20231001.csv")
    write(old, "t1\nt2\nt3\nState,Part C Premium2,Star Rating Part D,Overall Star Rating\nAL,$1.50,4,Not Applicable\n",
          "latin-1")
    write(new, "State,Part C Premium,2024 Star Rating Part D,2024 Overall Star Rating\nAK,($2.00),3.5,4\n", "latin-1")
    rows = {r.state: r for r in R.landscape_premium_report(spark, [old, new], LOAD).collect()}
    assert rows["AL"].part_c_premium == 1.5 and rows["AL"].star_rating_part_d == 4.0
    assert rows["AL"].overall_star_rating is None and rows["AL"].src_file_date == dt.date(2023, 1, 1)
    assert rows["AK"].part_c_premium == -2.0 and rows["AK"].overall_star_rating == 4.0


def test_landscape_tables_before_2024(spark, tmp_dir):
    root = os.path.join(tmp_dir, "closed")
    write(f"{root}/CY2023_Landscape_MA_20221014.csv", "a\n" * 5 + "State,In-Network MOOP Amount,Overall Star Rating\nAL,$500,4\n", "latin-1")
    write(f"{root}/CY2024_Landscape_MA_20230801.csv", "State,2024 Overall Star Rating\nAK,3.5\n", "latin-1")
    write(f"{root}/CY2024_Landscape_PDP_20230801.csv", "State,Organization Name,2024 Star Rating Part D\nAK,Org,3\n", "latin-1")
    for day, n in (("20221014", 6), ("20220930", 4), ("20230801", 0)):
        write(f"{root}/CY2023_Landscape_SNP_{day}.csv", "t\n" * n + f"State,Drug Benefit Type,Drug Benefit Type\n{day},x,y\n", "latin-1")
    target = os.path.join(tmp_dir, "ma_closed")
    assert R.load_landscape_before_2024(spark, root, "landscape_medicare_advantage", target, LOAD) == 2
    ma = {r.state: r for r in snk.read_table(spark, target).collect()}
    assert ma["AL"].innetwork_moop_amount == 500.0 and ma["AK"].overall_star_rating == 3.5
    paths = [r[0] for r in src.list_files(spark, root, "*_PDP_*").select("path").collect()]
    pdp = R.landscape_table_before_2024(spark, paths, "landscape_prescription_drug_plan", LOAD).first()
    assert pdp.company_name == "Org" and pdp.summary_star_rating == 3.0
    paths = [r[0] for r in src.list_files(spark, root, "*_SNP_*").select("path").collect()]
    snp = R.landscape_table_before_2024(spark, paths, "landscape_special_needs_plan", LOAD).collect()
    assert {(r.state, r.drug_benefit_type, r.drug_benefit_type_detail) for r in snp} == {(d, "x", "y") for d in ("20221014", "20220930", "20230801")}


def test_benefit_tables_and_plan_areas_end_to_end(spark, tmp_dir):
    root = os.path.join(tmp_dir, "pbp")
    write(f"{root}/pbp-benefits-2024/pbp_mrx.txt", "pbp_a_hnumber\tmrx_formulary_tiers_num\nH1\t1,005\n", "latin-1")
    write(f"{root}/pbp-benefits-2024/PlanArea.txt", "contract_id\tcontract_year\tnote\nH1\t2024\t\n", "latin-1")
    d = spark.createDataFrame([("pbp_mrx", "mrx_formulary_tiers_num", "CHAR"), ("pbp_mrx", "pbp_a_hnumber", "CHAR")],
                              "file STRING, name STRING, type STRING")
    target = os.path.join(tmp_dir, "mrx")
    assert "pbp_mrx" in B.BENEFIT_TABLES and len(B.BENEFIT_TABLES) == 18
    assert B.load_benefit_table(spark, root, "pbp_mrx", d, target, LOAD) == 1
    assert snk.read_table(spark, target).first().mrx_formulary_tiers_num == 1005.0
    area = os.path.join(tmp_dir, "area")
    assert B.load_snapshots(spark, root, "PlanArea", area, lambda t, day: B.plan_area(t, day, LOAD)) == 1
    assert snk.read_table(spark, area).first().contract_year == 2024


def test_last_file_wins_among_documents_of_a_plan(spark, tmp_dir):
    docs = spark.createDataFrame([("H1", "1", "0", 2025, '{"v":1}', "a/2.json"), ("H1", "1", "0", 2025, '{"v":2}', "a/1.json")],
                                 "contractId STRING, planId STRING, segmentId STRING, contractYear INT, document STRING, src_file_path STRING")
    target = os.path.join(tmp_dir, "docs")
    B.export_documents(docs, target)
    assert [r.document for r in snk.read_table(spark, target).collect()] == ['{"v":1}']


def test_workbook_tables_load_new_workbooks_alone(spark, tmp_dir):
    root, target = os.path.join(tmp_dir, "books"), os.path.join(tmp_dir, "lis_table")
    sheet, table = R.WORKBOOK_TABLES["lis_enrollment_by_plan"]
    load = lambda: R.load_workbooks(spark, root, target, sheet, table, LOAD)
    for i in range(2):
        write(f"{root}/LIS by Contract 2015.xlsx/{i}__S{i}.csv", 'a,b,c,d,e,f\nH1,Plan,001,PBP,"1,234",56\n')
    assert load() == 1 and load() == 0
    write(f"{root}/LIS by Contract 2016.xlsx/0__S0.csv", "a,b,c,d,e,f\nH2,Plan,001,PBP,1,2\n")
    assert load() == 1
    rows = snk.read_table(spark, target).collect()
    assert sorted((r.contract_id, r.src_file_date.year) for r in rows) == [("H1", 2015), ("H1", 2015), ("H2", 2016)]


def test_default_category_labels(spark):
    meta = spark.createDataFrame([(dt.date(2025, 1, 1), "Opt Sup Deduct Cats", "13b: Over-the-counter items")],
                                 "src_file_date DATE, title STRING, code_and_values STRING")
    lab = {r.code: r.label for r in B.category_labels(meta, 2025).collect()}
    assert lab["13b"] == "Over-the-counter items" and lab["RICS"] == "Reductions in Cost Sharing"
    assert lab["1a"] == "Inpatient Hospital - Acute" and len(lab) == 93


def test_landscape_end_to_end_and_hedis_pairs(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "land2", "CY2026_Landscape_202509.csv")
    write(csv, "Contract Category Type,Parent Organization Name,Plan Type,Monthly Premium\n"
               "MA,Aetna Lfe,PPO,$12.30\nPDP,Café Inc.,PDP,($5.00)\nSNP,X,HMO,$1\nOTHER,Y,HMO,$2\n", "utf-8")
    targets = {}
    for t, cols in [("landscape_medicare_advantage", "monthly_premium DOUBLE, organization_name STRING, type_of_medicare_health_plan STRING"),
                    ("landscape_plan_premium_report", "monthly_premium DOUBLE, organization_name STRING, plan_type STRING"),
                    ("landscape_prescription_drug_plan", "monthly_premium DOUBLE, company_name STRING")]:
        path = os.path.join(tmp_dir, t)
        spark.createDataFrame([], f"{cols}, src_file_date DATE, src_file_name STRING, load_date DATE") \
            .write.parquet(path)
        second = cols.split(", ")[1]
        spark.createDataFrame([(1.0, "seed", "2020.csv")], f"monthly_premium DOUBLE, {second}, src_file_name STRING").write.mode("append").partitionBy("src_file_name").parquet(path)
        targets[t] = path
    hist = spark.createDataFrame([("Aetna Life",)] * 3 + [("Aetna Lfe",)], "organization_name STRING")
    missing = R.load_landscape_after_2024(spark, csv, targets, hist, 2026, LOAD)
    assert missing["landscape_medicare_advantage"] == []
    ma = {r.src_file_name: r for r in snk.read_table(spark, targets["landscape_medicare_advantage"]).collect()}
    new = ma["CY2026_Landscape_202509.csv"]
    assert new.organization_name == "Aetna Life" and new.type_of_medicare_health_plan == "PPO" and new.monthly_premium == 12.3
    report = snk.read_table(spark, targets["landscape_plan_premium_report"]).filter("src_file_name <> '2020.csv'").collect()
    assert sorted((r.organization_name, r.plan_type) for r in report) == [
        ("Aetna Life", "Local PPO"), ("Café Inc.", "Medicare Prescription Drug Plan"), ("X", "HMO"), ("Y", "HMO")]
    pdp = snk.read_table(spark, targets["landscape_prescription_drug_plan"])
    row = pdp.filter(F.col("src_file_name") == "CY2026_Landscape_202509.csv").first()
    assert row.monthly_premium == -5.0 and row.company_name == "Café Inc."
    h = os.path.join(tmp_dir, "pairs")
    for wb in ("HEDIS2024.xlsx", "MADictionary2024.xlsx", "HEDIS2025.xlsx", "MADictionary2025.xlsx",
               "HEDIS2023.xlsx"):
        write(f"{h}/{wb}/0__s.csv", "a\n1\n")
    pairs = {r.year: (r.data, r.dictionary) for r in R.hedis_pairs(spark, h).collect()}
    assert pairs == {"2024": ("HEDIS2024.xlsx", "MADictionary2024.xlsx"),
                     "2025": ("HEDIS2025.xlsx", "MADictionary2025.xlsx")}


def test_payment_workbooks_end_to_end(spark, tmp_dir):
    """Title rows, the sheet of results, a year without header, other files
    beside, equal names in two folders, nothing new in a second run."""
    root, target = os.path.join(tmp_dir, "pay"), os.path.join(tmp_dir, "pay_t")
    title = "A title,,,,,,,\nanother,,,,,,,\n"
    head = "County Code,State,County Name,Plan Type,SNP Plan Type,Avg Risk Score,Avg A/B PMPM Payment,Avg Rebate\n"
    write(f"{root}/one/2024PartCCountyLevel.xlsx/0__notes.csv", "not this\n")
    write(f"{root}/one/2024PartCCountyLevel.xlsx/1__result.csv", title + head + "1001,AL,Autauga,HMO,None,950.5,1.02,88\n1003,AL,Baldwin,HMO,None,901,0.98,70\n")
    write(f"{root}/two/2024PartCCountyLevel.xlsx/0__Sheet1.csv", title + head + "1005,AL,Barbour,PPO,None,1.1,902,12\n")
    write(f"{root}/one/2011PartCCountyLevel.xlsx/0__Sheet1.csv", "1007,AL,Bibb,HMO,None,1.2,800,11,5\n")
    write(f"{root}/one/2024PartCPlanLevel.xlsx/0__Sheet1.csv", title + "x\n")
    load = lambda: R.load_payments(spark, root, target, "partc_payment_county_level", LOAD)
    assert load() == 3 and load() == 0
    rows = {r.county_code: r for r in snk.read_table(spark, target).collect()}
    assert set(rows) == {"01001", "01003", "01005", "01007"}
    assert (rows["01001"].avg_risk_score, rows["01001"].avg_ab_pmpm_payment) == (1.02, 950.5)  # swapped in this file alone
    assert (rows["01005"].avg_risk_score, rows["01005"].avg_ab_pmpm_payment) == (1.1, 902.0)
    assert rows["01005"].src_file_name == "two/2024PartCCountyLevel.xlsx" and rows["01001"].src_file_name == "one/2024PartCCountyLevel.xlsx"
    assert rows["01007"].avg_msa_monthly_deposit_payment == 5.0 and str(rows["01007"].src_file_date) == "2011-12-31"
    write(f"{root}/three/2023PartCCountyLevel.xlsx/0__Sheet1.csv", title + head + "1009,AL,Blount,HMO,None,1.0,700,9\n")
    assert load() == 1


def test_hedis_workbooks_end_to_end(spark, tmp_dir):
    root, measures, rau = (os.path.join(tmp_dir, n) for n in ("hedis_all", "hedis_m", "hedis_r"))

    def year(y, extra=""):
        book = f"{root}/HEDIS{y}.xlsx"
        write(f"{book}/0__hedis_measures.csv", f"CMSContractNumber,MeasureCode,IndicatorKey,Rate,Lcl,Ucl,Numerator,Denominator{extra}\n"
              f"H{y},BCS,bcs_rate,0.8,0.7,0.9,80,100{',x' if extra else ''}\nH9,BCS,bcs_rate,NQ,,,,{',y' if extra else ''}\n")
        write(f"{book}/1__hedishos_frm.csv", f"ContractNumber,Rate1,Rate2\nH{y},NR,0.5\n")
        write(f"{book}/2__hedishos_pao.csv", f"ContractNumber,Rate1,Rate2\nH{y},0.4,0.3\n")
        write(f"{book}/3__hedishos_mui.csv", f"ContractNumber,Rate1,Rate2,Rate3\nH{y},0.1,0.2,0.9\n")
        write(f"{book}/4__hedis_rau_measures.csv", "CMSContractNumber,MeasureCode,IndicatorKey,ObservedCount,ExpectedCount\n"
              f"H{y},PCR,pcr_rate,5,6\n")
        write(f"{root}/MADictionary{y}.xlsx/0__Sheet1.csv", "MeasureCode,IndicatorKey,MeasureName,ShortIndicatorName\n"
              f"BCS,bcs_rate,Breast {y},BCS\nPCR,pcr_rate,Readmission {y},PCR\n")

    year(2024)
    year(2025, ",Extra")
    year(2019)  # before the first year that is loaded
    assert R.load_hedis(spark, root, measures, rau, LOAD) == 2 and R.load_hedis(spark, root, measures, rau, LOAD) == 0
    rows = {(r.contract_number, r.indicator_key): r for r in snk.read_table(spark, measures).where("measure_code = 'BCS' AND contract_number <> 'H9'").collect()}
    assert {k: r.measure_name for k, r in rows.items()} == {("H2024", "bcs_rate"): "Breast 2024", ("H2025", "bcs_rate"): "Breast 2025"}
    assert rows["H2025", "bcs_rate"].src_file_name == "HEDIS2025.xlsx" and rows["H2025", "bcs_rate"].hedis_year == 2025
    assert snk.read_table(spark, measures).count() == 2 * (2 + 2 + 2 + 3)
    assert {(r.contract_number, r.measure_name) for r in snk.read_table(spark, rau).collect()} == {("H2024", "Readmission 2024"), ("H2025", "Readmission 2025")}
    year(2026)
    assert R.load_hedis(spark, root, measures, rau, LOAD) == 1 and snk.read_table(spark, rau).count() == 3
