"""Property tests (parsers never throw; idempotent slice replacement;
unpivot keeps cells; upsert leaves one row per key), link fixtures with
table rows, table comments, and plan-shape checks (no Python UDFs, pushed
filters, broadcast of proven-small sides, no window for one-per-key)."""

import datetime as dt
import os

import pytest

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.functions import scalars as S
from tidemark.operators import aggregates as A
from tidemark.operators import links as L
from tidemark.operators.reshape import melt
from tidemark.plans.catalog import load_all
from tidemark.sinks import tables as snk

TEXT = st.text(alphabet=st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=40)
DIRTY = st.one_of(TEXT, st.sampled_from(["$1,234.50", "($5.00)", "85%", "1.5d", "NaN", "1e400", "-", "",
                                          "02/2025 – 05/2025", "Not Applicable", ">= 62 to < 71", "0.5-0.8",
                                          "01/02/2024 03:04:05 PM Central Standard Time", "02-Jan-24",
                                          "13/45/2024", "99-Xyz-99", " 12 ", "1,2,3"]))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(DIRTY, min_size=1, max_size=30))
def test_parsers_never_throw(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t STRING")
    p = S.parse_period("t")
    r = S.parse_range("t")
    out = df.select(S.parse_money("t"), S.parse_number("t"), S.parse_percent("t"), S.parse_int("t"),
                    S.parse_int_commas("t"), S.zfill("t", 5), S.date_prefix("t"), S.parse_zoned_timestamp("t"),
                    p["start"], p["end"], r["lower"], r["upper"], S.complete_month("t"), S.clean_text("t"),
                    S.null_tokens("t"), S.last_token("t"), S.all_but_last("t"), S.extract_int("t", r"(\d+)"))
    assert len(out.collect()) == len(values)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a.csv", "b.csv", "c.csv"]), st.integers(0, 9)),
                     min_size=1, max_size=20))
def test_replace_slice_twice_equals_once(spark, tmp_path_factory, rows):
    path = str(tmp_path_factory.mktemp("slice"))
    df = spark.createDataFrame(rows, "src_file_name STRING, v INT")
    snk.replace_slice(df, path, "src_file_name")
    once = sorted(map(tuple, snk.read_table(spark, path).select("src_file_name", "v").collect()))
    snk.replace_slice(df, path, "src_file_name")
    twice = sorted(map(tuple, snk.read_table(spark, path).select("src_file_name", "v").collect()))
    assert once == twice == sorted(rows)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 5), st.integers(-3, 3), st.floats(allow_nan=False, width=32)),
                     min_size=1, max_size=25))
def test_upsert_one_row_per_key_and_melt_keeps_cells(spark, tmp_path_factory, rows):
    df = spark.createDataFrame(rows, "k INT, a INT, b DOUBLE")
    long = melt(df, ["k"], {"a": "a_rate", "b": "b_rate"}, value_type="double")
    assert long.count() == 2 * len(rows)
    path = str(tmp_path_factory.mktemp("upsert"))
    snk.upsert(df, path, ["k"], order=[("a", "desc")])
    snk.upsert(df, path, ["k"], order=[("a", "desc")])
    got = snk.read_table(spark, path).collect()
    assert len(got) == len({r[0] for r in rows})
    best = {}
    for k, a, b in rows:
        best[k] = max(best.get(k, a), a)
    assert {r.k: r.a for r in got} == best


def test_one_per_key_matches_window(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    got = A.one_per_key(o, ["o_custkey"], [("o_totalprice", "desc"), ("o_orderkey", "asc")])
    from pyspark.sql import Window as W
    w = W.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    ref = o.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.select(*got.columns).collect()))


PAGE = """<html><body><div class="rxbodyfield"><table><tbody>
<tr><td><a href="/files/benefits-2025">Benefits 2025</a></td><td>Jan 2025</td></tr>
<tr><td><a href="/files/benefits-2022">Benefits 2022</a></td><td>2022</td></tr>
<tr><td><a href="/files/one-cell">One cell</a></td></tr>
<tr><td><a href="/files/snp-2025-05">SNP</a></td><td>2025-05</td></tr>
<tr><td><a href="/files/snp-2024-01">SNP</a></td><td>2024-01</td></tr>
</tbody></table>
<ul><li class="other"><a href="/nope">x</a></li><li class="field__item"><a href="/downloads/dir.zip">Directory</a></li></ul>
<a href="https://cms.example/x/Star_Ratings.zip">2025 Star Ratings &amp; data</a>
<a href="/y/Measures.zip">Display Measures</a><a href="/z/notes.pdf">Ratings notes</a>
<p>Intro</p><p><strong>Report period:</strong> March 2025</p></div></body></html>"""


def test_links_tables(spark):
    pages = spark.createDataFrame([(1, "https://cms.example/page/a", PAGE)], "page_id LONG, url STRING, html STRING")
    rows = {r.href for r in L.recent_rows(pages, as_of_year=2025).collect()}
    # two cells and the last one ending in a year >= 2024; "2025-05" does not end in a year
    assert rows == {"/files/benefits-2025"}
    months = {r.href for r in L.recent_months(pages, as_of=dt.date(2025, 6, 30)).collect()}
    assert months == {"/files/snp-2025-05"}
    links = L.extract_links(pages)
    zips = L.filter_links(links).select(L.absolute_link("href", L.site_root("url")).alias("u"), "link_text")
    got = {(r.u, r.link_text) for r in zips.collect()}
    assert got == {("https://cms.example/x/Star_Ratings.zip", "2025 Star Ratings & data"),
                   ("https://cms.example/y/Measures.zip", "Display Measures")}
    one = pages.select(L.item_link("html").alias("l"), L.last_paragraph("html").alias("p")).first()
    assert one.l == "/downloads/dir.zip" and one.p == "March 2025"
    name = pages.select(L.stamped_name(L.item_link("html"), L.last_paragraph("html")).alias("n")).first().n
    assert name == "dir-March 2025.zip"


def test_comments(spark, tmp_dir):
    path = os.path.join(tmp_dir, "commented")
    spark.createDataFrame([(1, "a")], "pbp_a_hnumber INT, pbp_a_name STRING").write.parquet(path)
    spark.sql(f"CREATE TABLE tm_commented USING parquet LOCATION '{path}'")
    try:
        d = spark.createDataFrame([("pbp_a_hnumber", "Section A", "Contract number"),
                                   ("pbp_a_name", "Section A", "Plan's name")], "name STRING, title STRING, field_title STRING")
        snk.comment_columns(spark, "tm_commented", snk.dictionary_comments(d))
        snk.comment_table(spark, "tm_commented", "Plan benefit package, Section A")
        cols = {c.name: c.description for c in spark.catalog.listColumns("tm_commented")}
        assert cols == {"pbp_a_hnumber": "Section A; Contract number", "pbp_a_name": "Section A; Plan's name"}
        desc = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED tm_commented").collect()}
        assert desc.get("Comment") == "Plan benefit package, Section A"
    finally:
        spark.sql("DROP TABLE IF EXISTS tm_commented")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_python_udfs_and_push_filters(spark):
    reg = load_all()
    for name in ("parse_money", "cpsc_combined", "one_per_key", "matrix_to_long", "canonical_names",
                 "extract_links", "remap_field_deep", "for_year"):
        plan = _plan(reg[name].fn(spark, SF_SMALL))
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
    plan = _plan(reg["for_year"].fn(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_one_per_key_has_no_window_and_dictionary_broadcasts(spark):
    reg = load_all()
    plan = _plan(reg["one_per_key"].fn(spark, SF_SMALL))
    assert "Window" not in plan and "partial_min" in plan
    plan = _plan(reg["attach_dictionary"].fn(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(90, 110).map(float))),
                     min_size=1, max_size=30))
def test_median_exceeds_matches_exact_median(spark, rows):
    df = spark.createDataFrame(rows, "g INT, x DOUBLE")
    got = {r.g: r.median_exceeds for r in A.median_exceeds(df, ["g"], "x", 100.0).collect()}
    exact = {r.g: (r.m is not None and r.m > 100.0) for r in df.groupBy("g").agg(F.median("x").alias("m")).collect()}
    assert got == exact


def test_quarter_start_rules(spark):
    from tidemark.functions.dates import quarter_start
    rows = [("pbp-benefits-2024-quarter-3",), ("pbp-benefits-2024",), ("a-quarter-2023",),
            ("pbp-benefits-2024-extra-x",), ("pbp-benefits",)]
    got = [r[0] for r in spark.createDataFrame(rows, "f STRING").select(quarter_start("f")).collect()]
    assert got == [dt.date(2024, 7, 1), dt.date(2024, 1, 1), dt.date(2023, 1, 1), None, None]


def test_paren_text_date_forms(spark):
    from tidemark.functions.dates import paren_text_date
    names = [("x (Oct 11 2023).csv",), ("x (October 11, 2023).csv",), ("x (10/11/2023).csv",),
             ("x (2023-10-11).csv",), ("x (no date).csv",), ("x.csv",)]
    got = [r[0] for r in spark.createDataFrame(names, "n STRING").select(paren_text_date("n")).collect()]
    assert got == [dt.date(2023, 10, 11)] * 4 + [None, None]


def test_swap_broken_off_anywhere_keeps_all_rows(spark, tmp_dir):
    import shutil
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k INT, v STRING")
    more = spark.createDataFrame([(4, "d")], "k INT, v STRING")
    for state in ("moved aside", "both written", "old left"):
        path = os.path.join(tmp_dir, state.replace(" ", "_"))
        snk.upsert(one, path, ["k"])
        if state == "moved aside":  # staging not whole yet
            os.rename(path, path + ".__old")
            os.makedirs(path + ".__staging")
        elif state == "both written":
            shutil.copytree(path, path + ".__staging")
            os.rename(path, path + ".__old")
        else:
            shutil.copytree(path, path + ".__old")
        snk.upsert(more, path, ["k"])
        assert sorted(r.k for r in snk.read_table(spark, path).collect()) == [1, 2, 3, 4], state
        assert not os.path.exists(path + ".__old")


def test_misfit_values_fail_and_name_the_column(spark, tmp_dir):
    path = os.path.join(tmp_dir, "strict")
    snk.replace_slice(spark.createDataFrame([(1, "a")], "n INT, f STRING"), path, "f")
    bad = spark.createDataFrame([("abc", "b")], "n STRING, f STRING")
    with pytest.raises(Exception, match="column n"):
        snk.replace_slice(bad, path, "f")
    wide = spark.createDataFrame([(1099511627776, "c")], "n LONG, f STRING")
    snk.replace_slice(wide, path, "f")
    assert sorted(r.n for r in snk.read_table(spark, path).collect()) == [1, 1099511627776]


def test_too_many_attribute_columns_fail(spark):
    from tidemark.operators.reshape import matrix_to_long
    head = [("f", 1, ["a"] * 6 + [None]), ("f", 2, [None] * 6 + ["C01: x"]), ("f", 3, [None] * 6 + ["01/2022 - 06/2022"]),
            ("f", 4, ["1", "2", "3", "4", "5", "6", "7"])]
    m = spark.createDataFrame(head, "src_file_path STRING, row_idx LONG, cells ARRAY<STRING>")
    with pytest.raises(Exception, match="6 attribute columns"):
        matrix_to_long(m).collect()


def test_records_wider_than_said_fail(spark, tmp_dir):
    path = os.path.join(tmp_dir, "wide.csv")
    with open(path, "w") as f:
        f.write(",".join(map(str, range(70))) + "\n")
    from tidemark.sources.files import read_matrix
    assert len(read_matrix(spark, path).first()["cells"]) == 70
    with pytest.raises(Exception, match="more than 64 fields"):
        read_matrix(spark, path, width=64).collect()


def test_one_per_key_with_map_columns(spark):
    df = spark.createDataFrame([(1, 2, {"a": 1}), (1, 1, {"b": 2}), (2, 5, {"c": 3})],
                               "k INT, v INT, m MAP<STRING, INT>")
    got = {r.k: (r.v, r.m) for r in A.one_per_key(df, ["k"], [("v", "asc")]).collect()}
    assert got == {1: (1, {"b": 2}), 2: (5, {"c": 3})}


def test_scratch_scope_removes_staging(spark):
    from tidemark.session import cut_lineage, local_path, scratch_scope
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    with scratch_scope(spark) as created:
        staged = cut_lineage(o)
        assert staged.count() == o.count()
        paths = list(created)
    assert len(paths) == 1 and not os.path.exists(local_path(paths[0]))


def test_read_matrix_splittable_keeps_header_rows(spark, tmp_dir):
    from tidemark.sources.files import read_matrix
    path = os.path.join(tmp_dir, "big", "report.csv")
    os.makedirs(os.path.dirname(path))
    with open(path, "w") as f:
        f.write("title,,\nName,Code,Value\nperiod,,\n")
        for i in range(5000):
            f.write(f"row{i},C{i % 7},{i}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        m = read_matrix(spark, [path], width=3, multiline=False, files=True)
        assert m.rdd.getNumPartitions() > 3  # the one file is read by several tasks
        rows = m.orderBy("row_idx").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.row_idx for r in rows[:4]] == [0, 1, 2, 3]
    assert rows[1].cells[:2] == ["Name", "Code"] and rows[3].cells[0] == "row0"
    assert [r.cells[0] for r in rows[3:]] == [f"row{i}" for i in range(5000)]  # order kept


def test_read_with_preamble_mixed_headers(spark, tmp_dir):
    from tidemark.sources.files import read_with_preamble
    a = os.path.join(tmp_dir, "mixed", "a.csv")
    b = os.path.join(tmp_dir, "mixed", "b.csv")
    os.makedirs(os.path.dirname(a))
    with open(a, "w") as f:
        f.write("Title A\nState,Premium\nAL,1\n")
    with open(b, "w") as f:
        f.write("Title B\nState,Premium,Stars\nAK,2,4\n")
    rows = {r.State: r for r in read_with_preamble(spark, [a, b], 1).collect()}
    assert rows["AL"].Premium == "1" and rows["AL"].Stars is None
    assert rows["AK"].Premium == "2" and rows["AK"].Stars == "4"


def test_flagship_scans_are_pruned(spark):
    plan = _plan(load_all()["cpsc_combined"].fn(spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in plan
    assert "l_extendedprice" not in plan and "l_comment" not in plan
