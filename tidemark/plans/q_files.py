"""Proof queries for file sources and header operators over files written
from the driver tables (SRC-3..6, SRC-8/ORD-3, PRJ-4, PRJ-5, FLT-9).

The report files are the orders table rendered as reports, one a month: two
title lines, a header line, then one line per order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import parse_number
from ..operators import filters as flt
from ..operators import projections as prj
from ..session import scratch_path
from ..sources import files as src
from .catalog import query, table

TITLE = [(0, "Monthly Orders Report"), (1, '"Generated for plan year 2024, all contracts"'),
         (2, "o_orderkey,o_custkey,o_orderstatus,o_totalprice")]


@query("report_with_preamble", "SRC-3 SRC-4 SRC-5", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
""")
def q_report_with_preamble(spark, sf_dir):
    path = scratch_path(spark, "report_with_preamble")
    o = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    body = o.select("month", (F.col("o_orderkey") + len(TITLE)).alias("k"),
                    F.concat_ws(",", *[F.col(c).cast("string") for c in
                                       ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")]).alias("line"))
    titles = F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(line).alias("line")) for k, line in TITLE]))
    lines = o.select("month").distinct().select("month", titles.alias("t")).select("month", "t.k", "t.line").unionByName(body)
    # one report file a month, its lines in order; months are written in parallel
    (lines.repartition("month").sortWithinPartitions("month", "k").select("month", "line")
     .write.partitionBy("month").text(path))
    m = src.read_matrix(spark, path)
    header_row = src.detect_header(m, "o_orderkey").select("header_row").first()[0]
    df = src.read_with_preamble(spark, path, int(header_row))
    return df.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                     F.col("o_custkey").cast("bigint").alias("o_custkey"), "o_orderstatus",
                     parse_number("o_totalprice").alias("o_totalprice"))


@query("decode_with_fallback", "SRC-6 SRC-1", """
SELECT c_custkey, c_name || ' é ' || c_mktsegment AS label FROM customer
""")
def q_decode(spark, sf_dir):
    root = scratch_path(spark, "decode_with_fallback")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", F.concat(F.col("c_name"), F.lit(" é "), F.col("c_mktsegment")).alias("label"))
    (c.filter(F.col("c_nationkey") < 12).drop("c_nationkey").write.option("header", True)
     .option("encoding", "UTF-8").csv(f"{root}/utf8"))
    (c.filter(F.col("c_nationkey") >= 12).drop("c_nationkey").write.option("header", True)
     .option("encoding", "ISO-8859-1").csv(f"{root}/latin1"))
    enc = src.decode_with_fallback(spark, [f"{root}/utf8", f"{root}/latin1"], pattern="*.csv")
    groups: dict[str, list[str]] = {}
    for r in enc.collect():  # one row per file
        groups.setdefault(r["encoding"], []).append(r["path"])
    assert set(groups) == {"UTF-8", "ISO-8859-1"}, groups
    parts = [src.read_csv_text(spark, paths, encoding=e, with_path=False) for e, paths in sorted(groups.items())]
    out = parts[0].unionByName(parts[1])
    return out.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "label")


@query("pick_first_matching", "SRC-8 ORD-3", """
SELECT CAST(o_custkey AS VARCHAR) AS workbook,
       coalesce(min(CASE WHEN starts_with(o_orderpriority, '1-') THEN o_orderkey END), min(o_orderkey))
         AS sheet_index
FROM orders GROUP BY 1
""")
def q_pick_first(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    listing = o.select(F.col("o_custkey").cast("string").alias("workbook"),
                       F.col("o_orderkey").alias("sheet_index"), F.col("o_orderpriority").alias("sheet_name"))
    return src.pick_sheet(listing, "1-")


@query("rename_matching", "PRJ-4", """
SELECT c_custkey, c_name, c_nationkey AS nation_id, c_acctbal AS balance, c_mktsegment AS segment FROM customer
""")
def q_rename_matching(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return prj.rename_matching(c, [("acctbal", "balance"), ("mktsegment", "segment"), ("nation", "nation_id"),
                                   ("segment", "never_applied")])


@query("drop_unnamed", "PRJ-5 PRJ-1", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_drop_unnamed(spark, sf_dir):
    n = table(spark, sf_dir, "nation").withColumns({"Unnamed: 3": F.lit(None).cast("string"),
                                                    "Unnamed: 4": F.lit("x")})
    return prj.drop_unnamed(prj.normalize_headers(n))


@query("drop_empty_cells", "FLT-9", """
SELECT p_partkey, name, value FROM (
  SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN '' WHEN p_size % 4 = 1 THEN NULL ELSE p_type END AS name,
         CASE WHEN p_size > 45 THEN NULL ELSE p_retailprice END AS value
  FROM part) t
WHERE name IS NOT NULL AND name <> '' AND value IS NOT NULL
""")
def q_drop_empty_cells(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    m = F.col("p_size") % 4
    cells = p.select("p_partkey",
                     F.when(m == 0, F.lit("")).when(m == 1, F.lit(None).cast("string"))
                     .otherwise(F.col("p_type")).alias("name"),
                     F.when(F.col("p_size") > 45, F.lit(None).cast("double"))
                     .otherwise(F.col("p_retailprice")).alias("value"))
    return flt.drop_empty_cells(cells, "name", "value")


@query("records_with_breaks", "SRC-1 SRC-5", """
SELECT o_orderkey, 'first ' || o_orderstatus || chr(10) || 'of "' || o_orderpriority || '", two' AS note,
       'then' || chr(10) || chr(10) || CAST(o_custkey AS VARCHAR) AS more, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS row_idx
FROM orders
""")
def q_records_with_breaks(spark, sf_dir):
    """Records with two quoted line breaks and more, one file a status: read
    by as many tasks as their splits, numbered without gaps."""
    path = scratch_path(spark, "records_with_breaks")
    o = table(spark, sf_dir, "orders")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    note = F.concat(F.lit("first "), F.col("o_orderstatus"), F.lit('\nof "'), F.col("o_orderpriority"), F.lit('", two'))
    more = F.concat(F.lit("then\n\n"), F.col("o_custkey").cast("string"))
    body = o.select("o_orderstatus", "o_orderkey", F.concat_ws(",", F.col("o_orderkey").cast("string"), quoted(note), quoted(more)).alias("line"))
    head = o.select("o_orderstatus").distinct().select("o_orderstatus", F.lit(-1).cast("long").alias("o_orderkey"), F.lit("key,note,more").alias("line"))
    (head.unionByName(body).repartition("o_orderstatus").sortWithinPartitions("o_orderstatus", "o_orderkey").select("o_orderstatus", "line")
     .write.partitionBy("o_orderstatus").text(path))
    m = src.read_matrix(spark, path).where("row_idx > 0")
    return m.select(F.col("cells")[0].cast("bigint").alias("o_orderkey"), F.col("cells")[1].alias("note"), F.col("cells")[2].alias("more"), "row_idx")


@query("drifting_headers", "SRC-1 SET-1 SNK-4", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS o_custkey, o_totalprice,
       CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority FROM orders
""")
def q_drifting_headers(spark, sf_dir):
    """Files of three layouts in one read: columns in another order, one
    missing, one that only some files have."""
    root = scratch_path(spark, "drifting_headers")
    o = table(spark, sf_dir, "orders")
    layouts = {"F": ["o_totalprice", "o_orderkey"], "O": ["o_orderkey", "o_orderpriority", "o_custkey", "o_totalprice"],
               "P": ["o_custkey", "o_totalprice", "o_orderkey"]}
    for status, columns in layouts.items():
        of = o.filter(F.col("o_orderstatus") == status) if status != "P" else o.filter(~F.col("o_orderstatus").isin("F", "O"))
        of.select(columns).write.option("header", True).csv(f"{root}/status={status}")
    t = src.read_csv_text(spark, root, recursiveFileLookup=True, with_path=False)
    return t.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey"),
                    parse_number("o_totalprice").alias("o_totalprice"), "o_orderpriority")


@query("workbook_sheets", "SRC-7 SRC-11", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y') AS workbook, 1 AS sheet_index, 'orders ' || o_orderstatus AS sheet_name FROM orders
""")
def q_workbook_sheets(spark, sf_dir):
    """The sheets named ``orders ..`` of workbooks landed as text, a workbook
    a year; the cover sheets stay unread."""
    root = scratch_path(spark, "workbook_sheets")
    o = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy").alias("book"), "o_orderstatus", "o_orderkey", "o_custkey")
    lines = o.select("book", F.concat(F.lit("1__orders "), "o_orderstatus").alias("sheet"), "o_orderkey",
                     F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")).alias("value"))
    sheets = lines.select("book", "sheet").distinct()
    heads = sheets.select("book", "sheet", F.lit(-1).cast("long").alias("o_orderkey"), F.lit("o_orderkey,o_custkey").alias("value"))
    covers = sheets.select("book").distinct().select("book", F.lit("0__cover").alias("sheet"), F.lit(-1).cast("long").alias("o_orderkey"), F.lit("a cover").alias("value"))
    staged = scratch_path(spark, "workbook_lines")
    (lines.unionByName(heads).unionByName(covers).repartition("book", "sheet").sortWithinPartitions("book", "sheet", "o_orderkey")
     .select("book", "sheet", "value").write.partitionBy("book", "sheet").text(staged))
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    for r in src.list_files(spark, staged).select("path").collect():  # one text file a sheet: it gets the sheet's name
        old = fs.Path(r["path"])
        book, sheet = old.getParent().getParent().getName()[5:], old.getParent().getName()[6:]
        new = fs.Path(f"{root}/{book}/{sheet.replace('%20', ' ')}.csv")
        disk = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        disk.mkdirs(new.getParent())
        disk.rename(old, new)
    df = src.read_sheets(spark, root, 1)
    return df.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey"),
                     "workbook", "sheet_index", "sheet_name")
