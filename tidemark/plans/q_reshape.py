"""Proof queries for reshaping (RSH-1, RSH-2 with SRC-5 row layout).

``matrix_to_long`` runs over a report matrix whose data rows are the line
items: two "files" with different column layouts (the header rows are the
fixed part of a report; every data row comes from ``lineitem``, status F in
the first file and every other status in the second)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import base_name, classify_name, parenthesised_date, path_year, stem, underscore_date
from ..operators import reshape as R
from ..sources.files import FILE_PATH
from .catalog import query, table


@query("melt_rates", "RSH-1", """
SELECT l_orderkey, l_linenumber, 'quantity_rate' AS indicator_key, l_quantity AS rate,
       'LIN' AS measure_code, NULL::DOUBLE AS lcl, NULL::DOUBLE AS ucl FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 'price_rate', l_extendedprice, 'LIN', NULL, NULL FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 'tax_rate', l_tax, 'LIN', NULL, NULL FROM lineitem
""")
def q_melt(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return R.melt(li, ["l_orderkey", "l_linenumber"],
                  {"l_quantity": "quantity_rate", "l_extendedprice": "price_rate", "l_tax": "tax_rate"},
                  constants={"measure_code": F.lit("LIN"), "lcl": F.lit(None).cast("double"),
                             "ucl": F.lit(None).cast("double")},
                  value_type="double")


FILE_A = "file:/reports/2024/2024 Star Ratings Measure Data (Oct 11 2023).csv"
FILE_B = "file:/reports/2024/2024_Star_Ratings_Measure_2023_10_11_data.csv"
WIDTH = 9
_N = None
# header rows of the two layouts (row 0 title, 1 attribute names, 2 headings, 3 periods)
HEADERS = [
    (FILE_A, 0, ["2024 Star Ratings Data Table - Measure Data", _N, _N, _N, _N, _N, _N, _N, _N]),
    (FILE_A, 1, ["CONTRACT_NUMBER", "Organization Type", "Contract Name", "Organization Marketing Name",
                 "Parent Organization", _N, _N, _N, _N]),
    (FILE_A, 2, [_N, _N, _N, _N, _N, "C01: Quantity Measure", "C02: Discount Rate", _N, "D01: Tax: Rate"]),
    (FILE_A, 3, [_N, _N, _N, _N, _N, "01/01/2022 - 12/31/2022", "01/2022 – 06/2022", _N,
                 "(Monday - Friday) 07/01/2022 - 12/31/2022\u0096"]),
    (FILE_B, 0, ["2024 Star Ratings Data Table", _N, _N, _N, _N, _N, _N, _N, _N]),
    (FILE_B, 1, ["Contract Number", "Organization Type", _N, "Contract Name", "Organization Marketing Name",
                 "Parent Organization", _N, _N, _N]),
    (FILE_B, 2, [_N, _N, "C02: Discount Rate", _N, _N, _N, "C01: Quantity Measure", "D01: Tax: Rate", _N]),
    (FILE_B, 3, [_N, _N, "01/2022 - 06/2022", _N, _N, _N, "01/01/2022 - 12/31/2022",
                 "07/01/2022 – 12/31/2022", _N]),
]


def lineitem_matrix(spark, sf_dir):
    """Report matrix rows ``(src_file_path, row_idx, cells)``: fixed header
    rows plus one data row per line item."""
    schema = T.StructType([T.StructField(FILE_PATH, T.StringType()), T.StructField("row_idx", T.LongType()),
                           T.StructField("cells", T.ArrayType(T.StringType()))])
    heads = spark.createDataFrame(HEADERS, schema)
    li = table(spark, sf_dir, "lineitem")
    contract = F.concat(F.lit("H"), F.col("l_orderkey").cast("string"))
    org = F.col("l_returnflag")
    name = F.concat(F.lit("Contract "), F.col("l_orderkey").cast("string"))
    mkt = F.concat(F.lit(" Plan "), F.col("l_linenumber").cast("string"), F.lit(" "))
    parent = F.lit(None).cast("string")
    qty = F.col("l_quantity").cast("string")
    disc = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    tax = F.when(F.col("l_returnflag") == "R", F.lit("Plan too new")).otherwise(F.col("l_tax").cast("string"))
    null = F.lit(None).cast("string")
    a = F.array(contract, org, name, mkt, parent, qty, disc, null, tax)
    b = F.array(contract, org, disc, name, mkt, parent, qty, tax, null)
    is_a = F.col("l_linestatus") == "F"
    rows = li.select(
        F.when(is_a, F.lit(FILE_A)).otherwise(F.lit(FILE_B)).alias(FILE_PATH),
        (F.lit(4) + F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_idx"),
        F.when(is_a, a).otherwise(b).alias("cells"))
    return heads.unionByName(rows)


_MATRIX_SQL = """
WITH li AS (
  SELECT *, CASE WHEN l_linestatus = 'F' THEN '2024 Star Ratings Measure Data (Oct 11 2023).csv'
                 ELSE '2024_Star_Ratings_Measure_2023_10_11_data.csv' END AS src_file_name
  FROM lineitem),
b AS (
  SELECT 'H' || CAST(l_orderkey AS VARCHAR) AS contract_id, l_returnflag AS organization_type,
         'Contract ' || CAST(l_orderkey AS VARCHAR) AS contract_name,
         'Plan ' || CAST(l_linenumber AS VARCHAR) AS organization_marketing_name,
         NULL::VARCHAR AS parent_organization, src_file_name, l_quantity, l_discount, l_tax, l_returnflag
  FROM li)
SELECT contract_id, organization_type, contract_name, organization_marketing_name, parent_organization,
       'C01' AS measure_code, 'quantity_measure' AS measure_desc, DATE '2022-01-01' AS measure_start,
       DATE '2022-12-31' AS measure_end, CAST(l_quantity AS VARCHAR) AS measure_value_raw,
       l_quantity AS measure_value, src_file_name, DATE '2023-10-11' AS src_file_date, 2024 AS performance_year
FROM b
UNION ALL
SELECT contract_id, organization_type, contract_name, organization_marketing_name, parent_organization,
       'C02', 'discount_rate', DATE '2022-01-01', DATE '2022-06-30',
       CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%',
       CAST(CAST(round(l_discount * 100) AS INTEGER) AS DOUBLE), src_file_name, DATE '2023-10-11', 2024
FROM b
UNION ALL
SELECT contract_id, organization_type, contract_name, organization_marketing_name, parent_organization,
       'D01', 'rate', DATE '2022-07-01', DATE '2022-12-31',
       CASE WHEN l_returnflag = 'R' THEN 'Plan too new' ELSE CAST(l_tax AS VARCHAR) END,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_tax END, src_file_name, DATE '2023-10-11', 2024
FROM b
"""


@query("matrix_to_long", "RSH-2 RSH-5 SCL-6 SCL-12 SCL-16 PTH-8 PTH-9 PTH-10", _MATRIX_SQL)
def q_matrix_to_long(spark, sf_dir):
    m = lineitem_matrix(spark, sf_dir)
    name = base_name(F.col(FILE_PATH))
    folder = F.regexp_extract(F.col(FILE_PATH), r"([^/]*)/[^/]*$", 1)
    file_date = F.coalesce(parenthesised_date(name), underscore_date(stem(name)))
    file_date = F.coalesce(file_date, F.raise_error(F.concat(F.lit("no file date in "), name)).cast("date"))
    # file-level values: evaluated once per file, not per row
    long = R.matrix_to_long(m, file_columns={"src_file_name": name, "src_file_date": file_date,
                                             "performance_year": path_year(folder)})
    return long.select(*R.MEASURE_ATTRS, "measure_code", "measure_desc", "measure_start", "measure_end",
                       "measure_value_raw", "measure_value", "src_file_name", "src_file_date", "performance_year")


DISPLAY_H = "file:/reports/2024 Display/2024_Display_HEDIS_2023_10_12.csv"
DISPLAY_N = "file:/reports/2024 Display/2024_Display_Measures_2023_10_11.csv"
DISPLAY_HEADERS = [
    (DISPLAY_H, 0, ["2024 Display Measures - HEDIS", _N, _N, _N, _N, _N]),
    (DISPLAY_H, 1, ["CONTRACT_ID", "Contract Name", "Organization Marketing Name", "Parent Organization",
                    "Quantity Shipped DMH01", "Tax Rate DMH02"]),
    (DISPLAY_N, 0, ["2024 Display Measures", _N, _N, _N, _N, _N]),
    (DISPLAY_N, 1, ["Contract Number", "Contract Name", "Organization Marketing Name", "Parent Organization",
                    _N, _N]),
    (DISPLAY_N, 2, [_N, _N, _N, _N, "Discount  Percent DMC01", "Quantity Shipped DMC02"]),
]


def _matrix_schema():
    return T.StructType([T.StructField(FILE_PATH, T.StringType()), T.StructField("row_idx", T.LongType()),
                         T.StructField("cells", T.ArrayType(T.StringType()))])


@query("display_matrix_to_long", "RSH-3 SCL-20 SCL-6", """
WITH b AS (
  SELECT 'H' || CAST(l_orderkey AS VARCHAR) AS contract_id, 'Contract ' || CAST(l_orderkey AS VARCHAR) AS contract_name,
         'Plan ' || CAST(l_linenumber AS VARCHAR) AS organization_marketing_name,
         NULL::VARCHAR AS parent_organization, l_linestatus, l_quantity, l_tax, l_discount
  FROM lineitem)
SELECT contract_id, contract_name, organization_marketing_name, parent_organization, 'DMH01' AS measure_code,
       'quantity_shipped' AS measure_desc, CAST(l_quantity AS VARCHAR) AS measure_value_raw,
       l_quantity AS measure_value, '2024_Display_HEDIS_2023_10_12.csv' AS src_file_name
FROM b WHERE l_linestatus = 'F'
UNION ALL
SELECT contract_id, contract_name, organization_marketing_name, parent_organization, 'DMH02', 'tax_rate',
       CAST(l_tax AS VARCHAR), l_tax, '2024_Display_HEDIS_2023_10_12.csv' FROM b WHERE l_linestatus = 'F'
UNION ALL
SELECT contract_id, contract_name, organization_marketing_name, parent_organization, 'DMC01', 'discount_percent',
       CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%',
       CAST(CAST(round(l_discount * 100) AS INTEGER) AS DOUBLE), '2024_Display_Measures_2023_10_11.csv'
FROM b WHERE l_linestatus <> 'F'
UNION ALL
SELECT contract_id, contract_name, organization_marketing_name, parent_organization, 'DMC02', 'quantity_shipped',
       CAST(l_quantity AS VARCHAR), l_quantity, '2024_Display_Measures_2023_10_11.csv' FROM b WHERE l_linestatus <> 'F'
""")
def q_display_matrix(spark, sf_dir):
    heads = spark.createDataFrame(DISPLAY_HEADERS, _matrix_schema())
    li = table(spark, sf_dir, "lineitem")
    contract = F.concat(F.lit("H"), F.col("l_orderkey").cast("string"))
    name = F.concat(F.lit("Contract "), F.col("l_orderkey").cast("string"))
    mkt = F.concat(F.lit(" Plan "), F.col("l_linenumber").cast("string"))
    null = F.lit(None).cast("string")
    qty = F.col("l_quantity").cast("string")
    disc = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    is_h = F.col("l_linestatus") == "F"
    rows = li.select(F.when(is_h, F.lit(DISPLAY_H)).otherwise(F.lit(DISPLAY_N)).alias(FILE_PATH),
                     (F.lit(3) + F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_idx"),
                     F.when(is_h, F.array(contract, name, mkt, null, qty, F.col("l_tax").cast("string")))
                     .otherwise(F.array(contract, name, mkt, null, disc, qty)).alias("cells"))
    m = heads.unionByName(rows)
    fname = base_name(F.col(FILE_PATH))
    offset = F.when(stem(fname).contains("HEDIS"), 0).otherwise(1)
    long = R.display_matrix_to_long(m, offset, file_columns={"src_file_name": fname})
    return long.select(*R.DISPLAY_ATTRS, "measure_code", "measure_desc", "measure_value_raw", "measure_value", "src_file_name")


CUT_C = "file:/reports/2024 Star Ratings Data Table - Part C Cut Points (Oct 11 2023).csv"
CUT_D = "file:/reports/2024_Star_Ratings_Data_Table_-_Part_D_Cut_Points__Oct_11_2023_.csv"
CUT_HEADERS = [
    (CUT_C, 0, ["Part C", _N, _N, _N]), (CUT_C, 1, ["skip", _N, _N, _N]),
    (CUT_C, 2, [_N, "C01: Quantity Cut", "C02: Price: Cut", _N]),
    (CUT_C, 3, [_N, "01/2022 – 12/2022", "Not Applicable", _N]),
    (CUT_D, 0, ["Part D", _N, _N, _N]), (CUT_D, 1, ["skip", _N, _N, _N]),
    (CUT_D, 2, [_N, _N, "D01: Quantity Cut", "D02: Price: Cut"]),
    (CUT_D, 3, [_N, _N, "02/2020 - 02/2020", "07/01/2021 - 12/31/2021"]),
]


@query("cutpoints_to_long", "RSH-4 SCL-14 SCL-12 SCL-15 FLT-6 FLT-9 PTH-11", """
WITH b AS (
  SELECT 4 + l_orderkey * 8 + l_linenumber AS row_idx, l_linestatus, l_returnflag,
         CAST(l_linenumber AS INTEGER) AS star, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q,
         CAST(CAST(l_quantity AS INTEGER) + 5 AS VARCHAR) AS q5, CAST(floor(l_extendedprice) AS BIGINT) AS p
  FROM lineitem WHERE l_returnflag <> 'R'),
m AS (
  SELECT row_idx, l_linestatus, l_returnflag, star, 1 AS k, '>= ' || q || ' to < ' || q5 AS original_text,
         CAST(q AS DOUBLE) AS lower_bound, CAST(q5 AS DOUBLE) AS upper_bound FROM b
  UNION ALL
  SELECT row_idx, l_linestatus, l_returnflag, star, 2, '< ' || CAST(p AS VARCHAR), NULL, CAST(p AS DOUBLE)
  FROM b WHERE l_returnflag <> 'A')
SELECT row_idx, CASE WHEN l_linestatus = 'F' THEN 'Part_C' ELSE 'Part_D' END AS part_type,
       CASE WHEN l_linestatus = 'F' THEN 'MA-PD' ELSE l_returnflag END AS org_type,
       CASE WHEN l_linestatus = 'F' THEN 'C0' ELSE 'D0' END || CAST(k AS VARCHAR) AS measure_code,
       CASE WHEN k = 1 THEN 'Quantity Cut' ELSE 'Cut' END AS measure_name,
       CASE WHEN k = 1 AND l_linestatus = 'F' THEN DATE '2022-01-01' WHEN k = 1 THEN DATE '2020-02-01'
            WHEN l_linestatus <> 'F' THEN DATE '2021-07-01' END AS measure_period_start,
       CASE WHEN k = 1 AND l_linestatus = 'F' THEN DATE '2022-12-31' WHEN k = 1 THEN DATE '2020-02-29'
            WHEN l_linestatus <> 'F' THEN DATE '2021-12-31' END AS measure_period_end,
       star, lower_bound, upper_bound, original_text
FROM m
""")
def q_cutpoints(spark, sf_dir):
    heads = spark.createDataFrame(CUT_HEADERS, _matrix_schema())
    li = table(spark, sf_dir, "lineitem")
    label = F.when(F.col("l_returnflag") == "R", F.lit("Total")).otherwise(
        F.concat(F.col("l_linenumber").cast("string"), F.when(F.col("l_linenumber") % 2 == 0, F.lit(" Stars"))
                 .otherwise(F.lit("star"))))
    q = F.col("l_quantity").cast("int")
    m1 = F.concat(F.lit(">= "), q.cast("string"), F.lit(" to < "), (q + 5).cast("string"))
    m2 = F.when(F.col("l_returnflag") == "A", F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("< "), F.floor("l_extendedprice").cast("bigint").cast("string")))
    is_c = F.col("l_linestatus") == "F"
    null = F.lit(None).cast("string")
    rows = li.select(F.when(is_c, F.lit(CUT_C)).otherwise(F.lit(CUT_D)).alias(FILE_PATH),
                     (F.lit(4) + F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_idx"),
                     F.when(is_c, F.array(label, m1, m2, null))
                     .otherwise(F.array(F.col("l_returnflag"), label, m1, m2)).alias("cells"))
    m = heads.unionByName(rows)
    part = classify_name(base_name(F.col(FILE_PATH)))
    long = R.cutpoints_to_long(m, part)
    return long.select("row_idx", "part_type", "org_type", "measure_code", "measure_name", "measure_period_start",
                       "measure_period_end", "star", "lower_bound", "upper_bound", "original_text")
