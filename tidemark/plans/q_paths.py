"""Proof queries for dates and categories read from file names (PTH-2..12).
Names are rendered from order dates in the shapes the report files use."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from .catalog import query, table


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


@query("year_month_suffix", "PTH-2", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                        ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS src_file_date
FROM orders
""")
def q_year_month_suffix(spark, sf_dir):
    o = _orders(spark, sf_dir)
    name = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit("CPSC_Enrollment_Info_bad"))
            .when(F.col("o_orderstatus") == "P",
                  F.concat(F.lit("Monthly_Report_"), F.date_format("o_orderdate", "yyyy-MM")))
            .otherwise(F.concat(F.lit("CPSC_Enrollment_Info_"), F.date_format("o_orderdate", "yyyy_MM"))))
    return o.select("o_orderkey", D.year_month_suffix(name).alias("src_file_date"))


@query("year_bounds", "PTH-3 PTH-12", """
SELECT o_orderkey, make_date(year(o_orderdate), 1, 1) AS performance_date_start,
       make_date(year(o_orderdate), 12, 31) AS performance_date_end
FROM orders
""")
def q_year_bounds(spark, sf_dir):
    o = _orders(spark, sf_dir)
    y = F.date_format("o_orderdate", "yyyy")
    start, end = D.year_range(y)
    return o.select("o_orderkey", start.alias("performance_date_start"), end.alias("performance_date_end"))


@query("two_digit_year", "PTH-4 PTH-3", """
SELECT o_orderkey, make_date(CAST('20' || strftime(o_orderdate, '%y') AS INTEGER), 12, 31) AS src_file_date
FROM orders
""")
def q_two_digit_year(spark, sf_dir):
    o = _orders(spark, sf_dir)
    name = F.concat(F.lit("PD"), F.date_format("o_orderdate", "yy"), F.lit("ReconciliationContract"))
    return o.select("o_orderkey", D.year_end(D.two_digit_year(name, 3)).alias("src_file_date"))


@query("tagged_year", "PTH-5", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END
       AS contract_year
FROM orders
""")
def q_tagged_year(spark, sf_dir):
    o = _orders(spark, sf_dir)
    name = F.when(F.col("o_orderstatus") == "P", F.lit("MPF_Benefit_Summary")).otherwise(
        F.concat(F.lit("MPF_Benefit_CY"), F.date_format("o_orderdate", "yyyy"), F.lit("_v2")))
    return o.select("o_orderkey", D.tagged_year(name).alias("contract_year"))


@query("quarter_start", "PTH-6", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN make_date(year(o_orderdate), 3 * quarter(o_orderdate) - 2, 1)
            WHEN o_orderstatus = 'O' THEN make_date(year(o_orderdate), 1, 1) END AS src_file_date
FROM orders
""")
def q_quarter_start(spark, sf_dir):
    o = _orders(spark, sf_dir)
    y = F.date_format("o_orderdate", "yyyy")
    s = F.col("o_orderstatus")
    folder = (F.when(s == "F", F.concat(F.lit("pbp-benefits-"), y, F.lit("-quarter-"),
                                        F.quarter("o_orderdate").cast("string")))
              .when(s == "O", F.concat(F.lit("pbp-benefits-"), y))
              .otherwise(F.concat(F.lit("pbp-benefits-"), y, F.lit("-extra-x"))))
    return o.select("o_orderkey", D.quarter_start(folder).alias("src_file_date"))


@query("compact_date", "PTH-7", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS src_file_date FROM orders")
def q_compact_date(spark, sf_dir):
    o = _orders(spark, sf_dir)
    stem = F.concat(F.lit("PlanCrosswalk"), F.date_format("o_orderdate", "yyyy"), F.lit("_"),
                    F.date_format("o_orderdate", "MMddyyyy"))
    return o.select("o_orderkey", D.compact_date(stem).alias("src_file_date"))


@query("parenthesised_date", "PTH-8 PTH-11", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN make_date(year(o_orderdate), 1, day(o_orderdate))
            ELSE CAST(o_orderdate AS DATE) END AS generation_date,
       CASE WHEN o_orderstatus = 'F' THEN 'Part_C' WHEN o_orderstatus = 'O' THEN 'Part_D'
            ELSE 'Unknown' END AS part_type,
       CAST(year(o_orderdate) + 1 AS INTEGER) AS performance_year
FROM orders
""")
def q_parenthesised_date(spark, sf_dir):
    o = _orders(spark, sf_dir)
    s = F.col("o_orderstatus")
    part = F.when(s == "F", F.lit("Part C")).when(s == "O", F.lit("Part_D")).otherwise(F.lit("Part X"))
    month = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("Xyz")).otherwise(
        F.date_format("o_orderdate", "MMM"))
    d, y = F.date_format("o_orderdate", "d"), F.date_format("o_orderdate", "yyyy")
    py = (F.year("o_orderdate") + 1).cast("string")
    paren = F.concat(py, F.lit(" Star Ratings Data Table - "), part, F.lit(" Cut Points ("),
                     month, F.lit(" "), d, F.lit(" "), y, F.lit(").csv"))
    under = F.concat(py, F.lit("_Star_Ratings_Data_Table_-_"), F.replace(part, F.lit(" "), F.lit("_")),
                     F.lit("_Cut_Points__"), month, F.lit("_"), d, F.lit("_"), y, F.lit("_.csv"))
    name = F.when(F.col("o_orderkey") % 2 == 0, paren).otherwise(under)
    return o.select("o_orderkey", D.parenthesised_date(name).alias("generation_date"),
                    D.classify_name(name).alias("part_type"), D.path_year(name).alias("performance_year"))


@query("underscore_date", "PTH-9", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS src_file_date FROM orders")
def q_underscore_date(spark, sf_dir):
    o = _orders(spark, sf_dir)
    dt = F.date_format("o_orderdate", "yyyy_MM_dd")
    s = F.col("o_orderstatus")
    stem = (F.when(s == "F", F.concat(F.lit("2024_Star_Ratings_Measure_Data_"), dt, F.lit("_data")))
            .when(s == "O", F.concat(F.lit("2024_Star_Ratings_Measure_Stars_"), dt, F.lit("_stars")))
            .otherwise(F.concat(F.lit("2024_Display_Measures_"), dt)))
    return o.select("o_orderkey", D.underscore_date(stem).alias("src_file_date"))


@query("path_year", "PTH-10", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END
       AS performance_year
FROM orders
""")
def q_path_year(spark, sf_dir):
    o = _orders(spark, sf_dir)
    folder = F.when(F.col("o_orderstatus") == "P", F.lit("Star Ratings")).otherwise(
        F.concat(F.date_format("o_orderdate", "yyyy"), F.lit(" Star Ratings")))
    return o.select("o_orderkey", D.path_year(folder).alias("performance_year"))


@query("classify_name", "PTH-11", """
SELECT c_custkey,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Part_C'
            WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'Part_D' ELSE 'Unknown' END AS part_type
FROM customer
""")
def q_classify_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    name = (F.when(seg == "AUTOMOBILE", F.lit("2024 Data Table - Part C Cut Points"))
            .when(seg == "BUILDING", F.lit("2024_Data_Table_-_part_c_Cut_Points"))
            .when(seg == "FURNITURE", F.lit("2024 Data Table - PART D Cutpoints"))
            .when(seg == "MACHINERY", F.lit("2024_Part_D"))
            .otherwise(F.lit("2024 Data Table - PartC")))
    return c.select("c_custkey", D.classify_name(name).alias("part_type"))
