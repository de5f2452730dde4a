"""Proof queries: filters, joins, aggregates, ordering, sets, headers,
projections and incremental selection, on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.dates import year_end
from ..functions.scalars import extract_int, parse_number
from ..operators import aggregates as agg
from ..operators import filters as flt
from ..operators import incremental as inc
from ..operators import joins as jn
from ..operators import projections as prj
from ..sources.files import assign_header
from .catalog import query, table

LOAD_DATE = "2024-01-01"


# ---------------------------------------------------------------------------
# Flagship: enrollment facts enriched with contract attributes
# ---------------------------------------------------------------------------

def combined(spark, sf_dir):
    """Enrollment facts (lineitem) left-joined with contract attributes
    (orders) on (contract, snapshot year); the attribute side is reduced to
    one row per key first, highest total price winning."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    enroll = li.select(F.col("l_orderkey").alias("contract_id"),
                       F.col("l_linenumber").alias("plan_id"),
                       year_end(F.year("l_shipdate")).alias("src_file_date"),
                       F.col("l_quantity").cast("int").alias("enrollment"))
    enroll = flt.require(enroll, ["enrollment"])
    contract = o.select(F.col("o_orderkey").alias("contract_id"),
                        year_end(F.year("o_orderdate")).alias("src_file_date"),
                        "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    contract = flt.require(contract, ["contract_id"])
    out = jn.enrich(enroll, contract, ["contract_id", "src_file_date"], order=[("o_totalprice", "desc")])
    return prj.with_lineage(out, file_date=F.col("src_file_date"), load_date=LOAD_DATE,
                            file_name="lineitem.parquet")


_COMBINED_SQL = """
WITH enroll AS (
  SELECT l_orderkey AS contract_id, l_linenumber AS plan_id,
         make_date(year(l_shipdate), 12, 31) AS src_file_date,
         CAST(l_quantity AS INTEGER) AS enrollment
  FROM lineitem WHERE l_quantity IS NOT NULL),
contract AS (
  SELECT contract_id, src_file_date, o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM (
    SELECT o_orderkey AS contract_id, make_date(year(o_orderdate), 12, 31) AS src_file_date,
           o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
           row_number() OVER (PARTITION BY o_orderkey, make_date(year(o_orderdate), 12, 31)
                              ORDER BY o_totalprice DESC NULLS LAST, o_custkey, o_orderstatus,
                                       o_orderpriority) AS rn
    FROM orders WHERE o_orderkey IS NOT NULL) t WHERE rn = 1)
SELECT e.contract_id, e.src_file_date, e.plan_id, e.enrollment, c.o_custkey, c.o_orderstatus,
       c.o_orderpriority, c.o_totalprice, 'lineitem.parquet' AS src_file_name,
       DATE '2024-01-01' AS load_date
FROM enroll e LEFT JOIN contract c
  ON e.contract_id = c.contract_id AND e.src_file_date = c.src_file_date
"""

query("cpsc_combined", "JON-1 FLT-2 AGG-6 PTH-1 PTH-3 SRC-10", _COMBINED_SQL)(combined)


@query("cpsc_combined_summary", "JON-1 AGG-1", f"""
SELECT src_file_date, o_orderstatus, count(*) AS n_rows,
       CAST(sum(enrollment) AS BIGINT) AS total_enrollment, count(o_custkey) AS n_matched
FROM ({_COMBINED_SQL}) x GROUP BY src_file_date, o_orderstatus
""")
def combined_summary(spark, sf_dir):
    """Flagship: the combined table summarised per snapshot and status."""
    c = combined(spark, sf_dir)
    return c.groupBy("src_file_date", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("enrollment").alias("total_enrollment"),
        F.count("o_custkey").alias("n_matched"))


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------

_STATUS_TEXT = ("CASE WHEN o_orderstatus = 'P' THEN '*' WHEN o_orderpriority = '5-LOW' THEN NULL "
                "ELSE o_orderstatus END")


def _status_text():
    return (F.when(F.col("o_orderstatus") == "P", "*")
            .when(F.col("o_orderpriority") == "5-LOW", None)
            .otherwise(F.col("o_orderstatus")))


@query("drop_sentinel", "FLT-1", f"""
SELECT o_orderkey, status FROM (SELECT o_orderkey, {_STATUS_TEXT} AS status FROM orders) t
WHERE status <> '*'
""")
def q_drop_sentinel(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", _status_text().alias("status"))
    return flt.drop_sentinel(o, "status", "*")


@query("require_keys", "FLT-2", """
SELECT event_id, user_id, k FROM (
  SELECT event_id, user_id,
         CASE WHEN event_type = 'error' THEN NULL ELSE json_extract_string(props, '$.k') END AS k
  FROM events) t
WHERE user_id IS NOT NULL AND k IS NOT NULL
""")
def q_require(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", "user_id",
        F.when(F.col("event_type") == "error", None)
        .otherwise(F.get_json_object("props", "$.k")).alias("k"))
    return flt.require(e, ["user_id", "k"])


@query("drop_totals", "FLT-3", """
SELECT o_orderkey, label FROM (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Totals'
                          WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderstatus END AS label
  FROM orders) t
WHERE label IS DISTINCT FROM 'Totals'
""")
def q_drop_totals(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "Totals").when(F.col("o_orderpriority") == "5-LOW", None)
        .otherwise(F.col("o_orderstatus")).alias("label"))
    return flt.drop_totals(o, "label")


@query("drop_blank_rows", "FLT-4", """
SELECT name, segment FROM (
  SELECT CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_name END AS name,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS segment
  FROM customer) t
WHERE name IS NOT NULL OR segment IS NOT NULL
""")
def q_drop_blank_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    keep = F.col("c_mktsegment") != "HOUSEHOLD"
    df = c.select(F.when(keep, F.col("c_name")).alias("name"),
                  F.when(keep, F.col("c_mktsegment")).alias("segment"))
    return flt.drop_blank_rows(df)


@query("route_by_category", "FLT-5", """
SELECT 'open' AS route, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O')
UNION ALL
SELECT 'closed' AS route, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')
""")
def q_route(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    routes = flt.route_by_category(o, "o_orderstatus", {"open": ["O"], "closed": ["F", "P"]})
    return reduce(lambda a, b: a.unionByName(b),
                  [df.select(F.lit(name).alias("route"), "o_orderkey", "o_orderstatus")
                   for name, df in routes.items()])


_STAR_LABEL_SQL = """CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS VARCHAR) || 'star'
                          WHEN p_size % 3 = 1 THEN CAST(p_size AS VARCHAR) || ' Star'
                          ELSE p_type END"""


def _star_label():
    s = F.col("p_size").cast("string")
    return (F.when(F.col("p_size") % 3 == 0, F.concat(s, F.lit("star")))
            .when(F.col("p_size") % 3 == 1, F.concat(s, F.lit(" Star")))
            .otherwise(F.col("p_type")))


@query("rows_matching", "FLT-6 SCL-15", f"""
SELECT p_partkey, label, CAST(regexp_extract(lower(label), '(\\d+)\\s?star', 1) AS INTEGER) AS star
FROM (SELECT p_partkey, {_STAR_LABEL_SQL} AS label FROM part) t
WHERE regexp_matches(lower(label), '(\\d+)\\s?star')
""")
def q_rows_matching(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", _star_label().alias("label"))
    m = flt.rows_matching(p, "label", r"(\d+)\s?star")
    return m.withColumn("star", extract_int(F.lower("label"), r"(\d+)\s?star"))


@query("for_year", "FLT-7", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01'
""")
def q_for_year(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return flt.for_year(o, "o_orderdate", 1996)


@query("value_equals", "FLT-8", """
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'
""")
def q_value_equals(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return flt.value_equals(c, "c_mktsegment", "MACHINERY").select("c_custkey", "c_name")


# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------

@query("attach_dictionary", "JON-2 AGG-3", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, d.p_brand, d.p_type
FROM lineitem l LEFT JOIN (
  SELECT DISTINCT p_partkey AS l_partkey, CAST(p_size % 7 + 1 AS INTEGER) AS l_linenumber, p_brand, p_type
  FROM part) d
  ON l.l_partkey = d.l_partkey AND l.l_linenumber = d.l_linenumber
""")
def q_attach_dictionary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = table(spark, sf_dir, "part")
    d = p.select(F.col("p_partkey").alias("l_partkey"),
                 (F.col("p_size") % 7 + 1).cast("int").alias("l_linenumber"), "p_brand", "p_type")
    d = d.unionByName(d)  # a dictionary snapshot listed twice
    return jn.attach_dictionary(li, d, ["l_partkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_brand", "p_type")


@query("attach_labels", "JON-3", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, a.n_same_status
FROM orders o LEFT JOIN (
  SELECT o_custkey, o_orderstatus, count(*) AS n_same_status FROM orders
  WHERE o_orderpriority <> '1-URGENT' GROUP BY o_custkey, o_orderstatus) a
  ON o.o_custkey = a.o_custkey AND o.o_orderstatus = a.o_orderstatus
""")
def q_attach_labels(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a = agg.group_count(o.filter(F.col("o_orderpriority") != "1-URGENT"),
                        ["o_custkey", "o_orderstatus"], "n_same_status")
    return jn.attach_labels(o.select("o_orderkey", "o_custkey", "o_orderstatus"), a,
                            ["o_custkey", "o_orderstatus"])


@query("not_in", "JON-4 INC-1", """
SELECT c_custkey, c_name, 'new' AS state FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'O')
UNION ALL
SELECT c_custkey, c_name, 'loaded' AS state FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'O')
""")
def q_not_in(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    loaded = (table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "O")
              .select(F.col("o_custkey").alias("c_custkey")))
    new = inc.unprocessed(c, loaded, "c_custkey").withColumn("state", F.lit("new"))
    old = jn.only_in(c, loaded, ["c_custkey"]).withColumn("state", F.lit("loaded"))
    return new.unionByName(old)


_SEGMENT_MAP = {"AUTOMOBILE": "AUTO", "BUILDING": "BUILD", "AUTO": "X"}


@query("remap_values", "JON-5", """
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'BUILDING' THEN 'BUILD'
                                    WHEN 'AUTO' THEN 'X' ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def q_remap(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return jn.remap(c, "c_mktsegment", _SEGMENT_MAP)


@query("remap_by_table", "JON-5", """
SELECT c.c_custkey, coalesce(m.n_name, CAST(c.c_nationkey AS VARCHAR)) AS nation
FROM customer c LEFT JOIN (SELECT CAST(n_nationkey AS VARCHAR) AS k, n_name FROM nation
                           WHERE n_regionkey <> 0) m
  ON CAST(c.c_nationkey AS VARCHAR) = m.k
""")
def q_remap_table(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    n = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") != 0).select(
        F.col("n_nationkey").cast("string").alias("from"), F.col("n_name").alias("to"))
    return jn.remap(c, "nation", n)


# ---------------------------------------------------------------------------
# Aggregations, ordering, sets
# ---------------------------------------------------------------------------

@query("group_count", "AGG-1", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def q_group_count(spark, sf_dir):
    return agg.group_count(table(spark, sf_dir, "orders"), ["o_orderstatus"])


@query("non_null_counts", "AGG-1", """
SELECT count(c_custkey) AS c_custkey,
       count(CASE WHEN c_acctbal > 0 THEN c_acctbal END) AS positive_balance,
       count(CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END) AS segment
FROM customer
""")
def q_non_null_counts(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("positive_balance"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("segment"))
    return agg.non_null_counts(c)


@query("distinct_values", "AGG-2", "SELECT DISTINCT c_mktsegment FROM customer")
def q_distinct_values(spark, sf_dir):
    return agg.distinct_values(table(spark, sf_dir, "customer"), "c_mktsegment")


@query("distinct_rows", "AGG-3", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def q_distinct_rows(spark, sf_dir):
    return agg.distinct_rows(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("ordered_concat", "AGG-4 SCL-19", """
SELECT o_custkey, string_agg(o_orderstatus || ': ' || o_orderpriority, '; ' ORDER BY o_orderkey)
       AS code_and_values
FROM orders GROUP BY o_custkey
""")
def q_ordered_concat(spark, sf_dir):
    from ..functions.scalars import concat_label
    o = table(spark, sf_dir, "orders").withColumn("label", concat_label("o_orderstatus", "o_orderpriority"))
    return agg.ordered_concat(o, ["o_custkey"], "o_orderkey", "label")


@query("all_match", "AGG-5", """
SELECT l_orderkey, bool_and(coalesce(l_linestatus = 'F', false)) AS all_shipped
FROM lineitem GROUP BY l_orderkey
""")
def q_all_match(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return agg.all_match(li, ["l_orderkey"], F.col("l_linestatus") == "F", "all_shipped")


@query("one_per_key", "AGG-6 ORD-2 INC-3", """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST,
                                                           o_orderkey) AS rn
  FROM orders) t WHERE rn = 1
""")
def q_one_per_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return inc.latest_per_snapshot(o, "o_custkey", "o_orderdate", "o_orderkey")


@query("group_median", "AGG-7", """
SELECT c_nationkey, round(median(c_acctbal), 4) AS median_acctbal FROM customer GROUP BY c_nationkey
""")
def q_group_median(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    m = agg.group_median(c, ["c_nationkey"], "c_acctbal", "median_acctbal")
    return m.withColumn("median_acctbal", F.round("median_acctbal", 4))


@query("selected_median", "AGG-7", """
SELECT l_returnflag, CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_linenumber END AS mode, median(l_extendedprice) AS median_price,
       median(l_quantity) AS median_quantity FROM lineitem GROUP BY ALL
""")
def q_selected_median(spark, sf_dir):
    """Groups of very different size, a null key, prices that hardly repeat
    and quantities that do."""
    li = table(spark, sf_dir, "lineitem").withColumn("mode", F.when(F.col("l_linestatus") != "F", F.col("l_linenumber")))
    keys = ["l_returnflag", "mode"]
    price = agg.selected_median(li, keys, "l_extendedprice", "median_price", limit=500)
    quantity = agg.selected_median(li, keys, "l_quantity", "median_quantity", limit=20).withColumnsRenamed({k: f"of_{k}" for k in keys})
    same = F.col("l_returnflag").eqNullSafe(F.col("of_l_returnflag")) & F.col("mode").eqNullSafe(F.col("of_mode"))
    return price.join(quantity, same).select(*keys, "median_price", "median_quantity")


@query("most_common", "AGG-8 ORD-2", """
SELECT p_brand, p_type, n FROM (
  SELECT p_brand, p_type, n, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS rn
  FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY p_brand, p_type) c) t
WHERE rn = 1
""")
def q_most_common(spark, sf_dir):
    return agg.most_common(table(spark, sf_dir, "part"), ["p_brand"], "p_type")


@query("weighted_rollup", "AGG-9", """
SELECT lower(c_mktsegment) AS key, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1
""")
def q_weighted_rollup(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    r = agg.weighted_rollup(c, F.lower("c_mktsegment"), "c_acctbal")
    return r.withColumn("total", F.round("total", 2))


@query("newest_first", "ORD-1", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC")
def q_newest_first(spark, sf_dir):
    return agg.newest_first(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@query("union_by_name", "SET-1", """
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier
""")
def q_union_by_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("party_key"), F.col("s_nationkey").alias("nationkey"))
    return agg.union_by_name([c, s])


@query("union_distinct", "SET-2 SRC-10", "SELECT DISTINCT r_regionkey, r_name FROM region")
def q_union_distinct(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    return agg.union_distinct_on([r, r], "r_name")


# ---------------------------------------------------------------------------
# Headers and projections
# ---------------------------------------------------------------------------

@query("normalize_headers", "PRJ-1", """
SELECT n_nationkey AS nation_key, n_name AS nationname_full, n_regionkey AS region_key FROM nation
""")
def q_normalize_headers(spark, sf_dir):
    n = table(spark, sf_dir, "nation").toDF("  Nation Key ", "Nation-Name (Full)", "Region \t Key")
    return prj.normalize_headers(n)


@query("camel_headers", "PRJ-2", "SELECT r_regionkey AS r_region_key, r_name AS r_name FROM region")
def q_camel_headers(spark, sf_dir):
    return prj.camel_headers(table(spark, sf_dir, "region").toDF("RRegionKey", "RName"))


@query("rename_columns", "PRJ-3", "SELECT n_nationkey, n_name AS nation, n_regionkey FROM nation")
def q_rename(spark, sf_dir):
    return prj.rename(table(spark, sf_dir, "nation"), {"n_name": "nation", "absent": "x"})


@query("dedupe_headers", "PRJ-11 SRC-12", """
SELECT n_nationkey AS "name", n_name AS "name.1", n_regionkey AS "name.2" FROM nation
""")
def q_dedupe_headers(spark, sf_dir):
    return prj.dedupe_headers(table(spark, sf_dir, "nation").toDF("name", "name", "name"))


@query("drop_all_null_columns", "PRJ-6", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       CASE WHEN c_acctbal < 0 THEN 'negative' END AS sparse FROM customer
""")
def q_drop_all_null(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumns({
        "empty": F.lit(None).cast("string"),
        "sparse": F.when(F.col("c_acctbal") < 0, F.lit("negative"))})
    return prj.drop_all_null_columns(c)


@query("conform_to_schema", "PRJ-7", "SELECT c_custkey, c_acctbal, c_name FROM customer")
def q_conform(spark, sf_dir):
    from pyspark.sql import types as T
    c = table(spark, sf_dir, "customer")
    text = c.select(*[F.col(x).cast("string").alias(x) for x in c.columns])
    target = T.StructType([T.StructField("c_custkey", T.LongType()),
                           T.StructField("c_acctbal", T.DoubleType()),
                           T.StructField("c_name", T.StringType()),
                           T.StructField("c_comment", T.StringType())])
    out, missing = prj.conform_to(text, target)
    assert missing == ["c_comment"], missing
    return out


@query("select_drop", "PRJ-8", "SELECT c_name, c_custkey FROM customer")
def q_select_drop(spark, sf_dir):
    c = prj.drop_columns(table(spark, sf_dir, "customer"), ["c_acctbal", "c_mktsegment"])
    return prj.select_columns(c, ["c_name", "c_custkey"])


@query("swap_columns_if", "PRJ-9 AGG-7", """
WITH t AS (
  SELECT c_custkey, c_nationkey,
         CASE WHEN c_nationkey < 10 THEN c_acctbal ELSE c_acctbal / 10000 END AS risk,
         CASE WHEN c_nationkey < 10 THEN c_acctbal / 10000 ELSE c_acctbal END AS payment
  FROM customer),
m AS (SELECT c_nationkey, coalesce(median(risk) > 100, false) AS swap FROM t GROUP BY c_nationkey)
SELECT c_custkey, t.c_nationkey,
       CASE WHEN swap THEN payment ELSE risk END AS risk,
       CASE WHEN swap THEN risk ELSE payment END AS payment
FROM t JOIN m ON t.c_nationkey = m.c_nationkey
""")
def q_swap(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    small = F.col("c_nationkey") < 10
    t = c.select("c_custkey", "c_nationkey",
                 F.when(small, F.col("c_acctbal")).otherwise(F.col("c_acctbal") / 10000).alias("risk"),
                 F.when(small, F.col("c_acctbal") / 10000).otherwise(F.col("c_acctbal")).alias("payment"))
    return prj.swap_columns_if(t, "risk", "payment", 100.0, by=["c_nationkey"])


@query("cast_columns", "PRJ-10 SCL-3", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_tax, l_discount FROM lineitem
""")
def q_cast_columns(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        *[F.col(c).cast("string").alias(c) for c in ("l_extendedprice", "l_tax", "l_discount")])
    return prj.cast_columns(li, parse_number, names=["l_discount"], suffixes=["price", "tax"])


@query("keep_raw", "PRJ-12 SCL-15", """
SELECT c_custkey, CAST(regexp_extract(c_name, '#(\\d+)', 1) AS INTEGER) AS cust_no,
       c_name AS cust_no_raw FROM customer
""")
def q_keep_raw(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("cust_no"))
    return prj.keep_raw(c, "cust_no", lambda x: extract_int(x, r"#(\d+)"))


@query("assign_header", "SRC-12", """
SELECT n_nationkey AS nation_id, n_name AS nation, n_regionkey AS region_id FROM nation
""")
def q_assign_header(spark, sf_dir):
    return assign_header(table(spark, sf_dir, "nation"), ["nation_id", "nation", "region_id"])


# ---------------------------------------------------------------------------
# Incremental selection
# ---------------------------------------------------------------------------

@query("unprocessed_dates", "INC-2", """
SELECT DISTINCT CAST(ts AS DATE) AS snapshot FROM events
EXCEPT
SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE event_type = 'purchase' AND value > 400
""")
def q_unprocessed_dates(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    days = e.select(F.to_date("ts").alias("snapshot")).distinct()
    loaded = e.filter((F.col("event_type") == "purchase") & (F.col("value") > 400)).select(
        F.to_date("ts").alias("snapshot"))
    return inc.unprocessed(days, loaded, "snapshot")


@query("since_threshold", "INC-4", """
SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-15'
""")
def q_since(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts", F.to_date("ts").alias("d"))
    return inc.since(e, "d", F.lit("2024-01-15").cast("date")).drop("d")


@query("exclude_files", "INC-5", """
SELECT doc_id, source, lang FROM documents
WHERE NOT coalesce(starts_with(source, 'src1'), false)
  AND NOT coalesce(lang IN ('de'), false)
""")
def q_exclude(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return inc.exclude_files(d, name="source", prefixes=["src1"], folder="lang", deny_folders=["de"])


@query("pair_files", "INC-6", """
SELECT CAST(o_custkey % 50 AS BIGINT) AS grp,
       max(CASE WHEN starts_with(o_orderpriority, '1') THEN CAST(o_orderkey AS VARCHAR) END) AS data,
       max(CASE WHEN starts_with(o_orderpriority, '2') THEN CAST(o_orderkey AS VARCHAR) END) AS dictionary
FROM orders GROUP BY 1
""")
def q_pair_files(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 50).alias("grp"), F.col("o_orderpriority").alias("name"),
        F.col("o_orderkey").cast("string").alias("path"))
    return inc.pair_files(o, "grp", {"data": "1", "dictionary": "2"}, strict=True)
