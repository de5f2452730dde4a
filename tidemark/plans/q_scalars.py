"""Proof queries for the text parsers (SCL-1..20).

Each query renders driver values as the dirty text a report would hold
(money with ``$`` and parentheses, comma numbers, sentinels, zone names,
periods with odd separators), parses it back with the Column functions and
returns the typed values. The SQL twin states the expected values directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from .catalog import query, table

NUM_RE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _money_text():
    bal = F.col("c_acctbal")
    return (F.when(bal < 0, F.concat(F.lit("($"), F.format_number(-bal, 2), F.lit(")")))
            .when(F.col("c_nationkey") == 3, F.lit("Not Applicable"))
            .otherwise(F.concat(F.lit(" $"), F.format_number(bal, 2), F.lit(" "))))


@query("parse_money", "SCL-1", f"""
WITH t AS (
  SELECT c_custkey,
         CASE WHEN c_acctbal < 0 THEN '($' || format('{{:,.2f}}', -c_acctbal) || ')'
              WHEN c_nationkey = 3 THEN 'Not Applicable'
              ELSE ' $' || format('{{:,.2f}}', c_acctbal) || ' ' END AS money_text
  FROM customer),
u AS (SELECT *, trim(replace(money_text, '$', '')) AS s FROM t),
v AS (SELECT *, starts_with(s, '(') AND ends_with(s, ')') AS neg, trim(s, '()') AS core FROM u)
SELECT c_custkey, money_text,
       CASE WHEN regexp_matches(replace(core, ',', ''), '{NUM_RE}')
            THEN CAST(replace(core, ',', '') AS DOUBLE) * CASE WHEN neg THEN -1 ELSE 1 END END AS amount,
       CASE WHEN regexp_matches(core, '{NUM_RE}') THEN CAST(core AS DOUBLE) END AS legacy_amount
FROM v
""")
def q_parse_money(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", _money_text().alias("money_text"))
    return c.select("c_custkey", "money_text", S.parse_money("money_text").alias("amount"),
                    S.parse_money("money_text", legacy=True).alias("legacy_amount"))


@query("parse_int_commas", "SCL-2", f"""
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'P' THEN '*'
              WHEN o_orderpriority = '5-LOW' THEN '12.5'
              ELSE format('{{:,d}}', o_orderkey * 1000 + o_custkey) END AS txt
  FROM orders),
u AS (SELECT *, replace(txt, ',', '') AS s FROM t)
SELECT o_orderkey, txt,
       CASE WHEN regexp_matches(s, '{NUM_RE}') AND CAST(s AS DOUBLE) = floor(CAST(s AS DOUBLE))
            THEN CAST(CAST(s AS DOUBLE) AS BIGINT) END AS enrollment
FROM u
""")
def q_parse_int_commas(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    txt = (F.when(F.col("o_orderstatus") == "P", F.lit("*"))
           .when(F.col("o_orderpriority") == "5-LOW", F.lit("12.5"))
           .otherwise(F.format_number(F.col("o_orderkey") * 1000 + F.col("o_custkey"), 0)))
    o = o.select("o_orderkey", txt.alias("txt"))
    return o.withColumn("enrollment", S.parse_int_commas("txt"))


@query("parse_number", "SCL-3", f"""
WITH t AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN CAST(value AS VARCHAR) || 'd'
              WHEN event_type = 'view' THEN ' ' || CAST(value AS VARCHAR) || ' '
              WHEN event_type = 'click' THEN 'NR'
              ELSE CAST(value AS VARCHAR) END AS txt
  FROM events)
SELECT event_id,
       CASE WHEN regexp_matches(trim(txt), '{NUM_RE}') THEN CAST(trim(txt) AS DOUBLE) END AS amount
FROM t
""")
def q_parse_number(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    v = F.col("value").cast("string")
    t = F.col("event_type")
    txt = (F.when(t == "error", F.concat(v, F.lit("d")))
           .when(t == "view", F.concat(F.lit(" "), v, F.lit(" ")))
           .when(t == "click", F.lit("NR")).otherwise(v))
    return e.select("event_id", S.parse_number(txt).alias("amount"))


@query("parse_number_strict", "SCL-4", """
SELECT l_orderkey, l_linenumber, l_extendedprice AS price FROM lineitem
""")
def q_parse_strict(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     S.parse_number_strict(F.col("l_extendedprice").cast("string")).alias("price"))


@query("parse_thousands", "SCL-5", "SELECT o_orderkey, o_totalprice AS total FROM orders")
def q_parse_thousands(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", S.parse_thousands(F.format_number("o_totalprice", 2)).alias("total"))


@query("parse_percent", "SCL-6", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'R' THEN NULL
            ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) AS DOUBLE) END AS discount_pct
FROM lineitem
""")
def q_parse_percent(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    pct = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    txt = F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(pct)
    return li.select("l_orderkey", "l_linenumber", S.parse_percent(txt).alias("discount_pct"))


@query("parse_int", "SCL-7", """
SELECT c_custkey,
       CASE WHEN c_nationkey IN (1, 2, 3) THEN NULL ELSE CAST(c_custkey AS INTEGER) END AS enrollment
FROM customer
""")
def q_parse_int(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = F.col("c_nationkey")
    txt = (F.when(n == 1, "*").when(n == 2, "abc").when(n == 3, "1.5")
           .otherwise(F.col("c_custkey").cast("string")))
    return c.select("c_custkey", S.parse_int(txt).alias("enrollment"))


@query("zfill", "SCL-8", """
WITH t AS (
  SELECT c_custkey,
         CASE c_nationkey % 4 WHEN 0 THEN CAST(c_custkey % 1000 AS VARCHAR)
                              WHEN 1 THEN '-' || CAST(c_custkey % 10 AS VARCHAR)
                              WHEN 2 THEN CAST(c_custkey * 1000 AS VARCHAR) END AS code
  FROM customer)
SELECT c_custkey, code,
       CASE WHEN length(code) >= 5 THEN code
            WHEN left(code, 1) IN ('+', '-') THEN left(code, 1) || lpad(substr(code, 2), 4, '0')
            ELSE lpad(code, 5, '0') END AS county_code
FROM t
""")
def q_zfill(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    m = F.col("c_nationkey") % 4
    code = (F.when(m == 0, (k % 1000).cast("string"))
            .when(m == 1, F.concat(F.lit("-"), (k % 10).cast("string")))
            .when(m == 2, (k * 1000).cast("string")))
    return c.select("c_custkey", code.alias("code")).withColumn("county_code", S.zfill("code", 5))


@query("date_prefix", "SCL-9", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END
       AS contract_effective_date
FROM orders
""")
def q_date_prefix(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    txt = F.when(F.col("o_orderstatus") == "P", F.lit("N/A")).otherwise(
        F.concat(F.date_format("o_orderdate", "MM/dd/yyyy"), F.lit(" 0:00:00")))
    return o.select("o_orderkey", S.date_prefix(txt).alias("contract_effective_date"))


@query("parse_us_date", "SCL-10", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def q_parse_us_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", S.parse_us_date(F.date_format("o_orderdate", "M/d/yyyy")).alias("d"))


_ZONE_BY_USER = ["Central Standard Time", "", "Pacific Daylight Time", "India Standard Time",
                 "Mars Standard Time"]


def _zone_case_sql(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.ZONE_NAMES.items())
    return f"CASE {col} {whens} END"


@query("parse_zoned_timestamp", "SCL-11", f"""
WITH t AS (
  SELECT event_id, user_id, ts,
         CASE user_id % 6 WHEN 0 THEN 'Central Standard Time' WHEN 1 THEN ''
                          WHEN 2 THEN 'Pacific Daylight Time' WHEN 3 THEN 'India Standard Time'
                          WHEN 4 THEN 'Mars Standard Time' END AS zone_name
  FROM events),
u AS (
  SELECT event_id,
         CASE WHEN user_id % 6 = 5 THEN strftime(ts, '%d-%b-%y')
              ELSE strftime(ts, '%m/%d/%Y %I:%M:%S %p') || ' ' || zone_name END AS txt,
         {_zone_case_sql("CASE WHEN zone_name = '' THEN 'Eastern Standard Time' ELSE zone_name END")} AS tzid,
         ts, user_id
  FROM t)
SELECT event_id, txt,
       CASE WHEN user_id % 6 = 5 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
            WHEN tzid IS NULL THEN NULL
            ELSE timezone('UTC', timezone(tzid, CAST(strptime(substr(txt, 1, 22), '%m/%d/%Y %I:%M:%S %p')
                                                     AS TIMESTAMP))) END AS submitted_utc
FROM u
""")
def q_parse_zoned(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    m = F.col("user_id") % 6
    zone = F.lit(None).cast("string")
    for i, z in enumerate(_ZONE_BY_USER):
        zone = F.when(m == i, F.lit(z)).otherwise(zone)
    txt = F.when(m == 5, F.date_format("ts", "dd-MMM-yy")).otherwise(
        F.concat(F.date_format("ts", "MM/dd/yyyy hh:mm:ss a"), F.lit(" "), zone))
    out = e.select("event_id", txt.alias("txt"))
    return out.withColumn("submitted_utc", S.parse_zoned_timestamp("txt").cast("timestamp_ntz"))


@query("parse_period", "SCL-12 SCL-13", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL
            WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE)
            ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS period_start,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL
            WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) + 90
            ELSE last_day(CAST(o_orderdate AS DATE) + 90) END AS period_end
FROM orders
""")
def q_parse_period(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    later = F.date_add(F.to_date("o_orderdate"), 90)
    txt = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit("Not Applicable"))
           .when(F.col("o_orderstatus") == "P",
                 F.concat(F.date_format("o_orderdate", "MM/dd/yyyy"), F.lit(" - "),
                          F.date_format(later, "MM/dd/yyyy"), F.lit(" (Monday - Friday)\u0096")))
           .otherwise(F.concat(F.date_format("o_orderdate", "MM/yyyy"), F.lit(" – "),
                               F.date_format(later, "MM/yyyy"))))
    p = S.parse_period(S.clean_text(txt))
    return o.select("o_orderkey", p["start"].alias("period_start"), p["end"].alias("period_end"))


@query("complete_month", "SCL-13", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       last_day(CAST(o_orderdate AS DATE)) AS month_end
FROM orders
""")
def q_complete_month(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = F.date_format("o_orderdate", "MM/yyyy")
    return o.select("o_orderkey", S.complete_month(t, "start").alias("month_start"),
                    S.complete_month(t, "end").alias("month_end"))


@query("parse_range", "SCL-14", """
WITH t AS (
  SELECT p_partkey,
         CASE p_size % 5 WHEN 0 THEN '>= ' || CAST(p_size AS VARCHAR) || ' to < ' || CAST(p_size + 9 AS VARCHAR)
                         WHEN 1 THEN '< ' || CAST(p_size AS VARCHAR)
                         WHEN 2 THEN '>= ' || CAST(p_size AS VARCHAR) || '.5'
                         WHEN 3 THEN '0.' || CAST(p_size AS VARCHAR) || '-0.9'
                         ELSE 'no number' END AS original_text
  FROM part),
u AS (SELECT *, regexp_extract_all(original_text, '(-?\\d+\\.?\\d*)', 1) AS nums FROM t)
SELECT p_partkey, original_text,
       CASE WHEN len(nums) >= 2 THEN CAST(nums[1] AS DOUBLE)
            WHEN len(nums) = 1 AND NOT contains(original_text, '<') THEN CAST(nums[1] AS DOUBLE) END
         AS lower_bound,
       CASE WHEN len(nums) >= 2 THEN CAST(nums[len(nums)] AS DOUBLE)
            WHEN len(nums) = 1 AND contains(original_text, '<') THEN CAST(nums[1] AS DOUBLE) END
         AS upper_bound
FROM u
""")
def q_parse_range(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    s = F.col("p_size")
    ss = s.cast("string")
    m = s % 5
    txt = (F.when(m == 0, F.concat(F.lit(">= "), ss, F.lit(" to < "), (s + 9).cast("string")))
           .when(m == 1, F.concat(F.lit("< "), ss))
           .when(m == 2, F.concat(F.lit(">= "), ss, F.lit(".5")))
           .when(m == 3, F.concat(F.lit("0."), ss, F.lit("-0.9")))
           .otherwise(F.lit("no number")))
    p = p.select("p_partkey", txt.alias("original_text"))
    r = S.parse_range("original_text")
    return p.select("p_partkey", "original_text", r["lower"].alias("lower_bound"),
                    r["upper"].alias("upper_bound"))


@query("clean_text", "SCL-16", """
SELECT doc_id,
       regexp_replace(replace(replace(text, '(Monday - Friday)', ''), chr(150), ''),
                      '^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$', '', 'g') AS cleaned
FROM documents
""")
def q_clean_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", S.clean_text("text").alias("cleaned"))


@query("flag_codes", "SCL-17 SCL-3", f"""
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'F' THEN 'NQ' WHEN o_orderstatus = 'P' THEN 'NR'
              WHEN o_orderpriority = '1-URGENT' THEN 'BR'
              ELSE CAST(o_custkey AS VARCHAR) || '.5' END AS rate_text
  FROM orders)
SELECT o_orderkey, coalesce(rate_text = 'NQ', false) AS rate_nq, coalesce(rate_text = 'NR', false) AS rate_nr,
       coalesce(rate_text = 'NB', false) AS rate_nb, coalesce(rate_text = 'BR', false) AS rate_br,
       CASE WHEN regexp_matches(trim(rate_text), '{NUM_RE}') THEN CAST(trim(rate_text) AS DOUBLE) END AS rate
FROM t
""")
def q_flag_codes(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    txt = (F.when(F.col("o_orderstatus") == "F", "NQ").when(F.col("o_orderstatus") == "P", "NR")
           .when(F.col("o_orderpriority") == "1-URGENT", "BR")
           .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".5"))))
    o = o.select("o_orderkey", txt.alias("rate_text"))
    flags = S.flag_codes("rate_text")
    return o.select("o_orderkey", *[v.alias(k) for k, v in flags.items()],
                    S.parse_number("rate_text").alias("rate"))


@query("null_tokens", "SCL-18", """
SELECT event_id, CASE WHEN txt IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan',
    '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN NULL
    ELSE txt END AS event_type
FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'NA' WHEN 'view' THEN 'n/a'
                                       WHEN 'click' THEN '' ELSE event_type END AS txt FROM events) t
""")
def q_null_tokens(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    txt = F.when(t == "error", "NA").when(t == "view", "n/a").when(t == "click", "").otherwise(t)
    return e.select("event_id", S.null_tokens(txt).alias("event_type"))


@query("concat_label", "SCL-19", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END || ': ' || c_name
       AS code_and_value
FROM customer
""")
def q_concat_label(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    seg = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment"))
    return c.select("c_custkey", S.concat_label(seg, "c_name").alias("code_and_value"))


@query("heading_tokens", "SCL-20", """
WITH l AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line_no,
         string_split(text, chr(10)) AS lines FROM documents),
t AS (
  SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, list_filter(string_split_regex(
           regexp_replace(lines[line_no + 1], '^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$', '', 'g'),
           '[ \\t\\n\\r\\f\\v]+'), lambda w: w <> '') AS words
  FROM l)
SELECT doc_id, line_no, words[-1] AS measure_code,
       array_to_string(list_slice(words, 1, greatest(len(words) - 1, 0)), ' ') AS measure_desc
FROM t
""")
def q_heading_tokens(spark, sf_dir):
    """Every line of every document read as a heading: last word (code) and
    the words before it (description)."""
    d = table(spark, sf_dir, "documents")
    lines = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("doc_id", "line_no", S.last_token("line").alias("measure_code"),
                        S.all_but_last("line").alias("measure_desc"))


@query("split_heading", "RSH-5", """
SELECT c_custkey, trim(split_part(c_name, '#', 1)) AS measure_code,
       trim(split_part(c_name, '#', -1)) AS measure_name
FROM customer
""")
def q_split_heading(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    code, name = S.split_heading("c_name", "#")
    return c.select("c_custkey", code.alias("measure_code"), name.alias("measure_name"))
