"""Proof queries for nested documents (NST-1..6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import nested as N
from .catalog import query, table


def _conversation_docs(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.collect_list(F.struct("turn", "role", "text")).alias("turns"))


@query("explode_children", "NST-1 NST-3", """
SELECT conv_id, turn, role, text, count(*) OVER (PARTITION BY conv_id) AS n_turns FROM conversations
""")
def q_explode_children(spark, sf_dir):
    docs = _conversation_docs(spark, sf_dir)
    rows = N.explode_children(docs, "turns", keep=["conv_id", "n_turns"], alias="t")
    return rows.select("conv_id", "t.turn", "t.role", "t.text", "n_turns")


@query("push_down_array", "NST-3", """
SELECT conv_id, turn, role, count(*) OVER (PARTITION BY conv_id) AS n_turns FROM conversations
""")
def q_push_down(spark, sf_dir):
    docs = _conversation_docs(spark, sf_dir)
    docs = N.push_down(docs, "turns", {"conv_turns": F.col("n_turns")})
    rows = N.explode_children(docs, "turns", keep=["conv_id"], alias="t")
    return rows.select("conv_id", "t.turn", "t.role", F.col("t.conv_turns").alias("n_turns"))


@query("lift_struct", "NST-2", """
SELECT event_id, user_id, upper(event_type) AS event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events
""")
def q_lift_struct(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    docs = e.select("event_id", "user_id", "event_type",
                    F.struct(F.from_json("props", "k BIGINT")["k"].alias("k"),
                             F.upper("event_type").alias("event_type")).alias("planCharacteristics"))
    return N.lift_struct(docs, "planCharacteristics")


_CODES = {"click": "Click through", "view": "Page view", "error": ""}


def _event_docs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    note = F.when(t == "view", F.lit("")).when(t == "click", F.lit(None).cast("string")).otherwise(t)
    item = F.struct(t.alias("categoryCode"), F.col("value").alias("value"))
    empty_item = F.struct(F.lit("signup").alias("categoryCode"), F.lit(None).cast("double").alias("value"))
    return e.select(
        "event_id",
        t.alias("categoryCode"),
        F.struct(F.upper(t).alias("categoryCode"), note.alias("note"),
                 F.array(item, empty_item).alias("items"),
                 F.struct(t.alias("categoryCode")).alias("inner")).alias("detail"))


@query("remap_field_deep", "NST-4", """
SELECT event_id,
       CASE event_type WHEN 'click' THEN 'Click through' WHEN 'view' THEN 'Page view' WHEN 'error' THEN ''
                       ELSE event_type END AS top_code,
       upper(event_type) AS detail_code,
       CASE event_type WHEN 'click' THEN 'Click through' WHEN 'view' THEN 'Page view' WHEN 'error' THEN ''
                       ELSE event_type END AS item_code,
       'signup' AS second_item_code,
       CASE event_type WHEN 'click' THEN 'Click through' WHEN 'view' THEN 'Page view' WHEN 'error' THEN ''
                       ELSE event_type END AS inner_code
FROM events
""")
def q_remap_field_deep(spark, sf_dir):
    docs = _event_docs(spark, sf_dir)
    m = F.create_map(*[F.lit(x) for kv in _CODES.items() for x in kv])
    out = N.remap_field_deep(docs, "categoryCode", m)
    return out.select("event_id", F.col("categoryCode").alias("top_code"),
                      F.col("detail.categoryCode").alias("detail_code"),
                      F.col("detail.items")[0]["categoryCode"].alias("item_code"),
                      F.col("detail.items")[1]["categoryCode"].alias("second_item_code"),
                      F.col("detail.inner.categoryCode").alias("inner_code"))


@query("prune_empty_deep", "NST-5", """
SELECT event_id,
       event_type NOT IN ('view', 'click') AS has_note,
       true AS has_items,
       2 AS n_items,
       event_type AS top_code
FROM events
""")
def q_prune_empty_deep(spark, sf_dir):
    docs = _event_docs(spark, sf_dir)
    j = N.prune_empty_deep(docs)
    schema = ("event_id BIGINT, categoryCode STRING, detail STRUCT<categoryCode: STRING, note: STRING, "
              "items: ARRAY<STRUCT<categoryCode: STRING, value: DOUBLE>>>")
    back = j.select("doc_json", F.from_json("doc_json", schema).alias("d"))
    return back.select(F.col("d.event_id").alias("event_id"),
                       F.col("doc_json").contains('"note"').alias("has_note"),
                       F.col("doc_json").contains('"items"').alias("has_items"),
                       F.size("d.detail.items").alias("n_items"),
                       F.col("d.categoryCode").alias("top_code"))


@query("labels_from_dictionary", "NST-6 SCL-19", """
WITH t AS (
  SELECT c_custkey, c_mktsegment || ': ' || c_name || '; X' || CAST(c_nationkey AS VARCHAR) || ': '
         || CAST(c_custkey AS VARCHAR) || ': extra; lonely;' AS code_and_values
  FROM customer),
u AS (
  SELECT c_custkey, unnest(range(len(string_split(code_and_values, ';')))) AS pos,
         string_split(code_and_values, ';') AS items FROM t)
SELECT c_custkey, CAST(pos AS INTEGER) AS pos,
       regexp_replace(split_part(items[pos + 1], ': ', 1), '^\\s+|\\s+$', '', 'g') AS code,
       CASE WHEN position(': ' IN items[pos + 1]) > 0
            THEN substr(items[pos + 1], position(': ' IN items[pos + 1]) + 2) ELSE '' END AS label
FROM u
""")
def q_labels(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    txt = F.concat(F.col("c_mktsegment"), F.lit(": "), F.col("c_name"), F.lit("; X"),
                   F.col("c_nationkey").cast("string"), F.lit(": "), F.col("c_custkey").cast("string"),
                   F.lit(": extra; lonely;"))
    d = c.select("c_custkey", txt.alias("code_and_values"))
    return N.labels_from_dictionary(d, keep=["c_custkey"])


@query("merge_labels", "NST-6", """
WITH items AS (
  SELECT n_regionkey, unnest(string_split(n_name || ': label ' || CAST(n_nationkey AS VARCHAR), ';')) AS item
  FROM nation),
lab AS (
  SELECT regexp_replace(split_part(item, ': ', 1), '^\\s+|\\s+$', '', 'g') AS code,
         substr(item, position(': ' IN item) + 2) AS label FROM items),
d AS (SELECT * FROM (VALUES ('ALGERIA', 'default A'), ('ZZZ', 'default Z')) v(code, label))
SELECT code, label FROM lab
UNION ALL
SELECT code, label FROM d WHERE code NOT IN (SELECT code FROM lab)
""")
def q_merge_labels(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    txt = F.concat(F.col("n_name"), F.lit(": label "), F.col("n_nationkey").cast("string"))
    lab = N.labels_from_dictionary(n.select(txt.alias("code_and_values")))
    return N.merge_labels({"ALGERIA": "default A", "ZZZ": "default Z"}, lab)
