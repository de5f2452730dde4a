"""Proof queries for sinks and file round trips (SNK-1..5, SNK-8, SRC-1,
SRC-2, SRC-9).

Each query writes driver data to a fresh folder under the shared checkpoint
root, applies the sink operation under test, and returns the table as read
back. The SQL twin states the table's expected final content.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import parse_number
from ..session import scratch_path
from ..sinks import tables as snk
from ..sources.files import FILE_PATH, read_csv_text, read_tsv_text
from .catalog import query, table


def _orders_by_month(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderstatus", "o_totalprice",
                    F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyy-MM"),
                             F.lit(".csv")).alias("src_file_name"))


@query("replace_slice_by_file", "SNK-1", """
SELECT o_orderkey, o_orderstatus, o_totalprice, src_file_name FROM (
  SELECT o_orderkey, o_orderstatus, o_totalprice,
         'orders_' || strftime(o_orderdate, '%Y-%m') || '.csv' AS src_file_name FROM orders) t
WHERE src_file_name NOT IN ('orders_1995-06.csv', 'orders_1995-07.csv')
UNION ALL
SELECT o_orderkey, o_orderstatus, round(o_totalprice * 2, 2), 'orders_1995-06.csv' FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = '1995-06' AND o_orderstatus <> 'P'
""")
def q_replace_slice_file(spark, sf_dir):
    path = scratch_path(spark, "replace_slice_by_file")
    o = _orders_by_month(spark, sf_dir)
    snk.replace_slice(o, path, "src_file_name")
    june = "orders_1995-06.csv"
    redo = (o.filter((F.col("src_file_name") == june) & (F.col("o_orderstatus") != "P"))
            .withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2)))
    snk.replace_slice(redo, path, "src_file_name", value=june)
    july = "orders_1995-07.csv"
    snk.replace_slice(o.filter(F.lit(False)), path, "src_file_name", value=july)  # empty: slice removed
    return snk.read_table(spark, path).select("o_orderkey", "o_orderstatus", "o_totalprice", "src_file_name")


@query("replace_slice_by_date", "SNK-2", """
SELECT event_id, event_type,
       CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN value * 10 ELSE value END AS value,
       CAST(ts AS DATE) AS src_file_date
FROM events
WHERE CAST(ts AS DATE) <> DATE '2024-01-11'
  AND (CAST(ts AS DATE) <> DATE '2024-01-10' OR event_type = 'purchase')
""")
def q_replace_slice_date(spark, sf_dir):
    path = scratch_path(spark, "replace_slice_by_date")
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value",
                                               F.to_date("ts").alias("src_file_date"))
    snk.replace_slice(e, path, "src_file_date")
    import datetime as dt
    day = dt.date(2024, 1, 10)
    redo = (e.filter((F.col("src_file_date") == F.lit(day)) & (F.col("event_type") == "purchase"))
            .withColumn("value", F.col("value") * 10))
    snk.replace_slice(redo, path, "src_file_date", value=day)
    snk.replace_slice(e.filter(F.lit(False)), path, "src_file_date", value=dt.date(2024, 1, 11))
    back = snk.read_table(spark, path)
    return back.select("event_id", "event_type", "value", F.to_date("src_file_date").alias("src_file_date"))


@query("replace_table", "SNK-3", "SELECT n_nationkey, upper(n_name) AS n_name, n_regionkey FROM nation")
def q_replace_table(spark, sf_dir):
    path = scratch_path(spark, "replace_table")
    n = table(spark, sf_dir, "nation")
    snk.replace_table(n, path)
    first = snk.read_table(spark, path)
    # the new content is derived from the table being replaced
    snk.replace_table(first.withColumn("n_name", F.upper("n_name")), path)
    return snk.read_table(spark, path).select("n_nationkey", "n_name", "n_regionkey")


@query("evolve_schema", "SNK-4", """
SELECT o_orderkey, o_custkey, o_totalprice, NULL::VARCHAR AS o_orderpriority, o_orderstatus FROM orders
WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT o_orderkey, o_custkey + 4294967296, o_totalprice, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderstatus NOT IN ('F', 'O')
""")
def q_evolve_schema(spark, sf_dir):
    path = scratch_path(spark, "evolve_schema")
    o = table(spark, sf_dir, "orders")
    first = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"),
                                                           "o_totalprice", "o_orderstatus")
    snk.replace_slice(first, path, "o_orderstatus")
    # a later file: one more column, and the price exported as text
    second = o.filter(F.col("o_orderstatus") == "O").select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), F.col("o_totalprice").cast("string").alias("o_totalprice"),
        "o_orderpriority", "o_orderstatus")
    snk.replace_slice(second, path, "o_orderstatus", value="O")
    # then every other status, with customer numbers beyond the column's int
    third = o.filter(~F.col("o_orderstatus").isin("F", "O")).select(
        "o_orderkey", (F.col("o_custkey").cast("bigint") + F.lit(1 << 32)).alias("o_custkey"), "o_totalprice",
        "o_orderpriority", "o_orderstatus")
    snk.replace_slice(third, path, "o_orderstatus")
    return snk.read_table(spark, path).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                                              "o_orderstatus")


@query("upsert_partitioned", "SNK-5", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderstatus FROM orders
""")
def q_upsert_partitioned(spark, sf_dir):
    path = scratch_path(spark, "upsert_partitioned")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    keys = ["o_orderkey", "o_orderstatus"]
    snk.upsert(o.filter(F.col("o_orderkey") % 3 > 0), path, keys, partition_by=["o_orderstatus"])
    snk.upsert(o.filter(F.col("o_orderkey") % 3 == 0), path, keys, partition_by=["o_orderstatus"])
    snk.upsert(o.filter(F.col("o_orderstatus") == "P").withColumn("o_totalprice", F.col("o_totalprice") * 2), path, keys,
               partition_by=["o_orderstatus"])  # the other partitions stay as they are
    return snk.read_table(spark, path).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query("upsert_null_keys", "SNK-5", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice + CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 5 ELSE 0 END AS o_totalprice
FROM orders WHERE o_orderkey IN (SELECT max(o_orderkey) FROM orders GROUP BY o_custkey)
UNION ALL
SELECT NULL, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, max(o_totalprice) + 1 FROM orders GROUP BY o_orderstatus
""")
def q_upsert_null_keys(spark, sf_dir):
    """Null partitions and null keys: rows of a null partition stay, a null
    key is one row."""
    path = scratch_path(spark, "upsert_null_keys")
    o = table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    last = o.groupBy("o_custkey").agg(F.max("o_orderkey").alias("o_orderkey")).select("o_orderkey")
    rows = o.join(last, "o_orderkey").select("o_orderkey", "o_orderstatus", "o_totalprice")
    top = o.groupBy("o_orderstatus").agg(F.max("o_totalprice").alias("o_totalprice")).select(
        F.lit(None).cast("long").alias("o_orderkey"), "o_orderstatus", "o_totalprice")
    keys = ["o_orderkey", "o_orderstatus"]
    snk.upsert(rows.unionByName(top), path, keys, partition_by=["o_orderstatus"])
    again = rows.filter(F.col("o_orderstatus").isNull() & (F.col("o_orderkey") % 2 == 0)).withColumn("o_totalprice", F.col("o_totalprice") + 5)
    snk.upsert(again.unionByName(top.withColumn("o_totalprice", F.col("o_totalprice") + 1)), path, keys, partition_by=["o_orderstatus"])
    return snk.read_table(spark, path).select(*keys, "o_totalprice")


@query("upsert_buckets", "SNK-5", """
SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 7 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders
UNION ALL SELECT NULL, count(*), CAST(sum(o_custkey) AS DOUBLE) FROM orders
""")
def q_upsert_buckets(spark, sf_dir):
    """A table without a natural partition, dealt by a hash of its key."""
    path = scratch_path(spark, "upsert_buckets")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    total = o.agg(F.count(F.lit(1)).alias("o_custkey"), F.sum("o_custkey").cast("double").alias("o_totalprice")).select(
        F.lit(None).cast("long").alias("o_orderkey"), "o_custkey", "o_totalprice")
    snk.upsert(o.filter(F.col("o_custkey") % 3 > 0).unionByName(total.withColumn("o_totalprice", F.lit(0.0))), path, ["o_orderkey"], buckets=32)
    snk.upsert(o.filter(F.col("o_custkey") % 3 == 0).unionByName(total), path, ["o_orderkey"], buckets=32)
    twice = o.filter(F.col("o_custkey") % 7 == 0).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    snk.upsert(twice, path, ["o_orderkey"])  # the table knows its buckets
    return snk.read_table(spark, path).select("o_orderkey", "o_custkey", "o_totalprice")


@query("replace_slice_nested_name", "SNK-1", """
SELECT o_orderkey, 'reports/' || o_orderpriority || '/x=1.csv' AS src_file_name FROM orders WHERE o_orderpriority <> '1-URGENT'
""")
def q_replace_slice_nested(spark, sf_dir):
    """Slice names with slashes and other characters that paths escape."""
    path = scratch_path(spark, "replace_slice_nested")
    name = F.concat(F.lit("reports/"), F.col("o_orderpriority"), F.lit("/x=1.csv"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", name.alias("src_file_name"))
    snk.replace_slice(o, path, "src_file_name")
    snk.replace_slice(o.filter(F.lit(False)), path, "src_file_name", value="reports/1-URGENT/x=1.csv")
    return snk.read_table(spark, path).select("o_orderkey", "src_file_name")


@query("upsert", "SNK-5 AGG-6", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderdate >= DATE '1995-01-01' THEN o_totalprice + 1 ELSE o_totalprice END
         AS o_totalprice
FROM orders
""")
def q_upsert(spark, sf_dir):
    path = scratch_path(spark, "upsert")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderdate")
    cut = F.lit("1995-01-01").cast("date")
    early = o.filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("date")).drop("o_orderdate")
    late = o.filter(F.col("o_orderdate") >= cut).drop("o_orderdate")
    snk.upsert(early, path, ["o_orderkey"])
    # the second half overlaps the first and lists each record twice
    newer = late.withColumn("o_totalprice", F.col("o_totalprice") + 1).unionByName(late)
    snk.upsert(newer, path, ["o_orderkey"], order=[("o_totalprice", "desc")])
    return snk.read_table(spark, path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


_EVENT_DOC = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("props", T.StructType([T.StructField("k", T.LongType())]))])


@query("json_docs_round_trip", "SNK-8 SRC-9", """
SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def q_json_docs(spark, sf_dir):
    path = scratch_path(spark, "json_docs")
    e = table(spark, sf_dir, "events")
    docs = e.select("event_id", "user_id", "event_type",
                    F.from_json("props", "k BIGINT").alias("props"))
    snk.write_json_docs(docs, path, keys=["event_id"])
    back = spark.read.schema(_EVENT_DOC).json(path)
    return back.select("event_id", "user_id", "event_type", F.col("props.k").alias("k"))


@query("csv_round_trip", "SRC-1 SCL-3 SCL-7", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority FROM orders
""")
def q_csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv_round_trip")
    o = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    o.write.option("header", True).csv(path)
    t = read_csv_text(spark, path)
    return t.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                    F.col("o_custkey").cast("bigint").alias("o_custkey"), "o_orderstatus",
                    parse_number("o_totalprice").alias("o_totalprice"),
                    F.to_date("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")


@query("tsv_latin1_round_trip", "SRC-2", """
SELECT c_custkey, c_name || ' "é" ' || c_mktsegment AS label FROM customer
""")
def q_tsv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "tsv_latin1")
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.concat(F.col("c_name"), F.lit(' "é" '), F.col("c_mktsegment")).alias("label"))
    (c.write.option("header", True).option("sep", "\t").option("encoding", "ISO-8859-1")
     .option("quote", "\u0000").option("escape", "\u0000").csv(path))
    t = read_tsv_text(spark, path)
    assert FILE_PATH in t.columns
    return t.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "label")


@query("json_props", "SRC-9", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_json_props(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


@query("incremental_stream_load", "INC-1 SNK-1 SRC-1", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
""")
def q_stream_load(spark, sf_dir):
    """Orders land as CSV files in two waves; an availableNow file stream
    loads each wave, skipping files already loaded (its checkpoint), and
    replaces the slice of every new file."""
    from ..streaming.file_loader import run_csv_load
    root = scratch_path(spark, "stream_load")
    landing, target, ckpt = f"{root}/landing", f"{root}/table", f"{root}/checkpoint"
    o = table(spark, sf_dir, "orders").select(*[F.col(c).cast("string").alias(c) for c in
                                                ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")])
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    o.filter(F.col("o_orderstatus") != "P").write.mode("append").option("header", True).csv(landing)
    run_csv_load(spark, landing, cols, target, checkpoint=ckpt)
    swapped = o.filter(F.col("o_orderstatus") == "P").select(*reversed(cols))  # goes by the names in its header
    swapped.write.mode("append").option("header", True).csv(landing)
    run_csv_load(spark, landing, cols, target, checkpoint=ckpt)  # only the new files
    t = snk.read_table(spark, target)
    return t.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                    F.col("o_custkey").cast("bigint").alias("o_custkey"), "o_orderstatus",
                    parse_number("o_totalprice").alias("o_totalprice"))
