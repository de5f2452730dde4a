"""Further proof queries for readers, sinks and parsers on hard cases: quotes
and line breaks in values, wide records, listings, documents in files of their
own, comments, large integers, and descending text order."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.scalars import parse_int_commas
from ..operators.aggregates import one_per_key
from ..session import scratch_path
from ..sinks import tables as snk
from ..sources import files as src
from .catalog import query, table


@query("csv_quoted_round_trip", "SRC-1", """
SELECT doc_id, text || ' "a, b" ' || lang AS t FROM documents
""")
def q_csv_quoted(spark, sf_dir):
    """Quotes, commas and line breaks inside values survive."""
    path = scratch_path(spark, "csv_quoted")
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit(' "a, b" '), "lang").alias("t"))
    (d.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return src.read_csv_text(spark, path).select(F.col("doc_id").cast("bigint").alias("doc_id"), "t")


@query("wide_matrix", "SRC-5", """
SELECT c_custkey, c_custkey * 300 + 299 AS last_cell FROM customer
""")
def q_wide_matrix(spark, sf_dir):
    """Records of 301 fields: the width comes from the files."""
    path = scratch_path(spark, "wide_matrix")
    c = table(spark, sf_dir, "customer")
    cells = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(299)), lambda i: (F.col("c_custkey") * 300 + i).cast("string")), ",")
    c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), cells)).write.text(path)
    m = src.read_matrix(spark, path, multiline=False)
    return m.select(F.get("cells", F.lit(0)).cast("bigint").alias("c_custkey"),
                    F.get("cells", F.lit(300)).cast("bigint").alias("last_cell"))


@query("list_files", "SRC-11", """
SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS parent, TRUE AS has_bytes FROM orders
""")
def q_list_files(spark, sf_dir):
    path = scratch_path(spark, "list_files")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    files = src.list_files(spark, path, "*.parquet")
    return files.groupBy("parent").agg(F.bool_and(F.col("length") > 0).alias("has_bytes"))


@query("json_document_files", "SRC-9", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_json_files(spark, sf_dir):
    """One document per file."""
    path = scratch_path(spark, "json_files")
    table(spark, sf_dir, "nation").write.option("maxRecordsPerFile", 1).json(path)
    return src.read_json_docs(spark, path).select("n_nationkey", "n_name", "n_regionkey")


@query("dictionary_comments", "SNK-6 SNK-7", """
SELECT 'n_' || lower(r_name) AS name, r_name || '; ' || min(n_name) AS comment
FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name
UNION ALL
SELECT 'table', 'Nations by region'
""")
def q_comments(spark, sf_dir):
    """A table with a column per region, commented with its first nation."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    d = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.lit("nations").alias("file"), F.concat(F.lit("n_"), F.lower("r_name")).alias("name"), F.col("r_name").alias("title"),
        F.col("n_name").alias("field_title"))
    other = d.select(F.lit("other").alias("file"), "name", F.lit("A").alias("title"), F.lit("of another file").alias("field_title"))
    dictionary = d.unionByName(other)
    name, path = f"comments_{uuid.uuid4().hex[:12]}", scratch_path(spark, "comments")
    counts = n.join(r, n.n_regionkey == r.r_regionkey).groupBy().pivot(
        "r_name", [x[0] for x in r.select("r_name").orderBy("r_name").collect()]).count()
    counts.select(*[F.col(f"`{c}`").alias("n_" + c.lower().replace(" ", "_")) for c in counts.columns]).write.parquet(path)
    dictionary = dictionary.withColumn("column", F.replace("name", F.lit(" "), F.lit("_")))
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    try:
        snk.comment_columns(spark, name, snk.dictionary_comments(dictionary, "nations", name="column"))
        snk.comment_table(spark, name, "Nations by region")
        rows = [(c.name.replace("_", " ").replace("n ", "n_", 1), c.description) for c in spark.catalog.listColumns(name)]
        said = {x[0]: x[1] for x in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        rows.append(("table", said.get("Comment")))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame(rows, "name string, comment string")


@query("melt_hos_rates", "RSH-1", """
SELECT CAST(c_custkey AS VARCHAR) AS contract_number, indicator_key, CAST(c_acctbal AS VARCHAR) AS rate, measure_code
FROM customer, (VALUES ('discussing_fall_risk_rate', 'FRM'), ('managing_fall_risk_rate', 'FRM'),
  ('discussing_physical_activity_rate', 'PAO-HOS'), ('advising_physical_activity_rate', 'PAO-HOS'),
  ('discussing_urinary_incontinence_rate', 'MUI-HOS'), ('treatment_of_urinary_incontinence_rate', 'MUI-HOS'),
  ('impact_of_urinary_incontinence_rate', 'MUI-HOS')) t(indicator_key, measure_code)
""")
def q_hos_rates(spark, sf_dir):
    """Two, two and three rates a contract."""
    from .reports import HOS_RATES, hos_rates
    rate = F.col("c_acctbal").cast("string")
    sheet = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("contract_number"),
                                                    *[rate.alias(f"rate{k}") for k in (1, 2, 3)])
    parts = [hos_rates(sheet, code) for code in HOS_RATES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("contract_number", "indicator_key", "rate", "measure_code")


@query("parse_int_commas_large", "SCL-2", """
SELECT l_orderkey, l_linenumber, 9007199254740993 + l_orderkey AS n FROM lineitem
""")
def q_large_ints(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    text = F.format_number(F.lit(9007199254740993).cast("decimal(20,0)") + F.col("l_orderkey"), 0)
    return li.select("l_orderkey", "l_linenumber", parse_int_commas(text).alias("n"))


@query("one_per_key_text_desc", "AGG-6 ORD-2", """
SELECT o_custkey, o_orderpriority, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_orderkey) AS rn FROM orders)
WHERE rn = 1
""")
def q_text_desc(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderkey")
    return one_per_key(o, ["o_custkey"], [("o_orderpriority", "desc"), ("o_orderkey", "asc")])
