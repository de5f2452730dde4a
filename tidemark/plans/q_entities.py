"""Proof queries for organisation-name resolution (ENT-1..4).

The SQL twins resolve typos by brute force (``levenshtein`` over all name
pairs, affordable for the oracle on the test tables); the Spark side never
forms pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import entities as E
from .catalog import query, table

_SUFFIX_RE = r"\b(" + "|".join(E.LEGAL_SUFFIXES) + r")\b"
_IGNORE_RE = r"\b(" + "|".join(E.TYPO_IGNORE_WORDS) + r")\b"


def _std_sql(x: str) -> str:
    s = f"regexp_replace(lower({x}), '[^\\w\\s]', '', 'g')"
    s = f"regexp_replace({s}, '{_SUFFIX_RE}', '', 'g')"
    s = f"regexp_replace({s}, '\\s+', ' ', 'g')"
    return f"trim({s})"


def _key_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{_IGNORE_RE}', '', 'g'), '\\s+', '', 'g')"


def _typo_sql(names_cte: str, max_distance: int = 1) -> str:
    """Brute-force twin of typo_map over a CTE ``(name, n)``."""
    return f"""
keyed AS (SELECT name, n, {_key_sql("name")} AS key FROM {names_cte}),
pairs AS (
  SELECT a.name, b.name AS target, b.n AS tn FROM keyed a JOIN keyed b
    ON a.name <> b.name AND levenshtein(a.key, b.key) <= {max_distance}
   AND (b.n > a.n OR (b.n = a.n AND b.name < a.name))),
fix AS (
  SELECT name, target FROM (
    SELECT name, target, row_number() OVER (PARTITION BY name ORDER BY tn DESC, target) AS rn FROM pairs) t
  WHERE rn = 1)"""


def _typo_names():
    """Part names with injected typos: a dropped last letter, a changed first
    letter, an inserted letter."""
    k = F.col("p_partkey") % 7
    n = F.col("p_name")
    return (F.when(k == 0, F.expr("substring(p_name, 1, length(p_name) - 1)"))
            .when(k == 1, F.concat(F.lit("x"), F.expr("substring(p_name, 2)")))
            .when(k == 2, F.concat(n, F.lit("s")))
            .otherwise(n))


_TYPO_NAMES_SQL = """CASE p_partkey % 7 WHEN 0 THEN substr(p_name, 1, length(p_name) - 1)
                                        WHEN 1 THEN 'x' || substr(p_name, 2)
                                        WHEN 2 THEN p_name || 's' ELSE p_name END"""


@query("standardize_name", "ENT-1", f"""
SELECT s_suppkey, {_std_sql("raw")} AS std_name FROM (
  SELECT s_suppkey, CASE s_nationkey % 4 WHEN 0 THEN s_name WHEN 1 THEN upper(s_name) || ', Inc.'
                                         WHEN 2 THEN 'The ' || s_name || ' Company  LLC'
                                         ELSE '  ' || s_name || ' (Group) ' END AS raw
  FROM supplier) t
""")
def q_standardize(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    m = F.col("s_nationkey") % 4
    raw = (F.when(m == 0, F.col("s_name"))
           .when(m == 1, F.concat(F.upper("s_name"), F.lit(", Inc.")))
           .when(m == 2, F.concat(F.lit("The "), F.col("s_name"), F.lit(" Company  LLC")))
           .otherwise(F.concat(F.lit("  "), F.col("s_name"), F.lit(" (Group) "))))
    return s.select("s_suppkey", E.standardize_name(raw).alias("std_name"))


@query("typo_map", "ENT-2", f"""
WITH names AS (SELECT {_TYPO_NAMES_SQL} AS name, count(*) AS n FROM part GROUP BY 1),
{_typo_sql("names")}
SELECT name, target FROM fix
""")
def q_typo_map(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    names = p.groupBy(_typo_names().alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return E.typo_map(names, "name", "n", min_dist=2)


@query("typo_map_distance2", "ENT-2", f"""
WITH names AS (SELECT {_TYPO_NAMES_SQL} AS name, count(*) AS n FROM part GROUP BY 1),
{_typo_sql("names", 2)}
SELECT name, target FROM fix
""")
def q_typo_map2(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    names = p.groupBy(_typo_names().alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return E.typo_map(names, "name", "n", min_dist=3)


@query("canonical_names", "ENT-3 ENT-4 AGG-8 AGG-9", f"""
WITH raw AS (
  SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name)
                                        WHEN 2 THEN p_name || ', Inc.'
                                        WHEN 3 THEN substr(p_name, 2) ELSE p_name END AS raw_name
  FROM part),
counts AS (SELECT raw_name, count(*) AS n, {_std_sql("raw_name")} AS std FROM raw GROUP BY raw_name),
stdc AS (SELECT std AS name, sum(n) AS n FROM counts GROUP BY std),
{_typo_sql("stdc")},
spelling AS (
  SELECT std, raw_name FROM (
    SELECT std, raw_name, row_number() OVER (PARTITION BY std ORDER BY n DESC, raw_name) AS rn FROM counts) t
  WHERE rn = 1),
canon AS (
  SELECT c.raw_name, coalesce(s.raw_name, c.raw_name) AS canonical_name
  FROM counts c LEFT JOIN fix f ON c.std = f.name
  LEFT JOIN spelling s ON s.std = coalesce(f.target, c.std))
SELECT r.p_partkey, r.raw_name, coalesce(c.canonical_name, r.raw_name) AS organization_name
FROM raw r LEFT JOIN canon c ON r.raw_name = c.raw_name
""")
def q_canonical(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 5
    raw = (F.when(k == 0, F.col("p_name")).when(k == 1, F.upper("p_name"))
           .when(k == 2, F.concat(F.col("p_name"), F.lit(", Inc.")))
           .when(k == 3, F.expr("substring(p_name, 2)")).otherwise(F.col("p_name")))
    facts = p.select("p_partkey", raw.alias("raw_name"))
    mapping = E.canonical_names(facts, "raw_name")
    out = E.apply_canonical(facts.withColumn("organization_name", F.col("raw_name")),
                            "organization_name", mapping)
    return out.select("p_partkey", "raw_name", "organization_name")
