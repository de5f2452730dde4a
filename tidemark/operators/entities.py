"""Organisation-name resolution (ENT-1..4).

``typo_map`` finds, for every name, a more frequent name at edit distance
below ``min_dist`` (``min_dist=2``: distance 0 or 1; ``min_dist=3``: up to 2,
after ignored words are dropped). It never enumerates pairs. Two keys are
within distance 1 iff

* they are equal, or
* deleting the same position ``i`` from both gives the same text (one
  substitution), or
* deleting one character from the longer gives the shorter (one insertion).

Each relation is an equality on a derived key, so candidates are found by
grouping (a group of names sharing ``(variant, i)`` is a clique: every member
is within distance 1 of every other) and by equi-joins of variants to keys.
Per group only the two best members are kept, so a hot group costs one
aggregation, not its square. Work is linear in the total key length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col_
from ..session import cut_lineage

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Legal-form words dropped by standardize_name (whole words, after lower-casing
# and punctuation removal).
LEGAL_SUFFIXES = ("inc", "incorporated", "llc", "corp", "corporation", "co", "company",
                  "ltd", "limited", "lp", "llp", "plc")
# Words ignored when comparing organisation names for typos.
TYPO_IGNORE_WORDS = ("and", "inc", "care", "group")


def standardize_name(c: str | Column, suffixes: Sequence[str] = LEGAL_SUFFIXES) -> Column:
    """ENT-1: lower-case, punctuation removed, legal-form words removed,
    whitespace collapsed and trimmed."""
    s = F.lower(col_(c))
    s = F.regexp_replace(s, r"[^\w\s]", "")
    if suffixes:
        s = F.regexp_replace(s, r"\b(" + "|".join(suffixes) + r")\b", "")
    s = F.regexp_replace(s, r"\s+", " ")
    return F.trim(s)


def comparison_key(c: str | Column, ignore_words: Sequence[str] = TYPO_IGNORE_WORDS) -> Column:
    """Name as compared for typos: ignored words and all spaces removed."""
    s = col_(c)
    if ignore_words:
        s = F.regexp_replace(s, r"\b(" + "|".join(ignore_words) + r")\b", "")
    return F.regexp_replace(s, r"\s+", "")


def _rank(n: Column, name: Column) -> Column:
    """Orders names best first: higher count, then smaller name."""
    return F.struct((-n).alias("neg_n"), name.alias("name"))


def _best_two(df: DataFrame, group: Sequence[str], rank: str = "rank") -> DataFrame:
    """Per group the best and second-best distinct member rank."""
    group = list(group)
    best = df.groupBy(*group).agg(F.min(rank).alias("best1"))
    rest = df.join(best, group).filter(F.col(rank) != F.col("best1"))
    second = rest.groupBy(*group).agg(F.min(rank).alias("best2"))
    return best.join(second, group, "left")


def _deletions(df: DataFrame, src: str = "key") -> DataFrame:
    """One row per single-character deletion of ``src``: ``(..., i, variant)``."""
    out = df.filter(F.length(src) > 0).select("*", F.explode(F.sequence(F.lit(1), F.length(src))).alias("i"))
    return out.withColumn("variant", F.concat(F.expr(f"substring({src}, 1, i - 1)"),
                                              F.expr(f"substring({src}, i + 1)")))


def _other_best(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per member of a clique group, the best other member: ``(name, rank, cand)``."""
    best = _best_two(df, group)
    return df.join(best, list(group)).select(
        "name", "rank", F.when(F.col("best1") != F.col("rank"), F.col("best1"))
        .otherwise(F.col("best2")).alias("cand"))


def _key_best(df: DataFrame, key: str, into: str) -> DataFrame:
    """Best rank per value of ``key``, renamed so it joins on ``into``."""
    return df.groupBy(F.col(key).alias(into)).agg(F.min("rank").alias("cand"))


def typo_map(names: DataFrame, name: str = "name", count: str = "n", min_dist: int = 2,
             ignore_words: Sequence[str] = TYPO_IGNORE_WORDS) -> DataFrame:
    """ENT-2: ``(name, target)`` for each name that has a strictly better
    (more frequent, then smaller) name within edit distance ``< min_dist`` of
    its comparison key; the target is the best such name.

    Exact for ``min_dist`` up to 3 (distance 0, 1 or 2), with no pair
    enumeration: every relation below is an equality on a derived key, found
    by grouping (cliques: keep the best two members) or by equi-joins.
    ``names`` holds one row per distinct name with its count."""
    if min_dist > 3:
        raise ValueError("typo_map is exact for edit distance <= 2 (min_dist <= 3)")
    base = names.select(F.col(name).alias("name"), F.col(count).cast("long").alias("n"))
    base = base.withColumns({"key": comparison_key(F.col("name"), ignore_words),
                             "rank": _rank(F.col("n"), F.col("name"))}).select("name", "rank", "key")
    cands = [_other_best(base, ["key"])]  # distance 0: equal keys

    if min_dist >= 2:
        d1 = _deletions(base).select("name", "rank", "key", "i", "variant")
        # one substitution: same variant at the same position (a clique)
        cands.append(_other_best(d1, ["variant", "i"]))
        # one deletion / insertion: a variant of one key is the other key
        cands.append(d1.join(_key_best(base, "key", "variant"), "variant").select("name", "rank", "cand"))
        cands.append(base.join(_key_best(d1, "variant", "key"), "key").select("name", "rank", "cand"))

    if min_dist >= 3:
        # same length, one insertion and one deletion (or one substitution):
        # a shared one-deletion variant at any position; any two are within 2
        d1v = d1.select("name", "rank", "variant").distinct()
        cands.append(_other_best(d1v, ["variant"]))
        # two deletions from each key, at the same two positions: two substitutions
        d2 = _deletions(d1.withColumnRenamed("variant", "v1").withColumnRenamed("i", "i1"), "v1") \
            .filter(F.col("i") >= F.col("i1"))  # second position after the first (in the shortened key)
        d2s = d2.select("name", "rank", "i1", F.col("i").alias("i2"), "variant")
        cands.append(_other_best(d2s, ["variant", "i1", "i2"]))
        # two deletions / insertions: a two-deletion variant of one key is the other key
        d2v = d2.select("name", "rank", "variant").distinct()
        cands.append(d2v.join(_key_best(base, "key", "variant"), "variant").select("name", "rank", "cand"))
        cands.append(base.join(_key_best(d2v, "variant", "key"), "key").select("name", "rank", "cand"))
        # one deletion plus one substitution (lengths differ by one): the longer key
        # minus any character, then minus position q, equals the shorter key minus
        # position q; every cross pair in a (variant, q) group is within 2
        longer = _deletions(d1v.withColumnRenamed("variant", "v1"), "v1") \
            .select("name", "rank", F.col("i").alias("q"), "variant").distinct()
        shorter = d1.select("name", "rank", F.col("i").alias("q"), "variant")
        best_short = shorter.groupBy("variant", "q").agg(F.min("rank").alias("cand"))
        best_long = longer.groupBy("variant", "q").agg(F.min("rank").alias("cand"))
        cands.append(longer.join(best_short, ["variant", "q"]).select("name", "rank", "cand"))
        cands.append(shorter.join(best_long, ["variant", "q"]).select("name", "rank", "cand"))

    allc = cands[0]
    for c in cands[1:]:
        allc = allc.unionByName(c)
    best = (allc.filter(F.col("cand").isNotNull())
            .groupBy("name", "rank").agg(F.min("cand").alias("target_rank")))
    return best.filter(F.col("target_rank") < F.col("rank")).select(
        "name", F.col("target_rank.name").alias("target"))


def canonical_names(raw: DataFrame, column: str, min_dist: int = 2,
                    ignore_words: Sequence[str] = TYPO_IGNORE_WORDS) -> DataFrame:
    """ENT-3: ``(raw_name, canonical_name)`` for every distinct raw spelling.

    Raw spellings are counted, standardised (ENT-1) and the counts summed per
    standard name (AGG-9); standard names are typo-corrected (ENT-2); the
    canonical name is the commonest raw spelling (AGG-8) of the corrected
    standard name. A raw name whose standard name has no spelling keeps
    itself."""
    counts = raw.groupBy(F.col(column).alias("raw_name")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.filter(F.col("raw_name").isNotNull()).withColumn("std", standardize_name("raw_name"))
    # one row per distinct spelling, used by four branches below: written once
    # to the shared folder so the facts are aggregated once, not per branch
    counts = cut_lineage(counts, name="name_counts")
    std_counts = counts.groupBy("std").agg(F.sum("n").alias("n"))
    fix = typo_map(std_counts, "std", "n", min_dist, ignore_words)
    spelling = _commonest_spelling(counts)
    corrected = counts.join(fix.select(F.col("name").alias("std"), "target"), "std", "left").withColumn(
        "std_fixed", F.coalesce("target", "std"))
    out = corrected.join(spelling.select(F.col("std").alias("std_fixed"), F.col("raw_name").alias("canon")),
                         "std_fixed", "left")
    return out.select("raw_name", F.coalesce("canon", "raw_name").alias("canonical_name"))


def _commonest_spelling(counts: DataFrame) -> DataFrame:
    """Per standard name the raw spelling with the highest count (ties: the
    smaller spelling)."""
    return (counts.groupBy("std")
            .agg(F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("raw_name").alias("raw"))).alias("b"))
            .select("std", F.col("b.raw").alias("raw_name")))


def apply_canonical(df: DataFrame, column: str, mapping: DataFrame, raw: str = "raw_name",
                    canonical: str = "canonical_name") -> DataFrame:
    """ENT-4: replace ``column`` by its canonical name where one is known.
    The mapping is one row per distinct raw name; adaptive execution picks
    the join from its measured size."""
    m = mapping.select(F.col(raw).alias("__raw"), F.col(canonical).alias("__canon"))
    j = df.join(m, F.col(column) == F.col("__raw"), "left")
    return j.withColumn(column, F.coalesce(F.col("__canon"), F.col(column))).drop("__raw", "__canon")
