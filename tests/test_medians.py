"""The exact median of hot groups against Spark's."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.aggregates import group_median, selected_median


def numbers(kind, rnd):
    if kind == "ties":
        return float(rnd.choice((1, 1, 1, 2, 3)))
    if kind == "halves":  # the middle lies between two heaps
        return float(rnd.choice((-5, 5))) if rnd.random() < 0.98 else rnd.uniform(-4, 4)
    if kind == "wide":
        return rnd.choice((-1, 1)) * 10.0 ** rnd.uniform(-300, 300)
    if kind == "same":
        return 7.0
    return rnd.gauss(0, 1)


@pytest.mark.parametrize("limit", [1, 10, 300])
def test_equals_the_plain_median(spark, limit):
    rnd = random.Random(limit)
    rows = [(k, numbers(k or "plain", rnd)) for k in ("ties", "halves", "wide", "same", None, "plain") for _ in range(rnd.choice((1500, 2001)))]
    rows += [("small", 1.0), ("small", 4.0), ("none", None), ("two", 3.0), ("plain", None)] + [("infinite", float("inf"))] * 40 + [("infinite", 1.0)] * 30
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: r.median for r in selected_median(df, ["k"], "v", limit=limit).collect()}
    assert got == {r.k: r.median for r in group_median(df, ["k"], "v").collect()}


def test_no_keys_and_two_keys(spark):
    df = spark.range(10_001).select((F.col("id") * 7919 % 10_001).alias("v"), (F.col("id") % 2).alias("a"), F.lit(None).cast("string").alias("b"))
    assert selected_median(df, [], "v", limit=50).first()[0] == 5000.0
    want = {tuple(r) for r in group_median(df, ["a", "b"], "v").collect()}
    assert {tuple(r) for r in selected_median(df, ["a", "b"], "v", limit=50).collect()} == want
