"""Sinks: null keys, hash buckets, and writes that break off."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import tables as snk


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def files(path):
    """Data files by folder, with the time and name that a rewrite changes."""
    out = {}
    for folder, _, names in os.walk(path.removeprefix("file:")):
        found = {n for n in names if n.endswith(".parquet")}
        if found:
            out[os.path.basename(folder)] = found
    return out


def test_upsert_keeps_rows_of_a_null_partition(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    names = "p string, k int, v string"
    snk.upsert(spark.createDataFrame([(None, 1, "a"), ("x", 1, "b")], names), path, ["p", "k"], partition_by=["p"])
    snk.upsert(spark.createDataFrame([(None, 2, "new"), ("", 3, "empty")], names), path, ["p", "k"], partition_by=["p"])
    assert rows(snk.read_table(spark, path), "p", "k", "v") == [("x", 1, "b"), (None, 1, "a"), (None, 2, "new"), (None, 3, "empty")]


@pytest.mark.parametrize("how", [{}, {"buckets": 4}])
def test_upsert_null_key_is_one_row(spark, tmp_dir, how):
    path = f"{tmp_dir}/t"
    snk.upsert(spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string"), path, ["k"], **how)
    snk.upsert(spark.createDataFrame([(None, "c"), (2, "d")], "k int, v string"), path, ["k"], **how)
    assert rows(snk.read_table(spark, path), "k", "v") == [(1, "b"), (2, "d"), (None, "c")]


def test_upsert_rewrites_the_buckets_of_its_keys_alone(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    table = spark.range(5000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    snk.upsert(table, path, ["k"], buckets=100)
    assert snk.bucket_layout(spark, path) == (100, ["k"])
    before = files(path)
    assert len(before) == 100
    one = table.withColumn("b", snk._bucket(["k"], 100)).where("b = '17'").select("k", F.lit("new").alias("v")).limit(1)
    snk.upsert(one, path, ["k"])
    after = files(path)
    assert [f for f in before if before[f] != after[f]] == [f"{snk.BUCKET}=17"]  # 1 % of the buckets
    got = snk.read_table(spark, path)
    assert got.columns == ["k", "v"] and got.count() == 5000 and got.where("v = 'new'").count() == 1


def test_rebucket_and_its_limits(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    snk.upsert(spark.range(50).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("v")), path, ["k"])
    with pytest.raises(ValueError, match="rebucket"):
        snk.upsert(spark.createDataFrame([(1, 2)], "k int, v int"), path, ["k"], buckets=8)
    snk.rebucket(spark, path, ["k"], 8)
    snk.upsert(spark.createDataFrame([(1, 2), (99, 3)], "k int, v int"), path, ["k"])
    snk.rebucket(spark, path, ["k"], 3)
    assert snk.bucket_layout(spark, path) == (3, ["k"])
    got = snk.read_table(spark, path)
    assert got.count() == 51 and rows(got.where("k in (1, 99)"), "k", "v") == [(1, 2), (99, 3)]
    with pytest.raises(ValueError, match="dealt by"):
        snk.upsert(spark.createDataFrame([(1, 2)], "k int, v int"), path, ["v"])
    with pytest.raises(ValueError, match="keep their type"):
        snk.upsert(spark.createDataFrame([(1 << 40, 2)], "k long, v int"), path, ["k"])


class Broken(Exception):
    pass


def broken_write(monkeypatch):
    """Every Parquet write fails from now on, before any data are written."""
    from pyspark.sql.readwriter import DataFrameWriter

    def stop(self, path, *a, **k):
        raise Broken

    monkeypatch.setattr(DataFrameWriter, "parquet", stop)


def test_a_write_that_breaks_off_leaves_a_readable_table(spark, tmp_dir, monkeypatch):
    """The schema is widened first; whether the data follow or not, the table
    reads, and nothing is hidden."""
    path = f"{tmp_dir}/t"
    day = dt.date(2024, 1, 1)
    snk.replace_slice(spark.createDataFrame([(1, day)], "n int, d date"), path, "d")
    wider = spark.createDataFrame([(1 << 40, "x", dt.date(2024, 1, 2))], "n long, extra string, d date")
    with monkeypatch.context() as m:
        broken_write(m)
        with pytest.raises(Broken):
            snk.replace_slice(wider, path, "d")
    assert rows(snk.read_table(spark, path), "n", "extra") == [(1, None)]
    snk.replace_slice(wider, path, "d")
    assert rows(snk.read_table(spark, path), "n", "extra") == [(1, None), (1 << 40, "x")]


def test_data_without_their_schema_are_read(spark, tmp_dir, monkeypatch):
    """Between writing the data and an old schema nothing can go wrong: the
    schema of a slice is there before its first file is."""
    path = f"{tmp_dir}/t"
    snk.replace_slice(spark.createDataFrame([(1, "a")], "n int, s string"), path, "s")
    seen = []
    real = snk._store_schema
    monkeypatch.setattr(snk, "_store_schema", lambda sp, p, schema: (seen.append(sorted(files(path))), real(sp, p, schema)))
    snk.replace_slice(spark.createDataFrame([(2, 0.5, "b")], "n int, x double, s string"), path, "s")
    assert seen == [["s=a"]]
    assert rows(snk.read_table(spark, path), "n", "x") == [(1, None), (2, 0.5)]


def test_first_write_that_breaks_off_binds_nothing(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    with monkeypatch.context() as m:
        broken_write(m)
        with pytest.raises(Broken):
            snk.replace_slice(spark.createDataFrame([(1, "a")], "n int, s string"), path, "s")
    assert not snk.path_exists(spark, path)
    snk.replace_slice(spark.createDataFrame([("text", "a")], "n string, s string"), path, "s")
    assert rows(snk.read_table(spark, path), "n", "s") == [("text", "a")]


def test_a_schema_swap_that_breaks_off(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    snk.replace_slice(spark.createDataFrame([(1, "a")], "n int, s string"), path, "s")
    name = f"{path}/{snk._SCHEMA_FILE}"
    os.rename(name, name + ".new")
    assert rows(snk.read_table(spark, path), "n", "s") == [(1, "a")]
    with open(name + ".new") as f:
        whole = f.read()
    with open(name, "w") as f:
        f.write(whole)
    with open(name + ".new", "w") as f:
        f.write(whole[:10])  # a new one that was cut short is not taken
    assert rows(snk.read_table(spark, path), "n", "s") == [(1, "a")]
