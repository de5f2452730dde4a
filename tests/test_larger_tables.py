"""Steps whose tasks grew with the table or with a file: each must stay
within a split."""

import __spark_entry__ as entry
from conftest import SF_SMALL


def _planned(df) -> str:
    """The plan before anything ran: no size of an aggregate is known."""
    return df._jdf.queryExecution().sparkPlan().toString()


def _joined_without_shuffle(spark, name: str) -> None:
    plan = _planned(entry.queries()[name](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_display_matrix_rows_are_not_shuffled_by_file(spark):
    _joined_without_shuffle(spark, "display_matrix_to_long")


def test_matrix_rows_are_not_shuffled_by_file(spark):
    _joined_without_shuffle(spark, "matrix_to_long")


def test_cutpoint_rows_are_not_shuffled_by_file(spark):
    _joined_without_shuffle(spark, "cutpoints_to_long")


def test_path_parts_need_no_regex_for_every_row(spark, tmp_dir):
    from pyspark.sql import functions as F

    from tidemark.functions.dates import base_name, parent_name
    from tidemark.sources import files as src

    paths = ["", "/", "a", "/a", "a/", "a/b", "/x y/b+c.csv", "s3://k/a/1__s.csv", None]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select("p", base_name("p"), parent_name("p"),
                                                                          F.regexp_extract("p", r"([^/]*)$", 1), F.regexp_extract("p", r"([^/]*)/[^/]*$", 1)).collect()
    assert all((r[1], r[2]) == (r[3], r[4]) for r in got)
    folder = f"{tmp_dir}/book one"
    spark.createDataFrame([("1+2", "é%")], "a string, b string").write.option("header", True).csv(f"{folder}/1__s.csv")
    df = src.read_sheets(spark, tmp_dir).select("a", "b", "workbook")
    assert df.first()[:2] == ("1+2", "é%")
    assert "([^/]*)" not in _planned(df)  # its search starts anew at every place of a long path


def _matrix_of(spark, folder, text):
    from tidemark.sources import files as src

    with open(f"{folder}/m.csv", "w") as f:
        f.write(text)
    return src.read_matrix(spark, folder)


def test_records_of_reports_are_put_together_once(spark, tmp_dir):
    m = _matrix_of(spark, tmp_dir, "title\na,b\n1,2\n")
    assert "FileScan text" not in _planned(m)  # the pass that counts the fields has staged them
    assert sorted((r.row_idx, r.cells) for r in m.collect()) == [(0, ["title", None]), (1, ["a", "b"]), (2, ["1", "2"])]


def test_records_with_breaks_are_put_together_once(spark, tmp_dir):
    m = _matrix_of(spark, tmp_dir, 'a,b\n1,"x\n\ny"\n')
    plan = _planned(m)
    assert "Window" not in plan and "Join" not in plan and "FileScan text" not in plan
    assert sorted((r.row_idx, r.cells) for r in m.collect()) == [(0, ["a", "b"]), (1, ["1", "x\n\ny"])]
    lone = "\u0001"  # a mark of the reader's own, as text
    got = _matrix_of(spark, tmp_dir, f'a,b\n{lone},"x\n{lone}y"\n').collect()
    assert sorted((r.row_idx, r.cells) for r in got) == [(0, ["a", "b"]), (1, [lone, f"x\n{lone}y"])]


def test_quoted_splits_meet_their_lines_without_a_shuffle(spark, tmp_dir):
    from tidemark.sources import records as rec

    with open(f"{tmp_dir}/m.csv", "w") as f:
        f.write("a,b\n" + "".join(f'{k},"{k * 2654435761 % 1000003}\n\ny"\n' for k in range(20_000)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")  # below the lines, above the splits
    try:
        plan = _planned(rec.quoted_records(rec.text_lines(spark, tmp_dir)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_workers_that_read_token_files_hold_no_encoder(spark):
    from public_tokenizers import path

    from tidemark.llm import pieces

    first = pieces.encoder(path("word_bpe_49k.json"))
    first("some words to remember")
    pieces.forget()
    assert pieces.encoder.cache_info().currsize == 0
    assert not pieces.encoder(path("word_bpe_49k.json")).pieces.keys() & {"some words to remember"}


def test_forgotten_pieces_give_their_memory_back():
    import subprocess
    import sys

    code = """
import os
from public_tokenizers import path
from tidemark.llm import pieces
def mb():
    return int(open("/proc/self/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6
first = mb()
ids_of = pieces.encoder(path("word_bpe_49k.json"))
got = [ids_of(" ".join("".join(chr(97 + (k * 2654435761 >> s) % 26) for s in range(3, 24, 3)) for k in range(a, a + 100))) for a in range(0, 200_000, 100)]
del ids_of, got
most = mb()
pieces.forget()
print(most - first, mb() - first)
"""
    most, left = map(float, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=200).stdout.split())
    assert left < most / 2, (most, left)


def test_folded_texts_of_a_dictionary_are_written_once(spark, tmp_dir):
    import os

    from pyspark.sql import functions as F

    from tidemark.operators.dictionary import build_dictionary
    from tidemark.session import DICTIONARY_BYTES, apply_engine_conf

    rows = spark.range(60_000).select(
        F.lit("f").alias("file"), F.lit("n").alias("name"), F.when(F.col("id") < 30, "NUM").alias("type"), F.lit("1").alias("length"),
        F.col("id").cast("string").alias("codes"), F.sha1(F.col("id").cast("string")).alias("code_values"), F.col("id").alias("row_idx"))
    out = f"{tmp_dir}/dictionary"
    build_dictionary(rows).write.parquet(out)
    got = spark.read.parquet(out).groupBy(F.xxhash64("code_and_values"), F.length("code_and_values")).count().collect()
    text = "; ".join(f"{r.codes}: {r.code_values}" for r in rows.orderBy("row_idx").collect())
    want = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t"), F.length("t")).first()
    assert [tuple(r) for r in got] == [(*want, 30)]
    assert sum(os.path.getsize(f"{out}/{f}") for f in os.listdir(out)) < 2 * len(text)  # not 30 times
    apply_engine_conf(spark)  # as every registered query does first
    assert spark.conf.get(DICTIONARY_BYTES) == str(1 << 20)


def test_described_rows_of_a_name_are_dealt_out(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.dictionary import build_dictionary

    rows = spark.range(60_000).select(
        F.lit("f").alias("file"), F.lit("n").alias("name"), F.when(F.col("id") < 2400, "NUM").alias("type"), F.lit("1").alias("length"),
        F.col("id").cast("string").alias("codes"), F.sha1(F.col("id").cast("string")).alias("code_values"), F.col("id").alias("row_idx"))
    tasks = build_dictionary(rows).select(F.spark_partition_id().alias("task"), "type").groupBy("task").count().collect()  # 7 GB of text, not made
    assert sum(r["count"] for r in tasks) == 2400
    assert max(r["count"] for r in tasks) < 1600  # a join by name gives all to one task


def test_dealt_out_rows_are_those_of_the_plain_join(spark, monkeypatch):
    from tidemark.operators import dictionary as D

    rows = [(k, f, n, t, "1" if t else None, c, v) for k, (f, n, t, c, v) in enumerate(
        [("f", "a", "NUM" if k % 3 else None, f"{k % 7}" if k % 5 else None, f"v{k}") for k in range(300)]
        + [("f", "b", "CHAR", None, "no codes"), ("f", "c", None, "1", "not described"), ("g", "a", "NUM", "1", "é; x"), ("g", "a", "NUM", "1", "é; x")]
        + [("f", None, "NUM", "1", "x"), (None, "a", "NUM", "1", "x"), (None, None, "NUM", None, "x"), ("f", "d", "NUM", "0", "")])]
    raw = spark.createDataFrame(rows, "row_idx long, file string, name string, type string, length string, codes string, code_values string")
    want = D.build_dictionary(raw)
    assert "REPARTITION_BY_NUM" not in _planned(want)  # little text: no copies
    monkeypatch.setattr(D, "PART_BYTES", 1000)
    monkeypatch.setattr(D, "PART_ROWS", 16)
    got = D.build_dictionary(raw)
    plan = _planned(got)
    assert plan.count("Exchange hashpartitioning(_part") == plan.count("REPARTITION_BY_NUM") == 2  # and not dealt out again
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert want.count() == 200 + 7


def test_folded_texts_are_not_compared_for_statistics(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    from tidemark.operators.dictionary import build_dictionary
    from tidemark.session import FOLDED_STATISTICS, apply_engine_conf

    raw = spark.createDataFrame([(0, "f", "n", "NUM", "1", "1", "one")], "row_idx long, file string, name string, type string, length string, codes string, code_values string")
    build_dictionary(raw).write.parquet(f"{tmp_dir}/d")
    group = pq.read_metadata(glob.glob(f"{tmp_dir}/d/*.parquet")[0]).row_group(0)
    has = {group.column(i).path_in_schema: bool(group.column(i).statistics and group.column(i).statistics.has_min_max) for i in range(group.num_columns)}
    assert not has["code_and_values"] and has["name"]
    apply_engine_conf(spark)  # as every registered query does first
    assert spark.conf.get(FOLDED_STATISTICS) == "true"
