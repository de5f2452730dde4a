"""Records of split files against Python's csv module, header drift in one
plan, and the streaming load of odd files."""

import contextlib
import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import tables as snk
from tidemark.sources import files as src
from tidemark.sources import records as rec
from tidemark.streaming.file_loader import run_csv_load


@contextlib.contextmanager
def small_splits(spark, size):
    """Splits of ``size`` bytes, so that a small file has many."""
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def write(folder, name, text, encoding="utf-8"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def cell(rnd):
    return rnd.choice(("", "a", "b c", "5", "x,y", 'say ""', '"quoted"', "line\nbreak", "two\n\nbreaks", ",\n,", '",', '"\n"', "é ü", " pad ", ",", "\n", '"'))


def test_records_equal_the_csv_module(spark, tmp_dir):
    rnd = random.Random(7)
    want = {}
    for k in range(60):
        rows = [[cell(rnd) for _ in range(rnd.randint(2, 6))] for _ in range(rnd.randint(1, 25))]
        out = io.StringIO()
        csv.writer(out, lineterminator=rnd.choice(("\n", "\r\n"))).writerows(rows)
        text = ("﻿" if k % 7 == 0 else "") + out.getvalue() + "\n" * (k % 3)
        want[write(tmp_dir, f"f{k:02d}.csv", text)] = rows
    width = max(len(r) for rows in want.values() for r in rows)
    for size in (23, 1 << 20):
        with small_splits(spark, size):
            got = src.read_matrix(spark, tmp_dir).collect()
            assert src.matrix_width(spark, tmp_dir) == width
        by_file = {}
        for r in got:
            by_file.setdefault(r.src_file_path.removeprefix("file:").replace("//", "/"), []).append((r.row_idx, list(r.cells)))
        assert set(by_file) == set(want)
        for path, rows in want.items():
            found = sorted(by_file[path])
            assert [i for i, _ in found] == list(range(len(rows))), path  # no gaps
            assert [[x or "" for x in c] for _, c in found] == [r + [""] * (width - len(r)) for r in rows], path


def test_quotes_inside_plain_values_open_nothing(spark, tmp_dir):
    path = write(tmp_dir, "inches.csv", 'size,name\n5" pipe,a\n6 x 7",b\n"two\nlines",c\nO"Brien,d\n')
    got = sorted(map(tuple, src.read_matrix(spark, path).select("row_idx", "cells").collect()))
    assert [c for _, c in got] == [["size", "name"], ['5" pipe', "a"], ['6 x 7"', "b"], ["two\nlines", "c"], ['O"Brien', "d"]]


def test_a_record_with_two_quoted_breaks(spark, tmp_dir):
    text = 'a,b,c,d,e,"x\ny",f,g,h,"z\nw",i,j,k,l\n'
    path = write(tmp_dir, "two.csv", text)
    assert src.matrix_width(spark, path) == 14
    assert src.read_matrix(spark, path).first()["cells"] == ["a", "b", "c", "d", "e", "x\ny", "f", "g", "h", "z\nw", "i", "j", "k", "l"]


def test_a_large_file_with_breaks_is_read_by_many_tasks(spark, tmp_dir):
    path = write(tmp_dir, "large.csv", "k,t\n" + "".join(f'{i},"first {i}\nsecond, ""{i}"""\n' for i in range(4000)))
    with small_splits(spark, 16 << 10):
        lines = rec.text_lines(spark, path)
        assert lines.rdd.getNumPartitions() >= 8
        got = src.read_csv_text(spark, path)
        assert "multiLine" not in got._jdf.queryExecution().toString()
        rows = sorted((int(r.k), r.t) for r in got.collect())
    assert rows == [(i, f'first {i}\nsecond, "{i}"') for i in range(4000)]


def test_an_open_quote_fails_the_job(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(rec, "MAX_LINES", 50)
    path = write(tmp_dir, "open.csv", 'a,b\n1,"never closed\n' + "2,3\n" * 80)
    with pytest.raises(Exception, match="never closed"):
        src.read_matrix(spark, path, 2).collect()


def test_two_hundred_layouts_in_one_scan(spark, tmp_dir):
    rnd = random.Random(3)
    names = [f"n{i}" for i in range(40)]
    want = set()
    for k in range(200):
        mine = rnd.sample(names, rnd.randint(1, 12))
        write(tmp_dir, f"f{k:03d}.csv", ",".join(["id", *mine]) + "\n" + "".join(",".join([f"{k}.{j}", *(f"{k}.{j}.{n}" for n in mine)]) + "\n" for j in range(3)))
        for j in range(3):
            want.add((f"{k}.{j}", *(f"{k}.{j}.{n}" if n in mine else None for n in names)))
    df = src.read_csv_text(spark, tmp_dir)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Relation") <= 2  # the staged records and one descriptor row a file
    assert {tuple(r) for r in df.select("id", *names).collect()} == want
    assert df.columns[0] == "id" and df.columns[-1] == src.FILE_PATH


def test_names_of_headers(spark, tmp_dir):
    write(tmp_dir, "a.csv", "k,,A,a,x\n1,2,3,4,5\n")
    write(tmp_dir, "b.csv", "x,k\n9,8\n")
    got = {r.k: r.asDict() for r in src.read_csv_text(spark, tmp_dir, with_path=False).collect()}
    assert got["1"] == {"k": "1", "_c1": "2", "A2": "3", "a3": "4", "x": "5"}
    assert got["8"] == {"k": "8", "_c1": None, "A2": None, "a3": None, "x": "9"}
    one = write(tmp_dir, "p.txt", "title\nX,,X,X.1,Y,,\n1,2,3,4,5,,\n")
    got = src.read_with_preamble(spark, one, 1).drop(src.FILE_PATH, "row_idx")
    assert got.columns == ["X", "unnamed_1", "X.1", "X.1.1", "Y"] and tuple(got.first()) == ("1", "2", "3", "4", "5")
    with pytest.raises(Exception, match="beyond the header"):
        src.read_with_preamble(spark, write(tmp_dir, "q.txt", "title\nX\n1,2\n"), 1).collect()


def test_latin1_records_and_other_encodings(spark, tmp_dir):
    path = write(tmp_dir, "l.csv", 'a,b\n"é\nü",1\n', "latin-1")
    assert [r.cells for r in src.read_matrix(spark, path, encoding="ISO-8859-1").orderBy("row_idx").collect()] == [["a", "b"], ["é\nü", "1"]]
    path = write(tmp_dir, "u.csv", 'a,b\n"é\nü",1\n', "utf-16")
    assert [r.cells for r in src.read_matrix(spark, path, 2, "UTF-16").orderBy("row_idx").collect()] == [["a", "b"], ["é\nü", "1"]]


def test_streaming_load_goes_by_names_and_whole_records(spark, tmp_dir):
    landing, table = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "t")
    os.makedirs(landing)
    write(landing, "a.csv", "x,y\n1,2\n")
    write(landing, "b.csv", 'y,x\n1,2\n"says ""hi"", ok",2\n"line\nbreak",3\n')
    run_csv_load(spark, landing, ["x", "y"], table)
    names = ("x", "y", "src_file_name")
    want = {("1", "2", "a.csv"), ("2", "1", "b.csv"), ("2", 'says "hi", ok', "b.csv"), ("3", "line\nbreak", "b.csv")}
    assert {tuple(r) for r in snk.read_table(spark, table).select(*names).collect()} == want
    write(landing, "c d.csv", "z,y\n7,8\n")
    run_csv_load(spark, landing, ["x", "y"], table)  # the new file alone, without one of the columns
    assert {tuple(r) for r in snk.read_table(spark, table).select(*names).collect()} == want | {(None, "8", "c d.csv")}


def test_row_numbers_over_splits_have_no_gaps(spark, tmp_dir):
    path = write(tmp_dir, "n.csv", "".join(f"{i},{'x' * (i % 50)}\n" + "\n" * (i % 5 == 0) for i in range(3000)))
    with small_splits(spark, 4096):
        for how in (False, True, None):
            m = src.read_matrix(spark, path, 2, multiline=how)
            assert m.where(F.col("row_idx").cast("string") != F.col("cells")[0]).count() == 0
            assert m.agg(F.count(F.lit(1)), F.max("row_idx"), F.count_distinct("row_idx")).first()[:] == (3000, 2999, 3000)
