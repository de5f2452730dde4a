"""Records of delimited text, put together from the lines of split files.

A quoted value may run over line ends, so a record may be several lines, and
whether a line opens a record depends on all lines before it. Each line is a
map from the state in which it begins (outside or inside a quoted value) to
the one in which it ends:

- a quote that only opens (it follows a separator) ends outside states: the
  line is inside from there on, however it began;
- a quote that only closes (a separator or the line's end follows) likewise
  ends inside states;
- a quote that may do both turns the state around;
- doubled quotes, and quotes in the middle of a value, are text.

Such maps compose, and the map of any run of lines is again one of four. A
running composition over the lines of a split, and one over the splits of a
file, give the state of every line, the number of the record that it belongs
to, and with it the exact number of each record in its file. Files of any size
are read by as many tasks as they have splits. Only files in which some line
does end inside a value are dealt by split (their lines need an order), and
only records of several lines are gathered; all other text stays where it is.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

FILE_PATH = "src_file_path"
#: Lines of one record at most: a quote that is never closed fails the job
#: instead of gathering the rest of the file.
MAX_LINES = 1_000_000
#: Encodings whose line ends are those of ASCII.
BY_LINE = {"utf-8": "UTF-8", "utf8": "UTF-8", "us-ascii": "US-ASCII", "iso-8859-1": "ISO-8859-1", "latin1": "ISO-8859-1", "latin-1": "ISO-8859-1"}

_BOTH, _OPENS, _CLOSES = "\u0001", "\u0002", "\u0003"


def metadata_path() -> Column:
    """Path of the file a row was read from, decoded (``_metadata.file_path``
    is a URI: spaces come as ``%20``)."""
    return decoded(F.col("_metadata.file_path"))


def decoded(uri: Column) -> Column:
    """A URI without its escapes, looked for only where there are some; ``+``
    is protected from decoding."""
    return F.when(F.contains(uri, F.lit("%")), F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))).otherwise(uri)


def _listed(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def text_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8", blank: bool = True, **options) -> DataFrame:
    """``src_file_path, block, at, line``: the lines of the files (blank ones
    too, unless told otherwise) with the start of their split and a number
    that counts them within it. Lines end at line feeds; a carriage return
    before one stays with the line."""
    charset = BY_LINE[encoding.lower()]
    r = spark.read.format("text").option("lineSep", "\n")
    for k in ("recursiveFileLookup", "pathGlobFilter"):
        if k in options:
            r = r.option(k, options[k])
    value = F.col("value") if charset == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
    read = r.load(_listed(paths))
    read = read if blank else read.where(~_blank("value"))
    lines = read.select(metadata_path().alias(FILE_PATH), F.col("_metadata.file_block_start").alias("block"),
                                          F.monotonically_increasing_id().alias("at"), value.alias("line"))
    marked = (F.col("block") == 0) & F.startswith("line", F.lit("﻿"))
    return lines.withColumn("line", F.when(marked, F.substring("line", 2, 1 << 30)).otherwise(F.col("line"))) if charset == "UTF-8" else lines


def _line_map(line: Column, sep: str, quote: str) -> tuple[Column, Column]:
    """A line as a map of states (0 outside, 1 inside): the constant that it
    sets, if any, and whether it turns the state around after that.

    Plain replacements, as every line needs them: with a separator added at
    both ends and each one doubled, every quote has its neighbours to itself."""
    has, marks = F.contains(line, F.lit(quote)), line
    for mark in (_BOTH, _OPENS, _CLOSES):  # ours alone
        marks = F.replace(marks, F.lit(mark), F.lit(" "))
    marks = F.when(F.endswith(marks, F.lit("\r")), marks.substr(F.lit(1), F.length(marks) - 1)).otherwise(marks)
    marks = F.replace(F.replace(marks, F.lit(2 * quote), F.lit("")), F.lit(sep), F.lit(2 * sep))
    marks = F.concat(F.lit(sep), marks, F.lit(sep))
    for pattern, mark in ((sep + quote + sep, _BOTH), (sep + quote, _OPENS), (quote + sep, _CLOSES)):
        marks = F.replace(marks, F.lit(pattern), F.lit(mark))
    opened = F.substring_index(marks, _OPENS, -1)  # what follows the last quote that only opens
    rest = F.substring_index(opened, _CLOSES, -1)
    sets = F.when(F.contains(opened, F.lit(_CLOSES)), 0).when(F.contains(marks, F.lit(_OPENS)), 1)
    turns = (F.octet_length(rest) - F.octet_length(F.replace(rest, F.lit(_BOTH), F.lit("")))) % 2
    return F.when(has, sets), F.when(has, turns).otherwise(F.lit(0))


def _blank(line: str | Column) -> Column:
    return F.col(line).isin("", "\r") if isinstance(line, str) else line.isin("", "\r")


def broken_files(lines: DataFrame, sep: str = ",", quote: str = '"') -> DataFrame:
    """``src_file_path, broken``: whether some line of the file that begins
    outside ends inside a quoted value: one distributed pass."""
    sets, turns = _line_map(F.col("line"), sep, quote)
    ends = (F.coalesce(sets, F.lit(0)) + turns) % 2
    return lines.groupBy(FILE_PATH).agg((F.max(ends) == 1).alias("broken"))


def plain_records(lines: DataFrame) -> DataFrame:
    """``src_file_path, row_idx, record`` of files whose lines, read without
    the blank ones, are records. The rows of each split are counted; a prefix sum over the splits of a file
    and the place within the split give the row's exact number."""
    splits = lines.groupBy(FILE_PATH, "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(FILE_PATH).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col(FILE_PATH).alias("of"), F.col("block").alias("of_block"), "first",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    got = lines.join(splits, (F.col(FILE_PATH) == F.col("of")) & (F.col("block") == F.col("of_block")))
    return got.select(FILE_PATH, (F.col("base") + F.col("at") - F.col("first")).alias("row_idx"), F.regexp_replace("line", "\r$", "").alias("record"))


def quoted_records(lines: DataFrame, sep: str = ",", quote: str = '"') -> DataFrame:
    """``src_file_path, row_idx, record`` of files with quoted line breaks."""
    spark = lines.sparkSession
    sets, turns = _line_map(F.col("line"), sep, quote)
    inside = Window.partitionBy(FILE_PATH, "block").orderBy("at")  # a split at a time
    so_far, before = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = lines.select("*", sets.alias("sets"), turns.alias("turns")).withColumn("turned", F.sum("turns").over(so_far) % 2)
    rows = rows.withColumn("fixed", (F.col("sets") + F.col("turns") + F.col("turned")) % 2)
    rows = rows.withColumn("fixed_before", F.last("fixed", ignorenulls=True).over(before))
    rows = rows.withColumn("turned_before", F.coalesce(F.lag("turned").over(inside), F.lit(0)))
    begins = lambda state: (F.coalesce("fixed_before", F.lit(state)) + F.col("turned_before")) % 2
    rows = rows.withColumn("out0", begins(0)).withColumn("out1", begins(1))
    opens = lambda c: ((F.col(c) == 0) & ~_blank("line")).cast("long")
    rows = rows.withColumn("n0", F.sum(opens("out0")).over(so_far)).withColumn("n1", F.sum(opens("out1")).over(so_far))
    rows = cut_lineage(rows.select(FILE_PATH, "block", "at", "line", "sets", "turns", "out0", "out1", "n0", "n1"), spark, "record-lines")

    ends = lambda c: (F.coalesce(F.col("sets"), F.col(c)) + F.col("turns")) % 2
    last = F.struct("at", ends("out0").alias("e0"), ends("out1").alias("e1"))
    splits = rows.groupBy(FILE_PATH, "block").agg(F.max(last).alias("z"), F.max("n0").alias("n0"), F.max("n1").alias("n1"))
    # a split that ends alike however it began sets the state; others keep it or turn it around
    splits = splits.select(FILE_PATH, "block", "n0", "n1", F.when(F.col("z.e0") == F.col("z.e1"), F.col("z.e0")).alias("sets"),
                           F.when(F.col("z.e0") == F.col("z.e1"), 0).otherwise(F.col("z.e0")).alias("turns"))
    order = Window.partitionBy(FILE_PATH).orderBy("block")  # a row a split
    prior = order.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("turned", F.sum("turns").over(order.rowsBetween(Window.unboundedPreceding, 0)) % 2)
    splits = splits.withColumn("fixed", (F.col("sets") + F.col("turned")) % 2)
    state = (F.coalesce(F.last("fixed", ignorenulls=True).over(prior), F.lit(0)) + F.coalesce(F.lag("turned").over(order), F.lit(0))) % 2
    splits = splits.withColumn("state", state).withColumn("n", F.when(F.col("state") == 0, F.col("n0")).otherwise(F.col("n1")))
    splits = splits.select(F.col(FILE_PATH).alias("of"), F.col("block").alias("of_block"), "state",
                           F.coalesce(F.sum("n").over(prior), F.lit(0)).alias("base"))
    splits = cut_lineage(splits, spark, "record-splits")  # its size known, the join need not shuffle the lines

    pick = lambda a, b: F.when(F.col("state") == 0, F.col(a)).otherwise(F.col(b))
    got = rows.join(splits, (F.col(FILE_PATH) == F.col("of")) & (F.col("block") == F.col("of_block")))
    got = got.select(FILE_PATH, "block", "at", "line", "sets", "turns", pick("out0", "out1").alias("begins"),
                     (F.col("base") + pick("n0", "n1") - 1).alias("row_idx"))
    got = got.where((F.col("begins") == 1) | ~_blank("line")).withColumn("ends", ends("begins"))
    single = got.where("begins = 0 AND ends = 0").select(FILE_PATH, "row_idx", F.col("line").alias("record"))
    parts = got.where("begins = 1 OR ends = 1").groupBy(FILE_PATH, "row_idx").agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("block", "at", "line")).alias("parts"))
    endless = F.raise_error(F.concat(F.lit(f"a record of over {MAX_LINES} lines (a quote that is never closed?) in "), F.col(FILE_PATH)))
    whole = F.concat_ws("\n", F.transform(F.sort_array("parts"), lambda p: p["line"]))
    several = parts.select(FILE_PATH, "row_idx", F.when(F.col("n") > MAX_LINES, endless.cast("string")).otherwise(whole).alias("record"))
    return single.union(several).withColumn("record", F.regexp_replace("record", "\r$", ""))


def read_records(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", encoding: str = "UTF-8", quote: str = '"',
                 breaks: bool | None = None, **options) -> DataFrame:
    """``src_file_path, row_idx, record``: every record of the files, its
    number counted from 0 in each file without gaps. Blank lines outside of
    values are no records. ``breaks`` tells whether quoted line breaks may
    occur; by default a pass over the lines finds the files that have some."""
    lines = text_lines(spark, paths, encoding, blank=False, **options)
    if not quote or breaks is False:
        return plain_records(lines)
    if breaks:
        return quoted_records(text_lines(spark, paths, encoding, **options), sep, quote)
    found, others = [], False  # paths: a reader must be told them
    for path, broken in broken_files(lines, sep, quote).toLocalIterator():
        if broken:
            found.append(path)
        others = others or not broken
    if not found:
        return plain_records(lines)
    quoted = quoted_records(text_lines(spark, found, encoding), sep, quote)
    return plain_records(lines.where(~F.col(FILE_PATH).isin(found))).union(quoted) if others else quoted


def field_count(record: Column, sep: str = ",", quote: str = '"') -> Column:
    """The exact number of fields of a record: separators outside of quoted
    values, and one."""
    bare = record
    if quote:
        q = re.escape(quote)
        bare = F.regexp_replace(F.replace(record, F.lit(2 * quote), F.lit("")), f"(^|{re.escape(sep)}){q}[^{q}]*{q}", "$1")
        bare = F.when(F.contains(record, F.lit(quote)), bare).otherwise(record)
    without = F.octet_length(F.replace(bare, F.lit(sep), F.lit("")))
    return ((F.octet_length(bare) - without) / len(sep.encode())).cast("int") + 1


def cells_of(record: Column, width: int, sep: str = ",", quote: str = '"') -> Column:
    """The fields of a record as an array of ``width`` texts, an empty one
    and one that is missing as null."""
    options = {"sep": sep, "multiLine": "true", "maxColumns": str(max(width + 1, 20480)), "mode": "PERMISSIVE"}
    options |= {"quote": quote, "escape": quote} if quote else {"quote": "\u0000", "escape": "\u0000"}
    parsed = F.from_csv(record, ", ".join(f"c{i} STRING" for i in range(width)), options)
    return F.array(*[parsed[f"c{i}"] for i in range(width)])
