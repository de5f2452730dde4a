"""File sources (SRC-1..12).

Every reader loads text as text (no inference) and carries the source path
from ``_metadata``, so lineage and per-file logic need no driver loop. Many
files are read by one scan; Spark splits and schedules them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import base_name, parent_name
from ..session import cut_lineage
from . import records as rec
from .records import FILE_PATH, metadata_path


def metadata_name() -> Column:
    """Decoded name of the file a row was read from."""
    return rec.decoded(F.col("_metadata.file_name"))


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_csv_text(spark: SparkSession, paths: str | Sequence[str], sep: str = ",",
                  encoding: str | None = None, quote: str | None = None,
                  multiline: bool | None = None, with_path: bool = True, **options) -> DataFrame:
    """SRC-1: delimited text with a header row; every column a string.

    A doubled quote inside a quoted value is a quote, and a quoted value may
    run over line ends. Files whose headers differ load in one call: a column
    goes by its name, whatever its place in a file, and is null in files that
    lack it. One pass over the lines tells whether all headers are alike and
    every line is a record; if so, Spark's reader takes the files as they are,
    otherwise :func:`read_by_header` does. Large files are split either way.
    ``multiline`` given: taken as said, without that pass, and all headers
    have to be alike. ``quote=""`` makes quotes literal."""
    paths = _paths(paths)
    mark = '"' if quote is None else quote
    listing = {k: v for k, v in options.items() if k in ("recursiveFileLookup", "pathGlobFilter")}
    by_line = (encoding or "UTF-8").lower() in rec.BY_LINE and len(listing) == len(options)
    if multiline is None and by_line:
        alike, broken = _layouts(rec.text_lines(spark, paths, encoding or "UTF-8", **listing), sep, mark)
        if not alike or broken:
            got = read_by_header(spark, paths, sep, encoding or "UTF-8", mark, breaks=None if broken else False, **listing)
            return got if with_path else got.drop(FILE_PATH)
    # enforceSchema=false: a file whose header differs from the batch's
    # fails the read instead of being mapped by position
    r = (spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
         .option("sep", sep).option("multiLine", bool(multiline)))
    if mark:
        r = r.option("escape", mark)
    if encoding:
        r = r.option("encoding", encoding)
    if quote is not None:
        r = r.option("quote", quote)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.csv(paths)
    return df.select("*", metadata_path().alias(FILE_PATH)) if with_path else df


def _layouts(lines: DataFrame, sep: str, quote: str) -> tuple[bool, bool]:
    """Whether all files have the same first line, and whether some line ends
    inside a quoted value. One pass; one row comes back."""
    kept = lines.where(~rec._blank("line"))
    ends = F.lit(0)
    if quote:
        sets, turns = rec._line_map(F.col("line"), sep, quote)
        ends = (F.coalesce(sets, F.lit(0)) + turns) % 2
    files = kept.groupBy(FILE_PATH).agg(F.min_by(F.regexp_replace("line", "\r$", ""), F.struct("block", "at")).alias("head"), F.max(ends).alias("ends"))
    row = files.agg(F.min("head") == F.max("head"), F.max("ends") == 1).first()
    return row[0] is not False, bool(row[1])


def column_names(header: Column) -> Column:
    """The names that Spark's CSV reader gives: a blank one is ``_c`` and its
    place, one that occurs again (in any case) is followed by its place."""
    lower = _lower(header)
    place = lambda i: i.cast("string")
    return F.transform(header, lambda x, i: F.when(F.coalesce(x, F.lit("")) == "", F.concat(F.lit("_c"), place(i)))
                       .when(F.size(F.filter(lower, lambda y: y == F.lower(x))) > 1, F.concat(x, place(i))).otherwise(x))


def report_names(header: Column) -> Column:
    """The names of a report's header row: blank ones are ``unnamed_<i>``,
    repeated ones get ``.1``, ``.2``; blanks after the last name are none."""
    size = F.array_max(F.transform(header, lambda x, i: F.when(x.isNotNull(), i + 1).otherwise(0)))
    names = F.transform(F.slice(header, 1, size), lambda x, i: F.coalesce(x, F.concat(F.lit("unnamed_"), i.cast("string"))))
    for _ in range(2):  # once more for a name that looks like a numbered one
        names = _numbered(names)
    return names


def _numbered(names: Column) -> Column:
    earlier = lambda x, i: F.size(F.filter(F.slice(names, 1, i), lambda y: y == x))
    return F.transform(names, lambda x, i: F.when(earlier(x, i) > 0, F.concat(x, F.lit("."), earlier(x, i).cast("string"))).otherwise(x))


def _lower(names: Column) -> Column:
    return F.transform(names, lambda x: F.lower(x))


def by_header(matrix: DataFrame, header_row: int | str, names: Callable[[Column], Column]) -> DataFrame:
    """The rows after each file's ``header_row`` (a number, or the name of a
    column that holds each file's), cells named by that row:
    every name of any file is a column, in the order of the first file that
    has it (and in its spelling: as in Spark, case does not tell names apart). One descriptor row a file, made from its header alone, holds the
    place of every column; files of any number of layouts are one plan. Only
    the different names come to the driver. A cell that is beyond the header
    and not null fails the job."""
    at = F.col(header_row) if isinstance(header_row, str) else F.lit(header_row)
    heads = matrix.where(F.col("row_idx") == at).select(FILE_PATH, names(F.col("cells")).alias("names"))
    twice = F.raise_error(F.concat(F.lit("a column name occurs twice in "), F.col(FILE_PATH)))
    heads = heads.withColumn("names", F.when(F.size(F.array_distinct(_lower(F.col("names")))) < F.size("names"), twice.cast("array<string>")).otherwise(F.col("names")))
    heads = cut_lineage(heads, matrix.sparkSession, "headers")
    seen = heads.select(FILE_PATH, F.posexplode("names").alias("pos", "name")).groupBy(F.lower("name")).agg(F.min(F.struct(FILE_PATH, "pos", "name")).alias("at"))
    columns = [r["name"] for r in seen.orderBy("at").select("at.name").collect()]
    if not columns:
        raise ValueError("no header row found")
    body = matrix.where(F.col("row_idx") > at)
    layouts = heads.select(_lower(F.col("names")).alias("names")).distinct().limit(2).collect()
    if len(layouts) == 1:
        beyond, cell = F.lit(len(columns)), lambda k: F.get(F.col("cells"), F.lit(k))
    else:
        places = F.transform(F.array(*[F.lit(c) for c in columns]), lambda c: (F.array_position(_lower(F.col("names")), F.lower(c)) - 1).cast("int"))
        body = body.join(heads.select(FILE_PATH, F.size("names").alias("n_names"), places.alias("places")), FILE_PATH)
        beyond, cell = F.col("n_names"), lambda k: F.get(F.col("cells"), F.get(F.col("places"), F.lit(k)))  # no such place: null
    over = F.concat_ws("", F.slice("cells", beyond + 1, F.greatest(F.size("cells"), F.lit(1)))) != ""
    wrong = F.raise_error(F.concat(F.lit("cells beyond the header in "), F.col(FILE_PATH)))
    body = body.withColumn("cells", F.when(over, wrong.cast("array<string>")).otherwise(F.col("cells")))
    return body.select(*[cell(k).alias(c) for k, c in enumerate(columns)], FILE_PATH, "row_idx")


def read_by_header(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", encoding: str = "UTF-8", quote: str = '"',
                   breaks: bool | None = None, **options) -> DataFrame:
    """SRC-1 / SET-1: files with a header row each, of any number of layouts
    and with line breaks in quoted values, in one scan."""
    m = _cells(spark, paths, None, sep, encoding, quote, breaks, own_width=True, **options)
    return by_header(cut_lineage(m, spark, "records"), 0, column_names).drop("row_idx")


def read_tsv_text(spark: SparkSession, paths: str | Sequence[str], encoding: str = "ISO-8859-1",
                  quoting: bool = False, **options) -> DataFrame:
    """SRC-2: tab separated, Latin-1; quotes are literal characters unless
    ``quoting`` is on."""
    return read_csv_text(spark, paths, sep="\t", encoding=encoding,
                         quote=None if quoting else "", **options)


def matrix_schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])


def matrix_width(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", encoding: str = "UTF-8") -> int:
    """The most fields that a record of the files has: exact, also for records
    that run over several lines."""
    n = rec.read_records(spark, _paths(paths), sep, encoding).agg(F.max(rec.field_count(F.col("record"), sep))).first()[0]
    return n or 1


def _cells(spark: SparkSession, paths: str | Sequence[str], width: int | None, sep: str, encoding: str, quote: str = '"',
           breaks: bool | None = None, own_width: bool = False, **options) -> DataFrame:
    """``src_file_path, row_idx, cells``; a record of more than ``width``
    fields fails the job. Every row has ``width`` cells, or (``own_width``) as
    many as its record."""
    records = rec.read_records(spark, _paths(paths), sep, encoding, quote, breaks, **options)
    records = records.withColumn("n_fields", rec.field_count(F.col("record"), sep, quote))
    if width is None:  # put together once for the count and the cells
        records = cut_lineage(records, spark, "records")
        width = records.agg(F.max("n_fields")).first()[0] or 1
    cells = records.withColumn("wide", rec.cells_of(F.col("record"), width + 1, sep, quote))
    too_wide = F.raise_error(F.concat(F.lit(f"a record of more than {width} fields in "), F.col(FILE_PATH)))
    over = F.get(F.col("wide"), F.lit(width)).isNotNull()
    many = F.col("n_fields") if own_width else F.lit(width)
    return cells.select(FILE_PATH, "row_idx", F.when(over, too_wide.cast("array<string>")).otherwise(F.slice("wide", 1, many)).alias("cells"))


def read_matrix(spark: SparkSession, paths: str | Sequence[str], width: int | None = None,
                encoding: str = "UTF-8", sep: str = ",", stage: bool = False,
                files: bool = False, multiline: bool | None = None) -> DataFrame:
    """SRC-5: a headerless report file as indexed rows
    ``(src_file_path, row_idx, cells array<string>)``.

    Quoted line breaks are kept, and large files are split, those with such
    breaks too (``sources.records``). ``row_idx`` counts the records of a file
    from 0 without gaps. ``width`` is taken from the files unless given; a
    record of more fields than that fails the job, none is dropped.
    ``multiline`` says whether quoted line breaks occur; unless given, a pass
    over the lines finds the files that have some.

    With ``stage`` the parsed rows are written once as Parquet under the
    shared checkpoint folder and read back: later passes (header rows,
    descriptors, data) then read columnar data, and the ``row_idx`` filter of
    the header pass skips all but the first row group of each file, instead
    of parsing the text again. This also cuts the lineage.

    A file in an encoding whose line ends are not ASCII's (UTF-16) can't be
    split: one task reads it whole."""
    if encoding.lower() in rec.BY_LINE:
        out = _cells(spark, paths, width, sep, encoding, breaks=multiline)
    else:
        out = _whole_files(spark, paths, width, encoding, sep)
    return cut_lineage(out, spark, "matrix") if stage else out


def _whole_files(spark: SparkSession, paths: str | Sequence[str], width: int | None, encoding: str, sep: str) -> DataFrame:
    if width is None:
        raise ValueError(f"the width of files in {encoding} has to be given")
    df = (spark.read.schema(matrix_schema(width + 1)).option("header", False)
          .option("multiLine", True).option("encoding", encoding).option("sep", sep).option("escape", '"')
          .option("mode", "PERMISSIVE").csv(_paths(paths)))
    too_wide = F.raise_error(F.concat(F.lit(f"a record of more than {width} fields in "), metadata_path()))
    first_cell = F.when(F.col(f"c{width}").isNotNull(), too_wide.cast("string")).otherwise(F.col("c0"))
    df = df.select(metadata_path().alias(FILE_PATH), F.monotonically_increasing_id().alias("_mid"),
                   F.array(first_cell, *[F.col(f"c{i}") for i in range(1, width)]).alias("cells"))
    first = df.groupBy(FILE_PATH).agg(F.min("_mid").alias("_mid0"))
    return df.join(first, FILE_PATH).select(FILE_PATH, (F.col("_mid") - F.col("_mid0")).alias("row_idx"), "cells")


def header_rows(matrix: DataFrame, header_row: Column | int) -> DataFrame:
    """Per file, the cells of its header row (one small row per file)."""
    h = header_row if not isinstance(header_row, int) else F.lit(header_row)
    return matrix.filter(F.col("row_idx") == h).select(FILE_PATH, F.col("cells").alias("header"))


def promote_header(matrix: DataFrame, skip: Column | int, names: Sequence[str]) -> DataFrame:
    """SRC-3 core: rows after the per-file header row, cells named by
    position with ``names`` (the normalised header, same for the batch)."""
    s = skip if not isinstance(skip, int) else F.lit(skip)
    body = matrix.filter(F.col("row_idx") > s)
    return body.select(FILE_PATH, "row_idx",
                       *[F.col("cells")[i].alias(n) for i, n in enumerate(names)])


def read_with_preamble(spark: SparkSession, paths: str | Sequence[str], skip_rows: int,
                       width: int | None = None, encoding: str = "UTF-8") -> DataFrame:
    """SRC-3: skip ``skip_rows`` title lines; the next line is the header.

    Files whose headers differ load in one scan by the names in their own
    header rows (:func:`by_header`). Cells beyond the header's last name fail
    the job; duplicate names get ``.1``; blank names become ``unnamed_<i>``.
    The parsed text is staged once: header rows and data read it."""
    m = read_matrix(spark, paths, width, encoding, stage=True)
    out = by_header(m, skip_rows, report_names)
    return out.select(FILE_PATH, "row_idx", *[F.col("`" + c.replace("`", "``") + "`") for c in out.columns if c not in (FILE_PATH, "row_idx")])


def detect_header(matrix: DataFrame, first_cell: str, max_scan: int = 30) -> DataFrame:
    """SRC-4: per file, the first row (below ``max_scan``) whose first cell
    equals ``first_cell``: ``(src_file_path, header_row)``. A file without
    such a row fails the job (the source silently kept its last attempt)."""
    found = (matrix.filter((F.col("row_idx") < max_scan) & (F.col("cells")[0] == first_cell))
             .groupBy(FILE_PATH).agg(F.min("row_idx").alias("header_row")))
    files = matrix.select(FILE_PATH).distinct()
    j = files.join(found, FILE_PATH, "left")
    return j.withColumn("header_row", F.coalesce(
        F.col("header_row"),
        F.raise_error(F.concat(F.lit("no header row starting with "), F.lit(first_cell),
                               F.lit(" in "), F.col(FILE_PATH))).cast("long")))


def list_files(spark: SparkSession, root: str, pattern: str | None = None,
               recursive: bool = True) -> DataFrame:
    """SRC-11: ``(path, name, parent, modificationTime, length)`` of the files
    under ``root``. Only metadata columns are selected, so file contents are
    never read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    df = r.load(root).select("path", "modificationTime", "length")
    return df.select("path", base_name("path").alias("name"), parent_name("path").alias("parent"),
                     "modificationTime", "length")


def decode_with_fallback(spark: SparkSession, paths: str | Sequence[str],
                         pattern: str | None = None) -> DataFrame:
    """SRC-6: per file, the first encoding that decodes it: ``UTF-8`` (a BOM is
    allowed) else ``ISO-8859-1``. Returns ``(path, encoding)``; read each group
    with SRC-1/SRC-5 using that encoding.

    The files are scanned as split text lines (any size, many tasks per
    file; the text source keeps the raw bytes), and a file is Latin-1 when
    any of its lines is not valid UTF-8."""
    r = spark.read.format("text")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    lines = r.load(_paths(paths)).select(metadata_path().alias("path"),
                                         (~F.is_valid_utf8("value")).alias("bad"))
    per_file = lines.groupBy("path").agg(F.bool_or("bad").alias("bad"))
    return per_file.select("path", F.when(F.col("bad"), F.lit("ISO-8859-1"))
                           .otherwise(F.lit("UTF-8")).alias("encoding"))


def read_sheets(spark: SparkSession, root: str, sheet: str | int | None = None, **csv_options) -> DataFrame:
    """SRC-7: workbook sheets landed as ``<workbook>/<idx>__<sheet>.csv``.
    ``sheet`` picks one sheet kind by name or index (sheets of one kind share
    a header, so read each kind separately). Adds ``workbook``,
    ``sheet_index`` and ``sheet_name`` from the path."""
    if sheet is None:
        glob = "*.csv"
    elif isinstance(sheet, int):
        glob = f"{sheet}__*.csv"
    else:
        glob = f"*__{sheet}.csv"
    df = read_csv_text(spark, root, recursiveFileLookup=True, pathGlobFilter=glob, **csv_options)
    return sheet_columns(df)


def sheet_columns(df: DataFrame) -> DataFrame:
    """Workbook, index and name of the sheet that each row was read from."""
    fname = base_name(F.col(FILE_PATH))
    return df.withColumns({
        "workbook": parent_name(F.col(FILE_PATH)),
        "sheet_index": F.regexp_extract(fname, r"^(\d+)__", 1).cast("int"),
        "sheet_name": F.regexp_extract(fname, r"^\d+__(.*)\.csv$", 1),
    })


def list_sheets(spark: SparkSession, root: str) -> DataFrame:
    """One row per landed sheet ``(workbook, sheet_index, sheet_name, path)``,
    from the file listing only (no content read)."""
    files = list_files(spark, root, "*.csv")
    return files.select(F.col("parent").alias("workbook"),
                        F.regexp_extract("name", r"^(\d+)__", 1).cast("int").alias("sheet_index"),
                        F.regexp_extract("name", r"^\d+__(.*)\.csv$", 1).alias("sheet_name"), "path")


def pick_sheet(sheets: DataFrame, prefix: str, workbook: str = "workbook",
               index: str = "sheet_index", name: str = "sheet_name") -> DataFrame:
    """SRC-8 / ORD-3: per workbook, the first sheet whose name starts with
    ``prefix``, else the first sheet (sheet 0). Input: one row per sheet
    (``list_sheets``). Output: ``(workbook, sheet_index)``. One aggregation,
    no window."""
    hit = F.min(F.when(F.col(name).startswith(prefix), F.col(index)))
    return sheets.groupBy(workbook).agg(F.coalesce(hit, F.min(index)).alias(index))


def read_json_docs(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """SRC-9: one JSON document per file; all files in one read so their
    schemas merge before any rewriting."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(_paths(paths)).select("*", metadata_path().alias(FILE_PATH))


def assign_header(df: DataFrame, names: Sequence[str], optional_tail: Sequence[str] = (),
                  ignore: Sequence[str] = (FILE_PATH,)) -> DataFrame:
    """SRC-12: positional header. The data columns (all but ``ignore``) must
    number ``len(names)`` or ``len(names) + len(optional_tail)``."""
    data_cols = [c for c in df.columns if c not in ignore]
    if len(data_cols) == len(names):
        new = list(names)
    elif optional_tail and len(data_cols) == len(names) + len(optional_tail):
        new = list(names) + list(optional_tail)
    else:
        raise ValueError(f"{len(data_cols)} columns, expected {len(names)}"
                         + (f" or {len(names) + len(optional_tail)}" if optional_tail else ""))
    mapping = dict(zip(data_cols, new))
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])
