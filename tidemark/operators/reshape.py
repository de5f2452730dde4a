"""Wide report matrices to long fact tables (RSH-1..5).

A report matrix is read with ``sources.files.read_matrix`` into rows
``(src_file_path, row_idx, cells array<string>)``. Its first rows describe
the columns (attribute names, measure headings, measurement periods); the
rest are data. The column roles differ per file, so:

1. the few header rows of every file are turned into one *descriptor* row
   per file (attribute positions, one struct per measure column, and the
   values that depend on the file alone). The descriptors are staged, so that
   their size is known when the join is planned: they are broadcast if it
   allows, and no data row is shuffled for them;
2. each data row is joined to its file's descriptor and emits one output
   row per measure by ``explode``; attribute values are read by position.

Data rows never meet a Python loop, and shuffle only if the descriptors are
too large to be broadcast (of many files, then, and a file of many rows is
split as a skewed key); each file's header is tied to its data by the file
path and column position.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import normalize_name_col
from ..functions.scalars import (
    all_but_last,
    clean_text,
    extract_int,
    last_token,
    parse_percent,
    parse_period,
    parse_range,
    split_heading,
    strip,
)
from ..session import cut_lineage
from ..sources.files import FILE_PATH

# ---------------------------------------------------------------------------
# Output attribute names, in source column order
# ---------------------------------------------------------------------------

MEASURE_ATTRS = ("contract_id", "organization_type", "contract_name",
                 "organization_marketing_name", "parent_organization")
DISPLAY_ATTRS = ("contract_id", "contract_name", "organization_marketing_name", "parent_organization")
STAR_LABEL = r"(\d+)\s?star"


def melt(df: DataFrame, ids: Sequence[str], columns: Mapping[str, str],
         key_name: str = "indicator_key", value_name: str = "rate",
         constants: Mapping[str, Column] | None = None, value_type: str = "string") -> DataFrame:
    """RSH-1: each of ``columns`` becomes a row ``(ids..., key, value)``; the
    key is the mapped name (``rate1`` -> ``discussing_fall_risk_rate``).
    ``constants`` adds fixed columns (``measure_code``, null ``lcl``/``ucl``)."""
    cols = list(columns)
    typed = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in cols])
    long = typed.unpivot(list(ids), cols, "__variable", value_name)
    keys = F.create_map(*[F.lit(x) for kv in columns.items() for x in kv])
    out = long.withColumn(key_name, keys[F.col("__variable")]).drop("__variable")
    return out.withColumns(dict(constants or {})) if constants else out


def _header_rows(matrix: DataFrame, rows: Mapping[str, int]) -> DataFrame:
    """One row per file holding the requested header rows as arrays."""
    wanted = list(rows.values())
    h = matrix.filter(F.col("row_idx").isin(*wanted))
    aggs = [F.max(F.when(F.col("row_idx") == idx, F.col("cells"))).alias(name) for name, idx in rows.items()]
    return h.groupBy(FILE_PATH).agg(*aggs)


def _positions(pred_arr: Column) -> Column:
    """0-based positions where a boolean array is true."""
    idx = F.sequence(F.lit(0), F.size(pred_arr) - 1)
    return F.filter(idx, lambda i: F.get(pred_arr, i))


def _with_descriptor(data: DataFrame, desc: DataFrame) -> DataFrame:
    """Each data row with its file's descriptor, one row per file. An
    aggregate's size is not known before it has run: planned with it, the join
    would shuffle all data rows by file, a file to a task."""
    return data.join(cut_lineage(desc, data.sparkSession, "descriptors"), FILE_PATH)


def _explode_measures(data: DataFrame, desc: DataFrame, attrs: Sequence[str],
                      measure_fields: Sequence[str], file_fields: Sequence[str] = (),
                      is_data: Column | None = None) -> DataFrame:
    """Join data rows with their file's descriptor and emit one row per
    measure column. The descriptor is one row per file, made from the header
    rows alone. Attribute cells are
    stripped once per data row, before the explode; per-file values ride
    along from the descriptor, and ``is_data`` may filter by them. A file
    with more or fewer attribute columns than ``attrs`` fails the job."""
    n = len(attrs)
    desc = desc.withColumn("attr_pos", F.when(F.size("attr_pos") == n, F.col("attr_pos")).otherwise(F.raise_error(F.concat(
        F.size("attr_pos").cast("string"), F.lit(f" attribute columns, expected {n}, in "), F.col(FILE_PATH))).cast("array<int>")))
    j = _with_descriptor(data, desc)
    if is_data is not None:
        j = j.filter(is_data)
    j = j.filter(F.concat_ws("", "cells") != "")  # fully blank rows are skipped
    attr_cols = [strip(F.get(F.col("cells"), F.get(F.col("attr_pos"), k))).alias(a)
                 for k, a in enumerate(attrs)]
    wide = j.select(FILE_PATH, "row_idx", *attr_cols, *file_fields, "measures", "cells")
    ex = wide.select(FILE_PATH, "row_idx", *attrs, *file_fields, "cells", F.explode("measures").alias("m"))
    value = strip(F.get(F.col("cells"), F.col("m.i")))
    return ex.select(FILE_PATH, "row_idx", *attrs, *[F.col(f"m.{f}").alias(f) for f in measure_fields],
                     value.alias("measure_value_raw"), *file_fields)


def matrix_to_long(matrix: DataFrame, attrs: Sequence[str] = MEASURE_ATTRS,
                   attr_row: int = 1, heading_row: int = 2, period_row: int = 3,
                   data_from: int = 4, file_columns: Mapping[str, Column] | None = None) -> DataFrame:
    """RSH-2: star-rating measure matrices to rows.

    A column is skipped when its attribute, heading and period cells are all
    null; it is an attribute when its period cell is null, otherwise a
    measure with code = text before the first ``:`` of the heading,
    description = normalised text after the last ``:``, and period from the
    period cell (``(Monday - Friday)`` and ``\\x96`` removed). Attributes are
    named by position with ``attrs``. A null data cell stays null.

    ``file_columns`` are expressions over ``src_file_path`` (file date, year,
    name); they are evaluated once per file on the descriptor side and carried
    to the rows by the broadcast join."""
    file_columns = dict(file_columns or {})
    heads = _header_rows(matrix, {"a": attr_row, "h": heading_row, "p": period_row})
    z = F.arrays_zip(F.col("a").alias("a"), F.col("h").alias("h"), F.col("p").alias("p"))
    is_attr = F.transform(z, lambda x: ~(x["a"].isNull() & x["h"].isNull() & x["p"].isNull())
                          & x["p"].isNull())
    is_meas = F.transform(z, lambda x: x["p"].isNotNull())

    def measure(i):
        heading = F.get(F.col("h"), i)
        code, _ = split_heading(heading)
        period = parse_period(clean_text(F.get(F.col("p"), i)))
        return F.struct(i.alias("i"), code.alias("measure_code"),
                        normalize_name_col(F.substring_index(heading, ":", -1)).alias("measure_desc"),
                        period["start"].alias("measure_start"), period["end"].alias("measure_end"))

    desc = heads.select(FILE_PATH, _positions(is_attr).alias("attr_pos"),
                        F.transform(_positions(is_meas), measure).alias("measures"),
                        *[c.alias(n) for n, c in file_columns.items()])
    data = matrix.filter(F.col("row_idx") >= data_from)
    out = _explode_measures(data, desc, attrs, ["measure_code", "measure_desc", "measure_start", "measure_end"],
                            list(file_columns))
    return out.withColumn("measure_value", parse_percent("measure_value_raw"))


def display_matrix_to_long(matrix: DataFrame, offset: Column | int = 1,
                           attrs: Sequence[str] = DISPLAY_ATTRS, n_attrs: int = 4, max_offset: int = 1,
                           file_columns: Mapping[str, Column] | None = None) -> DataFrame:
    """RSH-3: display-measure matrices. The first ``n_attrs`` columns are
    attributes named from row 1; measure headings are on row ``1 + offset``
    (offset 0 for HEDIS files, 1 otherwise; a Column over ``src_file_path``
    may give it per file, up to ``max_offset``); the measure code is the
    heading's last word and the description the normalised rest; data start on
    row ``2 + offset``.

    The few rows that may be headers are picked by their number first; the
    offset and the ``file_columns`` (as in RSH-2) are evaluated on the one row
    a file that they make."""
    file_columns = dict(file_columns or {})
    off = offset if isinstance(offset, Column) else F.lit(offset)
    heads = _header_rows(matrix, {f"r{k}": 1 + k for k in range(max_offset + 1)}).withColumn("_off", off)
    at = F.array(*[F.col(f"r{k}") for k in range(max_offset + 1)])
    heads = heads.select(FILE_PATH, "_off", F.col("r0").alias("a"), F.get(at, F.col("_off")).alias("h"))
    heads = heads.filter(F.col("a").isNotNull() & F.col("h").isNotNull())
    z = F.arrays_zip(F.col("a").alias("a"), F.col("h").alias("h"))
    keep = F.transform(z, lambda x: ~(x["a"].isNull() & x["h"].isNull()))
    idx = F.sequence(F.lit(0), F.size(keep) - 1)
    attr_pos = F.filter(idx, lambda i: F.get(keep, i) & (i < n_attrs))
    meas_pos = F.filter(idx, lambda i: F.get(keep, i) & (i >= n_attrs))

    def measure(i):
        h = F.get(F.col("h"), i)
        return F.struct(i.alias("i"), last_token(h).alias("measure_code"),
                        normalize_name_col(all_but_last(h)).alias("measure_desc"))

    desc = heads.select(FILE_PATH, "_off", attr_pos.alias("attr_pos"),
                        F.transform(meas_pos, measure).alias("measures"), *[c.alias(n) for n, c in file_columns.items()])
    out = _explode_measures(matrix, desc, attrs, ["measure_code", "measure_desc"], list(file_columns),
                            is_data=F.col("row_idx") >= 2 + F.col("_off"))
    return out.withColumn("measure_value", parse_percent("measure_value_raw"))


def cutpoints_to_long(matrix: DataFrame, part: Column | str, default_org_type: str = "MA-PD",
                      names_row: int = 2, periods_row: int = 3,
                      data_from: int = 4, file_columns: Mapping[str, Column] | None = None) -> DataFrame:
    """RSH-4: cut-point grids (star level x measure) to rows.

    ``part`` is ``Part_C`` (star label in column 0, measures from column 1,
    ``org_type`` = ``MA-PD``) or ``Part_D`` (org type in column 0, label in
    column 1, measures from column 2); a Column gives it per file. Only rows
    whose lower-cased label matches ``(\\d+)\\s?star`` are kept; cells with an
    empty measure name or a null value are skipped. ``file_columns`` as in
    RSH-2."""
    file_columns = dict(file_columns or {})
    p = part if isinstance(part, Column) else F.lit(part)
    # the part follows from the path: it is taken on the one row per file
    heads = _header_rows(matrix, {"n": names_row, "per": periods_row}).withColumn("part_type", p)
    first_measure = F.when(F.col("part_type") == "Part_D", 2).otherwise(1)
    idx = F.sequence(first_measure, F.greatest(F.size(F.col("n")) - 1, first_measure))

    def measure(i):
        name = F.get(F.col("n"), i)
        code, desc_ = split_heading(name)
        period = parse_period(F.get(F.col("per"), i))
        return F.struct(i.alias("i"), name.alias("_name"), code.alias("measure_code"),
                        desc_.alias("measure_name"),
                        period["start"].alias("measure_period_start"),
                        period["end"].alias("measure_period_end"))

    desc = heads.select(FILE_PATH, "part_type", F.transform(idx, measure).alias("measures"), *[c.alias(n) for n, c in file_columns.items()])
    data = matrix.filter(F.col("row_idx") >= data_from)
    j = _with_descriptor(data, desc)
    is_d = F.col("part_type") == "Part_D"
    label = F.when(is_d, F.get(F.col("cells"), 1)).otherwise(F.get(F.col("cells"), 0))
    org = F.when(is_d, F.get(F.col("cells"), 0)).otherwise(F.lit(default_org_type))
    j = j.select(FILE_PATH, "row_idx", "part_type", "cells", org.alias("org_type"),
                 extract_int(F.lower(label), STAR_LABEL).alias("star"), "measures", *file_columns)
    j = j.filter(F.col("star").isNotNull())
    ex = j.select(FILE_PATH, "row_idx", "part_type", "org_type", "star", "cells", *file_columns, F.explode("measures").alias("m"))
    value = F.get(F.col("cells"), F.col("m.i"))
    ex = ex.filter(F.col("m._name").isNotNull() & (F.col("m._name") != "") & value.isNotNull())
    rng = parse_range(value)
    return ex.select(FILE_PATH, "row_idx", "part_type", "org_type",
                     F.col("m.measure_code").alias("measure_code"), F.col("m.measure_name").alias("measure_name"),
                     F.col("m.measure_period_start").alias("measure_period_start"),
                     F.col("m.measure_period_end").alias("measure_period_end"), "star",
                     rng["lower"].alias("lower_bound"), rng["upper"].alias("upper_bound"),
                     value.alias("original_text"), *file_columns)
