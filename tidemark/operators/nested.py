"""Nested document operators (NST-1..6).

Documents stay typed ``StructType`` / ``ArrayType`` columns. Deep rewrites
are built by walking the *schema* on the driver and emitting one Column
expression (``struct`` / ``transform`` / ``coalesce``) that Spark evaluates
per row on the executors; no document passes through Python.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .aggregates import one_per_key

# on_field(name, column, type) -> replacement Column, or None to recurse
FieldRule = Callable[[str, Column, T.DataType], Column | None]


def rebuild(c: Column, dtype: T.DataType, on_field: FieldRule) -> Column:
    """Rebuild a value of type ``dtype`` applying ``on_field`` to every struct
    field at any depth (inside arrays too). A null struct stays null."""
    if isinstance(dtype, T.StructType):
        fields = []
        for f in dtype.fields:
            child = c.getField(f.name)
            new = on_field(f.name, child, f.dataType)
            if new is None:
                new = rebuild(child, f.dataType, on_field)
            fields.append(new.alias(f.name))
        return F.when(c.isNull(), F.lit(None)).otherwise(F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: rebuild(x, dtype.elementType, on_field))
    return c


def rebuild_columns(df: DataFrame, on_field: FieldRule) -> DataFrame:
    """Apply :func:`rebuild` to every top-level column (top-level columns are
    the document's first-level fields)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        new = on_field(f.name, c, f.dataType)
        cols.append((new if new is not None else rebuild(c, f.dataType, on_field)).alias(f.name))
    return df.select(*cols)


def explode_children(docs: DataFrame, children: str, keep: Sequence[str] = (),
                     alias: str | None = None) -> DataFrame:
    """NST-1 / NST-3: one row per child of the array ``children``; documents
    with a null or empty array give no row. ``keep`` parent fields are pushed
    down into every child row."""
    alias = alias or children
    return docs.select(*[F.col(k) for k in keep], F.explode(children).alias(alias))


def lift_struct(df: DataFrame, column: str) -> DataFrame:
    """NST-2: the fields of struct ``column`` become top-level columns; on a
    name clash the child's value wins."""
    child = [f.name for f in df.schema[column].dataType.fields]
    parents = [c for c in df.columns if c != column and c not in child]
    return df.select(*[F.col(f"`{c}`") for c in parents],
                     *[F.col(column).getField(n).alias(n) for n in child])


def push_down(df: DataFrame, children: str, fields: Mapping[str, Column]) -> DataFrame:
    """NST-3 (array form): add parent values as fields of every child struct
    without exploding."""
    def add(x):
        for name, value in fields.items():
            x = x.withField(name, value)
        return x
    return df.withColumn(children, F.transform(children, add))


def remap_field_deep(df: DataFrame, field: str, mapping: Column) -> DataFrame:
    """NST-4: wherever a struct field named ``field`` holds a string, replace
    it through ``mapping`` (a map Column); unknown codes stay. The value under
    that key is not searched further."""
    def rule(name, c, dtype):
        if name != field:
            return None
        if isinstance(dtype, T.StringType):
            return F.coalesce(mapping[c], c)
        return c
    return rebuild_columns(df, rule)


def prune_empty_deep(df: DataFrame, json_column: str | None = "doc_json") -> DataFrame:
    """NST-5: remove struct fields that are null or ``""`` at any depth; list
    items and empty containers stay. Empty strings become null; with
    ``json_column`` the document is rendered as JSON, where null fields are
    omitted (list items that are null are kept)."""
    def rule(name, c, dtype):
        if isinstance(dtype, T.StringType):
            return F.when(c != "", c)
        return None

    out = rebuild_columns(df, rule)
    if json_column:
        return out.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in out.columns])).alias(json_column))
    return out


def labels_from_dictionary(df: DataFrame, text: str = "code_and_values",
                           keep: Sequence[str] = ()) -> DataFrame:
    """NST-6: ``a: x; b: y`` to rows ``(pos, code, label)``. Items split on
    every ``;``; the code is the stripped text before the first ``": "``, the
    label all text after it (empty when there is none)."""
    items = df.select(*keep, F.posexplode(F.split(F.col(text), ";")).alias("pos", "item"))
    at = F.instr("item", ": ")
    return items.select(
        *keep, "pos",
        F.regexp_replace(F.substring_index("item", ": ", 1), r"^\s+|\s+$", "").alias("code"),
        F.when(at > 0, F.expr("substring(item, instr(item, ': ') + 2)")).otherwise(F.lit("")).alias("label"))


def merge_labels(defaults: Mapping[str, str], labels: DataFrame, code: str = "code",
                 label: str = "label", order: str | None = "pos") -> DataFrame:
    """Labels from the dictionary merged over fixed defaults: one row per code,
    a dictionary label beating the default and a later item beating an
    earlier one (dict-update order)."""
    spark = labels.sparkSession
    d = spark.createDataFrame([(k, v) for k, v in defaults.items()],
                              "code STRING, label STRING") if defaults else None
    lab = labels.select(F.col(code).alias("code"), F.col(label).alias("label"),
                        F.lit(1).alias("_src"),
                        (F.col(order) if order else F.lit(0)).cast("long").alias("_pos"))
    if d is not None:
        lab = lab.unionByName(d.select("code", "label", F.lit(0).alias("_src"), F.lit(0).cast("long").alias("_pos")))
    best = one_per_key(lab, ["code"], [("_src", "desc"), ("_pos", "desc")])
    return best.select("code", "label")


def labels_map(labels: DataFrame, code: str = "code", label: str = "label",
               max_rows: int = 100_000) -> Column:
    """A literal map Column from a small label table (checked size), for the
    deep rewrite that cannot join inside nested arrays."""
    rows = labels.select(code, label).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError("label table too large for a literal map")
    if not rows:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for r in rows for x in (r[0], r[1])])
