"""Table sinks over partitioned Parquet (SNK-1..8).

There is no Delta here, so the user-visible effects of its writes are built
from plain Spark writes:

* slice replacement = ``partitionBy(key)`` + dynamic partition overwrite,
  plus two rules dynamic overwrite lacks: an empty input removes the slice,
  and rows outside the declared slice are rejected;
* schema evolution = conform the batch to the table on write (new columns
  and wider numbers allowed, other misfits rejected). The table's schema is
  kept beside its data (``_table_schema.json``), so neither reads nor writes
  open the footers of old slices. It is widened before the data are written:
  a write that breaks off leaves a schema that holds for the old files too;
* upsert = null-safe anti-join of the old rows + one row per key of the new,
  for the touched partitions or hash buckets alone if the table has either,
  otherwise written to a fresh folder and swapped in;
* a swap interrupted anywhere is finished or undone by the next access.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregates import Order, one_per_key
from ..session import cut_lineage


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a table: at least one data file (an empty
    folder left by a failed first write does not count). A swap that broke
    off is finished or undone first; errors of the file system propagate."""
    recover(spark, path)
    return _has_data(spark, path)


def _has_data(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    base = fs.makeQualified(p).toUri().getPath().rstrip("/")
    files = fs.listFiles(p, True)
    while files.hasNext():
        inner = files.next().getPath().toUri().getPath()[len(base) + 1:]
        if not any(part.startswith(("_", ".")) for part in inner.split("/")):
            return True
    return False


def recover(spark: SparkSession, path: str) -> None:
    """Bring a table whose swap broke off back to one complete copy: the new
    one if it was written to its end, otherwise the old one."""
    base = path.rstrip("/")
    staging, old = base + ".__staging", base + ".__old"
    fs, p = _fs(spark, base)
    there = lambda x: fs.exists(_fs(spark, x)[1])
    if fs.exists(p):
        if there(old):
            _delete(spark, old)  # the new copy is in place
    elif there(staging + "/_SUCCESS") and there(old):
        _rename(spark, staging, base)
        _delete(spark, old)
    elif there(old):
        _rename(spark, old, base)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    if not fs.rename(s, d):
        raise OSError(f"rename {src} -> {dst} failed")


_SCHEMA_FILE = "_table_schema.json"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept beside a table, if there is one."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/{_SCHEMA_FILE}")
    if not fs.exists(p):
        p = _fs(spark, f"{path.rstrip('/')}/{_SCHEMA_FILE}.new")[1]  # whole: the old one went after it was written
        if not fs.exists(p):
            return None
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return T.StructType.fromJson(json.loads(text))


def _store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Write the schema beside the old one, then put it in its place: at any
    moment one of the two is there and whole."""
    base = f"{path.rstrip('/')}/{_SCHEMA_FILE}"
    fs, p = _fs(spark, base + ".new")
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(schema.json().encode()))
    finally:
        stream.close()
    _delete(spark, base)
    _rename(spark, base + ".new", base)


def read_table(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """Read a table written by these sinks. Its kept schema covers all slices;
    a table without one is read by merging the schemas in its files."""
    recover(spark, path)
    schema = stored_schema(spark, path)
    if schema is not None:
        df = spark.read.schema(schema).parquet(path)
        return df.drop(BUCKET) if BUCKET in schema.names else df
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_note(spark: SparkSession, path: str, name: str) -> dict | None:
    """A small JSON note kept beside a table's data; ``None`` if there is none
    or it was cut short."""
    text = _read_text(spark, f"{path.rstrip('/')}/{name}")
    try:
        return json.loads(text) if text is not None else None
    except json.JSONDecodeError:
        return None


def write_note(spark: SparkSession, path: str, name: str, note: dict) -> None:
    """Keep a small JSON note beside a table (``name`` begins with ``_``, so
    that readers skip it)."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/{name}")
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(json.dumps(note).encode()))
    finally:
        stream.close()


def slice_fingerprints(spark: SparkSession, paths: Sequence[str], key: str) -> dict[str, str]:
    """For each value of the partition column ``key`` that any of the tables
    has: a digest of the names, sizes and times of its files in all of them.
    From the listings alone, an entry a slice."""
    found: dict[str, list[str]] = {}
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for n, path in enumerate(paths):
        recover(spark, path)
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            continue
        for folder in fs.listStatus(p):
            name = folder.getPath().getName()
            if folder.isDirectory() and name.startswith(key + "="):
                marks = [f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}" for f in fs.listStatus(folder.getPath())]
                found.setdefault(unescape(name[len(key) + 1:]), []).append(f"{n}: " + ", ".join(sorted(marks)))
    return {value: hashlib.sha256("; ".join(marks).encode()).hexdigest() for value, marks in sorted(found.items())}


def remove_slice(spark: SparkSession, path: str, key: str, value) -> None:
    """Delete one slice of a table."""
    _delete(spark, _partition_folder(spark, path, key, value))


def loaded_slices(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    """The values of the partition column ``key`` that a table has, from its
    folder names alone; ``None`` without a table."""
    recover(spark, path)
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    values = [unescape(n[len(key) + 1:]) for n in names if n.startswith(key + "=")]
    rows = [(None if v == "__HIVE_DEFAULT_PARTITION__" else v,) for v in values]
    return spark.createDataFrame(rows, T.StructType([T.StructField(key, T.StringType())]))


def _partition_text(value) -> str:
    if isinstance(value, (_dt.date, _dt.datetime)):
        return value.isoformat()[:10]
    return str(value)


def _partition_folder(spark: SparkSession, path: str, key: str, value) -> str:
    """The folder of a slice, its name escaped as Spark writes it."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{path.rstrip('/')}/{escape(key)}={escape(_partition_text(value))}"


# Types in order of widening; a value of an earlier one always fits a later one.
_WIDER = (("tinyint", "smallint", "int", "bigint"), ("float", "double"), ("tinyint", "smallint", "int", "double"))


def _widened(old: T.DataType, new: T.DataType) -> T.DataType:
    """The wider of two types where one holds the other without loss, else
    the table's."""
    a, b = old.simpleString(), new.simpleString()
    for chain in _WIDER:
        if a in chain and b in chain:
            return old if chain.index(a) >= chain.index(b) else new
    return old


def conform_to_table(spark: SparkSession, df: DataFrame, path: str,
                     partition_key: str | None = None) -> DataFrame:
    """SNK-4 (write side): give every column the table already has its table
    type, and null-fill table columns the batch lacks. New columns pass
    through and extend the schema; a column of a wider number type widens the
    table's. A value that does not fit its column fails the job and names the
    column: nothing is stored as null in its place."""
    if not path_exists(spark, path):
        return df
    table = stored_schema(spark, path) or read_table(spark, path).schema
    ttypes = {f.name: f.dataType for f in table.fields if f.name not in (partition_key, BUCKET)}
    cols = []
    for c in df.columns:
        raw = F.col(f"`{c}`")
        if c in ttypes and df.schema[c].dataType != ttypes[c]:
            to = _widened(ttypes[c], df.schema[c].dataType)
            got = raw.try_cast(to)
            misfit = F.raise_error(F.concat(F.lit(f"column {c}: no {to.simpleString()}: "), F.coalesce(raw.cast("string"), F.lit(""))))
            cols.append(F.when(raw.isNotNull() & got.isNull(), misfit.cast(to)).otherwise(got).alias(c))
        else:
            cols.append(raw)
    for name, dtype in ttypes.items():
        if name not in df.columns:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*cols)


def _extend_schema(spark: SparkSession, path: str, df: DataFrame, keys: Sequence[str], layout: dict | None = None) -> None:
    """Keep the schema that the table has once ``df`` is written: its data
    columns, then the partition columns as text. It is called before the data
    are written, as it also holds for a table without them: a new column is
    null in old files, and a wider type reads the narrower ones. A schema
    that a first write left behind without data counts for nothing."""
    before = stored_schema(spark, path)
    fields = {f.name: f.dataType for f in before.fields} if before and _has_data(spark, path) else {}
    for f in df.schema.fields:
        fields[f.name] = _widened(fields[f.name], f.dataType) if f.name in fields else f.dataType
    data = [T.StructField(n, t) for n, t in fields.items() if n not in keys]
    after = T.StructType(data + [T.StructField(k, T.StringType(), metadata=layout if k == BUCKET else None) for k in keys])
    if after != before:
        _store_schema(spark, path, after)


def replace_slice(df: DataFrame, path: str, key: str, value=None,
                  evolve: bool = True) -> None:
    """SNK-1 / SNK-2: overwrite only the slices (partitions of ``key``) present
    in ``df``, leaving the other slices untouched.

    With ``value`` the batch declares its one slice: rows with another key
    fail the job, and an empty batch deletes that slice (dynamic overwrite
    alone would leave it in place)."""
    spark = df.sparkSession
    if value is not None:
        bad = F.col(key).cast("string") != F.lit(_partition_text(value))
        df = df.withColumn("__chk", F.when(bad | F.col(key).isNull(), F.raise_error(
            F.concat(F.lit(f"row outside slice {key}={_partition_text(value)}: "),
                     F.col(key).cast("string")))))
        df = df.filter(F.col("__chk").isNull()).drop("__chk")
    if evolve:
        df = conform_to_table(spark, df, path, key)
    if value is not None and df.isEmpty():
        _delete(spark, _partition_folder(spark, path, key, value))
        return
    if evolve:
        _extend_schema(spark, path, df, [key])
    # rebalance by the slice key: AQE evens the output files per slice and
    # splits a hot slice over several tasks instead of one
    (df.hint("rebalance", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(key).parquet(path))


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), layout: dict | None = None) -> None:
    """SNK-3: replace the whole table. The new content is written to a
    staging folder first; the old table is then moved aside, the staging
    folder moved in, and the old copy deleted last. Whatever step it stops
    at, ``recover`` (run by every access of these sinks) finds one complete
    copy: the old one until the staging folder is whole, the new one after.
    The input may be the table itself.

    On an object store a rename is a copy; there the swap takes longer but
    keeps these rules."""
    spark = df.sparkSession
    base = path.rstrip("/")
    staging, old = base + ".__staging", base + ".__old"
    recover(spark, base)
    _delete(spark, staging)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(staging)
    _extend_schema(spark, staging, df, list(partition_by), layout)
    fs, s = _fs(spark, staging + "/_SUCCESS")
    if not fs.exists(s):  # the mark that recover goes by
        fs.create(s, True).close()
    fs, p = _fs(spark, base)
    if fs.exists(p):
        _rename(spark, base, old)
    _rename(spark, staging, base)
    _delete(spark, old)


#: Folder column of a table dealt into hash buckets; readers do not see it.
BUCKET = "tidemark_bucket"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key. Keys are hashed as text, each with its length, so
    that nulls and the ends of neighbouring texts are told apart."""
    texts = [F.col(f"`{k}`").cast("string") for k in keys]
    return F.pmod(F.xxhash64(*[x for t in texts for x in (F.length(t), t)]), F.lit(buckets)).cast("string")


def bucket_layout(spark: SparkSession, path: str) -> tuple[int, list[str]] | None:
    """The number of buckets and the key columns of a bucketed table."""
    schema = stored_schema(spark, path)
    if schema is None or BUCKET not in schema.names:
        return None
    return schema[BUCKET].metadata["buckets"], list(schema[BUCKET].metadata["keys"])


def rebucket(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> None:
    """Deal a table anew into ``buckets`` hash buckets of ``keys``: for a table
    that had none, or whose buckets have grown too large to rewrite."""
    df = read_table(spark, path).withColumn(BUCKET, _bucket(keys, buckets))
    replace_table(df, path, [BUCKET], {"buckets": buckets, "keys": list(keys)})


def _same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    """Null-safe equality of the columns that two frames share."""
    out = F.lit(True)
    for c in columns:
        out = out & a[f"`{c}`"].eqNullSafe(b[f"`{c}`"])
    return out


def upsert(df: DataFrame, path: str, keys: Sequence[str], order: Order | None = None,
           partition_by: Sequence[str] = (), buckets: int | None = None) -> None:
    """SNK-5: replace the stored row of every key present in ``df`` and insert
    new keys; one row per key afterwards (AGG-6 picks among new duplicates
    by ``order``, so the winner does not depend on file order). Null is a key
    value like any other.

    With ``partition_by``, columns of the key, the table is partitioned by
    them and only the partitions that ``df`` has keys in are read and
    rewritten. A table without such columns takes ``buckets``: it is dealt by
    a hash of the key, and only the buckets of ``df``'s keys are read and
    rewritten (an existing table keeps its number; see ``rebucket``). With
    neither, the whole table is written anew and swapped in. An empty text in
    a partition column is stored as null, as folders can't tell them apart."""
    spark = df.sparkSession
    keys, parts = list(keys), list(partition_by)
    if not set(parts) <= set(keys):
        raise ValueError("a row's partition must follow from its key")
    if parts and buckets:
        raise ValueError("a table is dealt by partition columns or by buckets")
    for c in parts:
        df = df.withColumn(c, F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")))
    new = one_per_key(df, keys, order)
    there = path_exists(spark, path)
    layout = bucket_layout(spark, path) if there else None
    if layout and layout[1] != keys:
        raise ValueError(f"the table is dealt by {layout[1]}, not by {keys}")
    if not there:
        if buckets:
            new = new.withColumn(BUCKET, _bucket(keys, buckets))
            replace_table(new, path, [BUCKET], {"buckets": buckets, "keys": keys})
        else:
            replace_table(new, path, parts)
        return
    if buckets and not layout:
        raise ValueError(f"{path} has no buckets; rebucket() deals it into some")
    new = conform_to_table(spark, new, path)
    if not layout and not parts:
        old = read_table(spark, path)
        replace_table(old.join(new, _same(old, new, keys), "left_anti").unionByName(new, allowMissingColumns=True), path)
        return
    folders = parts
    if layout:
        was = {f.name: f.dataType for f in stored_schema(spark, path).fields}
        wider = [k for k in keys if new.schema[k].dataType != was[k]]
        if wider:
            raise ValueError(f"key columns {wider} of a bucketed table keep their type")
        folders, new = [BUCKET], new.withColumn(BUCKET, _bucket(keys, layout[0]))
    new = cut_lineage(new, spark, "upsert")
    if layout:  # at most as many as the table has buckets: the scan lists their folders alone
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]
        old = spark.read.schema(stored_schema(spark, path)).parquet(path).where(F.col(BUCKET).isin(touched))
    else:
        old, touched = read_table(spark, path), new.select(*parts).distinct()
        old = old.join(touched, _same(old, touched, parts), "left_semi")
    out = old.join(new, _same(old, new, keys), "left_anti").unionByName(new, allowMissingColumns=True)
    staged = cut_lineage(out, spark, "upsert")  # the table is read to its end before it is written
    _extend_schema(spark, path, staged, folders, {"buckets": layout[0], "keys": keys} if layout else None)
    (staged.hint("rebalance", *folders).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*folders).parquet(path))


def comment_columns(spark: SparkSession, table: str, comments: Mapping[str, str]) -> None:
    """SNK-6: column comments of a catalog table (from dictionary titles)."""
    existing = {f.name for f in spark.table(table).schema.fields}
    for column, text in comments.items():
        if column in existing and text:
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT {_sql_string(text)}")


def dictionary_comments(dictionary: DataFrame, file: str | None = None, name: str = "name", title: str = "title",
                        field_title: str = "field_title", file_col: str = "file", order: str | None = None) -> dict[str, str]:
    """Comment text per column from a dictionary: ``title; field_title`` of the
    column's first row (by ``order`` if given, else by both titles), of the
    rows of ``file`` if given. One short text per column of one table."""
    d = dictionary if file is None else dictionary.filter(F.col(file_col) == file)
    text = F.concat(F.coalesce(F.col(title), F.lit("")), F.when(F.coalesce(F.col(field_title), F.lit("")) != "",
                    F.concat(F.lit("; "), F.col(field_title))).otherwise(F.lit("")))
    first = F.struct(*([F.col(order)] if order else []), F.col(title), F.col(field_title))
    rows = d.groupBy(name).agg(F.min_by(text, first).alias("t")).collect()
    return {r[name]: r["t"] for r in rows}


def comment_table(spark: SparkSession, table: str, text: str) -> None:
    """SNK-7."""
    spark.sql(f"COMMENT ON TABLE {table} IS {_sql_string(text)}")


def _sql_string(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_json_docs(df: DataFrame, path: str, keys: Sequence[str] = (),
                    order: Order | None = None) -> None:
    """SNK-8: cleaned documents as JSON lines; with ``keys``, one document per
    key (last writer by ``order``), replacing the folder."""
    out = one_per_key(df, list(keys), order) if keys else df
    out.write.mode("overwrite").json(path)
