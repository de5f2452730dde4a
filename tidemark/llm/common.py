"""Small helpers that several operators share."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Largest Arrow batch that a Python worker gets, in bytes.
BATCH_BYTES = "16m"
#: Rows of a batch at most.
BATCH_ROWS = "4096"


def _ship(spark: SparkSession) -> None:
    """Give the executors this package, once for a Spark application: they
    may have neither it nor the driver's working folder."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(out))
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()


def bounded_batches(spark: SparkSession) -> None:
    """Make a session ready for Python workers: they get this package, and
    Arrow batches are bounded by bytes as well as by rows, so that long texts
    do not add up in a worker."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def col(name: str):
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    while name.lower() in [c.lower() for c in df.columns]:
        name += "_"
    return name


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) alone, whatever else ``df``
    holds, so that its other columns can't clash with an operator's own."""
    return df.select(col(id_col).alias("doc_id"),
                     F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
                     *[col(c).alias(c) for c in more])


def utf8(column) -> list[bytes]:
    """The UTF-8 bytes of each value of an Arrow string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def over_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                 schema: str) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def digest_of(path: str) -> str:
    """SHA-256 of a file's bytes."""
    h = hashlib.sha256()
    with open(path, "rb") as f:
        for part in iter(lambda: f.read(1 << 20), b""):
            h.update(part)
    return h.hexdigest()


def numbered(df: DataFrame, name: str, *order) -> DataFrame:
    """``df`` with the place ``name`` (a long, from 0) of each row in an order.
    Ranges of the order are sorted by themselves; the rows before a range come
    from a sum over the ranges."""
    from ..session import cut_lineage

    spark = df.sparkSession
    lots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(lots, *order).sortWithinPartitions(*order)
    rows = cut_lineage(dealt.withColumns({"in_range": F.spark_partition_id(), "in_order": F.monotonically_increasing_id()}), spark, "numbered")
    ranges = rows.groupBy(F.col("in_range").alias("of_range")).agg(F.min("in_order").alias("least"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("of_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    ranges = ranges.select("of_range", (F.col("least") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("shift"))
    return rows.join(ranges, F.col("in_range") == F.col("of_range")).select(*map(col, df.columns), (F.col("in_order") - F.col("shift")).alias(name))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every end of an edge, ``component`` being the
    smallest node reachable.

    Alternates large-star and small-star steps until the edges stay as they
    are. Every step is a grouped minimum joined back to the edges: a node of
    many edges is a partial aggregate and a join that adaptive execution can
    split, never a collected list. Each round is cut by a reliable checkpoint.
    """
    spark = edges.sparkSession
    e = edges.select(col(a).alias("u"), col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = _checkpoint(spark, e)
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = _checkpoint(spark, small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .union(low.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())


def _checkpoint(spark: SparkSession, df: DataFrame) -> DataFrame:
    from ..session import checkpoint_root

    checkpoint_root(spark)
    return df.checkpoint(eager=True)


#: Keys that hold over one part in so many of the rows go by broadcast.
HOT_SHARE = 1000


def spread_join(rows: DataFrame, table: DataFrame, key: str, count: str, share: int = HOT_SHARE) -> DataFrame:
    """``rows`` with the columns of ``table`` (one row for each value of
    ``key``, null among them, with the number ``count`` of its rows), but for
    ``count``.

    A key that holds over one part in ``share`` of all rows is joined where
    its rows are: there are fewer than ``share`` such keys, so their part of
    ``table`` is broadcast. All others meet their rows by a shuffle. Both
    frames should be staged: they are read twice."""
    total = table.agg(F.sum(count)).first()[0] or 0
    name = fresh_name(rows, "of_key")
    of = table.withColumnRenamed(key, name)
    hot, rest = of.where(col(count) * share > total).drop(count), of.where(col(count) * share <= total).drop(count)
    same = col(key).eqNullSafe(col(name))
    here = rows.join(F.broadcast(hot), same)
    others = rows.join(F.broadcast(hot.select(name)), same, "left_anti").join(rest, same)
    return here.union(others).drop(name)
