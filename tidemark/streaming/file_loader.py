"""Incremental file loading as a Structured Streaming job.

The batch scripts skip files already loaded (INC-1) and replace the slice of
each new file (SNK-1). As a stream, the file source's checkpoint remembers
which files were read, so every run picks up exactly the new files; an
``availableNow`` trigger processes them and stops, which suits scheduled
loads. Each micro-batch replaces the slices of the files it holds, so a
re-delivered batch after a failure rewrites the same slices (idempotent).

The stream checkpoint must be stable across runs and on shared storage; by
default it is ``<target>/_stream_checkpoint`` (readers skip ``_`` folders).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.tables import replace_slice
from ..sources.files import FILE_PATH, read_csv_text

Transform = Callable[[DataFrame], DataFrame]


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def rows_of(spark: SparkSession, paths: list[str], columns: list[str], **csv_options) -> DataFrame:
    """The rows of some files as ``columns`` (each by its name in the file's
    own header; null where a file lacks it) with the file's name and path."""
    raw = read_csv_text(spark, paths, **csv_options)
    there = {c.lower(): c for c in raw.columns}
    named = [F.col(f"`{there[c.lower()]}`").alias(c) if c.lower() in there else F.lit(None).cast("string").alias(c) for c in columns]
    return raw.select(*named, F.substring_index(FILE_PATH, "/", -1).alias("src_file_name"), FILE_PATH)


def start_csv_load(spark: SparkSession, source_dir: str, columns: list[str], target: str,
                   transform: Transform | None = None, key: str = "src_file_name",
                   checkpoint: str | None = None, pattern: str = "*.csv",
                   max_files_per_trigger: int | None = None, **csv_options):
    """Start a stream over ``source_dir`` that loads every new CSV file (all
    columns text, header row) into the partitioned table at ``target``,
    replacing the slice ``key`` (the file name by default) of each file.

    The stream itself carries the files' paths alone (their content is not
    read); a micro-batch reads its files as a batch load does, by the names in
    their headers and with line breaks and quotes in quoted values.

    ``transform`` turns the raw text rows (with ``src_file_name`` and
    ``src_file_path`` added) into table rows. Returns the running query; with
    the default trigger it stops by itself once the files present are done."""
    reader = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
              .option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]  # a reader must be told them
        if paths:
            rows = rows_of(batch.sparkSession, paths, columns, **csv_options)
            replace_slice(transform(rows) if transform else rows, target, key)

    # the checkpoint must be stable across runs (it is what remembers loaded
    # files); by default it sits beside the table, where readers ignore it
    ckpt = checkpoint or target.rstrip("/") + "/_stream_checkpoint"
    return (reader.load(source_dir).select("path").writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def run_csv_load(spark: SparkSession, source_dir: str, columns: list[str], target: str,
                 transform: Transform | None = None, checkpoint: str | None = None, **kw) -> None:
    """Start the load and wait until the files present have been processed."""
    q = start_csv_load(spark, source_dir, columns, target, transform, checkpoint=checkpoint, **kw)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
