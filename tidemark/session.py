"""Session settings and shared scratch space.

Scratch data (lineage cuts, staged tables, sink round trips) goes under the
folder the cluster names in ``spark.checkpoint.dir``: a shared file system
that survives the loss of an executor. A folder is set only when the session
has none and runs on one machine (local tests); a cluster must name one.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

# Bytes of different values that Parquet's writer holds once for each column.
DICTIONARY_BYTES = "parquet.dictionary.page.size"
# Whether it keeps the least and the largest folded text of a dictionary.
FOLDED_STATISTICS = "parquet.column.statistics.enabled#code_and_values"

# Session settings every job here relies on.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # slice replacement = dynamic partition overwrite (SNK-1/2)
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # keep partition values as written ("007" must not come back as 7)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    # Parquet's defaults; build_dictionary changes them for what is written of it
    DICTIONARY_BYTES: str(1 << 20),
    FOLDED_STATISTICS: "true",
}


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Set the runtime-settable engine options on an existing session."""
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session. A session in local mode
    that names none gets one under the system temp folder; on a cluster that
    would be a different folder on every machine, so there it is an error."""
    root = None
    try:
        root = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - connect sessions have no SparkContext
        root = None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root


_SCOPES = threading.local()
_BASES: set[str] = set()  # scratch folders that go with their application


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root. Inside a
    :func:`scratch_scope` the folder is deleted when the scope ends, otherwise
    with the application."""
    base = f"{checkpoint_root(spark).rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"
    if base not in _BASES:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _BASES.add(base)
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    for scope in getattr(_SCOPES, "stack", []):
        scope.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch folders (staged matrices, lineage cuts) created
    inside the ``with`` block once it ends, i.e. after the load that used
    them has been written:

        with scratch_scope(spark):
            write_full(measure_values(spark, root, patterns, today), target)
    """
    stack = getattr(_SCOPES, "stack", None)
    if stack is None:
        stack = _SCOPES.stack = []
    created: list[str] = []
    stack.append(created)
    try:
        yield created
    finally:
        stack.remove(created)
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in created:
            p = jvm.org.apache.hadoop.fs.Path(path)
            fs = p.getFileSystem(conf)
            if fs.exists(p):
                fs.delete(p, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file creation in tests."""
    return path[5:] if path.startswith("file:") else path


def cut_lineage(df: DataFrame, spark: SparkSession | None = None, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: a lineage
    cut that survives executor loss (never a local checkpoint)."""
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def data_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """SRC-10: a driver table by name."""
    return spark.read.parquet(data_path(sf_dir, table))
