"""Token counts through a digest cache.

The cache is a table of (tokenizer digest, content digest, tokens): SHA-256
of the vocabulary file and of the normalised content. A run joins the
documents' digests to the stored counts, encodes one text for each digest
that is missing, appends these counts, and joins every row to its count.

Content is normalised by reading null as empty and in no other way: a
byte-level tokenizer sees every other difference, so any further step could
give two texts of different length one digest.

Inside a task :mod:`pieces` gives the library's ids; a sentencepiece model
(``.model``) encodes whole texts.

Cases: null and empty texts have no tokens; copies are encoded once; repeated
and null ids stay rows of their own; an empty table gives an empty result and
appends nothing; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import digest_of, id_and_text, over_batches
from .pieces import encoder

LIMIT = 512
_SCHEMA = "tokenizer string, digest binary, n_tokens long"


@lru_cache(maxsize=2)
def _sentencepiece(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def token_numbers(texts: list[str], path: str) -> list[int]:
    """Tokens of each whole text."""
    if path.endswith(".model"):
        return [len(x) for x in _sentencepiece(path).encode(texts, add_bos=False, add_eos=False, num_threads=1)] if texts else []
    ids = encoder(path)
    return [len(ids(t)) // 4 for t in texts]


def count_texts(missing: DataFrame, path: str) -> DataFrame:
    """``(digest, n_tokens)`` of the rows ``(digest, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = token_numbers(b.column("text").to_pylist(), path)
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(np.array(n, np.int64))], ["digest", "n_tokens"])

    return over_batches(missing, run, "digest binary, n_tokens long")


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """The stored ``(digest, n_tokens)`` of a tokenizer; no such folder: none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return (spark.read.schema(_SCHEMA).parquet(cache).where(F.col("tokenizer") == tokenizer)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))  # a rerun after a crash may have appended twice


def counted(docs: DataFrame, tokenizer_path: str, cache: str, id_col: str = "doc_id", text_col: str = "text",
            limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``;
    counts that ``cache`` lacks are appended to it."""
    spark = docs.sparkSession
    version = digest_of(tokenizer_path)
    base = id_and_text(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    keyed = base.withColumn("digest", digest)
    have = read_cache(spark, cache, version).select(F.col("digest").alias("had"))
    missing = keyed.select("digest", "text").groupBy("digest").agg(F.first("text").alias("text")).join(
        have, F.col("digest") == F.col("had"), "left_anti")
    (count_texts(missing, tokenizer_path).select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
     .write.mode("append").parquet(cache))
    stored = read_cache(spark, cache, version).withColumnRenamed("digest", "of")
    light = keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    return light.join(stored, F.col("digest") == F.col("of")).select(
        F.col("doc_id").cast(kind).alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
