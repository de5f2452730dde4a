"""The training-data pipeline over ``documents``.

Five stages, each one of the operators of ``tidemark.llm`` over all that the
stage before kept: quality rules, SimHash near-duplicates, benchmark
decontamination, the mix of sources to their target weights, and the token
files. Every stage's result is written as Parquet and read again as the next
one's documents. The last gives the place, length and checksum of each
document in the token files.

Cases are those of the operators; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, mixing, quality, simhash, token_files
from tidemark.llm.queries import tokenizer_file
from tidemark.session import apply_engine_conf, cut_lineage, read_table, scratch_path


#: Bytes of text in a lot of the quality rules. The workers of a pipeline hold
#: what other stages have left as well, so lots are smaller than the
#: operator's own: less memory for more shuffled bytes, with equal results.
LOT_BYTES = 10 << 20


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept(docs, read_table(spark, sf_dir, "labels"), lot_bytes=LOT_BYTES)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    token_files.write(docs, tokenizer_file("word_bpe_49k.json"), out)
    return token_files.read(spark, out)


STAGES = [
    ("quality rules", rules),
    ("SimHash near-duplicates", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing to target weights", mixed),
    ("token files", token_output),
]

#: DuckDB has neither the hashed language model, the fingerprints, the edit
#: distance search nor the tokenizer; tests/llm holds each stage against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    apply_engine_conf(spark)
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut_lineage(docs, spark, f"pipeline-{k + 1}")
    return docs
