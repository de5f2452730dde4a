"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_engine_conf, read_table, scratch_path
from . import (
    decontamination,
    divergence,
    html_text,
    licences,
    minhash,
    mixing,
    quality,
    simhash,
    suffix_dedup,
    token_counts,
    token_files,
    url_filter,
    vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    """The path of a public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as range-coded blocks and read back."""
    out = scratch_path(spark, "token-files")
    token_files.write(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), out)
    return token_files.read(spark, out)


def html_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extracted(read_table(spark, sf_dir, "pages"))


def url_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of all page urls."""
    return url_filter.filtered(read_table(spark, sf_dir, "pages"))


def licence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences stated in all documents."""
    return licences.scan(read_table(spark, sf_dir, "documents"))


def suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of all documents without repeated strings of 100 bytes."""
    return suffix_dedup.deduplicated(read_table(spark, sf_dir, "documents"))


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    got = decontamination.with_hits(docs, read_table(spark, sf_dir, "benchmark"), "items")
    return got.select("doc_id", F.col("items").alias("item_ids"), F.size("items").cast("long").alias("n_items"),
                      (F.size("items") > 0).alias("contaminated"))


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of all documents."""
    got = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return got.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and model verdict of all documents."""
    return quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    got, sources = mixing.mixed_with(read_table(spark, sf_dir, "documents"))
    table = sources.select("of", F.col("words").alias("source_size"), "target")
    rows = got.select("doc_id", "size", "taken", F.col("members")[0].alias("source"))
    return rows.join(table, F.col("source").eqNullSafe(F.col("of"))).select("doc_id", "size", "source_size", "target", "taken", "source")


def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents. The cache starts empty in each run, so that
    every different text is encoded."""
    cache = scratch_path(spark, "token-cache")
    return token_counts.counted(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), cache)


def minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of all documents by their word shingles."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def vector_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings."""
    return vector_codes.compressed(read_table(spark, sf_dir, "embeddings"))


def divergence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term shares of all documents' sources against each other."""
    return divergence.divergence(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_html_text": html_query,
    "op2_token_files": token_files_query,
    "op3_url_filter": url_query,
    "op4_suffix_dedup": suffix_query,
    "op5_licences": licence_query,
    "op6_decontamination": decontamination_query,
    "op7_simhash": simhash_query,
    "op8_quality": quality_query,
    "op9_mixing": mixing_query,
    "op10_token_counts": token_counts_query,
    "op11_minhash": minhash_query,
    "op12_vector_codes": vector_query,
    "op13_divergence": divergence_query,
}
ORACLES: dict[str, str] = {
    "op5_licences": licences.oracle(),
    "op12_vector_codes": vector_codes.oracle(),
    "op13_divergence": divergence.oracle(),
}


def queries() -> dict[str, Query]:
    def held(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_engine_conf(spark)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        return run

    return {name: held(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
