"""Token ids of a corpus in range-coded blocks.

Documents are dealt out by ranges of their id, sorted, encoded by the
tokenizers library, each followed by an end id, and cut into shards of whole
documents. A shard is a row of the written table: its documents' ids and
lengths and its blocks (see :mod:`range_coder`), each on its own and
checksummed. Spark's writer commits the files, so a lost executor or a task
that runs twice leaves no half or double shard.

Reading decodes the blocks, checks them, and gives each document its place in
the whole sequence. The places come from the shards' lengths alone: sums by
part, then within each part.

A shard closes at ``SHARD_IDS`` ids; a document is never split over shards,
so a longer one has a shard of its own (in as many blocks as it needs).

Cases: null and empty texts are the end id alone; null ids come first;
documents of equal id follow each other in the order of their texts' hashes;
an empty table gives an empty folder of shards and an empty result; extra
columns are not read. A damaged block raises an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import range_coder
from .common import id_and_text, over_batches
from .pieces import encoder, forget, give_back

END_ID = 2
SHARD_IDS = range_coder.BLOCK * range_coder.LANES


def write(docs: DataFrame, tokenizer_path: str, out: str, id_col: str = "doc_id", text_col: str = "text",
          end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode every document of ``docs`` into shards under the folder ``out``."""
    base = id_and_text(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    order = ("doc_id", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = base.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # a worker may have run other stages
        ids_of, part, shard = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        vocab, end = max(ids_of.vocab, end_id + 1), np.array([end_id], np.uint32).tobytes()
        names: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal shard
            all_ids, rows, lengths = np.concatenate(held), pa.concat_arrays(names), pa.array(np.concatenate(sizes))
            for x in (names, sizes, held):
                x.clear()
            out_row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(all_ids)], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), lengths),
                pa.array([b"".join(range_coder.encode(all_ids, vocab))], pa.binary())],
                ["part", "shard", "n_ids", "doc_ids", "sizes", "blocks"])
            shard += 1
            return out_row

        n = 0  # ids held
        for b in batches:
            of = b.column("doc_id")
            since = 0
            for ids, size in ids_of.many(b.column("text"), end):
                ends, at = np.cumsum(size), 0  # at: documents of these that are dealt with
                while at < len(size):
                    before = int(ends[at - 1]) if at else 0
                    until = min(int(np.searchsorted(ends, before + shard_ids - n)) + 1, len(size))
                    names.append(of.slice(since + at, until - at))
                    sizes.append(size[at:until])
                    held.append(ids[before:int(ends[until - 1])])
                    n, at = n + len(held[-1]), until
                    if n >= shard_ids:
                        yield close()
                        n = 0
                since += len(size)
        if names:
            yield close()

    schema = f"part int, shard int, n_ids long, doc_ids array<{kind}>, sizes array<long>, blocks binary"
    over_batches(dealt, run, schema).write.mode("overwrite").parquet(out)


def read(spark: SparkSession, out: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids`` if asked for) of
    every document under ``out``, from the decoded blocks."""
    shards = spark.read.parquet(out)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # a worker that wrote shards reads some now
        for b in batches:
            for row in range(b.num_rows):
                part, shard, sizes = (b.column(c)[row].as_py() for c in ("part", "shard", "sizes"))
                ids = range_coder.decode(b.column("blocks")[row].as_buffer().to_pybytes()).astype("<u4")
                sizes = np.array(sizes, np.int64)
                ends = np.cumsum(sizes)
                if len(ids) != (ends[-1] if len(ends) else 0):
                    raise ValueError("a shard's blocks and documents differ in length")
                names = b.column("doc_ids")[row].values
                starts = ends - sizes
                for at in range(0, len(sizes), 4096):  # bounded batches out
                    cut = slice(at, at + 4096)
                    raw = [ids[s:e].tobytes() for s, e in zip(starts[cut].tolist(), ends[cut].tolist())]
                    k = len(raw)
                    cols = [pa.array([part] * k, pa.int32()), pa.array([shard] * k, pa.int32()), names.slice(at, k),
                            pa.array(starts[cut]), pa.array(sizes[cut]), pa.array([zlib.crc32(x) for x in raw], pa.int64())]
                    fields = ["part", "shard", "doc_id", "offset", "n_tokens", "ids_crc32"]
                    if with_ids:
                        cols.append(pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in raw], pa.list_(pa.int64())))
                        fields.append("ids")
                    yield pa.RecordBatch.from_arrays(cols, fields)

    schema = f"part int, shard int, doc_id {kind}, offset long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    docs = over_batches(shards.select("part", "shard", "doc_ids", "sizes", "blocks"), run, schema)
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row for each part
    base = sums.select(F.col("part").alias("p1"), F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = shards.select(F.col("part").alias("p2"), F.col("shard").alias("s2"), F.coalesce(
        F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("inside"))
    places = inside.join(base, F.col("p1") == F.col("p2")).select("p2", "s2", (F.col("base") + F.col("inside")).alias("place"))
    got = docs.join(places, (F.col("part") == F.col("p2")) & (F.col("shard") == F.col("s2")))
    return got.select("doc_id", (F.col("place") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
