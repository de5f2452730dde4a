"""Product codes of vectors by a lexicographic trie over their parts.

Each component ``x`` becomes the integer ``floor(1024 * x)``; a vector is cut
into ``PARTS`` equal consecutive parts and each part is coded by the nearest
entry of its position's codebook (squared Euclidean distance, ties to the
lower index). A codebook starts as that part of the ``ENTRIES`` smallest ids
and is refined ``ROUNDS`` times: every entry becomes the floored mean of the
parts that chose it. All arithmetic is on integers and exact.

The distinct parts with their counts are staged once, in lexicographic order
over ranges. A round reads them as tries: the trie of a range is walked depth
first, and a node hands the distances of its prefix to all 256 entries down to
its children, so that parts with a common prefix pay for it once; subtrees of
at most ``LEAVES`` parts are walked a level at a time as numpy arrays. A leaf
takes the argmin and adds its part, times its count, to that entry's sum.
Only the sums, a fixed number of them a task, leave a task, and only the
codebooks (a fixed size) come to the driver.

Cases: rows whose vector is null or holds a null, infinite or NaN component
are dropped; null ids come after all others, rows of equal ids in the order of
their vectors; repeated rows are coded one by one; null labels are one label;
with fewer than 256 vectors a codebook has as many entries as there are; an
empty vector has empty parts and error 0; an empty table gives an empty
result; extra columns are not read. A vector whose length is not a multiple
of four or differs from the others', or a component of 65,536 or more, fails
the job with a message: squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import col, over_batches, spread_join

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Parts of a subtree that is walked a level at a time.
LEAVES = 512
#: Largest absolute component after scaling.
LARGEST = 1 << 26


def nearest(parts: np.ndarray, book: np.ndarray, leaves: int = LEAVES) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each row of ``parts``, which are distinct
    and in lexicographic order."""
    n, width = parts.shape
    code, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n:
        return code, error
    turned = np.ascontiguousarray(book.T)  # entries by dimension
    differ = np.ones((n, width), bool)  # whether a row opens a new node at a depth
    if n > 1:
        differ[1:] = np.logical_or.accumulate(parts[1:] != parts[:-1], axis=1)

    def leaf(i: int, j: int, total: np.ndarray) -> None:
        code[i:j] = total.argmin(axis=1)
        error[i:j] = np.take_along_axis(total, code[i:j, None], axis=1)[:, 0]

    stack = [(0, n, 0, np.zeros(len(book), np.int64))]  # rows i to j share the first d components
    while stack:
        i, j, d, total = stack.pop()
        if j - i <= leaves or d == width:
            level, own = total[None, :], np.zeros(j - i, np.int64)  # nodes of this depth, and each row's
            for k in range(d, width):
                opens = differ[i:j, k].copy()
                opens[0] = True
                first = np.flatnonzero(opens)
                step = parts[i:j, k][first, None] - turned[k][None, :]
                level = level[own[first]] + step * step
                own = np.cumsum(opens) - 1
            leaf(i, j, level[own] if len(level) != j - i else level)
            continue
        opens = np.flatnonzero(differ[i:j, d]) + i
        starts = np.union1d(opens, [i])
        for a, b in reversed(list(zip(starts.tolist(), [*starts[1:].tolist(), j]))):
            step = parts[a, d] - turned[d]
            stack.append((a, b, d + 1, total + step * step))
    return code, error


def _distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, and the place of each row there."""
    if not parts.shape[1]:
        return parts[:1], np.zeros(len(parts), np.int64)
    order = np.lexsort(parts.T[::-1])
    ranked = parts[order]
    new = np.ones(len(parts), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    at = np.empty(len(parts), np.int64)
    at[order] = np.cumsum(new) - 1
    return ranked[new], at


def coded(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (a column for each part) and summed distances of scaled vectors;
    ``books`` by part, entry and position."""
    n, parts = len(vectors), len(books)
    cut = vectors.reshape(n, parts, -1)
    codes, errors = np.zeros((n, parts), np.int64), np.zeros(n, np.int64)
    for p in range(parts):
        rows, at = _distinct(np.ascontiguousarray(cut[:, p]))
        code, error = nearest(rows, books[p])
        codes[:, p] = code[at]
        errors += error[at]
    return codes, errors


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError(f"vectors of different lengths: {sizes.min()} and {sizes.max()}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(sizes), int(sizes[0]) if len(sizes) else 0)


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *more: str, parts: int = PARTS,
           scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``scaled`` (array of long) and the columns ``more`` of the
    rows whose vector is whole and finite."""
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(col(id_col).alias("vec_id"), col(vector_col).cast("array<double>").alias("v"),
                          *[col(c).alias(c) for c in more]).where(F.col("v").isNotNull() & whole)
    fits = F.forall("v", lambda x: F.abs(x) * scale < LARGEST) & (F.size("v") % parts == 0)
    wrong = F.raise_error(F.concat(F.lit(f"a vector whose length is no multiple of {parts}, or a component of {LARGEST // scale} or more: id "),
                                   F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))))
    return rows.select("vec_id", F.when(fits, F.transform("v", lambda x: F.floor(x * scale).cast("long")))
                       .otherwise(wrong.cast("array<long>")).alias("scaled"), *more)


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """The parts of the ``entries`` smallest ids."""
    first = rows.select("vec_id", "scaled").orderBy(F.asc_nulls_last("vec_id"), "scaled").limit(entries).collect()
    widths = {len(r["scaled"]) for r in first}
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {min(widths)} and {max(widths)}")
    width = max(widths, default=0) // parts
    whole = np.array([r["scaled"] for r in first], np.int64).reshape(len(first), parts, width)
    return np.ascontiguousarray(whole.transpose(1, 0, 2))


def distinct_parts(rows: DataFrame, width: int, parts: int = PARTS) -> DataFrame:
    """``pos, part, n``: the different parts of each position with their
    counts, staged in lexicographic order."""
    spark = rows.sparkSession
    cut = F.array(*[F.slice("scaled", p * width + 1, width) for p in range(parts)])
    counted = (rows.select(F.posexplode(cut).alias("pos", "part")).groupBy("pos", "part").agg(F.count(F.lit(1)).alias("n")))
    lots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(counted.repartitionByRange(lots, "pos", "part").sortWithinPartitions("pos", "part"), spark, "vector-parts")


def refined(distinct: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry moves to the floored mean of its parts."""
    held = distinct.sparkSession.sparkContext.broadcast(books)  # parts x entries x width integers
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            pos, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("pos", "n"))
            rows = _matrix(b.column("part"))
            for p in np.unique(pos):
                mine = pos == p
                ranked, at = _distinct(np.ascontiguousarray(rows[mine]))  # several ranges may follow one another
                weight = np.zeros(len(ranked), np.int64)
                np.add.at(weight, at, n[mine])
                code, _ = nearest(ranked, held.value[p])
                np.add.at(counts[p], code, weight)
                np.add.at(sums[p], code, ranked * weight[:, None])
        at = np.flatnonzero(counts.reshape(-1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(counts.reshape(-1)[at]),
             pa.array(list(sums.reshape(parts * entries, width)[at]), pa.list_(pa.int64()))], ["entry", "n", "sums"])

    found = over_batches(distinct, run, "entry int, n long, sums array<long>")
    totals = found.groupBy("entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))
    out = books.copy().reshape(parts * entries, width)
    for r in totals.collect():  # a row an entry
        out[r["entry"]] = [s // r["n"] for s in r["sums"]]
    held.unpersist()
    return out.reshape(books.shape)


def trained(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (part, entry, position) fitted on all ``scaled`` rows."""
    books = first_books(rows, parts, entries)
    if books.shape[1] and books.shape[2]:
        distinct = distinct_parts(rows, books.shape[2], parts)
        for _ in range(rounds):
            books = refined(distinct, books)
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of the components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def codes(rows: DataFrame, books: np.ndarray, *more: str) -> DataFrame:
    """``vec_id``, ``codes`` (an integer a part), ``error`` and ``more`` of
    every ``scaled`` row."""
    held = rows.sparkSession.sparkContext.broadcast(books)
    kept = rows.select("vec_id", "scaled", *more)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "scaled"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = held.value.shape[0] * held.value.shape[2]
        for b in batches:
            whole = _matrix(b.column("scaled")).astype(np.int64)
            if whole.shape[1] != width and len(whole):
                raise ValueError(f"vectors of different lengths: {width} and {whole.shape[1]}")
            code, error = coded(whole, held.value)
            others = [b.column(c) for c in ("vec_id", *more)]
            yield pa.RecordBatch.from_arrays([*others, pa.array(list(code.astype(np.int32)), pa.list_(pa.int32())), pa.array(error)],
                                             ["vec_id", *more, "codes", "error"])

    return over_batches(kept, run, ", ".join([*fields, "codes array<int>", "error long"]))


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every whole,
    finite vector."""
    spark = vectors.sparkSession
    rows = scaled(vectors.withColumn("vector_label", col(label_col)) if label_col != "vector_label" else vectors,
                  id_col, vector_col, "vector_label")
    rows = cut_lineage(rows, spark, "vectors-scaled")
    books = trained(rows)
    got = cut_lineage(codes(rows, books, "vector_label"), spark, "vector-codes")
    sums = got.groupBy("vector_label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n_rows"))
    out = spread_join(got, sums, "vector_label", "n_rows")
    return out.select("vec_id", F.concat_ws("", F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))).alias("code"),
                      "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL for ``compressed``: every part against every entry."""
    steps = [f"""rows AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
  list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""parts AS (SELECT r, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS part
  FROM rows, range({parts}) AS t(p))""",
             f"book0 AS (SELECT p, r - 1 AS e, part AS entry FROM parts WHERE r <= {entries})"]
    near = """SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (SELECT parts.r, parts.p, b.e,
  list_sum(list_transform(list_zip(parts.part, b.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM parts JOIN {book} b ON parts.p = b.p) GROUP BY r, p"""
    for k in range(rounds):
        steps.append(f"near{k} AS MATERIALIZED ({near.format(book=f'book{k}')})")
        steps.append(f"""book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.entry, b.entry) AS entry FROM book{k} b LEFT JOIN (
  SELECT p, e, list(mean ORDER BY i) AS entry FROM (SELECT near{k}.p, e, i, CAST(floor(sum(part[i])::DOUBLE / count(*)) AS BIGINT) AS mean
    FROM near{k} JOIN parts USING (r, p), LATERAL (SELECT unnest(range(1, len(part) + 1)) AS i) GROUP BY ALL) GROUP BY p, e) m
  ON b.p = m.p AND b.e = m.e)""")
    steps.append(f"last AS MATERIALIZED ({near.format(book=f'book{rounds}')})")
    steps.append("""done AS (SELECT rows.r, vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM rows JOIN last USING (r) GROUP BY ALL)""")
    steps.append(f"""sums AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM done GROUP BY label)""")
    steps.append(f"""whole AS (SELECT sha256(string_agg(x, ',' ORDER BY p, e, i)) AS h FROM (
  SELECT p, e, i, CAST(entry[i] AS VARCHAR) AS x FROM book{rounds}, LATERAL (SELECT unnest(range(1, len(entry) + 1)) AS i)))""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, label_error, h AS codebooks_sha256
FROM done JOIN sums ON done.label IS NOT DISTINCT FROM sums.label, whole"""
