"""Source divergence audit: term shares of sources against each other and
against their language.

Terms are runs of ASCII letters and of characters beyond ASCII, A-Z
lower-cased. A language keeps the terms that at least ``MIN_DOCS`` of its
documents hold. With ``N`` occurrences of kept terms in a group and ``V`` kept
terms of the language, a term counted ``c`` times in a group has the share
``1 + floor(ONE * (c + ADD) / (N + ADD * V))``, an integer; all arithmetic is
on integers.

Counting packs terms by their length in bytes: up to 8 bytes are one unsigned
64-bit word, up to 16 two of them (big-endian, filled up with zeros, which no
term holds), and both are radix-sorted in numpy, 16 bits at a time. Runs of
equal (term, document) and (term, group) then give occurrences and documents.
Longer terms go to a bucket for each length, which is sorted by its bytes. A
task counts lots of about ``LOT_BYTES`` of text; only a lot's counts leave it
and are added up by Spark.

Part ``pair`` lays the counts of a language out as terms by sources. Sources
are numbered and cut into tiles of ``TILE``, terms are dealt into chunks of
about ``CHUNK``; a chunk and a pair of tiles is one small dense matrix, which
sums the absolute differences of all its columns. What all other kept terms
add (both shares at their floor) is added for them at once. Part ``term``
ranks the terms of a group by a window whose limit Spark applies before its
shuffle, so that no hot group is sorted whole.

Cases: null text, language and source are read as ''; a group without terms
has its pairs, with shares at their floor; a language without kept terms has
pairs of value 0; equal values rank by the item's bytes; ids are not needed,
so null or repeated ids are rows like any other; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import bounded_batches, col, over_batches, utf8

MIN_DOCS = 30
ONE = 1_000_000_000
ADD = 5
TOP = 50
#: Bytes of text that are counted at once, about.
LOT_BYTES = 1 << 23
TILE = 256
CHUNK = 4096

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: Keeps the first 0 to 8 bytes of a big-endian word.
_FIRST = np.array([(1 << 64) - (1 << 8 * (8 - n)) if n else 0 for n in range(9)], np.uint64)


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes of all texts (with room after them), and start,
    length and text number of every term."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    data = np.frombuffer(b"\0".join(texts) + b"\0" * 17, np.uint8)
    inside = _LETTER[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, stops = edge[::2], edge[1::2]
    return _LOWER[data], starts, stops - starts, np.searchsorted(ends, starts, "right")


def _words(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes from ``starts``, ``sizes`` of them up to 8, as one word."""
    at = np.lib.stride_tricks.sliding_window_view(data, 8)[starts]
    return at.view(">u8")[:, 0].astype(np.uint64) & _FIRST[np.clip(sizes, 0, 8)]


def radix_order(words: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """``order`` rearranged, stably, by ``words`` (the first one leads)."""
    for w in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = (w >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]  # 16-bit keys: numpy sorts them by radix
    return order


def _runs(same: np.ndarray) -> np.ndarray:
    """Starts of the runs in a sequence of which ``same`` tells whether an
    element equals the one before; the sequence's length is appended."""
    return np.concatenate((np.flatnonzero(~same), [len(same)]))


def _counted(keys: list[np.ndarray], doc: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows ordered by their keys and documents: the first row, the rows
    and the different documents of each (key, group)."""
    same = np.zeros(len(doc), bool)
    same[1:] = np.logical_and.reduce([k[1:] == k[:-1] for k in keys])
    in_doc = same.copy()
    in_doc[1:] &= doc[1:] == doc[:-1]
    same[1:] &= group[1:] == group[:-1]
    runs = _runs(same)
    docs = np.add.reduceat((~in_doc).astype(np.int64), runs[:-1]) if len(doc) else np.zeros(0, np.int64)
    return runs[:-1], np.diff(runs), docs


def lot_counts(texts: list[bytes], groups: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """Group, term, occurrences and documents of a lot of texts, given in the
    order of their groups."""
    data, starts, sizes, doc = terms(texts)
    for low, high in ((1, 8), (9, 16)):
        mine = np.flatnonzero((sizes >= low) & (sizes <= high))
        if not len(mine):
            continue
        s, n, d = starts[mine], sizes[mine], doc[mine]
        words = [_words(data, s, n)] + ([_words(data, s + 8, n - 8)] if high > 8 else [])
        order = radix_order(words, np.arange(len(mine)))  # stable: documents stay in order
        words = [w[order] for w in words]
        first, count, docs = _counted(words, d[order], groups[d[order]])
        packed = np.empty((len(first), len(words)), ">u8")
        for k, w in enumerate(words):
            packed[:, k] = w[first]
        names = packed.view(f"S{8 * len(words)}")[:, 0].tolist()
        yield groups[d[order[first]]], names, count, docs
    for size in np.unique(sizes[sizes > 16]).tolist():  # a bucket for each length
        mine = np.flatnonzero(sizes == size)
        s, d = starts[mine], doc[mine]
        step = max(1, (1 << 24) // size)
        rows = np.concatenate([np.lib.stride_tricks.sliding_window_view(data, size)[s[i:i + step]] for i in range(0, len(s), step)])
        names = np.ascontiguousarray(rows).view(f"S{size}")[:, 0]
        order = np.argsort(names, kind="stable")
        names = names[order]
        first, count, docs = _counted([names], d[order], groups[d[order]])
        yield groups[d[order[first]]], names[first].tolist(), count, docs


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                lot_bytes: int = LOT_BYTES) -> DataFrame:
    """``lang, source, term, n, docs`` of every group's terms, and a row with
    a null term for every group."""
    rows = docs.select(*[F.coalesce(col(c).cast("string"), F.lit("")).alias(name)
                         for c, name in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def counted(texts: list[bytes], of: list[tuple]) -> Iterator[pa.RecordBatch]:
        names = sorted(set(of))
        number = {g: i for i, g in enumerate(names)}
        groups = np.array([number[g] for g in of], np.int64)
        order = np.argsort(groups, kind="stable")
        langs, sources = (pa.array([g[k] for g in names], pa.string()) for k in (0, 1))
        none = pa.array([0] * len(names), pa.int64())
        yield pa.RecordBatch.from_arrays([langs, sources, pa.nulls(len(names), pa.string()), none, none], schema=schema)
        for group, term, n, d in lot_counts([texts[i] for i in order], groups[order]):
            for at in range(0, len(term), 1 << 15):
                cut = slice(at, at + (1 << 15))
                which = pa.array(group[cut])
                yield pa.RecordBatch.from_arrays([langs.take(which), sources.take(which), pa.array(term[cut], pa.binary()).cast(pa.string()),
                                                  pa.array(n[cut]), pa.array(d[cut])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        of: list[tuple] = []
        size = 0
        for b in batches:
            for t, group in zip(utf8(b.column("text")), zip(b.column("lang").to_pylist(), b.column("source").to_pylist())):
                texts.append(t)
                of.append(group)
                size += len(t)
                if size >= lot_bytes:
                    yield from counted(texts, of)
                    texts, of, size = [], [], 0
        if texts:
            yield from counted(texts, of)

    found = over_batches(rows, run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, whole: str, v: str) -> F.Column:
    return F.expr(f"CAST(1 + (CAST({ONE} AS DECIMAL(38, 0)) * ({n} + {ADD})) div ({whole} + {ADD} * {v}) AS LONG)")


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               min_docs: int = MIN_DOCS, top: int = TOP, lot_bytes: int = LOT_BYTES, tile: int = TILE, chunk: int = CHUNK) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group."""
    spark = docs.sparkSession
    bounded_batches(spark)
    counts = cut_lineage(term_counts(docs, text_col, lang_col, source_col, lot_bytes), spark, "divergence-counts")
    kept = (counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs"))
            .where(F.col("lang_docs") >= min_docs).drop("lang_docs"))
    shares = cut_lineage(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), spark, "divergence-kept")

    of_kept = shares.select("lang", "term", "lang_n").distinct()
    langs = counts.select("lang").distinct().join(of_kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total")), "lang", "left")
    langs = langs.select("lang", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"))
    groups = counts.where("term IS NULL").select("lang", "source").join(
        shares.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(langs, "lang")
    by_source = Window.partitionBy("lang").orderBy("source")  # its output holds a row for each pair of a language's sources
    groups = groups.select("lang", "source", "v", "lang_total", F.coalesce("total", F.lit(0)).alias("total"),
                           (F.row_number().over(by_source) - 1).alias("at"))
    groups = cut_lineage(groups.withColumn("least", F.when(F.col("v") > 0, _share("0", "total", "v")).otherwise(F.lit(0))), spark, "divergence-groups")

    placed = shares.join(groups.select("lang", "source", "v", "total", "lang_total", "at"), ["lang", "source"])
    placed = placed.withColumn("p", _share("n", "total", "v")).withColumn("q", _share("lang_n", "lang_total", "v"))
    return _pairs(placed, groups, tile, chunk).unionByName(_terms(placed, top))


def _terms(placed: DataFrame, top: int) -> DataFrame:
    over = placed.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("p - q").alias("value"))
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return over.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)


def _pairs(placed: DataFrame, groups: DataFrame, tile: int, chunk: int) -> DataFrame:
    """Sums of absolute differences for every ordered pair of a language's
    sources: kept terms of either in chunks, the others at once."""
    last = F.expr(f"CAST((count - 1) div {tile} AS INT)")
    tiles = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.max("v").alias("v")).select(
        "lang", F.expr(f"CAST(v div {chunk} AS INT) + 1").alias("chunks"), last.alias("last"))

    def pairs_of(rows: DataFrame) -> DataFrame:
        """``rows`` once for each pair of tiles that theirs is in."""
        mine = F.expr(f"CAST(at div {tile} AS INT)")
        other = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
        out = rows.withColumn("mine", mine).select("*", other)
        return out.withColumn("ti", F.least("mine", "other")).withColumn("tj", F.greatest("mine", "other")).drop("mine", "other", "last")

    cells = pairs_of(placed.select("lang", "term", "at", "p").join(tiles, "lang")
                     .withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int")))
    cells = cells.select("lang", "chunk", "ti", "tj", "term", "at", "p")
    heads = pairs_of(groups.select("lang", "at", "least").join(tiles, "lang")).select(
        F.col("lang").alias("lang"), "ti", "tj", F.col("at").alias("head"), "least", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    schema = "lang string, a int, b int, part_sum long, part_terms long"

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        at = np.sort(right.column("head").to_numpy())
        if not left.num_rows:
            return pa.table({"lang": pa.array([], pa.string()), **{c: pa.array([], pa.int32()) for c in "ab"},
                             **{c: pa.array([], pa.int64()) for c in ("part_sum", "part_terms")}})
        least = np.zeros(len(at), np.int64)
        least[np.searchsorted(at, right.column("head").to_numpy())] = right.column("least").to_numpy()
        row = left.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        matrix = np.repeat(least[None, :], int(row.max()) + 1, axis=0)
        matrix[row, np.searchsorted(at, left.column("at").to_numpy())] = left.column("p").to_numpy()
        tiles_of = at // tile
        a_side, b_side = np.flatnonzero(tiles_of == key[2].as_py()), np.flatnonzero(tiles_of == key[3].as_py())
        sums = np.stack([np.abs(matrix[:, b_side] - matrix[:, [i]]).sum(axis=0) for i in a_side])
        ia, ib = np.meshgrid(at[a_side], at[b_side], indexing="ij")
        wanted = ia < ib
        n = int(wanted.sum())
        return pa.table({"lang": pa.array([key[0].as_py()] * n, pa.string()), "a": pa.array(ia[wanted].astype(np.int32)),
                         "b": pa.array(ib[wanted].astype(np.int32)), "part_sum": pa.array(sums[wanted]),
                         "part_terms": pa.array(np.full(n, len(matrix), np.int64))})

    keys = ["lang", "chunk", "ti", "tj"]
    found = cells.groupBy(*keys).cogroup(heads.groupBy(*keys)).applyInArrow(run, schema)
    sums = found.groupBy("lang", "a", "b").agg(F.sum("part_sum").alias("part_sum"), F.sum("part_terms").alias("part_terms"))
    ends = groups.select("lang", "source", "at", "least", "v")
    pair = ends.alias("x").join(ends.alias("y"), (F.col("x.lang") == F.col("y.lang")) & (F.col("x.at") != F.col("y.at"))).select(
        F.col("x.lang").alias("lang"), F.col("x.source").alias("source"), F.col("y.source").alias("item"), F.col("x.v").alias("v"),
        F.abs(F.col("x.least") - F.col("y.least")).alias("apart"), F.least("x.at", "y.at").alias("a"), F.greatest("x.at", "y.at").alias("b"))
    value = F.coalesce("part_sum", F.lit(0)) + (F.col("v") - F.coalesce("part_terms", F.lit(0))) * F.col("apart")
    pair = pair.join(sums, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return pair.withColumn("rank", F.row_number().over(ranked))


def oracle(min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    """DuckDB SQL for ``divergence`` over ``documents``."""
    share = lambda n, whole: f"CAST(1 + {ONE} * (CAST({n} AS HUGEINT) + {ADD}) // ({whole} + {ADD} * v) AS BIGINT)"
    return f"""WITH docs AS (SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
found AS (SELECT d, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM found GROUP BY ALL HAVING count(DISTINCT d) >= {min_docs}),
cells AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT l.lang, count(k.term) AS v, coalesce(sum(k.lang_n), 0) AS lang_total FROM (SELECT DISTINCT lang FROM docs) l
  LEFT JOIN kept k USING (lang) GROUP BY l.lang),
groups AS (SELECT lang, source, v, lang_total, coalesce((SELECT sum(n) FROM cells c WHERE c.lang = g.lang AND c.source = g.source), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN langs USING (lang)),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {share('coalesce(c.n, 0)', 'total')} AS p, {share('k.lang_n', 'lang_total')} AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y USING (lang, term)
  WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
lists AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM lists QUALIFY part = 'pair' OR rank <= {top}"""
