"""MinHash near-duplicates by circulant permutations.

A text's words are its runs of bytes other than ASCII white space, after A-Z
are lower-cased; its set holds the distinct shingles of ``size`` words (fewer
words: the whole sequence as one; none: empty). Two sets link if 100 times
their common shingles are at least ``percent`` times their union.

A set's signature has ``COORDS`` coordinates from two permutations of the
32-bit numbers: the first scatters the shingles once, the second, shifted
circularly by ``k``, gives coordinate ``k`` as the least image. ``BANDS`` keys
of ``ROWS`` coordinates each name the buckets; a pair at the threshold misses
all of them with a chance of 5e-8 (``(1 - 0.8 ** 4) ** 32``).

Equal sets are one node. A node's group is named after the least node that it
shares a bucket with. Links are confirmed on full sets, made from the texts of
the nodes that share a bucket:

1. A group is dealt into blocks of about ``BLOCK`` shingles. A block yields a
   spanning forest of its links: an inverted index of its sets counts what one
   set has in common with all others at once, and sets of the largest class
   need no comparison among themselves.
2. The node that names a group of several blocks visits them all, which joins
   what belongs together.
3. In a bucket whose nodes are not yet of one class, those outside its largest
   class visit each other block that holds a node of it. Then every two nodes
   of a bucket have been compared, unless they are of one class already.

Neither emits the pairs of a group, and no group is held by one task whole.

Cases: null text is an empty text; empty texts have an empty set, link with
nothing and are their own component; a null id keeps its row and gets the
smallest non-null id reachable (null if there is none; it is kept if it has
none); repeated rows and ids stay rows, those of equal ids that link with
nothing else share the id as component; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import connected_components, id_and_text, over_batches, spread_join, utf8

SIZE = 4
PERCENT = 80
BANDS = 32
ROWS = 4
COORDS = BANDS * ROWS
#: Shingles of a block, about.
BLOCK = 1 << 18
_SEED = 11
#: Shingles whose images are made at once.
_STEP = 1024


def _mixed(h: np.ndarray) -> np.ndarray:
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ h >> np.uint64(33)) * np.uint64(factor)
    return h ^ h >> np.uint64(33)


def shingles(text: bytes, size: int = SIZE) -> np.ndarray:
    """The distinct 64-bit hashes, in order, of a text's shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    seen: dict[bytes, int] = {}
    at = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    h = np.fromiter((xxhash.xxh64_intdigest(w, _SEED) for w in seen), np.uint64, len(seen))[at]
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = _mixed((out ^ h[k:k + n]) + np.uint64(0x9E3779B97F4A7C15))
    return np.unique(out)


def _images(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


_SHIFTS = np.arange(COORDS, dtype=np.uint32)[:, None]


def signature(of: np.ndarray) -> np.ndarray:
    """The coordinates of a set of shingle hashes."""
    scattered = _images(((of >> np.uint64(32)) ^ np.uint64(0x7FEB352D)).astype(np.uint32))
    least = np.full(COORDS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(scattered), _STEP):
        np.minimum(least, _images(scattered[None, i:i + _STEP] - _SHIFTS).min(axis=1), out=least)
    return least


def band_keys(of: np.ndarray) -> np.ndarray:
    """The bucket key of each band, the band's number mixed in."""
    rows = signature(of).reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        h = _mixed((h ^ rows[:, k]) + np.uint64(0x9E3779B97F4A7C15))
    return h.view(np.int64)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """``doc_id, text_hash, digest, n, bands`` of every row; an empty set has
    a null digest. ``text_hash`` finds the row's text again."""
    base = id_and_text(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t, size) for t in utf8(b.column("text"))]
            digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
            bands = [band_keys(x) if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(digests, pa.binary()),
                 pa.array([len(x) for x in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "digest", "n", "bands"])

    return over_batches(base, run, f"doc_id {kind}, text_hash long, digest binary, n long, bands array<long>")


class _Sets:
    """Some sets with an inverted index: what one has in common with all."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        whole = np.concatenate([np.zeros(0, np.uint64), *sets])
        order = np.argsort(whole, kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        ranked = whole[order]
        first = np.ones(len(ranked), bool)
        first[1:] = ranked[1:] != ranked[:-1]
        self.starts = np.flatnonzero(first)
        self.keys = ranked[self.starts]
        self.stops = np.append(self.starts[1:], len(ranked))
        self.percent = percent

    def linked(self, of: np.ndarray) -> np.ndarray:
        """The sets that link with ``of``."""
        if not len(self.keys):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, of), len(self.keys) - 1)
        at = at[self.keys[at] == of]
        sizes = self.stops[at] - self.starts[at]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - (ends - sizes), sizes)
        common = np.bincount(self.owner[places], minlength=len(self.sizes))
        return np.flatnonzero((100 + self.percent) * common >= self.percent * (self.sizes + len(of)))


def forest(nodes: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links between ``nodes`` that connect all that are linked."""
    n = len(nodes)
    if n == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        linked = (100 + percent) * common >= percent * (len(sets[0]) + len(sets[1]))
        return [(int(nodes[0]), int(nodes[1]))] if linked else []
    index = _Sets(sets, percent)
    group, compared, main, out = np.arange(n), np.zeros(n, bool), -1, []
    while True:  # until all that were never compared are of the largest class
        rest = np.flatnonzero(~compared & (group != main))
        if not len(rest):
            return out
        i = int(rest[0])
        compared[i] = True
        for j in index.linked(sets[i]).tolist():
            if group[j] != group[i]:
                out.append((int(nodes[i]), int(nodes[j])))
                group[group == group[j]] = group[i]
        main = np.bincount(group).argmax()


def _blocks_of(batches: Iterator[pa.RecordBatch], size: int, percent: int, visiting: bool) -> Iterator[pa.RecordBatch]:
    """Links in rows that come by group and block: of the block's members
    among each other, or (``visiting``) of those that visit it, which come
    last, with members of other classes."""
    key, nodes, sets, classes, index = None, [], [], [], None
    found: list[tuple[int, int]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if found:
            a, b = zip(*found)
            found.clear()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        texts = utf8(batch.column("text"))
        others = [batch.column(c).to_pylist() for c in ("grp", "block", "role", "node", "cls", "digest")]
        for text, grp, block, role, node, cls, digest in zip(texts, *others):
            if (grp, block) != key:
                if not visiting:
                    found += forest(np.array(nodes, np.int64), sets, percent)
                key, nodes, sets, classes, index = (grp, block), [], [], [], None
            if not role and nodes and nodes[-1] == node:
                continue  # the same row again
            own = shingles(text, size)
            if hashlib.blake2b(own.tobytes(), digest_size=16).digest() != digest:
                continue  # another text of the same hash
            if not role:
                nodes.append(node)
                sets.append(own)
                classes.append(cls)
                continue
            if index is None:
                index, classes = _Sets(sets, percent), np.array(classes, np.int64)
            near = index.linked(own)
            _, first = np.unique(classes[near], return_index=True)  # a link to each class is enough
            found += [(node, nodes[j]) for j in near[first].tolist() if classes[j] != cls]
        yield from flush()
    if not visiting:
        found += forest(np.array(nodes, np.int64), sets, percent)
    yield from flush()


_ROW = ["grp", "block", "role", "node", "cls", "digest", "text"]


def _links(rows: DataFrame, size: int, percent: int, visiting: bool) -> DataFrame:
    dealt = rows.select(*_ROW).repartition("grp", "block").sortWithinPartitions("grp", "block", "role", "node")
    return over_batches(dealt, lambda batches: _blocks_of(batches, size, percent, visiting), "a long, b long")


def _classes(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """``nodes`` with the class ``cls`` that ``edges`` give to column ``node``."""
    comps = connected_components(edges).select(F.col("node").alias("of"), "component")
    return nodes.join(comps, F.col(node) == F.col("of"), "left").withColumn("cls", F.coalesce("component", node)).drop("of", "component")


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """``(key, node, least)`` of the buckets that several nodes share."""
    buckets = nodes.select("node", F.explode("bands").alias("key"))
    low = buckets.groupBy("key").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    return buckets.join(low, "key").select("key", "node", "least")


def classes(docs: DataFrame, nodes: DataFrame, size: int = SIZE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``(node, cls)`` of the nodes that share a bucket: the class that their
    links give. ``docs`` holds the texts as ``doc_id, text, text_hash``."""
    spark = docs.sparkSession
    shared = cut_lineage(shared_buckets(nodes), spark, "minhash-buckets")
    groups = shared.groupBy(F.col("node").alias("who")).agg(F.min("least").alias("grp"))
    members = nodes.select("node", "n", "digest", "text_hash", "doc_id").join(groups, F.col("node") == F.col("who")).drop("who")
    large = members.groupBy(F.col("grp").alias("of")).agg(F.sum("n").alias("n")).where(F.col("n") > block).select(
        "of", F.expr(f"CAST((n - 1) div {block} AS INT) + 1").alias("blocks"))
    members = members.join(large, F.col("grp") == F.col("of"), "left").drop("of")
    members = members.withColumn("block", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("node"), F.col("blocks"))).cast("int"))
    members = cut_lineage(members, spark, "minhash-members")

    row = members.select("grp", "block", "blocks", F.lit(0).alias("role"), "node", F.col("node").alias("cls"), "digest",
                         F.col("text_hash").alias("h"), F.col("doc_id").alias("i"))
    held = docs.join(row, (F.col("text_hash") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("i"))).select("blocks", *_ROW)
    held = cut_lineage(held, spark, "minhash-texts")
    found = _links(held, size, percent, False)

    def visited(visits: DataFrame, known: DataFrame) -> DataFrame:
        """Links of ``visits`` (``who, to_grp, to_block``) among ``known``
        texts with their classes."""
        guests = known.join(visits, F.col("node") == F.col("who")).select(
            F.col("to_grp").alias("grp"), F.col("to_block").alias("block"), F.lit(1).alias("role"), "node", "cls", "digest", "text")
        there = visits.select(F.col("to_grp").alias("grp"), F.col("to_block").alias("block")).distinct()
        return _links(known.join(there, ["grp", "block"], "left_semi").select(*_ROW).unionByName(guests), size, percent, True)

    large = members.where("blocks IS NOT NULL").select("grp", "blocks").distinct().join(members.select("node", F.col("block").alias("own")), F.col("grp") == F.col("node"))
    everywhere = large.select(F.col("grp").alias("who"), F.col("grp").alias("to_grp"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to_block"))
    found = cut_lineage(found.union(visited(everywhere, held.drop("blocks"))), spark, "minhash-links")
    by_class = cut_lineage(_classes(members.select("node", "grp", "block"), found), spark, "minhash-classes")

    placed = shared.select("key", F.col("node").alias("who")).join(by_class, F.col("who") == F.col("node"))
    counts = placed.groupBy("key", "cls").agg(F.count(F.lit(1)).alias("c"))
    mixed = counts.groupBy(F.col("key").alias("of_key")).agg(F.max(F.struct("c", "cls")).alias("m"), F.count(F.lit(1)).alias("c")).where("c > 1")
    in_mixed = placed.join(mixed.select("of_key", F.col("m.cls").alias("main")), F.col("key") == F.col("of_key"))
    blocks = in_mixed.select(F.col("key").alias("to_key"), F.col("grp").alias("to_grp"), F.col("block").alias("to_block")).distinct()
    others = in_mixed.where("cls <> main").select("key", "who", "grp", "block")
    visits = others.join(blocks, F.col("key") == F.col("to_key")).where("grp <> to_grp OR block <> to_block").select("who", "to_grp", "to_block").distinct()
    visits = cut_lineage(visits, spark, "minhash-visits")
    if visits.isEmpty():
        return by_class.select("node", "cls")
    known = held.drop("cls", "blocks").join(by_class.select(F.col("node").alias("of"), "cls"), F.col("node") == F.col("of"))
    more = visited(visits, known)
    cls_of = lambda end: by_class.select(F.col("node").alias(end), F.col("cls").alias(f"{end}_cls"))
    more = more.join(cls_of("a"), "a").join(cls_of("b"), "b").select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b")).where("a <> b").distinct()
    more = cut_lineage(more, spark, "minhash-links")
    if more.isEmpty():
        return by_class.select("node", "cls")
    return _classes(by_class.select("node", F.col("cls").alias("first")), more, "first").select("node", "cls")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT,
                    block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``."""
    spark = docs.sparkSession
    rows = cut_lineage(signatures(docs, id_col, text_col, size), spark, "minhash")
    first = F.min(F.struct("text_hash", "doc_id"))  # one row of each set stands for it
    nodes = rows.where("digest IS NOT NULL").groupBy("digest").agg(
        first.alias("row"), F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("bands").alias("bands"),
        F.count(F.lit(1)).alias("copies"))
    nodes = nodes.select(F.monotonically_increasing_id().alias("node"), "digest", "row.text_hash", "row.doc_id", "least_id", "n", "bands", "copies")
    nodes = cut_lineage(nodes, spark, "minhash-nodes")

    texts = id_and_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    linked = classes(texts, nodes, size, percent, block).select(F.col("node").alias("linked_node"), "cls")
    of = nodes.select("node", "digest", "least_id", "copies").join(linked, F.col("node") == F.col("linked_node"), "left")
    of = of.withColumn("cls", F.coalesce("cls", "node"))
    least = of.groupBy("cls").agg(F.min("least_id").alias("component_id"))
    of = cut_lineage(of.join(least, "cls").select("digest", "component_id", "copies"), spark, "minhash-components")
    shown = rows.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    got = spread_join(shown.where("digest IS NOT NULL"), of, "digest", "copies").select("doc_id", "n_shingles", "component_id")
    alone = shown.where("digest IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return got.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
