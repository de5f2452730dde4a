"""SimHash near-duplicates with pigeonring filtering.

A text's words are its runs of bytes other than ASCII white space, after A-Z
are lower-cased; its shingles are runs of ``size`` words, joined by a space,
repeats included (fewer words: the whole sequence; none: fingerprint zero).
A fingerprint bit is 1 if it is set in over half of the shingles' XXH64.

Two fingerprints link at ``THRESHOLD`` or fewer differing bits. Candidates
share at least half of their eight segments, one key for each choice of four;
the pigeonring filter then asks for a start on the ring of segments from
which the cumulative differences of 1, 2, ... segments all stay within their
proportional share of the budget, and the last step of it is the full Hamming
check. Both conditions hold for every pair within the threshold, so no link
is lost.

Copies of a fingerprint are one row. A bucket of candidates yields a spanning
forest of its links and never all its pairs. A bucket of over ``HOT``
fingerprints is streamed out under longer keys (four of the eight half
segments left): these buckets share 48 of 64 bits, so 65,536 fingerprints
bound them.

Cases: null text is an empty text; empty texts have fingerprint zero and link
with each other; a null id keeps its fingerprint and gets the smallest
non-null id reachable (null if there is none); repeated rows and ids stay
rows; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import col, connected_components, fresh_name, id_and_text, over_batches, utf8

SEED = 42
SIZE = 4
THRESHOLD = 4
SEGMENTS = 8
#: Fingerprints of a bucket that one task holds before it deals them anew.
HOT = 4096

_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def fingerprint(text: bytes, size: int = SIZE) -> int:
    """The 64-bit fingerprint of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(size, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[s:e], SEED) for s, e in zip(starts[: len(words) - last].tolist(), ends[last:].tolist())],
                 dtype=np.uint64)
    return _majority(h)


def _majority(h: np.ndarray) -> int:
    """Bits set in over half of ``h``."""
    octets = h.astype(">u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(octets), 4096):
        ones += np.unpackbits(octets[at:at + 4096], axis=1).sum(axis=0, dtype=np.uint16)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """``(doc_id, fp)`` of every row, ``fp`` as a signed long."""
    base = id_and_text(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, size) for t in utf8(b.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return over_batches(base, run, f"doc_id {kind}, fp long")


def ring_links(x: np.ndarray, threshold: int = THRESHOLD, segments: int = SEGMENTS) -> np.ndarray:
    """Which of the differences ``x`` (exclusive ors of fingerprints) pass
    the pigeonring filter up to the whole ring, that is the Hamming check."""
    d = _POPCOUNT[x.view(np.uint8)].reshape(-1, 8)
    at = np.arange(len(x))
    total = np.zeros((len(x), segments), np.uint8)
    alive = np.ones((len(x), segments), bool)
    for length in range(1, segments + 1):
        total = total + np.roll(d, 1 - length, axis=1)
        alive &= total <= length * threshold // segments
        keep = alive.any(axis=1)
        if not keep.all():
            at, d, total, alive = at[keep], d[keep], total[keep], alive[keep]
            if not len(at):
                break
    out = np.zeros(len(x), bool)
    out[at] = True
    return out


def forest(f: np.ndarray, threshold: int = THRESHOLD) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A spanning forest of the links between different fingerprints ``f``:
    each one found is compared with those not yet reached alone."""
    left, right = [], []
    rest = f
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            c = queue.pop()
            near = ring_links(rest ^ c, threshold)
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), c, np.uint64))
                right.append(found)
                queue.extend(found)
                rest = rest[~near]
    return left, right


def _pairs(batches: Iterator[pa.RecordBatch], hot: int, threshold: int) -> Iterator[pa.RecordBatch]:
    """Buckets (rows in a row with the same choice and key) to links, or, for
    a bucket of over ``hot`` rows, to the rows themselves (``choice`` >= 0)."""
    names = ["choice", "a", "b"]

    def out(choice, a, b):
        return pa.RecordBatch.from_arrays([pa.array(choice, pa.int32()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names)

    def links(f: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        left, right = [], []
        two = starts[sizes == 2]
        if len(two):
            a, b = f[two], f[two + 1]
            near = ring_links(a ^ b, threshold)
            left.append(a[near])
            right.append(b[near])
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            x, y = forest(f[s:s + n], threshold)
            left += x
            right += y
        if left:
            a, b = np.concatenate(left), np.concatenate(right)
            if len(a):
                yield out(np.full(len(a), -1, np.int32), a, b)

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # the bucket that may go on
    held_rows, streaming = 0, False
    for batch in batches:
        c = batch.column("choice").to_numpy(zero_copy_only=False)
        k = batch.column("key").to_numpy(zero_copy_only=False)
        f = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(c):
            continue
        if held and (held[-1][0][-1], held[-1][1][-1]) == (c[0], k[0]):
            same = (c == c[0]) & (k == k[0])
            if same.all():  # the whole batch goes on with it
                if streaming:
                    yield out(c, f, k.view(np.uint64))
                else:
                    held.append((c, k, f))
                    held_rows += len(c)
                    if held_rows > hot:
                        for x in held:
                            yield out(x[0], x[2], x[1].view(np.uint64))
                        held, streaming = held[-1:], True
                continue
            if streaming:
                n = int(same.sum())
                yield out(c[:n], f[:n], k[:n].view(np.uint64))
                c, k, f, held = c[n:], k[n:], f[n:], []
        if streaming:
            held, streaming = [], False
        if held:
            c, k, f = (np.concatenate([x[i] for x in held] + [y]) for i, y in enumerate((c, k, f)))
        cut = np.flatnonzero((c[1:] != c[:-1]) | (k[1:] != k[:-1])) + 1
        starts = np.concatenate(([0], cut))
        sizes = np.diff(np.concatenate((starts, [len(c)])))
        starts_done, sizes_done = starts[:-1], sizes[:-1]
        for s, n in zip(starts_done[sizes_done > hot].tolist(), sizes_done[sizes_done > hot].tolist()):
            yield out(c[s:s + n], f[s:s + n], k[s:s + n].view(np.uint64))
        yield from links(f, starts_done[sizes_done <= hot], sizes_done[sizes_done <= hot])
        s = int(starts[-1])
        held, held_rows = [(c[s:], k[s:], f[s:])], len(c) - s
        if held_rows > hot:
            yield out(c[s:], f[s:], k[s:].view(np.uint64))
            streaming = True
    if held and not streaming:
        c, _, f = (np.concatenate([x[i] for x in held]) for i in range(3))
        if len(f) > hot:
            yield out(c, f, np.concatenate([x[1] for x in held]).view(np.uint64))
        else:
            yield from links(f, np.array([0]), np.array([len(f)]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks() -> list[int]:
    """A mask for each choice of four of the eight segments."""
    return [sum(255 << 8 * s for s in four) for four in combinations(range(SEGMENTS), SEGMENTS // 2)]


def _submasks(mask: int) -> list[int]:
    """``mask`` with four of the eight half segments that it leaves free."""
    free = [s for s in range(2 * SEGMENTS) if not mask >> 4 * s & 15]
    return [mask | sum(15 << 4 * s for s in four) for four in combinations(free, len(free) // 2)]


def links(fps: DataFrame, threshold: int = THRESHOLD, hot: int = HOT) -> DataFrame:
    """``(a, b)``: links between different fingerprints of column ``fp``,
    enough of them to connect all that are linked."""
    if not 0 <= threshold <= SEGMENTS // 2:
        raise ValueError("the keys hold for a threshold of 0 to 4")
    spark = fps.sparkSession
    masks = _masks()
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks]))
                       .alias("choice", "key"))
    found = cut_lineage(_bucketed(keyed, hot, threshold), spark, "simhash-links")
    again = found.where("choice >= 0").select(F.col("a").alias("fp"), "choice")
    sub = F.array(*[F.array(*[F.lit(_signed(m)) for m in _submasks(mask)]) for mask in masks])
    again = (again.select("fp", "choice", F.posexplode(F.element_at(sub, F.col("choice") + 1)).alias("part", "mask"))
             .select("fp", (F.col("choice") * 70 + F.col("part")).alias("choice"), F.col("fp").bitwiseAND(F.col("mask")).alias("key")))
    more = _bucketed(again, 1 << 17, threshold)
    return found.where("choice < 0").select("a", "b").union(more.select("a", "b")).distinct()


def _bucketed(keyed: DataFrame, hot: int, threshold: int) -> DataFrame:
    dealt = keyed.repartition("choice", "key").sortWithinPartitions("choice", "key")
    return over_batches(dealt, lambda batches: _pairs(batches, hot, threshold), "choice int, a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                    threshold: int = THRESHOLD, hot: int = HOT) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row of ``docs``."""
    spark = docs.sparkSession
    fps = cut_lineage(fingerprints(docs, id_col, text_col, size), spark, "simhash")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    comps = connected_components(links(classes.select("fp"), threshold, hot))
    roots = classes.join(comps, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    least = roots.groupBy("component").agg(F.min("first").alias("component_id"))
    of = roots.join(least, "component").select(F.col("fp").alias("of_fp"), "component_id")
    return fps.join(of, F.col("fp") == F.col("of_fp")).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the smallest id of each class, as they are. Rows
    that are equal in id and text count as one."""
    key = fresh_name(docs, "row_key")
    keyed = docs.withColumn(key, F.struct(col(id_col).alias("i"), F.xxhash64(F.coalesce(col(text_col), F.lit(""))).alias("h")))
    stay = near_duplicates(keyed, key, text_col).select(F.col("component_id").alias("stays")).distinct()
    return keyed.dropDuplicates([key]).join(stay, col(key) == F.col("stays"), "left_semi").drop(key)


def hex16(c) -> F.Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))
