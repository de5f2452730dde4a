"""Quality rules: base counts and an n-gram log-likelihood ratio.

Base rules are exact counts over a whole text. The model compares two
multinomials over word unigrams and bigrams: the trusted target (labelled good
and not toxic) and the raw corpus (every document). A document's score is the
sum of its n-grams' log ratios divided by their number; every document is held
against one fixed threshold.

The trusted target is a bounded sample of the labelled rows: at most
``TRUSTED`` documents, those whose ids have the least hashes. A list of ids of
that size goes to the tasks, so that no text is shuffled to meet its label.

The raw counts cover every n-gram of every document, each under a hash that
is wide enough for the corpus (``hash_bits``: 42 bits, or 14 more than its
n-grams number); they are never together in one process. A task packs its
documents into lots of about ``LOT_BYTES``, each one compressed row, and deals
them out. A lot sends the n-grams it holds, with their counts, to ranges of
hashes, as many as the session has shuffle partitions; a range adds up what
all lots sent and answers each lot with the totals of those of its n-grams
that other lots hold as well, in their order. For all others the lot's own
counts are the totals. An n-gram that is in every document so costs a range
one entry a lot.

Cases: null and empty texts have no words, zero counts and ``base_failed``; a
label that repeats counts as good only if all its rows are; labels with nulls
and labels of absent documents are no trusted rows; with no trusted document
at all the ratio is zero everywhere and only the base rules decide; repeated
rows are counted and judged one by one; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from math import ceil, log2
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, col, id_and_text, over_batches, utf8

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: Trusted documents that the target is fitted on, at most.
TRUSTED = 50_000
#: Bytes of text in a lot, about.
LOT_BYTES = 28 << 20
#: Bytes of text whose words are hashed at once.
_CHUNK = 1 << 20
#: Occurrences at the overall trusted rate that each n-gram gets besides its
#: own: a rare n-gram then says little for or against its only document.
SMOOTHING = 20.0
#: Least score (log ratio an n-gram) of a document that is kept.
THRESHOLD = -0.15

_SYMBOLS = b"#*$%&|<>"
_KIND = np.zeros(256, np.uint8)  # 0: starts a code point of a word
_KIND[[0x20, *range(0x09, 0x0E)]] = 1
_KIND[0x80:0xC0] = 2  # continuation bytes
_KIND[list(_SYMBOLS)] = 3


def word_ids(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """A number for each word, and the different words in that order."""
    seen: dict[bytes, int] = {}
    at = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    return at, list(seen)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words (a power of two) that occur
    twice or more. Windows get exact numbers by doubling their length."""
    n = len(ids)
    if n <= window:
        return 0
    width = 1
    while width < window:
        pair = ids[:-width] * np.int64(n + 1) + ids[width:]
        _, ids, count = np.unique(pair, return_inverse=True, return_counts=True)
        if len(count) == len(ids):
            return 0
        width *= 2
    twice = np.flatnonzero(count[ids] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=4)
    seen: set[bytes] = set()
    copies = 0
    for line in text.split(b"\n"):
        if line in seen:
            copies += bool(line.strip())
        else:
            seen.add(line)
    ids, _ = word_ids(words)
    return len(words), int(kinds[0] + kinds[3]), int(kinds[3]), copies, repeated_words(ids)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ h >> np.uint64(33)) * np.uint64(factor)
    return h ^ h >> np.uint64(33)


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each lower-cased word of some texts, and its text's number:
    the word's bytes by powers of an odd number, mixed with its length."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = ~_SPACE[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    first = np.cumsum(sizes) - sizes
    place = np.arange(first[-1] + sizes[-1]) - np.repeat(first, sizes)
    powers = np.multiply.accumulate(np.full(int(sizes.max()), _ODD))
    h = np.add.reduceat((_LOWER[data[inside]].astype(np.uint64) + np.uint64(1)) * powers[place], first)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return _mixed(h + sizes.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), np.searchsorted(ends, starts, "right").astype(np.int32)


def _ngram_chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """64-bit hashes of the lower-cased unigrams and bigrams of texts, and the
    number of the text that each is from, some texts at a time."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= _CHUNK):
            size += len(texts[j])
            j += 1
        h, d = _word_hashes(texts[i:j])
        two = d[1:] == d[:-1]
        pair = _mixed(h[:-1] * _ODD + (h[1:] ^ h[1:] >> np.uint64(29)) * np.uint64(0xC2B2AE3D27D4EB4F))[two]
        yield np.concatenate((_mixed(h), pair)), np.concatenate((d, d[1:][two])) + np.int32(i)
        i = j


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All of ``_ngram_chunks``."""
    hashes, of = zip(*_ngram_chunks(texts)) if texts else ((), ())
    return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([np.zeros(0, np.int32), *of])


def ngram_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of a text's lower-cased unigrams and bigrams."""
    return ngrams([text])[0]


class Counts(NamedTuple):
    """Occurrences by n-gram (sorted hashes), and all of the corpus."""

    keys: np.ndarray
    raw: np.ndarray
    good: np.ndarray
    all_raw: int
    all_good: int


def hash_bits(all_ngrams: int) -> int:
    """Bits of the hashes of a corpus with so many n-grams: one in 16,000 of
    them at most shares its hash with another, at any size."""
    return min(64, max(42, ceil(log2(all_ngrams + 1)) + 14))


class _Lot:
    """The n-grams of some texts: ``keys`` in order with their counts, and for
    each text and n-gram its ``place`` in the keys, ``text`` and ``own`` count."""

    def __init__(self, texts: list[bytes], flags: list[bool], bits: int = 64):
        self.flags = np.array(flags, bool)
        wide = max(1, len(texts) - 1).bit_length()
        if bits + wide <= 64:  # hash and text in one number; arrays go as soon as they can
            drop, up = np.uint64(64 - bits), np.uint64(wide)
            chunks = [(h >> drop) << up | of.astype(np.uint64) for h, of in _ngram_chunks(texts)]
            both = np.empty(sum(map(len, chunks)), np.uint64)
            end = len(both)
            while chunks:
                last = chunks.pop()
                both[end - len(last):end] = last
                end -= len(last)
            both.sort()
            n, pair = len(both), np.ones(len(both), bool)
            pair[1:] = both[1:] != both[:-1]
            at = np.flatnonzero(pair)
            both = both[at]
            self.own = np.diff(at, append=n).astype(np.int32)
            del at, pair
            self.text = (both & np.uint64((1 << wide) - 1)).astype(np.int32)
            both >>= up
        else:
            h, of = ngrams(texts)
            h >>= np.uint64(64 - bits)
            order = np.lexsort((of, h))
            h, of = h[order], of[order]
            pair = np.ones(len(h), bool)
            pair[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
            at = np.flatnonzero(pair)
            self.own, self.text, both = np.diff(at, append=len(h)).astype(np.int32), of[at], h[at]
        new = np.ones(len(both), bool)
        new[1:] = both[1:] != both[:-1]
        self.keys = both[new]
        del both
        self.place = np.cumsum(new, dtype=np.int32) - np.int32(1)
        first = np.flatnonzero(new)
        count = lambda x: np.add.reduceat(x, first) if len(first) else np.zeros(0, np.int64)
        self.raw, self.good = count(self.own).astype(np.int64), count(self.own * self.flags[self.text]).astype(np.int64)

    def scores(self, raw: np.ndarray, good: np.ndarray, all_raw: int, all_good: int, smoothing: float) -> np.ndarray:
        """The texts' mean log ratios by the corpus's counts of ``keys``."""
        total, n = np.zeros(len(self.flags)), np.zeros(len(self.flags))
        if not all_good:
            return total
        for i in range(0, len(self.own), 1 << 19):
            cut = slice(i, i + (1 << 19))
            at, of, own = self.place[cut], self.text[cut], self.own[cut]
            ratio = _log_ratio(own, raw[at], good[at], all_good / all_raw, self.flags[of], smoothing)
            total += np.bincount(of, own * ratio, len(total))
            n += np.bincount(of, own, len(n))
        return total / np.maximum(n, 1)


def _log_ratio(own, raw, good, rate: float, trusted, smoothing: float) -> np.ndarray:
    """Log ratios of n-grams, a text's own occurrences taken out."""
    target = np.maximum(good - own * trusted, 0) + smoothing * rate
    base = np.maximum(raw - own, 0) + smoothing
    return np.log(target / (rate * base))


def _packed(*arrays: np.ndarray) -> bytes:
    """Integers as planes of equal bytes, compressed."""
    planes = b"".join(np.ascontiguousarray(a.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays)
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, arrays: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n * arrays, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(arrays, 8, n).transpose(0, 2, 1)).view(np.uint64)[:, :, 0]


def _lot_of(table: pa.Table, id_col: str, text_col: str, trusted: pa.Array, bits: int = 64) -> _Lot:
    ids = table.column(id_col).combine_chunks()
    return _Lot([t or b"" for t in utf8(table.column(text_col).cast(pa.string()))], _flags(ids, trusted), bits)


_BLOCK = "lot long, hashes long, n long, keys_crc long, block binary, mask binary"


def _blocks(rows: list[tuple]) -> pa.Table:
    kinds = (("lot", pa.int64()), ("hashes", pa.int64()), ("n", pa.int64()), ("keys_crc", pa.int64()), ("block", pa.binary()), ("mask", pa.binary()))
    return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(kinds)})


def corpus_totals(docs: DataFrame, id_col: str, text_col: str, trusted: pa.Array) -> tuple[int, int]:
    """The n-grams of all and of the trusted documents."""
    n = F.greatest(2 * F.regexp_count(F.coalesce(col(text_col).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) - 1, F.lit(0)).cast("long")
    kind = docs.select(col(id_col)).schema[0].dataType.simpleString()
    ids = docs.sparkSession.createDataFrame([(x,) for x in trusted.to_pylist()], f"good_id {kind}")
    rows = docs.select(col(id_col).alias("own_id"), n.alias("n")).join(F.broadcast(ids), F.col("own_id") == F.col("good_id"), "left")  # TRUSTED ids at most
    raw, good = rows.agg(F.sum("n"), F.sum(F.when(F.col("good_id").isNotNull(), F.col("n")))).first()
    return raw or 0, good or 0


def packed_lots(docs: DataFrame, lot_bytes: int) -> DataFrame:
    """``lot, rows``: the rows of ``docs`` in lots, each compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, made = pa.Codec("zstd", 6), 0
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            nonlocal made
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as out:
                for x in held:
                    out.write_batch(x)
            held.clear()
            data = sink.getvalue()
            number = TaskContext.get().partitionId() << 32 | made
            made += 1
            packed = len(data).to_bytes(8, "little") + codec.compress(data, asbytes=True)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([packed], pa.binary())], ["lot", "rows"])

        size = 0
        for b in batches:
            step = max(1, b.num_rows * (lot_bytes // 4) // max(1, b.nbytes))
            for at in range(0, b.num_rows, step):  # a lot closes within a quarter of its size
                part = b.slice(at, step)
                held.append(part)
                size += part.nbytes
                if size >= lot_bytes:
                    yield close()
                    size = 0
        if held:
            yield close()

    return over_batches(docs, run, "lot long, rows binary")


def _unpacked_rows(table: pa.Table) -> pa.Table:
    data = table.column("rows")[0].as_buffer().to_pybytes()
    whole = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd")
    return pa.ipc.open_stream(whole).read_all()


def ngram_totals(lots: DataFrame, ranges: int, bits: int, id_col: str, text_col: str, trusted) -> DataFrame:
    """For each lot and each range of hashes: which of the lot's n-grams there
    other lots hold as well, and the corpus's raw and trusted counts of those,
    in the hashes' order."""

    def ask(table: pa.Table) -> pa.Table:
        own = _lot_of(_unpacked_rows(table), id_col, text_col, trusted.value, bits)
        of = ((own.keys >> np.uint64(bits - 32)) * np.uint64(ranges)) >> np.uint64(32)
        at = np.append(np.flatnonzero(np.diff(of, prepend=of[:1] + np.uint64(1))), len(of))
        number, crc = table.column("lot")[0].as_py(), zlib.crc32(own.keys)
        return _blocks([(number, int(of[i]), int(j - i), crc, _packed(np.diff(own.keys[i:j], prepend=np.uint64(0)), own.raw[i:j], own.good[i:j]), b"")
                        for i, j in zip(at, at[1:])])

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        got = [_unpacked(r["block"], r["n"], 3) for r in rows]
        keys, at = np.unique(np.concatenate([np.cumsum(g[0], dtype=np.uint64) for g in got]), return_inverse=True)
        total = np.zeros((2, len(keys)), np.uint64)
        holders = np.bincount(at, minlength=len(keys))
        ends = np.cumsum([0, *[r["n"] for r in rows]])
        for g, i, j in zip(got, ends, ends[1:]):
            total[:, at[i:j]] += g[1:]
        out = []
        for r, i, j in zip(rows, ends, ends[1:]):
            mine = at[i:j]
            shared = holders[mine] > 1
            out.append((r["lot"], r["hashes"], r["n"], r["keys_crc"], _packed(*total[:, mine[shared]]), pa.compress(np.packbits(shared).tobytes(), "zstd", asbytes=True)))
        return _blocks(out)

    return lots.groupBy("lot").applyInArrow(ask, _BLOCK).groupBy("hashes").applyInArrow(answer, _BLOCK)


def judged_lots(docs: DataFrame, id_col: str, text_col: str, trusted: pa.Array, judge: Callable[[pa.Table, np.ndarray], pa.Table],
                schema, lot_bytes: int = LOT_BYTES) -> DataFrame:
    """What ``judge`` makes of each lot's rows and their scores. Both uses of
    the packed lots have one plan, so that Spark shuffles them once."""
    spark = docs.sparkSession
    bounded_batches(spark)
    held = spark.sparkContext.broadcast(trusted)
    all_raw, all_good = corpus_totals(docs, id_col, text_col, trusted)
    bits, ranges = hash_bits(all_raw), int(spark.conf.get("spark.sql.shuffle.partitions"))
    lots = packed_lots(docs, lot_bytes)
    totals = ngram_totals(lots, ranges, bits, id_col, text_col, held)

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = _unpacked_rows(table)
        own = _lot_of(rows, id_col, text_col, held.value, bits)
        raw, good, at, crc = own.raw, own.good, 0, zlib.crc32(own.keys)
        for r in sorted(answers.to_pylist(), key=lambda r: r["hashes"]):
            mask = np.frombuffer(pa.decompress(r["mask"], decompressed_size=(r["n"] + 7) // 8, codec="zstd"), np.uint8)
            shared = at + np.flatnonzero(np.unpackbits(mask, count=r["n"]))
            raw[shared], good[shared] = _unpacked(r["block"], len(shared), 2)
            at += r["n"]
            if r["keys_crc"] != crc:
                raise ValueError("a lot was made anew from documents in another order: write the documents to a table first")
        if at != len(own.keys):
            raise ValueError(f"a lot of {len(own.keys)} n-grams was answered {at}")
        return judge(rows, own.scores(raw, good, all_raw, all_good, SMOOTHING))

    return lots.groupBy("lot").cogroup(totals.groupBy("lot")).applyInArrow(run, schema)


def _ratio(own: np.ndarray, raw: np.ndarray, good: np.ndarray, all_raw: int, all_good: int, trusted: bool, smoothing: float = SMOOTHING) -> float:
    n = own.sum()
    if not n or not all_good:
        return 0.0
    return float((own * _log_ratio(own, raw, good, all_good / all_raw, trusted, smoothing)).sum() / n)


def score(text: bytes, counts: Counts, trusted: bool = False, smoothing: float = SMOOTHING) -> float:
    """The mean log ratio of a text's n-grams. Its own n-grams are taken out
    of the counts first, so that a document says nothing about itself and a
    trusted one has no advantage."""
    keys, own = np.unique(ngram_hashes(text), return_counts=True)
    if not len(counts.keys):
        return 0.0
    at = np.minimum(np.searchsorted(counts.keys, keys), len(counts.keys) - 1)
    there = counts.keys[at] == keys
    return _ratio(own, counts.raw[at] * there, counts.good[at] * there, counts.all_raw, counts.all_good, trusted, smoothing)


def trusted_ids(labels: DataFrame, bound: int = TRUSTED) -> pa.Array:
    """At most ``bound`` ids of trusted rows, those of least hash."""
    good = (labels.select(col("doc_id").alias("label_id"), col("quality").alias("q"), col("toxic").alias("t"))
            .where("label_id IS NOT NULL").groupBy("label_id")
            .agg(F.min((F.coalesce("q", F.lit(0)) == 1) & (F.coalesce("t", F.lit(1)) == 0)).alias("good"))
            .where("good").orderBy(F.xxhash64("label_id"), "label_id").limit(bound))
    return good.select("label_id").toArrow().column(0).combine_chunks()


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def model(docs: DataFrame, trusted: pa.Array, id_col: str = "doc_id", text_col: str = "text") -> Counts:
    """The counts of ``trusted`` documents and of all of ``docs``, read into
    one process: for looking at small tables, no query uses it."""
    rows = id_and_text(docs, id_col, text_col).toArrow()
    own = _lot_of(rows, "doc_id", "text", trusted)
    return Counts(own.keys, own.raw, own.good, int(own.raw.sum()), int(own.good.sum()))


def _flags(ids: pa.Array, trusted: pa.Array) -> list[bool]:
    return pc.is_in(ids, value_set=trusted.cast(ids.type)).to_pylist()


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            threshold: float = THRESHOLD, lot_bytes: int = LOT_BYTES) -> DataFrame:
    """Id, base counts, score and verdict of every row of ``docs``."""
    base = id_and_text(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()

    def judge(rows: pa.Table, scores: np.ndarray) -> pa.Table:
        counts = np.array([base_counts(t) for t in utf8(rows.column("text"))], np.int64).reshape(-1, 5)
        return pa.table([rows.column("doc_id"), *[pa.array(counts[:, i]) for i in range(5)], pa.array(scores, pa.float64())],
                        ["doc_id", *_COUNTS, "score"])

    judged = judged_lots(base, "doc_id", "text", trusted_ids(labels), judge,
                         f"doc_id {kind}, " + ", ".join(f"{n} long" for n in _COUNTS) + ", score double", lot_bytes)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))


def base_fails(text: bytes) -> bool:
    words = text.split()
    return len(words) < MIN_WORDS or 100 * repeated_words(word_ids(words)[0]) > MAX_REPEAT_PERCENT * len(words)


def kept(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         threshold: float = THRESHOLD, lot_bytes: int = LOT_BYTES) -> DataFrame:
    """The documents that pass, as they are."""

    def judge(rows: pa.Table, scores: np.ndarray) -> pa.Table:
        texts = utf8(rows.column(text_col).cast(pa.string()))
        return rows.filter(pa.array([s >= threshold and not base_fails(t or b"") for t, s in zip(texts, scores)], pa.bool_()))

    return judged_lots(docs, id_col, text_col, trusted_ids(labels), judge, docs.schema, lot_bytes)
