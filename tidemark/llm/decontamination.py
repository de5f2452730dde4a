"""Benchmark decontamination by pigeonhole pieces and Myers' distance.

Texts are compared lower-cased and with every run of white space as one
space. An item of ``n`` characters occurs in a document if some stretch of
the document is within ``int(rate * n)`` edits (insert, delete, replace) of
it. The item is split into budget + 1 pieces: at least one of them stands in
that stretch unchanged, so an automaton over all pieces finds every
candidate. A hit is then verified upwards: the piece's half, quarter, ... of
the item, each with as many edits as it has pieces less one (some branch from
the whole item down to an unchanged piece always holds these), by Myers'
bit-parallel distance. The last step is the whole item with its whole budget.

The benchmark is a stated query set: blocks of about ``BLOCK_BYTES`` of items
go to the tasks one after the other, however large it is.

Cases: null and empty texts hold no item; null or blank items are never
found; repeated items are each found; an item id may be null; empty tables
give no hit; other columns of the documents, whatever their names, stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, col, fresh_name

RATE = 0.1
BLOCK_BYTES = 8 << 20

_SPACE = re.compile(r"\s+")


def normalise(text: str) -> str:
    return _SPACE.sub(" ", text.lower()).strip()


def distance_within(pattern: str, peq: dict[str, int], text: str, budget: int) -> bool:
    """Whether some stretch of ``text`` is within ``budget`` edits of
    ``pattern`` (Myers 1999; Python's integers are the bit vectors)."""
    m = len(pattern)
    mask, top = (1 << m) - 1, 1 << m - 1
    pv, mv, score, get = mask, 0, m, peq.get
    for c in text:
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score <= budget:
                return True
        ph = ph << 1 & mask
        pv = mh << 1 & mask | ~(xv | ph) & mask
        mv = ph & xv
    return score <= budget


class Item:
    """A normalised item, its pieces and the nodes above each piece."""

    def __init__(self, text: str, rate: float):
        self.text, self.budget = text, int(rate * len(text))
        n = self.budget + 1
        self.cuts = [len(text) * i // n for i in range(n + 1)]
        self.up: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # from the smallest to the whole
        self._halve(0, n)
        self.peqs: dict[tuple[int, int], tuple[str, dict[str, int]]] = {}

    def _halve(self, a: int, b: int) -> None:
        if b - a > 1:
            self._halve(a, (a + b) // 2)
            self._halve((a + b) // 2, b)
            for i in range(a, b):
                self.up[i].append((a, b))

    def pieces(self) -> list[str]:
        return [self.text[s:e] for s, e in zip(self.cuts, self.cuts[1:])]

    def holds(self, piece: int, at: int, text: str) -> bool:
        """Whether the item occurs in ``text`` around its ``piece`` at ``at``."""
        for node in self.up[piece]:
            a, b = node
            got = self.peqs.get(node)
            if got is None:
                part = self.text[self.cuts[a]:self.cuts[b]]
                peq: dict[str, int] = {}
                for i, c in enumerate(part):
                    peq[c] = peq.get(c, 0) | 1 << i
                got = self.peqs[node] = (part, peq)
            start, budget = at - (self.cuts[piece] - self.cuts[a]), b - a - 1
            if not distance_within(*got, text[max(0, start - budget):start + len(got[0]) + budget], budget):
                return False
        return True


class Finder:
    """Finds the items of a block in texts."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE):
        self.ids, self.items = [], []
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, raw in items:
            text = normalise(raw or "")
            if text:
                item = Item(text, rate)
                for i, piece in enumerate(item.pieces()):
                    places.setdefault(piece, []).append((len(self.items), i))
                self.ids.append(item_id)
                self.items.append(item)
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def __call__(self, raw: str) -> list[int | None]:
        if not self.items:
            return []
        text, found, failed = normalise(raw), set(), set()
        for end, (size, where) in self.automaton.iter(text):
            for i, piece in where:
                start = end - size + 1
                origin = (i, piece, start)
                if i not in found and origin not in failed:
                    if self.items[i].holds(piece, start, text):
                        found.add(i)
                    else:
                        failed.add(origin)
        return [self.ids[i] for i in sorted(found)]


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> Iterator[list]:
    """The benchmark's items in blocks of about ``block_bytes``."""
    items = benchmark.select(col(id_col).cast("long").alias("item"), col(text_col).cast("string").alias("body")).where("body IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n = -(-size // block_bytes)
    for k in range(n):
        yield items.where(F.pmod(F.xxhash64("item", "body"), F.lit(n)) == k).orderBy("item", "body").collect()


def with_hits(docs: DataFrame, benchmark: DataFrame, hits: str, text_col: str = "text", rate: float = RATE,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` and a column ``hits``: the ids of the items that occur."""
    if hits in docs.columns:
        raise ValueError(f"there is a column {hits} already")
    out = docs.withColumn(hits, F.array().cast("array<long>"))
    bounded_batches(docs.sparkSession)
    for block in blocks(benchmark, block_bytes=block_bytes):
        items = docs.sparkSession.sparkContext.broadcast([(r["item"], r["body"]) for r in block])

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            find = Finder(items.value, rate)
            for b in batches:
                at = b.schema.get_field_index(hits)
                got = [before + find(t or "") for before, t in zip(b.column(at).to_pylist(), b.column(text_col).to_pylist())]
                yield b.set_column(at, b.schema.field(at), pa.array(got, b.schema.field(at).type))

        out = out.mapInArrow(run, out.schema)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", rate: float = RATE) -> DataFrame:
    """The documents in which no item occurs, as they are."""
    hits = fresh_name(docs, "benchmark_hits")
    return with_hits(docs, benchmark, hits, text_col, rate).where(F.size(col(hits)) == 0).drop(hits)
