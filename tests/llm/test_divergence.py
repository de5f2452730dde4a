"""The source divergence audit against a plain version and the SQL twin."""

import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import compare, duck  # noqa: E402

from tidemark.llm import divergence as D  # noqa: E402
from tidemark.llm import queries  # noqa: E402

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string"


def plain(rows, min_docs=30, top=50):
    groups, held = {}, {}
    for _, text, lang, source in rows:
        found = Counter(re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in TERM.findall(text or ""))
        groups.setdefault((lang or "", source or ""), Counter()).update(found)
        held.setdefault(lang or "", Counter()).update(found.keys())
    out = []
    for lang, docs in held.items():
        kept = [t for t, n in docs.items() if n >= min_docs]
        mine = {s: c for (x, s), c in groups.items() if x == lang}
        whole = Counter()
        for c in mine.values():
            whole.update(c)

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in mine.items()}, shares(whole)
        for s in mine:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in mine if o != s]
            lists = [(q[t] - p[s][t], t.encode(), t) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(lists)[:top])):
                out += [(lang, s, part, item, -v, k + 1) for k, (v, _, item) in enumerate(found)]
    return sorted(out)


def corpus(seed=1, n=120, sources=7):
    rnd = random.Random(seed)
    words = ["a", "I", "word", "eightlet", "ninechars", "sixteenletterwor", "seventeenletterwo", "ÄÖÜ", "ßé", "日本語", "x" * 40,
             "UPPER", "upper", "don't", "e-mail", "a1b2", "[x]", "z\x00y", "\u0085", " q", "longerthansixteenletters" * 3]
    rows = []
    for i in range(n):
        own = rnd.sample(words, rnd.randint(1, len(words)))
        rows.append((i, rnd.choice((" ", "\n", ", ")).join(rnd.choices(own, k=rnd.randint(0, 60))), rnd.choice(("en", "en", "de", None, "")),
                     rnd.choice([f"s{k}" for k in range(sources)] + [None])))
    return rows + [(900, None, "en", "empty"), (901, "", "xx", "one"), (902, "1 2 3", "xx", "two"), (None, "word", None, None), (3, "word", "en", "s1"),
                   (903, "very long " * 30000, "en", "s2")]


@pytest.mark.parametrize("lot,tile,chunk", [(D.LOT_BYTES, D.TILE, D.CHUNK), (2000, 3, 4)])
def test_matches_plain_version(spark, lot, tile, chunk):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = D.divergence(docs, min_docs=5, top=4, lot_bytes=lot, tile=tile, chunk=chunk)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(rows, 5, 4)


def test_radix_order_is_stable_and_whole():
    rnd = np.random.default_rng(3)
    words = [rnd.integers(0, 1 << 63, 400, dtype=np.uint64) % np.uint64(7) << np.uint64(45), rnd.integers(0, 5, 400).astype(np.uint64)]
    got = D.radix_order(words, np.arange(400))
    assert got.tolist() == sorted(range(400), key=lambda i: (int(words[0][i]), int(words[1][i]), i))


def test_sql_twin(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(queries.queries()["op13_divergence"](spark, sf), duck(sf), queries.oracle_sql()["op13_divergence"]) == []


def test_empty_table_and_extra_columns(spark):
    names = DOCS + ", term string, n int, part string, p int"
    got = D.divergence(spark.createDataFrame([], names))
    assert got.count() == 0
    rows = [(i, "Aa bb", "en", s, "t", 1, "p", 2) for i in range(30) for s in ("x", "y")]
    got = D.divergence(spark.createDataFrame(rows, names))
    assert sorted(map(tuple, got.collect())) == plain([r[:4] for r in rows])
