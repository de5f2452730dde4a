"""MinHash near-duplicates against full comparison of all pairs."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from tidemark.llm import minhash, queries  # noqa: E402

DOCS = "doc_id long, text string"


def plain(rows, size=4, percent=80):
    """(doc_id, n_shingles, component_id, kept) by looking at all pairs."""
    sets = []
    for _, text in rows:
        words = brute.WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
        sets.append({tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * len(a | sets[j]):
                group = [group[i] if g == group[j] else g for g in group]
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((d, len(sets[i]), least, d == least))
    return sorted(out, key=repr)


def family(seed=4):
    """Chains of texts, each a little further from the first, families of
    copies around the threshold, and odd texts."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(6):
        text = rnd.choices(words, k=rnd.randint(60, 160))
        for _ in range(12):
            texts.append(" ".join(text))
            for _ in range(rnd.randint(1, 3)):
                text[rnd.randrange(len(text))] = rnd.choice(words)
        base = list(text)
        for n in (1, 2, 3, 4, 5, 6, 8):
            other = list(base)
            for _ in range(n):
                other[rnd.randrange(len(other))] = "changed"
            texts.append("\t".join(other).upper())
    texts += ["", None, " \n\x0b ", "one", "ONE", "one two three", "One  two\nthree", "one two three four", "é É é É", texts[0], texts[0]]
    texts.append("the same four words " * 3000)
    texts.append("The same four words " * 2000)
    rows = [(i * 37 % 1009, t) for i, t in enumerate(texts)]
    return rows + [(None, texts[3]), (None, "quite alone here with no other one"), (5, "five one"), (5, "five two")]


@pytest.mark.parametrize("block", [1 << 18, 400])
def test_matches_all_pairs(spark, block):
    rows = family()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = sorted(map(tuple, minhash.near_duplicates(docs, block=block).collect()), key=repr)
    assert got == plain(rows)


def test_hot_group_over_many_blocks(spark):
    """One family holds most rows; its blocks meet through the buckets."""
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(rnd.choice((0, 1, 1, 2, 3, 4))):
            text[rnd.randrange(80)] = f"x{rnd.randrange(40)}"
        rows.append((1000 - i, " ".join(text)))
    rows += [(2000 + i, " ".join(rnd.choices(base, k=50))) for i in range(20)]
    got = sorted(map(tuple, minhash.near_duplicates(spark.createDataFrame(rows, DOCS), block=1500).collect()), key=repr)
    assert got == plain(rows)


def test_empty_table_and_extra_columns(spark):
    names = "node long, doc_id long, text string, digest string, grp int, text_hash string"
    rows = [(1, 5, "a b c d e f g h i j k", "x", 1, "y"), (1, 3, "a b c d e f g h i j k", "x", 1, "y"), (None, 4, None, None, None, None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, names))
    assert sorted(map(tuple, got.collect())) == [(3, 8, 3, True), (4, 0, 4, True), (5, 8, 3, False)]
    none = minhash.near_duplicates(spark.createDataFrame([], names))
    assert none.columns == got.columns and none.count() == 0


def test_circulant_signature():
    """Each coordinate is the least image under the shifted permutation, and
    agreements estimate the similarity."""
    of = minhash.shingles(" ".join(map(str, range(3000))).encode())
    x = ((of >> np.uint64(32)) ^ np.uint64(0x7FEB352D)).astype(np.uint32)
    scattered = minhash._images(x.copy())
    for k in (0, 1, 77, minhash.COORDS - 1):
        assert minhash.signature(of)[k] == minhash._images(scattered - np.uint32(k)).min()
    words = [str(i) for i in range(2000)]
    a, b = minhash.shingles(" ".join(words[:1500]).encode()), minhash.shingles(" ".join(words[150:]).encode())
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((minhash.signature(a) == minhash.signature(b)).mean() - true) < 0.12


def test_query_matches_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.queries()["op11_minhash"](spark, sf)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)
