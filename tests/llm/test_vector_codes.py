"""Vector codes against a plain version and the SQL twin."""

import hashlib
import math
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import compare, duck  # noqa: E402

from tidemark.llm import queries  # noqa: E402
from tidemark.llm import vector_codes as V  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """The result by comparing every part with every entry."""
    kept = [(i, [math.floor(1024 * x) for x in v], k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = len(kept[0][1]) // 4
    parts = [[v[p * width:(p + 1) * width] for p in range(4)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:256]
    books = [[list(parts[i][p]) for i in order] for p in range(4)]

    def assign():
        codes = []
        for part in parts:
            codes.append([min((sum((x - y) ** 2 for x, y in zip(part[p], e)), n) for n, e in enumerate(books[p])) for p in range(4)])
        return codes

    for _ in range(4):
        codes = assign()
        for p in range(4):
            for n in range(len(books[p])):
                mine = [parts[i][p] for i in range(len(kept)) if codes[i][p][1] == n]
                if mine:
                    books[p][n] = [sum(c) // len(mine) for c in zip(*mine)]
    codes = assign()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in c) for c in codes]
    sums = {}
    for (_, _, label), e in zip(kept, errors):
        sums[label] = sums.get(label, 0) + e
    return sorted(((i, "".join(f"{n:02x}" for _, n in c), e, sums[k], digest) for (i, _, k), c, e in zip(kept, codes, errors)), key=repr)


def vectors(n, width=8, seed=2):
    rnd = random.Random(seed)
    value = lambda: rnd.choice((-0.5, -0.0004, 0.0, 0.25, 1.0, rnd.uniform(-1, 1)))
    rows = [(i * 13 % 997, [float(np.float32(value())) for _ in range(width)], rnd.choice((1, 1, 1, 2, None))) for i in range(n)]
    rows += [(2000, None, 1), (2001, [0.5] * (width - 1) + [None], 2), (2002, [0.5] * (width - 1) + [math.nan], 2),
             (2003, [math.inf] + [0.5] * (width - 1), None), (None, rows[0][1], None), (None, [0.125] * width, 7), rows[3], rows[3]]
    return rows


@pytest.mark.parametrize("n", [5, 40, 400])
def test_matches_plain_version(spark, n):
    rows = vectors(n)
    got = V.compressed(spark.createDataFrame(rows, VECTORS).repartition(4))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


@pytest.mark.parametrize("leaves", [1, 3, 512])
def test_trie_finds_the_nearest_entries(leaves):
    rnd = np.random.default_rng(leaves)
    rows, _ = V._distinct(rnd.integers(-3, 4, (500, 5)))
    book = rnd.integers(-3, 4, (37, 5))
    far = ((rows[:, None] - book[None]) ** 2).sum(axis=2)
    code, error = V.nearest(rows, book, leaves)
    assert (code == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()


def test_sql_twin(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(queries.queries()["op12_vector_codes"](spark, sf), duck(sf), queries.oracle_sql()["op12_vector_codes"]) == []


def test_empty_and_odd_tables(spark):
    names = "vec_id long, embedding array<float>, label int, scaled string, v int, vector_label string"
    assert V.compressed(spark.createDataFrame([], names)).count() == 0
    assert V.compressed(spark.createDataFrame([(1, None, 1, "", 1, "")], names)).count() == 0
    same = [(i, [0.25] * 4, None, "x", 1, "y") for i in range(300)]
    got = V.compressed(spark.createDataFrame(same, names)).collect()
    assert {r.code for r in got} == {"00000000"} and {r.label_error for r in got} == {0}
    assert [r.error for r in V.compressed(spark.createDataFrame([(1, [], 1), (2, [], 1)], VECTORS)).collect()] == [0, 0]
    for bad in ([(1, [0.5] * 5, 1)], [(1, [0.5] * 4, 1), (2, [0.5] * 8, 1)], [(1, [1e6] * 4, 1)]):
        with pytest.raises(Exception, match="length|component"):
            V.compressed(spark.createDataFrame(bad, VECTORS)).collect()
