"""Cases in which an operator once did less than its whole job."""

import math
from collections import Counter

from tidemark.llm import html_text, licences, quality


def test_quality_counts_every_ngram_apart(spark):
    """Scores in several lots are those of exact n-gram counts."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    trusted = set(quality.trusted_ids(labels).to_pylist())

    def grams(text):
        words = (text or "").encode().lower().split()
        return Counter(words) + Counter(zip(words, words[1:]))

    own = {r.doc_id: grams(r.text) for r in docs.collect()}
    raw, good = Counter(), Counter()
    for d, n in own.items():
        raw.update(n)
        if d in trusted:
            good.update(n)
    rate = good.total() / raw.total()

    def score(d):
        mine, s = own[d], quality.SMOOTHING
        return sum(n * math.log((good[g] - n * (d in trusted) + s * rate) / (rate * (raw[g] - n + s))) for g, n in mine.items()) / max(1, mine.total())

    got = quality.quality(docs, labels, lot_bytes=1 << 19).collect()
    assert len(got) == len(own)
    assert max(abs(r.score - score(r.doc_id)) for r in got) < 1e-9


def test_quality_rejects_junk_at_two_sizes(spark):
    kept, clean = [], []
    for size in ("sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
        labels = spark.read.parquet(f"/root/testdata/{size}/labels.parquet")
        judged = quality.quality(docs, labels, lot_bytes=1 << 22).join(labels, "doc_id").where(f"n_words >= {quality.MIN_WORDS}").cache()
        for out, which in ((kept, "quality = 0 AND toxic = 0"), (clean, "quality = 1 AND toxic = 0")):
            out.append(judged.where(which).selectExpr(f"avg(int(score >= {quality.THRESHOLD}))").first()[0])
    assert kept[1] <= kept[0] <= 0.4 and kept[1] <= 0.1
    assert min(clean) >= 0.99


def test_quality_lots_of_equal_rows(spark):
    """Rows equal in id and text go to as many lots as their bytes need, and
    are scored alike whatever the lots."""
    text = " ".join(f"w{i % 37}" for i in range(300))
    rows = [(None, text)] * 400 + [(i, f"{text} other{i} words{i % 5}") for i in range(40)] + [(50, ""), (51, None), (52, "\u2028 a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    lots = quality.packed_lots(docs, 1 << 15)
    assert lots.count() >= 12 and lots.select("lot").distinct().count() == lots.count()
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    one, many = (sorted(map(tuple, quality.quality(docs, labels, lot_bytes=n).select("doc_id", "n_words", "score").collect()), key=repr) for n in (1 << 24, 1 << 14))
    assert len(one) == len(rows) and [r[:2] for r in one] == [r[:2] for r in many]
    assert max(abs(a[2] - b[2]) for a, b in zip(one, many)) < 1e-12
    assert len({r[2] for r in one if r[0] is None}) == 1


def test_ngrams_are_those_of_the_words():
    texts = [b"", b"One two  one", b"\x0bA\xc3\xa9 b\n", b"x" * 5000 + b" y", b" ", b"one TWO"]
    hashes, of = quality.ngrams(texts)
    found = {}
    for h, d in zip(hashes.tolist(), of.tolist()):
        found.setdefault(d, []).append(h)
    count = lambda t: max(0, 2 * len(t.split()) - 1)
    assert {d: len(x) for d, x in found.items()} == {d: count(t) for d, t in enumerate(texts) if t.split()}
    assert set(found[5]) <= set(found[1]) and len(set(found[1])) == 4 and not set(found[2]) & set(found[1])
    assert quality.ngrams(texts * 300)[0].tolist()[:3] != [] and len(quality.ngrams(texts * 300)[0]) == 300 * len(hashes)


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MIT = """The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_wrapped_licences(spark):
    headers = {"Apache-2.0": (APACHE, 3), "GPL-3.0": (GPL, 3), "MIT": (MIT, 1), "BSD-2-Clause": (BSD, 3), "BSD-3-Clause": (BSD3, 4)}
    forms = [lambda t: t, lambda t: "x = 1\n" + t + "\ny = 2\n", lambda t: t.replace("\n", "\r\n")]
    for sign in ("# ", "// ", " * ", "-- ", ";; ", "dnl "):
        forms.append(lambda t, sign=sign: "\n".join(sign + line for line in t.split("\n")))
    want, rows = {}, []
    for name, (text, n) in headers.items():
        for form in forms:
            want[len(rows)] = (name, n)
            rows.append((len(rows), form(text)))
    for text in ("Released under the. MIT License.", "Not released under the MIT License.", BSD.replace("1.", "Some other words.\n1.")):
        want[len(rows)] = ("", 3 if "words" in text else 0)
        rows.append((len(rows), text))
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.licences, r.n_sentences) for r in got} == want


def test_silent_elements_without_end_tag():
    def read(page):
        return [b.text for b in html_text.blocks(page)]

    for tag in ("button", "svg", "noscript", "object", "canvas", "template", "select", "iframe", "option", "datalist"):
        assert read(f"<body><p>one</p><{tag} class='x'><p>two</p><p>three</p></body>") == ["one", "two", "three"], tag
        assert read(f"<p>one</p><{tag}>no</{tag}><p>two</p>") == ["one", "two"], tag
    assert read("<p>one</p><button><p>two</p><button>no</button><p>three</p>") == ["one", "two", "three"]
    assert read("<html><head><meta charset=x><title>no</title><p>one</p><p>two</p>") == ["one", "two"]
    assert read("<html><head><title>no</title><style>no</style><body><p>one</p>") == ["one"]
    assert read("<html><head><title>no</title></head><p>one</p>") == ["one"]
    for tag in ("script", "style", "title", "textarea"):
        assert read(f"<p>one</p><{tag}><p>no</p>") == ["one"], tag
