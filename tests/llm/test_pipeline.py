"""The pipeline's stages against plain versions over sf0.001."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline as P  # noqa: E402

from tidemark.llm import decontamination, mixing, quality  # noqa: E402

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_in_order():
    assert [f for _, f in P.STAGES] == [P.rules, P.near_duplicates, P.decontaminated, P.mixed, P.token_output]


def test_each_stage_on_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    trusted = quality.trusted_ids(labels)
    counts, good = quality.model(docs, trusted), set(trusted.to_pylist())

    kept = P.rules(spark, docs, SF)
    assert kept.columns == docs.columns

    def passes(d, t):
        n, _, _, _, repeats = brute.base_counts(t)
        return n >= 20 and 100 * repeats <= 30 * n and quality.score(t.encode(), counts, d in good) >= quality.THRESHOLD

    assert ids(kept) == sorted(d for d, r in rows.items() if passes(d, r.text))

    one = P.near_duplicates(spark, docs, SF)
    assert one.columns == docs.columns
    comps = brute.components([(d, brute.simhash(r.text)) for d, r in rows.items()])
    assert ids(one) == sorted({c for _, _, c in comps})

    clean = P.decontaminated(spark, docs, SF)
    assert clean.columns == docs.columns
    items = [decontamination.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {d for d, r in rows.items() if any(t in decontamination.normalise(r.text) for t in items)}
    assert not exact & set(ids(clean))
    small = [d for d in sorted(rows) if len(rows[d].text) < 1500][:25]
    near = {d for d in small if any(brute.within(t, decontamination.normalise(rows[d].text), int(0.1 * len(t))) for t in items)}
    assert set(small) - near == set(small) & set(ids(clean))

    mixed = P.mixed(spark, docs, SF)
    assert mixed.columns == docs.columns
    got, _, _ = mixing.mixed(docs)
    times = {r.doc_id: r.taken // r["size"] for r in got.collect() if r["size"]}
    assert ids(mixed) == sorted(d for d, n in times.items() for _ in range(n))

    out = P.token_output(spark, mixed, SF)
    assert ids(out) == ids(mixed)


def test_run_applies_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))


def test_empty_table_passes_through(spark, tmp_dir):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_dir}/{t}.parquet")
    assert P.run(spark, tmp_dir).count() == 0
