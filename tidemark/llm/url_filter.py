"""URL filters: host rules, then a character language-model ratio.

Rules block or allow a host with all its subdomains under a path; the longest
that fits decides. Every other url is judged by two variable-order Markov
models over its characters, one of accepted and one of rejected urls. The
chance of a character after up to ``ORDER`` others is smoothed from one order
to the next: a context that was never seen leaves it to the shorter one. The
score is the log-likelihood difference divided by the url's length, and a url
is blocked below a threshold calibrated on the labelled urls (the score that
separates them best).

Counts cover all labelled urls: tasks add up their own, a grouped sum merges
them. N-grams are hashed to ``BUCKETS`` for each order, so the models that
the tasks get have a size fixed by a parameter.

Cases: a null url, or one without ``://``, has empty host and path, no rule,
and is scored as the text it is; an empty url scores 0; without labelled urls
of both kinds every score is 0; the threshold is at most 0 and then 0, so a
score of 0 is allowed; repeated urls count as often as they stand; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, over_batches, utf8

ORDER = 4
BUCKETS = 1 << 16
#: Weight of the next shorter context, in characters.
BACKOFF = 4.0
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Words in a host that mark a url as rejected when the models are fitted.
REJECTED_TERMS = ("adult", "ads-", "bets", "casino", "pills", "spam")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def rule_of(host: F.Column, path: F.Column, rules=RULES) -> tuple[F.Column, F.Column]:
    """The longest rule that fits (like ``net/``) and what it says."""
    name, says = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, says = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(says)
    return name, says


def buckets_of(url: bytes, order: int = ORDER, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """For each order and character: the buckets of its context and of the
    context with the character. Urls start and end with a mark."""
    x = np.concatenate((np.full(order, 2, np.uint64), np.frombuffer(url, np.uint8).astype(np.uint64), [np.uint64(3)]))
    n = len(url) + 1
    context, gram = np.empty((order + 1, n), np.int64), np.empty((order + 1, n), np.int64)
    for o in range(order + 1):
        h = np.full(n, 0x9E3779B97F4A7C15 + o, np.uint64)
        for k in range(o, 0, -1):
            h = (h ^ x[order - k:order - k + n]) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
        context[o] = (h >> np.uint64(20)) % np.uint64(buckets)
        h = (h ^ x[order:] ^ np.uint64(0x1234567)) * np.uint64(0xC2B2AE3D27D4EB4F)
        gram[o] = (h >> np.uint64(24)) % np.uint64(buckets)
    return context, gram


def counts(urls: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """``(cell, n)`` over all rows of ``urls(url, rejected)``. A cell is a
    class, whether context or n-gram, an order and a bucket."""
    rows = order + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, 2, rows * buckets), np.int64)
        shift = (np.arange(rows) * buckets)[:, None]
        for b in batches:
            for url, rejected in zip(utf8(b.column("url")), b.column("rejected").to_pylist()):
                for kind, at in enumerate(buckets_of(url, order, buckets)):
                    np.add.at(n[int(rejected), kind], (at + shift).reshape(-1), 1)
        flat = n.reshape(-1)
        have = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(flat[have])], ["cell", "n"])

    return over_batches(urls.select("url", "rejected"), run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def fitted(urls: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """The counts as an array [class, context or n-gram, order, bucket]; its
    size is fixed by the parameters."""
    got = counts(urls, order, buckets).toArrow()
    out = np.zeros(4 * (order + 1) * buckets, np.float32)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(2, 2, order + 1, buckets)


def score(url: bytes, model: np.ndarray, backoff: float = BACKOFF) -> float:
    """Log-likelihood of accepted less that of rejected, per character."""
    order = model.shape[2] - 1
    if not url or not model[0, 0, 0].any() or not model[1, 0, 0].any():
        return 0.0
    context, gram = buckets_of(url, order, model.shape[3])
    total = []
    for cls in model:
        p = np.full(len(url) + 1, 1 / 256)
        for o in range(order + 1):
            p = (np.minimum(cls[1, o, gram[o]], cls[0, o, context[o]]) + backoff * p) / (cls[0, o, context[o]] + backoff)
        total.append(np.log(p).sum())
    return float(total[0] - total[1]) / (len(url) + 1)


def scored(urls: DataFrame, model: np.ndarray) -> DataFrame:
    """``urls`` (all columns; ``url`` without nulls) and ``score``."""
    held = urls.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = pa.array([score(u, held.value) for u in utf8(b.column("url"))], pa.float64())
            yield b.append_column("score", s)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema.fields)
    return over_batches(urls, run, schema + ", score double")


def threshold(labelled: DataFrame, step: float = 0.01) -> float:
    """The score, in steps and not above 0, that separates ``rejected`` rows
    of ``labelled`` from the others best (the mean of both rates)."""
    cells = (labelled.groupBy(F.least(F.floor(F.col("score") / step), F.lit(0)).alias("cell"))
             .agg(F.sum((~F.col("rejected")).cast("long")).alias("good"), F.sum(F.col("rejected").cast("long")).alias("bad"))
             .orderBy("cell").collect())  # scores lie within the log of 256 and the model's smoothing
    good, bad = sum(c["good"] for c in cells), sum(c["bad"] for c in cells)
    if not good or not bad:
        return 0.0
    best, at, lost, caught = 0.5, 0.0, 0, 0
    for c in cells:
        if c["cell"] < 0:
            lost, caught = lost + c["good"], caught + c["bad"]
            value = (1 - lost / good + caught / bad) / 2
            if value > best:
                best, at = value, (c["cell"] + 1) * step
    return at


def filtered(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
             rejected_terms=REJECTED_TERMS) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row."""
    raw = col(url_col).cast("string")
    host, path = host_and_path(raw)
    base = pages.select(col(id_col).alias("page_id"), F.coalesce(raw, F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    name, says = rule_of(F.col("host"), F.col("path"), rules)
    term = F.lit(False)
    for t in rejected_terms:
        term = term | F.contains(F.col("host"), F.lit(t))
    base = base.select("*", name.alias("rule"), says.alias("says"), term.alias("rejected"))
    labelled = base.where("host <> '' AND (rejected OR says IS NULL OR says = 'allow')").select("url", "rejected")
    model = fitted(labelled)
    at = threshold(scored(labelled, model))
    verdict = F.coalesce("says", F.when(F.col("score") < at, F.lit("block")).otherwise(F.lit("allow")))
    return scored(base, model).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
