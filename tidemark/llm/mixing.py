"""Mixing sources to target weights by a min-cost flow.

A document may belong to several sources. Documents are added up by their
membership pattern (the set of their sources); a flow routes each pattern's
words to the quotas of its sources. A pattern offers its words once for every
repetition it may serve, each further time at a higher cost, so that nothing
is repeated while unused words could serve the quota (convex costs: the
repetitions fill in order). What a quota still lacks when no capacity is left
goes unserved.

The flow falls apart into groups of sources that patterns connect. A source
that shares no document with another is its own group: its flow is its quota,
a column of the table of sources. Each other group is solved by one task. All
tables of patterns, sources and runs stay with Spark; the driver sees one row
of sums for each step of the resharing.

A pattern that serves one source is taken in a seeded order, whole documents
as long as they fit, then in further passes (``ROUNDS`` in all) those that fit
what is still lacking, and in the end the smallest one left if that comes
nearer; if it needs more than half of the words, what stays behind is found so.
Only the part of the order in which a pass ends is sorted. Documents of a pattern
that serves several sources are cut into the runs of words that the flow
assigned: a document counts to the run that its middle falls in.

Targets: sources in code point order, null last, weigh ``WEIGHTS`` in turn
and share ``SHARE`` of all words; a target stops at ``REPEATS`` times its
source's words and the excess is shared anew by weight until none is above.

Cases: null or empty texts have size zero and are taken zero times; a null
source is a source of its own; a source without words has target zero; ids
may be null or repeat (the seeded order then goes by the text's hash as well,
and rows equal in both are alike); an empty table gives an empty result;
extra columns stay as they are in ``mix`` and are not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from decimal import Decimal
from fractions import Fraction
from functools import reduce
from heapq import heappop, heappush
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import bounded_batches, col, connected_components, fresh_name, numbered

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
REPEATS = 2
SEED = 42
#: Passes that fill what a source still lacks.
ROUNDS = 3


def targets(sizes: dict, weights=WEIGHTS, share: Fraction = SHARE, repeats: int = REPEATS) -> dict:
    """Target words of each source, as exact fractions."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    limit = {s: Fraction(repeats * sizes[s]) for s in order}
    out: dict = {}
    rest, free = share * sum(sizes.values()), list(order)
    while free:
        unit = rest / sum(weight[s] for s in free)
        full = [s for s in free if weight[s] * unit > limit[s]]
        for s in full:
            out[s] = limit[s]
            rest -= limit[s]
        if not full:
            out.update({s: weight[s] * unit for s in free})
        free = [s for s in free if s not in out]
    return out


def route(patterns: list[tuple[tuple, int]], quotas: dict, repeats: int = REPEATS) -> dict[tuple[int, object], int]:
    """Min-cost flow: words of pattern ``i`` that go to source ``s``.

    Successive shortest paths with potentials. The k-th repetition of a
    pattern costs k - 1 a word. A path's cost is the repetition it opens; a
    path may take words back from one source and give them to another.
    """
    used = [0] * len(patterns)
    flow: dict[tuple[int, object], int] = {}
    lack = dict(quotas)
    by_source: dict = {}
    for i, (members, _) in enumerate(patterns):
        for s in members:
            by_source.setdefault(s, []).append(i)
    for level in range(1, repeats + 1):  # all words at a lower cost first: costs are equal within a level
        for s in lack:
            while lack[s] > 0:
                path = _path(s, patterns, by_source, used, flow, level)
                if path is None:
                    break
                amount = min([lack[s], level * patterns[path[-1][0]][1] - used[path[-1][0]]]
                             + [flow[i, t] for (i, _), (_, t) in zip(path, path[1:])])
                for i, t in path:
                    flow[i, t] = flow.get((i, t), 0) + amount
                for (i, _), (_, t) in zip(path, path[1:]):
                    flow[i, t] -= amount
                used[path[-1][0]] += amount
                lack[s] -= amount
    return {k: v for k, v in flow.items() if v}


def _path(source, patterns, by_source, used, flow, level) -> list | None:
    """The shortest way from ``source`` to a pattern with words left at this
    level: (pattern, source it then serves) pairs."""
    heap, seen, n = [(0, 0, source, ())], {source}, 0
    while heap:
        length, _, s, way = heappop(heap)
        for i in by_source.get(s, ()):
            if used[i] < level * patterns[i][1]:
                return [*way, (i, s)]
        for i in by_source.get(s, ()):
            for t in patterns[i][0]:
                if t not in seen and flow.get((i, t), 0) > 0:
                    seen.add(t)
                    n += 1
                    heappush(heap, (length + 1, n, t, (*way, (i, s))))
    return None


def sized(docs: DataFrame, sources: F.Column, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
          order_col: str | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``members`` (array of sources) and the seeded
    order ``rank`` (by ``order_col``, else the id, and the text) of every row."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    return docs.select(
        col(id_col).alias("doc_id"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        sources.alias("members"), F.xxhash64(F.lit(seed), col(order_col or id_col), text).alias("rank"))


class Collected(Mapping):
    """A column of the table of sources by source, read when it is asked for:
    for looking at small tables, no query uses it."""

    def __init__(self, table: DataFrame, value: str):
        self._table, self._value, self._rows = table, value, None

    def _held(self) -> dict:
        if self._rows is None:
            self._rows = {r[0]: r[1] for r in self._table.select("of", self._value).collect()}
        return self._rows

    def __getitem__(self, key):
        return self._held()[key]

    def __iter__(self) -> Iterator:
        return iter(self._held())

    def __len__(self) -> int:
        return len(self._held())


def source_targets(patterns: DataFrame, weights=WEIGHTS, share: Fraction = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``of, words, target, quota`` of every source. The words a unit of
    weight gets rise with every step, as sources reach their limits; a step is
    one sum over the sources, on exact numbers."""
    spark = patterns.sparkSession
    sums = patterns.select(F.explode("members").alias("of"), "words").groupBy("of").agg(F.sum("words").alias("words"))
    at = numbered(sums, "place", F.asc_nulls_last("of"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights)).cast("int") + 1)
    table = cut_lineage(at.select("of", "words", weight.alias("weight"), (F.col("words") * repeats).alias("most")), spark, "mix-sources")
    sum_of = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    whole, of_weight = (int(x or 0) for x in table.agg(sum_of("words"), sum_of("weight")).first())
    unit, before = Fraction(0), None
    over = F.lit(False)
    while unit != before:
        full, gone = (int(x or 0) for x in table.where(over).agg(sum_of("most"), sum_of("weight")).first())
        before = unit
        if gone < of_weight:
            unit = (share * whole - full) / (of_weight - gone)
        big = lambda n: F.lit(Decimal(n)).cast("decimal(38,0)")
        over = F.col("weight") * big(unit.numerator) > F.col("most") * big(unit.denominator)

    def by_weight(value, kind: str) -> F.Column:
        out = F.lit(None).cast(kind)
        for w in sorted(set(weights)):
            out = F.when(F.col("weight") == w, F.lit(value(w * unit)).cast(kind)).otherwise(out)
        return out

    return table.select("of", "words", F.when(over, F.col("most").cast("double")).otherwise(by_weight(float, "double")).alias("target"),
                        F.when(over, F.col("most")).otherwise(by_weight(round, "long")).alias("quota"))


_RUN = "members array<string>, of string, words long"


def planned(docs: DataFrame, weights=WEIGHTS, share: Fraction = SHARE, repeats: int = REPEATS) -> tuple[DataFrame, DataFrame]:
    """The runs ``members, of, words`` of the flow, and the table of sources
    (``of, words, target, quota``), from ``sized`` documents."""
    spark = docs.sparkSession
    patterns = cut_lineage(docs.groupBy("members").agg(F.sum("size").alias("words")), spark, "mix-patterns")
    sources = cut_lineage(source_targets(patterns, weights, share, repeats), spark, "mix-targets")
    several = patterns.where(F.size("members") > 1)
    alone = patterns.where(F.size("members") == 1).withColumn("one", F.col("members")[0])
    served = sources.select(F.col("of").alias("one_of"), "quota")
    own = F.col("one").eqNullSafe(F.col("one_of"))
    if several.isEmpty():
        flow = alone.join(served, own).select("members", F.col("one").alias("of"), F.least("quota", F.col("words") * repeats).alias("words"))
        return flow.where("words > 0"), sources
    bounded_batches(spark)
    name = lambda c: F.when(c.isNull(), "n").otherwise(F.concat(F.lit("s"), c))
    ends = several.select(F.explode("members").alias("b"), F.col("members")[0].alias("a")).select(name(F.col("a")).alias("a"), name(F.col("b")).alias("b"))
    groups = connected_components(ends.distinct()).select(F.col("node"), F.col("component").alias("grp"))
    linked = patterns.where(F.size("members") > 0).withColumn("node", name(F.col("members")[0])).join(groups, "node").select("grp", "members", "words")
    quotas = sources.withColumn("node", name(F.col("of"))).join(groups, "node").select(F.col("grp").alias("of_grp"), "of", "quota")

    def solve(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        key = lambda s: (s is None, s or "")
        found = sorted(((tuple(m), int(w)) for m, w in zip(rows["members"], rows["words"])), key=lambda x: [key(s) for s in x[0]])
        lack = {s: int(q) for s, q in sorted(zip(wanted["of"], wanted["quota"]), key=lambda x: key(x[0]))}
        return pd.DataFrame([(list(found[i][0]), s, n) for (i, s), n in route(found, lack, repeats).items()], columns=["members", "of", "words"])

    flow = linked.groupBy("grp").cogroup(quotas.groupBy("of_grp")).applyInPandas(solve, _RUN)
    rest = alone.withColumn("node", name(F.col("one"))).join(groups, "node", "left_anti").join(served, own).select(
        "members", F.col("one").alias("of"), F.least("quota", F.col("words") * repeats).alias("words"))
    return cut_lineage(flow.union(rest).where("words > 0"), spark, "mix-runs"), sources


def plan(docs: DataFrame, weights=WEIGHTS, share: Fraction = SHARE, repeats: int = REPEATS) -> tuple[list, Mapping, Mapping]:
    """``planned`` as a list of runs and maps of sizes and targets, read into
    the driver: for looking at small tables."""
    runs, sources = planned(docs, weights, share, repeats)
    rows = [(list(r["members"]), r["of"], r["words"]) for r in runs.collect()]
    rows.sort(key=lambda r: ([(s is None, s or "") for s in r[0]], r[1] is None, r[1] or ""))
    return rows, Collected(sources, "words"), Collected(sources, "target")


def mix(docs: DataFrame, runs, repeats: int = REPEATS, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` (from ``sized``) with ``served`` (the sources it goes to, and
    how often) and ``taken`` (size times their sum). ``runs`` is the table of
    ``planned``, or its rows."""
    spark = docs.sparkSession
    if not isinstance(runs, DataFrame):
        runs = spark.createDataFrame(runs, _RUN)
    number = fresh_name(docs, "row_no")
    rows = cut_lineage(docs.withColumn(number, F.monotonically_increasing_id()), spark, "mix-rows")
    wholes = rows.groupBy("members").agg(F.sum("size").alias("whole"), F.count(F.lit(1)).alias("n"))
    start = Window.partitionBy("members").orderBy(F.asc_nulls_last("of")).rowsBetween(Window.unboundedPreceding, -1)
    laid = runs.withColumn("run_from", F.coalesce(F.sum("words").over(start), F.lit(0)))
    lists = laid.groupBy("members").agg(  # a run for each of the pattern's sources at most
        F.sort_array(F.collect_list(F.struct("run_from", (F.col("run_from") + F.col("words")).alias("run_to"), "of"))).alias("runs"))
    lists = cut_lineage(lists.join(wholes.withColumnRenamed("members", "m2"), F.col("members").eqNullSafe(F.col("m2"))).select(
        F.col("members").alias("run_members"), "runs", "whole", (F.size("runs") == 1).alias("single")), spark, "mix-lists")

    parts = isqrt(rows.count()) + 1
    key = F.pmod(F.shiftright("rank", 8), F.lit(parts)).cast("int")
    light = rows.select(F.col(number).alias("row_no"), "members", "size", "rank", "doc_id", key.alias("part")).where("size > 0")
    goal = F.col("runs")[0]["run_to"]
    copies = F.least(F.expr("CAST(runs[0].run_to div greatest(whole, 1) AS LONG)"), F.lit(repeats))
    extra = F.when(copies < repeats, goal - copies * F.col("whole")).otherwise(0)
    leaves = 2 * extra > F.col("whole")  # more than half goes once more: it is told by what stays behind
    lacking = lists.where("single").select("run_members", F.when(leaves, F.col("whole") - extra).otherwise(extra).alias("lack"))
    told = _filled(light, lacking.where("lack > 0"), rounds).select(F.col("row_no").alias("more_no")).withColumn("told", F.lit(True))
    more = (F.coalesce("told", F.lit(False)) != leaves).cast("int")

    pieces = None
    if not lists.where("NOT single").isEmpty():
        pieces = _cut(light.join(lists.where("NOT single").select("run_members"), F.col("members").eqNullSafe(F.col("run_members")), "left_semi"))
        pieces = pieces.select(F.col("row_no").alias("cut_no"), "start")
    out = rows.join(lists, F.col("members").eqNullSafe(F.col("run_members")), "left")
    out = out.join(told, F.col(number) == F.col("more_no"), "left")
    out = out.join(pieces, F.col(number) == F.col("cut_no"), "left") if pieces else out.withColumn("start", F.lit(None).cast("long"))
    middle = [2 * (F.col("start") + k * F.col("whole")) + F.col("size") for k in range(repeats)]

    def times(run):
        inside = sum(((m >= 2 * run["run_from"]) & (m < 2 * run["run_to"])).cast("int") for m in middle)
        return F.when(F.col("single"), (copies + more).cast("int")).otherwise(F.coalesce(inside, F.lit(0)))

    none = F.array().cast("array<struct<of:string,times:int>>")
    served = F.when((F.col("size") > 0) & F.col("runs").isNotNull(), F.filter(F.transform(
        "runs", lambda r: F.struct(r["of"].alias("of"), times(r).alias("times"))), lambda x: x["times"] > 0)).otherwise(none)
    out = out.withColumn("served", served).withColumn("taken", F.col("size") * F.aggregate(
        "served", F.lit(0).cast("long"), lambda a, x: a + x["times"]))
    return out.select(*docs.columns, "served", "taken")


def _bases(rows: DataFrame) -> DataFrame:
    """Words of each part of a pattern, and of all parts before it."""
    sums = rows.groupBy("members", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("members").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(F.col("members").alias("m2"), F.col("part").alias("p2"), "words", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows``, each with ``inside``: the words before it in its part."""
    order = Window.partitionBy("members", "part").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("inside", F.coalesce(F.sum("size").over(order), F.lit(0)))


def _cut(rows: DataFrame) -> DataFrame:
    """``rows`` with ``start``, the words before them in their pattern."""
    at = (F.col("members").eqNullSafe(F.col("m2"))) & (F.col("part") == F.col("p2"))
    return _placed(rows).join(_bases(rows), at).withColumn("start", F.col("base") + F.col("inside"))


def _filled(rows: DataFrame, lacking: DataFrame, rounds: int) -> DataFrame:
    """``row_no`` of the rows that fill what patterns lack (``run_members,
    lack``) by whole documents, each at most once."""
    spark, passes = rows.sparkSession, []
    at = (F.col("members").eqNullSafe(F.col("m2"))) & (F.col("part") == F.col("p2"))

    def still() -> DataFrame:
        """What is lacking after the passes so far."""
        if not passes:
            return lacking
        got = reduce(DataFrame.union, passes).groupBy(F.col("members").alias("of_members")).agg(F.sum("size").alias("got"))
        return lacking.join(got, F.col("run_members").eqNullSafe(F.col("of_members")), "left").select(
            "run_members", (F.col("lack") - F.coalesce("got", F.lit(0))).alias("lack")).where("lack > 0")

    def left() -> DataFrame:
        """The rows of patterns that lack words, without those found."""
        here = rows.join(still(), F.col("members").eqNullSafe(F.col("run_members"))).drop("run_members")
        return here.join(reduce(DataFrame.union, passes).select("row_no"), "row_no", "left_anti") if passes else here

    for _ in range(rounds):
        here = left().where("size <= lack")
        placed = here.join(_bases(here), at).where("base < lack")
        inner = placed.where("base + words <= lack")  # all of the part fits
        edge = _placed(placed.where("base + words > lack")).where("base + inside + size <= lack")
        columns = ["row_no", "members", "size"]
        passes.append(cut_lineage(inner.select(*columns).union(edge.select(*columns)), spark, "mix-fill"))
    last = left().groupBy("members").agg(F.min(F.struct("size", "rank", "doc_id", "row_no")).alias("m"), F.first("lack").alias("lack"))
    return reduce(DataFrame.union, passes).select("row_no").union(last.where("m.size < 2 * lack").select("m.row_no"))


def mixed(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
          seed: int = SEED, order_col: str | None = None) -> tuple[DataFrame, Mapping, Mapping]:
    """The mix of documents of one source each, with its sources' sizes and
    targets (read when asked for)."""
    got, sources = mixed_with(docs, source_col, id_col, text_col, seed, order_col)
    return got, Collected(sources, "words"), Collected(sources, "target")


def mixed_with(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
               seed: int = SEED, order_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix of documents of one source each, and the table of sources. The
    sized rows are staged: the plan and the mix both read them."""
    rows = cut_lineage(sized(docs, F.array(col(source_col).cast("string")), id_col, text_col, seed, order_col), docs.sparkSession, "mixing")
    runs, sources = planned(rows)
    return mix(rows, runs), sources


def repeated(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
             seed: int = SEED) -> DataFrame:
    """The mix as documents: every row as often as the mix takes it."""
    key = fresh_name(docs, "row_key")
    keyed = docs.withColumn(key, F.struct(col(id_col).alias("i"), F.xxhash64(*map(col, docs.columns)).alias("h")))
    got, _, _ = mixed(keyed, source_col, key, text_col, seed, id_col)
    times = (got.where("size > 0").groupBy(F.col("doc_id").alias("of"))
             .agg(F.sum(F.expr("taken div size")).cast("int").alias("times")).where("times > 0"))
    once = keyed.dropDuplicates([key]).join(times, col(key) == F.col("of"))
    return once.withColumn(key, F.explode(F.sequence(F.lit(1), F.col("times")))).select(*map(col, docs.columns))
