"""Aggregations, ordering and set operators (AGG-1..9, ORD-1..3, SET-1..2).

Skew rule: any key may hold a third of all rows. Every operator here is a
hash/sort aggregation with a map-side partial step, so a hot key is reduced
inside each map task before the shuffle. "One row per key" in particular is
a ``min_by`` over the row keyed by a sort-key struct, never a window that
would sort a whole hot key inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")

Order = Sequence[str | tuple[str, str]]


def _norm_order(order: Order) -> list[tuple[str, str]]:
    out = []
    for item in order:
        if isinstance(item, str):
            out.append((item, "asc"))
        else:
            name, direction = item
            if direction not in ("asc", "desc"):
                raise ValueError(f"direction must be asc or desc: {direction}")
            out.append((name, direction))
    return out


def _desc_key(c: Column, dtype: str) -> Column:
    if dtype in _NUMERIC or dtype.startswith("decimal"):
        return -c
    if dtype == "date":
        return -F.unix_date(c)
    if dtype.startswith("timestamp"):
        return -F.unix_micros(c.cast("timestamp"))
    if dtype == "boolean":
        return ~c
    if dtype in ("string", "binary") or dtype.startswith(("char", "varchar")):
        # byte order reversed: each hex digit by its complement, then an end
        # mark above all digits, so that a text stands before its own prefix
        digits = F.translate(F.hex(c.cast("binary")), "0123456789ABCDEF", "FEDCBA9876543210")
        return F.concat(digits, F.lit("G"))
    raise TypeError(f"cannot order {dtype} descending inside a mixed key")


def sort_key(df: DataFrame, order: Order) -> Column:
    """One struct that compares like ``ORDER BY order`` (asc nulls first,
    desc nulls last), usable inside ``min``."""
    types = dict(df.dtypes)
    parts = []
    for i, (name, direction) in enumerate(_norm_order(order)):
        c = F.col(f"`{name}`")
        if direction == "asc":
            parts.append(c.alias(f"k{i}"))
        else:
            parts.append(c.isNull().alias(f"n{i}"))
            parts.append(_desc_key(c, types[name]).alias(f"k{i}"))
    return F.struct(*parts)


def _orderable(dtype: str) -> bool:
    return not dtype.startswith("map<") and "map<" not in dtype


def one_per_key(df: DataFrame, keys: Sequence[str], order: Order | None = None) -> DataFrame:
    """AGG-6 / ORD-2: the first row per key under a total ``order``.

    ``order`` defaults to all non-key columns ascending, which makes the pick
    deterministic where the source kept an arbitrary duplicate. Ties left by
    an explicit ``order`` are broken by the remaining (orderable) columns.

    Plan: a partial ``min_by(row, sort_key)`` in every map task, one shuffle
    of at most (tasks x keys) rows, a final ``min_by``. No window. The row
    itself may hold any type (maps included); only the key is compared."""
    keys = list(keys)
    types = dict(df.dtypes)
    rest = [c for c in df.columns if c not in keys]
    order = _norm_order(order or [])
    tie = [(c, "asc") for c in rest if c not in {n for n, _ in order} and _orderable(types[c])]
    k = sort_key(df, order + tie)
    payload = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(0)
    picked = df.groupBy(*keys).agg(F.min_by(payload, k).alias("_v"))
    return picked.select(*keys, *[F.col("_v").getField(c).alias(c) for c in rest]).select(*df.columns)


def group_count(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """AGG-1: rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def non_null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """AGG-1 (column form): non-null values per column, one row."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """AGG-2."""
    return df.select(column).distinct()


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG-3."""
    return df.select(*columns).distinct()


def ordered_concat(df: DataFrame, keys: Sequence[str], order: str, text: str | Column,
                   sep: str = "; ", name: str = "code_and_values") -> DataFrame:
    """AGG-4: join the texts of each group in ``order`` with ``sep``.

    The list is built with a map-side partial ``collect_list`` and sorted once
    per group; null texts are skipped. The output row holds the whole
    concatenation by definition, so the group size is the output size."""
    t = text if isinstance(text, Column) else F.col(text)
    pairs = F.collect_list(F.when(t.isNotNull(), F.struct(F.col(order).alias("o"), t.alias("t"))))
    return df.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(pairs), lambda x: x["t"]), sep).alias(name))


def all_match(df: DataFrame, keys: Sequence[str], predicate: Column, name: str = "all_match") -> DataFrame:
    """AGG-5: true when the predicate holds for every row of the group; a null
    predicate counts as false (plain ``every`` would skip it)."""
    return df.groupBy(*keys).agg(F.every(F.coalesce(predicate, F.lit(False))).alias(name))


def group_median(df: DataFrame, keys: Sequence[str], column: str, name: str = "median",
                 accuracy: int | None = None) -> DataFrame:
    """AGG-7: exact median (mean of the two middle values for even counts).

    This form keeps a value-to-count map per group (partial per map task). For
    groups of more values than one task should hold, :func:`selected_median`
    is exact with bounded state; with ``accuracy`` the median comes from
    ``percentile_approx`` sketches of fixed size. Threshold decisions ("median above t") are exact and O(1) per group with
    :func:`median_exceeds`."""
    if accuracy:
        return df.groupBy(*keys).agg(F.percentile_approx(column, 0.5, accuracy).alias(name))
    return df.groupBy(*keys).agg(F.median(column).alias(name))


#: Steps of the sketched histogram that narrows a bracket.
_STEPS = 64


def selected_median(df: DataFrame, keys: Sequence[str], column: str, name: str = "median", limit: int = 100_000) -> DataFrame:
    """AGG-7 for hot groups: the exact median as :func:`group_median` gives
    it, without a map of a group's values.

    Groups of up to ``limit`` values go the plain way. For each other group a
    bracket of values that holds the middle ranks is narrowed: a pass counts
    the values below, at the ends of and inside a candidate bracket and
    sketches its inside as a histogram of ``_STEPS`` steps of equal counts;
    the counts, not the sketch, decide whether the candidate holds the ranks.
    A pass leaves at most a few steps inside, so two or three passes bring
    10^11 values below ``limit`` whatever their distribution; many equal
    values end in a bracket without an inside. The last pass counts the
    different values of the bracket. All state is fixed counts and sketches a
    map task; the driver sees whether a group is still too large."""
    spark, keys = df.sparkSession, list(keys)
    rows = df.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{column}`").cast("double").alias("_v"))
    groups = rows.groupBy(*keys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    groups = cut_lineage(groups, spark, "median-groups")
    hot = groups.where(F.col("_n") > limit)
    if hot.isEmpty():
        return group_median(df, keys, column, name)

    def of(state: DataFrame) -> DataFrame:
        """The rows of the groups of ``state`` inside their known brackets."""
        named = state.toDF(*[f"_k{keys.index(c)}" if c in keys else c for c in state.columns])
        same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.lit(True))
        got = rows.where(F.col("_v").isNotNull()).join(named, same)
        return got.where((F.col("_v") >= F.col("_from")) & (F.col("_v") <= F.col("_to"))).drop(*[f"_k{i}" for i in range(len(keys))])

    state = hot.select(*keys, F.expr("(_n - 1) div 2").alias("_r1"), F.expr("_n div 2").alias("_r2"), "_lo", "_hi",
                       F.col("_lo").alias("_from"), F.col("_hi").alias("_to"), F.lit(0).cast("long").alias("_below"), F.lit(1).alias("_margin"))
    done = None
    while True:
        v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
        inside = (v > lo) & (v < hi)
        carried = ["_r1", "_r2", "_lo", "_hi", "_from", "_to", "_below", "_margin"]
        seen = of(state).groupBy(*keys).agg(
            *[F.first(c).alias(c) for c in carried], F.count(F.when(v < lo, 1)).alias("_lt"), F.count(F.when(v == lo, 1)).alias("_at_lo"),
            F.count(F.when(inside, 1)).alias("_mid"), F.count(F.when((v == hi) & (lo < hi), 1)).alias("_at_hi"),
            F.percentile_approx(F.when(inside, v), [i / _STEPS for i in range(_STEPS + 1)], 20 * _STEPS).alias("_steps"))
        start = F.col("_below") + F.col("_lt")
        holds = (start <= F.col("_r1")) & (F.col("_r2") < start + F.col("_at_lo") + F.col("_mid") + F.col("_at_hi"))
        step = lambda r: (F.col(r) - start - F.col("_at_lo")) * _STEPS / F.greatest("_mid", F.lit(1))
        i1 = (F.floor(step("_r1")) - F.col("_margin")).cast("int")
        i2 = (F.ceil(step("_r2")) + F.col("_margin")).cast("int")
        low = F.when(i1 < 0, lo).when(i1 >= _STEPS, F.element_at("_steps", -1)).otherwise(F.get(F.col("_steps"), i1))
        high = F.when(F.col("_r2") < start + F.col("_at_lo"), lo).when(i2 > _STEPS, hi).otherwise(F.get(F.col("_steps"), F.greatest(i2, F.lit(0))))
        keep = lambda new, old: F.when(holds, new).otherwise(F.col(old))
        after = seen.select(
            *keys, "_r1", "_r2", keep(low, "_from").alias("_lo"), keep(high, "_to").alias("_hi"), keep(lo, "_from").alias("_from"),
            keep(hi, "_to").alias("_to"), keep(start, "_below").alias("_below"), (F.col("_margin") * F.when(holds, 1).otherwise(2)).alias("_margin"),
            (holds & (F.col("_mid") <= limit)).alias("_done"))
        after = cut_lineage(after, spark, "median-bracket")
        found = after.where("_done").drop("_done")
        done = found if done is None else done.union(found)
        state = after.where("NOT _done").drop("_done")
        if state.isEmpty():
            break
    values = of(done).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"), *[F.first(c).alias(c) for c in ("_r1", "_r2", "_below")])
    order = Window.partitionBy(*keys).orderBy("_v")  # the different values of a bracket: limit and two at most
    values = values.withColumn("_end", F.col("_below") + F.sum("_c").over(order))
    pick = lambda r: F.min(F.when(F.col("_end") > F.col(r), F.col("_v")))
    large = values.groupBy(*keys).agg((pick("_r1") * 0.5 + pick("_r2") * 0.5).alias(name))
    if not keys:
        return large
    named = hot.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.lit(True))
    return group_median(df.join(named, same, "left_anti"), keys, column, name).union(large)


def median_exceeds(df: DataFrame, keys: Sequence[str], column: str, threshold: float,
                   name: str = "median_exceeds") -> DataFrame:
    """Per group: is the exact median of ``column`` (nulls ignored; mean of
    the two middle values for an even count) above ``threshold``?

    Answered from four algebraic aggregates (count, count above, largest
    value at or below, smallest value above), so every map task combines its
    part and a hot group costs O(1) memory; no group's values are gathered.
    Empty groups give false."""
    c = F.col(column)
    agg = df.groupBy(*keys).agg(
        F.count(c).alias("_n"), F.count(F.when(c > threshold, c)).alias("_above"),
        F.max(F.when(c <= threshold, c)).alias("_lo"), F.min(F.when(c > threshold, c)).alias("_hi"))
    n, above = F.col("_n"), F.col("_above")
    odd = (n % 2) == 1
    even_tie = (above * 2 == n) & ((F.col("_lo") + F.col("_hi")) / 2 > threshold)
    result = F.when(n == 0, F.lit(False)).when(odd, above * 2 > n).otherwise((above * 2 > n) | even_tie)
    return agg.select(*keys, F.coalesce(result, F.lit(False)).alias(name))


def most_common(df: DataFrame, group: Sequence[str], value: str,
                name: str | None = None, count_name: str = "n") -> DataFrame:
    """AGG-8: the most frequent value per group; ties go to the smallest
    value. Counting first bounds every later group by its distinct values."""
    group = list(group)
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias(count_name))
    best = one_per_key(counts, group, [(count_name, "desc"), (value, "asc")])
    return best.withColumnRenamed(value, name) if name else best


def weighted_rollup(df: DataFrame, key: Column, weight: str, name: str = "total",
                    key_name: str = "key") -> DataFrame:
    """AGG-9: sum of weights per derived key (for example a standard name)."""
    return df.groupBy(key.alias(key_name)).agg(F.sum(weight).alias(name))


def newest_first(df: DataFrame, column: str) -> DataFrame:
    """ORD-1: order by ``column`` descending, nulls last."""
    return df.orderBy(F.col(column).desc_nulls_last())


def union_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """SET-1: union by column name; missing columns null; duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct_on(dfs: Sequence[DataFrame], column: str) -> DataFrame:
    """SET-2: union of several listings, one row per ``column`` value (a file
    matched by two patterns is listed once)."""
    return one_per_key(union_by_name(dfs), [column])
