"""Aggregates that combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import col, safe_ratio
from ..session import cut_lineage
from .dedupe import top_k
from .ordered import Running, Split, running
from .skew import find_hot, lookup_join

LIST_VALUES = 999  # values that one joined text may hold; one more is the largest rank that Spark cuts in the map tasks by default


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def count_distinct_if(c, cond: Column) -> Column:
    return F.countDistinct(F.when(cond, col(c)))


def avg_if(c, cond: Column) -> Column:
    """Mean over the rows that meet the condition; NULL if there is none."""
    return F.avg(F.when(cond, col(c).cast("double")))


def share(cond: Column) -> Column:
    """Share of rows that meet the condition; a NULL condition counts as not met."""
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def rate(num: Column, den: Column, scale: float = 1.0, digits: int | None = None) -> Column:
    """Guarded ratio of two aggregates."""
    out = safe_ratio(num, den, scale)
    return out if digits is None else F.round(out, digits)


def any_flag(cond: Column) -> Column:
    return F.max(F.when(cond, 1).otherwise(0))


def sum_flag(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def distinct_sums(df: DataFrame, keys, id_col: str, flags: dict[str, Column]) -> DataFrame:
    """Per key, the number of distinct ids with at least one row that meets each condition.

    One pass: rows are reduced to one per key and id, then summed; both steps combine on the map
    side, and the rows are not multiplied as several COUNT(DISTINCT) would.
    """
    per_id = df.filter(F.col(id_col).isNotNull()).groupBy(*keys, id_col).agg(
        *[any_flag(c).alias(n) for n, c in flags.items()]
    )
    return per_id.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in flags])


def listagg(df: DataFrame, keys, c: str, out: str, sep: str = ", ", limit: int = LIST_VALUES) -> DataFrame:
    """Values per key joined in sorted order, NULLs left out; a key with more than `limit` values raises.

    Up to the default limit, all but the first `limit + 1` rows of a key go in the map tasks, so a long group is refused without meeting in one
    task. A larger limit sorts the rows of a key in one task, on disk if need be, and still gathers no more than `limit + 1` of them.
    """
    some = top_k(df, keys, c, limit + 1)  # NULLs come last
    too_many = F.raise_error(F.lit(f"listagg: a key has more than {limit} values"))
    joined = F.concat_ws(sep, F.array_sort(F.collect_list(c)))
    return some.groupBy(*([keys] if isinstance(keys, str) else keys)).agg(F.when(F.count(c) > limit, too_many).otherwise(joined).alias(out))


def histogram_of_counts(df: DataFrame, key: str, counted: Column, value_out: str, keys_out: str) -> DataFrame:
    """How many keys have each count."""
    per_key = df.groupBy(key).agg(counted.alias(value_out))
    return per_key.groupBy(value_out).agg(F.count(key).alias(keys_out))


def exact_percentile(df: DataFrame, by: str, value: str, p: float, out: str, split: Split = Split()) -> DataFrame:
    """Interpolated percentile per key, exact, without holding a key's values in one task.

    Equal values are counted first, in the only pass over `df`, and the counts are written once; totals and hot keys come from them. A
    running count over the sorted values then marks the one or two values that surround the wanted position. NULL values and NULL keys are left out.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    counts = cut_lineage(counts)
    hot = find_hot(counts, by, split.min_rows)  # a key is as heavy as it has different values
    placed = running(counts, by, [value], Running(sums={"_upto": F.col("_n")}), split=split, hot=hot)
    totals = counts.groupBy(by).agg(F.sum("_n").alias("_all"))
    near = lookup_join(placed, totals, by, "inner", hot, spread=[by, value])
    at = F.lit(p) * (F.col("_all") - 1)
    holds = lambda pos: (F.col("_upto") - F.col("_n") <= pos) & (pos < F.col("_upto"))
    ends = near.withColumn("_at", at).groupBy(by).agg(
        F.max("_at").alias("_at"),
        F.max(F.when(holds(F.floor("_at")), F.col(value))).alias("_lo"),
        F.max(F.when(holds(F.ceil("_at")), F.col(value))).alias("_hi"),
    )
    frac = F.col("_at") - F.floor("_at")
    return ends.select(by, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * frac).alias(out))
