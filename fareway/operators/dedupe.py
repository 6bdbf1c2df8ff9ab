"""Keep one row, the top rows, or the rows at the maximum of a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from .ordered import sorting
from .skew import Hot, find_hot, lookup_join


def top_k(df: DataFrame, by, order, k: int, out: str | None = None) -> DataFrame:
    """The first `k` rows per key, numbered in `out` if given.

    `row_number <= k` lets Spark keep only `k` rows per key in every map task, so a hot key
    reaches the shuffle already cut down.
    """
    by = [by] if isinstance(by, str) else list(by)
    order = [order] if isinstance(order, str) else list(order)
    rank = out or "_rank"
    line = Window.partitionBy(*by).orderBy(*sorting(order))
    kept = df.withColumn(rank, F.row_number().over(line)).filter(F.col(rank) <= k)
    return kept if out else kept.drop(rank)


def keep_first(df: DataFrame, by, order) -> DataFrame:
    """The first row per key; put `-` before a column to keep the latest."""
    return top_k(df, by, order, 1)


def with_group_values(df: DataFrame, by, aggs: dict, hot: Hot | None = None) -> DataFrame:
    """Add aggregates of the key to each row; `by` columns that are NULL get NULL.

    Without hot keys this is one window over the key, which later steps by the same key share. With hot keys the
    aggregate is combined on the map side and looked up with hot keys spread, where a window would pull a whole key into one task.
    """
    by = [by] if isinstance(by, str) else list(by)
    hot = hot or find_hot(df, by)
    names = [c for c in df.columns if c not in aggs]
    if hot.keys is None:
        keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in by])
        group = Window.partitionBy(*by)
        return df.select(*names, *[F.when(keyed, e.over(group)).alias(n) for n, e in aggs.items()])
    values = df.groupBy(*by).agg(*[e.alias("_g_" + n) for n, e in aggs.items()])
    return lookup_join(df, values, by, "left", hot).select(*names, *[F.col("_g_" + n).alias(n) for n in aggs])


def keep_max(df: DataFrame, by, c: str, hot: Hot | None = None) -> DataFrame:
    """All rows that hold the largest value of `c` in their key; ties stay."""
    return with_group_values(df, by, {"_max": F.max(c)}, hot).filter(F.col(c) == F.col("_max")).drop("_max")


def minmax_score(df: DataFrame, by, c: str, out: str, invert: bool = False, hot: Hot | None = None) -> DataFrame:
    """Scale `c` to 0..1 within the key; 1 when the key has one value only. `invert` ranks small first."""
    scored = with_group_values(
        df.withColumn("_v", F.col(c).cast("double")), by, {"_low": F.min("_v"), "_high": F.max("_v")}, hot
    )
    span = F.col("_high") - F.col("_low")
    part = (F.col("_high") - F.col("_v")) if invert else (F.col("_v") - F.col("_low"))
    return scored.withColumn(out, F.when(span == 0, 1.0).otherwise(part / span)).drop("_v", "_low", "_high")
