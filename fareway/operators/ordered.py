"""Running values along an ordered key, exact also when one key holds most of the rows.

Ordinary keys are one window partition each. The rows of hot keys are range-partitioned by key and order and written once; each
partition is a chunk and a window partition of its own, and the values that cross a chunk border are carried by a
table with one row per hot key and chunk. The cut follows the rows, not the values, so it holds for any sortable type, any
direction, NULLs and equal times; rows of equal order are cut by a hash of the row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import cut_lineage
from .skew import Hot, find_hot, mark_hot, same_key, task_rows

CHUNK = "_chunk"
TIE = "_tie_break"


@dataclass(frozen=True)
class Split:
    """When a key is hot, and how many rows a chunk of one has; None takes the session's values."""

    min_rows: int | None = None
    chunk_rows: int | None = None


@dataclass(frozen=True)
class Running:
    """Values to compute along the order; each maps an output name to an expression.

    sums   running total up to and with this row (whole numbers)
    mins   running minimum up to and with this row
    lags   value of the previous row          leads  value of the next row
    fills  last value so far that is not NULL, this row included
    """

    sums: dict[str, Column] = field(default_factory=dict)
    mins: dict[str, Column] = field(default_factory=dict)
    lags: dict[str, Column] = field(default_factory=dict)
    leads: dict[str, Column] = field(default_factory=dict)
    fills: dict[str, Column] = field(default_factory=dict)

    def names(self) -> list[str]:
        return [*self.sums, *self.mins, *self.lags, *self.leads, *self.fills]


def chunked(df: DataFrame, by, order, descending: bool, hot: Hot, split: Split = Split()) -> DataFrame:
    """The rows of hot keys with `_chunk`, which rises along the order within a key, and a tie break; written once, so both stay the same."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    hashed = [c for c, kind in kinds.items() if not isinstance(kind, (T.MapType, T.VariantType))]
    rows = mark_hot(df, by, hot).filter(F.col("_hot").isNotNull()).drop("_hot").withColumn(TIE, F.xxhash64(*hashed))
    parts = max(1, -(-hot.total // (split.chunk_rows or task_rows(df.sparkSession))))
    dealt = rows.repartitionByRange(parts, *[F.col(k).asc() for k in by], *sorting([*order, TIE], descending))
    return cut_lineage(dealt.withColumn(CHUNK, F.spark_partition_id()))


def ordinary(df: DataFrame, by, hot: Hot) -> DataFrame:
    """The rows of all other keys."""
    return df if hot.keys is None else mark_hot(df, by, hot).filter(F.col("_hot").isNull()).drop("_hot")


def sorting(order, descending: bool = False):
    """Sort columns for names with an optional leading `-`; NULL is the largest value."""
    flip = lambda c: c.startswith("-") != descending
    return [
        F.col(c.lstrip("-")).desc_nulls_first() if flip(c) else F.col(c.lstrip("-")).asc_nulls_last()
        for c in order
    ]


def running(
    df: DataFrame, by, order, values: Running, descending: bool = False, split: Split = Split(),
    hot: Hot | None = None,
) -> DataFrame:
    """Add the running values of `df` along `order` within `by`.

    `order` lists column names, each with an optional leading `-` for descending; NULL sorts as
    the largest value. The order should end in a unique column, otherwise ties are arbitrary. An output that
    has the name of a column replaces it. `hot` are the hot keys, if they are known already.
    """
    by = [by] if isinstance(by, str) else list(by)
    order = [order] if isinstance(order, str) else list(order)
    hot = hot or find_hot(df, by, split.min_rows)
    names = df.columns + [n for n in values.names() if n not in df.columns]
    plain = _finish(ordinary(df, by, hot).withColumns(_over(values, by, order, descending)), values, names)
    if hot.keys is None:
        return plain

    fine = [*order, TIE]
    rows = Window.partitionBy(*by, CHUNK).orderBy(*sorting(fine, descending))
    parts = chunked(df, by, order, descending, hot, split).withColumn("_rn", F.row_number().over(rows))
    edges = _edges(parts, by, values)
    local = parts.withColumns(_over(values, [*by, CHUNK], fine, descending))
    joined = local.join(edges, same_key(local, edges, by, "_k_") & (local[CHUNK] == edges["_k_chunk"]), "left")
    final = {}
    for n in values.sums:
        both = F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col("_c_" + n), F.lit(0))
        final[n] = F.when(F.col(n).isNotNull() | F.col("_c_" + n).isNotNull(), both)
    for n in values.mins:
        final[n] = F.least(F.col(n), F.col("_c_" + n))
    for n in [*values.lags, *values.leads, *values.fills]:
        final[n] = F.coalesce(F.col(n), F.col("_c_" + n))
    return plain.unionByName(_finish(joined.withColumns(final), values, names))


def _box(e: Column) -> Column:
    return F.struct(e.alias("v"))


def _over(values: Running, keys, order, descending: bool) -> dict[str, Column]:
    """The values within one window partition; lags and leads are boxed, so that a NULL value differs from no row."""
    rows = Window.partitionBy(*keys).orderBy(*sorting(order, descending))
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {n: F.sum(e).over(so_far) for n, e in values.sums.items()}
    out |= {n: F.min(e).over(so_far) for n, e in values.mins.items()}
    out |= {n: F.lag(_box(e)).over(rows) for n, e in values.lags.items()}
    out |= {n: F.lead(_box(e)).over(rows) for n, e in values.leads.items()}
    return out | {n: F.last(e, ignorenulls=True).over(so_far) for n, e in values.fills.items()}


def _finish(df: DataFrame, values: Running, names) -> DataFrame:
    boxed = {*values.lags, *values.leads}
    return df.select(*[F.col(n)["v"].alias(n) if n in boxed else F.col(n) for n in names])


def _edges(parts: DataFrame, by, values: Running) -> DataFrame:
    """Per hot key and chunk, what the neighbouring chunks hand over; `_rn` numbers the rows of a chunk."""
    aggs = [F.sum(e).alias("_s_" + n) for n, e in values.sums.items()]
    aggs += [F.min(e).alias("_s_" + n) for n, e in values.mins.items()]
    aggs += [F.max_by(_box(e), "_rn").alias("_s_" + n) for n, e in values.lags.items()]
    aggs += [F.min_by(_box(e), "_rn").alias("_s_" + n) for n, e in values.leads.items()]
    aggs += [F.max_by(e, F.when(e.isNotNull(), F.col("_rn"))).alias("_s_" + n) for n, e in values.fills.items()]
    chunks = parts.groupBy(*by, CHUNK).agg(*aggs)
    # one row per chunk of a hot key
    line = Window.partitionBy(*by).orderBy(CHUNK)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    over = {n: F.sum("_s_" + n).over(before) for n in values.sums}
    over |= {n: F.min("_s_" + n).over(before) for n in values.mins}
    over |= {n: F.lag("_s_" + n).over(line) for n in values.lags}
    over |= {n: F.lead("_s_" + n).over(line) for n in values.leads}
    over |= {n: F.last("_s_" + n, ignorenulls=True).over(before) for n in values.fills}
    return chunks.select(
        *[F.col(k).alias("_k_" + k) for k in by], F.col(CHUNK).alias("_k_chunk"),
        *[e.alias("_c_" + n) for n, e in over.items()],
    )


def seq_num(df: DataFrame, by, order, out: str = "seq", split: Split = Split(), hot: Hot | None = None) -> DataFrame:
    """Row number within the key, from 1."""
    return running(df, by, order, Running(sums={out: F.lit(1).cast("long")}), split=split, hot=hot)


def prior_count(df: DataFrame, by, order, out: str = "prior", split: Split = Split(), hot: Hot | None = None) -> DataFrame:
    """Number of earlier rows of the key."""
    return seq_num(df, by, order, out, split, hot).withColumn(out, F.col(out) - 1)


def cumulative(df: DataFrame, by, order, exprs: dict, split: Split = Split(), hot: Hot | None = None) -> DataFrame:
    """Running totals up to and with each row."""
    return running(df, by, order, Running(sums=exprs), split=split, hot=hot)


def neighbours(
    df: DataFrame, by, order, lags=None, leads=None, split: Split = Split(), hot: Hot | None = None
) -> DataFrame:
    """Values of the previous and the next row of the key."""
    return running(df, by, order, Running(lags=lags or {}, leads=leads or {}), split=split, hot=hot)
