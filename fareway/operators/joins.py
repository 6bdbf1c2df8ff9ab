"""Membership, scalar and parent joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .skew import Hot, lookup_join


def filter_in(df: DataFrame, c: str, ref: DataFrame, ref_c: str | None = None, hot: Hot | None = None) -> DataFrame:
    """Rows whose key occurs in `ref`."""
    keys = ref.select(F.col(ref_c or c).alias(c)).distinct()
    return lookup_join(df, keys, c, "left_semi", hot)


def classify_member(df: DataFrame, c: str, ref: DataFrame, ref_c: str, out: str, hot: Hot | None = None) -> DataFrame:
    """Boolean column: does the key occur in `ref`? Keys are made unique first, so no row is repeated."""
    keys = ref.select(F.col(ref_c).alias(c)).filter(F.col(c).isNotNull()).distinct().withColumn("_in", F.lit(True))
    return lookup_join(df, keys, c, "left", hot).withColumn(out, F.coalesce("_in", F.lit(False))).drop("_in")


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a relation of exactly one row, such as a keyless aggregate; more rows raise when it runs."""
    row = F.struct(*one_row.columns)
    checked = one_row.agg(F.when(F.count(F.lit(1)) == 1, F.first(row)).otherwise(F.raise_error(F.lit("not one row"))).alias("_one"))
    return df.crossJoin(F.broadcast(checked)).select(*df.columns, "_one.*")


def parent_compare(
    rows: DataFrame, id_c: str, parent_c: str, carried: dict[str, Column], hot: Hot | None = None
) -> DataFrame:
    """Each row with values of its parent row; rows without a parent row are dropped."""
    parents = rows.select(F.col(id_c).alias(parent_c), *[e.alias(n) for n, e in carried.items()])
    return lookup_join(rows.filter(F.col(parent_c).isNotNull()), parents, parent_c, "inner", hot)
