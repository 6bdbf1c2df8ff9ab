"""Keys with more rows than one task should hold, and joins that survive them.

A key is hot when it holds more than `spark.fareway.hotRows` rows (one million by default). The bound is fixed: it does not grow
with the data. Work on a hot key is cut into parts of about `spark.fareway.taskRows` rows, however many parts that makes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage

HOT_ROWS = 1_000_000
TASK_ROWS = 1_000_000
BROADCAST_KEYS = 100_000
JOINS = ("inner", "left", "left_outer", "leftouter", "left_semi", "left_anti")


@dataclass(frozen=True)
class Hot:
    """The hot values of the key columns `by` with their row counts; `keys` is None when there are none.

    `total` is the number of rows of all hot keys, `n_keys` the number of hot keys.
    """

    by: tuple[str, ...]
    keys: DataFrame | None
    total: int = 0
    n_keys: int = 0


def hot_rows(spark: SparkSession) -> int:
    """Rows above which a key is hot."""
    return int(spark.conf.get("spark.fareway.hotRows", str(HOT_ROWS)))


def task_rows(spark: SparkSession) -> int:
    """Rows of a hot key that one task gets."""
    return max(1, int(spark.conf.get("spark.fareway.taskRows", str(TASK_ROWS))))


def find_hot(frames, by, min_rows: int | None = None) -> Hot:
    """Count the keys of one or more frames and keep the hot ones.

    This runs one job that reads the key columns only and combines on the map side; its result is one row. Mostly no
    key is hot, and the steps that use the key then take their plain form. Otherwise the hot keys are written to the shared
    folder, so that no step counts them again. Pass frames close to the scan, and pass the result on to all steps
    with the same key.
    """
    by = [by] if isinstance(by, str) else list(by)
    frames = frames if isinstance(frames, (list, tuple)) else [frames]
    min_rows = hot_rows(frames[0].sparkSession) if min_rows is None else min_rows
    keys = reduce(lambda a, b: a.unionByName(b), [f.select(*by) for f in frames])
    counts = keys.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > min_rows)
    n_keys, total = counts.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if not n_keys:
        return Hot(tuple(by), None)
    kept = cut_lineage(counts.select(*[F.col(k).alias("_k_" + k) for k in by], F.col("_n").alias("_k_n")))
    return Hot(tuple(by), kept, total, n_keys)


def same_key(left: DataFrame, right: DataFrame, keys, prefix: str = "") -> Column:
    """Equality on all keys in which NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[prefix + k]) for k in keys])


def mark_hot(df: DataFrame, by, hot: Hot) -> DataFrame:
    """`df` with `_hot`: the key's row count if it is hot, else NULL. Only few keys are broadcast."""
    if hot.keys is None:
        return df.withColumn("_hot", F.lit(None).cast("long"))
    keys = hot.keys.select(*[F.col("_k_" + k).alias("_h_" + k) for k in by], F.col("_k_n").alias("_hot"))
    if hot.n_keys <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return df.drop("_hot").join(keys, same_key(df, keys, by, "_h_"), "left").drop(*["_h_" + k for k in by])


def lookup_join(
    left: DataFrame, right: DataFrame, on, how: str = "left", hot: Hot | None = None, spread=None
) -> DataFrame:
    """Equi join in which each hot key of `left` is spread over as many salts as its rows need tasks.

    The rows of `right` that meet a hot key are repeated once per salt, so only joins that never return an
    unmatched right row are taken: inner, left, left_semi, left_anti. `spread` names the left columns that decide the salt
    (all of them by default), so a re-run task salts alike. A hot NULL key matches nothing and is spread too. Without hot keys
    it is a plain join.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in JOINS:
        raise ValueError(f"lookup_join cannot repeat right rows for a join of kind {how!r}; use one of {JOINS}")
    hot = hot or find_hot(left, on)
    if hot.keys is None:
        return left.join(right, on, how)
    parts = F.ceil(F.coalesce("_hot", F.lit(0)) / F.lit(task_rows(left.sparkSession)))
    salts = F.greatest(F.lit(1).cast("long"), parts.cast("long"))
    slot = F.pmod(F.xxhash64(*(spread or left.columns)), salts)
    salted = mark_hot(left, on, hot).withColumn("_salt", slot).drop("_hot")
    repeated = mark_hot(right, on, hot).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_hot")
    return salted.join(repeated, on + ["_salt"], how).drop("_salt")
