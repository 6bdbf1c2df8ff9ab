"""Expand parent links to chains: the root and the depth of every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..session import cut_lineage
from .reshape import union_all

LEVELS = 6  # levels that one round adds
MOST_LEVELS = 10_000


def expand_chains(df: DataFrame, id_c: str, parent_c: str, root: Column) -> DataFrame:
    """All rows whose chain starts at a parentless row that meets `root`, with `root_id` and `level`.

    `df` is read once and written to the shared checkpoint folder, dealt by the parent (roots by their own id); pass only the columns that
    are needed. From then on a level costs one exchange, that of the level before it: the written rows lie where the join wants
    them, and they bring their columns along, so nothing is joined back. A round adds a few levels and is written; the deepest level is
    counted while it is. Joins with a level that turns out to be empty are dropped at run time. Rows of a broken chain (missing
    parent) and rows on a cycle have no root, and are never reached.

    Ids must be unique; a chain of more than `MOST_LEVELS` levels is taken for a repeated id and raises.
    """
    names, parts = df.columns, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.filter(F.col(id_c).isNotNull()).withColumn("_key", F.coalesce(parent_c, id_c))
    rows = cut_lineage(keyed.repartition(parts, "_key"))
    children = rows.filter(F.col(parent_c).isNotNull())
    zero = F.lit(0).cast("long")
    frontier = rows.filter(F.col(parent_c).isNull() & root).select(*names, F.col(id_c).alias("root_id"), zero.alias("level"))
    found, reach = [frontier], 0
    while True:
        grown = [frontier]
        for _ in range(LEVELS):
            above = grown[-1].select(F.col(id_c).alias("_above"), "root_id", (F.col("level") + 1).alias("level"))
            grown.append(children.join(above, F.col("_key") == F.col("_above")).select(*names, "root_id", "level"))
        reach += LEVELS
        deepest = Observation()
        found.append(cut_lineage(union_all(*grown[1:]).coalesce(parts).observe(deepest, F.max("level").alias("deepest"))))
        if deepest.get["deepest"] is None or deepest.get["deepest"] < reach:
            break
        if reach > MOST_LEVELS:
            raise ValueError(f"a chain of more than {MOST_LEVELS} levels; are the ids unique?")
        frontier = found[-1].filter(F.col("level") == reach)
    return union_all(*found).coalesce(parts)
