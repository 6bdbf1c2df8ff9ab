"""Connected components of links, by alternating large and small stars; no group is gathered anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import cut_lineage

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node it knows."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands itself and its smaller neighbours to the smallest of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that is not the smallest of its component; root is that smallest node.

    `links` has two columns of one sortable type; direction, repeats, self-links and NULL ends do not matter. An empty
    input gives an empty result. Each round writes its edges to the shared checkpoint folder; a star is reached after
    about log2 of the longest path, squared at worst.
    """
    a, b = links.columns
    edges = cut_lineage(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    )
    mark = F.struct(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a")))
    before = edges.agg(mark).first()[0]
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = edges.agg(mark).first()[0]
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
