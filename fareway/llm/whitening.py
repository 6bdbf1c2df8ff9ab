"""Whitening of embeddings with a covariance found by polarisation.

A vector becomes integers x = floor(scale * component) + shift. For every dimension, and for the sum of every two dimensions, the job
adds up exact squares of centred integers. Twice the covariance of two dimensions is the variance of their sum less their own
variances, so all entries of the covariance matrix come from sums of squares; the driver assembles them and calls eigh.

Centring: c = x - m with the integer m next to the mean. The rest of the mean, below one half, is taken out exactly afterwards:
n * sum(c^2) - sum(c)^2 is n^2 times the variance. The sums are longs while a bound from the measured ranges shows that they fit, and decimals of
38 digits beyond. Pairs are laid out by rotation: a vector gives one row per dimension i (and block of OFFSETS offsets), which adds to the
sums for i + 1, i + 2, ... at once, so no row per pair is ever made. Only DataFrame functions run on the executors.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import cut_lineage

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
OFFSETS = 8  # pair sums in one row
LONG = 2**63 - 1
WHOLE = 2**52  # integers up to here are exact in a double


def usable(vector: Column) -> Column:
    """Whether a vector (of doubles) is there and holds finite numbers only; a search that ends at a NULL gives NULL, which no filter passes."""
    holds = lambda x: F.array_contains(vector, F.lit(float(x)))
    return ~holds("nan") & ~holds("inf") & ~holds("-inf")


def as_integer(x: Column) -> Column:
    return F.floor(x.cast("double") * SCALE) + F.lit(SHIFT)


def numbers(values, kind: str) -> Column:
    """An array literal; one text, so that long vectors do not make one literal per component."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


@dataclass(frozen=True)
class Ranges:
    """Rows, and per dimension the sum and the least and largest integer."""

    n: int
    sums: list[int]
    least: list[int]
    largest: list[int]

    @property
    def middles(self) -> list[int]:
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    @property
    def reach(self) -> int:
        """No centred integer is larger."""
        return max(max(hi - m, m - lo) for lo, hi, m in zip(self.least, self.largest, self.middles, strict=True))

    @property
    def largest_deviation(self) -> int:
        return sum(max(self.n * hi - s, s - self.n * lo) ** 2 for s, lo, hi in zip(self.sums, self.least, self.largest, strict=True))


def measure(vectors: DataFrame) -> Ranges | None:
    """One pass over column `vector`; the result has a row per dimension. None without vectors."""
    n = F.count(F.lit(1)).alias("n")
    x = vectors.select(F.posexplode("vector").alias("at", "v")).select("at", as_integer(F.col("v")).alias("x"))
    rows = x.groupBy("at").agg(n, F.sum("x").alias("total"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("at").collect()
    if not rows:
        return None
    if len({r.n for r in rows}) > 1 or vectors.where(F.size("vector") != len(rows)).limit(1).count():
        raise ValueError("vectors of different lengths")
    if max(max(abs(r.lo), abs(r.hi)) for r in rows) >= WHOLE:
        raise ValueError(f"components beyond {WHOLE // SCALE} have no exact integer")
    return Ranges(rows[0].n, [r.total for r in rows], [r.lo for r in rows], [r.hi for r in rows])


def centred(vectors: DataFrame, ranges: Ranges) -> DataFrame:
    """`vectors` with the array `c` of centred integers, whose type says that nothing in it is NULL."""
    c = F.zip_with("vector", numbers(ranges.middles, "bigint"), lambda v, m: F.coalesce(as_integer(v) - m, F.lit(0).cast("long")))
    return vectors.withColumn("c", F.coalesce(c, F.array().cast("array<bigint>")))


def pair_sums(vectors: DataFrame, ranges: Ranges) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Sums of squares of each centred dimension, and of each sum of two, i < j."""
    d = len(ranges.sums)
    small = ranges.n * (2 * ranges.reach) ** 2 <= LONG
    blocks = range(max(1, -(-(d // 2) // OFFSETS)))
    square = (lambda v: v * v) if small else (lambda v: v.cast("decimal(18,0)") * v.cast("decimal(18,0)"))
    rows = centred(vectors, ranges).select(F.concat("c", "c").alias("c"))  # twice over, so that i + offset needs no wrapping
    rows = rows.select("c", F.explode(F.sequence(F.lit(0), F.lit(d * len(blocks) - 1))).alias("slot"))
    at, first = F.expr(f"slot div {len(blocks)}").cast("int"), (F.col("slot") % len(blocks) * OFFSETS).cast("int")
    value = F.col("c")[at]
    offsets = min(OFFSETS, d // 2)
    sums = [F.sum(square(value)).alias("own"), *(F.sum(square(value + F.col("c")[at + first + k + 1])).alias(f"s{k}") for k in range(offsets))]
    own, pairs = [0] * d, {}
    for row in rows.groupBy("slot").agg(*sums).collect():  # as many rows as the vector length sets
        i, first_offset = divmod(row.slot, len(blocks))
        own[i] = int(row.own)
        for k in range(offsets):
            offset = first_offset * OFFSETS + k + 1
            if offset <= d // 2:
                j = (i + offset) % d
                pairs[min(i, j), max(i, j)] = int(row[f"s{k}"])
    return own, pairs


def covariance(vectors: DataFrame, ranges: Ranges) -> np.ndarray:
    """The covariance matrix (divisor n), each entry rounded once from its exact value."""
    n, d = ranges.n, len(ranges.sums)
    left = [s - n * m for s, m in zip(ranges.sums, ranges.middles, strict=True)]
    own, pairs = pair_sums(vectors, ranges)
    own = [n * q - r * r for q, r in zip(own, left, strict=True)]
    out = np.diag([v / (n * n) for v in own]).astype(np.float64)
    for i, j in combinations(range(d), 2):
        both = n * pairs[i, j] - (left[i] + left[j]) ** 2
        out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n * n)  # whole numbers until the division
    return out


def projected(vectors: DataFrame, weights: list[np.ndarray], ranges: Ranges) -> DataFrame:
    """vec_id, deviation_exact, and p0, p1, ... : products of the centred vector with each weight vector; one row per vector.

    A vector is taken apart into its dimensions, and each gives a term to all sums; the sums of a vector are complete before
    the shuffle, since its dimensions lie in one task.
    """
    n, middles = ranges.n, ranges.middles
    left = [s - n * m for s, m in zip(ranges.sums, middles, strict=True)]
    rest, table = numbers([r / n for r in left], "double"), F.array(*(numbers(row.tolist(), "double") for row in np.array(weights).T))
    rows = vectors.withColumn("row", F.monotonically_increasing_id())  # before the explode, which would number the dimensions
    x = rows.select("vec_id", "row", F.posexplode("vector").alias("at", "v"))
    x = x.select("vec_id", "row", "at", (as_integer(F.col("v")) - F.get(numbers(middles, "bigint"), F.col("at"))).alias("c"), F.get(table, F.col("at")).alias("u"))
    terms = x.select("vec_id", "row", (F.col("c") - F.get(rest, F.col("at"))).alias("d"), "u", _deviation(ranges, left).alias("square"))
    products = [F.sum(F.col("d") * F.get("u", F.lit(k))).alias(f"p{k}") for k in range(len(weights))]
    total = F.sum("square").cast("decimal(38,0)").alias("deviation_exact")
    return terms.groupBy("row", "vec_id").agg(total, *products).drop("row")


def _deviation(ranges: Ranges, left: list[int]) -> Column:
    """(n * x - S)^2 of one dimension: a long, or a decimal where the sum over dimensions needs one; NULL where 38 digits do not hold the sum."""
    if ranges.largest_deviation >= 10**37:
        return F.lit(None).cast("decimal(38,0)")
    if ranges.largest_deviation <= LONG:
        y = F.col("c") * F.lit(ranges.n).cast("long") - F.get(numbers(left, "bigint"), F.col("at"))
        return y * y
    y = F.col("c").cast("decimal(18,0)") * F.lit(ranges.n).cast("decimal(18,0)") - F.get(numbers(left, "decimal(38,0)"), F.col("at"))
    y = y.cast("decimal(19,0)")
    return (y * y).cast("decimal(38,0)")


def identity_error(rows: DataFrame, components: int, n: int) -> float:
    """Largest entry of the covariance of p0, p1, ... less the identity, again from variances of sums."""
    ends = [(a, a) for a in range(components)] + list(combinations(range(components), 2))
    value = lambda a, b: F.col(f"p{a}") if a == b else F.col(f"p{a}") + F.col(f"p{b}")
    sums = [f(value(a, b)).alias(f"{kind}{k}") for k, (a, b) in enumerate(ends) for kind, f in (("s", F.sum), ("q", lambda v: F.sum(v * v)))]
    got = rows.agg(*sums).first()
    variance = {e: got[f"q{k}"] / n - (got[f"s{k}"] / n) ** 2 for k, e in enumerate(ends)}
    cross = [abs(variance[a, b] - variance[a, a] - variance[b, b]) / 2 for a, b in ends[components:]]
    return max([abs(variance[a, a] - 1) for a in range(components)] + cross)


def whiten(
    embeddings: DataFrame, *, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding",
    use: Callable[[np.ndarray], None] | None = None,
) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error, deviation_exact: `components` rows per vector.

    Vectors that are NULL or hold NULL, NaN or infinite components are left out; the others must have one length, else the job
    raises. Repeated rows count and come out each; a NULL id stays NULL; further columns are ignored; without vectors the result is
    empty. Vectors shorter than `components` give as many rows as they have dimensions. A direction without variance (equal vectors, fewer
    vectors than components) has whitened 0, and identity_error then says 1. `deviation` is NULL beyond the range of a long;
    `deviation_exact` (38 digits) still holds it. `use` is given the covariance matrix.
    """
    vectors = embeddings.select(embeddings[id_col].cast("long").alias("vec_id"), embeddings[vector_col].cast("array<double>").alias("vector"))
    vectors = vectors.where(usable(F.col("vector")))
    ranges = measure(vectors)
    if ranges is None:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
        )
    matrix = covariance(vectors, ranges)
    if use:
        use(matrix)
    values, directions = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:components]
    floor = max(values.max(), 0.0) * len(values) * np.finfo(np.float64).eps
    weights = [directions[:, k] / np.sqrt(values[k]) if values[k] > floor else np.zeros(len(values)) for k in order]
    trace = float(np.trace(matrix))
    shares = [float(values[k]) / trace if trace > 0 else 0.0 for k in order]
    # written once: the error is measured on these rows, and they are what is returned
    rows = cut_lineage(projected(vectors, weights, ranges))
    error = identity_error(rows, len(weights), ranges.n)
    wide = F.col("deviation_exact")
    parts = [F.struct(F.lit(k + 1).alias("component"), F.col(f"p{k}").alias("whitened"), F.lit(share).alias("explained")) for k, share in enumerate(shares)]
    out = rows.select("vec_id", "deviation_exact", F.explode(F.array(*parts)).alias("x"))
    return out.select(
        "vec_id", "x.component", F.lit(ranges.n).cast("long").alias("n"), F.when(wide <= F.lit(LONG).cast("decimal(38,0)"), wide).cast("long").alias("deviation"),
        "x.whitened", "x.explained", F.lit(error).alias("identity_error"), wide,
    )
