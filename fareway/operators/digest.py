"""Weekly digests: one narrow row per key and week, from which sums, labels and counts are windows over the key's weeks.

A digest row holds the sums of its week, the number of its facts, and a bitmap of the days that have one (bit 0 is Monday).
However many facts a key has, it has one row a week, so the windows are never long. Facts are read once and combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.time import week_start

EPOCH_MONDAY = "1970-01-05"


def week_digest(facts: DataFrame, by: str, day: str, sums: dict[str, Column], also=(), week: str = "week_start") -> DataFrame:
    """One row per `by`, the columns `also` and week: the sums, `_facts` and `_days`. Facts without a key or a day are left out."""
    known = facts.filter(F.col(by).isNotNull() & F.col(day).isNotNull())
    bit = F.expr(f"shiftleft(1, weekday(`{day}`))")
    return known.groupBy(by, *also, week_start(F.col(day)).alias(week)).agg(
        *[F.sum(e).alias(n) for n, e in sums.items()], F.count(F.lit(1)).alias("_facts"), F.bit_or(bit).alias("_days")
    )


def with_week_after(digest: DataFrame, by: str, also=(), week: str = "week_start") -> DataFrame:
    """The digest, dealt by `by`, and a row without facts for the week after the last one of each `by` and `also`."""
    last = F.col(week) == F.max(week).over(Window.partitionBy(by, *also))
    twice = F.when(F.col("_last"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = digest.repartition(by).withColumn("_last", last).withColumn("_later", F.explode(twice))
    own = F.col("_later") == 0
    # the key itself is passed on as it is, so the rows stay dealt by it
    value = lambda c: (
        F.col(c) if c in (by, *also) else F.when(own, F.col(c)).otherwise(F.date_add(week, 7)) if c == week
        else F.when(own, F.col(c)).otherwise(F.lit(0)) if c in ("_facts", "_days") else F.when(own, F.col(c))
    )
    return rows.select(*[value(c).alias(c) for c in digest.columns])


def over_weeks(
    digest: DataFrame, by: str, *, sums=(), weeks: int = 2, active: dict[str, int] | None = None, prior: str | None = None,
    week: str = "week_start",
) -> DataFrame:
    """Per row of a digest, over all rows of its key.

    `sums`: these columns summed over the `weeks` weeks before, NULL without facts. `active`: for each output name, 1 if there is a
    fact in (Monday, Monday + days], else 0. `prior`: the number of facts before the week, over all time. All frames share one window.
    """
    line = Window.partitionBy(by).orderBy("_w")
    within = lambda c, first, last: F.max(F.when(c, 1).otherwise(0)).over(line.rangeBetween(first, last))
    day_bits = lambda first, last: (F.col("_days").bitwiseAND(sum(1 << i for i in range(first, last + 1))) != 0)
    out = {n: F.sum(n).over(line.rangeBetween(-weeks, -1)) for n in sums}
    for name, days in (active or {}).items():
        full, rest = divmod(days, 7)
        parts = [within(day_bits(1, min(days, 6)), 0, 0)]
        if full > 1:
            parts.append(within(F.col("_days") != 0, 1, full - 1))
        if full:
            parts.append(within(day_bits(0, rest), full, full))
        out[name] = F.greatest(*[F.coalesce(p, F.lit(0)) for p in parts], F.lit(0))
    if prior:
        out[prior] = F.coalesce(F.sum("_facts").over(line.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = digest.withColumn("_w", (F.datediff(week, F.lit(EPOCH_MONDAY).cast("date")) / 7).cast("int"))
    kept = [c for c in digest.columns if c not in out and c not in ("_facts", "_days")]
    return placed.select(*kept, *[e.alias(n) for n, e in out.items()])
