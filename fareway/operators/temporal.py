"""Joins on time: nearest event, windows around an event, counts in a window.

None of them pairs every row of a key with every other: nearest-event joins are one ordered pass
over both sides, window counts are differences of running counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ordered import Running, Split, ordinary, running
from .skew import Hot, find_hot, lookup_join, mark_hot

DAY = 86400


def _seconds(n: float) -> Column:
    return F.expr(f"make_dt_interval(0, 0, 0, {n})")


@dataclass(frozen=True)
class Source:
    """Right-hand events of an as-of join.

    `values` maps output names to expressions over `df`; each is taken from the nearest row in
    which it is not NULL. `strict` leaves out rows at the very same time. `tie` is a column that
    decides between rows of equal time, in its own type (the largest wins backward, the smallest forward).
    """

    df: DataFrame
    ts: str
    values: dict[str, Column]
    strict: bool = False
    tie: str | None = None


def asof_many(
    left: DataFrame, sources: list[Source], by, left_ts: str, direction: str = "backward",
    split: Split = Split(), hot: Hot | None = None,
) -> DataFrame:
    """For each left row the nearest event of each source with the same key, before or after it.

    All sides meet in one ordered pass. Left rows are all kept; those with a NULL key or time go through it too, so that `left` is
    made once, and match nothing. `hot` are the keys, NULL too, that are hot in all sides together, if known already.
    """
    by = [by] if isinstance(by, str) else list(by)
    forward = direction == "forward"
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in by])
    hot = hot or find_hot([left, *[s.df.filter(keyed) for s in sources]], by, split.min_rows)
    packed = F.struct(*[c for c in left.columns if c not in by or c == left_ts])
    left_type = left.select(packed).schema[0].dataType
    types = {n: _type_of(s.df, e) for s in sources for n, e in s.values.items()}
    ties = {f"_tie_{i}": s.df.schema[s.tie].dataType for i, s in enumerate(sources) if s.tie}
    blank = lambda names, kinds: [F.lit(None).cast(kinds[n]).alias(n) for n in names]
    rows = left.select(
        *by, F.col(left_ts).alias("_t"), F.lit(1).alias("_side"), packed.alias("_left"), *blank(ties, ties), *blank(types, types),
    )
    for i, s in enumerate(sources):
        # at equal times the scan must reach the source before the left row, unless strict
        side = 2 if forward != s.strict else 0
        own = f"_tie_{i}"
        rows = rows.unionByName(s.df.filter(keyed & F.col(s.ts).isNotNull()).select(
            *by, F.col(s.ts).alias("_t"), F.lit(side).alias("_side"), F.lit(None).cast(left_type).alias("_left"),
            *([F.col(s.tie).alias(own)] if s.tie else []), *blank((t for t in ties if t != own), ties),
            *[e.alias(n) for n, e in s.values.items()], *blank((n for n in types if n not in s.values), types),
        ))
    done = running(
        rows, by, ["_t", "_side", *ties], Running(fills={"_f_" + n: F.col(n) for n in types}),
        descending=forward, split=split, hot=hot,
    )
    # the keys are those of the pass, so what follows by the same key needs no exchange
    kept = [F.col(c).cast(left.schema[c].dataType).alias(c) if c in by else F.col("_left")[c].alias(c) for c in left.columns]
    usable = keyed & F.col("_t").isNotNull()
    return done.filter(F.col("_left").isNotNull()).select(*kept, *[F.when(usable, F.col("_f_" + n)).alias(n) for n in types])


def asof(
    left: DataFrame, right: DataFrame, by, left_ts: str, right_ts: str, values: dict[str, Column],
    direction: str = "backward", strict: bool = False, tie: str | None = None, split: Split = Split(),
    hot: Hot | None = None,
) -> DataFrame:
    """`asof_many` with one source."""
    return asof_many(left, [Source(right, right_ts, values, strict, tie)], by, left_ts, direction, split, hot)


def _type_of(df: DataFrame, e: Column):
    return df.select(e.alias("x")).schema[0].dataType


def asof_within(
    left, right, by, left_ts, right_ts, values: dict[str, Column], seconds: float | None = None,
    direction: str = "backward", strict: bool = False, tie: str | None = None, split: Split = Split(),
    hot: Hot | None = None,
) -> DataFrame:
    """`asof` on whole right rows: all values come from the one nearest row, if it is close enough.

    The time of the matched row is returned as `matched_at`.
    """
    row = F.struct(F.col(right_ts).alias("matched_at"), *[e.alias(n) for n, e in values.items()])
    found = asof(
        left, right, by, left_ts, right_ts, {"_match": row}, direction, strict, tie, split, hot
    )
    ok = F.lit(True)
    if seconds is not None:
        at, t = F.col("_match.matched_at"), F.col(left_ts)
        ok = (at <= t + _seconds(seconds)) if direction == "forward" else (at >= t - _seconds(seconds))
    return found.withColumn("_match", F.when(ok, F.col("_match"))).select(*left.columns, "_match.*")


def next_within(left, right, by, left_ts, right_ts, values, seconds, strict=False, tie=None, split=Split()):
    """The first right row at or after each left row, at most `seconds` later."""
    return asof_within(left, right, by, left_ts, right_ts, values, seconds, "forward", strict, tie, split)


def match_latest_left(
    left, right, by, left_ts, right_ts, left_values: dict, seconds, nearest_only: bool = False,
    left_id: str | None = None, right_id: str | None = None, split: Split = Split(),
) -> DataFrame:
    """Pair each right row with the latest left row at most `seconds` before it (or at the same time).

    `left_values` are carried over; unmatched right rows are dropped. With `nearest_only` a left
    row keeps only its earliest right row.
    """
    pairs = asof_within(
        right, left, by, right_ts, left_ts, left_values, seconds, "backward", tie=left_id, split=split
    ).filter(F.col("matched_at").isNotNull())
    if nearest_only:
        from .dedupe import keep_first

        pairs = keep_first(pairs, [*([by] if isinstance(by, str) else by), left_id], [right_ts, right_id])
    return pairs


def exists_within(
    left, right, by, left_ts, right_ts, seconds, out: str, strict: bool = False, split: Split = Split()
) -> DataFrame:
    """1 where the right side has an event in [t, t + seconds] (without t itself if `strict`), else 0."""
    near = asof(left, right, by, left_ts, right_ts, {out: F.col(right_ts)}, "forward", strict, split=split)
    hit = F.col(out) <= F.col(left_ts) + _seconds(seconds)
    return near.withColumn(out, F.when(hit, 1).otherwise(0))


def next_activity(
    left, right, by, left_ts, right_ts, seconds, flag: Column, next_out: str, flag_out: str,
    split: Split = Split(),
) -> DataFrame:
    """Per left row over the right rows in (t, t + seconds]: the earliest time, and 1 if any meets `flag`."""
    near = asof(
        left, right, by, left_ts, right_ts,
        {next_out: F.col(right_ts), flag_out: F.when(flag, F.col(right_ts))}, "forward", True, split=split,
    )
    end = F.col(left_ts) + _seconds(seconds)
    return near.withColumns({
        next_out: F.when(F.col(next_out) <= end, F.col(next_out)),
        flag_out: F.when(F.col(flag_out) <= end, 1).otherwise(0),
    })


def count_within(
    df: DataFrame, by, ts: str, seconds: int, out: str, split: Split = Split(), hot: Hot | None = None
) -> DataFrame:
    """Number of rows of the same key in (t, t + seconds].

    It is a running count up to t + seconds less the one up to t: for ordinary keys both come from one window, for hot keys
    from two ordered passes in which the row waits at either time. Rows with a NULL key or time count 0; they go along, so that `df` is made once.
    """
    by = [by] if isinstance(by, str) else list(by)
    hot = hot or find_hot(df, by, split.min_rows)
    names = [c for c in df.columns if c != out]
    usable = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*by, ts]])
    counts = lambda n: F.when(usable, n).otherwise(F.lit(0).cast("long")).alias(out)
    line = Window.partitionBy(*by).orderBy("_us")
    upto = lambda us: F.count("_us").over(line.rangeBetween(Window.unboundedPreceding, us))
    timed = ordinary(df, by, hot).withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    counted = timed.withColumn("_n", upto(int(seconds * 1_000_000)) - upto(0)).select(*names, counts(F.col("_n")))
    if hot.keys is None:
        return counted
    many = mark_hot(df, by, hot).filter(F.col("_hot").isNotNull()).drop("_hot")
    marks = many.filter(usable).select(*by, F.col(ts).alias("_t"), F.lit(0).alias("_side"), F.lit(1).cast("long").alias("_one"))
    waiting = many.select(F.struct(*df.columns).alias("_row"), *by, ts)
    for name, wait in (("_upto", 0), ("_beyond", seconds)):
        at = waiting.withColumns({"_t": F.col(ts) + _seconds(wait), "_side": F.lit(1), "_one": F.lit(0).cast("long")})
        both = at.unionByName(marks, allowMissingColumns=True)
        waiting = running(both, by, ["_t", "_side"], Running(sums={name: F.col("_one")}), split=split, hot=hot).filter(
            F.col("_row").isNotNull()
        ).drop("_t", "_side", "_one")
    cut = waiting.select("_row.*", (F.col("_beyond") - F.col("_upto")).alias("_n")).select(*names, counts(F.col("_n")))
    return counted.unionByName(cut)


def add_counts_before(rows: DataFrame, before: DataFrame, by: str, counts: dict[str, Column]) -> DataFrame:
    """Add to each running count in `rows` what the key had in `before`; a NULL key is a key of its own.

    `before` is summed once per key, with map-side combine; `counts` maps a column of `rows` to its expression over `before`.
    """
    totals = [F.sum(e).alias("_b_" + n) for n, e in counts.items()]
    sums = before.filter(F.col(by).isNotNull()).groupBy(F.col(by).alias("_key")).agg(*totals)
    # a plain equality leaves the rows where an ordered pass by the same key has put them; the NULL key has one row of its own
    unkeyed = before.filter(F.col(by).isNull()).agg(*totals).select(F.struct("*").alias("_unkeyed"))
    joined = rows.join(sums, rows[by] == sums["_key"], "left").crossJoin(F.broadcast(unkeyed))
    earlier = lambda n: F.when(F.col(by).isNull(), F.col("_unkeyed")["_b_" + n]).otherwise(F.col("_b_" + n))
    return joined.withColumns({n: F.col(n) + F.coalesce(earlier(n), F.lit(0)) for n in counts}).select(*rows.columns)


def before_after(
    events: DataFrame, facts: DataFrame, by: str, event_ts: str, fact_ts: str, fact_id: str,
    before: dict[str, Column], after: dict[str, Column], carry=(), hot: Hot | None = None,
) -> DataFrame:
    """Per event (one per key) the distinct facts strictly before and strictly after it.

    `before` and `after` map output names to conditions on a fact. Keys without facts get 0.
    Facts are reduced to one row per id first, then summed with map-side combine.
    """
    marked = lookup_join(facts, events.select(by, F.col(event_ts).alias("_event")), by, "inner", hot)
    flags = {n: (F.col(fact_ts) < F.col("_event")) & c for n, c in before.items()}
    flags |= {n: (F.col(fact_ts) > F.col("_event")) & c for n, c in after.items()}
    per_fact = marked.groupBy(by, fact_id).agg(
        *[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in flags.items()]
    )
    sums = per_fact.filter(F.col(fact_id).isNotNull()).groupBy(by).agg(*[F.sum(n).alias(n) for n in flags])
    return events.join(sums, by, "left").select(
        by, event_ts, *carry, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in flags]
    )


def rolling_weeks(
    grid: DataFrame, facts: DataFrame, by: str, week: str, day: str, aggs: dict[str, Column],
    weeks: int = 2,
) -> DataFrame:
    """Sums over the `weeks` full weeks before each grid week (a Monday); 0 without facts.

    The window [Monday - 7·weeks, Monday) is whole weeks, so facts are summed once per key and
    week, and each sum is handed to the `weeks` Mondays that follow. No range join.
    """
    weekly = facts.groupBy(by, F.to_date(F.date_trunc("week", day)).alias("_w")).agg(
        *[F.sum(e).alias(n) for n, e in aggs.items()]
    )
    steps = F.array(*[F.lit(7 * (i + 1)) for i in range(weeks)])
    handed = weekly.withColumn("_step", F.explode(steps)).withColumn(week, F.expr("date_add(_w, _step)"))
    sums = handed.groupBy(by, week).agg(*[F.sum(n).alias(n) for n in aggs])
    return grid.join(sums, [by, week], "left")


def active_within(
    grid: DataFrame, facts: DataFrame, by: str, week: str, day: str, days: int, out: str
) -> DataFrame:
    """1 where the key has a fact in (Monday, Monday + days], else 0.

    Each active day is handed to the Mondays whose window holds it.
    """
    if days < 7:
        raise ValueError("a window under a week may hold no Monday")
    active = facts.select(by, day).distinct()
    first = F.date_trunc("week", F.date_add(day, -days + 6)).cast("date")
    last = F.date_trunc("week", F.date_add(day, -1)).cast("date")
    mondays = F.sequence(first, last, F.expr("interval 7 days"))
    hits = (
        active.filter(F.col(day).isNotNull())
        .select(by, F.explode(mondays).alias(week)).distinct().withColumn(out, F.lit(1))
    )
    return grid.join(hits, [by, week], "left").withColumn(out, F.coalesce(out, F.lit(0)))


def count_before(grid: DataFrame, facts: DataFrame, by: str, week: str, day: str, out: str) -> DataFrame:
    """Number of facts on days before each grid Monday, over all time.

    Facts and grid weeks meet in one table of at most one row per key and week, which is then
    summed along the weeks of the key.
    """
    weekly = facts.groupBy(by, F.to_date(F.date_trunc("week", day)).alias(week)).agg(
        F.count(F.lit(1)).alias("_n")
    )
    marks = grid.select(by, week).distinct().withColumn("_n", F.lit(0).cast("long"))
    both = weekly.unionByName(marks).groupBy(by, week).agg(F.sum("_n").alias("_n"))
    line = Window.partitionBy(by).orderBy(week).rowsBetween(Window.unboundedPreceding, -1)
    sums = both.withColumn(out, F.coalesce(F.sum("_n").over(line), F.lit(0))).drop("_n")
    return grid.join(sums, [by, week], "left").withColumn(out, F.coalesce(out, F.lit(0)))
