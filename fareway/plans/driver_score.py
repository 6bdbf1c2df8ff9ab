"""Driver scores from completion, cancellation, rating and acceptance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.scalars import decode, in_codes, logistic, min_max, safe_ratio
from ..functions.time import day_start_utc, days, filter_local_day, minutes_between, monday
from ..operators.aggregates import count_if, distinct_sums
from ..operators.joins import with_scalars
from .trips import completed, rating_totals, with_local_time, with_trip_times

SMALL = 5


def periods(variant: str, as_of: dt.date) -> tuple[dt.date, dt.date]:
    """`(end of data, start of the recent period)` as local days; the end is exclusive."""
    if variant == "first":
        return as_of - days(1), as_of - days(2 + 32)
    return monday(as_of), monday(as_of) - days(31)


def taxi_drivers(users: DataFrame) -> DataFrame:
    return users.filter(F.col("meterid").isNotNull() & (F.col("usertype") == V.DRIVER_TYPE)).select(
        F.col("_id").alias("ref_driver_id"), F.col("useruid").alias("driver_id"), "meterid", "name",
        decode("refusermaster", V.SUPPLIERS).alias("suppliername"),
    )


def scored_trips(journeys: DataFrame, ratings: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Trips of the score period with rating, on-time flag and peak."""
    base = with_trip_times(with_local_time(filter_local_day(journeys, "journey_created_at", start, end)))
    base = base.withColumn("ata_min", minutes_between(F.col("accepted_time"), F.col("arrived_at_pickup_timestamp")))
    base = base.withColumn("ontime_jrny", F.when(F.col("ata_min") <= F.col("dispatch_eta") + 2, 1).otherwise(0))
    return base.join(rating_totals(ratings), "ref_journey_id", "left")


def driver_summary(trips: DataFrame, recent: Column) -> DataFrame:
    """Counts per driver over all trips (`_lt`) and over the recent ones (`_rc`), in one aggregate.

    Trips are unique by journey, so sums are distinct counts.
    """
    drv_cancel = in_codes("journey_status", V.DRIVER_CANCELLED)
    tests = {
        "total": F.lit(True),
        "completed": completed(),
        "cancelled": drv_cancel,
        "ontime": completed() & (F.col("ontime_jrny") == 1),
        "cancelled_30s": drv_cancel & (F.col("cancel_time_sec") < 30),
    }
    aggs = []
    for tag, when in (("lt", F.lit(True)), ("rc", recent)):
        aggs += [count_if(test & when & F.col("journey_id").isNotNull()).alias(f"{n}_{tag}") for n, test in tests.items()]
        rated = completed() & when
        aggs.append(safe_ratio(
            F.sum(F.when(rated, F.col("rating_sum"))), F.sum(F.when(rated, F.col("rating_n")))
        ).alias(f"rating_{tag}"))
    return trips.groupBy("ref_driver_id").agg(*aggs)


def acceptance_summary(offers: DataFrame, since: dt.date, recent_start: dt.date, end: dt.date) -> DataFrame:
    """Distinct journeys offered to and accepted by each driver, from `since` on and in the recent period."""
    rows = filter_local_day(offers, "timestamp", since, None).filter(F.col("estimate_eta").isNotNull())
    action = F.lower(F.trim("driver_action"))
    accepted, elapsed, rejected = action.like("accept%"), action.like("%elapsed%"), action.like("%rejected%")
    recent = (F.col("timestamp") >= day_start_utc(recent_start)) & (F.col("timestamp") < day_start_utc(end))
    flags = {}
    for tag, when in (("lt", F.lit(True)), ("rc", recent)):
        flags |= {
            f"accepted_{tag}": accepted & when, f"elapsed_{tag}": elapsed & when,
            f"rejected_{tag}": rejected & when, f"offered_{tag}": (accepted | elapsed | rejected) & when,
        }
    return distinct_sums(rows.withColumnRenamed("driver_id", "ref_driver_id"), ["ref_driver_id"], "journey_id", flags)


def driver_scores(
    journeys: DataFrame, ratings: DataFrame, users: DataFrame, as_of: dt.date, start: dt.date,
    variant: str = "scheduled", offers: DataFrame | None = None, offers_since: dt.date | None = None,
) -> DataFrame:
    """One row per taxi driver. With `offers`, the acceptance rate takes part in the score.

    Drivers with fewer than five lifetime trips get 1 in every lifetime part; without recent trips
    the lifetime score stands in for the recent one.
    """
    end, recent_start = periods(variant, as_of)
    trips = scored_trips(journeys, ratings, start, end)
    recent = F.col("journey_created_at") >= day_start_utc(recent_start)
    summary = driver_summary(trips, recent)
    rows = taxi_drivers(users).select("ref_driver_id").join(summary, "ref_driver_id", "left")
    if offers is not None:
        rows = rows.join(acceptance_summary(offers, offers_since, recent_start, end), "ref_driver_id", "left")
    return score_rows(rows, offers is not None)


def score_rows(rows: DataFrame, with_acceptance: bool) -> DataFrame:
    """Rates, logistic transform, min-max scaling over all drivers, weights."""
    weights = V.SCORE_WEIGHTS_ACCEPTANCE if with_acceptance else V.SCORE_WEIGHTS
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    raw, flags = {}, {}
    for tag in ("lt", "rc"):
        raw[f"cr_{tag}"] = F.round(safe_ratio(n(f"completed_{tag}"), n(f"total_{tag}"), 100.0), 5)
        raw[f"dc_{tag}"] = F.coalesce(F.round(safe_ratio(n(f"cancelled_{tag}"), n(f"total_{tag}"), 100.0), 5), F.lit(0.0))
        raw[f"rt_{tag}"] = F.coalesce(F.round(F.col(f"rating_{tag}"), 2), F.lit(5.0))
        if with_acceptance:
            raw[f"acc_{tag}"] = F.coalesce(
                F.round(safe_ratio(n(f"accepted_{tag}"), n(f"offered_{tag}"), 100.0), 5), F.lit(0.0)
            )
    small, idle = n("total_lt") < SMALL, n("total_rc") == 0
    out_lt = {m: small for m in weights} | ({"acc": n("offered_lt") < SMALL} if with_acceptance else {})
    out_rc = {m: idle for m in weights} | ({"acc": n("offered_rc") == 0} if with_acceptance else {})
    for m in weights:
        flags[f"_skip_{m}_lt"], flags[f"_skip_{m}_rc"] = out_lt[m], out_rc[m]

    curves = {}
    for m in weights:
        mid, slope = V.LOGISTIC[m]
        for tag in ("lt", "rc"):
            x = F.col(f"{m}_{tag}") if m == "rt" else F.col(f"{m}_{tag}") / 100.0
            curves[f"_log_{m}_{tag}"] = logistic(x, mid, slope, clamp=m != "rt")
    base = rows.withColumns({"total_journeys": n("total_lt"), "total_journeys_30d": n("total_rc")})
    logs = base.withColumns(raw | flags).withColumns(curves)

    kinds = [(m, tag) for m in weights for tag in ("lt", "rc")]
    used = lambda m, tag: F.when(~F.col(f"_skip_{m}_{tag}"), F.col(f"_log_{m}_{tag}"))
    ends = logs.agg(*[
        f(used(m, tag)).alias(f"_{name}_{m}_{tag}")
        for m, tag in kinds for name, f in (("min", F.min), ("max", F.max))
    ])
    scaled = with_scalars(logs, ends)
    place = lambda m, tag: min_max(f"_log_{m}_{tag}", f"_min_{m}_{tag}", f"_max_{m}_{tag}")
    scaled = scaled.withColumns({
        f"{m}_lt_scaled": F.when(F.col(f"_skip_{m}_lt"), 1.0).otherwise(place(m, "lt")) for m in weights
    } | {
        f"{m}_rc_scaled": F.when(~(F.col(f"_skip_{m}_rc") | F.col(f"_skip_{m}_lt")), place(m, "rc")) for m in weights
    })
    total = lambda tag: sum((F.lit(w) * F.col(f"{m}_{tag}_scaled") for m, w in weights.items()), F.lit(0.0))
    scored = scaled.withColumns({"_life": total("lt"), "_recent": total("rc")})
    no_recent = F.col("total_journeys_30d") == 0
    final = F.lit(V.LIFETIME_WEIGHT) * F.col("_life") + F.lit(V.RECENT_WEIGHT) * F.coalesce(
        F.when(~no_recent, F.col("_recent")), F.col("_life")
    )
    columns = [
        "ref_driver_id", "total_journeys", "total_journeys_30d",
        F.col("cr_lt").alias("completion_rate_pct_lt"), F.col("dc_lt").alias("driver_cancel_rate_pct_lt"),
        F.col("rt_lt").alias("avg_rating_lt"), F.col("cr_rc").alias("completion_rate_pct_30d"),
        F.col("dc_rc").alias("driver_cancel_rate_pct_30d"), F.col("rt_rc").alias("avg_rating_30d"),
        *[f"{m}_{tag}_scaled" for tag in ("lt", "rc") for m in ("cr", "dc", "rt")],
        F.round("_life", 4).alias("lifetime_score"),
        F.round(F.when(no_recent, F.col("_life")).otherwise(F.col("_recent")), 4).alias("recency_score"),
        F.round(final, 4).alias("final_score"),
    ]
    if with_acceptance:
        columns += [
            F.col("acc_lt").alias("acceptance_rate_pct_lt"), F.col("acc_rc").alias("acceptance_rate_pct_30d"),
            "acc_lt_scaled", "acc_rc_scaled",
        ]
    return scored.select(*columns)


def driver_zone_peak(trips: DataFrame) -> DataFrame:
    """Trip outcome per driver, pickup zone and peak."""
    drv_cancel = in_codes("journey_status", V.DRIVER_CANCELLED)
    return trips.groupBy("ref_driver_id", "pickup_zone_name", "peak").agg(
        F.count("journey_id").alias("total_jrny_request"),
        count_if(completed()).alias("completed_jrny_cnt"),
        count_if(drv_cancel).alias("driver_cancelled_jrny_cnt"),
        safe_ratio(F.sum("rating_sum"), F.sum("rating_n")).alias("avg_rating"),
        count_if(completed() & (F.col("ontime_jrny") == 1)).alias("on_time_jrny_cnt"),
        count_if(drv_cancel & (F.col("cancel_time_sec") < 30)).alias("cancelled_under_30_sec"),
    )
