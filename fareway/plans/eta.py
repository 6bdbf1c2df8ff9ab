"""Arrival times: trip detail, last ETA before a cancellation, ETA rank against distance rank."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.geo import sphere_distance
from ..functions.scalars import digits, in_codes, json_text, safe_ratio
from ..functions.time import filter_local_day, seconds_between
from ..operators.dedupe import keep_max, top_k
from ..operators.skew import find_hot, lookup_join
from ..operators.temporal import asof_within
from .trips import with_local_time, with_trip_times


def eta_ata_detail(journeys: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """One row per assigned trip with its times and peak label."""
    base = filter_local_day(journeys, "journey_created_at", start, end).filter(F.col("driver_id").isNotNull())
    return with_trip_times(with_local_time(base)).select(
        "journey_id", "ref_journey_id", "ref_customer_id", "ref_driver_id", "driver_id",
        "ref_vehicle_category_id", "pickup_latitude", "pickup_longitude", "customer_id", "local_ts",
        "local_date", "local_hour", "weekday", "journey_status_desc", "journey_status",
        "actual_total_fee", "estimate_total_fee", "first_eta", "dispatch_eta", "dispatch_eta_sec",
        "accepted_ride_timestamp", "on_route_timestamp", "arrived_at_pickup_timestamp",
        "journey_cancel_timestamp", "journey_completed_timestamp", "vehicle_cat", "booking_week",
        "accepted_time", "peak", "ata", "cancel_time_sec", "jrny_time",
    )


def last_eta_before_cancel(journeys: DataFrame, app_events: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Histogram of the first ETA less (last ETA seen + whole minutes to the cancellation)."""
    shown = filter_local_day(app_events, "event_time", start, end).filter(F.col("event_type") == "eta_refresh")
    shown = shown.select(
        json_text("event_properties", "Journey_id").alias("journey_id"), "event_time", "user_id",
        digits(json_text("event_properties", "ETA")).alias("eta"),
    )
    cancelled = filter_local_day(journeys, "journey_created_at", start, end).filter(
        F.col("driver_id").isNotNull() & in_codes("journey_status", V.CUSTOMER_CANCELLED)
        & in_codes("ref_vehicle_category_id", V.TAXI_CATEGORIES)
    ).select("journey_id", "first_eta", "journey_created_at", "journey_cancel_timestamp")
    seen = asof_within(
        cancelled, shown, "journey_id", "journey_cancel_timestamp", "event_time", {"eta": F.col("eta")}, tie="eta"
    )
    waited = seconds_between("journey_created_at", "journey_cancel_timestamp")
    proxy = F.round(F.col("eta") + (waited / 60).cast("long"), 0)
    return seen.withColumn("diff", F.col("first_eta") - proxy).groupBy("diff").agg(
        F.count("journey_id").alias("jrny_cnt")
    )


def eta_distance_agreement(
    journeys: DataFrame, offers: DataFrame, start: dt.date, end: dt.date, offer_end: dt.date | None = None,
    tops=(3, 4, 5),
) -> DataFrame:
    """Share of taxi journeys whose ETA-best driver is also among the nearest 3, 4 or 5.

    Only the nearest few and the best offer of each journey are kept, so a journey with very many
    offers is cut down before the shuffle.
    """
    taxis = filter_local_day(journeys, "journey_created_at", start, end).filter(
        in_codes("ref_vehicle_category_id", V.TAXI_CATEGORIES)
    ).select("journey_id", "pickup_latitude", "pickup_longitude")
    offers = offers.select(
        "journey_id", "driver_id", "attempt", "dispatch_order", "distance_from_pickup", "estimate_eta",
        "estimate_distance", "is_dispatched", "latitude", "longitude", "timestamp",
    )
    final = filter_local_day(offers, "timestamp", start, offer_end or end).filter(F.col("estimate_eta").isNotNull())
    hot = find_hot(offers, "journey_id")
    final = keep_max(final.distinct(), "journey_id", "attempt", hot)
    joined = lookup_join(final, taxis, "journey_id", "inner", hot).withColumn(
        "gap_m", sphere_distance("pickup_longitude", "pickup_latitude", "longitude", "latitude")
    )
    order = F.struct("estimate_eta", "estimate_distance", "driver_id")
    best = joined.groupBy("journey_id").agg(F.min_by("driver_id", order).alias("driver_id"))
    near = top_k(joined, "journey_id", ["gap_m", "driver_id", "estimate_eta", "estimate_distance"], max(tops), "dist_rank")
    met = best.join(near.select("journey_id", "driver_id", "dist_rank"), ["journey_id", "driver_id"], "left")
    sums = met.agg(
        F.countDistinct("journey_id").alias("total_journeys"),
        *[F.count(F.when(F.col("dist_rank") <= k, 1)).alias(f"_top{k}") for k in tops],
    )
    return sums.select(
        "total_journeys", *[safe_ratio(f"_top{k}", "total_journeys").alias(f"pct_eta1_in_top{k}") for k in tops]
    )
