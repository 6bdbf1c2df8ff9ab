"""What happens around one booking: fare view before it, change of place after it, campaign message."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.geo import sphere_distance
from ..functions.scalars import change_label, in_codes, json_text
from ..functions.time import day_of_week, filter_local_day
from ..operators.temporal import asof_within, match_latest_left, next_within
from .trips import completed, with_local_time


def view_to_pickup_distance(
    journeys: DataFrame, fare_views: DataFrame, start: dt.date, end: dt.date, minutes: int = 15,
    digits: int | None = None,
) -> DataFrame:
    """Histogram of metres between the last fare view (at most `minutes` before) and the booked pickup.

    `digits` rounds the distance, so that the histogram has bins.
    """
    base = filter_local_day(journeys, "journey_created_at", start, end).filter(
        F.col("ref_parent_journey_id").isNull()
    ).select("journey_id", "customer_id", "journey_created_at", "pickup_latitude", "pickup_longitude")
    views = filter_local_day(fare_views, "timestamp", start, None).select(
        F.col("customerid").alias("customer_id"), "timestamp", "routes",
        json_text("routes", 0, "lat").try_cast("double").alias("lat"),
        json_text("routes", 0, "lng").try_cast("double").alias("lng"),
    )
    last = asof_within(
        base, views, "customer_id", "journey_created_at", "timestamp",
        {"lat": F.col("lat"), "lng": F.col("lng")}, seconds=60 * minutes, tie="routes",
    )
    metres = sphere_distance("pickup_longitude", "pickup_latitude", "lng", "lat")
    if digits is not None:
        metres = F.round(metres, digits)
    return last.groupBy(metres.alias("distance_mtr")).agg(F.countDistinct("journey_id").alias("jrny_cnt"))


def location_change_pairs(
    journeys: DataFrame, start: dt.date, end: dt.date, minutes: int = 10, nearest_only: bool = False
) -> DataFrame:
    """Completed journeys paired with the customer's latest cancelled one at most `minutes` before."""
    base = filter_local_day(journeys, "journey_created_at", start, end).filter(F.col("journey_type") == 1).select(
        "customer_id", "journey_id", "journey_status", "journey_created_at", "pickup_longitude", "pickup_latitude",
        "estimate_drop_off_longitude", "estimate_drop_off_latitude",
    )
    done = base.filter(completed()).withColumnRenamed("journey_id", "completed_jrny").drop("journey_status")
    cancelled = base.filter(in_codes("journey_status", V.CUSTOMER_CANCELLED))
    carried = {
        "cancelled_jrny": F.col("journey_id"),
        "c_pickup_lon": F.col("pickup_longitude"), "c_pickup_lat": F.col("pickup_latitude"),
        "c_drop_lon": F.col("estimate_drop_off_longitude"), "c_drop_lat": F.col("estimate_drop_off_latitude"),
    }
    pairs = match_latest_left(
        cancelled.withColumnRenamed("journey_created_at", "cancelled_at").withColumn("cancelled_jrny", F.col("journey_id")),
        done.withColumnRenamed("journey_created_at", "completed_at"),
        "customer_id", "cancelled_at", "completed_at", carried, 60 * minutes, nearest_only,
        left_id="cancelled_jrny", right_id="completed_jrny",
    )
    pairs = pairs.withColumns({
        "pickup_distance_mtr": sphere_distance("c_pickup_lon", "c_pickup_lat", "pickup_longitude", "pickup_latitude"),
        "drop_distance_mtr": sphere_distance(
            "c_drop_lon", "c_drop_lat", "estimate_drop_off_longitude", "estimate_drop_off_latitude"
        ),
    })
    return pairs.withColumn("location_change_flag", change_label("pickup_distance_mtr", "drop_distance_mtr"))


def location_change_after_cancel(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("location_change_flag").agg(F.countDistinct("cancelled_jrny").alias("jrny_cnt"))


def message_matches(
    journeys: DataFrame, messages: DataFrame, start: dt.date, end: dt.date, hours=(16, 17, 18, 19, 20),
    weekend=(0, 6), seconds: int = 60,
) -> DataFrame:
    """Weekday peak trips with the first message delivered at most `seconds` after the request."""
    sent = messages.filter(F.col("`profile.identity`").isNotNull()).select(
        F.col("`profile.identity`").alias("customer_id"), F.col("event_dt_dubai"),
        F.col("`eventprops.journey id`").alias("message_journey"),
    ).distinct()
    base = with_local_time(filter_local_day(journeys, "journey_created_at", start, end)).select(
        "journey_id", "customer_id", "journey_status", "local_ts", "local_date", "local_hour",
        day_of_week(F.col("local_ts")).alias("dow"),
    ).filter(F.col("local_hour").isin(*hours) & ~F.col("dow").isin(*weekend))
    return next_within(
        base, sent, "customer_id", "local_ts", "event_dt_dubai", {"message_journey": F.col("message_journey")},
        seconds, tie="message_journey",
    )


def message_rollup(matches: DataFrame) -> DataFrame:
    """Trips, customers and outcome with and without a delivered message."""
    flag = F.when(F.col("matched_at").isNotNull(), "Delivered").otherwise("Not_delivered")
    return matches.groupBy(flag.alias("flg")).agg(
        F.countDistinct("journey_id").alias("jrny_cnt"),
        F.countDistinct("customer_id").alias("customer_cnt"),
        F.count(F.when(completed(), F.col("journey_id"))).alias("completed_jrny"),
        F.count(F.when(in_codes("journey_status", V.CUSTOMER_CANCELLED), F.col("journey_id"))).alias("customer_cancelled_jrny"),
    )
