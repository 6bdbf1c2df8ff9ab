"""Trip columns that several jobs share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.scalars import accepted_at, in_codes, peak_label, vehicle_class
from ..functions.time import (
    local_ts, minutes_between, seconds_between, week_start, weekday_name,
)
from ..operators.skew import lookup_join
from ..sources.tables import with_ticket_time


def completed() -> Column:
    return in_codes("journey_status", V.COMPLETED)


def with_local_time(df: DataFrame, ts: str = "journey_created_at") -> DataFrame:
    """Local time, date, hour and weekday of the request, and the trip's vehicle class."""
    return df.withColumn("local_ts", local_ts(F.col(ts))).withColumns({
        "local_date": F.to_date("local_ts"),
        "local_hour": F.hour("local_ts"),
        "weekday": weekday_name(F.col("local_ts")),
        "vehicle_cat": vehicle_class("ref_vehicle_category_id"),
    })


def with_trip_times(df: DataFrame) -> DataFrame:
    """Week, acceptance, arrival time in seconds, time to cancel, and ride minutes.

    The acceptance time is NULL-safe: a trip without it has NULL durations.
    """
    taken = accepted_at(F.col("vehicle_cat"))
    return df.withColumn("accepted_time", taken).withColumns({
        "booking_week": week_start(F.col("local_date")),
        "peak": peak_label("weekday", "local_hour"),
        "ata": seconds_between("accepted_time", "arrived_at_pickup_timestamp"),
        "cancel_time_sec": seconds_between("accepted_time", "journey_cancel_timestamp"),
        "jrny_time": minutes_between(F.col("arrived_at_pickup_timestamp"), F.col("journey_completed_timestamp")),
    })


def rating_per_journey(ratings: DataFrame, how: str = "one") -> DataFrame:
    """Ratings by journey: the best one, or all of them, which repeats trips rated twice."""
    if how == "all":
        return ratings.select("ref_journey_id", "rating")
    return ratings.groupBy("ref_journey_id").agg(F.max("rating").alias("rating"))


def rating_totals(ratings: DataFrame) -> DataFrame:
    """Sum and number of a journey's ratings: means over all ratings need no repeated trips."""
    return ratings.groupBy("ref_journey_id").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_n")
    )


def customers(users: DataFrame) -> DataFrame:
    return users.filter(F.col("usertype") == V.CUSTOMER_TYPE).withColumnsRenamed(
        {"_id": "ref_customer_id", "useruid": "customer_id"}
    )


def customer_tickets(tickets: DataFrame, users: DataFrame) -> DataFrame:
    """Tickets with the customer that owns the phone number; tickets of strangers are dropped."""
    owners = customers(users).filter(F.col("mobilenumber").isNotNull()).select(
        F.col("mobilenumber").alias("user_properties_phone_number"), "ref_customer_id", "customer_id"
    )
    return lookup_join(with_ticket_time(tickets), owners, "user_properties_phone_number", "inner")


def complaints(tickets: DataFrame, users: DataFrame) -> DataFrame:
    """One row per customer and complaint time."""
    return customer_tickets(tickets, users).select(
        "ref_customer_id", F.col("initiated_date").alias("complaint_ts")
    ).distinct()
