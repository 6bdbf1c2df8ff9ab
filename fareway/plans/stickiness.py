"""How often customers ride, and how many ride again after their n-th trip."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.scalars import safe_ratio
from ..functions.time import filter_local_day
from ..operators.ordered import Running, running
from .trips import completed, customers


def completed_trip_histogram(journeys: DataFrame, users: DataFrame, start: dt.date) -> DataFrame:
    """Customers per number of completed trips; customers without trips count as 0."""
    trips = filter_local_day(journeys, "journey_created_at", start, None)
    per_customer = trips.groupBy("ref_customer_id").agg(
        F.countDistinct(F.when(completed(), F.col("journey_id"))).alias("completed_jrny")
    )
    base = customers(users).select("ref_customer_id").join(per_customer, "ref_customer_id", "left")
    return (
        base.withColumn("completed_jrny", F.coalesce("completed_jrny", F.lit(0)))
        .groupBy("completed_jrny").agg(F.countDistinct("ref_customer_id").alias("customer_cnt"))
        .orderBy("completed_jrny")
    )


def _numbered_trips(journeys: DataFrame, start: dt.date) -> DataFrame:
    trips = filter_local_day(journeys, "journey_created_at", start, None).filter(completed())
    at = F.col("journey_created_at")
    return running(
        trips.select("ref_customer_id", "journey_id", "journey_created_at"),
        "ref_customer_id", ["journey_created_at", "journey_id"],
        Running(sums={"trip_number": F.lit(1).cast("long")}, leads={"next_trip": at}, mins={"first_trip": at}),
    )


def _retention(numbered: DataFrame, days: int) -> DataFrame:
    """Each customer has one row per trip number, so plain counts are distinct counts."""
    soon = F.col("next_trip") <= F.col("journey_created_at") + F.make_dt_interval(F.lit(days))
    return numbered.groupBy("trip_number").agg(
        F.count("ref_customer_id").alias("users_reached_n"),
        F.count(F.when(soon, F.col("ref_customer_id"))).alias("retained"),
    ).withColumn("retention_rate_next_30d", safe_ratio("retained", "users_reached_n"))


def retention_by_trip_number(journeys: DataFrame, start: dt.date, days: int = 30) -> DataFrame:
    """Share of customers who ride again within `days` of their n-th completed trip."""
    return _retention(_numbered_trips(journeys, start), days).select("trip_number", "retention_rate_next_30d")


def retention_in_first_days(journeys: DataFrame, start: dt.date, first_days: int = 90, days: int = 30) -> DataFrame:
    """The same over trips within `first_days` of each customer's first trip."""
    end = F.col("first_trip") + F.make_dt_interval(F.lit(first_days))
    numbered = _numbered_trips(journeys, start).filter(F.col("journey_created_at") <= end)
    numbered = numbered.withColumn("next_trip", F.when(F.col("next_trip") <= end, F.col("next_trip")))
    return _retention(numbered, days).select(
        "trip_number", "retention_rate_next_30d", "users_reached_n"
    ).orderBy("trip_number")
