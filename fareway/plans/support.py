"""Return behaviour after the first support ticket."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.scalars import bucketize, safe_ratio
from ..functions.time import filter_local_day, local_ts
from ..operators.skew import find_hot
from ..operators.temporal import before_after
from .trips import completed, customer_tickets


def first_tickets(tickets: DataFrame, users: DataFrame, until: dt.date) -> DataFrame:
    """The earliest ticket of each customer, up to the midnight that begins `until`."""
    owned = customer_tickets(tickets, users).filter(F.col("initiated_date") <= F.lit(until).cast("timestamp"))
    return owned.groupBy("ref_customer_id", "customer_id").agg(F.min("initiated_date").alias("initiated_date"))


def ticket_behaviour(tickets: DataFrame, users: DataFrame, journeys: DataFrame, until: dt.date, as_of: dt.date) -> DataFrame:
    """Per customer with a ticket: journeys before and after it."""
    first = first_tickets(tickets, users, until)
    trips = filter_local_day(journeys, "journey_created_at", None, as_of).select(
        "ref_customer_id", "journey_id", "journey_status", "ref_promo_applied",
        local_ts("journey_created_at").alias("local_ts"),
    )
    promo = completed() & F.col("ref_promo_applied").isNotNull()
    return before_after(
        first, trips, "ref_customer_id", "initiated_date", "local_ts", "journey_id",
        before={"completed_before": completed(), "total_before": F.lit(True)},
        after={"trips_after": F.lit(True), "completed_after": completed(), "completed_after_promo": promo},
        hot=find_hot(journeys, "ref_customer_id"),
    )


def return_after_ticket(behaviour: DataFrame) -> DataFrame:
    """Per category of earlier experience: customers, those who returned, and the part of promotions."""
    rows = behaviour.withColumn(
        "pre_ticket_category", bucketize("completed_before", V.PRE_TICKET_BOUNDS, V.PRE_TICKET_LABELS)
    )
    # behaviour has one row per customer, so plain counts are counts of customers
    customers_if = lambda c: F.count(F.when(c, F.col("ref_customer_id")))
    back, promo = F.col("completed_after") > 0, F.col("completed_after_promo") > 0
    sums = rows.groupBy("pre_ticket_category").agg(
        F.count("ref_customer_id").alias("total_customers"),
        customers_if(back).alias("returned_customers"),
        customers_if(promo).alias("returned_customer_with_promo"),
        customers_if(promo & back).alias("_both"),
        F.sum("completed_after").alias("_trips"), F.sum("completed_after_promo").alias("_promo_trips"),
    )
    return sums.select(
        "pre_ticket_category", "total_customers", "returned_customers",
        F.round(safe_ratio("returned_customers", "total_customers"), 3).alias("return_rate_post_ticket"),
        safe_ratio("_promo_trips", "_trips").alias("perc_trips_with_promo"),
        "returned_customer_with_promo",
        safe_ratio("_both", "returned_customers").alias("returned_customer_with_promo_rate"),
    ).orderBy("pre_ticket_category")
