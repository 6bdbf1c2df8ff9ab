"""Customer-week features over the 14 days before each Monday, with the label: active in the next 30 days?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.scalars import safe_ratio, status_flag
from ..functions.time import filter_local_day, minutes_between
from ..operators.digest import over_weeks, week_digest, with_week_after
from .trips import with_local_time

CUSTOMER = "ref_customer_id"


def request_facts(journeys: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    base = with_local_time(filter_local_day(journeys, "journey_created_at", start, end))
    taken = F.when(F.col("vehicle_cat") == "Limo", F.col("accepted_ride_timestamp")).otherwise(F.col("on_route_timestamp"))
    return base.select(
        "journey_id", CUSTOMER, "customer_id", "local_date", "local_hour", "weekday", "vehicle_cat",
        "dispatch_eta", "estimate_total_fee", "actual_total_fee", "actual_distance", "ref_promo_applied",
        "payment_description",
        status_flag("journey_status", V.COMPLETED).alias("done"),
        status_flag("journey_status", V.CUSTOMER_CANCELLED).alias("customer_cancelled"),
        status_flag("journey_status", V.DRIVER_CANCELLED).alias("driver_cancelled"),
        status_flag("journey_status", V.ADMIN_CANCELLED).alias("admin_cancelled"),
        minutes_between(taken, F.col("arrived_at_pickup_timestamp")).alias("ata_min"),
    )


def weekly_churn_features(journeys: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """One row per customer and week. Weeks without trips in the window have counts and shares of 0 and no means."""
    facts = request_facts(journeys, start, end)
    done = F.col("done") == 1
    work_day = F.col("weekday").isin(*V.WEEKDAYS)
    weekend = F.col("weekday").isin(*V.WEEKEND)
    hour, ata, eta = F.col("local_hour"), F.col("ata_min"), F.col("dispatch_eta")
    gap = F.abs(F.col("actual_total_fee") - F.col("estimate_total_fee"))
    pay = F.col("payment_description")
    counts = {
        "completed_journeys_14d": done, "customer_cancelled_14d": F.col("customer_cancelled") == 1,
        "driver_cancelled_14d": F.col("driver_cancelled") == 1, "admin_cancelled_14d": F.col("admin_cancelled") == 1,
        "taxi_rides_14d": F.col("vehicle_cat") == "Taxi", "limo_rides_14d": F.col("vehicle_cat") == "Limo",
        "evening_peak_rides_14d": work_day & hour.between(15, 19),
        "morning_peak_rides_14d": work_day & hour.between(7, 9),
        "weekend_rides_14d": weekend, "weekday_rides_14d": ~weekend,
    }
    shares = {
        "share_trips_with_promo_14d": F.col("ref_promo_applied").isNotNull(),
        "share_trips_card_14d": ~pay.contains("CASH"), "share_trips_cash_14d": F.upper(pay).contains("CASH"),
        **{f"share_trips_fare_diff_gt_{n}_14d": (gap > n) & done for n in (5, 10, 15)},
        "share_trips_ata_lt_3_14d": (ata <= 3) & done, "share_trips_ata_gt_3_14d": (ata > 3) & done,
        "share_trips_etta_lt_3_14d": eta <= 3, "share_trips_eta_gt_3_14d": eta > 3,
        "share_trips_ata_gt_eta_by_2m_14d": (ata - eta > 2) & done,
    }
    means = {
        "avg_eta_14d": F.when(eta != 0, eta), "avg_estimated_fare_14d": F.col("estimate_total_fee"),
        "avg_distance_14d": F.col("actual_distance"), "avg_ata_14d": ata.cast("double"),
    }
    one = lambda c: F.when(c, 1).otherwise(0)
    aggs = {"total_journeys_14d": one(F.col("journey_id").isNotNull()), "_rows": F.lit(1)}
    aggs |= {n: one(c) for n, c in (counts | shares).items()}
    aggs |= {f"_sum_{n}": e for n, e in means.items()} | {f"_n_{n}": one(e.isNotNull()) for n, e in means.items()}

    # the weeks in which a customer asked for a trip, and the week after the last one
    weekly = with_week_after(week_digest(facts, CUSTOMER, "local_date", aggs, also=["customer_id"]), CUSTOMER, ["customer_id"])
    rows = over_weeks(weekly, CUSTOMER, sums=list(aggs), active={"y_retained_next_30d": 30}, prior="prior_requests_all_time")
    zero = lambda e: F.coalesce(e, F.lit(0))
    order = [
        "total_journeys_14d", *counts, "avg_eta_14d", "avg_estimated_fare_14d", "avg_distance_14d",
        *list(shares)[:6], "avg_ata_14d", *list(shares)[6:],
    ]
    value = lambda n: (
        safe_ratio(f"_sum_{n}", f"_n_{n}") if n in means
        else F.coalesce(safe_ratio(n, "_rows"), F.lit(0.0)) if n in shares else zero(F.col(n))
    )
    return rows.select(
        "week_start", CUSTOMER, "customer_id", *[value(n).alias(n) for n in order],
        "prior_requests_all_time", "y_retained_next_30d",
    )
