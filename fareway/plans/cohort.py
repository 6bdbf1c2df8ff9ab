"""Customer cohorts by recency, spending, promotions, places and habits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.scalars import bucketize, count_segment, in_codes, journey_type, place_type, ratio_segment, safe_ratio
from ..functions.time import day_of_week, days_between, filter_local_day, iso_week, iso_year_week, monday, month_start, week_start
from ..operators.aggregates import any_flag, avg_if, count_if, exact_percentile
from ..operators.zones import zone_join_many
from .trips import completed, customers, with_local_time

NIGHT = (21, 22, 23, 0, 1, 2, 3)
WEEKEND_DAYS = (0, 6)
PLACE_TRIPS = {"mall": "Mall_Goer", "school": "School_Route", "college": "College_Route",
               "airport": "Airport_Traveler", "metro": "Metro_Route"}

# Promotion labels by the share of requests with a promotion.
PROMO_FIXED = (
    (lambda r: r >= 0.8, "Promo_Heavy_User"), (lambda r: r.between(0.3, 0.8), "Promo_Balanced_User"),
    (lambda r: (r < 0.3) & (r > 0), "Occasional_Promo_User"), (lambda r: r == 0, "Non_Promo_User"),
)
PROMO_WEEKLY = (
    (lambda r: r == 1, "100_percent_promo_user"), (lambda r: (r >= 0.8) & (r < 1), "Promo_Heavy_User_80_perc"),
    (lambda r: r.between(0.3, 0.8), "Promo_Balanced_User_30_80_perc"),
    (lambda r: (r < 0.3) & (r > 0), "Occasional_Promo_User_less_than_30_perc"), (lambda r: r == 0, "Non_Promo_User"),
)
# Lifecycle labels by completed trips.
CASUAL_FIXED = ((2, 9, "Casual_User"),)
CASUAL_WEEKLY = ((2, 5, "Casual_User_2_5"), (6, 9, "Casual_User_6_9"))
CONSISTENCY = ((8, None, "Consistent_Weekly_User"), (4, 7, "Occasional_User"), (1, 3, "Infrequent_User"))


def journey_places(journeys: DataFrame, zones: DataFrame) -> DataFrame:
    """Journeys with the place type at both ends and the journey type."""
    out = journeys
    out = zone_join_many(out, zones, [
        ("pickup_longitude", "pickup_latitude", {"pickup_zone_found": "name"}),
        ("actual_drop_off_longitude", "actual_drop_off_latitude", {"drop_zone_found": "name"}),
    ], "geom", "name")
    out = out.withColumns({
        "pickup_type": place_type("pickup_zone_found", "pickup_location"),
        "drop_type": place_type("drop_zone_found", "drop_off_location"),
    })
    return out.withColumn("journey_type_flag", journey_type("pickup_type", "drop_type"))


def customer_activity(trips: DataFrame, year_week: bool = False) -> DataFrame:
    """One aggregate per customer. Journeys are unique, so sums are distinct counts."""
    hour, dow = F.col("local_hour"), day_of_week(F.col("local_ts"))
    week = iso_year_week(F.col("local_ts")) if year_week else iso_week(F.col("local_ts"))
    taxi = in_codes("ref_vehicle_category_id", V.TAXI_CATEGORIES)
    spent = F.col("actual_total_fee")
    counted = {
        "total_jrny_request": F.lit(True), "completed_jrny": completed(),
        "user_cancelled_jrny": in_codes("journey_status", V.CUSTOMER_CANCELLED),
        "jrny_request_with_promo": F.col("ref_promo_applied").isNotNull(),
        "morning_trips": hour.between(6, 10), "evening_trips": hour.between(14, 20),
        "night_trips": hour.isin(*NIGHT), "weekend_trips": dow.isin(*WEEKEND_DAYS),
        "taxi_request": taxi, "limo_request": ~taxi,
    } | {f"{k}_trips": F.col("journey_type_flag") == label for k, label in PLACE_TRIPS.items()}
    return trips.groupBy("ref_customer_id").agg(
        F.countDistinct(week).alias("active_weeks"),
        F.min("local_date").alias("first_jrny_date"), F.max("local_date").alias("last_jrny_date"),
        F.avg("actual_distance").alias("avg_trip_distance"), F.avg(spent).alias("avg_actual_fee"),
        F.avg("estimate_total_fee").alias("avg_estimated_fee"),
        F.sum(spent).alias("actual_total_fee"), F.sum("actual_discount_amount").alias("total_discount_amount"),
        F.sum(spent - F.col("actual_discount_amount")).alias("total_fare_after_discount"),
        F.stddev_samp(spent).alias("stddev_trip_cost"),
        avg_if(F.col("estimate_total_fee") - spent, completed()).alias("avg_fee_diff"),
        *[count_if(c).alias(n) for n, c in counted.items()],
    )


def customer_cohort(
    journeys: DataFrame, users: DataFrame, zones: DataFrame, as_of: dt.date, variant: str = "fixed",
    cutoff: dt.date | None = None, registered_since: dt.date | None = None, year_week: bool = False,
) -> DataFrame:
    """One row per customer with counts, spending and segments.

    `fixed` takes journeys before `cutoff` and customers registered since a date; `weekly` takes
    closed weeks and all customers, has finer labels, and adds first active week and month.
    """
    weekly = variant == "weekly"
    trips = filter_local_day(journeys, "journey_created_at", None, monday(as_of) if weekly else cutoff)
    trips = trips.select(
        "journey_id", "ref_customer_id", "ref_vehicle_category_id", "journey_status", "journey_created_at",
        "pickup_longitude", "pickup_latitude", "actual_drop_off_longitude", "actual_drop_off_latitude",
        "pickup_location", "drop_off_location", "actual_distance", "estimate_total_fee", "actual_total_fee",
        "actual_discount_amount", "ref_promo_applied",
    )
    fares = exact_percentile(trips.filter(completed()), "ref_customer_id", "actual_total_fee", 0.7, "fare_p70")
    done = trips.filter(completed()).select("ref_customer_id").distinct()
    base = customers(users)
    if not weekly and registered_since is not None:
        base = base.filter(F.col("createdat") >= F.lit(registered_since).cast("timestamp"))
    stats = customer_activity(with_local_time(journey_places(trips, zones)), year_week)
    rows = base.join(stats, "ref_customer_id", "left").join(
        done.join(fares, "ref_customer_id", "left").withColumn("_priced", F.lit(True)), "ref_customer_id", "left"
    )
    return _segments(rows, as_of, weekly)


def _segments(rows: DataFrame, as_of: dt.date, weekly: bool) -> DataFrame:
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    total = F.col("total_jrny_request")
    part = lambda c: safe_ratio(c, total)
    idle_days = days_between(F.col("last_jrny_date"), F.lit(as_of))
    commuter = (part(F.col("morning_trips") + F.col("evening_trips")) >= 0.6) & (part("weekend_trips") < 0.4)
    weekender = part("weekend_trips") >= 0.6
    life = F.when(total == 0, "Acquired_No_Trip").when((total > 0) & (F.col("completed_jrny") == 0), "Attempted_but_0_fulfilled")
    life = life.when(F.col("completed_jrny") == 1, "Single_Completed_Trip_User")
    for low, high, label in CASUAL_WEEKLY if weekly else CASUAL_FIXED:
        life = life.when(F.col("completed_jrny").between(low, high), label)
    life = life.when(F.col("completed_jrny") >= 10, "Power_User").otherwise("Unknown")
    p70 = F.col("fare_p70")
    cancel = F.round(F.coalesce(part("user_cancelled_jrny"), F.lit(0.0)), 3)
    none = n("total_jrny_request") == 0
    distance = n("avg_trip_distance")

    out: dict[str, Column] = {
        "local_flag": F.when(F.col("countrycode").contains("+971"), 1).otherwise(0),
        "fare_segment": F.when(
            F.col("_priced"),
            F.when(p70 < 40, "Low-Fare Oriented").when(p70.between(40, 70), "Mid-Fare Majority").otherwise("High-Fare Oriented"),
        ),
        "promo_usage_segment": F.when(none, "No_Request").otherwise(
            ratio_segment(n("jrny_request_with_promo"), total, PROMO_WEEKLY if weekly else PROMO_FIXED, "Unknown")
        ),
        "recency_days": idle_days,
        "cancellation_ratio": cancel,
        "recency_flag": F.when(F.col("first_jrny_date").isNull(), V.NEVER_ACTIVE).otherwise(
            bucketize(idle_days, V.RECENCY_BOUNDS, V.RECENCY_LABELS)
        ),
        "lifecycle_segment": life,
        "primary_user_type": F.when(commuter, "Commuter").when(weekender, "Weekend").otherwise("General_Purpose"),
        "sub_user_type": F.when(
            commuter,
            F.when(part("metro_trips") >= 0.5, "Metro_User").when(part("school_trips") >= 0.5, "School_User")
            .when(part("college_trips") >= 0.5, "College_User").otherwise("Othercommuters"),
        ).when(
            weekender,
            F.when(part("mall_trips") >= 0.5, "Mall_User").when(part("night_trips") >= 0.5, "Night_User")
            .otherwise("Daytime_Leisure_User"),
        ).otherwise("General_Purpose"),
        "distance_segment": F.when(distance >= 25, "Long_Haul_User").when(distance.between(8, 25), "Mid_Range_User")
        .when((distance < 8) & (distance > 0), "Short_Haul_User").otherwise("No_Journey"),
        "service_mix_segment": F.when(none, "No_Request").when(part("taxi_request") >= 0.7, "Taxi_User")
        .when(part("limo_request") >= 0.7, "Limo_User").otherwise("Others"),
        "cancellation_behavior_segment": F.when(none, "No_Request").when(cancel > 0.4, "High_Canceller")
        .when(cancel.between(0.2, 0.4), "Moderate_Canceller").when(cancel < 0.2, "Low_Canceller").otherwise("No_Data"),
    }
    extra = ["recency_bucket", "first_active_week", "first_active_month", "registration_date"] if weekly else ["consistency_segment"]
    if weekly:
        out |= {
            "recency_bucket": F.when(F.col("last_jrny_date").isNull(), V.NEVER_ACTIVE).otherwise(
                bucketize(idle_days, V.RECENCY_BUCKET_BOUNDS, V.RECENCY_BUCKET_LABELS)
            ),
            "first_active_week": week_start(F.col("first_jrny_date")),
            "first_active_month": month_start(F.col("first_jrny_date")),
            "registration_date": F.col("createdat"),
        }
    else:
        out["consistency_segment"] = count_segment("active_weeks", CONSISTENCY, "Inactive")
    zeroed = [
        "actual_total_fee", "total_fare_after_discount", "total_discount_amount", "completed_jrny", "total_jrny_request",
        "active_weeks", "taxi_request", "limo_request", "avg_trip_distance", "avg_fee_diff", "avg_actual_fee",
        *[f"{k}_trips" for k in PLACE_TRIPS], "morning_trips", "evening_trips", "night_trips", "weekend_trips",
    ]
    return rows.select(
        "ref_customer_id", "customer_id", "name", "countrycode", "mobilenumber", "emailid", "fare_p70",
        "first_jrny_date", "last_jrny_date", n("user_cancelled_jrny").alias("cancelled_jrny"),
        *[n(c).alias(c) for c in zeroed], *[e.alias(c) for c, e in out.items()],
    ).select(
        "ref_customer_id", "customer_id", "name", "countrycode", "mobilenumber", "emailid", "local_flag", "fare_segment",
        "fare_p70", *zeroed, "cancelled_jrny", "first_jrny_date", "last_jrny_date",
        *[c for c in out if c not in ("local_flag", "fare_segment", *extra)], *extra,
    )


def segment_rollup(cohort: DataFrame) -> DataFrame:
    """Customers, trips and spending per user type and sub-type."""
    return cohort.groupBy("primary_user_type", "sub_user_type").agg(
        F.countDistinct("ref_customer_id").alias("customer_count"),
        *[F.sum(c).alias(c) for c in (
            "completed_jrny", "total_jrny_request", "actual_total_fee", "total_fare_after_discount", "total_discount_amount"
        )],
    )
