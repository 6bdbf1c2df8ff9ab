"""Effect of a fare above the estimate on ratings, complaints and return."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.geo import sphere_distance
from ..functions.scalars import bucketize
from ..functions.time import filter_local_day, local_ts
from ..operators.ordered import prior_count
from ..operators.skew import find_hot
from ..operators.temporal import Source, add_counts_before, asof_many
from .trips import complaints, completed, rating_per_journey

def mispriced_trips(
    journeys: DataFrame, ratings: DataFrame, tickets: DataFrame, users: DataFrame,
    start: dt.date, end: dt.date, history_end: dt.date, max_drop_m: float = 50.0,
    ratings_per_journey: str = "one",
) -> DataFrame:
    """Completed trips of local days [start, end) that ended where they were estimated to end.

    Experience counts all completed trips up to the local day `history_end` (inclusive).
    """
    history = filter_local_day(journeys, "journey_created_at", None, history_end + dt.timedelta(days=1)).filter(completed())
    history = history.select(
        "journey_id", "ref_journey_id", "ref_customer_id", "journey_created_at",
        "estimate_drop_off_longitude", "estimate_drop_off_latitude", "actual_drop_off_longitude", "actual_drop_off_latitude",
        "estimate_total_fee", "actual_total_fee",
    )
    said = complaints(tickets, users)
    hot = find_hot([journeys, said], "ref_customer_id")
    inside = filter_local_day(history, "journey_created_at", start, end)
    counted = prior_count(inside, "ref_customer_id", ["journey_created_at", "journey_id"], "prior_completed_trips", hot=hot)
    # trips before the range are one narrow count per customer
    before = filter_local_day(history, "journey_created_at", None, start).select("ref_customer_id")
    trips = add_counts_before(counted, before, "ref_customer_id", {"prior_completed_trips": F.lit(1).cast("long")}).withColumns({
        "local_ts": local_ts("journey_created_at"),
        "drop_dist_m": sphere_distance(
            "estimate_drop_off_longitude", "estimate_drop_off_latitude", "actual_drop_off_longitude", "actual_drop_off_latitude"
        ),
        "price_error": F.try_divide(F.col("actual_total_fee") - F.col("estimate_total_fee"), F.nullif("estimate_total_fee", F.lit(0.0))),
    }).filter((F.col("drop_dist_m") <= max_drop_m) & (F.col("estimate_total_fee") > 0))

    later = filter_local_day(journeys, "journey_created_at", start, None).filter(completed()).select(
        "ref_customer_id", local_ts("journey_created_at").alias("_trip_at")
    )
    near = asof_many(
        trips,
        [Source(said, "complaint_ts", {"_complaint": F.col("complaint_ts")}),
         Source(later, "_trip_at", {"_next_trip": F.col("_trip_at")}, strict=True)],
        "ref_customer_id", "local_ts", "forward", hot=hot,
    )
    rated = near.join(rating_per_journey(ratings, ratings_per_journey), "ref_journey_id", "left")
    within = lambda c, hours: F.when(F.col(c) <= F.col("local_ts") + F.make_dt_interval(hours=F.lit(hours)), 1).otherwise(0)
    return rated.withColumns({
        "price_bucket": bucketize("price_error", V.PRICE_BOUNDS, V.IMPACT_PRICE_LABELS),
        "actual_fee_bkt": F.when(
            F.col("actual_total_fee").isNotNull(), bucketize("actual_total_fee", V.FEE_BOUNDS, V.IMPACT_FEE_LABELS)
        ),
        "experience_cohort": bucketize("prior_completed_trips", V.EXPERIENCE_BOUNDS, V.EXPERIENCE_LABELS),
        "low_rating_lt3": F.when(F.col("rating") < 3, 1).otherwise(0),
        "low_rating_lt4": F.when(F.col("rating") < 4, 1).otherwise(0),
        "has_complaint_24h": within("_complaint", 24),
        "retained_30d": within("_next_trip", 720),
    }).drop("_complaint", "_next_trip")


FLAGS = {
    "retained_30d": "retained_30d", "low_rating_lt3": "rating_lt3", "low_rating_lt4": "rating_lt4",
    "has_complaint_24h": "complaint_24h",
}


def impact_by_customer(trips: DataFrame) -> DataFrame:
    """Per price, experience and fare bucket: customers, and how many of them show each flag."""
    keys = ["price_bucket", "experience_cohort", "actual_fee_bkt"]
    per_customer = trips.groupBy("ref_customer_id", *keys).agg(*[F.max(c).alias(c) for c in FLAGS])
    return per_customer.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_customers"),
        *[F.sum(c).alias(f"{name}_customers") for c, name in FLAGS.items()],
    ).orderBy(*keys)


def impact_by_trip(trips: DataFrame) -> DataFrame:
    """Per price and experience bucket: trips, mean price error and share of trips with each flag."""
    keys = ["price_bucket", "experience_cohort"]
    return trips.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("mispriced_trips"), F.avg("price_error").alias("avg_price_error"),
        *[F.avg(c).alias(f"{name}_share") for c, name in FLAGS.items()],
    ).orderBy(*keys)
