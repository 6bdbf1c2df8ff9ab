"""Trip-level retention features with the label: does the customer request again within 30 days?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.geo import sphere_distance
from ..functions.scalars import bucketize, safe_ratio, shift_label, status_flag
from ..functions.time import days_between, filter_local_day, local_ts, minutes_between
from ..operators.ordered import Running, running
from ..operators.skew import Hot, find_hot
from ..operators.temporal import Source, add_counts_before, asof_many, count_within
from ..operators.zones import zone_join
from .trips import complaints, rating_per_journey, with_local_time

CUSTOMER = "ref_customer_id"
OUTCOMES = {
    "completed_trip": V.COMPLETED, "customer_cancelled": V.CUSTOMER_CANCELLED,
    "driver_cancelled": V.DRIVER_CANCELLED, "admin_cancelled": V.ADMIN_CANCELLED,
}


def customer_history(journeys: DataFrame, start: dt.date, end: dt.date, hot: Hot | None = None) -> DataFrame:
    """The requests of local days [start, end) with their number and the running outcome counts over all history, and the request
    before them within the range.

    What lies before `start` is one narrow sum per customer; only the rows of the range go through the ordered pass, and
    rows from `end` on are not read.
    """
    flags = [status_flag("journey_status", codes).alias(n) for n, codes in OUTCOMES.items()]
    flagged = filter_local_day(journeys, "journey_created_at", start, end).select(
        "journey_id", "ref_journey_id", CUSTOMER, "ref_vehicle_category_id", "journey_status", "journey_created_at",
        "accepted_ride_timestamp", "on_route_timestamp", "arrived_at_pickup_timestamp", "dispatch_eta",
        "pickup_latitude", "pickup_longitude", "actual_drop_off_latitude", "actual_drop_off_longitude",
        "estimate_drop_off_latitude", "estimate_drop_off_longitude", "estimate_total_fee", "actual_total_fee",
        "actual_distance", "ref_promo_applied", "payment_description", *flags,
    )
    one = F.lit(1).cast("long")
    sums = {"request_seq_num": one} | {f"cum_{n}": F.col(n).cast("long") for n in OUTCOMES}
    last = F.struct("journey_created_at", "ref_promo_applied", *OUTCOMES)
    counted = running(flagged, CUSTOMER, ["journey_created_at", "journey_id"], Running(sums=sums, lags={"_prev": last}), hot=hot)
    before = filter_local_day(journeys, "journey_created_at", None, start).select(CUSTOMER, *flags)
    return add_counts_before(counted, before, CUSTOMER, sums)


def trip_features(
    journeys: DataFrame, ratings: DataFrame, tickets: DataFrame, users: DataFrame, zones: DataFrame,
    start: dt.date, end: dt.date, with_completed_seq: bool = False, ratings_per_journey: str = "one",
) -> DataFrame:
    """One row per request of local days [start, end).

    Counts run over the whole history; the previous request and the label only look inside the range.
    """
    said = complaints(tickets, users)
    hot = find_hot([journeys, said], CUSTOMER)
    base = with_local_time(customer_history(journeys, start, end, hot))
    requests = filter_local_day(journeys, "journey_created_at", start, end).select(
        CUSTOMER, local_ts("journey_created_at").alias("_trip_at")
    )
    timed = asof_many(
        base,
        [Source(said, "complaint_ts", {"_complaint": F.col("complaint_ts")}),
         Source(requests, "_trip_at", {"_next_trip": F.col("_trip_at")}, strict=True)],
        CUSTOMER, "local_ts", "forward", hot=hot,
    )
    counted = count_within(timed, CUSTOMER, "local_ts", 30 * 60, "trips_in_next_30min", hot=hot)
    placed = zone_join(
        counted, zones, "pickup_longitude", "pickup_latitude", "geom", "name",
        {"pickup_hood": "name", "pickup_zone": "zone_name"},
    )
    rated = placed.join(rating_per_journey(ratings, ratings_per_journey), "ref_journey_id", "left")

    excess = F.col("actual_total_fee") - F.col("estimate_total_fee")
    price_error = F.try_divide(excess, F.nullif("estimate_total_fee", F.lit(0.0)))
    taken = F.when(F.col("vehicle_cat") == "Limo", F.col("accepted_ride_timestamp")).otherwise(F.col("on_route_timestamp"))
    charged = F.col("actual_total_fee").isNotNull()
    within = lambda c, hours: F.when(F.col(c) <= F.col("local_ts") + F.make_dt_interval(hours=F.lit(hours)), 1).otherwise(0)
    features = {
        "journey_ts": F.col("local_ts"), "journey_dt": F.col("local_date"), "local_booking_hr": F.col("local_hour"),
        "weekday": F.col("weekday"), "shift": shift_label("weekday", "local_hour"),
        **{n: F.col(n) for n in OUTCOMES},
        **{f"prev_{n}": F.col(f"_prev.{n}") for n in OUTCOMES},
    }
    if with_completed_seq:
        # the request's own number among the completed ones; NULL if it was not completed
        seq = F.when(F.col("completed_trip") == 1, F.col("cum_completed_trip"))
        features |= {"completed_trip_seq_num": seq, "prior_completed_trips": seq - 1}
    features |= {
        "time_since_last_trip_day": days_between(local_ts(F.col("_prev.journey_created_at")), F.col("local_ts")),
        "ref_promo_applied": F.col("ref_promo_applied"),
        "promo_applied_current_trip": F.when(F.col("ref_promo_applied").isNotNull(), 1).otherwise(0),
        "promo_used_last_trip": F.col("_prev.ref_promo_applied"),
        "payment_method": F.col("payment_description"),
        "estimate_total_fee": F.col("estimate_total_fee"), "actual_total_fee": F.col("actual_total_fee"),
        "price_error": price_error,
        "price_bucket": F.when(charged, F.when(excess <= 0, V.PRICE_LABELS[0]).otherwise(
            bucketize(price_error, V.PRICE_BOUNDS[1:], V.PRICE_LABELS[1:])
        )),
        "fee_bucket": F.when(charged, bucketize("actual_total_fee", V.FEE_BOUNDS, V.FEE_LABELS)),
        "drop_dist_m": sphere_distance(
            "estimate_drop_off_longitude", "estimate_drop_off_latitude", "actual_drop_off_longitude", "actual_drop_off_latitude"
        ),
        "actual_distance": F.col("actual_distance"), "dispatch_eta": F.col("dispatch_eta"),
        "ata_min": minutes_between(taken, F.col("arrived_at_pickup_timestamp")),
        "pickup_latitude": F.col("pickup_latitude"), "pickup_longitude": F.col("pickup_longitude"),
        "actual_drop_off_latitude": F.col("actual_drop_off_latitude"),
        "actual_drop_off_longitude": F.col("actual_drop_off_longitude"),
        "pickup_hood": F.col("pickup_hood"), "pickup_zone": F.col("pickup_zone"),
        "trips_in_next_30min": F.col("trips_in_next_30min"), "vehicle_cat": F.col("vehicle_cat"),
        "request_seq_num": F.col("request_seq_num"), "prior_requests": F.col("request_seq_num") - 1,
        "rating": F.col("rating"),
        "low_rating_lt4": F.when(F.col("rating") < 4, 1).otherwise(0),
        "low_rating_lt3": F.when(F.col("rating") < 3, 1).otherwise(0),
        "complaint_24h": within("_complaint", 24),
        "overall_completed_trips": F.col("cum_completed_trip"),
        **{f"overall_{n}_trips": F.col(f"cum_{n}") for n in list(OUTCOMES)[1:]},
        "overall_total_trips": F.col("request_seq_num"),
        **{f"overall_{who}_cancel_rate": safe_ratio(f"cum_{who}_cancelled", "request_seq_num")
           for who in ("customer", "driver", "admin")},
        "overall_completion_rate": safe_ratio("cum_completed_trip", "request_seq_num"),
        "retained_30d_label": within("_next_trip", 720),
    }
    return rated.select("journey_id", CUSTOMER, *[e.alias(n) for n, e in features.items()])
