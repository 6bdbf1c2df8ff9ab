"""Dispatch by a blend of ETA and driver score."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.scalars import bucketize, in_codes, outlier_label, priority_label
from ..functions.time import filter_local_day
from ..operators.aggregates import count_distinct_if, distinct_sums
from ..operators.dedupe import keep_max, minmax_score
from ..operators.ordered import seq_num
from ..operators.skew import find_hot, lookup_join
from ..sources.sinks import snapshot_asof
from .trips import completed

# what tells offers apart; an offer that is logged with two actions is one
OFFER = [
    "journey_id", "driver_id", "attempt", "dispatch_order", "distance_from_pickup", "estimate_eta", "estimate_distance", "is_dispatched", "timestamp",
]
TIE = ["driver_id", "dispatch_order", "timestamp"]


def blended_offers(
    journeys: DataFrame, offers: DataFrame, scores: DataFrame, start: dt.date, end: dt.date, score_date: dt.date,
    weights=V.DISPATCH_WEIGHTS,
) -> DataFrame:
    """Final-attempt offers of taxi journeys with their rank by ETA and by the blended score.

    `start` and `end` are inclusive local days of the journeys; offers are taken by their own
    (unshifted) time from `start` to the midnight that begins `end`. A driver without a score has
    no blend and, as NULL sorts as the largest value, ranks first.
    """
    taxis = filter_local_day(journeys, "journey_created_at", start, end + dt.timedelta(days=1)).filter(
        F.col("ref_driver_id").isNotNull() & in_codes("ref_vehicle_category_id", V.TAXI_CATEGORIES)
    ).select("journey_id", F.col("ref_driver_id").alias("driver_assigned"), "journey_status")
    base = offers.filter(
        (F.col("timestamp") >= F.lit(start).cast("timestamp")) & (F.col("timestamp") <= F.lit(end).cast("timestamp"))
        & F.col("estimate_eta").isNotNull()
    ).select(*OFFER)
    hot = find_hot(offers, "journey_id")
    # steps by journey come first and share one partitioning; only the final attempt is made distinct
    final = keep_max(base, "journey_id", "attempt", hot).distinct()
    scaled = minmax_score(final, "journey_id", "estimate_eta", "eta_score", invert=True, hot=hot)
    given = lookup_join(scaled, taxis, "journey_id", "inner", hot)
    picked = snapshot_asof(scores, score_date, ["ref_driver_id", "final_score"]).withColumnRenamed("ref_driver_id", "driver_id")
    blend = sum((F.lit(w) * F.col(c) for c, w in weights.items()), F.lit(0.0))
    scored = lookup_join(given, picked, "driver_id", hot=find_hot(offers, "driver_id")).withColumn("dispatch_score", blend)
    by_eta = seq_num(scored, "journey_id", ["estimate_eta", "estimate_distance", *TIE], "eta_rank", hot=hot)
    return seq_num(by_eta, "journey_id", ["-dispatch_score", "estimate_eta", *TIE], "dispatch_rank", hot=hot)


def assigned(blended: DataFrame) -> DataFrame:
    """The offers made to the driver who got the journey."""
    return blended.filter(F.col("driver_id") == F.col("driver_assigned")).withColumn("dat", F.to_date("timestamp"))


def rank_distribution(blended: DataFrame) -> DataFrame:
    return assigned(blended).groupBy("dat", "dispatch_rank").agg(F.countDistinct("journey_id").alias("jrny_cnt"))


def outcome_by_priority(blended: DataFrame) -> DataFrame:
    """Journeys per day and priority label with their outcome, and the mean ETA and score of the offers."""
    rows = assigned(blended).withColumn("flg", priority_label("dispatch_rank", "eta_rank"))
    keys = ["dat", "flg"]
    counts = distinct_sums(rows, keys, "journey_id", {
        "jrny_cnt": F.lit(True),
        "completed_jrny": completed(),
        "customer_cancelled": in_codes("journey_status", V.CUSTOMER_CANCELLED),
        "driver_cancelled": in_codes("journey_status", V.DRIVER_CANCELLED),
    })
    means = rows.groupBy(*keys).agg(F.avg("estimate_eta").alias("avg_eta"), F.avg("final_score").alias("final_score"))
    return counts.join(means, keys).orderBy("dat", "flg")


def outlier_journeys(blended: DataFrame, since: dt.date) -> DataFrame:
    """Journeys from `since` on whose assigned driver was neither best by ETA nor by blend, or only by ETA."""
    rows = assigned(blended).withColumn("flag", outlier_label("dispatch_rank", "eta_rank"))
    odd = F.col("flag").isNull() | (F.col("flag") == "ETA_priortised")
    return rows.filter((F.col("timestamp") >= F.lit(since).cast("timestamp")) & odd).select("journey_id").distinct()


def outcome_by_score_bucket(journeys: DataFrame, scores: DataFrame, start: dt.date, end: dt.date, score_date: dt.date) -> DataFrame:
    """Taxi journeys per score bucket of their driver; NULL bucket for drivers without a score."""
    trips = filter_local_day(journeys, "journey_created_at", start, end + dt.timedelta(days=1)).filter(
        F.col("ref_driver_id").isNotNull() & in_codes("ref_vehicle_category_id", V.TAXI_CATEGORIES)
    )
    picked = snapshot_asof(scores, score_date, ["ref_driver_id", "final_score"])
    rows = lookup_join(trips.select("journey_id", "ref_driver_id", "journey_status"), picked, "ref_driver_id")
    rows = rows.withColumn("score", bucketize("final_score", V.SCORE_BOUNDS, V.SCORE_LABELS))
    counts = distinct_sums(rows, ["score"], "journey_id", {
        "jrny_cnt": F.lit(True),
        "customer_cancelled_jrny": in_codes("journey_status", V.CUSTOMER_CANCELLED),
        "driver_cancelled_jrny": in_codes("journey_status", V.DRIVER_CANCELLED),
    })
    plain = rows.groupBy("score").agg(F.count(F.when(completed(), F.col("journey_id"))).alias("completed_jrny"))
    c, p = counts.alias("c"), plain.alias("p")
    return c.join(p, F.col("c.score").eqNullSafe(F.col("p.score"))).select("c.*", "p.completed_jrny")
