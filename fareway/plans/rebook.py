"""Chains of re-booked journeys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.scalars import in_codes, safe_ratio
from ..functions.time import day_start_utc, filter_local_day, local_ts, minutes_between, week_start
from ..operators.aggregates import distinct_sums, sum_flag
from ..operators.chains import expand_chains
from ..operators.joins import filter_in, parent_compare
from ..operators.temporal import next_activity
from ..session import cut_lineage
from .trips import completed

PARENT = "ref_parent_journey_id"


def chains(journeys: DataFrame, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """Journeys of all chains whose first journey was requested on a local day in [start, end); written once for the steps that use them."""
    at = F.col("journey_created_at")
    root = at >= day_start_utc(start)
    if end is not None:
        root = root & (at < day_start_utc(end))
    columns = ["journey_id", "ref_journey_id", "ref_customer_id", PARENT, "journey_status", "journey_created_at", "dispatch_eta"]
    return cut_lineage(expand_chains(journeys.select(*columns), "ref_journey_id", PARENT, root))


def chain_levels(chain: DataFrame, compare_to_level: int = 3) -> DataFrame:
    """Per chain level: journeys, completions, and the mean change of the ETA against the parent."""
    counts = distinct_sums(chain, ["level"], "journey_id", {"total_journeys": F.lit(True), "completed_journeys": completed()})
    changes = parent_compare(
        chain.filter(F.col("level") <= compare_to_level), "ref_journey_id", PARENT, {"parent_eta": F.col("dispatch_eta")}
    ).groupBy("level").agg(F.avg(F.col("dispatch_eta") - F.col("parent_eta")).alias("_change"))
    return counts.join(changes, "level", "left").select(
        F.col("level").alias("rebook_level"), "total_journeys", "completed_journeys",
        F.round(safe_ratio("completed_journeys", "total_journeys"), 3).alias("completion_rate"),
        F.round("_change", 2).alias("avg_eta_diff_vs_parent"),
    ).orderBy("rebook_level")


def return_after_chain(
    chain: DataFrame, journeys: DataFrame, start: dt.date, min_cancels: int = 3, window_minutes: int = 15,
    within=(15, 30), driver_cancel: tuple = V.CHAIN_DRIVER_CANCELLED,
) -> DataFrame:
    """Weekly, over chains with more than `min_cancels` customer cancellations: who came back, and when.

    The next request is searched for `window_minutes` after the last journey of the chain; minute
    limits in `within` are counted on that, so a limit above the window adds nothing.
    """
    per_chain = chain.groupBy("root_id").agg(
        F.max("level").alias("max_level"),
        sum_flag(completed()).alias("chain_completed"),
        sum_flag(in_codes("journey_status", V.CUSTOMER_CANCELLED)).alias("customer_cancels"),
        sum_flag(in_codes("journey_status", driver_cancel)).alias("driver_cancels"),
    )
    troubled = filter_in(chain, "root_id", per_chain.filter(F.col("customer_cancels") > min_cancels))
    spans = troubled.groupBy("root_id", "ref_customer_id").agg(
        F.min("journey_created_at").alias("first_at"), F.max("journey_created_at").alias("last_at"),
        F.max("level").alias("max_level"), F.max(F.when(completed(), 1).otherwise(0)).alias("chain_done"),
        F.countDistinct("journey_id").alias("chain_journey_count"),
    )
    fresh = filter_local_day(journeys, "journey_created_at", start, None).filter(F.col(PARENT).isNull())
    near = next_activity(
        spans, fresh.select("ref_customer_id", "journey_created_at", "journey_status"), "ref_customer_id",
        "last_at", "journey_created_at", 60 * window_minutes, completed(), "next_at", "next_done",
    )
    gap = minutes_between(F.col("last_at"), F.col("next_at"))
    back = {m: F.when(F.col("next_at").isNotNull() & (gap <= m), 1).otherwise(0) for m in within}
    done = F.when((F.col("next_done") == 1) & (gap <= within[0]), 1).otherwise(0)
    sums = near.groupBy(week_start(local_ts(F.col("first_at"))).alias("booking_week")).agg(
        F.countDistinct("root_id").alias("total_chains"), F.count(F.lit(1)).alias("_n"),
        F.sum("chain_done").alias("completed_chains"),
        *[F.sum(e).alias(f"return_{m}min_count") for m, e in back.items()],
        F.sum(done).alias("returned_and_completed_count"),
    )
    ratio = lambda c: F.round(safe_ratio(c, "_n"), 3)
    return sums.select(
        "booking_week", "total_chains", "completed_chains", ratio("completed_chains").alias("chain_completion_rate"),
        *[c for m in within for c in (F.col(f"return_{m}min_count"), ratio(f"return_{m}min_count").alias(f"return_{m}min_rate"))],
        "returned_and_completed_count", ratio("returned_and_completed_count").alias("returned_and_completed_rate"),
    ).orderBy("booking_week")
