"""Outstanding balances of customers who share a device."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.scalars import in_codes, json_text, safe_ratio, vehicle_class
from ..functions.time import filter_local_day
from ..operators.dedupe import keep_first
from .trips import completed


def latest_devices(devices: DataFrame) -> DataFrame:
    """The latest device record of each user, with the first device of its list."""
    latest = keep_first(devices, "refuserid", ["-updatedat", "_id"])
    part = lambda name: json_text("devices", "devices", 0, name)
    return latest.select(
        F.col("refuserid").alias("ref_customer_id"), part("deviceId").alias("device_id"),
        part("deviceName").alias("device_name"), part("deviceOs").alias("device_os"),
    )


def outstanding_balance(wallet: DataFrame, least: float = 1.0) -> DataFrame:
    """Sum per customer and wallet type over the outstanding wallets above `least`."""
    due = (F.col("balance") > least) & (F.trim(F.upper("type")) == "OUTSTANDING")
    return wallet.filter(due).groupBy("customer_id", "type").agg(F.sum("balance").alias("total_outstanding_balance"))


def device_summary(journeys: DataFrame, devices: DataFrame, wallet: DataFrame, as_of: dt.date, wallet_key: str = "ref_customer_id") -> DataFrame:
    """Per device: customers, requests, promotions, outcome, balance and ratios.

    Journeys are summed per customer before they meet the devices. `wallet_key` names the customer
    column that wallets refer to.
    """
    trips = filter_local_day(journeys, "journey_created_at", None, as_of)
    limo = vehicle_class("ref_vehicle_category_id") == "Limo"
    flags = {
        "total_jrny_request": F.lit(True), "limo_jrny_request": limo,
        "jrny_with_promo": F.col("ref_promo_applied").isNotNull(), "completed_jrny": completed(),
        "customer_cancelled_jrny": in_codes("journey_status", V.CUSTOMER_CANCELLED),
    }
    has_id = F.col("journey_id").isNotNull()
    per_customer = trips.groupBy("ref_customer_id", "customer_id").agg(
        *[F.count(F.when(c & has_id, 1)).alias(n) for n, c in flags.items()]
    )
    owned = per_customer.join(latest_devices(devices).filter(F.col("device_id").isNotNull()), "ref_customer_id")
    due = outstanding_balance(wallet).select(F.col("customer_id").alias(wallet_key), "total_outstanding_balance")
    sums = owned.join(due, wallet_key, "left").groupBy("device_id").agg(
        F.countDistinct("ref_customer_id").alias("customer_cnt"),
        *[F.sum(n).alias(n) for n in flags],
        F.coalesce(F.sum("total_outstanding_balance"), F.lit(0.0)).alias("total_outstanding_balance"),
    ).filter(F.col("device_id") != "")
    return sums.withColumns({
        "promo_ratio": safe_ratio("jrny_with_promo", "total_jrny_request"),
        "limo_ratio": safe_ratio("limo_jrny_request", "total_jrny_request"),
        "customer_cancel_ratio": safe_ratio("customer_cancelled_jrny", "total_jrny_request"),
    })


def shared_device_balance(summary: DataFrame, customers: int = 3, promo_ratio: float = 0.75) -> DataFrame:
    """Totals over devices with exactly `customers` customers and at least `promo_ratio` promotions."""
    odd = (F.col("customer_cnt") == customers) & (F.col("promo_ratio") >= promo_ratio)
    return summary.filter(odd).agg(
        F.sum("customer_cnt").alias("customer_cnt"), F.countDistinct("device_id").alias("device_cnt"),
        F.sum("total_outstanding_balance").alias("total_outstanding_balance"),
    )
