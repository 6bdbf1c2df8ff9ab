"""Weekly settlement with the suppliers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as V
from ..functions.time import filter_prev_week, local_ts, minutes_between
from ..operators.skew import find_hot, lookup_join

VAT = 0.05


def adjustment_totals(adjustments: DataFrame, as_of: dt.date) -> DataFrame:
    """Fare corrections of last week that concern the driver, summed per journey; exact copies count once."""
    mine = F.lower(F.trim("adjustmentapplicability")).isin("both", "driver")
    return filter_prev_week(adjustments.filter(mine), "updatedat", as_of).distinct().groupBy(
        F.col("journeyid").alias("journey_id")
    ).agg(F.sum("adjustmentamount").alias("adjustmentamount"))


def settlement_base(journeys: DataFrame, users: DataFrame, adjustments: DataFrame, fare_metrics: DataFrame, as_of: dt.date) -> DataFrame:
    """Assigned journeys updated last week with driver contact, corrections and payment instrument."""
    trips = filter_prev_week(journeys.filter(F.col("ref_driver_id").isNotNull()), "updated_at", as_of)
    contacts = users.select(F.col("useruid").alias("driver_id"), "mobilenumber", "meterid", "countrycode").distinct()
    instruments = fare_metrics.select("journey_id", "actual_payment_instrument").distinct()
    rows = lookup_join(trips, contacts, "driver_id", hot=find_hot(journeys, "driver_id"), spread=["journey_id"])
    return rows.join(adjustment_totals(adjustments, as_of), "journey_id", "left").join(instruments, "journey_id", "left")


def settle(rows: DataFrame) -> DataFrame:
    """Cash collected, net fare, net earning and amount payable of each journey."""
    z = lambda c: F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0.0))
    method = F.upper(F.trim("payment_description"))
    # a NULL method is neither cash nor not-cash
    cash, no_cash = method.contains("CASH"), ~method.contains("CASH")
    limo, taxi = F.col("car_category") == "LIMO", F.col("car_category") == "TAXI"
    fare, fee, correction = "actual_total_fee", F.col("actual_commission"), z("adjustmentamount")
    less_fee = z(fare) - z(fee)
    vat = z(F.lit(VAT) * fee)
    cut = correction * (F.lit(1.0) - z(fee) / F.nullif(fare, F.lit(0.0)))
    settled = F.col("journey_status_desc").isin(*V.SETTLED_STATUS_TEXTS)

    out = rows.withColumns({
        "car_category": F.when(F.col("vehicle_category_type") == 1, "LIMO").otherwise("TAXI"),
        "final_journey_status": F.when(settled, "Completed").otherwise("Cancelled"),
        "cash_collected": F.when(cash, z(fare) + correction - z("actual_discount_amount")).otherwise(0.0),
    }).withColumn(
        "netfare",
        F.when(cash & limo, less_fee - vat + correction - z("actual_rta_fee"))
        .when(no_cash & limo, less_fee - vat + cut)
        .otherwise(less_fee + cut),
    )
    out = out.withColumns({
        "_earned": F.col("netfare") - F.when(cash, z(fare) + correction).otherwise(0.0),
        "rta_revised_fare_adjustment": F.when(
            settled & (F.col("netfare") > 0), -F.col("actual_booking_extra_fee")
        ).otherwise(0.0),
        "vat_on_comission": F.lit(VAT) * fee,
    })

    def payable(amount: Column) -> Column:
        dispatch, cancel, discount = z("actual_rta_fee"), z("actual_total_cancellation_fee"), z("actual_discount_amount")
        return (
            F.when(limo & no_cash, amount - dispatch + cancel)
            .when(limo & cash, amount - dispatch + discount + cancel)
            .when(taxi & no_cash, amount)
            .when(taxi & cash, amount + discount)
        ) + z("actual_tip_amount")

    return out.withColumns({
        "net_earning": payable(z("_earned")),
        "final_net_payable_to_supplier": payable(z("rta_revised_fare_adjustment") + z("_earned")),
    })


def weekly_settlement(
    journeys: DataFrame, users: DataFrame, adjustments: DataFrame, fare_metrics: DataFrame, as_of: dt.date
) -> DataFrame:
    """One row per assigned journey updated in the week before the Monday of `as_of`."""
    rows = settle(settlement_base(journeys, users, adjustments, fare_metrics, as_of))
    picked = local_ts("pickup_time")
    return rows.select(
        "journey_id", F.col("journey_status_desc").alias("trip_status"), F.col("payment_description").alias("payment_method"),
        "car_category", "supplier_name", "final_journey_status", "driver_id", "driver_name",
        F.col("mobilenumber").cast("long").alias("mobilenumber"), "meterid", "transport_authority_job_id", "actual_distance",
        minutes_between("arrived_at_pickup_timestamp", "actual_drop_off_time").alias("actual_time"),
        "pickup_location", "drop_off_location", F.to_date(picked).alias("pickup_date"), picked.alias("pickup_time"),
        "pickup_latitude", "pickup_longitude", F.to_date("actual_drop_off_time").alias("dropoff_date"),
        F.col("actual_drop_off_time").alias("drop_off_time"), "actual_drop_off_latitude", "actual_drop_off_longitude",
        F.col("actual_salik_fee").alias("salik"), F.col("actual_discount_amount").alias("discount"),
        "actual_interemirate_fee", "actual_total_cancellation_fee", "actual_parking_fee",
        F.col("actual_commission").alias("commission"), F.col("actual_tip_amount").alias("tips"),
        F.col("actual_total_fee").alias("total_fare"), "actual_peak_multiplier", "adjustmentamount",
        "actual_booking_extra_fee", "cash_collected", "actual_payment_instrument",
        F.col("actual_rta_fee").alias("dispatchfeeamount"), "netfare", "rta_revised_fare_adjustment", "vat_on_comission",
        "net_earning", "final_net_payable_to_supplier",
    )
