"""The jobs over the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..plans import (
    bookings, cohort, devices, dispatch, driver_score, eta, kpi, pricing, rebook, settlement, stickiness, support,
    trip_features, weekly_churn,
)
from ..sources import adapters as A
from ..session import configure

START, END = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
AS_OF = dt.date(2024, 1, 25)
OFFER_START, OFFER_END = dt.date(1990, 1, 1), dt.date(2010, 1, 1)
SCORE_DATE = dt.date(2024, 1, 29)


def portable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Dates and times as text and doubles rounded, so that two engines can be compared."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # the inner rounding takes off noise in the last bits, so that ties fall alike
            c = F.round(F.round(c, 9), digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn):
    """Pin the session settings, run, and make the result comparable."""
    def run(spark: SparkSession, root: str) -> DataFrame:
        return portable(fn(configure(spark), root))
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def _linked(s, r):
    return A.with_parents(A.journeys(s, r))


def _blended(s, r):
    return dispatch.blended_offers(
        A.offer_journeys(s, r), A.offers(s, r), A.driver_scores(s, r), OFFER_START, OFFER_END, SCORE_DATE
    )


def _kpi_trips(s, r):
    return kpi.rated_trips(kpi.kpi_base(A.journeys(s, r), AS_OF), A.ratings(s, r), A.badges(s, r))


def _mispriced(s, r):
    return pricing.mispriced_trips(
        A.journeys(s, r), A.ratings(s, r), A.tickets(s, r), A.users(s, r), dt.date(2024, 1, 8), dt.date(2024, 1, 29), END
    )


def _cohort(s, r, variant):
    return cohort.customer_cohort(
        A.journeys(s, r), A.users(s, r), A.zones(s, r), AS_OF, variant, dt.date(2024, 1, 23), dt.date(2023, 2, 1)
    )


def _features(s, r, seq):
    return trip_features.trip_features(
        A.journeys(s, r), A.ratings(s, r), A.tickets(s, r), A.users(s, r), A.zones(s, r),
        dt.date(2024, 1, 5), dt.date(2024, 1, 28), seq,
    )


def _scores(s, r, variant, offers=False):
    return driver_score.driver_scores(
        A.journeys(s, r), A.ratings(s, r), A.users(s, r), dt.date(2024, 2, 1), START, variant,
        A.event_offers(s, r) if offers else None, dt.date(2024, 1, 10) if offers else None,
    )


def _own_share(s, r):
    meter = kpi.meter_days(A.meter_events(s, r), A.journeys(s, r), AS_OF)
    return kpi.own_share(kpi.by_period(meter, "day", AS_OF), "period")


def _user_rollup(s, r):
    state = kpi.by_period(kpi.trip_state(_kpi_trips(s, r)), "local_date", AS_OF)
    return kpi.user_rollup(state, kpi.first_completed_day(A.journeys(s, r), AS_OF))


JOBS = {
    "kpi_sheet": lambda s, r: kpi.kpi_sheet(
        A.journeys(s, r), A.ratings(s, r), A.badges(s, r), A.meter_events(s, r), A.session_daily(s, r), AS_OF),
    "kpi_weekly_funnel": lambda s, r: kpi.funnel(kpi.partial_sums(_kpi_trips(s, r), "booking_week"), "booking_week"),
    "kpi_own_platform_share": _own_share,
    "kpi_user_rollup": _user_rollup,
    "kpi_session_conversion": lambda s, r: kpi.session_conversion(A.session_daily(s, r), AS_OF),
    "driver_score_first": lambda s, r: _scores(s, r, "first"),
    "driver_score_scheduled": lambda s, r: _scores(s, r, "scheduled"),
    "driver_score_acceptance": lambda s, r: _scores(s, r, "scheduled", offers=True),
    "driver_zone_peak": lambda s, r: driver_score.driver_zone_peak(
        driver_score.scored_trips(A.journeys(s, r), A.ratings(s, r), START, END)),
    "eta_ata_detail": lambda s, r: eta.eta_ata_detail(A.journeys(s, r), START, END),
    "last_eta_before_cancel": lambda s, r: eta.last_eta_before_cancel(A.journeys(s, r), A.app_events(s, r), START, END),
    "eta_distance_agreement": lambda s, r: eta.eta_distance_agreement(
        A.offer_journeys(s, r), A.offers(s, r), OFFER_START, OFFER_END),
    "customer_cohort_fixed": lambda s, r: _cohort(s, r, "fixed"),
    "customer_cohort_weekly": lambda s, r: _cohort(s, r, "weekly"),
    "cohort_segment_rollup": lambda s, r: cohort.segment_rollup(_cohort(s, r, "fixed")),
    "dispatch_rank_distribution": lambda s, r: dispatch.rank_distribution(_blended(s, r)),
    "dispatch_outcome_by_priority": lambda s, r: dispatch.outcome_by_priority(_blended(s, r)),
    "dispatch_outliers": lambda s, r: dispatch.outlier_journeys(_blended(s, r), dt.date(1995, 1, 1)),
    "outcome_by_score_bucket": lambda s, r: dispatch.outcome_by_score_bucket(
        A.journeys(s, r), A.driver_scores(s, r), START, END, SCORE_DATE),
    "pricing_impact_by_customer": lambda s, r: pricing.impact_by_customer(_mispriced(s, r)),
    "pricing_impact_by_trip": lambda s, r: pricing.impact_by_trip(_mispriced(s, r)),
    "return_after_ticket": lambda s, r: support.return_after_ticket(support.ticket_behaviour(
        A.tickets(s, r), A.users(s, r), A.journeys(s, r), dt.date(2024, 1, 20), END)),
    "shared_device_balance": lambda s, r: devices.shared_device_balance(devices.device_summary(
        A.journeys(s, r), A.devices(s, r), A.wallet(s, r), END), promo_ratio=0.3),
    "view_to_pickup_distance": lambda s, r: bookings.view_to_pickup_distance(
        _linked(s, r), A.fare_views(s, r), START, END, digits=0),
    "rebook_chain_levels": lambda s, r: rebook.chain_levels(rebook.chains(_linked(s, r), dt.date(2024, 1, 2))),
    "return_after_rebook_chain": lambda s, r: _returns(s, r),
    "weekly_settlement": lambda s, r: settlement.weekly_settlement(
        A.journeys(s, r), A.users(s, r), A.adjustments(s, r), A.fare_metrics(s, r), AS_OF),
    "completed_trip_histogram": lambda s, r: stickiness.completed_trip_histogram(A.journeys(s, r), A.users(s, r), dt.date(2024, 1, 3)),
    "retention_by_trip_number": lambda s, r: stickiness.retention_by_trip_number(A.journeys(s, r), dt.date(2024, 1, 3), 3),
    "retention_in_first_days": lambda s, r: stickiness.retention_in_first_days(A.journeys(s, r), dt.date(2024, 1, 3), 20, 3),
    "location_change_after_cancel": lambda s, r: bookings.location_change_after_cancel(
        bookings.location_change_pairs(A.journeys(s, r), START, END, minutes=600)),
    "location_change_nearest": lambda s, r: bookings.location_change_pairs(
        A.journeys(s, r), START, END, minutes=600, nearest_only=True
    ).select("customer_id", "cancelled_jrny", "completed_jrny", "pickup_distance_mtr", "drop_distance_mtr", "location_change_flag"),
    "message_experiment_rollup": lambda s, r: bookings.message_rollup(
        bookings.message_matches(A.journeys(s, r), A.message_events(s, r), START, END)),
    "message_experiment_matches": lambda s, r: bookings.message_matches(A.journeys(s, r), A.message_events(s, r), START, END),
    "trip_retention_features": lambda s, r: _features(s, r, False),
    "trip_retention_features_seq": lambda s, r: _features(s, r, True),
    "weekly_churn_features": lambda s, r: weekly_churn.weekly_churn_features(A.journeys(s, r), dt.date(2024, 1, 3), dt.date(2024, 1, 30)),
}


def _returns(s, r):
    linked = _linked(s, r)
    chain = rebook.chains(linked, dt.date(2024, 1, 2), dt.date(2024, 1, 31))
    return rebook.return_after_chain(chain, linked, dt.date(2024, 1, 2), min_cancels=1, window_minutes=600, within=(300, 600))


JOB_QUERIES = {name: query(fn) for name, fn in JOBS.items()}
