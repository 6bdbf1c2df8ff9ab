"""Operations KPI sheet: weekly, month-to-date and target rows in long format.

Trips are read once and reduced to a state: sums per local day, customer and outcome. Funnel, rates and users are sums over the state, so days can be
stored and a daily run adds one day (`sinks.write_days`) instead of reading sixty.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed_values as V
from ..functions.geo import cosine_distance_km
from ..functions.scalars import composite_id, in_codes, no_bad_badges, safe_ratio, trip_revenue
from ..functions.time import days, filter_day_column, filter_local_day, local_date, week_start
from ..operators.aggregates import avg_if, count_if
from ..operators.joins import classify_member
from ..operators.skew import Hot
from ..operators.reshape import literal_rows, union_all, unpivot_metrics
from ..session import write_aside
from .trips import completed, rating_per_journey, with_local_time, with_trip_times

WINDOW_DAYS = 60
FUNNEL = ("requests", "completed", "completion_rate", "cancellation_rate", "revenue", "driver_cancel_rate",
          "customer_cancel_rate", "avg_eta", "avg_ata", "good_ratings", "short_eta", "short_ata", "own_share")
USERS = ("new_users", "existing_users", "trip_frequency")
SESSIONS = ("sessions", "session_conversion")


def kpi_base(journeys: DataFrame, as_of: dt.date, n_days: int = WINDOW_DAYS) -> DataFrame:
    """Trips of the last `n_days` local days before `as_of` with times and revenue."""
    base = filter_local_day(journeys, "journey_created_at", as_of - days(n_days), as_of)
    base = with_local_time(base).withColumn("eta_sec", F.coalesce("dispatch_eta_sec", "first_eta"))
    fees = ("actual_base_fee", "actual_total_distance_fee", "actual_total_time_fee")
    return with_trip_times(base).withColumns({
        "revenue": trip_revenue("journey_status", F.col("vehicle_cat"), "weekday", "local_hour", fees),
        "pickup_km": cosine_distance_km(
            "driver_pickup_longitude", "driver_pickup_latitude", "dispatch_longitude", "dispatch_latitude"
        ),
    })


def rated_trips(base: DataFrame, ratings: DataFrame, badges: DataFrame) -> DataFrame:
    """`kpi_base` with the rating and whether the badges are clean.

    Badges are reduced to one flag per journey; their text is not needed.
    """
    # a journey counts as clean if the badges of one of its drivers are
    clean = badges.groupBy("ref_journey_id", "ref_driver_id").agg(
        F.min(no_bad_badges("badge_name").cast("int")).alias("_clean")
    ).groupBy("ref_journey_id").agg(F.max("_clean").alias("_clean"))
    rated = rating_per_journey(ratings).join(clean, "ref_journey_id", "left").withColumn(
        "clean_badges", F.coalesce(F.col("_clean") == 1, F.lit(True))
    ).drop("_clean")
    return base.join(rated, "ref_journey_id", "left")


def by_period(df: DataFrame, day: str, as_of: dt.date) -> DataFrame:
    """Each row once for its week and, if it lies in [first of the month, as_of), once for `MTD`.

    One pass then serves both; the repeated rows meet the map-side combine before any shuffle.
    """
    month = as_of.replace(day=1)
    local = F.to_date(F.col(day))
    line = lambda name, start, end: F.struct(name.alias("period"), start.alias("period_start"), end.alias("period_end"))
    week = week_start(local)
    weekly = line(F.date_format(week, "yyyy-MM-dd"), week, F.date_add(week, 7))
    mtd = line(F.lit("MTD"), F.lit(month), F.add_months(F.lit(month), 1))
    inside = (local >= F.lit(month)) & (local < F.lit(as_of))
    lines = F.when(inside, F.array(weekly, mtd)).otherwise(F.array(weekly))
    return df.withColumn("_period", F.explode(lines)).select(*df.columns, "_period.*")


def outcome() -> Column:
    """What became of a request; NULL without a status."""
    of = lambda codes: in_codes("journey_status", codes)
    return (
        F.when(completed(), "completed").when(of(V.DRIVER_CANCELLED), "driver").when(of(V.CUSTOMER_CANCELLED), "customer")
        .when(of(V.ADMIN_CANCELLED), "admin").when(F.col("journey_status").isNotNull(), "other")
    )


def partial_sums(trips: DataFrame, *keys) -> DataFrame:
    """Sums and counts per key and outcome that can be added up further; `trips` come from `rated_trips`."""
    eta, ata = F.col("eta_sec"), F.col("ata")
    rated = completed() & F.col("rating").isNotNull()
    n = lambda c: count_if(c & F.col("journey_id").isNotNull())
    minutes = lambda c: F.round(c / 60.0, 2)
    return trips.withColumn("outcome", outcome()).groupBy(*keys, "outcome").agg(
        F.count("journey_id").alias("requests"), n(F.col("ref_driver_id").isNull()).alias("driver_not_found"),
        F.count("ref_customer_id").alias("requests_with_customer"), n(F.col("ref_promo_applied").isNotNull()).alias("promo_requests"),
        F.sum(F.coalesce("revenue", F.lit(0.0))).alias("revenue"),
        F.sum(minutes(eta)).alias("eta_minutes"), F.count(eta).alias("eta_trips"),
        F.sum(minutes(ata)).alias("ata_minutes"), F.count(ata).alias("ata_trips"),
        F.sum("pickup_km").alias("pickup_km"), F.count("pickup_km").alias("pickup_trips"),
        n(eta <= V.SHORT_WAIT_SECONDS).alias("short_eta_trips"), n(ata <= V.SHORT_WAIT_SECONDS).alias("short_ata_trips"),
        n(F.abs(ata - eta) <= 120).alias("accurate_eta_trips"),
        n(rated & (F.col("rating") >= 4)).alias("well_rated"), n(rated & F.col("clean_badges")).alias("cleanly_rated"),
    )


def trip_state(trips: DataFrame) -> DataFrame:
    """`partial_sums` per local day and customer: what is stored of trips, and all that the sheet needs of them.

    Days add up, so a new day is a new set of rows. A day whose trips or ratings changed later is computed again as a whole.
    """
    return partial_sums(trips, "local_date", "ref_customer_id")


def funnel(sums: DataFrame, *keys) -> DataFrame:
    """Requests, outcome, waiting and rating figures per key from `partial_sums` of the same or finer keys; percentages are 0..100."""
    of = lambda c: F.sum(F.when(c, F.col("requests")).otherwise(0))
    is_a = lambda name: of(F.col("outcome") == name)
    added = ("requests", "driver_not_found", "requests_with_customer", "promo_requests", "revenue", "short_eta_trips",
             "short_ata_trips", "accurate_eta_trips", "well_rated", "cleanly_rated")
    mean = lambda total, number: safe_ratio(F.sum(total), F.sum(number))
    figures = sums.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in added],
        is_a("completed").alias("completed"), of(F.col("outcome") != "completed").alias("cancelled"),
        is_a("driver").alias("driver_cancelled"), is_a("customer").alias("customer_cancelled"), is_a("admin").alias("admin_cancelled"),
        mean("eta_minutes", "eta_trips").alias("avg_eta"), mean("ata_minutes", "ata_trips").alias("avg_ata"),
        mean("pickup_km", "pickup_trips").alias("avg_pickup_km"),
    )
    pct = lambda num, den="requests": safe_ratio(num, den, 100.0)
    return figures.withColumns({
        "completion_rate": pct("completed"), "cancellation_rate": pct("cancelled"),
        "driver_cancel_rate": pct("driver_cancelled"), "customer_cancel_rate": pct("customer_cancelled"),
        "driver_not_found_share": safe_ratio("driver_not_found", "requests"),
        "admin_cancel_share": safe_ratio("admin_cancelled", "requests"),
        "promo_share": safe_ratio("promo_requests", "requests"),
        "eta_accuracy_share": safe_ratio("accurate_eta_trips", "requests"),
        "short_eta": pct("short_eta_trips"), "short_ata": pct("short_ata_trips", "completed"),
        "good_ratings": pct("well_rated", "cleanly_rated"),
    })


def meter_days(meter_events: DataFrame, trips: DataFrame, as_of: dt.date) -> DataFrame:
    """Different taxi meter trips of the last 60 days per day and type: street hail, own platform, or others.

    The meter's time column already is local time. Trips are counted per day and job number before the job is looked up, so the number 0 of all
    street trips is one row a day, and the meter log is read once.
    """
    day = F.to_date("eventdatetime")
    vacant = filter_day_column(
        meter_events.filter(F.col("eventname") == "METER_VACANT"), "eventdatetime", as_of - days(WINDOW_DAYS), as_of
    )
    known = vacant.filter(composite_id("driverid", "jobnumber", "eventdatetime").isNotNull())
    different = known.select("eventdatetime", "driverid", "jobnumber").distinct()
    per_job = different.groupBy(day.alias("day"), "jobnumber").agg(F.count(F.lit(1)).alias("trips"))
    own = trips.filter(in_codes("journey_status", V.METER_JOB))
    member = classify_member(per_job, "jobnumber", own, "transport_authority_job_id", "_own", Hot(("jobnumber",), None))
    kind = F.when(F.col("jobnumber") == "0", "Street").when(F.col("_own"), "Own").otherwise("Others")
    return member.groupBy("day", kind.alias("trip_type")).agg(F.sum("trips").alias("trips"))


def own_share(meter: DataFrame, *keys) -> DataFrame:
    """Own-platform share of the different meter trips in percent; `meter` comes from `meter_days`."""
    own = F.sum(F.when(F.col("trip_type") == "Own", F.col("trips")).otherwise(0))
    return meter.groupBy(*keys).agg(safe_ratio(own, F.sum("trips"), 100.0).alias("own_share"))


def first_completed_day(journeys: DataFrame, as_of: dt.date) -> DataFrame:
    done = filter_local_day(journeys, "journey_created_at", None, as_of + days(1)).filter(completed())
    return done.groupBy("ref_customer_id").agg(F.min(local_date("journey_created_at")).alias("first_day"))


def merge_first_days(first_days: DataFrame, state: DataFrame) -> DataFrame:
    """First completed days carried on: those known, and those of the days of `state`."""
    seen = state.filter(F.col("outcome") == "completed").select("ref_customer_id", F.col("local_date").alias("first_day"))
    return first_days.unionByName(seen).groupBy("ref_customer_id").agg(F.min("first_day").alias("first_day"))


def user_rollup(state: DataFrame, first_days: DataFrame) -> DataFrame:
    """Active, new and existing users per period, and trips per user, from `by_period` of a `trip_state`.

    A user has one row per period after the first aggregate, so counts are distinct counts.
    """
    done = state.filter(F.col("outcome") == "completed")
    per_user = done.groupBy("period", "period_start", "period_end", "ref_customer_id").agg(
        F.sum("requests").alias("trips")
    ).join(first_days, "ref_customer_id", "left")
    new = (F.col("first_day") >= F.col("period_start")) & (F.col("first_day") < F.col("period_end"))
    old = F.col("first_day") < F.col("period_start")
    user = F.col("ref_customer_id")
    return per_user.groupBy("period").agg(
        F.count(user).alias("active_users"),
        F.count(F.when(new, user)).alias("new_users"), F.count(F.when(old, user)).alias("existing_users"),
        F.round(F.avg("trips"), 1).alias("trip_frequency"),
        F.round(avg_if("trips", new), 1).alias("trip_frequency_new"),
        F.round(avg_if("trips", old), 1).alias("trip_frequency_existing"),
    )


def session_conversion(sessions: DataFrame, as_of: dt.date) -> DataFrame:
    """Sessions and the percentage of them with a booking, per week of the last 60 days and MTD."""
    recent = filter_day_column(sessions, "local_event_dt", as_of - days(WINDOW_DAYS), as_of)
    return by_period(recent, "local_event_dt", as_of).groupBy("period").agg(
        F.sum("total_page_view_session_cnt").alias("sessions"), F.sum("total_booked_session").alias("booked_sessions")
    ).withColumn("session_conversion", safe_ratio("booked_sessions", "sessions", 100.0))


def _lines(df: DataFrame, names) -> DataFrame:
    return unpivot_metrics(df, ["period"], {n: V.KPI_METRICS[n][:2] for n in names})


def target_rows(spark: SparkSession) -> DataFrame:
    rows = [("Monthly Target", name, value, order) for order, name, value in V.KPI_METRICS.values()]
    return literal_rows(spark, rows, "period string, metric string, value double, metric_order int")


def kpi_sheet(
    journeys: DataFrame, ratings: DataFrame, badges: DataFrame, meter_events: DataFrame, sessions: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Rows `(period, metric, value, metric_order)`; the period is a Monday, `MTD` or `Monthly Target`."""
    state = write_aside(trip_state(rated_trips(kpi_base(journeys, as_of), ratings, badges)))
    return sheet_from_state(state, first_completed_day(journeys, as_of), journeys, meter_events, sessions, as_of)


def sheet_from_state(
    state: DataFrame, first_days: DataFrame, journeys: DataFrame, meter_events: DataFrame, sessions: DataFrame, as_of: dt.date
) -> DataFrame:
    """The sheet from a `trip_state` that holds at least the last 60 days; of `journeys` only the job numbers are read."""
    trips = by_period(filter_day_column(state, "local_date", as_of - days(WINDOW_DAYS), as_of), "local_date", as_of)
    own_jobs = filter_local_day(journeys, "journey_created_at", as_of - days(WINDOW_DAYS), as_of)
    meter = by_period(meter_days(meter_events, own_jobs, as_of), "day", as_of)
    users = user_rollup(trips, first_days)
    lines = union_all(
        _lines(funnel(trips, "period").join(own_share(meter, "period"), "period", "left"), FUNNEL),
        _lines(users, USERS),
        _lines(session_conversion(sessions, as_of), SESSIONS),
    )
    targets = target_rows(state.sparkSession)
    # on the first of a month nothing lies in MTD: its counts are 0 and its other values NULL
    empty = [
        ("MTD", V.KPI_METRICS[n][1], 0.0 if n in ("requests", "completed") else None, V.KPI_METRICS[n][0])
        for n in FUNNEL + SESSIONS
    ]
    floor = literal_rows(state.sparkSession, empty, "period string, metric string, value double, metric_order int")
    ranked = union_all(lines.select(targets.columns), floor).groupBy("period", "metric").agg(
        F.sum("value").alias("value"), F.min("metric_order").alias("metric_order")
    )
    return union_all(ranked.select(targets.columns), targets).orderBy("period", "metric_order")
