"""One query per operator over the driver tables, each next to its oracle SQL."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import scalars as S
from ..functions import time as TM
from ..functions.geo import cosine_distance_km, ring_area, ring_contains, ring_edges, sphere_distance
from ..operators import aggregates as AG
from ..operators import dedupe as D
from ..operators import joins as J
from ..operators import ordered as O
from ..operators import temporal as TJ
from ..operators.chains import expand_chains
from ..operators.reshape import literal_rows, union_all, union_distinct, unpivot_metrics
from ..operators.skew import lookup_join
from ..operators.zones import zone_join
from ..plans import dispatch, kpi, settlement
from ..plans.trips import completed, complaints, with_local_time, with_trip_times
from ..session import shared_dir
from ..sources import adapters as A
from ..sources import sinks
from ..sources.tables import read_table, read_tickets
from .frames_sql import with_frames
from .job_oracles import BLENDED, DONE, JOB_ORACLES, PEAK, PLACE, SLOT, d, dist, n, r, t
from .job_queries import AS_OF, OFFER_END, OFFER_START, SCORE_DATE, _scores, query

QUERIES, ORACLES = {}, {}


def op(name: str, frames: str, sql: str, recursive: bool = False):
    """Register a query with its oracle; `frames` are the SQL frames the oracle builds on."""
    def add(fn):
        QUERIES[name] = query(fn)
        ORACLES[name] = with_frames(frames, sql, recursive) if frames else sql.strip()
        return fn
    return add


def scratch(spark) -> str:
    """A fresh folder under the shared one."""
    return f"{shared_dir(spark)}/fareway-{uuid.uuid4().hex}"


def scratch_table(spark) -> str:
    db = "fareway_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch(spark)}'")
    return f"{db}.result"


def trips(s, root):
    return with_local_time(A.journeys(s, root))


def timed(s, root):
    return with_trip_times(trips(s, root))


# ------------------------------------------------------------------ sources and sinks
@op("table_scan", "", f"SELECT event_id, user_id, {r('value')} AS value FROM events WHERE event_type = 'purchase'")
def _(s, root):
    return read_table(s, "events", root).filter("event_type = 'purchase'").select("event_id", "user_id", "value")


@op("ticket_file_scan", "tickets", f"""
SELECT initiated_at, {t("strptime(initiated_at, '%m/%d/%Y %H:%M')")} AS initiated_date, chat_type, csat_score, user_properties_phone_number FROM tickets""")
def _(s, root):
    path = scratch(s)
    A.tickets(s, root).write.csv(path, header=True)
    return read_tickets(s, path).select("initiated_at", "initiated_date", "chat_type", "csat_score", "user_properties_phone_number")


WEEKLY = "SELECT {0} AS booking_week, count(*) AS requests, count(DISTINCT ref_customer_id) AS customers FROM trips {1} GROUP BY 1"


def _weekly(s, root):
    return timed(s, root).groupBy("booking_week").agg(
        F.count(F.lit(1)).alias("requests"), F.countDistinct("ref_customer_id").alias("customers"))


@op("rebuild_table", "trips", WEEKLY.format(d("wk"), ""))
def _(s, root):
    table = scratch_table(s)
    sinks.write_rebuild(_weekly(s, root).withColumn("requests", F.col("requests") + 1), table)
    sinks.write_rebuild(_weekly(s, root), table)
    return s.table(table)


@op("daily_snapshot", "trips", f"""
SELECT {d('wk')} AS booking_week, count(*) AS requests, count(DISTINCT ref_customer_id) AS customers, x AS run_date
FROM trips, (VALUES ('2024-01-24'), ('2024-01-25')) AS v(x) GROUP BY 1, 4""")
def _(s, root):
    path, frame = scratch(s), _weekly(s, root)
    sinks.write_snapshot(frame.withColumn("requests", F.col("requests") * 0), path, dt.date(2024, 1, 25))
    for day in (24, 25):
        sinks.write_snapshot(frame, path, dt.date(2024, 1, day))
    return s.read.parquet(path)


@op("append_with_retention", "trips", f"SELECT {d('ld')} AS pickup_date, count(*) AS requests FROM trips WHERE ld >= DATE '2024-01-08' GROUP BY 1")
def _(s, root):
    table, per_day = scratch_table(s), trips(s, root).groupBy(F.col("local_date").alias("pickup_date")).agg(F.count(F.lit(1)).alias("requests"))
    cut = dt.date(2024, 1, 15)
    sinks.append_with_retention(per_day.filter(F.col("pickup_date") < F.lit(cut)), table, "pickup_date", AS_OF)
    # the second run keeps two weeks before its Monday, 2024-01-22
    sinks.append_with_retention(per_day.filter(F.col("pickup_date") >= F.lit(cut)), table, "pickup_date", AS_OF, weeks=2)
    return s.table(table)


@op("snapshot_pick", "driver_scores", f"SELECT DISTINCT ref_driver_id, {r('final_score')} AS final_score FROM driver_scores WHERE run_date = DATE '2024-01-22'")
def _(s, root):
    return sinks.snapshot_asof(A.driver_scores(s, root), dt.date(2024, 1, 22))


@op("insert_by_name", "trips", f"SELECT {d('wk')} AS booking_week, count(*) * k AS requests FROM trips, (VALUES (1), (2)) AS v(k) GROUP BY wk, k")
def _(s, root):
    table, frame = scratch_table(s), _weekly(s, root).select("booking_week", "requests")
    sinks.write_rebuild(frame, table)
    sinks.insert_by_name(frame.select((F.col("requests") * 2).alias("requests"), "booking_week"), table, ["booking_week", "requests"])
    return s.table(table)


@op("run_stamp", "driver_scores", f"SELECT ref_driver_id, {r('final_score')} AS final_score, {d('run_date')} AS run_date, '2024-02-01 04:30:00.000000' AS query_run_timestamp FROM driver_scores")
def _(s, root):
    return sinks.with_run_ts(A.driver_scores(s, root), dt.datetime(2024, 2, 1, 0, 30))


@op("settlement_table", "", f"SELECT *, '2024-02-01 04:30:00.000000' AS query_run_timestamp FROM ({JOB_ORACLES['weekly_settlement']})")
def _(s, root):
    """The settlement job ends in its table; the same run a second time changes nothing."""
    table = scratch_table(s)
    rows = settlement.weekly_settlement(A.journeys(s, root), A.users(s, root), A.adjustments(s, root), A.fare_metrics(s, root), AS_OF)
    stamped = sinks.with_run_ts(rows, dt.datetime(2024, 2, 1, 0, 30))
    for _ in range(2):
        sinks.append_with_retention(stamped, table, "pickup_date", AS_OF, run_c="run_week")
    return s.table(table).drop("run_week")


@op("kpi_sheet_from_state", "", JOB_ORACLES["kpi_sheet"])
def _(s, root):
    """The sheet from stored days: sixty days up to yesterday are written, then the last day is added, and first days are carried on."""
    path, journeys = scratch(s), A.journeys(s, root)
    yesterday = AS_OF - dt.timedelta(days=1)
    for as_of, n_days in ((yesterday, kpi.WINDOW_DAYS), (AS_OF, 1), (AS_OF, 1)):
        trips = kpi.rated_trips(kpi.kpi_base(journeys, as_of, n_days), A.ratings(s, root), A.badges(s, root))
        sinks.write_days(kpi.trip_state(trips), path, "local_date")
    state = s.read.parquet(path)
    first_days = kpi.merge_first_days(kpi.first_completed_day(journeys, yesterday - dt.timedelta(days=1)), state)
    return kpi.sheet_from_state(state, first_days, journeys, A.meter_events(s, root), A.session_daily(s, root), AS_OF)


@op("dispatch_from_stored_scores", "offers offer_journeys", f""", driver_scores AS (
  SELECT ref_driver_id, final_score, DATE '2024-01-29' AS run_date FROM ({JOB_ORACLES['driver_score_acceptance']})){BLENDED}
SELECT {d('dat')} AS dat, {n('dr')} AS dispatch_rank, count(DISTINCT journey_id) AS jrny_cnt FROM given GROUP BY 1, 2""")
def _(s, root):
    """The score job writes a snapshot per run, stamped; the dispatch job reads the run it wants back."""
    path, scores = scratch(s), _scores(s, root, "scheduled", offers=True)
    for day, frame in ((22, scores.withColumn("final_score", F.lit(0.0))), (29, scores)):
        run = dt.datetime(2024, 1, day)
        sinks.write_snapshot(sinks.with_run_ts(frame, run), path, run.date())
    stored = s.read.parquet(path)
    blended = dispatch.blended_offers(A.offer_journeys(s, root), A.offers(s, root), stored, OFFER_START, OFFER_END, SCORE_DATE)
    return dispatch.rank_distribution(blended)


# ------------------------------------------------------------------ filters
def _filter(name, where, fn):
    @op(name, "trips", f"SELECT journey_id, {d('ld')} AS local_date FROM trips WHERE {where}")
    def _(s, root):
        return with_local_time(fn(A.journeys(s, root))).select("journey_id", "local_date")


CREATED = "journey_created_at"
_filter("local_day_filter", "ld >= DATE '2024-01-05' AND ld < DATE '2024-01-20'",
        lambda j: TM.filter_local_day(j, CREATED, dt.date(2024, 1, 5), dt.date(2024, 1, 20)))
_filter("last_days_filter", "ld >= DATE '2024-01-15' AND ld < DATE '2024-01-25'", lambda j: TM.filter_last_days(j, CREATED, 10, AS_OF))
_filter("month_to_date_filter", "ld >= DATE '2024-01-01' AND ld < DATE '2024-01-25'", lambda j: TM.filter_mtd(j, CREATED, AS_OF))
_filter("closed_weeks_filter", "ld < DATE '2024-01-22'", lambda j: TM.filter_closed_weeks(j, CREATED, AS_OF))
_filter("previous_week_filter", "ld >= DATE '2024-01-15' AND ld < DATE '2024-01-22'", lambda j: TM.filter_prev_week(j, CREATED, AS_OF))
_filter("week_bounds_filter", "ld >= DATE '2023-12-22' AND ld < DATE '2024-01-22'", lambda j: TM.filter_local_day(j, CREATED, *TM.week_bounds(AS_OF)))


@op("label_filter", "trips", f"SELECT journey_id, {d('ld')} AS local_date FROM trips WHERE cls = 'Taxi' AND {PEAK} = 'Evening_peak'")
def _(s, root):
    return timed(s, root).filter((F.col("vehicle_cat") == "Taxi") & (F.col("peak") == "Evening_peak")).select("journey_id", "local_date")


def _project(name, columns: dict, fn, frames="trips", base="trips", source=trips, key="journey_id"):
    """A row-wise operator: `columns` maps outputs to SQL, `fn` gives the same Spark columns."""
    picked = ", ".join(f"{e} AS {c}" for c, e in columns.items())

    @op(name, frames, f"SELECT {key + ', ' if key else ''}{picked} FROM {base}")
    def _(s, root):
        made = fn()
        keys = [key] if key else []
        return source(s, root).select(*keys, *[e.alias(c) for c, e in made.items()])


_project("status_flags", {"done": n(f"({DONE})"), "cancelled": n("(journey_status IN (13, 14))")},
         lambda: {"done": S.status_flag("journey_status", V.COMPLETED), "cancelled": S.status_flag("journey_status", (13, 14))})
_project("category_decode", {"vehicle": "cls", "supplier": "CASE supplier_name WHEN 'Kabi' THEN 'K' WHEN 'DTC' THEN 'D' END"},
         lambda: {"vehicle": S.vehicle_class("ref_vehicle_category_id"), "supplier": S.decode("supplier_name", {"Kabi": "K", "DTC": "D"})})
_project("threshold_buckets", {
    "fee": "CASE WHEN estimate_total_fee <= 30 THEN '0.<30' WHEN estimate_total_fee <= 50 THEN '1.30-50' WHEN estimate_total_fee <= 70 THEN '2.50-70' ELSE '3.>70' END",
    "idle": "CASE WHEN DATE '2024-03-01' - ld <= 7 THEN '0-7_days' WHEN DATE '2024-03-01' - ld <= 30 THEN '8-30_days' WHEN DATE '2024-03-01' - ld <= 90 THEN '31-90_days' ELSE '90+_days' END",
}, lambda: {"fee": S.bucketize("estimate_total_fee", V.FEE_BOUNDS, V.FEE_LABELS),
            "idle": S.bucketize(F.datediff(F.lit(dt.date(2024, 3, 1)), "local_date"), V.RECENCY_BUCKET_BOUNDS, V.RECENCY_BUCKET_LABELS)})
_project("shift_labels", {"peak": PEAK, "shift": SLOT.format("'Morning_peak'", "'Evening_weekday_peak'", "'Weekend_evening_peak'", "'Weekend_mid_night'", "'LateNight0_5'", "'Weekday_mid_night'", "'Others'")},
         lambda: {"peak": S.peak_label("weekday", "local_hour"), "shift": S.shift_label("weekday", "local_hour")},
         base="(SELECT *, dayofweek(ld) AS dow FROM trips)")
_project("place_types", {"place": PLACE.format(z="lower(trim(name))", a="lower(trim(zone_name))")},
         lambda: {"place": S.place_type("name", "zone_name")}, "zones", "zones", A.zones, "name")
_project("journey_types", {"kind": "CASE WHEN a = 'Mall' OR b = 'Mall' THEN 'Mall_Goer' WHEN a = 'School' OR b = 'School' THEN 'School_Route' WHEN a = 'College' OR b = 'College' THEN 'College_Route' WHEN a = 'Metro' OR b = 'Metro' THEN 'Metro_Route' WHEN a = 'Airport' OR b = 'Airport' THEN 'Airport_Traveler' ELSE 'General' END"},
         lambda: {"kind": S.journey_type(S.place_type(F.lit(None).cast("string"), "pickup_location"), S.place_type(F.lit(None).cast("string"), "drop_off_location"))},
         base=f"(SELECT *, {PLACE.format(z='NULL::VARCHAR', a='lower(pickup_location)')} AS a, {PLACE.format(z='NULL::VARCHAR', a='lower(drop_off_location)')} AS b FROM trips)")
_project("bad_badge_exclusion", {"badge_name": "badge_name", "clean": "badge_name IS NULL OR NOT (badge_name ILIKE '%dirty car%' OR badge_name ILIKE '%bad odour%' OR badge_name ILIKE '%unfriendly chat%')"},
         lambda: {"badge_name": F.col("badge_name"), "clean": S.no_bad_badges("badge_name")}, "badges", "badges", A.badges, "ref_journey_id")
_project("chained_columns", {"price_error": r("err"), "over": n("(err > 0.1)")},
         lambda: {"price_error": F.col("err"), "over": F.when(F.col("err") > 0.1, 1).when(F.col("err").isNotNull(), 0)},
         base="(SELECT *, (actual_total_fee - estimate_total_fee) / nullif(estimate_total_fee, 0) AS err FROM trips)",
         source=lambda s, root: trips(s, root).withColumn("err", F.try_divide(F.col("actual_total_fee") - F.col("estimate_total_fee"), F.nullif("estimate_total_fee", F.lit(0.0)))))
_project("slot_revenue", {"revenue": r(f"CASE WHEN {DONE} AND cls = 'Taxi' THEN {SLOT.format('7e0', '7e0', '7e0', '6.5e0', '3.5e0', '3.5e0', '3e0')} WHEN {DONE} THEN 0.2e0 * (actual_base_fee + actual_total_distance_fee + actual_total_time_fee) END")},
         lambda: {"revenue": S.trip_revenue("journey_status", F.col("vehicle_cat"), "weekday", "local_hour", ("actual_base_fee", "actual_total_distance_fee", "actual_total_time_fee"))},
         base="(SELECT *, dayofweek(ld) AS dow FROM trips)")
_project("acceptance_time", {"accepted": t("CASE WHEN cls = 'Limo' THEN accepted_ride_timestamp ELSE on_route_timestamp END")},
         lambda: {"accepted": S.accepted_at(F.col("vehicle_cat"))})


@op("ratio_segments", "trips", f"""
SELECT ref_customer_id, CASE WHEN p >= 0.4 THEN 'heavy' WHEN p BETWEEN 0.3 AND 0.4 THEN 'balanced' ELSE 'light' END AS segment
FROM (SELECT ref_customer_id, count(ref_promo_applied)::DOUBLE / count(*) AS p FROM trips GROUP BY 1)""")
def _(s, root):
    per = trips(s, root).groupBy("ref_customer_id").agg(F.count("ref_promo_applied").alias("p"), F.count(F.lit(1)).alias("n"))
    return per.select("ref_customer_id", S.ratio_segment("p", "n", ((lambda x: x >= 0.4, "heavy"), (lambda x: x.between(0.3, 0.4), "balanced")), "light").alias("segment"))


@op("count_segments", "trips", f"""
SELECT ref_customer_id, CASE WHEN c >= 30 THEN 'power' WHEN c BETWEEN 20 AND 29 THEN 'regular' WHEN c >= 1 THEN 'casual' ELSE 'none' END AS segment
FROM (SELECT ref_customer_id, count(*) FILTER ({DONE}) AS c FROM trips GROUP BY 1)""")
def _(s, root):
    per = trips(s, root).groupBy("ref_customer_id").agg(AG.count_if(completed()).alias("c"))
    return per.select("ref_customer_id", S.count_segment("c", ((30, None, "power"), (20, 29, "regular"), (1, None, "casual")), "none").alias("segment"))


_project("change_labels", {"label": "CASE WHEN a > 150 AND b > 150 THEN 'Both Changed' WHEN a > 150 THEN 'Pickup Changed' WHEN b > 150 THEN 'Drop Changed' ELSE 'No Change' END"},
         lambda: {"label": S.change_label(F.col("actual_distance") * 10, F.col("estimate_total_fee") * 5)},
         base="(SELECT *, actual_distance * 10 AS a, estimate_total_fee * 5 AS b FROM trips)")
_project("priority_labels", {"label": "CASE WHEN dispatch_order = 1 AND attempt = 1 THEN 'ETA_rank_1' WHEN dispatch_order = 1 AND attempt > 1 THEN 'Driver_Score_priortised' ELSE 'Others' END",
                             "outlier": "CASE WHEN dispatch_order = 1 AND attempt = 1 THEN 'ETA_rank' WHEN dispatch_order = 1 AND attempt > 1 THEN 'Driver_Score_priortised' WHEN attempt = 1 AND dispatch_order > 1 THEN 'ETA_priortised' END"},
         lambda: {"label": S.priority_label("dispatch_order", "attempt"), "outlier": S.outlier_label("dispatch_order", "attempt")}, "offers", "offers", A.offers)
_project("settlement_formulas", {
    "cash": r("CASE WHEN upper(payment_description) LIKE '%CASH%' THEN coalesce(actual_total_fee, 0) - coalesce(actual_discount_amount, 0) ELSE 0 END"),
    "vat": r("0.05e0 * actual_commission"), "state": "CASE WHEN journey_status IN (9, 10) THEN 'Completed' ELSE 'Cancelled' END"},
    lambda: {"cash": F.col("cash_collected"), "vat": F.col("vat_on_comission"), "state": F.col("final_journey_status")},
    source=lambda s, root: settlement.settle(A.journeys(s, root).withColumn("adjustmentamount", F.lit(None).cast("double"))))
_project("text_digits", {"eta": r("TRY_CAST(regexp_replace(json_extract_string(event_properties, '$.ETA'), '[^0-9.]', '', 'g') AS DOUBLE)"), "phone": r("csat")},
         lambda: {"eta": S.digits(S.json_text("event_properties", "ETA")), "phone": S.digits(F.lit("+971 50-1"))},
         "app_events", "(SELECT *, 971501e0 AS csat FROM app_events)", A.app_events, "user_id")


@op("explicit_columns", "trips ratings", f"SELECT j.journey_id, r.rating::BIGINT AS rating, r.comment, j.ref_driver_id, r.ref_driver_id AS rated_driver_id FROM trips j JOIN ratings r USING (ref_journey_id)")
def _(s, root):
    rated = A.ratings(s, root).withColumnRenamed("ref_driver_id", "rated_driver_id")
    return trips(s, root).join(rated, "ref_journey_id").select("journey_id", "rating", "comment", "ref_driver_id", "rated_driver_id")


# ------------------------------------------------------------------ joins
@op("membership_label", "trips meter_events", f"SELECT jobnumber, driverid, {r('fareamount')} AS fareamount, coalesce(jobnumber IN (SELECT transport_authority_job_id FROM trips WHERE journey_status = 9), FALSE) AS own FROM meter_events")
def _(s, root):
    ours = A.journeys(s, root).filter("journey_status = 9")
    return J.classify_member(A.meter_events(s, root), "jobnumber", ours, "transport_authority_job_id", "own").select("jobnumber", "driverid", "fareamount", "own")


@op("membership_filter", "trips", f"SELECT journey_id FROM trips WHERE ref_customer_id IN (SELECT ref_customer_id FROM trips WHERE journey_status = 9 AND estimate_total_fee > 200)")
def _(s, root):
    rich = A.journeys(s, root).filter("journey_status = 9 AND estimate_total_fee > 200")
    return J.filter_in(A.journeys(s, root), "ref_customer_id", rich).select("journey_id")


@op("inner_join", "trips users", "SELECT journey_id, name FROM trips JOIN users ON ref_customer_id = _id")
def _(s, root):
    people = A.users(s, root).select(F.col("_id").alias("ref_customer_id"), "name")
    return lookup_join(A.journeys(s, root), people, "ref_customer_id", "inner").select("journey_id", "name")


@op("left_join", "trips users", "SELECT journey_id, meterid FROM trips LEFT JOIN users ON ref_driver_id = _id")
def _(s, root):
    drivers = A.users(s, root).select(F.col("_id").alias("ref_driver_id"), "meterid")
    return lookup_join(A.journeys(s, root), drivers, "ref_driver_id").select("journey_id", "meterid")


@op("left_join_using", "trips rated", "SELECT ref_journey_id, journey_id, rating::BIGINT AS rating FROM trips LEFT JOIN rated USING (ref_journey_id)")
def _(s, root):
    best = A.ratings(s, root).groupBy("ref_journey_id").agg(F.max("rating").alias("rating"))
    return A.journeys(s, root).join(best, "ref_journey_id", "left").select("ref_journey_id", "journey_id", "rating")


@op("left_join_not_null", "trips ratings", "SELECT journey_id, rating::BIGINT AS rating FROM trips LEFT JOIN ratings USING (ref_journey_id) WHERE rating IS NOT NULL")
def _(s, root):
    return A.journeys(s, root).join(A.ratings(s, root).select("ref_journey_id", "rating"), "ref_journey_id", "left").filter("rating IS NOT NULL").select("journey_id", "rating")


@op("composite_key_join", "ratings badges", "SELECT ref_journey_id, ref_driver_id, rating::BIGINT AS rating, badge_name FROM ratings JOIN badges USING (ref_journey_id, ref_driver_id)")
def _(s, root):
    return A.ratings(s, root).join(A.badges(s, root), ["ref_journey_id", "ref_driver_id"]).select("ref_journey_id", "ref_driver_id", "rating", "badge_name")


@op("one_row_cross_join", "trips", f"SELECT journey_id, {r('(estimate_total_fee - lo) / (hi - lo)')} AS scaled FROM trips, (SELECT min(estimate_total_fee) AS lo, max(estimate_total_fee) AS hi FROM trips)")
def _(s, root):
    j = A.journeys(s, root)
    ends = j.agg(F.min("estimate_total_fee").alias("lo"), F.max("estimate_total_fee").alias("hi"))
    return J.with_scalars(j, ends).select("journey_id", S.min_max("estimate_total_fee", "lo", "hi").alias("scaled"))


@op("metric_unpivot", "trips", f"""
SELECT ref_customer_id, unnest(['Requests', 'Spent']) AS metric, unnest([1, 2])::BIGINT AS metric_order, {r('unnest([a, b])')} AS value
FROM (SELECT ref_customer_id, count(*)::DOUBLE AS a, sum(estimate_total_fee) AS b FROM trips GROUP BY 1)""")
def _(s, root):
    per = A.journeys(s, root).groupBy("ref_customer_id").agg(F.count(F.lit(1)).alias("a"), F.sum("estimate_total_fee").alias("b"))
    return unpivot_metrics(per, ["ref_customer_id"], {"a": (1, "Requests"), "b": (2, "Spent")})


DONE_TRIPS = f"(SELECT * FROM trips WHERE {DONE})"
CANCELS = "(SELECT * FROM trips WHERE journey_status = 13)"


def _sides(s, root):
    j = A.journeys(s, root).select("ref_customer_id", "journey_id", "journey_status", CREATED)
    done = j.filter(completed()).select("ref_customer_id", F.col("journey_id").alias("done_id"), F.col(CREATED).alias("done_at"))
    return j.filter("journey_status = 13").drop("journey_status"), done


def _asof_sql(cond, order):
    return f"""SELECT a.journey_id, a.ref_customer_id, {t('a.journey_created_at')} AS journey_created_at, {t('b.journey_created_at')} AS matched_at, b.journey_id AS done_id
FROM {CANCELS} a LEFT JOIN {DONE_TRIPS} b ON a.ref_customer_id = b.ref_customer_id AND {cond}
QUALIFY row_number() OVER (PARTITION BY a.journey_id ORDER BY {order}) = 1"""


@op("asof_latest", "trips", _asof_sql("b.journey_created_at <= a.journey_created_at", "b.journey_created_at DESC, b.journey_id DESC"))
def _(s, root):
    left, right = _sides(s, root)
    return TJ.asof_within(left, right, "ref_customer_id", CREATED, "done_at", {"done_id": F.col("done_id")}, tie="done_id")


@op("asof_latest_within", "trips", _asof_sql("b.journey_created_at <= a.journey_created_at AND b.journey_created_at >= a.journey_created_at - INTERVAL 4 HOUR", "b.journey_created_at DESC, b.journey_id DESC"))
def _(s, root):
    left, right = _sides(s, root)
    return TJ.asof_within(left, right, "ref_customer_id", CREATED, "done_at", {"done_id": F.col("done_id")}, 4 * 3600, tie="done_id")


@op("next_within", "trips", _asof_sql("b.journey_created_at >= a.journey_created_at AND b.journey_created_at <= a.journey_created_at + INTERVAL 4 HOUR", "b.journey_created_at, b.journey_id"))
def _(s, root):
    left, right = _sides(s, root)
    return TJ.next_within(left, right, "ref_customer_id", CREATED, "done_at", {"done_id": F.col("done_id")}, 4 * 3600, tie="done_id")


@op("match_latest_left", "trips", f"""
SELECT b.journey_id AS done_id, a.journey_id AS cancelled_id FROM {CANCELS} a JOIN {DONE_TRIPS} b ON a.ref_customer_id = b.ref_customer_id
  AND b.journey_created_at >= a.journey_created_at AND b.journey_created_at <= a.journey_created_at + INTERVAL 4 HOUR
QUALIFY row_number() OVER (PARTITION BY b.journey_id ORDER BY a.journey_created_at DESC, a.journey_id DESC) = 1""")
def _(s, root):
    left, right = _sides(s, root)
    left = left.withColumn("cancelled_id", F.col("journey_id"))
    return TJ.match_latest_left(left, right, "ref_customer_id", CREATED, "done_at", {"cancelled_id": F.col("cancelled_id")}, 4 * 3600, left_id="cancelled_id").select("done_id", "cancelled_id")


@op("next_activity", "trips", f"""
SELECT a.journey_id, {t('min(b.journey_created_at)')} AS next_at, {n(f"coalesce(max(CASE WHEN b.journey_status IN (9, 10) THEN 1 ELSE 0 END), 0)")} AS next_done
FROM {CANCELS} a LEFT JOIN trips b ON a.ref_customer_id = b.ref_customer_id AND b.journey_created_at > a.journey_created_at
  AND b.journey_created_at <= a.journey_created_at + INTERVAL 4 HOUR GROUP BY 1""")
def _(s, root):
    left, _unused = _sides(s, root)
    right = A.journeys(s, root).select("ref_customer_id", "journey_status", F.col(CREATED).alias("at"))
    return TJ.next_activity(left, right, "ref_customer_id", CREATED, "at", 4 * 3600, completed(), "next_at", "next_done").select("journey_id", "next_at", "next_done")


GRID = ", grid AS (SELECT DISTINCT ref_customer_id, wk AS w FROM trips UNION SELECT DISTINCT ref_customer_id, wk + 7 FROM trips)"


def _grid(s, root):
    base = timed(s, root).select("ref_customer_id", F.col("booking_week").alias("week_start"))
    return union_distinct(base, base.withColumn("week_start", F.date_add("week_start", 7)))


@op("rolling_features", "trips", GRID + f"""
SELECT g.ref_customer_id, {d('g.w')} AS week_start, count(t.journey_id) AS requests, {r('coalesce(sum(t.estimate_total_fee), 0)')} AS spent
FROM grid g LEFT JOIN trips t ON t.ref_customer_id = g.ref_customer_id AND t.ld >= g.w - 14 AND t.ld < g.w GROUP BY g.ref_customer_id, g.w""")
def _(s, root):
    out = TJ.rolling_weeks(_grid(s, root), trips(s, root), "ref_customer_id", "week_start", "local_date", {"requests": F.lit(1), "spent": F.col("estimate_total_fee")})
    return out.select("ref_customer_id", "week_start", F.coalesce("requests", F.lit(0)).alias("requests"), F.coalesce("spent", F.lit(0.0)).alias("spent"))


@op("active_within_label", "trips", GRID + f"""
SELECT ref_customer_id, {d('w')} AS week_start, {n('EXISTS (SELECT 1 FROM trips t WHERE t.ref_customer_id = g.ref_customer_id AND t.ld > g.w AND t.ld <= g.w + 10)')} AS active FROM grid g""")
def _(s, root):
    return TJ.active_within(_grid(s, root), trips(s, root), "ref_customer_id", "week_start", "local_date", 10, "active")


@op("count_before_week", "trips", GRID + f"""
SELECT ref_customer_id, {d('w')} AS week_start, (SELECT count(*) FROM trips t WHERE t.ref_customer_id = g.ref_customer_id AND t.ld < g.w) AS earlier FROM grid g""")
def _(s, root):
    return TJ.count_before(_grid(s, root), trips(s, root), "ref_customer_id", "week_start", "local_date", "earlier")


@op("exists_within_flag", "trips complaints", f"""
SELECT journey_id, {n('EXISTS (SELECT 1 FROM complaints c WHERE c.ref_customer_id = t.ref_customer_id AND c.at BETWEEN t.lts AND t.lts + INTERVAL 24 HOUR)')} AS complained FROM trips t""")
def _(s, root):
    said = complaints(A.tickets(s, root), A.users(s, root))
    base = trips(s, root).select("journey_id", "ref_customer_id", "local_ts")
    return TJ.exists_within(base, said, "ref_customer_id", "local_ts", "complaint_ts", 86400, "complained").select("journey_id", "complained")


@op("count_within_window", "trips", "SELECT journey_id, (SELECT count(*) FROM trips b WHERE b.ref_customer_id = t.ref_customer_id AND b.lts > t.lts AND b.lts <= t.lts + INTERVAL 6 HOUR) AS following FROM trips t")
def _(s, root):
    base = A.journeys(s, root).select("journey_id", "ref_customer_id", CREATED)
    return TJ.count_within(base, "ref_customer_id", CREATED, 6 * 3600, "following").select("journey_id", "following")


@op("parent_compare", "linked", f"SELECT c.journey_id, {r('c.dispatch_eta - p.dispatch_eta')} AS eta_diff FROM linked c JOIN linked p ON c.ref_parent_journey_id = p.ref_journey_id")
def _(s, root):
    rows = A.with_parents(A.journeys(s, root)).select("journey_id", "ref_journey_id", "ref_parent_journey_id", "dispatch_eta")
    both = J.parent_compare(rows, "ref_journey_id", "ref_parent_journey_id", {"parent_eta": F.col("dispatch_eta")})
    return both.select("journey_id", (F.col("dispatch_eta") - F.col("parent_eta")).alias("eta_diff"))


@op("chain_expansion", "linked", f""", chain AS (
  SELECT ref_journey_id, ref_journey_id AS root_id, 0 AS level FROM linked WHERE ref_parent_journey_id IS NULL
  UNION ALL SELECT c.ref_journey_id, p.root_id, p.level + 1 FROM linked c JOIN chain p ON c.ref_parent_journey_id = p.ref_journey_id)
SELECT ref_journey_id, root_id, {n('level')} AS level FROM chain""", recursive=True)
def _(s, root):
    rows = A.with_parents(A.journeys(s, root)).select("ref_journey_id", "ref_parent_journey_id")
    return expand_chains(rows, "ref_journey_id", "ref_parent_journey_id", F.lit(True)).select("ref_journey_id", "root_id", "level")


@op("zone_lookup", "trips pickup_zone", "SELECT journey_id, z.name AS hood, z.zone_name AS zone FROM trips LEFT JOIN pickup_zone z USING (journey_id)")
def _(s, root):
    points = A.journeys(s, root).select("journey_id", "pickup_longitude", "pickup_latitude")
    return zone_join(points, A.zones(s, root), "pickup_longitude", "pickup_latitude", "geom", "name", {"hood": "name", "zone": "zone_name"}).select("journey_id", "hood", "zone")


@op("alternate_key_join", "tickets users", "SELECT user_properties_phone_number, initiated_at, _id FROM tickets JOIN (SELECT DISTINCT mobilenumber, _id FROM users) ON mobilenumber = user_properties_phone_number")
def _(s, root):
    phones = A.users(s, root).select(F.col("mobilenumber").alias("user_properties_phone_number"), "_id").dropDuplicates()
    return lookup_join(A.tickets(s, root), phones, "user_properties_phone_number", "inner").select("user_properties_phone_number", "initiated_at", "_id")


@op("before_after_event", "trips", f"""
SELECT e.ref_customer_id, {t('e.x')} AS first_cancel, count(DISTINCT journey_id) FILTER (t.lts < e.x) AS earlier,
  count(DISTINCT journey_id) FILTER (t.lts > e.x AND {DONE}) AS later_done
FROM (SELECT ref_customer_id, min(lts) AS x FROM trips WHERE journey_status = 13 GROUP BY 1) e LEFT JOIN trips t USING (ref_customer_id) GROUP BY e.ref_customer_id, e.x""")
def _(s, root):
    j = trips(s, root)
    first = j.filter("journey_status = 13").groupBy("ref_customer_id").agg(F.min("local_ts").alias("first_cancel"))
    return TJ.before_after(first, j.select("ref_customer_id", "journey_id", "journey_status", "local_ts"), "ref_customer_id", "first_cancel", "local_ts", "journey_id", {"earlier": F.lit(True)}, {"later_done": completed()})


# ------------------------------------------------------------------ aggregates
@op("badge_list", "badges", "SELECT ref_journey_id, ref_driver_id, string_agg(badge_name, ', ' ORDER BY badge_name) AS badge_names FROM badges GROUP BY 1, 2")
def _(s, root):
    return AG.listagg(A.badges(s, root), ["ref_journey_id", "ref_driver_id"], "badge_name", "badge_names")


def _agg(name, keys, columns: dict, fn, frames="trips", base="trips", source=timed, having=""):
    """A grouped aggregate: `keys` maps outputs to (SQL, Spark column)."""
    picked = [f"{e[0]} AS {k}" for k, e in keys.items()] + [f"{e} AS {c}" for c, e in columns.items()]
    group = f" GROUP BY {', '.join(str(i + 1) for i in range(len(keys)))}" if keys else ""

    @op(name, frames, f"SELECT {', '.join(picked)} FROM {base}{group}{having}")
    def _(s, root):
        return fn(source(s, root).groupBy(*[e[1]().alias(k) for k, e in keys.items()]))



def _by(*names):
    return {name: (name, lambda name=name: F.col(name)) for name in names}


fee = "estimate_total_fee"
_agg("grouped_aggregates", _by("ref_driver_id"), {"n": "count(*)", "total": r(f"sum({fee})"), "mean": r(f"avg({fee})"), "low": r(f"min({fee})"), "high": r(f"max({fee})")},
     lambda g: g.agg(F.count(F.lit(1)).alias("n"), F.sum(fee).alias("total"), F.avg(fee).alias("mean"), F.min(fee).alias("low"), F.max(fee).alias("high")))
_agg("ordinal_grouping", _by("journey_status", "supplier_name"), {"n": "count(*)"}, lambda g: g.agg(F.count(F.lit(1)).alias("n")), base="(SELECT * REPLACE (journey_status::BIGINT AS journey_status) FROM trips)")
_agg("count_distinct", _by("ref_driver_id"), {"customers": "count(DISTINCT ref_customer_id)"}, lambda g: g.agg(F.countDistinct("ref_customer_id").alias("customers")))
_agg("conditional_counts", _by("ref_driver_id"), {"done": f"count(*) FILTER ({DONE})", "done_customers": f"count(DISTINCT ref_customer_id) FILTER ({DONE})"},
     lambda g: g.agg(AG.count_if(completed()).alias("done"), AG.count_distinct_if("ref_customer_id", completed()).alias("done_customers")))
_agg("conditional_means", _by("ref_driver_id"), {"mean_done": r(f"avg({fee}) FILTER ({DONE})"), "promo_share": r("avg(CASE WHEN ref_promo_applied IS NOT NULL THEN 1e0 ELSE 0e0 END)")},
     lambda g: g.agg(AG.avg_if(fee, completed()).alias("mean_done"), AG.share(F.col("ref_promo_applied").isNotNull()).alias("promo_share")))
_agg("guarded_rate", _by("ref_driver_id"), {"rate": r(f"count(*) FILTER ({DONE}) * 100e0 / nullif(count(*) FILTER (journey_status <> 12), 0)")},
     lambda g: g.agg(AG.rate(AG.count_if(completed()), AG.count_if(F.col("journey_status") != 12), 100.0).alias("rate")))
_agg("global_aggregate", {}, {"n": "count(*)", "customers": "count(DISTINCT ref_customer_id)", "total": r(f"sum({fee})")},
     lambda g: g.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("ref_customer_id").alias("customers"), F.sum(fee).alias("total")))
_agg("sample_stddev", _by("ref_customer_id"), {"spread": r("stddev_samp(actual_total_fee)")}, lambda g: g.agg(F.stddev_samp("actual_total_fee").alias("spread")))
_agg("flag_rollup", _by("ref_customer_id"), {"any_limo": n("max(CASE WHEN cls = 'Limo' THEN 1 ELSE 0 END)"), "cancels": n("sum(CASE WHEN journey_status = 13 THEN 1 ELSE 0 END)")},
     lambda g: g.agg(AG.any_flag(F.col("vehicle_cat") == "Limo").alias("any_limo"), AG.sum_flag(F.col("journey_status") == 13).alias("cancels")))
_agg("first_last_event", _by("ref_customer_id"), {"first_at": t("min(lts)"), "last_at": t("max(lts)")}, lambda g: g.agg(F.min("local_ts").alias("first_at"), F.max("local_ts").alias("last_at")))
_agg("value_histogram", {"bin": (r("round(actual_distance, 0)"), lambda: F.round("actual_distance", 0))}, {"n": "count(*)"}, lambda g: g.agg(F.count(F.lit(1)).alias("n")))
_agg("active_weeks", _by("ref_customer_id"), {"weeks": "count(DISTINCT week(lts))", "year_weeks": "count(DISTINCT wk)"},
     lambda g: g.agg(F.countDistinct(TM.iso_week(F.col("local_ts"))).alias("weeks"), F.countDistinct(TM.iso_year_week(F.col("local_ts"))).alias("year_weeks")))
_agg("post_aggregate_filter", _by("ref_customer_id"), {"n": "count(*)"}, lambda g: g.agg(F.count(F.lit(1)).alias("n")).filter("n > 60"), having=" HAVING count(*) > 60")


@op("distinct_sums", "event_offers", f"""
SELECT driver_id, count(DISTINCT journey_id) AS offered, count(DISTINCT journey_id) FILTER (lower(trim(driver_action)) LIKE 'accept%') AS accepted FROM event_offers GROUP BY 1""")
def _(s, root):
    return AG.distinct_sums(A.event_offers(s, root), ["driver_id"], "journey_id", {"offered": F.lit(True), "accepted": F.lower(F.trim("driver_action")).like("accept%")})


@op("exact_percentile", "trips", f"SELECT ref_customer_id, {r('quantile_cont(actual_total_fee, 0.7)')} AS p70 FROM trips WHERE actual_total_fee IS NOT NULL GROUP BY 1")
def _(s, root):
    return AG.exact_percentile(A.journeys(s, root), "ref_customer_id", "actual_total_fee", 0.7, "p70")


@op("distinct_rows", "offers", "SELECT DISTINCT journey_id, driver_id FROM offers")
def _(s, root):
    return A.offers(s, root).select("journey_id", "driver_id").distinct()


@op("two_level_aggregate", "trips", f"SELECT pickup_zone_name, {r('avg(c)')} AS mean_trips, {n('max(c)')} AS most_trips FROM (SELECT pickup_zone_name, ref_customer_id, count(*) AS c FROM trips GROUP BY 1, 2) GROUP BY 1")
def _(s, root):
    per = A.journeys(s, root).groupBy("pickup_zone_name", "ref_customer_id").agg(F.count(F.lit(1)).alias("c"))
    return per.groupBy("pickup_zone_name").agg(F.avg("c").alias("mean_trips"), F.max("c").alias("most_trips"))


@op("histogram_of_counts", "trips", "SELECT trips, count(*) AS customers FROM (SELECT ref_customer_id, count(*) AS trips FROM trips GROUP BY 1) GROUP BY 1")
def _(s, root):
    return AG.histogram_of_counts(A.journeys(s, root), "ref_customer_id", F.count(F.lit(1)), "trips", "customers")


@op("aggregate_before_join", "trips adjustments", f"SELECT journey_id, {r('adj')} AS adj FROM trips JOIN (SELECT journeyid, sum(adjustmentamount) AS adj FROM adjustments GROUP BY 1) ON journeyid = journey_id")
def _(s, root):
    sums = A.adjustments(s, root).groupBy(F.col("journeyid").alias("journey_id")).agg(F.sum("adjustmentamount").alias("adj"))
    return A.journeys(s, root).join(sums, "journey_id").select("journey_id", "adj")


# ------------------------------------------------------------------ windows
BY_CUSTOMER = "OVER (PARTITION BY ref_customer_id ORDER BY journey_created_at, journey_id)"
ORDER = [CREATED, "journey_id"]


def _ordered(name, sql, fn):
    @op(name, "trips", f"SELECT journey_id, {sql} FROM trips")
    def _(s, root):
        return fn(A.journeys(s, root).select("journey_id", "ref_customer_id", "journey_status", CREATED))


_ordered("sequence_number", f"row_number() {BY_CUSTOMER} AS seq", lambda j: O.seq_num(j, "ref_customer_id", ORDER).select("journey_id", "seq"))
_ordered("rank_with_ties_broken", "row_number() OVER (PARTITION BY ref_customer_id ORDER BY journey_status DESC, journey_id) AS seq",
         lambda j: O.seq_num(j, "ref_customer_id", ["-journey_status", "journey_id"]).select("journey_id", "seq"))
_ordered("prior_count", f"row_number() {BY_CUSTOMER} - 1 AS prior", lambda j: O.prior_count(j, "ref_customer_id", ORDER).select("journey_id", "prior"))
_ordered("lead_lag", f"lag(journey_id) {BY_CUSTOMER} AS previous, lead(journey_status) {BY_CUSTOMER}::BIGINT AS next_status",
         lambda j: O.neighbours(j, "ref_customer_id", ORDER, {"previous": F.col("journey_id")}, {"next_status": F.col("journey_status")}).select("journey_id", "previous", "next_status"))
_ordered("cumulative_counters", f"count(*) FILTER ({DONE}) {BY_CUSTOMER} AS done, count(*) FILTER (journey_status = 13) {BY_CUSTOMER} AS cancelled",
         lambda j: O.cumulative(j, "ref_customer_id", ORDER, {"done": S.status_flag("journey_status", V.COMPLETED).cast("long"), "cancelled": S.status_flag("journey_status", (13,)).cast("long")}).select("journey_id", "done", "cancelled"))


@op("keep_latest", "devices", "SELECT refuserid, _id FROM devices QUALIFY row_number() OVER (PARTITION BY refuserid ORDER BY updatedat DESC) = 1")
def _(s, root):
    return D.keep_first(A.devices(s, root), "refuserid", ["-updatedat", "_id"]).select("refuserid", "_id")


@op("keep_group_maximum", "offers", "SELECT journey_id, driver_id, attempt::BIGINT AS attempt FROM offers QUALIFY attempt = max(attempt) OVER (PARTITION BY journey_id)")
def _(s, root):
    return D.keep_max(A.offers(s, root), "journey_id", "attempt").select("journey_id", "driver_id", "attempt")


@op("group_minmax_score", "offers", f"""
SELECT journey_id, driver_id, dispatch_order::BIGINT AS dispatch_order, {r('CASE WHEN hi = lo THEN 1e0 ELSE (hi - estimate_distance) / (hi - lo) END')} AS score
FROM (SELECT *, min(estimate_distance) OVER (PARTITION BY journey_id) AS lo, max(estimate_distance) OVER (PARTITION BY journey_id) AS hi FROM offers)""")
def _(s, root):
    return D.minmax_score(A.offers(s, root), "journey_id", "estimate_distance", "score", invert=True).select("journey_id", "driver_id", "dispatch_order", "score")


@op("top_k_hit", "offers", f"""
SELECT journey_id, {n('count(*) FILTER (er <= 3 AND dr <= 3)')} AS hits FROM (SELECT *,
  row_number() OVER (PARTITION BY journey_id ORDER BY estimate_distance, driver_id, dispatch_order) AS er,
  row_number() OVER (PARTITION BY journey_id ORDER BY latitude, driver_id, dispatch_order) AS dr FROM offers) WHERE dr <= 3 GROUP BY 1""")
def _(s, root):
    base = A.offers(s, root).select("journey_id", "driver_id", "dispatch_order", "estimate_distance", "latitude")
    ranked = O.seq_num(base, "journey_id", ["estimate_distance", "driver_id", "dispatch_order"], "er")
    near = D.top_k(ranked, "journey_id", ["latitude", "driver_id", "dispatch_order"], 3)
    return near.groupBy("journey_id").agg(AG.count_if(F.col("er") <= 3).alias("hits"))


@op("blended_rank", "offers driver_scores", f"""
SELECT journey_id, driver_id, dispatch_order::BIGINT AS dispatch_order, row_number() OVER (PARTITION BY journey_id
  ORDER BY 0.8e0 * (1e0 / estimate_distance) + 0.2e0 * final_score DESC NULLS FIRST, driver_id, dispatch_order, estimate_distance) AS rnk
FROM offers LEFT JOIN (SELECT * FROM driver_scores WHERE run_date = DATE '2024-01-22') ON ref_driver_id = driver_id""")
def _(s, root):
    picked = sinks.snapshot_asof(A.driver_scores(s, root), dt.date(2024, 1, 22)).withColumnRenamed("ref_driver_id", "driver_id")
    rows = lookup_join(A.offers(s, root), picked, "driver_id").withColumn("blend", F.lit(0.8) * (F.lit(1.0) / F.col("estimate_distance")) + F.lit(0.2) * F.col("final_score"))
    return O.seq_num(rows, "journey_id", ["-blend", "driver_id", "dispatch_order", "estimate_distance"], "rnk").select("journey_id", "driver_id", "dispatch_order", "rnk")


# ------------------------------------------------------------------ sort, limit, sets
@op("final_sort", "trips", "SELECT ref_driver_id, count(*) AS n FROM trips GROUP BY 1 ORDER BY n DESC, ref_driver_id")
def _(s, root):
    return A.journeys(s, root).groupBy("ref_driver_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "ref_driver_id")


@op("limit_sample", "trips", f"SELECT journey_id, {r(fee)} AS estimate_total_fee FROM trips ORDER BY estimate_total_fee DESC, journey_id LIMIT 10")
def _(s, root):
    return A.journeys(s, root).orderBy(F.desc(fee), "journey_id").limit(10).select("journey_id", fee)


@op("top_k_per_group", "trips", f"SELECT ref_driver_id, journey_id, row_number() OVER (PARTITION BY ref_driver_id ORDER BY estimate_total_fee DESC, journey_id) AS pos FROM trips QUALIFY pos <= 3")
def _(s, root):
    return D.top_k(A.journeys(s, root), "ref_driver_id", ["-" + fee, "journey_id"], 3, "pos").select("ref_driver_id", "journey_id", "pos")


@op("union_all_slices", "trips", f"SELECT 'day' AS grain, {d('ld')} AS period, count(*) AS n FROM trips GROUP BY 2 UNION ALL SELECT 'week', {d('wk')}, count(*) FROM trips GROUP BY 2")
def _(s, root):
    j = timed(s, root)
    part = lambda grain, c: j.groupBy(F.col(c).alias("period")).agg(F.count(F.lit(1)).alias("n")).withColumn("grain", F.lit(grain))
    return union_all(part("day", "local_date"), part("week", "booking_week"))


@op("union_distinct", "trips", f"SELECT ref_customer_id, {d('wk')} AS week FROM trips UNION SELECT ref_customer_id, {d('max(wk) + 7')} FROM trips GROUP BY 1")
def _(s, root):
    j = timed(s, root).select("ref_customer_id", F.col("booking_week").alias("week"))
    return union_distinct(j, j.groupBy("ref_customer_id").agg(F.date_add(F.max("week"), 7).alias("week")))


@op("literal_relation", "trips", f"SELECT label, count(*) AS n FROM trips JOIN (VALUES (9, 'paid'), (10, 'done'), (13, 'cancelled')) AS v(code, label) ON code = journey_status GROUP BY 1")
def _(s, root):
    names = literal_rows(s, [(9, "paid"), (10, "done"), (13, "cancelled")], "journey_status int, label string")
    return A.journeys(s, root).join(names, "journey_status").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ scalar functions
L = lambda: F.col("local_ts")
_project("local_time", {"local_ts": t("lts")}, lambda: {"local_ts": TM.local_ts(CREATED)})
_project("local_date_hour", {"day": d("ld"), "hr": n("lh")}, lambda: {"day": TM.local_date(CREATED), "hr": TM.local_hour(CREATED)})
_project("weekday_name", {"wd": "wd"}, lambda: {"wd": TM.weekday_name(L())})
_project("day_of_week", {"dow": n("dayofweek(lts)")}, lambda: {"dow": TM.day_of_week(L())})
_project("iso_week", {"wk_no": n("week(lts)")}, lambda: {"wk_no": TM.iso_week(L())})
_project("truncate_week_month", {"w": d("wk"), "m": d("date_trunc('month', lts)")}, lambda: {"w": TM.week_start(L()), "m": TM.month_start(L())})
_project("date_steps", {"later": d("ld + 6"), "plus": t("lts + INTERVAL 15 MINUTE")}, lambda: {"later": F.date_add("local_date", 6), "plus": L() + F.expr("INTERVAL '15' MINUTE")})
_project("boundary_difference", {
    "s": "epoch(date_trunc('second', arrived_at_pickup_timestamp))::BIGINT - epoch(date_trunc('second', on_route_timestamp))::BIGINT",
    "m": "date_diff('minute', on_route_timestamp, arrived_at_pickup_timestamp)", "dd": "date_diff('day', lts, TIMESTAMP '2024-02-01')"},
    lambda: {"s": TM.seconds_between("on_route_timestamp", "arrived_at_pickup_timestamp"), "m": TM.minutes_between("on_route_timestamp", "arrived_at_pickup_timestamp"), "dd": TM.days_between(L(), F.lit(dt.date(2024, 2, 1)))})
_project("elapsed_minutes", {"m": r("(epoch_us(journey_completed_timestamp) - epoch_us(journey_start_timestamp)) / 6e7")},
         lambda: {"m": TM.minutes_elapsed("journey_start_timestamp", "journey_completed_timestamp")})
_project("date_text", {"at": t("strptime(initiated_at, '%m/%d/%Y %H:%M')"), "day": "strftime(strptime(initiated_at, '%m/%d/%Y %H:%M'), '%Y-%m-%d')"},
         lambda: {"at": TM.parse_ticket_time(F.col("initiated_at")), "day": F.date_format(TM.parse_ticket_time(F.col("initiated_at")), "yyyy-MM-dd")},
         "tickets", "tickets", A.tickets, "user_properties_phone_number")
_project("as_of_parameter", {"idle": "date_diff('day', ld, DATE '2024-01-25')"}, lambda: {"idle": TM.days_between("local_date", F.lit(AS_OF))})
_project("arithmetic", {"a": r("round(abs(actual_distance - 20) / 7, 3)"), "e": r("exp(actual_tip_amount)"), "g": r("greatest(actual_total_fee, actual_discount_amount)"), "l": r("least(actual_total_fee, actual_discount_amount)")},
         lambda: {"a": F.round(F.abs(F.col("actual_distance") - 20) / 7, 3), "e": F.exp("actual_tip_amount"), "g": F.greatest("actual_total_fee", "actual_discount_amount"), "l": F.least("actual_total_fee", "actual_discount_amount")})
_project("trigonometry", {"c": r("cos(radians(pickup_latitude))"), "s": r("sin(radians(pickup_latitude))"), "a": r("acos(pickup_latitude / 100)")},
         lambda: {"c": F.cos(F.radians("pickup_latitude")), "s": F.sin(F.radians("pickup_latitude")), "a": F.acos(F.col("pickup_latitude") / 100)})
_project("null_handling", {"a": r("nullif(actual_tip_amount, 0)"), "b": r("coalesce(dispatch_eta_sec, first_eta)"), "c": "journey_status::VARCHAR"},
         lambda: {"a": F.nullif("actual_tip_amount", F.lit(0.0)), "b": F.coalesce("dispatch_eta_sec", "first_eta"), "c": F.col("journey_status").cast("string")})
_project("text_functions", {"a": "upper(trim(driver_action))", "b": "lower(trim(driver_action)) LIKE 'accept%'", "c": "driver_action ILIKE '%ELAPSED%'", "e": "journey_id || ':' || driver_id"},
         lambda: {"a": F.upper(F.trim("driver_action")), "b": F.lower(F.trim("driver_action")).like("accept%"), "c": F.col("driver_action").ilike("%ELAPSED%"), "e": F.concat("journey_id", F.lit(":"), "driver_id")}, "offers", "offers", A.offers)
_project("json_path", {"device": "json_extract_string(devices, '$.devices[0].deviceId')", "os": "json_extract_string(devices, '$.devices[0].deviceOs')", "none": "json_extract_string(devices, '$.devices[1].deviceId')"},
         lambda: {"device": S.json_text("devices", "devices", 0, "deviceId"), "os": S.json_text("devices", "devices", 0, "deviceOs"), "none": S.json_text("devices", "devices", 1, "deviceId")}, "devices", "devices", A.devices, "_id")
_project("json_array_element", {"lat": r("json_extract_string(routes, '$[0].lat')::DOUBLE"), "lng": r("json_extract_string(routes, '$[1].lng')::DOUBLE")},
         lambda: {"lat": S.json_text("routes", 0, "lat").try_cast("double"), "lng": S.json_text("routes", 1, "lng").try_cast("double")}, "fare_views", "fare_views", A.fare_views, "customerid")
_project("variant_value", {"k": "json_extract_string(props, '$.k')::BIGINT", "txt": "'{\"k\":' || json_extract_string(props, '$.k') || '}'"},
         lambda: {"k": F.variant_get(F.parse_json("props"), "$.k", "bigint"), "txt": F.to_json(F.parse_json("props"))}, "", "events", lambda s, root: read_table(s, "events", root), "event_id")
_project("regex_to_number", {"num": r("TRY_CAST(regexp_replace(props, '[^0-9.]', '', 'g') AS DOUBLE)")}, lambda: {"num": S.digits("props")}, "", "events", lambda s, root: read_table(s, "events", root), "event_id")
_project("sphere_distance", {"m": r(dist("pickup_longitude", "pickup_latitude", "actual_drop_off_longitude", "actual_drop_off_latitude"), 4)},
         lambda: {"m": F.round(sphere_distance("pickup_longitude", "pickup_latitude", "actual_drop_off_longitude", "actual_drop_off_latitude"), 4)})
_project("cosine_distance", {"km": r("6371e0 * acos(greatest(-1e0, least(1e0, cos(radians(pickup_latitude)) * cos(radians(estimate_drop_off_latitude)) * cos(radians(pickup_longitude) - radians(estimate_drop_off_longitude)) + sin(radians(pickup_latitude)) * sin(radians(estimate_drop_off_latitude)))))", 3)},
         lambda: {"km": F.round(cosine_distance_km("pickup_longitude", "pickup_latitude", "estimate_drop_off_longitude", "estimate_drop_off_latitude"), 3)})


@op("polygon_area_containment", "zones edges areas", f"""
SELECT a.name, {r('any_value(a.area)', 8)} AS area, {n("count(*) FILTER ((e.y1 > 25.05::DOUBLE) <> (e.y2 > 25.05::DOUBLE) AND 55.05::DOUBLE < (e.x2 - e.x1) * (25.05::DOUBLE - e.y1) / (e.y2 - e.y1) + e.x1) % 2")} = 1 AS has_point
FROM areas a JOIN edges e USING (name) GROUP BY 1""")
def _(s, root):
    z = A.zones(s, root).withColumn("edges", ring_edges("geom"))
    return z.select("name", F.round(ring_area("edges"), 8).alias("area"), ring_contains("edges", F.lit(55.05), F.lit(25.05)).alias("has_point"))


_project("logistic_transform", {"p": r("1e0 / (1e0 + exp(-7e0 * (greatest(least(actual_distance / 40, 0.999999::DOUBLE), 0.000001::DOUBLE) - 0.5e0)))")},
         lambda: {"p": S.logistic(F.col("actual_distance") / 40, 0.5, 7.0)})


@op("minmax_scaling", "trips", f"SELECT journey_id, {r('(actual_distance - lo) / nullif(hi - lo, 0)')} AS scaled, {r('(actual_base_fee - f) / nullif(f - f, 0)')} AS flat FROM trips, (SELECT min(actual_distance) AS lo, max(actual_distance) AS hi, min(actual_base_fee) AS f FROM trips)")
def _(s, root):
    j = A.journeys(s, root)
    ends = j.agg(F.min("actual_distance").alias("lo"), F.max("actual_distance").alias("hi"), F.min("actual_base_fee").alias("f"))
    return J.with_scalars(j, ends).select("journey_id", S.min_max("actual_distance", "lo", "hi").alias("scaled"), S.min_max("actual_base_fee", "f", "f").alias("flat"))


_project("composite_id", {"uid": "driverid || '-' || jobnumber || '-' || eventname"}, lambda: {"uid": S.composite_id("driverid", "jobnumber", "eventname")}, "meter_events", "meter_events", A.meter_events, "driverid")
