"""Ride-hailing frames derived from the driver tables, by fixed arithmetic on their keys.

They stand in for the warehouse tables, which are not published. `checks/frames_sql.py` derives the
same frames in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.fixed_values import TAXI_CATEGORIES
from ..operators.ordered import neighbours
from .tables import read_table

LIMO_CATEGORY = "limo"
PLACES = ("Dubai Mall Gate", "Metro Station", "City School", "University Road", "Marina Walk", "Creek Park")
ZONE_NAMES = ("Mall of", "Airport", "Metro", "School", "University", "Downtown")


def _later(ts: str, seconds: str) -> str:
    return f"timestampadd(SECOND, cast({seconds} as int), {ts})"


def _cycle(values, index: str) -> str:
    return f"element_at(array({', '.join(repr(v) for v in values)}), cast({index} as int) + 1)"


def journeys(spark: SparkSession, root: str) -> DataFrame:
    """One trip request per event."""
    e = read_table(spark, "events", root)
    done = "event_type IN ('purchase', 'view')"
    cancelled = "event_type IN ('click', 'error')"
    base = e.selectExpr(
        "*",
        "CASE event_type WHEN 'purchase' THEN 9 WHEN 'view' THEN 10 WHEN 'click' THEN 13 WHEN 'error' THEN 14 "
        "ELSE CASE event_id % 6 WHEN 0 THEN 19 WHEN 3 THEN 12 ELSE 15 END END AS journey_status",
        _later("ts", "event_id % 120") + " AS on_route_timestamp",
        _later("ts", "event_id % 60") + " AS accepted_ride_timestamp",
        _later("ts", "event_id % 120 + event_id * 31 % 900") + " AS arrived_at_pickup_timestamp",
        "CASE WHEN event_id % 11 <> 0 THEN cast(60 + event_id * 37 % 600 AS double) END AS dispatch_eta_sec",
        "55.0D + ((user_id * 7 + event_id) % 1000) / 2000.0D AS pickup_longitude",
        "25.0D + ((user_id * 13 + event_id * 3) % 1000) / 2000.0D AS pickup_latitude",
        "(event_id % 9) / 10000.0D AS shift",
    )
    return base.selectExpr(
        "concat('J', event_id) AS journey_id",
        "concat('R', event_id) AS ref_journey_id",
        "concat('C', user_id) AS ref_customer_id",
        "concat('CUS_', user_id) AS customer_id",
        "CASE WHEN event_id % 17 <> 0 THEN concat('D', event_id % 50) END AS ref_driver_id",
        "CASE WHEN event_id % 17 <> 0 THEN concat('DRV_', event_id % 50) END AS driver_id",
        f"CASE WHEN event_id % 44 = 0 THEN NULL WHEN event_id % 4 = 0 THEN '{LIMO_CATEGORY}' "
        f"WHEN event_id % 4 = 1 THEN '{TAXI_CATEGORIES[0]}' ELSE '{TAXI_CATEGORIES[1]}' END AS ref_vehicle_category_id",
        "CASE WHEN event_id % 4 = 0 THEN 1 ELSE 2 END AS vehicle_category_type",
        "journey_status",
        "CASE journey_status WHEN 9 THEN 'PAYMENT_RECEIVED' WHEN 10 THEN 'JOURNEY_COMPLETED' "
        "ELSE 'CANCELLED' END AS journey_status_desc",
        "CASE WHEN event_id % 8 = 0 THEN 2 ELSE 1 END AS journey_type",
        "ts AS journey_created_at",
        _later("ts", "3600 + 86400 * (event_id % 3)") + " AS updated_at",
        "accepted_ride_timestamp", "on_route_timestamp", "arrived_at_pickup_timestamp",
        f"CASE WHEN {done} THEN {_later('arrived_at_pickup_timestamp', '60')} END AS journey_start_timestamp",
        f"CASE WHEN {done} THEN {_later('arrived_at_pickup_timestamp', 'event_id * 13 % 3600')} END "
        "AS journey_completed_timestamp",
        f"CASE WHEN {cancelled} THEN {_later('ts', 'event_id * 7 % 300')} END AS journey_cancel_timestamp",
        "ts AS pickup_time",
        f"CASE WHEN {done} THEN {_later('arrived_at_pickup_timestamp', 'event_id * 13 % 3600')} END "
        "AS actual_drop_off_time",
        "dispatch_eta_sec", "dispatch_eta_sec / 60.0D AS dispatch_eta",
        "cast(5 + event_id % 7 AS double) AS first_eta",
        "pickup_longitude", "pickup_latitude",
        "pickup_longitude + 0.01D AS estimate_drop_off_longitude",
        "pickup_latitude + 0.02D AS estimate_drop_off_latitude",
        "pickup_longitude + 0.01D + shift AS actual_drop_off_longitude",
        "pickup_latitude + 0.02D + shift AS actual_drop_off_latitude",
        "pickup_longitude + 0.003D AS driver_pickup_longitude",
        "pickup_latitude + 0.001D AS driver_pickup_latitude",
        "pickup_longitude + shift AS dispatch_longitude", "pickup_latitude - shift AS dispatch_latitude",
        _cycle(PLACES, "event_id % 6") + " AS pickup_location",
        _cycle(PLACES, "event_id * 5 % 6") + " AS drop_off_location",
        "concat('Z', user_id % 5) AS pickup_zone_name", "concat('Z', event_id % 5) AS drop_off_zone_name",
        "value AS estimate_total_fee",
        f"CASE WHEN {done} THEN value * (1.0D + ((event_id % 41) - 10) / 100.0D) END AS actual_total_fee",
        "5.0D AS actual_base_fee", "value * 0.5D AS actual_total_distance_fee",
        "value * 0.25D AS actual_total_time_fee",
        "(event_id % 400) / 10.0D AS actual_distance",
        "CASE WHEN event_id % 5 <> 0 THEN cast(event_id % 7 AS double) END AS actual_discount_amount",
        "cast(event_id % 3 AS double) AS actual_tip_amount",
        "CASE WHEN event_id % 10 <> 0 THEN value * 0.15D END AS actual_commission",
        "cast(event_id % 4 AS double) AS actual_booking_extra_fee",
        "2.0D AS actual_rta_fee", "4.0D * (event_id % 2) AS actual_salik_fee",
        "cast(event_id % 6 AS double) AS actual_parking_fee",
        "cast(event_id % 9 AS double) AS actual_interemirate_fee",
        "1.0D + (event_id % 3) / 10.0D AS actual_peak_multiplier",
        f"CASE WHEN {cancelled} AND event_id % 2 = 0 THEN 10.0D END AS actual_total_cancellation_fee",
        "CASE WHEN event_id % 3 = 0 THEN concat('P', event_id % 12) END AS ref_promo_applied",
        "CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'CASH' ELSE 'CARD' END AS payment_description",
        _cycle(("Kabi", "National Taxi", "DTC"), "event_id % 3") + " AS supplier_name",
        "concat('Driver ', event_id % 50) AS driver_name",
        "cast(event_id AS string) AS transport_authority_job_id",
    )


def with_parents(frame: DataFrame) -> DataFrame:
    """Link each request to the customer's previous one, if that was not completed and is at most 12 h old."""
    linked = neighbours(
        frame, "ref_customer_id", ["journey_created_at", "journey_id"],
        lags={"_prev": F.struct("ref_journey_id", "journey_status", "journey_created_at")},
    )
    close = F.col("_prev.journey_created_at") >= F.col("journey_created_at") - F.expr("INTERVAL '12' HOUR")
    failed = ~F.col("_prev.journey_status").isin(9, 10)
    return linked.withColumn(
        "ref_parent_journey_id", F.when(close & failed, F.col("_prev.ref_journey_id"))
    ).drop("_prev")


def offers(spark: SparkSession, root: str) -> DataFrame:
    """One dispatch offer per order line."""
    return read_table(spark, "lineitem", root).selectExpr(
        "concat('O', l_orderkey) AS journey_id", "concat('D', l_suppkey) AS driver_id",
        "1 + l_linenumber % 2 AS attempt", "l_linenumber AS dispatch_order",
        "l_extendedprice / 1000.0D AS distance_from_pickup",
        "CASE WHEN l_partkey % 29 <> 0 THEN l_quantity END AS estimate_eta",
        "l_extendedprice AS estimate_distance", "l_linestatus = 'F' AS is_dispatched",
        "CASE l_returnflag WHEN 'A' THEN ' Accepted' WHEN 'R' THEN 'Rejected' ELSE 'Time Elapsed' END AS driver_action",
        "25.0D + (l_partkey % 500) / 1000.0D AS latitude", "55.0D + (l_partkey % 370) / 1000.0D AS longitude",
        "l_shipdate AS timestamp",
    )


def offer_journeys(spark: SparkSession, root: str) -> DataFrame:
    """The trip requests the offers belong to, one per order."""
    return read_table(spark, "orders", root).selectExpr(
        "concat('O', o_orderkey) AS journey_id", "concat('C', o_custkey) AS ref_customer_id",
        "CASE WHEN o_orderkey % 23 <> 0 THEN concat('D', o_orderkey % 100) END AS ref_driver_id",
        f"CASE WHEN o_orderkey % 4 = 0 THEN '{LIMO_CATEGORY}' ELSE '{TAXI_CATEGORIES[0]}' END AS ref_vehicle_category_id",
        "CASE o_orderstatus WHEN 'F' THEN 9 WHEN 'O' THEN 13 ELSE 14 END AS journey_status",
        "o_orderdate AS journey_created_at", "o_totalprice AS actual_total_fee",
        "25.0D + (o_custkey % 500) / 1000.0D AS pickup_latitude",
        "55.0D + (o_custkey % 370) / 1000.0D AS pickup_longitude",
    )


def event_offers(spark: SparkSession, root: str) -> DataFrame:
    """Three dispatch offers per event, for acceptance rates on the journeys' own time line."""
    e = read_table(spark, "events", root).selectExpr("*", "explode(sequence(0, 2)) AS i")
    return e.selectExpr(
        "concat('J', event_id) AS journey_id", "concat('D', (event_id + 7 * i) % 50) AS driver_id",
        "CASE (event_id * 3 + i * 5) % 4 WHEN 0 THEN 'Accepted ' WHEN 1 THEN 'Time Elapsed' "
        "WHEN 2 THEN 'REJECTED' END AS driver_action",
        "CASE WHEN event_id % 31 <> 0 THEN cast(1 + event_id % 9 AS double) END AS estimate_eta",
        _later("ts", "20 * i") + " AS timestamp",
    )


def users(spark: SparkSession, root: str) -> DataFrame:
    """Customers (type 1) and drivers (type 2)."""
    c = read_table(spark, "customer", root).selectExpr(
        "concat('C', c_custkey) AS _id", "concat('CUS_', c_custkey) AS useruid", "c_name AS name",
        "CASE WHEN c_custkey % 4 <> 0 THEN '+971' ELSE '+44' END AS countrycode",
        "cast(500000000 + c_custkey AS string) AS mobilenumber",
        "concat('c', c_custkey, '@example.com') AS emailid",
        "cast(NULL AS string) AS meterid", "cast(NULL AS string) AS refusermaster", "1 AS usertype",
        "timestampadd(DAY, cast(c_custkey % 365 AS int), timestamp'2023-01-01 00:00:00') AS createdat",
    )
    s = read_table(spark, "supplier", root).selectExpr(
        "concat('D', s_suppkey) AS _id", "concat('DRV_', s_suppkey) AS useruid", "s_name AS name",
        "'+971' AS countrycode", "cast(700000000 + s_suppkey AS string) AS mobilenumber",
        "concat('d', s_suppkey, '@example.com') AS emailid",
        "CASE WHEN s_suppkey % 13 <> 0 THEN concat('M', s_suppkey) END AS meterid",
        "element_at(array('67178c298f4c4d9d4657633e', '676125c8c9abe86ca466af9a', '68b6f317881686da85284ea7', 'none'), "
        "cast(s_suppkey % 4 AS int) + 1) AS refusermaster",
        "2 AS usertype", "timestamp'2023-01-01 00:00:00' AS createdat",
    )
    return c.unionByName(s)


def ratings(spark: SparkSession, root: str) -> DataFrame:
    """Ratings of even purchase events; every tenth journey has a second rating."""
    e = read_table(spark, "events", root).filter("event_type = 'purchase' AND event_id % 2 = 0").selectExpr(
        "*", "explode(CASE WHEN event_id % 10 = 0 THEN array(0, 2) ELSE array(0) END) AS i"
    )
    return e.selectExpr(
        "concat('R', event_id) AS ref_journey_id", "concat('D', event_id % 50) AS ref_driver_id",
        "cast(1 + (event_id DIV 2 + i) % 5 AS int) AS rating", "concat('note ', event_id % 3) AS comment",
    )


def badges(spark: SparkSession, root: str) -> DataFrame:
    """Badges of purchase events; two where the id divides by six."""
    e = read_table(spark, "events", root).filter("event_type = 'purchase' AND event_id % 5 <> 0").selectExpr(
        "*", "explode(CASE WHEN event_id % 6 = 0 THEN array(0, 1) ELSE array(0) END) AS i"
    )
    return e.selectExpr(
        "concat('R', event_id) AS ref_journey_id", "concat('D', event_id % 50) AS ref_driver_id",
        _cycle(("Great drive", "Dirty Car", "Polite", "Bad odour"), "(event_id + i) % 4") + " AS badge_name",
    )


def tickets(spark: SparkSession, root: str) -> DataFrame:
    """Support tickets of error events, with text times as an upload has them."""
    return read_table(spark, "events", root).filter("event_type = 'error'").selectExpr(
        "date_format(ts, 'MM/dd/yyyy') AS date", "date_format(ts, 'MM/dd/yyyy HH:mm') AS initiated_at",
        "date_format(ts + INTERVAL '2' HOUR, 'MM/dd/yyyy HH:mm') AS resolved_at", "'chat' AS chat_type",
        "cast(event_id % 5 AS string) AS csat_score",
        "cast(500000000 + user_id AS string) AS user_properties_phone_number",
        "concat('user ', user_id) AS user_properties_name", "cast(NULL AS string) AS user_properties_email",
    )


def meter_events(spark: SparkSession, root: str) -> DataFrame:
    """Taxi meter log in local time; street jobs have number 0 or none."""
    return read_table(spark, "events", root).filter("event_type IN ('purchase', 'view', 'click')").selectExpr(
        "ts + INTERVAL '4' HOUR AS eventdatetime", "concat('M', event_id % 50) AS driverid",
        "CASE WHEN event_id % 5 = 0 THEN '0' WHEN event_id % 23 = 0 THEN NULL "
        "WHEN event_id % 7 = 0 THEN concat('X', event_id) ELSE cast(event_id AS string) END AS jobnumber",
        "CASE WHEN event_id % 13 = 0 THEN 'METER_HIRED' ELSE 'METER_VACANT' END AS eventname",
        "value AS fareamount",
    )


def session_daily(spark: SparkSession, root: str) -> DataFrame:
    """Sessions and bookings per local day."""
    e = read_table(spark, "events", root).withColumn("local_event_dt", F.to_date(F.expr("ts + INTERVAL '4' HOUR")))
    return e.groupBy("local_event_dt").agg(
        F.count(F.lit(1)).alias("total_page_view_session_cnt"),
        F.count(F.when(F.col("event_type") == "purchase", 1)).alias("total_booked_session"),
    )


def app_events(spark: SparkSession, root: str) -> DataFrame:
    """ETA refreshes shown before a cancellation, two per click event, as JSON properties."""
    e = read_table(spark, "events", root).filter("event_type = 'click'").selectExpr(
        "*", "explode(sequence(0, 1)) AS i", "cast(get_json_object(props, '$.k') AS int) AS k"
    )
    return e.selectExpr(
        "concat('CUS_', user_id) AS user_id",
        _later("ts", "CASE i WHEN 0 THEN 5 ELSE event_id % 250 END") + " AS event_time",
        "CASE WHEN event_id % 9 = 0 THEN 'other' ELSE 'eta_refresh' END AS event_type",
        "CASE WHEN event_id % 15 = 0 THEN concat('{\"Journey_id\": \"J', event_id, '\"}') "
        "ELSE concat('{\"Journey_id\": \"J', event_id, '\", \"ETA\": \"', k % 20 + i, ' min\"}') END AS event_properties",
    )


def message_events(spark: SparkSession, root: str) -> DataFrame:
    """Campaign deliveries around click events; the column names hold dots."""
    return read_table(spark, "events", root).filter("event_type = 'click'").selectExpr(
        "CASE WHEN event_id % 37 <> 0 THEN concat('CUS_', user_id) END AS `profile.identity`",
        "concat('J', event_id) AS `eventprops.journey id`",
        _later("ts", "event_id % 120") + " AS event_dt",
        _later("ts", "14400 + event_id % 120") + " AS event_dt_dubai",
    )


def devices(spark: SparkSession, root: str) -> DataFrame:
    """Two versions of a JSON device list per user; three users share a device."""
    u = read_table(spark, "events", root).select("user_id").distinct().selectExpr(
        "user_id", "explode(sequence(0, 1)) AS v"
    )
    device = "CASE WHEN user_id % 20 = 19 THEN '' WHEN v = 0 THEN concat('old', user_id) ELSE concat('dev', user_id DIV 3) END"
    return u.selectExpr(
        "concat('U', user_id, '_', v) AS _id", "concat('C', user_id) AS refuserid",
        f"concat('{{\"devices\": [{{\"deviceId\": \"', {device}, '\", \"deviceName\": \"phone\", \"deviceOs\": \"', "
        "CASE WHEN (user_id DIV 3) % 2 = 0 THEN 'ios' ELSE 'android' END, '\"}]}') AS devices",
        "timestampadd(DAY, v, timestamp'2024-01-01 00:00:00') AS updatedat",
    )


def wallet(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, "events", root).filter("event_type = 'signup'").selectExpr(
        "concat('C', user_id) AS customer_id",
        "CASE WHEN event_id % 3 = 0 THEN 'main' ELSE ' Outstanding ' END AS type", "value AS balance",
    )


def fare_views(spark: SparkSession, root: str) -> DataFrame:
    """Fare screens seen up to 30 minutes before a view event, with a JSON route."""
    return read_table(spark, "events", root).filter("event_type = 'view'").selectExpr(
        "concat('CUS_', user_id) AS customerid", "value AS distance",
        _later("ts", "-(event_id % 1800)") + " AS timestamp",
        "CASE WHEN event_id % 25 = 0 THEN '[]' ELSE concat('[{\"lat\": ', 25 + (event_id % 100) / 200.0D, "
        "', \"lng\": ', 55 + (user_id % 100) / 200.0D, '}, {\"lat\": 25.1, \"lng\": 55.1}]') END AS routes",
    )


def adjustments(spark: SparkSession, root: str) -> DataFrame:
    """Fare corrections; every fourth is stored twice."""
    e = read_table(spark, "events", root).filter("event_id % 20 = 0").selectExpr(
        "*", "explode(CASE WHEN event_id % 80 = 0 THEN array(0, 1) ELSE array(0) END) AS i"
    )
    return e.selectExpr(
        "concat('J', event_id) AS journeyid", "value / 10.0D AS adjustmentamount",
        _cycle(("both", " Driver", "customer"), "event_id DIV 20 % 3") + " AS adjustmentapplicability",
        _later("ts", "86400") + " AS updatedat",
    )


def fare_metrics(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, "events", root).filter("event_id % 3 <> 0").selectExpr(
        "concat('J', event_id) AS journey_id",
        "CASE WHEN event_id % 2 = 0 THEN 'WALLET' ELSE 'CARD' END AS actual_payment_instrument",
    )


def zones(spark: SparkSession, root: str) -> DataFrame:
    """A square per nation on a 5 x 5 grid, and a hexagon inside every third square."""
    n = read_table(spark, "nation", root).selectExpr(
        "n_nationkey AS n", "55.0D + 0.1D * (n_nationkey % 5) AS x", "25.0D + 0.1D * (n_nationkey DIV 5) AS y"
    )
    point = lambda dx, dy: f"named_struct('lon', x + {dx}D, 'lat', y + {dy}D)"
    square = [(0.005, 0.005), (0.095, 0.005), (0.095, 0.095), (0.005, 0.095)]
    hexagon = [(0.08, 0.05), (0.065, 0.076), (0.035, 0.076), (0.02, 0.05), (0.035, 0.024), (0.065, 0.024)]
    ring = lambda ps: f"array({', '.join(point(*p) for p in ps)})"
    name = _cycle(ZONE_NAMES, "n % 6")
    big = n.selectExpr(f"concat({name}, ' ', n) AS name", "concat('Zone ', n % 5) AS zone_name", ring(square) + " AS geom")
    small = n.filter("n % 3 = 0").selectExpr(
        "concat('Inner ', n) AS name", "concat('Core ', n % 5) AS zone_name", ring(hexagon) + " AS geom"
    )
    return big.unionByName(small)


def driver_scores(spark: SparkSession, root: str) -> DataFrame:
    """Two score snapshots of all drivers but every eleventh; the later one has shifted scores."""
    return read_table(spark, "supplier", root).filter("s_suppkey % 11 <> 0").selectExpr(
        "concat('D', s_suppkey) AS ref_driver_id",
        "explode(array(date'2024-01-22', date'2024-01-29')) AS run_date", "s_suppkey"
    ).selectExpr(
        "ref_driver_id", "((s_suppkey * 37 + CASE WHEN run_date = date'2024-01-29' THEN 5 ELSE 0 END) % 101) / 100.0D AS final_score",
        "run_date",
    )
