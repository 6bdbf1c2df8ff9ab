"""The adapter frames of `sources/adapters.py`, derived a second time in SQL for the oracle."""

TAXI = "('65d4bce6d30d222a7c7921b9', '65d4bce6d30d222a7c7921ba')"
PLACES = "['Dubai Mall Gate', 'Metro Station', 'City School', 'University Road', 'Marina Walk', 'Creek Park']"


def sec(n: str) -> str:
    return f"to_seconds(({n})::BIGINT)"


FRAMES = {
    "journeys": f"""
SELECT 'J' || event_id AS journey_id, 'R' || event_id AS ref_journey_id, 'C' || user_id AS ref_customer_id,
  'CUS_' || user_id AS customer_id,
  CASE WHEN event_id % 17 <> 0 THEN 'D' || (event_id % 50) END AS ref_driver_id,
  CASE WHEN event_id % 17 <> 0 THEN 'DRV_' || (event_id % 50) END AS driver_id,
  CASE WHEN event_id % 44 = 0 THEN NULL ELSE ['limo', '65d4bce6d30d222a7c7921b9', '65d4bce6d30d222a7c7921ba',
    '65d4bce6d30d222a7c7921ba'][event_id % 4 + 1] END AS ref_vehicle_category_id,
  CASE WHEN event_id % 4 = 0 THEN 1 ELSE 2 END AS vehicle_category_type,
  st AS journey_status,
  CASE st WHEN 9 THEN 'PAYMENT_RECEIVED' WHEN 10 THEN 'JOURNEY_COMPLETED' ELSE 'CANCELLED' END AS journey_status_desc,
  CASE WHEN event_id % 8 = 0 THEN 2 ELSE 1 END AS journey_type,
  ts AS journey_created_at, ts + {sec('3600 + 86400 * (event_id % 3)')} AS updated_at,
  ts + {sec('event_id % 60')} AS accepted_ride_timestamp, ts + {sec('event_id % 120')} AS on_route_timestamp,
  arr AS arrived_at_pickup_timestamp,
  CASE WHEN st IN (9, 10) THEN arr + {sec('60')} END AS journey_start_timestamp,
  CASE WHEN st IN (9, 10) THEN arr + {sec('event_id * 13 % 3600')} END AS journey_completed_timestamp,
  CASE WHEN st IN (13, 14) THEN ts + {sec('event_id * 7 % 300')} END AS journey_cancel_timestamp,
  ts AS pickup_time,
  CASE WHEN st IN (9, 10) THEN arr + {sec('event_id * 13 % 3600')} END AS actual_drop_off_time,
  eta AS dispatch_eta_sec, eta / 60e0 AS dispatch_eta, (5 + event_id % 7)::DOUBLE AS first_eta,
  lon AS pickup_longitude, lat AS pickup_latitude,
  lon + 0.01e0 AS estimate_drop_off_longitude, lat + 0.02e0 AS estimate_drop_off_latitude,
  lon + 0.01e0 + shift AS actual_drop_off_longitude, lat + 0.02e0 + shift AS actual_drop_off_latitude,
  lon + 0.003e0 AS driver_pickup_longitude, lat + 0.001e0 AS driver_pickup_latitude,
  lon + shift AS dispatch_longitude, lat - shift AS dispatch_latitude,
  {PLACES}[event_id % 6 + 1] AS pickup_location, {PLACES}[event_id * 5 % 6 + 1] AS drop_off_location,
  'Z' || (user_id % 5) AS pickup_zone_name, 'Z' || (event_id % 5) AS drop_off_zone_name,
  value AS estimate_total_fee,
  CASE WHEN st IN (9, 10) THEN value * (1e0 + ((event_id % 41) - 10) / 100e0) END AS actual_total_fee,
  5e0 AS actual_base_fee, value * 0.5e0 AS actual_total_distance_fee, value * 0.25e0 AS actual_total_time_fee,
  (event_id % 400) / 10e0 AS actual_distance,
  CASE WHEN event_id % 5 <> 0 THEN (event_id % 7)::DOUBLE END AS actual_discount_amount,
  (event_id % 3)::DOUBLE AS actual_tip_amount,
  CASE WHEN event_id % 10 <> 0 THEN value * 0.15e0 END AS actual_commission,
  (event_id % 4)::DOUBLE AS actual_booking_extra_fee, 2e0 AS actual_rta_fee, 4e0 * (event_id % 2) AS actual_salik_fee,
  (event_id % 6)::DOUBLE AS actual_parking_fee, (event_id % 9)::DOUBLE AS actual_interemirate_fee,
  1e0 + (event_id % 3) / 10e0 AS actual_peak_multiplier,
  CASE WHEN st IN (13, 14) AND event_id % 2 = 0 THEN 10e0 END AS actual_total_cancellation_fee,
  CASE WHEN event_id % 3 = 0 THEN 'P' || (event_id % 12) END AS ref_promo_applied,
  CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'CASH' ELSE 'CARD' END AS payment_description,
  ['Kabi', 'National Taxi', 'DTC'][event_id % 3 + 1] AS supplier_name,
  'Driver ' || (event_id % 50) AS driver_name, event_id::VARCHAR AS transport_authority_job_id
FROM (SELECT *,
    CASE event_type WHEN 'purchase' THEN 9 WHEN 'view' THEN 10 WHEN 'click' THEN 13 WHEN 'error' THEN 14
      ELSE CASE event_id % 6 WHEN 0 THEN 19 WHEN 3 THEN 12 ELSE 15 END END AS st,
    ts + {sec('event_id % 120 + event_id * 31 % 900')} AS arr,
    CASE WHEN event_id % 11 <> 0 THEN (60 + event_id * 37 % 600)::DOUBLE END AS eta,
    55e0 + ((user_id * 7 + event_id) % 1000) / 2000e0 AS lon,
    25e0 + ((user_id * 13 + event_id * 3) % 1000) / 2000e0 AS lat,
    (event_id % 9) / 10000e0 AS shift FROM events)""",
    # local clock fields of the journeys
    "trips": f"""
SELECT *, journey_created_at + INTERVAL 4 HOUR AS lts, (journey_created_at + INTERVAL 4 HOUR)::DATE AS ld,
  hour(journey_created_at + INTERVAL 4 HOUR) AS lh, dayname(journey_created_at + INTERVAL 4 HOUR) AS wd,
  CASE WHEN ref_vehicle_category_id IN {TAXI} THEN 'Taxi' ELSE 'Limo' END AS cls,
  date_trunc('week', journey_created_at + INTERVAL 4 HOUR)::DATE AS wk
FROM journeys""",
    "linked": """
SELECT *, CASE WHEN prev_status NOT IN (9, 10) AND prev_at >= journey_created_at - INTERVAL 12 HOUR
  THEN prev_ref END AS ref_parent_journey_id
FROM (SELECT *, lag(ref_journey_id) OVER w AS prev_ref, lag(journey_status) OVER w AS prev_status,
    lag(journey_created_at) OVER w AS prev_at FROM trips
  WINDOW w AS (PARTITION BY ref_customer_id ORDER BY journey_created_at, journey_id))""",
    "offers": """
SELECT 'O' || l_orderkey AS journey_id, 'D' || l_suppkey AS driver_id, 1 + l_linenumber % 2 AS attempt,
  l_linenumber AS dispatch_order, l_extendedprice / 1000e0 AS distance_from_pickup,
  CASE WHEN l_partkey % 29 <> 0 THEN l_quantity END AS estimate_eta, l_extendedprice AS estimate_distance,
  l_linestatus = 'F' AS is_dispatched,
  CASE l_returnflag WHEN 'A' THEN ' Accepted' WHEN 'R' THEN 'Rejected' ELSE 'Time Elapsed' END AS driver_action,
  25e0 + (l_partkey % 500) / 1000e0 AS latitude, 55e0 + (l_partkey % 370) / 1000e0 AS longitude,
  l_shipdate AS "timestamp" FROM lineitem""",
    "offer_journeys": """
SELECT 'O' || o_orderkey AS journey_id, 'C' || o_custkey AS ref_customer_id,
  CASE WHEN o_orderkey % 23 <> 0 THEN 'D' || (o_orderkey % 100) END AS ref_driver_id,
  CASE WHEN o_orderkey % 4 = 0 THEN 'limo' ELSE '65d4bce6d30d222a7c7921b9' END AS ref_vehicle_category_id,
  CASE o_orderstatus WHEN 'F' THEN 9 WHEN 'O' THEN 13 ELSE 14 END AS journey_status,
  o_orderdate AS journey_created_at, o_totalprice AS actual_total_fee,
  25e0 + (o_custkey % 500) / 1000e0 AS pickup_latitude, 55e0 + (o_custkey % 370) / 1000e0 AS pickup_longitude
FROM orders""",
    "event_offers": f"""
SELECT 'J' || event_id AS journey_id, 'D' || ((event_id + 7 * i) % 50) AS driver_id,
  CASE (event_id * 3 + i * 5) % 4 WHEN 0 THEN 'Accepted ' WHEN 1 THEN 'Time Elapsed' WHEN 2 THEN 'REJECTED' END AS driver_action,
  CASE WHEN event_id % 31 <> 0 THEN (1 + event_id % 9)::DOUBLE END AS estimate_eta,
  ts + {sec('20 * i')} AS "timestamp"
FROM events, range(3) AS r(i)""",
    "users": """
SELECT 'C' || c_custkey AS _id, 'CUS_' || c_custkey AS useruid, c_name AS name,
  CASE WHEN c_custkey % 4 <> 0 THEN '+971' ELSE '+44' END AS countrycode,
  (500000000 + c_custkey)::VARCHAR AS mobilenumber, 'c' || c_custkey || '@example.com' AS emailid,
  NULL::VARCHAR AS meterid, NULL::VARCHAR AS refusermaster, 1 AS usertype,
  TIMESTAMP '2023-01-01' + to_days((c_custkey % 365)::INT) AS createdat FROM customer
UNION ALL
SELECT 'D' || s_suppkey, 'DRV_' || s_suppkey, s_name, '+971', (700000000 + s_suppkey)::VARCHAR,
  'd' || s_suppkey || '@example.com', CASE WHEN s_suppkey % 13 <> 0 THEN 'M' || s_suppkey END,
  ['67178c298f4c4d9d4657633e', '676125c8c9abe86ca466af9a', '68b6f317881686da85284ea7', 'none'][s_suppkey % 4 + 1],
  2, TIMESTAMP '2023-01-01' FROM supplier""",
    "ratings": """
SELECT 'R' || event_id AS ref_journey_id, 'D' || (event_id % 50) AS ref_driver_id,
  (1 + (event_id // 2 + i) % 5)::INT AS rating, 'note ' || (event_id % 3) AS comment
FROM (SELECT *, unnest(CASE WHEN event_id % 10 = 0 THEN [0, 2] ELSE [0] END) AS i FROM events
  WHERE event_type = 'purchase' AND event_id % 2 = 0)""",
    # one rating per journey: the best one
    "rated": "SELECT ref_journey_id, max(rating) AS rating FROM ratings GROUP BY 1",
    "badges": """
SELECT 'R' || event_id AS ref_journey_id, 'D' || (event_id % 50) AS ref_driver_id,
  ['Great drive', 'Dirty Car', 'Polite', 'Bad odour'][(event_id + i) % 4 + 1] AS badge_name
FROM (SELECT *, unnest(CASE WHEN event_id % 6 = 0 THEN [0, 1] ELSE [0] END) AS i FROM events
  WHERE event_type = 'purchase' AND event_id % 5 <> 0)""",
    "tickets": """
SELECT strftime(ts, '%m/%d/%Y') AS date, strftime(ts, '%m/%d/%Y %H:%M') AS initiated_at,
  strftime(ts + INTERVAL 2 HOUR, '%m/%d/%Y %H:%M') AS resolved_at, 'chat' AS chat_type,
  (event_id % 5)::VARCHAR AS csat_score, (500000000 + user_id)::VARCHAR AS user_properties_phone_number,
  'user ' || user_id AS user_properties_name, NULL::VARCHAR AS user_properties_email
FROM events WHERE event_type = 'error'""",
    # complaints: one per customer and time
    "complaints": """
SELECT DISTINCT u._id AS ref_customer_id, strptime(t.initiated_at, '%m/%d/%Y %H:%M') AS at
FROM tickets t JOIN users u ON t.user_properties_phone_number = u.mobilenumber AND u.usertype = 1""",
    "meter_events": """
SELECT ts + INTERVAL 4 HOUR AS eventdatetime, 'M' || (event_id % 50) AS driverid,
  CASE WHEN event_id % 5 = 0 THEN '0' WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'X' || event_id
    ELSE event_id::VARCHAR END AS jobnumber,
  CASE WHEN event_id % 13 = 0 THEN 'METER_HIRED' ELSE 'METER_VACANT' END AS eventname, value AS fareamount
FROM events WHERE event_type IN ('purchase', 'view', 'click')""",
    "session_daily": """
SELECT (ts + INTERVAL 4 HOUR)::DATE AS local_event_dt, count(*) AS total_page_view_session_cnt,
  count(*) FILTER (event_type = 'purchase') AS total_booked_session FROM events GROUP BY 1""",
    "app_events": f"""
SELECT 'CUS_' || user_id AS user_id, ts + {sec('CASE i WHEN 0 THEN 5 ELSE event_id % 250 END')} AS event_time,
  CASE WHEN event_id % 9 = 0 THEN 'other' ELSE 'eta_refresh' END AS event_type,
  CASE WHEN event_id % 15 = 0 THEN '{{"Journey_id": "J' || event_id || '"}}'
    ELSE '{{"Journey_id": "J' || event_id || '", "ETA": "' || (k % 20 + i) || ' min"}}' END AS event_properties
FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events WHERE event_type = 'click'), range(2) AS r(i)""",
    "message_events": f"""
SELECT CASE WHEN event_id % 37 <> 0 THEN 'CUS_' || user_id END AS "profile.identity",
  'J' || event_id AS "eventprops.journey id", ts + {sec('event_id % 120')} AS event_dt,
  ts + {sec('14400 + event_id % 120')} AS event_dt_dubai FROM events WHERE event_type = 'click'""",
    "devices": """
SELECT 'U' || user_id || '_' || v AS _id, 'C' || user_id AS refuserid,
  '{"devices": [{"deviceId": "' || (CASE WHEN user_id % 20 = 19 THEN '' WHEN v = 0 THEN 'old' || user_id
    ELSE 'dev' || (user_id // 3) END) || '", "deviceName": "phone", "deviceOs": "'
    || (CASE WHEN (user_id // 3) % 2 = 0 THEN 'ios' ELSE 'android' END) || '"}]}' AS devices,
  TIMESTAMP '2024-01-01' + to_days(v::INT) AS updatedat
FROM (SELECT DISTINCT user_id FROM events), range(2) AS r(v)""",
    "wallet": """
SELECT 'C' || user_id AS customer_id, CASE WHEN event_id % 3 = 0 THEN 'main' ELSE ' Outstanding ' END AS type,
  value AS balance FROM events WHERE event_type = 'signup'""",
    "fare_views": f"""
SELECT 'CUS_' || user_id AS customerid, value AS distance, ts + {sec('-(event_id % 1800)')} AS "timestamp",
  CASE WHEN event_id % 25 = 0 THEN '[]' ELSE '[{{"lat": ' || (25 + (event_id % 100) / 200e0) || ', "lng": '
    || (55 + (user_id % 100) / 200e0) || '}}, {{"lat": 25.1, "lng": 55.1}}]' END AS routes
FROM events WHERE event_type = 'view'""",
    "adjustments": f"""
SELECT 'J' || event_id AS journeyid, value / 10e0 AS adjustmentamount,
  ['both', ' Driver', 'customer'][event_id // 20 % 3 + 1] AS adjustmentapplicability, ts + {sec('86400')} AS updatedat
FROM (SELECT *, unnest(CASE WHEN event_id % 80 = 0 THEN [0, 1] ELSE [0] END) AS i FROM events WHERE event_id % 20 = 0)""",
    "fare_metrics": """
SELECT 'J' || event_id AS journey_id, CASE WHEN event_id % 2 = 0 THEN 'WALLET' ELSE 'CARD' END AS actual_payment_instrument
FROM events WHERE event_id % 3 <> 0""",
    "zones": """
SELECT ['Mall of', 'Airport', 'Metro', 'School', 'University', 'Downtown'][n % 6 + 1] || ' ' || n AS name,
  'Zone ' || (n % 5) AS zone_name,
  [{'lon': x + 0.005e0, 'lat': y + 0.005e0}, {'lon': x + 0.095e0, 'lat': y + 0.005e0},
   {'lon': x + 0.095e0, 'lat': y + 0.095e0}, {'lon': x + 0.005e0, 'lat': y + 0.095e0}] AS geom
FROM (SELECT n_nationkey AS n, 55e0 + 0.1e0 * (n_nationkey % 5) AS x, 25e0 + 0.1e0 * (n_nationkey // 5) AS y FROM nation)
UNION ALL
SELECT 'Inner ' || n, 'Core ' || (n % 5),
  [{'lon': x + 0.08e0, 'lat': y + 0.05e0}, {'lon': x + 0.065e0, 'lat': y + 0.076e0}, {'lon': x + 0.035e0, 'lat': y + 0.076e0},
   {'lon': x + 0.02e0, 'lat': y + 0.05e0}, {'lon': x + 0.035e0, 'lat': y + 0.024e0}, {'lon': x + 0.065e0, 'lat': y + 0.024e0}]
FROM (SELECT n_nationkey AS n, 55e0 + 0.1e0 * (n_nationkey % 5) AS x, 25e0 + 0.1e0 * (n_nationkey // 5) AS y FROM nation)
WHERE n % 3 = 0""",
    "edges": """
SELECT name, zone_name, geom[i].lon AS x1, geom[i].lat AS y1, geom[i % len(geom) + 1].lon AS x2,
  geom[i % len(geom) + 1].lat AS y2
FROM (SELECT *, unnest(range(1, len(geom) + 1)) AS i FROM zones)""",
    "areas": "SELECT name, any_value(zone_name) AS zone_name, abs(sum(x1 * y2 - x2 * y1)) / 2 AS area FROM edges GROUP BY 1",
    "pickup_zone": """
SELECT journey_id, name, zone_name FROM (
  SELECT h.journey_id, a.name, a.zone_name,
    row_number() OVER (PARTITION BY h.journey_id ORDER BY a.area, a.name) AS rn
  FROM (SELECT j.journey_id, e.name FROM journeys j JOIN edges e ON (e.y1 > j.pickup_latitude) <> (e.y2 > j.pickup_latitude)
      AND j.pickup_longitude < (e.x2 - e.x1) * (j.pickup_latitude - e.y1) / (e.y2 - e.y1) + e.x1
    GROUP BY 1, 2 HAVING count(*) % 2 = 1) h JOIN areas a USING (name)) WHERE rn = 1""",
    "drop_zone": """
SELECT journey_id, name, zone_name FROM (
  SELECT h.journey_id, a.name, a.zone_name,
    row_number() OVER (PARTITION BY h.journey_id ORDER BY a.area, a.name) AS rn
  FROM (SELECT j.journey_id, e.name FROM journeys j
    JOIN edges e ON (e.y1 > j.actual_drop_off_latitude) <> (e.y2 > j.actual_drop_off_latitude)
      AND j.actual_drop_off_longitude < (e.x2 - e.x1) * (j.actual_drop_off_latitude - e.y1) / (e.y2 - e.y1) + e.x1
    GROUP BY 1, 2 HAVING count(*) % 2 = 1) h JOIN areas a USING (name)) WHERE rn = 1""",
    "driver_scores": """
SELECT 'D' || s_suppkey AS ref_driver_id,
  ((s_suppkey * 37 + CASE WHEN d = DATE '2024-01-29' THEN 5 ELSE 0 END) % 101) / 100e0 AS final_score, d AS run_date
FROM supplier, (VALUES (DATE '2024-01-22'), (DATE '2024-01-29')) AS v(d) WHERE s_suppkey % 11 <> 0""",
}

# Frames that build on other frames.
NEEDS = {
    "trips": ["journeys"], "linked": ["trips"], "rated": ["ratings"], "complaints": ["tickets", "users"],
    "edges": ["zones"], "areas": ["edges"], "pickup_zone": ["journeys", "areas", "edges"],
    "drop_zone": ["journeys", "areas", "edges"],
}


def with_frames(names: str, body: str, recursive: bool = False) -> str:
    """`body` after a WITH list of the named frames and what they need. `body` may add CTEs: start it with `, x AS (...)`."""
    order: list[str] = []

    def add(name):
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({FRAMES[n].strip()})" for n in order)
    start = "WITH RECURSIVE " if recursive else "WITH "
    return start + ctes + "\n" + body.strip()
