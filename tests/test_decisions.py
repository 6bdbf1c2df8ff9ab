"""Small hand-made frames, one per decision on semantics."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareway.functions import fixed_values as V
from fareway.functions.geo import ring_area, ring_contains, ring_edges
from fareway.functions.scalars import bucketize, digits, json_text, no_bad_badges, safe_ratio
from fareway.functions.time import filter_local_day, local_date, minutes_between, week_start
from fareway.operators import aggregates as AG
from fareway.operators.aggregates import exact_percentile
from fareway.operators.chains import expand_chains
from fareway.operators.dedupe import keep_first, keep_max, minmax_score
from fareway.operators.ordered import Split
from fareway.operators import zones as zones_module
from fareway.operators.temporal import asof_within
from fareway.operators.zones import zone_cells, zone_join, zone_join_many
from fareway.plans import kpi
from fareway.plans.dispatch import blended_offers
from fareway.plans.driver_score import score_rows
from fareway.plans.settlement import settle
from fareway.plans.trips import rating_per_journey, rating_totals
from fareway.plans.weekly_churn import weekly_churn_features
from fareway.sources import adapters as A

TS = lambda text: dt.datetime.fromisoformat(text)
T0 = TS("2024-01-01")


def one(df, e):
    return df.select(e.alias("x")).first().x


def test_minutes_count_crossed_boundaries(spark):
    df = spark.createDataFrame([(TS("2024-01-01 00:00:59"), TS("2024-01-01 00:01:01")), (TS("2024-01-01 00:01:00"), TS("2024-01-01 00:01:59"))], "a timestamp, b timestamp")
    assert [r.x for r in df.select(minutes_between(F.col("a"), F.col("b")).alias("x")).collect()] == [1, 0]
    assert [r.x for r in df.select(minutes_between(F.col("a"), F.col("b"), elapsed=True).alias("x")).collect()] == [0, 0]


def test_local_day_and_week(spark):
    df = spark.createDataFrame([(TS("2024-01-09 19:59:59"),), (TS("2024-01-09 20:00:00"),), (TS("2024-01-14 12:00:00"),)], "at timestamp")
    assert [r.x for r in df.select(local_date("at").alias("x")).collect()] == [dt.date(2024, 1, 9), dt.date(2024, 1, 10), dt.date(2024, 1, 14)]
    assert one(df.filter("at > '2024-01-13'"), week_start(F.col("at"))) == dt.date(2024, 1, 8)
    assert filter_local_day(df, "at", dt.date(2024, 1, 10), dt.date(2024, 1, 11)).count() == 1


def test_keep_first_breaks_ties_and_keep_max_keeps_them(spark):
    df = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x"), ("b", 2, "z"), (None, 3, "n")], "k string, o int, id string")
    assert sorted(r.id for r in keep_first(df, "k", ["-o", "id"]).collect()) == ["n", "x", "z"]
    assert sorted(r.id for r in keep_max(df, "k", "o").collect()) == ["x", "y", "z"]
    assert {r.id: r.s for r in minmax_score(df, "k", "o", "s").collect() if r.k == "a"} == {"x": 1.0, "y": 1.0}


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]


def test_zone_join_takes_the_smallest_and_keeps_outsiders(spark):
    zones = spark.createDataFrame(
        [("big", square(0.0, 0.0, 1.0)), ("small", square(0.2, 0.2, 0.2)), ("east", square(1.0, 0.0, 1.0))],
        "name string, geom array<struct<lon:double,lat:double>>")
    points = spark.createDataFrame(
        [("p1", 0.3, 0.3), ("p2", 0.8, 0.8), ("p3", 5.0, 5.0), ("p4", None, 0.1), ("p5", 1.0, 0.5)], "id string, lon double, lat double")
    found = lambda frame: sorted(((r.id, r.zone) for r in zone_join(frame, zones, "lon", "lat", "geom", "name", {"zone": "name"}).collect()), key=repr)
    got = dict(found(points))
    # p5 lies on the shared border and belongs to the zone on its right
    assert got == {"p1": "small", "p2": "big", "p3": None, "p4": None, "p5": "east"}
    assert one(zones.filter("name = 'small'"), F.round(ring_area(ring_edges("geom")), 6)) == 0.04
    assert one(zones.filter("name = 'east'"), ring_contains(ring_edges("geom"), F.lit(2.0), F.lit(0.5))) is False


@pytest.mark.parametrize("broadcast", [zones_module.BROADCAST_BYTES, -1])
def test_zone_join_returns_each_row_once(spark, monkeypatch, broadcast):
    """NULL and repeated ids, rings from a block to a continent, few cells and many."""
    monkeypatch.setattr(zones_module, "BROADCAST_BYTES", broadcast)
    zones = spark.createDataFrame(
        [("block", square(10.0, 10.0, 0.01)), ("city", square(9.9, 9.9, 1.0)), ("land", square(0.0, 0.0, 40.0)), ("twin", square(9.9, 9.9, 1.0))],
        "name string, geom array<struct<lon:double,lat:double>>")
    cells = zone_cells(zones, "geom").groupBy("name").count().collect()
    assert max(r["count"] for r in cells) <= 2 * zones_module.ZONE_CELLS
    rows = [(None, 10.005, 10.005), (None, 10.5, 10.5), ("p", 10.5, 10.5), ("p", 10.5, 10.5), ("p", 30.0, 1.0), ("q", -1.0, 0.0)]
    points = spark.createDataFrame(rows, "id string, lon double, lat double")
    out = zone_join_many(points, zones, [("lon", "lat", {"zone": "name"}), ("lat", "lon", {"mirror": "name"})], "geom", "name")
    got = sorted(((r.id, r.lon, r.zone, r.mirror) for r in out.collect()), key=repr)
    want = [(None, 10.005, "block", "block"), (None, 10.5, "city", "city"), ("p", 10.5, "city", "city"), ("p", 10.5, "city", "city"),
            ("p", 30.0, "land", "land"), ("q", -1.0, None, None)]
    assert got == sorted(want, key=repr)


def ring_holds(ring, lon, lat):
    """Ray casting over all edges, by numpy."""
    x1, y1 = np.array(ring).T
    x2, y2 = np.roll(x1, -1), np.roll(y1, -1)
    with np.errstate(all="ignore"):
        hit = ((y1 > lat) != (y2 > lat)) & (lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1)
    return bool(hit.sum() % 2)


def jagged(n, x, y, size, seed, corners=None):
    """A ring around (x, y) that goes in and out; with `corners` all vertices lie on a grid, so that many share a latitude."""
    rng = np.random.default_rng(seed)
    turn, far = np.linspace(0, 2 * np.pi, n, endpoint=False), size * (0.4 + 0.6 * rng.random(n))
    ring = np.c_[x + far * np.cos(turn), y + far * np.sin(turn)]
    return [tuple(map(float, p)) for p in (ring if corners is None else np.round(ring / corners) * corners)]


@pytest.mark.parametrize(("vertices", "corners"), [(7, None), (400, None), (400, 0.05), (300, 0.025)])
def test_clipped_zones_hold_what_whole_rings_hold(spark, vertices, corners):
    rings = {f"z{k}": jagged(vertices, 0.3 * k, -0.2 * k, 0.7, k, corners) for k in range(3)}
    rings["crossing"] = [(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 1.0)]
    zones = spark.createDataFrame(list(rings.items()), "name string, geom array<struct<lon:double,lat:double>>")
    rng = np.random.default_rng(9)
    spots = [(float(a), float(b)) for a, b in np.r_[rng.uniform(-1.2, 1.8, (1500, 2)), np.round(rng.uniform(-1, 1.5, (1500, 2)) / 0.025) * 0.025]]
    points = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "id long, lon double, lat double")
    for name, ring in rings.items():
        got = zone_join(points, zones.filter(F.col("name") == name), "lon", "lat", "geom", "name", {"zone": "name"}).collect()
        assert all((r.zone is not None) == ring_holds(ring, *spots[r.id]) for r in got) and len(got) == len(spots)


def test_a_ring_of_many_vertices_is_kept_once(spark):
    """No cell repeats the ring: the index grows with the vertices and the cells, not with their product."""
    ring = jagged(50_000, 50.0, 20.0, 0.7, 1)
    zones = spark.createDataFrame([("coast", ring)], "name string, geom array<struct<lon:double,lat:double>>")
    cells = zone_cells(zones, "geom").agg(F.count("*"), F.sum(F.size("_edges")), F.sum(F.size("_turns"))).first()
    assert 500 < cells[0] <= 2 * zones_module.ZONE_CELLS and cells[1] < 40 * len(ring) and cells[2] < 40 * len(ring)
    spots = [(float(a), float(b)) for a, b in np.random.default_rng(2).uniform((49.2, 19.2), (50.8, 20.8), (300, 2))]
    points = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "id long, lon double, lat double")
    got = zone_join(points, zones, "lon", "lat", "geom", "name", {"zone": "name"}).collect()
    assert all((r.zone is not None) == ring_holds(ring, *spots[r.id]) for r in got)


def test_a_numeric_tie_is_compared_as_a_number(spark):
    left = spark.createDataFrame([("a", T0)], "k string, at timestamp")
    right = spark.createDataFrame([("a", T0, 9), ("a", T0, 10)], "k string, e timestamp, eta int")
    assert asof_within(left, right, "k", "at", "e", {"eta": F.col("eta")}, tie="eta").first().eta == 10
    assert asof_within(left, right, "k", "at", "e", {"eta": F.col("eta")}, direction="forward", tie="eta").first().eta == 9


def test_an_offer_logged_with_two_actions_is_one_offer(spark):
    at = dt.datetime(2024, 1, 2, 12)
    trips = spark.createDataFrame([("J", "D1", V.TAXI_CATEGORIES[0], 9, at)], "journey_id string, ref_driver_id string, ref_vehicle_category_id string, journey_status int, journey_created_at timestamp")
    kind = "journey_id string, driver_id string, attempt int, dispatch_order int, distance_from_pickup double, estimate_eta double, estimate_distance double, is_dispatched boolean, driver_action string, latitude double, longitude double, timestamp timestamp"
    offers = [("J", d, 1, i, 1.0, float(i), float(i), True, "Rejected", 1.0, 1.0, at) for i, d in ((1, "D0"), (2, "D1"), (3, "D2"))]
    twice = [*offers, (*offers[0][:8], " Accepted", 2.0, 2.0, at)]
    scores = spark.createDataFrame([(f"D{i}", 0.5, dt.date(2024, 1, 3)) for i in range(3)], "ref_driver_id string, final_score double, run_date date")
    ranks = lambda rows: sorted((r.driver_id, r.eta_rank, r.dispatch_rank) for r in blended_offers(
        trips, spark.createDataFrame(rows, kind), scores, dt.date(2024, 1, 1), dt.date(2024, 1, 5), dt.date(2024, 1, 3)).collect())
    assert ranks(offers) == ranks(twice) == [("D0", 1, 1), ("D1", 2, 2), ("D2", 3, 3)]


def test_chains_drop_broken_and_cyclic_rows(spark):
    rows = [("r", None), ("c1", "r"), ("c2", "c1"), ("c3", "c2"), ("c4", "c3"), ("d", "c1"), ("lost", "nowhere"),
            ("x", "y"), ("y", "x"), ("tail", "x"), ("alone", None)]
    df = spark.createDataFrame(rows, "id string, up string")
    got = {r.id: (r.root_id, r.level) for r in expand_chains(df, "id", "up", F.col("id") != "alone").collect()}
    assert got == {"r": ("r", 0), "c1": ("r", 1), "c2": ("r", 2), "c3": ("r", 3), "c4": ("r", 4), "d": ("r", 2)}


def test_long_chain(spark):
    df = spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(300)], "id string, up string")
    assert expand_chains(df, "id", "up", F.lit(True)).agg(F.max("level")).first()[0] == 299


def test_segment_borders(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.2,), (0.21,), (None,)], "x double")
    got = [r.b for r in df.select(bucketize("x", V.PRICE_BOUNDS, V.PRICE_LABELS).alias("b")).collect()]
    assert got == ["0.<=0", "1.0–5%", "4.15–20%", "5.>20%", "5.>20%"]


def test_json_and_digits(spark):
    df = spark.createDataFrame([('{"ETA": "5 min"}',), ('{"ETA": "soon"}',), ("{}",), ("[]",)], "p string")
    assert [r.x for r in df.select(digits(json_text("p", "ETA")).alias("x")).collect()] == [5.0, None, None, None]


def test_ratings_do_not_repeat_trips(spark):
    r = spark.createDataFrame([("j", "d", 5), ("j", "d", 2)], "ref_journey_id string, ref_driver_id string, rating int")
    assert rating_per_journey(r).collect()[0].rating == 5
    assert rating_per_journey(r, "all").count() == 2
    assert tuple(rating_totals(r).first())[1:] == (7, 2)
    b = spark.createDataFrame([(None,), ("Bad Odour, Polite",), ("Polite",)], "b string")
    assert [x.ok for x in b.select(no_bad_badges("b").alias("ok")).collect()] == [True, False, True]


def test_percentile_of_hot_key(spark):
    rows = [("a", float(i % 50)) for i in range(500)] + [("b", 3.0), ("b", None), ("c", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    want = {r.k: r.p for r in df.groupBy("k").agg(F.expr("percentile_cont(0.7) WITHIN GROUP (ORDER BY x)").alias("p")).collect() if r.p is not None}
    for split in (Split(), Split(0, 7)):
        assert {r.k: pytest.approx(r.p) for r in exact_percentile(df, "k", "x", 0.7, "p", split).collect()} == want


def scored(spark, rows):
    cols = "ref_driver_id string, total_lt int, completed_lt int, cancelled_lt int, rating_lt double, total_rc int, completed_rc int, cancelled_rc int, rating_rc double"
    return {r.ref_driver_id: r for r in score_rows(spark.createDataFrame(rows, cols), False).collect()}


def test_score_rules(spark):
    got = scored(spark, [
        ("best", 10, 10, 0, 5.0, 10, 10, 0, 5.0), ("worst", 10, 1, 5, 1.0, 10, 1, 5, 1.0),
        ("small", 4, 0, 4, 1.0, 4, 0, 4, 1.0), ("idle", 10, 10, 0, 5.0, 0, 0, 0, None), ("none", None, None, None, None, None, None, None, None)])
    # the small driver still takes part in the scale of the recent scores
    assert got["best"].final_score == 1.0 and got["worst"].lifetime_score == 0.0 < got["worst"].recency_score
    # few lifetime trips: all lifetime parts are 1; the recent score is NULL, so the final falls back
    assert (got["small"].lifetime_score, got["small"].recency_score, got["small"].final_score) == (1.0, None, 1.0)
    # no recent trips: the lifetime score stands in
    assert got["idle"].recency_score == got["idle"].lifetime_score == 1.0
    assert got["none"].final_score == 1.0
    same = scored(spark, [("a", 9, 9, 0, 5.0, 9, 9, 0, 5.0), ("b", 9, 9, 0, 5.0, 9, 9, 0, 5.0)])
    assert same["a"].cr_lt_scaled is None and same["a"].final_score is None


def test_settlement_cases(spark):
    cols = ("payment_description string, vehicle_category_type int, journey_status_desc string, actual_total_fee double, actual_commission double, "
            "actual_discount_amount double, actual_rta_fee double, actual_booking_extra_fee double, actual_total_cancellation_fee double, actual_tip_amount double, adjustmentamount double")
    rows = [("cash", 1, "PAYMENT_RECEIVED", 100.0, 20.0, 5.0, 2.0, 3.0, None, 1.0, 10.0),
            ("CARD", 2, "JOURNEY_COMPLETED", 100.0, 20.0, None, 2.0, 3.0, None, None, 10.0),
            ("CARD", 2, "CANCELLED", None, None, None, None, 3.0, 7.0, None, None),
            (None, 2, "CANCELLED", 50.0, 5.0, None, None, 3.0, 7.0, None, None)]
    a, b, c, e = settle(spark.createDataFrame(rows, cols)).collect()
    assert (a.cash_collected, a.netfare) == (105.0, 87.0)
    # 87 - 110 earned, then - dispatch + discount + tip
    assert a.net_earning == pytest.approx(87 - 110 - 2 + 5 + 1) and a.final_net_payable_to_supplier == pytest.approx(-19 - 3)
    assert (b.netfare, b.net_earning, b.rta_revised_fare_adjustment) == (88.0, 88.0, -3.0)
    # a missing fare leaves the net fare open, and the earning counts as nothing
    assert c.netfare is None and c.net_earning == 0.0 and c.cash_collected == 0.0
    # without a payment method no earning can be stated
    assert e.net_earning is None


def test_empty_week_window(spark, data):
    j = A.journeys(spark, data).filter("ref_customer_id = 'C1'").orderBy("journey_created_at").limit(1)
    rows = {r.week_start: r for r in weekly_churn_features(j, dt.date(2023, 1, 1), dt.date(2025, 1, 1)).collect()}
    first = rows[min(rows)]
    assert (first.total_journeys_14d, first.share_trips_with_promo_14d, first.avg_eta_14d, first.prior_requests_all_time) == (0, 0.0, None, 0)
    assert rows[max(rows)].total_journeys_14d == 1 and len(rows) == 2


def test_kpi_on_the_first_of_a_month(spark, data):
    sheet = kpi.kpi_sheet(A.journeys(spark, data), A.ratings(spark, data), A.badges(spark, data), A.meter_events(spark, data),
                          A.session_daily(spark, data), dt.date(2024, 2, 1))
    mtd = {r.metric: r.value for r in sheet.filter("period = 'MTD'").collect()}
    assert mtd["Total Journey Request"] == 0 and mtd["Total Completion Rate"] is None and "New User Count" not in mtd


def test_weekly_outcomes_add_up(spark, data):
    trips = kpi.rated_trips(kpi.kpi_base(A.journeys(spark, data), dt.date(2024, 1, 25)), A.ratings(spark, data), A.badges(spark, data))
    rows = kpi.funnel(kpi.partial_sums(trips, "booking_week"), "booking_week").collect()
    assert rows and all(r.requests == r.completed + r.cancelled for r in rows)


def test_safe_ratio(spark):
    assert one(spark.range(1), safe_ratio(F.lit(1), F.lit(0))) is None


def test_meter_days_look_up_each_job_once(spark):
    at = dt.datetime(2024, 1, 20, 8)
    rows = [(at + dt.timedelta(seconds=i), "M1", "0", "METER_VACANT", 1.0) for i in range(50)]
    rows += [(at, "M1", "7", "METER_VACANT", 1.0), (at, "M1", "7", "METER_VACANT", 2.0), (at, "M2", "8", "METER_VACANT", 1.0)]
    rows += [(at, "M2", None, "METER_VACANT", 1.0), (at, None, "7", "METER_VACANT", 1.0), (at, "M3", "9", "METER_HIRED", 1.0)]
    meter = spark.createDataFrame(rows, "eventdatetime timestamp, driverid string, jobnumber string, eventname string, fareamount double")
    trips = spark.createDataFrame([("7", 9), ("7", 10), ("8", 13), (None, 9)], "transport_authority_job_id string, journey_status int")
    days = kpi.meter_days(meter, trips, dt.date(2024, 1, 25))
    # two fares of one meter trip are one trip; a missing driver or number counts nowhere
    assert {r.trip_type: r.trips for r in days.collect()} == {"Street": 50, "Own": 1, "Others": 1}
    assert [r.own_share for r in kpi.own_share(days).collect()] == [100.0 / 52]


def test_days_of_the_state_add_up(spark, data):
    day = dt.date(2024, 1, 25)
    state = lambda as_of, n: kpi.trip_state(kpi.rated_trips(kpi.kpi_base(A.journeys(spark, data), as_of, n), A.ratings(spark, data), A.badges(spark, data)))
    whole, parts = state(day, 3), state(day - dt.timedelta(days=1), 2).unionByName(state(day, 1))
    fixed = lambda df: sorted(str([round(x, 6) if isinstance(x, float) else x for x in r]) for r in df.collect())
    assert fixed(whole) == fixed(parts) and whole.count() > 0
    # first days: what is known stays, new customers get the first of their days
    known = spark.createDataFrame([("old", dt.date(2023, 5, 1))], "ref_customer_id string, first_day date")
    rows = [("old", dt.date(2024, 1, 2), "completed"), ("new", dt.date(2024, 1, 4), "completed"), ("new", dt.date(2024, 1, 3), "completed"), ("none", dt.date(2024, 1, 3), "other")]
    merged = kpi.merge_first_days(known, spark.createDataFrame(rows, "ref_customer_id string, local_date date, outcome string"))
    assert {r[0]: r[1] for r in merged.collect()} == {"old": dt.date(2023, 5, 1), "new": dt.date(2024, 1, 3)}


def test_joined_values_have_a_limit(spark):
    rows = [("a", "y"), ("a", "x"), ("a", "x"), ("a", None), ("b", None), (None, "z")]
    df = spark.createDataFrame(rows, "k string, v string")
    assert {r.k: r.vs for r in AG.listagg(df, "k", "v", "vs", "+", limit=3).collect()} == {"a": "x+x+y", "b": "", None: "z"}
    with pytest.raises(Exception, match="more than 2 values"):
        AG.listagg(df, "k", "v", "vs", limit=2).collect()
    plan = AG.listagg(df, "k", "v", "vs")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("Exchange ") == 1
