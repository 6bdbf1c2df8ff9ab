"""Physical plans: pushed bounds, pruned columns, one shuffle per ordered pass."""

import datetime as dt

from pyspark.sql import functions as F

from fareway.functions.time import filter_local_day
from fareway.operators.aggregates import exact_percentile
from fareway.operators.dedupe import keep_first, keep_max, minmax_score
from fareway.operators.ordered import Running, running
from fareway.operators.zones import zone_join_many
from fareway.plans import kpi, stickiness, trip_features, weekly_churn
from fareway.sources import adapters as A


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_local_day_bound_reaches_the_scan(spark, data):
    text = plan(stickiness.completed_trip_histogram(A.journeys(spark, data), A.users(spark, data), dt.date(2024, 1, 3)))
    assert "GreaterThanOrEqual(ts,2024-01-02 20:00:00.0)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,user_id:bigint,event_type:string>" in text


def test_ordered_pass_has_one_shuffle(spark, data):
    j = A.journeys(spark, data).select("journey_id", "ref_customer_id", "journey_created_at")
    df = running(j, "ref_customer_id", ["journey_created_at", "journey_id"],
                 Running(sums={"n": F.lit(1).cast("long")}, leads={"x": F.col("journey_id")}, fills={"y": F.col("journey_id")}))
    assert plan(df).count("Exchange hashpartitioning") == 1


def test_wide_history_pass_reads_the_range_alone(spark, data):
    text = plan(trip_features.customer_history(A.journeys(spark, data), dt.date(2024, 1, 3), dt.date(2024, 1, 20)))
    scans = [x for x in text.splitlines() if "FileScan" in x]
    wide = [x for x in scans if "GreaterThanOrEqual(ts," in x]
    assert len(scans) == 2 and len(wide) == 1 and all("LessThan(ts," in x for x in scans)


def test_points_meet_zones_without_a_shuffle(spark, data):
    points = A.journeys(spark, data).select("journey_id", "pickup_longitude", "pickup_latitude", "estimate_drop_off_longitude", "estimate_drop_off_latitude")
    ends = [("pickup_longitude", "pickup_latitude", {"a": "name"}), ("estimate_drop_off_longitude", "estimate_drop_off_latitude", {"b": "name"})]
    text = plan(zone_join_many(points, A.zones(spark, data), ends, "geom", "name"))
    left = text.split("FileScan parquet [event_id")[0]
    assert text.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in text and text.count("events.parquet") == 1 and "Scan ExistingRDD" in text  # the index is written once
    assert "Exchange hashpartitioning(pickup" not in left and "hashpartitioning(journey_id" not in text


def test_group_values_share_one_shuffle_by_journey(spark, data):
    offers = A.offers(spark, data)
    text = plan(minmax_score(keep_max(offers, "journey_id", "attempt"), "journey_id", "estimate_eta", "s"))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("FileScan") == 1


def test_first_per_key_is_cut_before_the_shuffle(spark, data):
    assert "WindowGroupLimit" in plan(keep_first(A.devices(spark, data), "refuserid", ["-updatedat", "_id"]))


def test_weekly_features_need_no_range_join(spark, data):
    text = plan(weekly_churn.weekly_churn_features(A.journeys(spark, data), dt.date(2024, 1, 3), dt.date(2024, 1, 30)))
    assert "Join" not in text and "Cartesian" not in text
    assert text.count("FileScan") == 1 and text.count("Exchange ") == 2  # the sums of weeks, then all weeks of a customer


def test_day_partitions_are_pruned(spark, data, tmp_path):
    path = str(tmp_path / "by_day")
    j = A.journeys(spark, data).select("journey_id", "journey_created_at")
    j.withColumn("day", F.to_date("journey_created_at")).write.partitionBy("day").parquet(path)
    start, end = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
    table = spark.read.parquet(path)
    pruned = filter_local_day(table, "journey_created_at", start, end, utc_day="day")
    assert pruned.count() == filter_local_day(table, "journey_created_at", start, end).count() > 0
    assert len(pruned.select(F.input_file_name()).distinct().collect()) <= 3
    scan = plan(pruned)
    assert "PartitionFilters: [isnotnull(day" in scan and ">= 2024-01-09" in scan


def test_a_percentile_reads_its_input_once(spark, tmp_path):
    rows = [(f"k{i % 3}" if i % 7 else None, float(i * i % 11) if i % 5 else None) for i in range(200)]
    spark.createDataFrame(rows, "k string, v double").write.parquet(f"{tmp_path}/values")
    df, reads = spark.read.parquet(f"{tmp_path}/values"), spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(v):
        reads.add(1)
        return v

    out = exact_percentile(df.withColumn("v", seen("v")), "k", "v", 0.7, "p")
    assert "FileScan" not in plan(out)  # the counts are written, nothing else goes back to the input
    want = {r.k: r.p for r in df.filter("v is not null and k is not null").groupBy("k").agg(F.expr("percentile(v, 0.7)").alias("p")).collect()}
    got = {r.k: r.p for r in out.collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want) and reads.value <= 2 * len(rows)


def test_sheet_reads_the_trips_once(spark, data):
    day, journeys = dt.date(2024, 1, 25), A.journeys(spark, data)
    text = plan(kpi.kpi_sheet(journeys, A.ratings(spark, data), A.badges(spark, data), A.meter_events(spark, data), A.session_daily(spark, data), day))
    # the state is written and read by funnel and users; history and job numbers of trips, the meter log, the sessions: one scan each
    scans = [x for x in text.splitlines() if "FileScan" in x]
    stored = [x for x in scans if "outcome:string" in x]
    assert len(scans) == 6 and len(stored) == 2 and "CartesianProduct" not in text
    assert any("ReadSchema: struct<local_date:date,ref_customer_id:string,outcome:string,requests:bigint>" in x for x in stored)
    state = plan(kpi.trip_state(kpi.rated_trips(kpi.kpi_base(journeys, day), A.ratings(spark, data), A.badges(spark, data))))
    assert state.count("FileScan") == 3  # trips, ratings, badges
