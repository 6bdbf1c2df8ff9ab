import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from fareway.sources import sinks
from fareway.sources.tables import read_tickets


def test_snapshot_rerun_replaces_its_day_only(spark, tmp_path):
    path, day = str(tmp_path / "scores"), dt.date(2024, 1, 2)
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "s int")
    sinks.write_snapshot(frame(1), path, dt.date(2024, 1, 1))
    sinks.write_snapshot(frame(2, 3), path, day)
    sinks.write_snapshot(frame(4, 4), path, day)
    back = spark.read.parquet(path)
    assert sorted(tuple(r) for r in back.collect()) == [(1, dt.date(2024, 1, 1)), (4, day), (4, day)]
    assert [r.s for r in sinks.snapshot_asof(back, day).collect()] == [4]


def test_rebuild_and_insert_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    sinks.write_rebuild(a, "rebuilt")
    sinks.write_rebuild(a, "rebuilt")
    sinks.insert_by_name(spark.createDataFrame([("y", 2)], "t string, n int"), "rebuilt", ["n", "t"])
    assert sorted(tuple(r) for r in spark.table("rebuilt").collect()) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        sinks.insert_by_name(a, "rebuilt", ["n"])


def test_retention_purges_whole_days(spark):
    rows = lambda *d: spark.createDataFrame([(1, x) for x in d], "v int, d date")
    as_of = dt.date(2024, 6, 5)
    edge = dt.date(2024, 6, 3) - dt.timedelta(weeks=55)
    sinks.append_with_retention(rows(edge - dt.timedelta(days=1), edge), "kept", "d", as_of)
    sinks.append_with_retention(rows(as_of), "kept", "d", as_of)
    assert sorted(r.d for r in spark.table("kept").collect()) == [edge, as_of]
    sinks.append_with_retention(rows(as_of), "kept", "d", as_of)  # the same run again
    assert sorted(r.d for r in spark.table("kept").collect()) == [edge, as_of]


def test_a_run_replaces_its_own_week_only(spark):
    day, other = dt.date(2024, 5, 30), dt.date(2024, 5, 31)
    rows = lambda *x: spark.createDataFrame([*x], "d date, v int")  # the date is not the last column
    first, second = dt.date(2024, 6, 5), dt.date(2024, 6, 12)
    run = lambda as_of, *x: sinks.append_with_retention(rows(*x), "by_week", "d", as_of, run_c="run_week")
    kept = lambda: sorted(((r.d, r.v) for r in spark.table("by_week").collect()), key=repr)
    run(first, (day, 1), (None, 2))
    run(second, (day, 3), (None, 4), (other, 5))
    assert kept() == sorted([(day, 1), (None, 2), (day, 3), (None, 4), (other, 5)], key=repr)
    run(second, (day, 3), (None, 4))  # again, without one of its days
    assert kept() == sorted([(day, 1), (None, 2), (day, 3), (None, 4)], key=repr)
    run(second)
    assert kept() == sorted([(day, 1), (None, 2)], key=repr)
    with pytest.raises(ValueError):
        sinks.append_with_retention(rows((day, 1)), "by_week", "d", first)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_a_failed_run_changes_nothing(spark, mode):
    old, day, as_of = dt.date(2020, 1, 1), dt.date(2024, 5, 30), dt.date(2024, 6, 5)
    rows = spark.createDataFrame([(old, 1), (day, 2), (dt.date(2024, 5, 31), 3)], "d date, v int")
    bad = rows.withColumn("v", F.when(F.col("v") > 2, F.raise_error("stop").cast("int")).otherwise(F.col("v") * 10))
    kept = lambda t: sorted((r.d, r.v) for r in spark.table(t).collect())
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        for table, run_c in ((f"fails_{mode}", None), (f"fails_run_{mode}", "run_week")):
            sinks.append_with_retention(rows, table, "d", as_of, run_c=run_c)
            with pytest.raises(Exception, match="stop"):
                sinks.append_with_retention(bad, table, "d", as_of, run_c=run_c)
            assert kept(table) == [(old, 1), (day, 2), (dt.date(2024, 5, 31), 3)]
            sinks.append_with_retention(rows.filter("v = 2").withColumn("v", F.lit(7)), table, "d", as_of, run_c=run_c)
            # the old day expires; of a run's own rows nothing else stays
            assert kept(table) == [(day, 7)] + ([] if run_c else [(dt.date(2024, 5, 31), 3)])
            assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
        sinks.write_rebuild(rows, f"whole_{mode}")
        with pytest.raises(Exception, match="stop"):
            sinks.write_rebuild(bad, f"whole_{mode}")
        assert len(kept(f"whole_{mode}")) == 3
        sinks.write_rebuild(spark.table(f"whole_{mode}").filter("v > 1"), f"whole_{mode}")  # from itself
        assert [v for _, v in kept(f"whole_{mode}")] == [2, 3]
        spark.sql(f"ALTER TABLE whole_{mode} RENAME TO whole_{mode}__old")  # a run stopped here
        with pytest.raises(Exception, match="stop"):
            sinks.write_rebuild(bad, f"whole_{mode}")
        assert [v for _, v in kept(f"whole_{mode}")] == [2, 3] and not spark.catalog.tableExists(f"whole_{mode}__old")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_two_tables_are_written_at_once(spark):
    days = [dt.date(2024, 5, 27) + dt.timedelta(days=i) for i in range(4)]
    rows = lambda k: spark.createDataFrame([(x, k) for x in days], "d date, v int")
    write = lambda k: sinks.append_with_retention(rows(k), f"side_{k % 2}", "d", dt.date(2024, 6, 5), run_c="run_week" if k % 2 else None)
    write(0), write(1)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, [2, 3]))
    assert all(sorted((r.d, r.v) for r in spark.table(f"side_{k % 2}").collect()) == [(x, k) for x in days] for k in (2, 3))


def test_purge_with_a_second_partition_column(spark):
    old, new = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    rows = spark.createDataFrame([(1, old, "a"), (2, old, "b"), (3, new, "a")], "v int, d date, k string")
    rows.write.mode("overwrite").partitionBy("d", "k").format("parquet").saveAsTable("two_parts")
    assert sinks.purge_before(spark, "two_parts", "d", new) == 2
    assert [r.v for r in spark.table("two_parts").collect()] == [3]


def test_ticket_file(spark, tmp_path):
    head = "date,initiated_at,resolved_at,chat_type,csat_score,user_properties_phone_number,user_properties_name,user_properties_email"
    (tmp_path / "t.csv").write_text(head + "\n01/31/2024,01/31/2024 17:05,,chat,5,971,A,a@x\n,not a time,,chat,,972,B,\n")
    got = [r.initiated_date for r in read_tickets(spark, str(tmp_path / "t.csv")).orderBy("user_properties_phone_number").collect()]
    assert got == [dt.datetime(2024, 1, 31, 17, 5), None]


def test_run_stamp_is_local(spark):
    row = sinks.with_run_ts(spark.range(1), dt.datetime(2024, 1, 1, 22, 0)).first()
    assert row.query_run_timestamp == dt.datetime(2024, 1, 2, 2, 0)


def test_days_are_replaced_one_by_one(spark, tmp_path):
    path, d = str(tmp_path / "days"), dt.date
    frame = lambda *rows: spark.createDataFrame(list(rows), "day date, n long")
    sinks.write_days(frame((d(2024, 1, 1), 1), (d(2024, 1, 2), 2), (None, 9)), path, "day")
    for _ in range(2):
        sinks.write_days(frame((d(2024, 1, 2), 5), (d(2024, 1, 3), 3)), path, "day")
    got = sorted((str(r.day), r.n) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 5), ("2024-01-03", 3), ("None", 9)]


def test_rows_are_made_once_and_a_failed_first_run_leaves_no_table(spark):
    """The frame is counted while it is written: two runs make its rows twice, not once for every look at them."""
    db = "once_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {db}")
    made = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            made.add(1)
            yield row

    rows = [(i, dt.date(2024, 1, 15 + i % 3)) for i in range(30)]
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).mapPartitions(count), "n int, day date")
    for _ in range(2):
        sinks.append_with_retention(frame, f"{db}.t", "day", dt.date(2024, 1, 25), run_c="week")
    assert made.value == 60 and spark.table(f"{db}.t").count() == 30
    again = spark.table(f"{db}.t").drop("week").withColumn("n", F.col("n") + 100)  # rows made of the table itself
    sinks.append_with_retention(again, f"{db}.t", "day", dt.date(2024, 1, 25), run_c="week")
    assert sorted(r.n for r in spark.table(f"{db}.t").collect()) == list(range(100, 130))
    none = frame.limit(0)
    sinks.append_with_retention(none, f"{db}.t", "day", dt.date(2024, 1, 25), run_c="week")
    assert spark.table(f"{db}.t").count() == 0
    sinks.append_with_retention(none, f"{db}.empty", "day", dt.date(2024, 1, 25))
    assert spark.table(f"{db}.empty").count() == 0
    bad = frame.withColumn("n", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        sinks.append_with_retention(bad, f"{db}.bad", "day", dt.date(2024, 1, 25))
    assert not spark.catalog.tableExists(f"{db}.bad")
    sinks.append_with_retention(frame, f"{db}.bad", "day", dt.date(2024, 1, 25))
    assert spark.table(f"{db}.bad").count() == 30
