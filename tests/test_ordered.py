"""Ordered operators: the split form for hot keys must equal the plain form and a brute-force walk."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fareway.operators.ordered import Running, Split, chunked, running
from fareway.operators.skew import find_hot, lookup_join
from fareway.operators.temporal import (
    Source, add_counts_before, asof, asof_many, asof_within, count_within, match_latest_left, next_activity,
)

PLAIN = Split()
FORCED = Split(min_rows=0, chunk_rows=20)
T0 = dt.datetime(2024, 1, 1)


def make(spark, seed, size=300, keys=("a", "b", "c", None)):
    rnd = random.Random(seed)
    weights = [6, 2, 1, 1][: len(keys)]
    rows = []
    for i in range(size):
        at = None if rnd.random() < 0.03 else T0 + dt.timedelta(seconds=60 * rnd.randint(0, 150))
        rows.append((i, rnd.choices(keys, weights)[0], at, rnd.choice([None, 1, 2, 3])))
    return spark.createDataFrame(rows, "id int, k string, at timestamp, v int"), rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("descending", [False, True])
def test_running_split_equals_plain(spark, descending):
    df, _ = make(spark, 1)
    values = Running(
        sums={"n": F.lit(1).cast("long"), "big": F.when(F.col("v") > 1, 1).otherwise(0).cast("long")},
        mins={"first_at": F.col("at")}, lags={"before": F.col("v")}, leads={"after": F.col("id")},
        fills={"seen": F.col("v"), "both": F.when(F.col("v") == 3, F.struct("id", "at"))},
    )
    plain = running(df, "k", ["at", "id"], values, descending, PLAIN)
    split = running(df, "k", ["at", "id"], values, descending, FORCED)
    assert rows_of(plain) == rows_of(split)


def test_running_against_brute_force(spark):
    df, rows = make(spark, 2)
    got = {r.id: (r.n, r.before) for r in running(
        df, "k", ["at", "id"], Running(sums={"n": F.lit(1).cast("long")}, lags={"before": F.col("id")}), split=FORCED
    ).collect()}
    for key in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2] is None, r[2] or T0, r[0]))
        for pos, r in enumerate(mine):
            assert got[r[0]] == (pos + 1, mine[pos - 1][0] if pos else None)


def test_mixed_directions_text_and_naive_times(spark):
    df, _ = make(spark, 3)
    df = df.withColumns({"name": F.concat(F.lit("n"), F.col("v").cast("string")), "naive": F.col("at").cast("timestamp_ntz")})
    values = Running(sums={"n": F.lit(1).cast("long")}, lags={"before": F.col("id")}, leads={"after": F.col("v")}, fills={"seen": F.col("name")})
    for order in (["-v", "at", "id"], ["-at", "id"], ["name", "-id"], ["naive", "id"], ["-naive", "v", "-id"]):
        for descending in (False, True):
            assert rows_of(running(df, "k", order, values, descending, PLAIN)) == rows_of(running(df, "k", order, values, descending, FORCED))


def test_null_sums_and_replaced_columns_do_not_depend_on_the_path(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 3, None), ("a", 4, 2), ("b", 1, None)], "k string, t int, v long")
    one_row = Split(min_rows=0, chunk_rows=1)
    for split in (PLAIN, one_row):
        out = running(df, "k", ["t"], Running(sums={"v": F.col("v")}, mins={"low": F.col("v")}), split=split)
        assert out.columns == ["k", "t", "v", "low"]
        assert rows_of(out) == rows_of(spark.createDataFrame(
            [("a", 1, 5, 5), ("a", 2, 5, 5), ("a", 3, 5, 5), ("a", 4, 7, 2), ("b", 1, None, None)], "k string, t int, v long, low long"))


@pytest.mark.parametrize("values", [
    [(1,) for _ in range(400)], [(i / 400,) for i in range(400)], [(None,) for _ in range(400)], [(T0,) for _ in range(400)],
])
def test_chunks_of_one_key_are_bounded(spark, values):
    """A status code, ratios in [0, 1], NULLs and equal times are all cut to about the wanted size."""
    kind = "timestamp" if values[0][0] == T0 else "double"
    rows = [("a", i, None if v is None else v if kind == "timestamp" else float(v)) for i, (v,) in enumerate(values)]
    df = spark.createDataFrame(rows, f"k string, id int, x {kind}")
    split = Split(min_rows=0, chunk_rows=50)
    parts = chunked(df, ["k"], ["x"], False, find_hot(df, "k", 0), split)
    sizes = [r["count"] for r in parts.groupBy("_chunk").count().collect()]
    assert sum(sizes) == 400 and max(sizes) <= 100
    assert sorted(r.n for r in running(df, "k", ["x"], Running(sums={"n": F.lit(1).cast("long")}), split=split).collect()) == list(range(1, 401))


@pytest.mark.parametrize("split", [PLAIN, FORCED])
@pytest.mark.parametrize("direction,strict", [("backward", False), ("backward", True), ("forward", False), ("forward", True)])
def test_asof_against_brute_force(spark, split, direction, strict):
    left, lrows = make(spark, 4, 120)
    right, rrows = make(spark, 5, 120)
    right = right.withColumnsRenamed({"id": "rid", "at": "rat", "v": "rv"})
    got = asof_within(left, right, "k", "at", "rat", {"rid": F.col("rid")}, 1800, direction, strict, "rid", split)
    found = {r.id: (r.rid, r.matched_at) for r in got.collect()}
    assert len(found) == len(lrows)
    for i, k, at, _ in lrows:
        gap = lambda r: (at - r[2]).total_seconds() * (1 if direction == "backward" else -1)
        near = [r for r in rrows if k is not None and at is not None and r[1] == k and r[2] is not None
                and (gap(r) > 0 if strict else gap(r) >= 0) and gap(r) <= 1800]
        want = None
        if near:
            best = min(gap(r) for r in near)
            ties = [r[0] for r in near if gap(r) == best]
            want = max(ties) if direction == "backward" else min(ties)
        assert found[i][0] == want


@pytest.mark.parametrize("split", [PLAIN, FORCED])
def test_asof_many_mixes_strict_and_inclusive(spark, split):
    left = spark.createDataFrame([("a", T0)], "k string, at timestamp")
    events = spark.createDataFrame([("a", T0), ("a", T0 + dt.timedelta(hours=5))], "k string, e timestamp")
    out = asof_many(
        left, [Source(events, "e", {"same": F.col("e")}), Source(events, "e", {"later": F.col("e")}, strict=True)],
        "k", "at", "forward", split,
    ).first()
    assert (out.same, out.later) == (T0, T0 + dt.timedelta(hours=5))


@pytest.mark.parametrize("split", [PLAIN, FORCED])
def test_count_within_and_next_activity(spark, split):
    df, rows = make(spark, 6)
    counted = {r.id: r.n for r in count_within(df, "k", "at", 1200, "n", split).collect()}
    facts = df.select("k", F.col("at").alias("f_at"), F.col("v").alias("f_v"))
    nxt = {r.id: (r.nx, r.flag) for r in next_activity(
        df, facts, "k", "at", "f_at", 1200, F.col("f_v") == 3, "nx", "flag", split).collect()}
    for i, k, at, _ in rows:
        hits = [r for r in rows if k is not None and at is not None and r[1] == k and r[2] is not None
                and 0 < (r[2] - at).total_seconds() <= 1200]
        assert counted[i] == len(hits)
        assert nxt[i] == (min((r[2] for r in hits), default=None), int(any(r[3] == 3 for r in hits)))


def test_passes_by_one_key_make_their_input_once(spark, tmp_path):
    """Rows without key or time share the pass of the others, and what follows by the same key takes the rows where they lie."""
    df, rows = make(spark, 9)
    df.write.parquet(str(tmp_path / "events"))
    read = lambda: spark.read.parquet(str(tmp_path / "events"))
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = running(read(), "k", ["at", "id"], Running(sums={"n": F.lit(1).cast("long")}))
        before = read().filter("v = 1").select("k")
        counted = add_counts_before(numbered, before, "k", {"n": F.lit(1).cast("long")})
        near = asof_many(counted, [Source(read().filter("v = 2"), "at", {"next_two": F.col("at")}, strict=True)], "k", "at", "forward")
        out = count_within(near, "k", "at", 1200, "close")
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r.id: r for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    # one scan each of the rows, the earlier counts with and without a key, and the source; three ordered passes
    assert plan.count("FileScan") == 4 and plan.count("Window [") == 3
    # the rows are dealt for the first pass and once more with the source, the earlier counts once by key and once to one row
    assert plan.count("Exchange hashpartitioning") == 3
    assert len(got) == len(rows) and out.columns == [*df.columns, "n", "next_two", "close"]
    late = lambda r: (r[2] is None, r[2] or T0, r[0])
    for i, k, at, v in rows:
        mine = [r for r in rows if r[1] == k]
        assert got[i].n == sum(late(r) <= late((i, k, at, v)) for r in mine) + sum(r[3] == 1 for r in mine)
        twos = [r[2] for r in mine if k is not None and at is not None and r[2] is not None and r[2] > at and r[3] == 2]
        assert got[i].next_two == min(twos, default=None)
        assert got[i].close == sum(k is not None and at is not None and r[2] is not None and 0 < (r[2] - at).total_seconds() <= 1200 for r in mine)


def test_match_latest_left_is_one_to_one_on_the_right(spark):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    left = spark.createDataFrame([("a", "x1", at(0)), ("a", "x2", at(5))], "k string, lid string, lat timestamp")
    right = spark.createDataFrame([("a", "y1", at(6)), ("a", "y2", at(9)), ("a", "y3", at(30))], "k string, rid string, rat timestamp")
    pairs = lambda **kw: rows_of(match_latest_left(
        left, right, "k", "lat", "rat", {"lid": F.col("lid")}, 600, left_id="lid", right_id="rid", **kw
    ).select("lid", "rid"))
    assert pairs() == [("x2", "y1"), ("x2", "y2")]
    assert pairs(nearest_only=True) == [("x2", "y1")]


def test_hot_keys_are_found_and_salted(spark):
    df, rows = make(spark, 7)
    most = max(sum(r[1] == k for r in rows) for k in ("b", "c", None))
    hot = find_hot(df, "k", most)
    assert [r[0] for r in hot.keys.collect()] == ["a"] and hot.n_keys == 1 and hot.total == sum(r[1] == "a" for r in rows)
    assert find_hot(df, "k").keys is None
    names = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, name string")
    everything = find_hot(df, "k", 0)
    spark.conf.set("spark.fareway.taskRows", "10")
    try:
        for how in ("left", "inner", "left_semi", "left_anti"):
            assert rows_of(lookup_join(df, names, "k", how, hot=everything)) == rows_of(df.join(names, "k", how))
    finally:
        spark.conf.unset("spark.fareway.taskRows")
    for hot in (everything, None):
        for how in ("full", "right"):
            with pytest.raises(ValueError):
                lookup_join(df, names, "k", how, hot=hot)
