"""Weekly digests against plain loops over the facts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fareway.operators.digest import over_weeks, week_digest, with_week_after

SCHEMA = "k string, id string, d date, v long"


def monday(d):
    return d - dt.timedelta(days=d.weekday())


@pytest.mark.parametrize("days", [3, 7, 13, 30])
def test_windows_equal_a_search_over_all_facts(spark, days):
    rng = random.Random(days)
    rows = [
        (rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", None]), dt.date(2024, 1, 1) + dt.timedelta(days=rng.choice([0, 1, 6, 20, rng.randrange(120)])), rng.choice([None, 1, 5]))
        for _ in range(90)
    ] + [("late", "x", None, 1), ("single", None, dt.date(2024, 2, 4), 2), ("single", None, dt.date(2024, 2, 4), 2)]
    digest = with_week_after(week_digest(spark.createDataFrame(rows, SCHEMA), "k", "d", {"s": F.col("v")}, also=["id"]), "k", ["id"])
    got = {(r.k, r.id, r.week_start): (r.s, r.y, r.before) for r in over_weeks(digest, "k", sums=["s"], active={"y": days}, prior="before").collect()}
    facts = [r for r in rows if r[0] is not None and r[2] is not None]
    weeks = {(k, i, monday(d)) for k, i, d, _ in facts}
    for k, i in {(k, i) for k, i, _, _ in facts}:
        weeks.add((k, i, max(w for a, b, w in weeks if (a, b) == (k, i)) + dt.timedelta(days=7)))
    want = {}
    for k, i, w in weeks:
        own = [(d, v) for a, _, d, v in facts if a == k]
        last = [v for d, v in own if w - dt.timedelta(days=14) <= d < w and v is not None]
        want[k, i, w] = (sum(last) if last else None, int(any(w < d <= w + dt.timedelta(days=days) for d, _ in own)), sum(d < w for d, _ in own))
    assert got == want


def test_no_facts_no_rows(spark):
    empty = week_digest(spark.createDataFrame([], SCHEMA), "k", "d", {"s": F.col("v")})
    assert over_weeks(with_week_after(empty, "k"), "k", sums=["s"], active={"y": 30}, prior="before").count() == 0
