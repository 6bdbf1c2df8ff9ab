"""Every registered query against its oracle, and what its plan must not contain."""

import pytest

import __spark_entry__ as entry
from fareway.checks.compare import compare, connect
from fareway.checks.job_oracles import JOB_ORACLES
from fareway.checks.job_queries import JOB_QUERIES
from fareway.checks.operator_queries import ORACLES as OPERATOR_ORACLES
from fareway.checks.operator_queries import QUERIES as OPERATOR_QUERIES

QUERIES, ORACLES = JOB_QUERIES | OPERATOR_QUERIES, JOB_ORACLES | OPERATOR_ORACLES


@pytest.fixture(scope="module")
def oracle(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, oracle, data, name):
    frame = QUERIES[name](spark, data)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for node in ("EvalPython", "MapInPandas", "CartesianProduct"):
        assert node not in plan
    equal, message = compare(frame, oracle, ORACLES[name])
    assert equal, message


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["trip_number", "retention_rate_next_30d", "users_reached_n"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_with_every_key_hot(spark, oracle, data, name):
    """All keys are split and salted; the results must stay the same."""
    spark.conf.set("spark.fareway.hotRows", "0")
    spark.conf.set("spark.fareway.taskRows", "1500")
    try:
        equal, message = compare(QUERIES[name](spark, data), oracle, ORACLES[name])
    finally:
        spark.conf.unset("spark.fareway.hotRows")
        spark.conf.unset("spark.fareway.taskRows")
    assert equal, message
