"""Explicit schemas of the inputs."""

# The tables the test driver provides. Times are naive UTC values, read as TIMESTAMP so that
# filters on them reach the scan (the session zone is UTC, see session.configure).
DRIVER_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
}

# Uploaded support tickets: all text, as exported.
TICKETS = (
    "date string, initiated_at string, resolved_at string, chat_type string, csat_score string, "
    "user_properties_phone_number string, user_properties_name string, user_properties_email string"
)
