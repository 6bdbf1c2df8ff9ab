"""Run a Spark query and its oracle on the same tables and compare all rows."""

from __future__ import annotations

import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if isinstance(v, bool):
        return v
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    """(equal, message). Columns are matched by name, rows as bags, doubles exactly."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    got = [tuple(r) for r in spark_df.collect()]
    if sorted(names) != sorted(spark_df.columns):
        return False, f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    a, b = _bag(spark_df.columns, got), _bag(names, want)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp": "TIMESTAMP"}
    odd = [f"{n}:{t}/{types[n]}" for n, t in spark_df.dtypes if kinds.get(t, t) != types[n]]
    note = f" types {odd}" if odd else ""
    if a == b:
        return not odd, f"{len(got)} rows{note}"
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    return False, (
        f"{len(got)} vs {len(want)} rows{note}; columns {sorted(names)}; "
        f"only spark {len(only_a)}: {only_a[:2]}; only oracle {len(only_b)}: {only_b[:2]}"
    )
