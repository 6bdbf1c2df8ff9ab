"""Writers: full rebuild, daily snapshot, append with retention.

Rows are computed and written beside a table first and swapped in after that, so a run that fails leaves the table as it was, and the same run
started again ends alike. How partitions are replaced is an option of the write; no session setting is changed, so different tables
can be written at the same time. One table has one writer at a time.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.fixed_values import LOCAL_ZONE
from ..functions.time import days, monday

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # how a partition path names NULL


def with_run_ts(df: DataFrame, run_at: dt.datetime, out: str = "query_run_timestamp", zone: str = LOCAL_ZONE) -> DataFrame:
    """Stamp all rows with the run time (naive UTC), shown in the local zone."""
    stamp = F.from_utc_timestamp(F.lit(run_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"), zone)
    return df.withColumn(out, stamp)


def write_rebuild(df: DataFrame, table: str) -> None:
    """Replace a table as a whole: the new one is written beside it, then both change names and the old one goes.

    `df` may read the table itself. A run that stopped between the two changes of name is set right by the next one.
    """
    # a name of its own for each run: a write that fails leaves an empty folder behind, which would bar a second one of its name
    spark, new, old = df.sparkSession, f"{table}__new_{uuid4().hex[:12]}", f"{table}__old"
    exists = spark.catalog.tableExists
    if not exists(table) and exists(old):
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    df.write.format("parquet").saveAsTable(new)
    if exists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def write_snapshot(df: DataFrame, path: str, run_date: dt.date) -> None:
    """Write one run's rows; a second run of the same day replaces the first, other days stay."""
    (
        df.withColumn("run_date", F.lit(run_date))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date").parquet(path)
    )


def write_days(df: DataFrame, path: str, day: str) -> None:
    """Replace the days that occur in `df`, one folder a day; other days stay.

    A day is spread over as many tasks as its rows need. A day that has no row any more keeps its old ones.
    """
    df.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def snapshot_asof(df: DataFrame, run_date: dt.date, columns=None) -> DataFrame:
    """The distinct rows of one run; a partition filter when the table is laid out by run date."""
    picked = df.filter(F.col("run_date") == F.lit(run_date))
    return picked.select(*(columns or [c for c in df.columns if c != "run_date"])).distinct()


def insert_by_name(df: DataFrame, table: str, columns) -> None:
    """Append the listed columns to a table by name, whatever their order in `df`.

    The list must name every column of the table.
    """
    order = df.sparkSession.table(table).columns
    if sorted(order) != sorted(columns):
        raise ValueError(f"columns {sorted(columns)} do not match table columns {sorted(order)}")
    df.select(*order).write.mode("append").insertInto(table)


def _partitions(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """Values by partition column, one entry per partition kept."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [{c: unquote(v) for c, v in (part.split("=", 1) for part in row[0].split("/"))} for row in rows]


def _spec(parts: dict[str, str]) -> str:
    text = lambda v: "NULL" if v == NO_VALUE else "'" + v.replace("'", "\\'") + "'"
    return "PARTITION (" + ", ".join(f"`{c}` = {text(v)}" for c, v in parts.items()) + ")"


def _drop(spark: SparkSession, table: str, partitions: list[dict[str, str]]) -> None:
    for parts in partitions:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_spec(parts)}")


def _replace_partitions(rows: DataFrame, table: str, by: list[str]) -> list[dict[str, str]]:
    """Replace the partitions that `rows` have, in the table's own folder; the catalog then learns of the new ones. Returns those written.

    A write to a folder takes the overwrite mode as an option, which an insert into a catalog table does not. Rows are made once: they lie beside the
    table until all are written, and the write itself notes their partitions.
    """
    spark = rows.sparkSession
    folder = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()[-1]["data_type"]  # a column of that name comes first
    seen = Observation()
    keys = F.struct(*[F.coalesce(F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")), F.lit(NO_VALUE)).alias(c) for c in by])
    noted = rows.observe(seen, F.collect_set(keys).alias("parts"))  # one value per partition written
    noted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(folder)
    written = [row.asDict() for row in seen.get["parts"]]
    known = _partitions(spark, table)
    for parts in written:
        if parts not in known:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {_spec(parts)}")
    spark.catalog.refreshTable(table)
    return written


def purge_before(spark: SparkSession, table: str, date_c: str, bound: dt.date) -> int:
    """Drop the date partitions before `bound`, whatever else the table is partitioned by."""
    is_day = lambda v: v[:4].isdigit()
    expired = [p for p in _partitions(spark, table) if is_day(p[date_c]) and dt.date.fromisoformat(p[date_c]) < bound]
    _drop(spark, table, expired)
    return len(expired)


def append_with_retention(df: DataFrame, table: str, date_c: str, as_of: dt.date, weeks: int = 55, run_c: str | None = None) -> None:
    """Write the new rows by name, then purge partitions older than `weeks` before this Monday.

    With `run_c` the table has a partition column of that name, the Monday of the run: a second run of the same week replaces the rows of the
    first, all of them and no others, whatever their dates. Without it the days in `df` replace those days in the table, which is right
    only for rows that are whole days.
    """
    spark, run, by = df.sparkSession, monday(as_of), [run_c, date_c] if run_c else [date_c]
    first = not spark.catalog.tableExists(table)
    if first:
        none = df.limit(0)
        (none.withColumn(run_c, F.lit(run)) if run_c else none).write.partitionBy(*by).format("parquet").saveAsTable(table)
    order = [c for c in spark.table(table).columns if c != run_c]
    if sorted(order) != sorted(df.columns) or run_c and run_c not in spark.table(table).columns:
        raise ValueError(f"columns {sorted(df.columns)} do not match table columns {sorted(spark.table(table).columns)}")
    rows, target = df.select(*order), spark.table(table).schema
    placed = (rows.withColumn(run_c, F.lit(run)) if run_c else rows).select(*(F.col(f"`{f.name}`").cast(f.dataType) for f in target))
    try:
        written = _replace_partitions(placed, table, by)
    except Exception:
        if first:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    if first:
        return
    if run_c:
        _drop(spark, table, [p for p in _partitions(spark, table) if p[run_c] == str(run) and p not in written])
    purge_before(spark, table, date_c, run - days(7 * weeks))
