"""Table and file readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.time import parse_ticket_time
from .schemas import DRIVER_TABLES, TICKETS


def read_table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A Parquet table under `root` with its declared schema, or a catalog table without `root`."""
    if root is None:
        return spark.table(name)
    reader = spark.read.schema(DRIVER_TABLES[name]) if name in DRIVER_TABLES else spark.read
    return reader.parquet(f"{root}/{name}.parquet")


def read_tickets(spark: SparkSession, path: str) -> DataFrame:
    """Support tickets from CSV; `initiated_date` is the parsed time, NULL where it is malformed."""
    rows = spark.read.csv(path, schema=TICKETS, header=True)
    return with_ticket_time(rows)


def with_ticket_time(tickets: DataFrame) -> DataFrame:
    return tickets.withColumn("initiated_date", parse_ticket_time(F.col("initiated_at")))
