"""Long format, unions and literal relations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def unpivot_metrics(df: DataFrame, keys, metrics: dict[str, tuple[int, str]]) -> DataFrame:
    """One row per key and metric: `metric`, `metric_order`, `value`; one pass, no cross join."""
    lines = F.array(*[
        F.struct(
            F.lit(name).alias("metric"), F.lit(order).alias("metric_order"),
            F.col(c).cast("double").alias("value"),
        )
        for c, (order, name) in metrics.items()
    ])
    return df.select(*keys, F.explode(lines).alias("_line")).select(*keys, "_line.*")


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def literal_rows(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small relation written out in the program; it becomes part of the plan."""
    fields = T.StructType.fromDDL(schema).fields
    lines = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f.name for f in fields)
    df = spark.sql(f"SELECT * FROM VALUES {lines} AS t({names})")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in fields])
