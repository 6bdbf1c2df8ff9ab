"""What the text operators share: reading a column pair, batches, and the folder all executors see."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import fareway.llm
from fareway.session import cut_lineage  # noqa: F401  the operators take it from here

# task code travels with the task, so executors need not have this package on their path
cloudpickle.register_pickle_by_value(fareway.llm)

BATCH_ROWS = 500


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table of documents."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, a NULL text as the empty one; other columns cannot clash."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )


def document_key(doc_id: Column, text: Column) -> Column:
    """25 bytes that order documents by id (NULL last), then by a hash of the text; rows alike in both share it."""
    as_bytes = lambda x: F.unhex(F.lpad(F.hex(x), 16, "0"))
    doc_id, text = doc_id.cast("long"), F.coalesce(text.cast("string"), F.lit(""))
    flag = F.when(doc_id.isNull(), F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00")))
    number = as_bytes(F.coalesce(doc_id, F.lit(0)).bitwiseXOR(F.lit(-(2**63))))
    return F.concat(flag, number, as_bytes(F.xxhash64(text)), as_bytes(F.xxhash64(text, F.lit(1))))


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_text` and the document's key `doc`."""
    return id_text(docs, id_col, text_col).select(document_key(F.col("doc_id"), F.col("text")).alias("doc"), "doc_id", "text")


def per_worker(name: str, key: object, make: Callable[[], object]) -> object:
    """A value that a Python worker keeps between its tasks; another key replaces it."""
    store = sys.modules.setdefault("_fareway_llm_worker", types.ModuleType("_fareway_llm_worker")).__dict__
    if name not in store or store[name][0] != key:
        store[name] = key, make()
    return store[name][1]


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[dict[str, list]], Iterable[dict]]], schema: str, rows: int = BATCH_ROWS
) -> DataFrame:
    """`make()` runs once a task; what it returns turns the columns of a batch into column dicts.

    Arrow batches are cut to `rows` rows, so a batch of long texts stays small in a Python worker.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                for columns in work({name: part.column(name).to_pylist() for name in part.schema.names}):
                    yield pa.RecordBatch.from_pydict(columns, schema=out)
        for columns in getattr(work, "rest", lambda: ())():
            yield pa.RecordBatch.from_pydict(columns, schema=out)

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return df.mapInArrow(run, schema)
