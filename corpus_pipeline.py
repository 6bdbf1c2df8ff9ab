"""From raw documents to training sequences: five stages, each over all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Between stages
the documents are written as Parquet to the shared folder and read again. Columns of any name pass through all stages but the last, and an empty
table gives an empty result in each. What a stage does with NULLs, texts without words and repeated rows is said at the stage; very long
texts are treated as any other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareway.llm import covering_simhash, line_alignment, line_crf, pow2_packing, template_decontamination
from fareway.llm.common import documents
from fareway.session import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and have enough words in content lines stay.

    NULL texts and texts without words fail the base rules and go. Repeated rows are judged each; a NULL id does not matter.
    """
    model = line_crf.fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return line_crf.keep_documents(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has go; a document that has no word left goes with them.

    So do NULL texts and texts without words. Rows alike in id and text keep the same lines each; a NULL id comes after all others.
    """
    out = line_alignment.dedup_lines(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the first by id, of equal ids the first by a hash of the text.

    Texts without words, NULL among them, are one group. Of repeated rows one stays. A document with a NULL id stays only if its group has no other.
    """
    return covering_simhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, by id and text: ids may be NULL or repeated. NULL texts and texts without words hold none and stay."""
    held = template_decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    held = held.select(F.col("k1").alias("held_k1"), F.col("k2").alias("held_k2")).distinct()
    k1, k2 = template_decontamination.text_keys(docs["doc_id"], docs["text"])
    return docs.join(held, (k1 == held["held_k1"]) & (k2 == held["held_k2"]), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length, with their ids. A NULL text is packed as an empty one: its end mark alone. Repeated rows are packed each."""
    return pow2_packing.pack_powers(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; no documents give no pieces."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


ORACLE_SQL = None  # a trained field, patience diff and token ids are beyond SQL; tests compare with brute force

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
