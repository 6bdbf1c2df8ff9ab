"""The registered queries of the text operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareway.llm import (
    bestfit_packing, covering_simhash, line_alignment, line_crf, lm_scoring, paragraph_minhash, pii_disclosure, pow2_packing,
    template_decontamination, toxicity, viterbi_counts, walsh_codes, whitening,
)
from fareway.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_alignment.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))


def op2_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_disclosure.find_personal_data(documents(spark, sf_dir)).drop("found", "k1", "k2")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi_counts.count_tokens(documents(spark, sf_dir))


def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_decontamination.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("k1", "k2")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = line_crf.fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return line_crf.label_lines(docs, model)


def op6_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(documents(spark, sf_dir))


def op7_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covering_simhash.near_duplicates(documents(spark, sf_dir)).drop("doc", "first_doc")


def op8_power_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pow2_packing.pack_powers(documents(spark, sf_dir), keep_ids=False)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit_packing.pack_best_fit(documents(spark, sf_dir))


def op10_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated paragraphs by line, and repeated passages by word, whatever their lines."""
    docs = documents(spark, sf_dir)
    lines = paragraph_minhash.repeated_paragraphs(docs).drop("doc")
    passages = paragraph_minhash.repeated_passages(docs)
    return lines.unionByName(passages, allowMissingColumns=True)


def op11_walsh_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walsh_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_polarised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score_documents(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


QUERIES: dict[str, Query] = {
    "op1_line_alignment": op1_line_alignment,
    "op2_pii_disclosure": op2_pii_disclosure,
    "op3_token_counts": op3_token_counts,
    "op4_template_decontamination": op4_template_decontamination,
    "op5_quality_rules": op5_quality_rules,
    "op6_ppm_scoring": op6_ppm_scoring,
    "op7_covering_simhash": op7_covering_simhash,
    "op8_power_packing": op8_power_packing,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_paragraph_minhash": op10_paragraph_minhash,
    "op11_walsh_codes": op11_walsh_codes,
    "op12_polarised_whitening": op12_polarised_whitening,
    "op13_kernel_toxicity": op13_kernel_toxicity,
}
ORACLES: dict[str, str] = {}
