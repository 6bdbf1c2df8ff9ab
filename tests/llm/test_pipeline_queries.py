"""The registered text queries over whole tables, and the pipeline stage by stage."""

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from fareway.llm import covering_simhash, line_alignment, template_decontamination
from fareway.llm.queries import QUERIES

OPERATORS = [f"op{n}_" for n in range(1, 14)]


def test_one_query_per_operator():
    names = entry.queries()
    assert "pipeline" in names and all(sum(x.startswith(o) for x in names) == 1 for o in OPERATORS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_over_the_whole_table(spark, data, name):
    out = QUERIES[name](spark, data)
    whole = spark.read.parquet(f"{data}/documents.parquet").count()
    rows = out.count()
    vectors = spark.read.parquet(f"{data}/embeddings.parquet").count()
    if name.split("_")[0] in ("op1", "op2", "op3", "op5", "op6", "op7", "op13"):
        assert rows == whole
    elif name.split("_")[0] in ("op11", "op12"):
        assert rows == vectors * (8 if name.startswith("op12") else 1)
    else:
        assert rows > 0


def test_pipeline_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, data).cache()
        assert after.columns == columns
        ids, kept = {r.doc_id for r in before.select("doc_id").collect()}, Counter(r.doc_id for r in after.select("doc_id").collect())
        assert set(kept) <= ids and max(kept.values()) == 1
        if name == "line_dedup":
            whole = {r.doc_id: r.text for r in line_alignment.dedup_lines(before).collect()}
            assert {r.doc_id: r.text for r in after.collect()} == {i: t for i, t in whole.items() if t and t.split()}
            assert all(r.n_chars == len(r.text) for r in after.collect())
        if name == "near_dedup":
            groups = covering_simhash.near_duplicates(before).collect()
            assert set(kept) == {r.component_id for r in groups}
        if name == "benchmark_decontamination":
            held = template_decontamination.contaminated(before, spark.read.parquet(f"{data}/benchmark.parquet")).collect()
            assert set(kept) == ids - {r.doc_id for r in held}
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, data).collect()
    assert {p.doc_id for p in pieces} == set(kept)


def test_contaminated_documents_go_without_their_namesakes(spark, tmp_path):
    item = "the quick brown fox jumps over the lazy dog near the old river bank"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"so {item} today"), (None, "a clean text without an id"), (None, None), (5, item), (5, "a clean text of the same id"), (6, "clean"), (6, "clean")]
    got = corpus_pipeline.decontaminate(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([rows[1], rows[2], *rows[4:]], key=repr)


def test_clean_documents_pass_the_quality_stage(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, data).collect()}
    good = [r.doc_id for r in docs.collect() if labels.get(r.doc_id) == 1 and len(r.text.split()) >= 20]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.95 * len(good) and sum(i in kept for i in bad) <= 0.1 * len(bad)


ODD = [(None, None), (None, ""), (1, None), (2, ""), (3, " \n\t"), (4, "so it goes " * 30), (4, "so it goes " * 30), (5, "w" * 60_000), (6, "a text of a few plain words. " * 3_000)]
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, doc string, __doc string, doc_key string, h string, lines string, k1 long, fp long, owner string"


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_rows_and_no_rows(spark, data, stage):
    """NULL ids and texts, empty and very long texts, repeated rows, clashing names, and a table without rows."""
    name, run = corpus_pipeline.STAGES[stage]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "d", "dd", "dk", "h", "l", 1, 2, "o") for i, t in ODD], CLASHING)
    for docs, rows in ((frame, len(ODD)), (frame.limit(0), 0)):
        out = run(spark, docs, data)
        got = out.collect()
        if name == "packing":
            assert {r.doc_id for r in got} == {i for i, _ in ODD[:rows]}
        else:
            assert out.columns == docs.columns and len(got) <= rows
            assert all((r["doc"], r["__doc"], r["doc_key"], r["h"], r["k1"], r["fp"], r["owner"]) == ("d", "dd", "dk", "h", 1, 2, "o") for r in got)
            if name == "near_dedup" and rows:  # all texts without words are alike; so are the two rows of document 4
                assert sorted(r.doc_id for r in got) == [1, 4, 5, 6]
