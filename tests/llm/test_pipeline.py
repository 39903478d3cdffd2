"""The pipeline stage by stage, and the queries against SQL."""

import duckdb  # noqa: F401
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reviewlens.llm.queries import ORACLES, QUERIES, trained_toxicity

NUMBERS = {"op1_toxicity", "op2_exact_dedup", "op3_brown_lm", "op4_decontamination", "op5_quality_cotraining", "op6_secret_scan",
           "op7_language_id", "op8_mixing", "op9_url_filter", "op10_simhash", "op11_hard_negatives", "op12_packing",
           "op13_lexical_search"}


def test_one_query_per_operator():
    assert set(QUERIES) == NUMBERS
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "decontamination", "mixing"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = duck.sql(ORACLES[name])
    at = [want.columns.index(c) for c in columns]
    assert sorted(want.columns) == columns
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())


@pytest.mark.parametrize("name", ["op1_toxicity", "op4_decontamination", "op5_quality_cotraining", "op6_secret_scan", "op7_language_id"])
def test_query_returns_its_rows_once(spark, sf_dir, rows, name):
    ids = [r["doc_id"] for r in QUERIES[name](spark, sf_dir).collect()]
    assert sorted(ids) == [r["doc_id"] for r in rows] if name != "op4_decontamination" else set(ids) <= {r["doc_id"] for r in rows}


def test_stages(spark, sf_dir, docs, rows):
    """Each stage drops exactly what its operator names, and the rows it keeps are whole."""
    score = trained_toxicity(spark, sf_dir).score(F.col("text"))
    bad = {r["doc_id"] for r in docs.where(score >= 0.3).select("doc_id").collect()}
    stage = dict(corpus_pipeline.STAGES)
    mild = stage["toxicity"](spark, docs, sf_dir)
    assert {r["doc_id"] for r in mild.collect()} == {r["doc_id"] for r in rows} - bad
    for name in list(stage)[1:4]:
        assert stage[name](spark, docs, sf_dir).columns == docs.columns
    out = corpus_pipeline.run(spark, sf_dir)
    kept = {r["doc_id"]: r for r in out.collect()}
    assert len(kept) == out.count() and all(r["copies"] >= 1 for r in kept.values())
    whole = {r["doc_id"]: r for r in rows}
    assert all(kept[i][c] == whole[i][c] for i in kept for c in docs.columns)
    assert len({r["text"] for r in kept.values()}) == len(kept) and not set(kept) & bad


def test_stages_on_odd_and_empty_tables(spark, odd, none, sf_dir):
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, odd, sf_dir)
        assert kept.columns == odd.columns and 0 < kept.count() <= odd.count()
        assert stage(spark, none, sf_dir).count() == 0
    assert corpus_pipeline.mixing(spark, none, sf_dir).count() == 0
