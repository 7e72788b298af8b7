"""The registered queries of this subpackage against their SQL, and the pipeline against its operators."""

import pytest

import corpus_pipeline
from compare import differences
from corpusmill.llm.queries import ORACLES, QUERIES
from test_near_copies import check_by_brute_force


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(name, spark, sf_dir, duck_con):
    assert differences(QUERIES[name](spark, sf_dir), duck_con, ORACLES[name]) == ""


def test_pipeline_rows(spark, sf_dir):
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    toxic = ids(QUERIES["op4_toxic_lexicon"](spark, sf_dir).where("predicted = 1"))
    left = docs.where(~docs["doc_id"].isin(toxic))
    got = ids(corpus_pipeline.STAGES[0][1](spark, docs, sf_dir))
    assert got == ids(left)
    stage = ids(corpus_pipeline.STAGES[1][1](spark, left, sf_dir))
    rows = {r.doc_id: r.text or "" for r in left.collect()}
    check_by_brute_force(list(rows.values()), {i for i, d in enumerate(rows) if d in stage})
    dirty = ids(QUERIES["op3_winnowing"](spark, sf_dir).where("contaminated"))
    assert ids(corpus_pipeline.run(spark, sf_dir)) == stage - dirty
