"""The registered corpus queries against SQL, and the pipeline against its stages."""

import oracle
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from tallyroom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    con = oracle.connect(sf_dir)
    assert oracle.compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) > 0
    con.close()


def test_one_query_for_each_operator():
    names = {n.split("_")[0] for n in entry_point.queries() if n.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry_point.queries()


def test_the_pipeline_is_its_stages_one_by_one(spark, sf_dir):
    """Each filter's decisions are those of its operator on what came before."""
    from tallyroom.llm import bpe, mixing, quality_lines, setsketch, toxicity
    from tallyroom.llm.common import table

    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"),
                           usable=~corpus_pipeline.is_remainder("doc_id", 4, 2))
    scored = {r["id"]: r["predicted"] for r in toxicity.score_toxicity(docs, model).collect()}
    docs = docs.where(docs.doc_id.isin([i for i, bad in scored.items() if not bad]))
    lines = quality_lines.train_lines(docs, table(spark, sf_dir, "labels"))
    kept = [r["id"] for r in quality_lines.label_lines(docs, lines).collect() if r["kept"]]
    docs = docs.where(docs.doc_id.isin(kept))
    first = [r["id"] for r in setsketch.near_duplicates(docs).collect() if r["kept"]]
    docs = docs.where(docs.doc_id.isin(first))
    copies = {r["id"]: r["copies"] for r in mixing.mix_plan(docs).collect()}
    tokens = {r["id"]: bytes(r["token_ids"]) for r in bpe.encode(docs).collect()}
    expected = sorted((i, tokens[i]) for i, n in copies.items() for _ in range(n))
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r["doc_id"], bytes(r["token_ids"])) for r in got.collect()) == expected


def test_stages_keep_columns_and_stand_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0
        if name != "encoding":
            assert out.columns == docs.columns
