"""The registered queries of the package: names, result columns, and their plain SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import connect, difference
from verdejo.llm import queries
from verdejo.llm.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    problem = difference(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name])
    assert problem is None, problem


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left and left <= ids
        if i < 4:
            assert docs.columns == names
        else:
            assert left == ids and {"sequence_id", "offset", "length"} <= set(docs.columns)
        ids = left
