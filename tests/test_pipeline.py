"""All stages from files to the published star, twice."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from verdejo.operators.keys import dense_ids
from verdejo.plans import gold, gold_quality, pipeline, testbed
from verdejo.session import Workspace
from verdejo.sources import landing, publish

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    raw = testbed.raw_tables(spark, FOLDER)
    # The domain checks reject a missing price and a half-imputed product, as they should.
    raw["itens_pedido"] = raw["itens_pedido"].withColumn("price", F.when(F.col("price") == "", "10.00").otherwise(F.col("price")))
    raw["produtos"] = raw["produtos"].replace("rara", "large", "product_category_name").replace("", "5")
    for name, df in raw.items():
        df.coalesce(1).write.option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).csv(str(root / name))
    sources = [landing.Source(n, str(root / n), "loja", "teste") for n in raw if n != "de_para"]
    return sources, str(root / "de_para")


def test_run_twice(spark, files, tmp_path):
    sources, crosswalk = files
    root = str(tmp_path / "dw")
    first = pipeline.run(spark, sources, crosswalk, root, now=datetime(2026, 1, 1))
    assert first["gold"]["executados"] == 59 and first["gold"]["reprovados"] == 0
    assert first["validacao"]["reprovados"] == 0 and first["validacao"]["executados"] > 70
    star = publish.read_published(spark, root + "/gold", gold.KEYS)
    assert star["fato_pedido"].count() == 1500 and star["fato_item_pedido"].count() == 6000
    before = gold_quality.signatures(star).collect()
    second = pipeline.run(spark, sources, crosswalk, root, now=datetime(2026, 2, 1))
    assert [b["fonte_alterada"] for b in second["bronze"]] == [False] * len(sources)
    assert gold_quality.signatures(publish.read_published(spark, root + "/gold", gold.KEYS)).collect() == before
    report = {r.id: r.status for r in spark.read.json(f"{root}/silver/_validacao").collect()}
    assert all(report[i] == "APROVADO" for i in ("BRZ-EST-001", "BRZ-CNT-001", "BRZ-CNT-002", "BRZ-CNT-003", "BRZ-CNT-004", "REP-003"))
    # a source that changes after its landing is found by recount and fingerprint
    landed = landing.landed_tables(spark, f"{root}/bronze", [s.table for s in sources])
    part = next(f for f in os.listdir(sources[0].path) if f.endswith(".csv"))
    with open(f"{sources[0].path}/{part}") as f:
        lines = f.readlines()
    changed = tmp_path / "changed"
    changed.mkdir()
    (changed / part).write_text("".join(lines[:-1]))
    moved = [landing.Source(sources[0].table, str(changed), "loja", "teste"), *sources[1:]]
    report = {r.id: r.status for r in pipeline.source_checks(spark, moved, landed, f"{root}/bronze").collect()}
    assert report["BRZ-CNT-001"] == "APROVADO" and report["BRZ-CNT-002"] == report["BRZ-CNT-003"] == "REPROVADO"


def test_unknown_stage(spark, files):
    with pytest.raises(ValueError, match="etapa"):
        pipeline.run(spark, files[0], None, "/nowhere", until="ouro")


def test_ids_of_one_row_and_none(spark):
    one = spark.createDataFrame([("x",)], "n string")
    assert dense_ids(one, ["n"], "id", Workspace(spark)).first().id == 1
    assert dense_ids(one.filter("false"), ["n"], "id", Workspace(spark)).count() == 0
