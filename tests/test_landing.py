"""Landing, registers, indicators and sinks on written files."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from verdejo.operators.checks import FAILED, PASSED
from verdejo.plans import gold_quality, quality
from verdejo.session import Workspace
from verdejo.sources import indicators, landing, publish, snapshot

NOW, LATER = datetime(2026, 1, 1, 8), datetime(2026, 1, 2, 8)


@pytest.fixture
def source(tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_bytes('﻿id,cep,texto\r\n1,00123,"linha um\nlinha ""dois"""\r\n2,,""\r\n3," 01 ",fim\r\n'.encode("utf-8"))
    return landing.Source("avaliacoes", str(path), "loja", "extrato")


def test_csv_stays_text(spark, source):
    rows = landing.read_text_csv(spark, source.path).collect()
    assert rows[0].asDict() == {"id": "1", "cep": "00123", "texto": 'linha um\nlinha "dois"'}
    assert (rows[1].cep, rows[1].texto, rows[2].cep) == ("", "", " 01 ")


def test_landing_keeps_time_until_content_changes(spark, source, tmp_path):
    root, ws = str(tmp_path / "bronze"), Workspace(spark)
    first = landing.land(spark, [source], root, ws, NOW)[0]
    assert (first["linhas_entrada"], first["linhas_saida"], first["fonte_alterada"]) == (3, 3, True)
    again = landing.land(spark, [source], root, ws, LATER)[0]
    assert (again["data_ingestao"], again["fonte_alterada"]) == (NOW, False)
    landed = landing.landed_tables(spark, root, ["avaliacoes"])
    df = landed["avaliacoes"]
    assert [r._linha_origem for r in df.orderBy("id").collect()] == [1, 2, 3]
    assert df.select("_fonte", "_arquivo_origem", "_data_ingestao").distinct().collect() == [("loja", "reviews.csv", NOW)]
    assert {r.status for r in quality.landed_shape(spark, landed).collect()} == {PASSED}
    assert {r.status for r in quality.landed_content(landed, ["loja"]).collect()} == {PASSED}
    manifest = landing.load_manifest(spark, root)
    prints = spark.createDataFrame([("avaliacoes", first["sha256"])], "tabela string, sha256 string")
    src = {"avaliacoes": landing.read_text_csv(spark, source.path)}
    assert {r.status for r in quality.landed_against_source(landed, src, manifest, prints).collect()} == {PASSED}
    bad = {"avaliacoes": df.filter("id <> '2'")}
    got = {r.id: r.status for r in quality.landed_against_source(bad, src, manifest, prints.withColumn("sha256", F.lit("x"))).collect()}
    assert (got["BRZ-CNT-001"], got["BRZ-CNT-002"], got["BRZ-CNT-003"]) == (FAILED,) * 3
    hole = {r.id: r.status for r in quality.landed_content(bad, ["outra"]).collect()}
    assert hole["BRZ-LIN-001.avaliacoes"] == FAILED and hole["BRZ-LIN-002.avaliacoes"] == FAILED
    with open(source.path, "a") as f:
        f.write("4,1,novo\r\n")
    third = landing.land(spark, [source], root, ws, LATER)[0]
    assert (third["data_ingestao"], third["linhas_saida"]) == (LATER, 4)


def test_numbers_restart_in_every_file(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(5):
        (folder / f"f{i}.csv").write_text("a\n" + "\n".join(f"{i}-{j}" for j in range(i + 2)) + "\n")
    df = landing.with_lineage(landing.read_text_csv(spark, str(folder)), "loja", NOW)
    for r in df.collect():
        i, j = r.a.split("-")
        assert r._linha_origem == int(j) + 1 and r._arquivo_origem == f"f{i}.csv"
    assert df.count() == 20


def test_missing_and_unknown_sources(spark, source):
    gone = landing.Source("x", "/nowhere/x.csv", "loja", "peca ao time")
    with pytest.raises(landing.MissingSource, match="peca ao time"):
        landing.require(spark, [source, gone])
    with pytest.raises(ValueError, match="desconhecida"):
        landing.chosen([source], ["nada"])
    with pytest.raises(landing.MissingSource):
        landing.landed_tables(spark, "/nowhere", ["a"])


def test_ragged_record_stops(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception):
        landing.read_text_csv(spark, str(path)).collect()


def test_register_is_flattened(spark, tmp_path):
    path = tmp_path / "m.json"
    uf = {"id": 35, "sigla": "SP", "nome": "São Paulo", "regiao": {"id": 3, "sigla": "SE", "nome": "Sudeste"}}
    near = {"id": 1, "nome": "perto", "regiao-intermediaria": {"id": 2, "nome": "meio", "UF": uf}}
    rows = [{"id": 3500105, "nome": "Adamantina", "microrregiao": {"id": 5, "nome": "mi", "mesorregiao": {"id": 6, "nome": "me", "UF": uf}},
             "regiao-imediata": near}, {"id": 5101837, "nome": "Nova", "microrregiao": None, "regiao-imediata": near}]
    path.write_text(json.dumps(rows))
    got = {r.id: r for r in landing.read_register(spark, str(path)).collect()}
    assert len(got["3500105"]) == 22 and got["3500105"].microrregiao_mesorregiao_uf_sigla == "SP"
    assert got["5101837"].microrregiao_mesorregiao_uf_sigla == ""
    assert got["5101837"].regiao_imediata_regiao_intermediaria_uf_regiao_nome == "Sudeste"
    path.write_text(json.dumps([{"id": 1, "x": [1, 2]}]))
    with pytest.raises(landing.UnexpectedStructure):
        landing.read_register(spark, str(path))


def test_indicator_responses(spark, tmp_path):
    def response(rows, name):
        path = tmp_path / name
        path.write_text(json.dumps([{"D1C": "Município (Código)", "D3C": "Ano (Código)", "V": "Valor"}, *rows]))
        return indicators.read_response(spark, str(path))

    def row(code, value, year="2017"):
        return {"D1C": code, "D3C": year, "V": value}

    people = response([row("1", "1000"), row("2", "..."), row("3", "0"), row("5", "3")], "p.json")
    wealth = response([row("1", "12345"), row("2", "7"), row("3", "9"), row("4", "X"), row("5", " 10 ")], "w.json")
    got = {r.cod_ibge: (r.populacao_estimada, None if r.pib_per_capita is None else str(r.pib_per_capita))
           for r in indicators.consolidate(people, wealth).collect()}
    assert got == {"1": (1000, "12345.00"), "2": (None, None), "3": (0, None), "4": (None, None), "5": (3, "3333.33")}
    with pytest.raises(ValueError, match="ano"):
        response([row("1", "2", "2018")], "y.json")
    with pytest.raises(ValueError, match="duplicado"):
        response([row("1", "2"), row("1", "2")], "d.json")
    for code in ("12x", None, ""):
        with pytest.raises(ValueError, match="codigo invalido"):
            response([row("1", "2"), row(code, "2")], f"c{code}.json")
    with pytest.raises(ValueError, match="sem dados"):
        response([], "e.json")


def test_sinks_and_pointer(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x;"y"\nz'), ("b", None)], "k string, v string")
    assert publish.write_table(df, str(tmp_path / "t")) == 2
    assert publish.write_table(df, str(tmp_path / "t.csv")) == 2
    root = str(tmp_path / "pub")
    assert publish.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, root, ["t"])
    publish.publish(spark, root, {"t": df})
    publish.publish(spark, root, {"t": df.filter("k = 'a'")})
    assert publish.read_published(spark, root, ["t"])["t"].count() == 1


def test_numbers_with_equal_base_names_and_split_files(spark, tmp_path):
    for d in ("x=1", "x=2"):
        (tmp_path / "t" / d).mkdir(parents=True)
        (tmp_path / "t" / d / "part.csv").write_text("a\n" + "\n".join(f"{d}-{j:05d}" for j in range(3000)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        scan = landing.read_text_csv(spark, str(tmp_path / "t"), multi_line=False)
        assert scan.rdd.getNumPartitions() > 4
        rows = landing.with_lineage(scan, "loja", NOW).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.a, r._linha_origem) for r in rows) == [(f"{d}-{j:05d}", j + 1) for d in ("x=1", "x=2") for j in range(3000)]


def test_fingerprint_sees_order_names_and_line_ends_at_any_layout(spark, tmp_path):
    def of(text, name="f.csv"):
        path = tmp_path / name
        path.write_bytes(text.encode())
        return landing.fingerprint(spark, landing.Source("t", str(path), "loja", ""))
    text = "a\n" + "\n".join(map(str, range(500)))
    base = of(text)
    assert of(text) == base
    changed = [of(text.replace("17\n18", "18\n17")), of(text + "\n"), of(text.replace("\n", "\r\n")), of(text, "g.csv"), of(text + "0")]
    assert len({base, *changed}) == 6
    of(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        assert of(text) == base
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_failed_landing_keeps_the_earlier_table(spark, tmp_path, monkeypatch):
    path = tmp_path / "orders.csv"
    path.write_text("a,b\n1,2\n")
    source, root, ws = landing.Source("pedidos", str(path), "loja", ""), str(tmp_path / "bronze"), Workspace(spark)
    landing.land(spark, [source], root, ws, NOW)
    path.write_text("a,b\n1,2\n3,4\n")
    real = landing.with_lineage
    monkeypatch.setattr(landing, "with_lineage", lambda *a: real(*a).limit(1))
    with pytest.raises(landing.CountMismatch):
        landing.land(spark, [source], root, ws, NOW)
    assert landing.landed_tables(spark, root, ["pedidos"])["pedidos"].count() == 1


def test_a_crash_leaves_the_earlier_manifest_and_table(spark, tmp_path, monkeypatch):
    path = tmp_path / "orders.csv"
    path.write_text("a,b\n1,2\n")
    source, root, ws = landing.Source("pedidos", str(path), "loja", ""), str(tmp_path / "bronze"), Workspace(spark)
    landing.land(spark, [source], root, ws, NOW)
    before = landing.load_manifest(spark, root).collect()
    path.write_text("a,b\n1,2\n3,4\n")

    def crash(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(landing, "put_text", crash)
        with pytest.raises(KeyboardInterrupt):
            landing.land(spark, [source], root, ws, LATER)
    assert landing.load_manifest(spark, root).collect() == before
    assert landing.landed_tables(spark, root, ["pedidos"])["pedidos"].count() == 1
    open_reader = landing.landed_tables(spark, root, ["pedidos"])["pedidos"]
    landing.land(spark, [source], root, ws, LATER)
    assert landing.landed_tables(spark, root, ["pedidos"])["pedidos"].count() == 2 and open_reader.count() == 1
    landing.land(spark, [source], root, ws, LATER)
    assert len(list((tmp_path / "bronze" / "pedidos").iterdir())) == 2


def test_rows_do_not_move_while_landing(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a\n" + "\n".join(map(str, range(2000))) + "\n")
    df = landing.read_text_csv(spark, str(path))
    ws = Workspace(spark)
    blocks = ws.keep("blocks", landing.file_blocks(df.select("*", F.col("_metadata"))))
    plan = landing.with_lineage(df, "loja", NOW, blocks)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_old_versions_go(spark, tmp_path):
    root = str(tmp_path / "pub")
    df = spark.createDataFrame([("a",)], "k string")
    for _ in range(4):
        publish.publish(spark, root, {"t": df})
    with pytest.raises(RuntimeError):
        publish.publish(spark, root, {"t": df}, before_switch=lambda: (_ for _ in ()).throw(RuntimeError()))
    now = publish.current_version(spark, root)
    publish.publish(spark, root, {"t": df})
    left = {p.name for p in (tmp_path / "pub").iterdir() if p.name.startswith("version=")}
    assert len(left) == 2 and f"version={now}" in left and f"version={publish.current_version(spark, root)}" in left


def test_split_files_must_not_hold_line_breaks(spark, source, tmp_path):
    plain = landing.Source(source.table, source.path, "loja", "", multi_line=False)
    with pytest.raises(landing.UnexpectedStructure, match="multi_line"):
        landing.land(spark, [plain], str(tmp_path / "bronze"), Workspace(spark), NOW)
    path = tmp_path / "plain.csv"
    path.write_text('a,b\n1,"x ""y"""\n2,\n')
    done = landing.land(spark, [landing.Source("t", str(path), "loja", "", multi_line=False)], str(tmp_path / "bronze"), Workspace(spark), NOW)
    assert done[0]["linhas_saida"] == 2


def test_inputs_that_change_stop_a_publication(spark, tmp_path):
    df = spark.range(10).selectExpr("cast(id as string) k")
    df.write.parquet(str(tmp_path / "in"))
    pinned = snapshot.pin(spark, {"t": str(tmp_path / "in")})
    root = str(tmp_path / "out")
    publish.publish(spark, root, pinned.tables(spark), before_switch=pinned.guard(spark))
    before = publish.current_version(spark, root)
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert pinned.tables(spark)["t"].count() == 10 and pinned.as_table(spark).count() == len(pinned.files["t"])
    with pytest.raises(snapshot.InputsChanged, match="novo"):
        publish.publish(spark, root, pinned.tables(spark), before_switch=pinned.guard(spark))
    df.write.mode("overwrite").parquet(str(tmp_path / "in"))
    with pytest.raises(snapshot.InputsChanged, match="sumiu"):
        pinned.guard(spark)()
    assert publish.current_version(spark, root) == before and publish.read_published(spark, root, ["t"])["t"].count() == 10


def test_sorted_tables_and_their_borders(spark, tmp_path):
    rows = spark.range(5000).selectExpr("if(id % 50 = 0, null, cast((id * 7919) % 5000 as string)) a", "id % 7 b")
    path, order = str(tmp_path / "s"), ["a", "b"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert publish.write_table(rows, path, order) == 5000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tuple(publish.borders(spark, path, order).first()) == (5000, 0, 0)
    ranges = publish.key_ranges(spark, path, order).orderBy("arquivo").collect()
    assert sum(r.linhas for r in ranges) == 5000 and len(ranges) > 1
    rows.repartition(4).write.parquet(str(tmp_path / "u"))
    got = publish.borders(spark, str(tmp_path / "u"), order).first()
    assert got.arquivos_fora_de_ordem > 0 and got.linhas_fora_de_ordem > 0


def test_shape_checks_count_rows(spark, source, tmp_path):
    landing.land(spark, [source], str(tmp_path / "bronze"), Workspace(spark), NOW)
    df = landing.landed_tables(spark, str(tmp_path / "bronze"), ["avaliacoes"])["avaliacoes"]
    bad = {"a": df, "b": df.drop("_fonte"), "c": df.withColumn("cep", F.lit(1)), "d": df.withColumn("_fonte", F.when(F.col("id") == "1", F.col("_fonte")))}
    got = {r.id: (r.encontrado, r.status, r.detalhes) for r in quality.landed_shape(spark, bad).collect()}
    assert got["BRZ-EST-002"] == ("5", FAILED, "b._fonte") and got["BRZ-EST-004"] == ("3", FAILED, "c.cep")
    assert got["BRZ-EST-003"][1] == PASSED


def test_an_unchanged_source_is_not_written_again(spark, tmp_path):
    path, root, ws = tmp_path / "orders.csv", str(tmp_path / "bronze"), Workspace(spark)
    path.write_text("a,b\n1,2\n")
    source = landing.Source("pedidos", str(path), "loja", "")
    versions = lambda: {p.name for p in (tmp_path / "bronze" / "pedidos").iterdir()}
    landing.land(spark, [source], root, ws, NOW)
    first = versions()
    again = landing.land(spark, [source], root, ws, LATER)[0]
    assert versions() == first and (again["linhas_entrada"], again["linhas_saida"], again["data_ingestao"]) == (1, 1, NOW)
    # another tag, or rows that are gone, are reasons to write
    landing.land(spark, [landing.Source("pedidos", str(path), "outra", "")], root, ws, LATER)
    assert len(versions()) == 2 and landing.landed_tables(spark, root, ["pedidos"])["pedidos"].first()._fonte == "outra"
    for part in (tmp_path / "bronze").glob(f"{landing.load_manifest(spark, root).first().pasta}/*.parquet"):
        spark.createDataFrame([], spark.read.parquet(str(part)).schema).write.mode("overwrite").parquet(str(part.parent))
    landing.land(spark, [source], root, ws, LATER)
    assert landing.landed_tables(spark, root, ["pedidos"])["pedidos"].count() == 1


def test_checks_in_parts_run_one_after_the_other(spark, tmp_path):
    from verdejo.operators import checks as C
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "k long, v long")

    def checks(done):
        return [C.rows(done["t"], [(C.Check(f"{n}-{i}", "c", "t"), F.col("k") < 0) for i in range(2)]) for n in "ab"]
    apart = publish.publish(spark, str(tmp_path / "apart"), {"t": df}, check=checks)
    whole = publish.publish(spark, str(tmp_path / "whole"), {"t": df}, check=lambda done: C.union(checks(done)))
    assert [r.id for r in apart.collect()] == ["a-0", "a-1", "b-0", "b-1"]
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, whole.collect())) and apart.schema == whole.schema
    with pytest.raises(ValueError, match="b-1"):
        publish.publish(spark, str(tmp_path / "bad"), {"t": df}, check=lambda done: [
            *checks(done)[:1], C.rows(done["t"], [(C.Check("b-1", "c", "t"), F.col("k") > 3)])])


def test_checks_of_the_star_are_the_families_together(spark):
    from verdejo.plans.warehouse import open_warehouse
    w = open_warehouse(spark, "/root/testdata/sf0.001")
    gold, s = w.gold.all(), w.contract
    parts = gold_quality.families(gold, s)
    assert len(parts) > 1
    assert [r.id for p in parts for r in p.collect()] == [r.id for r in gold_quality.analyse(gold, s).collect()]
