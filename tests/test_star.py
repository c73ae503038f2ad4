"""The star on the small regression case, its failures, and the panel."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from verdejo.operators import checks as C
from verdejo.operators import contract as contracts
from verdejo.plans.schemas import STAR_INPUTS
from verdejo.plans import gold, gold_quality, kpis, panel, pipeline, quality
from verdejo.sources import publish

BLANK = {"string": "", "int": 0, "bigint": 0, "boolean": False}


def tables(spark, rows):
    out = {}
    for name, contract in STAR_INPUTS.items():
        data = []
        for given in rows.get(name, []):
            data.append(tuple(given.get(f.name, None if f.nullable else BLANK[f.dataType.simpleString()]) for f in contract.schema))
        out[name] = spark.createDataFrame(data, contract.schema)
    return out


def case():
    def d(x):
        return datetime.fromisoformat(x)

    items = [dict(order_id="o1", item_pedido_id=i, product_id="pr1", seller_id="v1", preco_produto=Decimal(v), valor_frete=Decimal(1),
                  valor_total_item=Decimal(v + 1)) for i, v in ((1, 10), (2, 20))]
    return {
        "clientes": [dict(customer_id="c1", customer_unique_id="pessoa", uf="SP"), dict(customer_id="c2", customer_unique_id="pessoa", uf="SP")],
        "clientes_municipios": [dict(customer_id="c1", cod_ibge="0000001", metodo_match="exato"),
                                dict(customer_id="c2", metodo_match="nao_resolvido", motivo_nao_resolvido="sem coordenadas")],
        "geografia_integrada": [dict(cod_ibge="0000001", municipio="Cidade", municipio_normalizado="cidade", uf="SP", porte_municipio="Pequeno")],
        "vendedores": [dict(seller_id="v1", uf="SP")], "vendedores_municipios": [dict(seller_id="v1", cod_ibge="0000001", metodo_match="exato")],
        "produtos": [dict(product_id="pr1", categoria_produto="cat", categoria_produto_ingles="cat", peso_g=1000.0)],
        "pedidos": [dict(order_id="o1", customer_id="c1", status_pedido="delivered", ts_compra=d("2015-12-30"), ts_entrega_cliente=d("2016-01-02"),
                         dias_ate_entrega=3, dias_atraso=-1, flag_atraso=False),
                    dict(order_id="o2", customer_id="c2", status_pedido="delivered", ts_compra=d("2018-01-01"), flag_entrega_ausente=True),
                    dict(order_id="o3", customer_id="c1", status_pedido="canceled")],
        "itens_pedido": [*items, dict(order_id="o2", item_pedido_id=1, preco_produto=Decimal(7))],
        "distancias_itens": [*[dict(order_id="o1", order_item_id=i, distancia_km=42.0, flag_distancia_calculada=True) for i in (1, 2)],
                             dict(order_id="o2", order_item_id=1, motivo_distancia_ausente="sem coordenadas")],
        "pagamentos": [dict(order_id="o1", tipo_pagamento_predominante="credit_card", parcelas_tipo_predominante=3, valor_total_pago=Decimal(32),
                            qtd_transacoes=2, qtd_metodos_distintos=1)],
        "avaliacoes": [dict(order_id="o1", review_id="r1", nota_review=5)],
    }


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gold"))
    given = tables(spark, case())
    results = pipeline.load_star(spark, given, root)
    return root, given, results


def test_load_and_reload(spark, loaded):
    root, given, results = loaded
    assert results.count() == 59 and {r.status for r in results.collect()} == {C.PASSED}
    star = publish.read_published(spark, root, gold.KEYS)
    assert star["dim_cliente"].count() == 2
    orders = {r.order_id: r for r in star["fato_pedido"].collect()}
    assert (orders["o1"].quantidade_itens, orders["o1"].valor_total_pedido, orders["o1"].valor_total_pago, orders["o1"].nota_avaliacao) == (2, 32, 32, 5)
    assert (orders["o3"].quantidade_itens, orders["o3"].valor_total_pedido, orders["o3"].nota_avaliacao) == (0, 0, None)
    assert (orders["o2"].sk_geo_cliente, orders["o2"].sk_tempo_entrega, orders["o2"].sk_pagamento, orders["o2"].valor_total_pedido) == (0, 0, 0, None)
    item = star["fato_item_pedido"].filter("order_id = 'o2'").first()
    assert (item.sk_produto, item.sk_vendedor, item.distancia_km) == (0, 0, None)
    assert str(star["dim_tempo"].agg(F.min("data_completa")).first()[0]) == "2015-12-30"
    before = gold_quality.signatures(star).collect()
    pipeline.load_star(spark, tables(spark, {k: v[::-1] for k, v in case().items()}), root)
    assert gold_quality.signatures(publish.read_published(spark, root, gold.KEYS)).collect() == before


def test_orphan_keeps_the_published_version(spark, loaded):
    root, given, _ = loaded
    version = publish.current_version(spark, root)
    bad = {**given, "itens_pedido": given["itens_pedido"].withColumn(
        "product_id", F.when(F.col("order_id") == "o1", "inexistente").otherwise(F.col("product_id")))}
    with pytest.raises(ValueError, match="referencias inexistentes"):
        pipeline.load_star(spark, bad, root)
    assert publish.current_version(spark, root) == version


def test_failed_check_keeps_the_published_version(spark, loaded):
    root, given, _ = loaded
    version = publish.current_version(spark, root)
    bad = {**given, "avaliacoes": given["avaliacoes"].withColumn("nota_review", F.lit(7))}
    with pytest.raises(ValueError, match="Dominio da nota"):
        pipeline.load_star(spark, bad, root)
    assert publish.current_version(spark, root) == version


def verify(tables):
    return contracts.verify(tables, STAR_INPUTS)


def test_contract(spark):
    empty = tables(spark, {})
    assert verify(empty) == []
    assert any("pedidos: tabela nao entregue" in e for e in verify({k: v for k, v in empty.items() if k != "pedidos"}))
    wrong = spark.createDataFrame([(None, 123, "cidade", "SP")] * 2, "seller_id string, cep_prefixo int, cidade string, uf string")
    errors = verify({**empty, "vendedores": wrong})
    assert any("veio como int e o contrato pede string" in e for e in errors)
    assert any("vendedores: seller_id sem valor: 2" in e for e in errors)
    assert any("mais de uma linha por" in e for e in errors)
    short = spark.createDataFrame([("v1",)], "seller_id string")
    assert any("vendedores: falta a coluna cep_prefixo" in e for e in verify({**empty, "vendedores": short}))


DEFECTS = {
    "Total do item": ("fato_item_pedido", {"valor_total_item": "cast(1 as decimal(18,2))"}, "order_id = 'o1' and order_item_id = 1"),
    "Entregas elegiveis": ("fato_pedido", {"dias_ate_entrega": "cast(4 as bigint)"}, "order_id = 'o3'"),
    "Flag de atraso": ("fato_pedido", {"flag_atraso": "true"}, "order_id = 'o1'"),
    "Dominio da nota": ("fato_pedido", {"nota_avaliacao": "9"}, "order_id = 'o1'"),
    "FK fato_pedido.sk_cliente": ("fato_pedido", {"sk_cliente": "77"}, "order_id = 'o1'"),
    "FK fato_item_pedido.sk_produto": ("fato_item_pedido", {"sk_produto": "77"}, "order_id = 'o1'"),
    "Pagamento nao multiplicado": ("fato_pedido", {"valor_total_pago": "cast(64 as decimal(18,2))"}, "order_id = 'o1'"),
    "Distancia oficial preservada": ("fato_item_pedido", {"distancia_km": "1d"}, "order_id = 'o1'"),
    "Tempo de entrega": ("fato_pedido", {"sk_tempo_entrega": "1"}, "order_id = 'o1'"),
    "Membro desconhecido dim_pagamento": ("dim_pagamento", {"sk_pagamento": "5"}, "sk_pagamento = 0"),
    "Agregacao por pedido valor_frete": ("fato_pedido", {"valor_frete": "cast(0 as decimal(18,2))"}, "order_id = 'o1'"),
}


FAMILIES = {"FK": gold_quality.foreign_keys, "Total": gold_quality.rules, "Entregas": gold_quality.rules, "Flag": gold_quality.rules,
            "Dominio": gold_quality.rules, "Membro": gold_quality.structure, "Agregacao": gold_quality.reconciliation}


@pytest.mark.parametrize("check", DEFECTS)
def test_each_defect_is_reported(spark, loaded, check):
    root, given, _ = loaded
    star = publish.read_published(spark, root, gold.KEYS)
    table, change, where = DEFECTS[check]
    column, value = next(iter(change.items()))
    star[table] = star[table].withColumn(column, F.when(F.expr(where), F.expr(value)).otherwise(F.col(column)))
    family = FAMILIES.get(check.split()[0], gold_quality.preservation)
    results = family(star) if family in (gold_quality.foreign_keys, gold_quality.rules) else family(star, given)
    failed = {r.id for r in results.filter("status = 'REPROVADO'").collect()}
    assert check in failed


def test_unmeasurable_check_fails_without_stopping(spark):
    df = spark.createDataFrame([(1,)], "a int")
    got = {r.id: (r.status, r.encontrado) for r in C.rows(df, [
        (C.Check("A", "x", "x"), lambda: F.col("gone") > 1), (C.Check("B", "x", "x"), lambda: F.col("a") > 1)]).collect()}
    assert got == {"A": (C.FAILED, C.UNMEASURED), "B": (C.PASSED, "0")}
    assert C.outcome(C.skipped(spark, C.Check("C", "x", "x"), "falta")).first().resultado_geral == "APROVADO COM ALERTAS"


def test_panel_dates_and_export(spark, loaded, tmp_path):
    root = loaded[0]
    star = publish.read_published(spark, root, gold.KEYS)
    with pytest.raises(ValueError):
        panel.base(star, "2018-01-02", "2018-01-01")
    orders = panel.base(star, "2015-12-30", "2018-01-01")
    row = panel.summary(orders).first()
    assert (row.pedidos_filtrados, row.entregues, row.valor_entregue, row.base_ticket, row.atraso) == (2, 2, 32, 1, 0.0)
    assert panel.base(star, "2015-12-30", "2018-01-01", "SP").count() == 1
    table = panel.export(star, "2015-12-30", "2018-01-01")
    panel.write_export(table, str(tmp_path / "x"))
    back = spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "x"))
    assert back.count() == table.count() and back.columns == ["painel", "secao", "grupo", "valor", "base"]
    assert kpis.measure(star, "CLI-001").first().valor == 1 and kpis.repurchase(star).first().valor == 100.0


def test_layer_checks_report_a_missing_table(spark):
    got = quality.cleaned({}, {"pedidos": tables(spark, {})["pedidos"]}).collect()
    assert got[0].status == C.FAILED and got[1].status == C.SKIPPED


def test_keys_stay_when_an_earlier_member_comes(spark, tmp_path):
    rows, root = case(), str(tmp_path)
    pipeline.load_star(spark, tables(spark, rows), root)
    before = publish.read_published(spark, root, [*gold.KEYS, *gold.KEY_MAPS])
    old = {d: {tuple(r[c] for c in gold.NATURAL[d]): r[gold.KEYS[d][0]] for r in before[d].collect()} for d in gold.NATURAL}
    rows["clientes"].append(dict(customer_id="c0", customer_unique_id="abel", uf="SP"))
    rows["clientes_municipios"].append(dict(customer_id="c0", metodo_match="nao_resolvido", motivo_nao_match="x"))
    rows["produtos"].append({**rows["produtos"][0], "product_id": "aa"})
    rows["pedidos"][0]["ts_compra"] = datetime(2015, 12, 30)  # the calendar grows at its start
    pipeline.load_star(spark, tables(spark, rows), root)
    after = publish.read_published(spark, root, [*gold.KEYS, *gold.KEY_MAPS])
    for d in gold.NATURAL:
        now = {tuple(r[c] for c in gold.NATURAL[d]): r[gold.KEYS[d][0]] for r in after[d].collect()}
        assert all(now[n] == k for n, k in old[d].items()) and len(set(now.values())) == len(now), d
    assert {r.customer_unique_id: r.sk_cliente for r in after["dim_cliente"].collect()}["abel"] == max(old["dim_cliente"].values()) + 1
    assert after["chaves_dim_cliente"].count() == before["chaves_dim_cliente"].count() + 1
