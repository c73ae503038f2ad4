"""Layers write what a query reads, and each table once."""

import re
import time

from pyspark.sql import functions as F

from verdejo.plans import gold, integration, panel
from verdejo.plans.extracts import Extracts
from verdejo.plans.warehouse import Warehouse
from verdejo.session import Lazy, together, tune
from verdejo.sources.files import exists

FOLDER = "/root/testdata/sf0.001"


def test_a_table_is_built_once_for_many_threads():
    built = []

    def build(name):
        time.sleep(0.05)
        built.append(name)
        return name

    tables = Lazy({"a": lambda: build("a"), "b": lambda: tables["a"] + build("b")}, lambda name, made: made.upper())
    assert together(tables.__getitem__, ["b", "a", "b", "a"]) == ["AB", "A", "AB", "A"]
    assert sorted(built) == ["a", "b"] and "c" not in tables and tables.all() == {"a": "A", "b": "AB"}


def test_centroids_read_points_and_the_register_alone(spark):
    w = Warehouse(spark, FOLDER)
    assert integration.centroids(w.places["cep_exato"]).count() > 0
    assert set(w.silver.done) == {"geolocalizacao_cep", "municipios"} and set(w.places.done) == {"referencia", "cep_exato"}


def test_an_order_chart_needs_no_items_of_the_star(spark):
    w = Warehouse(spark, FOLDER)
    assert panel.late_by_state(panel.base(w.gold, "1995-06-01", "2000-06-30")).count() > 0
    assert "fato_item_pedido" not in w.gold.done and not set(w.gold.done) & set(gold.KEY_MAPS)
    assert not {"distancias_itens", "distancias_vendedor_cliente"} & set(w.integrated.done)


def test_sorted_tables_are_written_without_extracts_or_star(spark):
    x = Extracts(Warehouse(spark, FOLDER))
    assert {r.linhas_fora_de_ordem for r in x.sorted_outputs().collect()} == {0}
    assert not exists(spark, f"{x.root}/raw") and not x.landings and set(x.w.integrated.done) == set(integration.ORDER)


def test_one_table_lands_alone(spark):
    x = Extracts(Warehouse(spark, FOLDER))
    assert x.rows("vendedores").count() == x._land("vendedores")[0][1]["linhas_saida"] > 0
    assert list(x.landings) == ["vendedores"] and not exists(spark, f"{x.root}/raw/pedidos")


def test_order_totals_send_an_item_once_for_each_grouping(spark):
    rows = [("a", "s1", "p1", 1), ("a", "s1", "p2", 2), ("a", None, "p2", 3), ("b", None, None, 4)]
    items = spark.createDataFrame(rows, "order_id string, seller_id string, product_id string, n int").select(
        "*", *(F.col("n").cast("decimal(18,2)").alias(c) for c in ("preco_produto", "valor_frete", "valor_total_item")))
    orders = spark.createDataFrame([("a",), ("b",), ("c",)], "order_id string")
    for c in ("sk_tempo_compra", "sk_tempo_entrega", "sk_cliente", "sk_geo_cliente", "sk_pagamento", "status_pedido", "valor_total_pago", "dias_ate_entrega",
              "dias_atraso", "flag_atraso", "nota_avaliacao", "flag_possui_avaliacao", "flag_entrega_ausente", "metodo_match_municipio"):
        orders = orders.withColumn(c, F.lit("x"))
    fact = gold.fact_orders(orders, items)
    got = {r.order_id: (r.quantidade_itens, r.quantidade_vendedores, r.quantidade_produtos, int(r.valor_total_pedido)) for r in fact.collect()}
    assert got == {"a": (3, 1, 2, 6), "b": (1, 0, 0, 4), "c": (0, 0, 0, 0)}
    assert "Expand" not in fact._jdf.queryExecution().executedPlan().toString()


def test_the_item_fact_needs_no_totals_of_orders(spark):
    w = Warehouse(spark, FOLDER)
    assert w.gold["fato_item_pedido"].count() == w.silver["itens_pedido"].count() > 0
    assert "fato_pedido" not in w.gold.done and "contexto" not in w.gold


def test_facts_lay_the_items_out_once(spark):
    """By order, whatever the number of sums, counts and joins; the distances follow that layout."""
    n = 1000  # one order of many items beside small ones, some without seller or product
    items = spark.range(2 * n).selectExpr(
        f"if(id < {n}, 'hot', concat('o', id div 3)) as order_id", "cast(id as int) as item_pedido_id", "if(id % 7 = 0, null, concat('p', id % 90)) as product_id",
        "if(id % 5 = 0, null, concat('s', id % 11)) as seller_id", "cast(id as decimal(18,2)) as preco_produto", "cast(1 as decimal(18,2)) as valor_frete",
        "cast(id + 1 as decimal(18,2)) as valor_total_item", "false as flag_frete_outlier", "'alto' as faixa_preco")
    columns = ("sk_tempo_compra", "sk_tempo_entrega", "sk_cliente", "sk_geo_cliente", "sk_pagamento", "status_pedido", "valor_total_pago", "dias_ate_entrega",
               "dias_atraso", "flag_atraso", "nota_avaliacao", "flag_possui_avaliacao", "flag_entrega_ausente", "metodo_match_municipio")
    context = items.select("order_id").distinct().localCheckpoint().select("order_id", *(F.lit("x").alias(c) for c in columns))
    far = items.selectExpr("order_id", "item_pedido_id as order_item_id", "1.5D as distancia_km", "true as flag_distancia_calculada", "'' as motivo_distancia_ausente")
    goods, shops = (F.broadcast(items.select(c, F.lit(1).alias(sk)).distinct()) for c, sk in (("product_id", "sk_produto"), ("seller_id", "sk_vendedor")))
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition")}
    tune(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def layouts(df):
            return [re.findall(r"hashpartitioning\(([^,]*,[^,]*)", line)[0] for line in df._jdf.queryExecution().executedPlan().toString().splitlines()
                    if "hashpartitioning" in line and "Exchange" in line]
        sales = gold.order_sales(items, context)
        assert len(layouts(sales)) == 2, layouts(sales)  # items and orders
        want = items.groupBy("order_id").agg(F.count("*"), F.sum("valor_total_item"), F.countDistinct("seller_id"), F.countDistinct("product_id"))
        got = sales.select("_i", "quantidade_itens", "valor_total_pedido", "quantidade_vendedores", "quantidade_produtos")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        fact = gold.fact_items({"itens_pedido": items, "distancias_itens": far}, {"dim_produto": goods, "dim_vendedor": shops}, context)
        assert len([x for x in layouts(fact) if x.startswith(("order_id", "_o", "_d"))]) == 3, layouts(fact)  # items, orders, distances
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        small = gold.fact_items({"itens_pedido": items, "distancias_itens": far}, {"dim_produto": goods, "dim_vendedor": shops}, context)
        assert [x.split("#")[0] for x in layouts(small) if x.startswith(("order_id", "_o", "_d"))] == ["order_id", "_o"], layouts(small)  # few distances are sent, the layout stays
        assert fact.agg(F.count("*"), F.countDistinct("order_item_id"), F.sum("distancia_km")).first() == (2 * n, 2 * n, 3.0 * n)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
