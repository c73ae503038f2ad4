"""Named queries over a folder of source tables: (session, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normal_form, tight_key
from ..operators import checks as C
from ..operators.quantiles import money_fence
from ..operators.signature import key_changes, merged, signature
from ..sources import indicators, landing
from . import gold, gold_quality, growth, integration, kpis, panel, quality, silver, testbed
from .extracts import Extracts, open_extracts
from .warehouse import open_warehouse

Query = Callable[[SparkSession, str], DataFrame]

WHEN = datetime(2026, 1, 2, 3, 4, 5)
TAG = "loja"
LANDED = ("orders", "lineitem", "customer", "supplier", "part", "events")
PERIOD = ("1995-06-01", "2000-06-30")
STATE = "R1"
EARLY = date(1995, 1, 1)  # an earlier load has seen the orders bought before


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles at six places, so that two engines with different math libraries agree."""
    return df.select(*[F.round(F.col(f.name), places).alias(f.name) if f.dataType == T.DoubleType() else F.col(f.name)
                       for f in df.schema])


def _short(df: DataFrame) -> DataFrame:
    return df.select("id", "esperado", "encontrado", "status")


def _landed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {t: landing.land_parquet(spark, f"{folder}/{t}.parquet", TAG, WHEN) for t in LANDED}


def _silver(build: Callable[[dict], DataFrame]) -> Query:
    return lambda spark, folder: rounded(build(testbed.raw_tables(spark, folder)))


def _places(build: Callable) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        w = open_warehouse(spark, folder)
        return rounded(build(w))
    return query


def _panel(build: Callable, state: str = panel.ALL) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        g = open_warehouse(spark, folder).gold
        return build(panel.base(g, *PERIOD, state), g)
    return query


def _kpi(code: str, by: tuple[str, ...] = ()) -> Query:
    return lambda spark, folder: kpis.measure(open_warehouse(spark, folder).gold, code, by)


def _star(build: Callable) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        w = open_warehouse(spark, folder)
        return rounded(build(w.contract, w.ws))
    return query


def _fence(spark: SparkSession, folder: str) -> DataFrame:
    freight = testbed.order_items(spark, folder).select(F.col("freight_value").cast("decimal(18,2)").alias("valor_frete"))
    quartiles, _ = money_fence(freight, "valor_frete")
    return quartiles


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return testbed.source(spark, folder, "documents").select(
        "doc_id", normal_form("text").alias("normal"), F.md5(tight_key("text")).alias("chave_md5"))


def _responses(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two statistical responses of all customers with a label record, absence markers and codes that only one side has."""
    n = testbed.source(spark, folder, "customer")

    def rows(alone: str, apart: int, value: str, label: str) -> DataFrame:
        data = n.selectExpr(f"cast(if({alone}, {apart}, 0) + 1100000 + c_custkey as string) as D1C", "'2017' as D3C", f"{value} as V")
        return data.unionByName(spark.range(1).selectExpr(f"'{indicators.LABEL}' as D1C", "'Ano' as D3C", f"'{label}' as V"))

    people = rows("c_mktsegment = 'MACHINERY'", 10**9, "case c_custkey % 10 when 0 then '...' when 1 then ' - ' when 2 then '0' "
                  "else cast(c_custkey * 37 as string) end", "Pessoas")
    wealth = rows("c_acctbal < 0", 2 * 10**9, "case c_custkey % 9 when 0 then 'X' when 1 then '' "
                  "else cast(c_custkey * 911 + 5 as string) end", "Mil Reais")
    return people, wealth


def _consolidated(spark: SparkSession, folder: str) -> DataFrame:
    people, wealth = _responses(spark, folder)
    return indicators.consolidate(indicators.values(people), indicators.values(wealth))


def _source_signatures(spark: SparkSession, folder: str) -> DataFrame:
    raw = testbed.raw_tables(spark, folder)
    return C.union([signature(df, t).drop("esquema") for t, df in raw.items()])


def _part_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """Signatures of the sources, added up from those of two parts that split each table by its rows' text."""
    raw = testbed.raw_tables(spark, folder)
    halves = []
    for t, df in raw.items():
        side = F.pmod(F.xxhash64(*df.columns), F.lit(2))
        halves += [signature(df.filter(side == i), t) for i in range(2)]
    return merged(*halves).drop("esquema")


def _order_slice(spark: SparkSession, folder: str) -> DataFrame:
    """Delivered value by month straight from landed text: typed cleaning, strict totals, grouping."""
    raw = testbed.raw_tables(spark, folder)
    totals = gold.order_totals(silver.typed_items(raw))
    orders = silver.orders(raw).filter(F.col("status_pedido") == silver.DELIVERED)
    joined = orders.join(totals, F.col("order_id") == F.col("_i"), "left")
    total = F.when(F.col("_i").isNull(), F.lit(0).cast("decimal(18,2)")).otherwise(F.col("valor_total_pedido"))
    return (joined.groupBy(F.col("ano_mes_compra").alias("nome"))
            .agg(F.sum(total).cast("decimal(18,2)").alias("valor"), F.count(F.lit(1)).alias("base")).orderBy("nome"))


def _key_stability(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of a fresh load against the loaded dimensions: nothing may move."""
    w = open_warehouse(spark, folder)
    parts = []
    for dim, build, natural in (("dim_cliente", gold.dim_customer, "customer_unique_id"), ("dim_produto", gold.dim_product, "product_id"),
                                ("dim_vendedor", gold.dim_seller, "seller_id"), ("dim_geografia", gold.dim_geography, "cod_ibge")):
        moved = key_changes(w.gold[dim], build(w.contract, w.ws), natural, gold.KEYS[dim][0])
        parts.append(moved.agg(F.count(F.lit(1)).alias("alteradas")).select(F.lit(dim).alias("dimensao"), "alteradas"))
    return C.union(parts)


def _verdict(spark: SparkSession, folder: str) -> DataFrame:
    w = open_warehouse(spark, folder)
    return C.outcome(C.union([quality.cleaned(w.raw, w.silver), quality.integrated(w.raw["de_para"], w.contract)]))


def _on(fn: Callable, *layers: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        w = open_warehouse(spark, folder)
        return rounded(fn(*[getattr(w, layer) for layer in layers]))
    return query


def _checks(fn: Callable, *layers: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        w = open_warehouse(spark, folder)
        return _short(fn(*[getattr(w, layer) for layer in layers]))
    return query


def _files(fn: Callable[[Extracts], DataFrame]) -> Query:
    return lambda spark, folder: fn(open_extracts(spark, folder))


QUERIES: dict[str, Query] = {
    # landing
    **{f"landed_{t}": (lambda spark, folder, t=t: landing.land_parquet(spark, f"{folder}/{t}.parquet", TAG, WHEN))
       for t in ("orders", "events", "part")},
    "landed_shape_checks": lambda spark, folder: _short(quality.landed_shape(spark, _landed(spark, folder))),
    "landed_content_checks": lambda spark, folder: _short(quality.landed_content(_landed(spark, folder), [TAG])),
    "indicator_consolidation": _consolidated,
    "source_signatures": _source_signatures, "merged_signatures": _part_signatures,
    "landed_csv_orders": _files(lambda x: x.rows("pedidos")), "landed_csv_reviews": _files(lambda x: x.rows("avaliacoes")),
    "landed_csv_items": _files(lambda x: x.rows("itens_pedido")), "landed_csv_counts": _files(Extracts.landed_again),
    "landed_csv_numbers": _files(Extracts.numbers), "landed_csv_manifest": _files(Extracts.manifest),
    "landed_json_register": _files(Extracts.register), "landed_crosswalk": _files(Extracts.crosswalk_rows),
    "source_checks": _files(lambda x: _short(x.source_checks())),
    # sinks
    "published_counts": _files(Extracts.published_counts), "published_report": _files(Extracts.published_report),
    "sorted_outputs": _files(Extracts.sorted_outputs), "csv_sink": _files(Extracts.csv_sink),
    # cleaning
    "clean_orders": _silver(silver.orders), "clean_items": _silver(silver.order_items),
    "clean_payments": _silver(silver.payments), "clean_reviews": _silver(silver.reviews),
    "clean_products": _silver(silver.products), "clean_customers": _silver(silver.customers),
    "clean_sellers": _silver(silver.sellers), "geo_points": _silver(silver.geo_points),
    "geo_prefixes": _silver(lambda raw: silver.geo_prefixes(silver.geo_points(raw))),
    "municipalities": _silver(silver.municipalities),
    "freight_fence": _fence, "text_keys": _texts, "delivered_value_by_month": _order_slice,
    # places and distances
    "match_reference": _places(lambda w: integration.register(w.silver["municipios"])),
    "prefix_coordinates": _places(lambda w: integration.coordinates(w.silver["geolocalizacao_cep"])),
    "crosswalk": _places(lambda w: integration.crosswalk(w.raw["de_para"], w.places["referencia"])),
    "exact_prefixes": _places(lambda w: integration.exact_prefixes(w.silver["geolocalizacao_cep"], w.places["referencia"])),
    "centroids": _places(lambda w: integration.centroids(w.places["cep_exato"])),
    **{name: _places(lambda w, e=e: integration.resolve(
        w.silver[e], integration.ENTITIES[e][0], w.places["referencia"], w.places["de_para"], w.places["coordenadas"],
        w.places["centroides"])) for name, e in (("customer_places", "clientes"), ("seller_places", "vendedores"))},
    "customer_audit_map": _places(lambda w: integration.audit_map(w.places["mapa_clientes"], "customer_id")),
    "customer_contract_map": _places(lambda w: integration.contract_map(w.places["mapa_clientes"], "customer_id", "cliente")),
    "seller_contract_map": _places(lambda w: integration.contract_map(w.places["mapa_vendedores"], "seller_id", "vendedor")),
    "geography": _places(lambda w: integration.geography(w.places["referencia"], w.places["centroides"])),
    "pair_distances": _places(lambda w: integration.pair_distances(
        w.silver["itens_pedido"], w.silver["pedidos"], w.places["mapa_vendedores"], w.places["mapa_clientes"], w.places["centroides"])),
    "item_distances": _places(lambda w: integration.item_distances(
        w.silver["itens_pedido"], w.silver["pedidos"], w.places["mapa_vendedores"], w.places["mapa_clientes"])),
    "match_coverage": _places(lambda w: C.union([integration.coverage(w.places[f"mapa_{e}"], e) for e in integration.ENTITIES])),
    "unresolved_places": _places(lambda w: integration.unresolved(w.places["mapa_clientes"], w.places["mapa_vendedores"])),
    "unresolved_by_city": _places(lambda w: integration.unresolved_by_city(w.places["mapa_clientes"], w.places["mapa_vendedores"])),
    "crosswalk_use": _places(lambda w: integration.crosswalk_use(
        w.places["de_para"], w.places["referencia"], w.places["mapa_clientes"], w.places["mapa_vendedores"])),
    "city_prototype": _places(lambda w: integration.city_prototype(w.raw["geolocalizacao"], w.places["referencia"])),
    "city_coverage": _places(lambda w: integration.city_coverage(
        integration.city_prototype(w.raw["geolocalizacao"], w.places["referencia"]))),
    "missing_distance_reasons": _on(quality.missing_reasons, "contract"),
    # star
    "dim_calendar": _star(lambda s, ws: gold.calendar(s["pedidos"])), "dim_customer": _star(gold.dim_customer),
    "dim_product": _star(gold.dim_product), "dim_geography": _star(gold.dim_geography),
    "dim_seller": _star(gold.dim_seller), "dim_payment": _star(gold.dim_payment),
    "order_context": _places(lambda w: gold.order_context(w.contract, w.gold)),
    "fact_orders": _places(lambda w: gold.fact_orders(
        gold.order_context(w.contract, w.gold), w.contract["itens_pedido"], w.contract["pedidos"])),
    "fact_items": _places(lambda w: gold.fact_items(w.contract, w.gold, w.gold["fato_pedido"])),
    # checks
    "silver_key_checks": _checks(lambda s: quality.keys("SLV-PK", quality.SILVER_GRAIN, s), "silver"),
    "silver_reference_checks": _checks(quality.references, "silver"),
    "silver_grain_checks": _checks(quality.kept_grain, "raw", "silver"),
    "silver_money_checks": _checks(quality.reconciliation, "raw", "silver"),
    "order_rule_checks": _checks(quality.order_rules, "silver"), "domain_checks": _checks(quality.domains, "silver"),
    "imputation_checks": _checks(quality.imputation, "silver"),
    "geolocation_checks": _checks(quality.geolocation, "raw", "silver"),
    "integration_key_checks": _checks(lambda s: quality.keys("INT-PK", quality.INTEGRATION_GRAIN, s), "contract"),
    "match_checks": _checks(quality.matches, "contract"),
    "crosswalk_checks": _places(lambda w: _short(quality.crosswalk_evidence(w.raw["de_para"], w.contract))),
    "distance_checks": _checks(quality.distances, "contract"),
    "indicator_checks": _checks(quality.indicator_gaps, "contract"),
    "indicator_examples": _on(quality.indicator_examples, "silver"),
    "acceptance_checks": _places(lambda w: _short(quality.acceptance(w.places, w.contract["distancias_itens"]))),
    "contract_checks": lambda spark, folder: _short(quality.contract(spark, open_warehouse(spark, folder).contract)),
    "star_input_problems": _on(gold.reference_problems, "contract"),
    "layer_verdict": _verdict,
    "star_structure_checks": _checks(gold_quality.structure, "gold", "contract"),
    "star_reference_checks": _checks(gold_quality.foreign_keys, "gold"),
    "star_rule_checks": _checks(gold_quality.rules, "gold"),
    "star_reconciliation_checks": _checks(gold_quality.reconciliation, "gold", "contract"),
    "star_preservation_checks": _checks(gold_quality.preservation, "gold", "contract"),
    "star_unknown_use": _on(gold_quality.unknown_use, "gold"), "star_counts": _on(gold_quality.counts, "gold"),
    "star_match_coverage": _on(gold_quality.match_coverage, "contract"),
    "star_signatures": _on(gold_quality.signatures, "gold"),
    "key_stability": _key_stability,
    "key_growth": _star(lambda s, ws: growth.growth(s, ws, EARLY)),
    **{f"grown_keys_{name}": _star(lambda s, ws, d=d: growth.grown_keys(s, ws, EARLY, d)) for name, d in (
        ("customer", "dim_cliente"), ("product", "dim_produto"), ("payment", "dim_pagamento"))},
    # profiles
    "distance_profile": _on(gold_quality.distance_profile, "gold"),
    "freight_profile": _on(lambda s: gold_quality.freight_profile(s["itens_pedido"]), "silver"),
    "product_profile": _on(gold_quality.product_profile, "gold"), "unreviewed_orders": _on(gold_quality.unreviewed, "gold"),
    "mixed_scores": _on(gold_quality.mixed_scores, "gold"), "lost_ids": _on(gold_quality.lost_ids, "gold", "contract"),
    "payment_checks": _checks(gold_quality.payment_controls, "gold", "contract"),
    "places_without_indicators": _on(gold_quality.places_without_indicators, "gold", "contract"),
    # panel
    "panel_options": _on(panel.options, "gold"),
    "panel_summary": _panel(lambda o, g: panel.summary(o)),
    "panel_summary_state": _panel(lambda o, g: panel.summary(o), STATE),
    "panel_distance": _panel(panel.distance),
    **{f"panel_{name}": _panel(chart) for name, chart in panel.CHARTS.items()},
    "panel_categorias_uf": _panel(panel.top_categories, STATE),
    "panel_export": lambda spark, folder: panel.export(open_warehouse(spark, folder).gold, *PERIOD),
    # KPI catalogue
    **{f"kpi_{code.lower().replace('-', '_')}": _kpi(code) for code in kpis.KPIS},
    "kpi_cli_002": _on(kpis.repurchase, "gold"),
    "kpi_geo_001": _on(lambda s: kpis.match_rate(s["clientes_municipios"]), "contract"),
    "kpi_geo_002": _kpi("VEN-002", ("porte_municipio",)), "kpi_geo_003": _kpi("VEN-007", ("porte_municipio",)),
    "analysis_lateness_score": _on(kpis.score_by_lateness, "gold"), "analysis_distance": _on(kpis.by_distance, "gold"),
    "analysis_gdp": _on(kpis.by_gdp, "gold"), "analysis_categories": _on(kpis.categories, "gold"),
    "analysis_sellers": _on(kpis.seller_metrics, "gold"),
    "split_value_quarter": _kpi("VEN-002", ("ano", "trimestre")), "split_value_price_band": _kpi("VEN-001", ("faixa_preco",)),
    "split_freight_seller_region": _kpi("FRE-001", ("vendedor_regiao",)),
    "split_days_weekday": _kpi("LOG-001", ("nome_dia_semana",)), "split_late_payment": _kpi("LOG-002", ("tipo_pagamento", "faixa_parcelas")),
    "split_items_weight": _kpi("VEN-006", ("faixa_peso",)), "split_score_region": _kpi("SAT-001", ("regiao",)),
    "split_orders_category": _kpi("VEN-005", ("categoria_pt",)), "split_ticket_price_band_quarter": _kpi("VEN-007", ("faixa_preco", "trimestre")),
    "split_late_seller_region_category": _kpi("LOG-002", ("vendedor_regiao", "categoria_pt")),
    "split_buyers_seller_total": _on(lambda g: kpis.with_total(g, "CLI-001", ("vendedor_uf",)), "gold"),
}
