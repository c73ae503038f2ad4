"""Places of customers and sellers, centroids and distances."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.geo import PROTOTYPE_BOX, Box, haversine_km
from ..functions.text import normal_form, tight_key
from ..operators.integrity import orphans, repeated
from ..operators.matching import RADIUS_KM, match_names, nearest_within, unique_keys
from ..operators.quantiles import group_quantiles
from ..session import Lazy

Tables = dict[str, DataFrame]

# Wording of the reasons that the outputs carry.
NO_COORDINATE = "prefixo de CEP sem coordenada valida"
NO_MATCH = "sem nome correspondente no IBGE e nenhum centroide a ate {radius} km na UF"
ITEM_BOTH = "prefixo de CEP do vendedor e do cliente sem coordenada valida"
ITEM_SELLER = "prefixo de CEP do vendedor sem coordenada valida"
ITEM_CUSTOMER = "prefixo de CEP do cliente sem coordenada valida"

ENTITIES = {"clientes": ("customer_id", "cliente"), "vendedores": ("seller_id", "vendedor")}


def register(municipalities: DataFrame) -> DataFrame:
    """The municipality register with its tight key and whether that key is unique in the state."""
    ref = municipalities.withColumn("chave_sem_espaco", tight_key("municipio"))
    single = unique_keys(ref, "uf", "chave_sem_espaco", "cod_ibge").select(F.col("cod_ibge").alias("_one"))
    return ref.join(single, F.col("cod_ibge") == F.col("_one"), "left").withColumn(
        "chave_unica_na_uf", F.col("_one").isNotNull()).drop("_one")


def coordinates(prefixes: DataFrame) -> DataFrame:
    return prefixes.select(
        "cep_prefixo", F.col("latitude_mediana").alias("latitude"), F.col("longitude_mediana").alias("longitude")
    ).filter("latitude is not null and longitude is not null")


def crosswalk(raw: DataFrame | None, ref: DataFrame, check: bool = True) -> DataFrame:
    """Curated (city, state) -> code. Unknown codes and repeated pairs stop the job."""
    if raw is None:
        return ref.sparkSession.createDataFrame(
            [], "cidade_normalizada string, uf string, cod_ibge string, justificativa string")
    table = raw.filter(S.filled("cod_ibge").isNotNull()).select(
        normal_form("cidade_origem").alias("cidade_normalizada"), F.upper(F.trim("uf_origem")).alias("uf"),
        F.trim("cod_ibge").alias("cod_ibge"), "justificativa")
    if check:
        unknown = orphans(table, "cod_ibge", ref, "cod_ibge").limit(10).collect()
        if unknown:
            raise ValueError(f"de-para aponta para cod_ibge inexistente: {[tuple(r)[:3] for r in unknown]}")
        twice = repeated(table, ["cidade_normalizada", "uf"]).limit(10).collect()
        if twice:
            raise ValueError(f"de-para com (cidade, uf) repetido: {[tuple(r) for r in twice]}")
    return table


def _named(rows: DataFrame, ref: DataFrame) -> DataFrame:
    slim = ref.select("uf", F.col("municipio_normalizado").alias("cidade_normalizada"), "chave_sem_espaco", "cod_ibge")
    return match_names(rows, slim, block="uf", name="cidade_normalizada", key="chave_sem_espaco",
                       code="cod_ibge", out_name="cod_exato", out_key="cod_chave")


def exact_prefixes(prefixes: DataFrame, ref: DataFrame) -> DataFrame:
    rows = prefixes.filter("cidade_predominante is not null and latitude_mediana is not null").select(
        "cep_prefixo", normal_form("cidade_predominante").alias("cidade_normalizada"),
        tight_key("cidade_predominante").alias("chave_sem_espaco"), F.col("uf_predominante").alias("uf"),
        F.col("latitude_mediana").alias("latitude"), F.col("longitude_mediana").alias("longitude"))
    return _named(rows, ref).select(
        "cep_prefixo", "uf", "latitude", "longitude", F.coalesce("cod_exato", "cod_chave").alias("cod_ibge")
    ).filter("cod_ibge is not null")


def centroids(exact: DataFrame) -> DataFrame:
    return group_quantiles(exact, ["cod_ibge", "uf"], {
        "latitude_representativa": ("latitude", 0.5), "longitude_representativa": ("longitude", 0.5)},
        also={"qtd_prefixos": F.count(F.lit(1))})


def resolve(entities: DataFrame, key: str, ref: DataFrame, curated: DataFrame, coords: DataFrame,
            centers: DataFrame, radius_km: float = RADIUS_KM) -> DataFrame:
    """Entity -> municipality: equal name, unique tight key, curated pair, nearest centroid, unresolved."""
    base = entities.select(
        F.col(key).alias("id_entidade"), "cep_prefixo", F.col("cidade").alias("cidade_original"),
        normal_form("cidade").alias("cidade_normalizada"), tight_key("cidade").alias("chave_sem_espaco"), "uf")
    pair = curated.select(F.col("uf").alias("_cu"), F.col("cidade_normalizada").alias("_cc"),
                          F.col("cod_ibge").alias("_curated"))
    named = _named(base, ref)
    # A row that an earlier pass has settled fails the condition of the later ones; the chain stays one line of joins.
    open_ = F.col("cod_exato").isNull() & F.col("cod_chave").isNull()
    known = named.join(pair, (F.col("uf") == F.col("_cu")) & (F.col("cidade_normalizada") == F.col("_cc")) & open_, "left").drop("_cu", "_cc")
    known = known.withColumn("_settled", F.coalesce("cod_exato", "cod_chave", "_curated"))

    spots = coords.select(F.col("cep_prefixo").alias("_p"), "latitude", "longitude")
    pending = known.filter("_settled is null").select("cep_prefixo", "uf").distinct()
    probes = pending.join(spots, F.col("cep_prefixo") == F.col("_p")).drop("_p")
    targets = centers.select("uf", F.col("cod_ibge").alias("_near"), F.col("latitude_representativa").alias("latitude"),
                             F.col("longitude_representativa").alias("longitude"))
    near = nearest_within(probes, targets, block="uf", code="_near", radius_km=radius_km).select(
        F.col("cep_prefixo").alias("_np"), F.col("uf").alias("_nu"), "_near", "distancia_km")

    spotted = known.join(spots, F.col("cep_prefixo") == F.col("_p"), "left").drop("_p")
    placed = spotted.join(near, (F.col("cep_prefixo") == F.col("_np")) & (F.col("uf") == F.col("_nu")) & F.col("_settled").isNull(), "left").drop("_np", "_nu")
    code = F.coalesce("_settled", "_near")
    return placed.select(
        "id_entidade", "cep_prefixo", "cidade_original", "cidade_normalizada", "uf", code.alias("cod_ibge"),
        F.when(F.coalesce("cod_exato", "cod_chave").isNotNull(), "exato")
        .when(F.col("_curated").isNotNull(), "de_para")
        .when(F.col("_near").isNotNull(), "geografico").otherwise("nao_resolvido").alias("metodo_match"),
        F.col("distancia_km").cast("decimal(10,2)").alias("distancia_match_km"), "latitude", "longitude",
        F.when(code.isNull(), F.when(F.col("latitude").isNull(), NO_COORDINATE)
               .otherwise(NO_MATCH.format(radius=radius_km))).alias("motivo_nao_resolvido"))


def audit_map(resolved: DataFrame, key: str) -> DataFrame:
    return resolved.select(F.col("id_entidade").alias(key), "cod_ibge", "metodo_match", "distancia_match_km")


def contract_map(resolved: DataFrame, key: str, suffix: str) -> DataFrame:
    return resolved.select(
        F.col("id_entidade").alias(key), "cod_ibge",
        F.when(F.col("metodo_match") == "de_para", "manual").otherwise(F.col("metodo_match")).alias("metodo_match"),
        F.col("distancia_match_km").cast("double").alias("distancia_match_km"),
        F.col("latitude").alias(f"latitude_{suffix}"), F.col("longitude").alias(f"longitude_{suffix}"),
        "cidade_original", "cidade_normalizada", "uf", "motivo_nao_resolvido")


def geography(ref: DataFrame, centers: DataFrame) -> DataFrame:
    points = centers.select(F.col("cod_ibge").alias("_c"), "latitude_representativa", "longitude_representativa")
    return ref.join(points, F.col("cod_ibge") == F.col("_c"), "left").select(
        "cod_ibge", "municipio", "municipio_normalizado", "uf", "nome_uf", "regiao",
        F.col("populacao").alias("populacao_estimada"), "pib_per_capita", "ano_referencia_indicadores",
        "porte_municipio", "latitude_representativa", "longitude_representativa")


def _place(resolved: DataFrame, centers: DataFrame, prefix: str) -> DataFrame:
    points = centers.select(F.col("cod_ibge").alias("_c"), F.col("latitude_representativa").alias(f"{prefix}_lat"),
                            F.col("longitude_representativa").alias(f"{prefix}_lng"))
    return resolved.join(points, F.col("cod_ibge") == F.col("_c"), "left").select(
        F.col("id_entidade").alias(f"{prefix}_id"), F.col("metodo_match").alias(f"{prefix}_how"),
        f"{prefix}_lat", f"{prefix}_lng")


def pair_distances(items: DataFrame, orders: DataFrame, sellers: DataFrame, customers: DataFrame,
                   centers: DataFrame) -> DataFrame:
    """Distance between municipal centroids, one row per seller and customer that traded."""
    buyers = orders.select(F.col("order_id").alias("_o"), "customer_id")
    pairs = items.join(buyers, F.col("order_id") == F.col("_o")).select("seller_id", "customer_id").distinct()
    both = (pairs.join(_place(sellers, centers, "v"), F.col("seller_id") == F.col("v_id"), "left")
            .join(_place(customers, centers, "c"), F.col("customer_id") == F.col("c_id"), "left"))
    return both.select(
        "seller_id", "customer_id",
        haversine_km(F.col("v_lat"), F.col("v_lng"), F.col("c_lat"), F.col("c_lng")).cast("decimal(10,2)").alias("distancia_km"),
        ((F.col("v_how") != "exato") | (F.col("c_how") != "exato")).alias("flag_distancia_estimada"))


def _spot(resolved: DataFrame, prefix: str) -> DataFrame:
    # The resolved rows already carry the coordinates of their own postal prefix.
    return resolved.select(F.col("id_entidade").alias(f"{prefix}_id"), F.col("latitude").alias(f"{prefix}_lat"),
                           F.col("longitude").alias(f"{prefix}_lng"))


def item_distances(items: DataFrame, orders: DataFrame, sellers: DataFrame, customers: DataFrame) -> DataFrame:
    """Distance between the median points of the two postal prefixes, one row per item."""
    buyers = orders.select(F.col("order_id").alias("_o"), "customer_id").join(
        _spot(customers, "c"), F.col("customer_id") == F.col("c_id"), "left").drop("customer_id", "c_id")
    both = (items.select("order_id", F.col("item_pedido_id").alias("order_item_id"), "seller_id")
            .join(buyers, F.col("order_id") == F.col("_o"))
            .join(_spot(sellers, "v"), F.col("seller_id") == F.col("v_id"), "left"))
    no_v, no_c = F.col("v_lat").isNull(), F.col("c_lat").isNull()
    return both.select(
        "order_id", "order_item_id",
        haversine_km(F.col("v_lat"), F.col("v_lng"), F.col("c_lat"), F.col("c_lng")).alias("distancia_km"),
        (~no_v & ~no_c).alias("flag_distancia_calculada"),
        F.when(no_v & no_c, ITEM_BOTH).when(no_v, ITEM_SELLER).when(no_c, ITEM_CUSTOMER)
        .alias("motivo_distancia_ausente"))


def coverage(resolved: DataFrame, entity: str) -> DataFrame:
    """One row: counts per method and the matched share."""
    how = F.col("metodo_match")
    return resolved.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(how == "exato").alias("exato"),
        F.count_if(how == "geografico").alias("geografico"), F.count_if(how == "de_para").alias("manual"),
        F.count_if(how == "nao_resolvido").alias("nao_resolvido"),
    ).select(F.lit(entity).alias("entidade"), "*", F.when(F.col("total") > 0, F.round(
        (F.col("total") - F.col("nao_resolvido")) / F.col("total"), 6)).otherwise(F.lit(0.0)).alias("taxa_match"))


def unresolved(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    def side(df: DataFrame, entity: str) -> DataFrame:
        return df.filter("cod_ibge is null").groupBy("cidade_original", "cidade_normalizada", "uf").agg(
            F.count(F.lit(1)).alias("qtd_entidades"), F.min("motivo_nao_resolvido").alias("motivo")
        ).select(F.lit(entity).alias("entidade"), "*")

    return side(customers, "cliente").unionByName(side(sellers, "vendedor"))


def unresolved_by_city(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    return unresolved(customers, sellers).groupBy("entidade", "cidade_original", "uf").agg(
        F.sum("qtd_entidades").alias("qtd"))


def crosswalk_use(curated: DataFrame, ref: DataFrame, customers: DataFrame, sellers: DataFrame) -> DataFrame:
    def used(df: DataFrame, out: str) -> DataFrame:
        return df.filter("metodo_match = 'de_para'").groupBy("cidade_normalizada", "uf").agg(F.count(F.lit(1)).alias(out))

    names = ref.select("cod_ibge", "municipio")
    on = ["cidade_normalizada", "uf"]
    return (curated.join(names, "cod_ibge").join(used(customers, "clientes"), on, "left")
            .join(used(sellers, "vendedores"), on, "left")
            .select(*on, "cod_ibge", "municipio", "justificativa",
                    F.coalesce("clientes", F.lit(0)).alias("clientes"),
                    F.coalesce("vendedores", F.lit(0)).alias("vendedores")))


def city_prototype(raw_points: DataFrame, ref: DataFrame, box: Box = PROTOTYPE_BOX) -> DataFrame:
    """City-level medians and point counts, matched by name and then by tight key."""
    lat, lng = S.typed("geolocation_lat", "double"), S.typed("geolocation_lng", "double")
    points = raw_points.select(
        lat.alias("latitude"), lng.alias("longitude"), normal_form("geolocation_city").alias("cidade_normalizada"),
        F.col("geolocation_state").alias("uf")).filter(box.inside(F.col("latitude"), F.col("longitude")))
    cities = group_quantiles(points, ["uf", "cidade_normalizada"], {
        "lat_representativa": ("latitude", 0.5), "lng_representativa": ("longitude", 0.5)},
        also={"qte_pontos": F.count(F.lit(1))})
    cities = cities.withColumn("chave_sem_espaco", F.replace("cidade_normalizada", F.lit(" "), F.lit("")))
    matched = _named(cities, ref)
    return matched.select(
        F.col("uf").alias("estado"), F.col("cidade_normalizada").alias("cidade_norm"),
        "lat_representativa", "lng_representativa", "qte_pontos",
        F.lpad(F.coalesce("cod_exato", "cod_chave"), 7, "0").alias("cod_ibge"),
        F.when(F.col("cod_exato").isNotNull(), "nome_identico")
        .when(F.col("cod_chave").isNotNull(), "sem_espacos").alias("variante_match"),
        F.when(F.coalesce("cod_exato", "cod_chave").isNotNull(), "exato").alias("metodo_match"))


def city_coverage(prototype: DataFrame) -> DataFrame:
    hit = F.col("cod_ibge").isNotNull()
    return prototype.agg(
        F.count(F.lit(1)).alias("cidades"),
        F.count_if(F.col("variante_match") == "nome_identico").alias("nome_identico"),
        F.count_if(F.col("variante_match") == "sem_espacos").alias("sem_espacos"),
        F.count_if(~hit).alias("sem_codigo"),
        F.round(S.percent(F.count_if(hit), F.count(F.lit(1))), 6).alias("pct_cidades"),
        F.round(S.percent(F.sum(F.when(hit, F.col("qte_pontos"))), F.sum("qte_pontos")), 6).alias("pct_pontos"))


def places(silver: Mapping[str, DataFrame], raw_crosswalk: Callable[[], DataFrame | None], ws=None) -> Lazy:
    """Reference tables and both entity maps, each when it is asked for. With a workspace each is written once for all later uses."""
    out = Lazy({
        "referencia": lambda: register(silver["municipios"]), "coordenadas": lambda: coordinates(silver["geolocalizacao_cep"]),
        "cep_exato": lambda: exact_prefixes(silver["geolocalizacao_cep"], out["referencia"]),
        "centroides": lambda: centroids(out["cep_exato"]), "de_para": lambda: crosswalk(raw_crosswalk(), out["referencia"]),
        **{f"mapa_{entity}": lambda entity=entity, key=key: resolve(
            silver[entity], key, out["referencia"], out["de_para"], out["coordenadas"], out["centroides"])
           for entity, (key, _) in ENTITIES.items()},
    }, ws and ws.keep)
    return out


def resolve_both(silver: Tables, raw_crosswalk: DataFrame | None, ws=None) -> Tables:
    return places(silver, lambda: raw_crosswalk, ws).all()


#: Tables that are written in a total order.
ORDER = {
    **{f"municipios_{suffix}": (key,) for key, suffix in ENTITIES.values()},
    "distancias_vendedor_cliente": ("seller_id", "customer_id"), "distancias_itens": ("order_id", "order_item_id"),
}


def output_builders(silver: Mapping[str, DataFrame], base: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    out = {"geografia_integrada": lambda: geography(base["referencia"], base["centroides"])}
    for entity, (key, suffix) in ENTITIES.items():
        out[f"municipios_{suffix}"] = lambda e=entity, k=key: audit_map(base[f"mapa_{e}"], k)
        out[f"{entity}_municipios"] = lambda e=entity, k=key, s=suffix: contract_map(base[f"mapa_{e}"], k, s)
    out["distancias_vendedor_cliente"] = lambda: pair_distances(
        silver["itens_pedido"], silver["pedidos"], base["mapa_vendedores"], base["mapa_clientes"], base["centroides"])
    out["distancias_itens"] = lambda: item_distances(
        silver["itens_pedido"], silver["pedidos"], base["mapa_vendedores"], base["mapa_clientes"])
    return out


def outputs(silver: Tables, base: Tables) -> Tables:
    return {name: build() for name, build in output_builders(silver, base).items()}


def build(silver: Tables, raw_crosswalk: DataFrame | None, ws=None) -> Tables:
    return outputs(silver, resolve_both(silver, raw_crosswalk, ws))
