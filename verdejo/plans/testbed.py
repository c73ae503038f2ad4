"""Retail-shaped landed text tables, derived from the TPC-H-like tables of a folder.

Every table is a row-wise expression over one or two given tables, so it grows
with them. Values are text, as landing delivers them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STAMP = "'yyyy-MM-dd HH:mm:ss'"
ITEM_BUCKETS = 4096


def source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _later(day: str, days: str, hours: str = "0") -> str:
    return f"{day} + make_dt_interval(cast({days} as int), cast({hours} as int))"


def _stamp(expr: str) -> str:
    return f"date_format({expr}, {STAMP})"


def orders(spark: SparkSession, folder: str) -> DataFrame:
    k, d = "o_orderkey", "o_orderdate"
    return source(spark, folder, "orders").selectExpr(
        f"cast({k} as string) as order_id", "cast(o_custkey as string) as customer_id",
        "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'canceled' end as order_status",
        f"{_stamp(_later(d, '0', f'{k} % 24'))} as order_purchase_timestamp",
        f"case when {k} % 53 = 0 then '' else {_stamp(_later(d, '1', f'{k} % 24'))} end as order_approved_at",
        f"case when {k} % 59 = 0 then ' ' else {_stamp(_later(d, f'{k} % 5', '3'))} end as order_delivered_carrier_date",
        f"case when {k} % 97 = 0 then '' else {_stamp(_later(d, f'{k} % 40', f'({k} * 7) % 24'))} end"
        " as order_delivered_customer_date",
        f"{_stamp(_later(d, '20'))} as order_estimated_delivery_date")


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Item numbers are unique within an order and need no sort of a whole order."""
    rows = source(spark, folder, "lineitem").withColumn(
        "_bucket", F.expr(f"(l_partkey * 31 + l_suppkey * 7 + l_linenumber) % {ITEM_BUCKETS}"))
    place = Window.partitionBy("l_orderkey", "_bucket").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    price = "cast(cast(cast(round(l_extendedprice * 100) as bigint) % 30000 as decimal(18,2)) * 0.01 as decimal(18,2))"
    return rows.withColumn("_rank", F.row_number().over(place)).selectExpr(
        "cast(l_orderkey as string) as order_id",
        f"cast((_rank - 1) * {ITEM_BUCKETS} + _bucket + 1 as string) as order_item_id",
        "cast(l_partkey as string) as product_id", "cast(l_suppkey as string) as seller_id",
        f"{_stamp('l_shipdate')} as shipping_limit_date",
        f"case when l_partkey % 211 = 0 then '' else cast({price} as string) end as price",
        "cast(cast(l_quantity * case when l_orderkey % 50 = 0 then 10 else 1 end as decimal(18,2)) as string)"
        " as freight_value")


def payments(spark: SparkSession, folder: str) -> DataFrame:
    return source(spark, folder, "lineitem").selectExpr(
        "cast(l_orderkey as string) as order_id", "cast(l_linenumber as string) as payment_sequential",
        "case l_returnflag when 'A' then 'boleto' when 'N' then 'credit_card' else 'voucher' end as payment_type",
        "cast(l_linenumber * 2 - 1 as string) as payment_installments",
        "cast(cast(l_quantity as decimal(18,2)) as string) as payment_value")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    return source(spark, folder, "events").selectExpr(
        "cast(event_id as string) as review_id", "cast((event_id * 2) div 5 as string) as order_id",
        "cast(1 + event_id % 5 as string) as review_score",
        "case when event_id % 3 = 0 then event_type else '' end as review_comment_title",
        "case when event_id % 4 = 0 then concat(' ', event_type, ' ') else ' ' end as review_comment_message",
        f"{_stamp('cast(to_date(ts) as timestamp_ntz)')} as review_creation_date",
        f"{_stamp('ts')} as review_answer_timestamp")


def products(spark: SparkSession, folder: str) -> DataFrame:
    k = "p_partkey"

    def size(expr: str, gap: int) -> str:
        return f"case when {k} % {gap} = 0 then '' else cast({expr} as string) end"

    return source(spark, folder, "part").selectExpr(
        f"cast({k} as string) as product_id",
        f"case when {k} % 50 = 0 then '' when {k} % 500 = 1 then 'rara' else lower(p_type) end as product_category_name",
        f"{size('p_size * 700', 11)} as product_weight_g", f"{size('p_size + 10', 13)} as product_length_cm",
        f"{size('p_size + 5', 17)} as product_height_cm", f"{size('p_size + 7', 19)} as product_width_cm")


def translations(spark: SparkSession, folder: str) -> DataFrame:
    """One kind of part goes by another name here, so its products find no translation."""
    return source(spark, folder, "part").select("p_type").distinct().selectExpr(
        "lower(if(p_type = 'PROMO', concat('outro ', p_type), p_type)) as product_category_name", "p_type as product_category_name_english")


def _nations(spark: SparkSession, folder: str) -> DataFrame:
    n = source(spark, folder, "nation")
    r = source(spark, folder, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey)


def _city(key: str) -> str:
    return (f"case {key} % 6 when 0 then upper(concat('são ', n_name)) when 1 then concat('São ', n_name) "
            f"when 2 then concat('sao', replace(lower(n_name), '_', '')) when 3 then concat(' SAO-', n_name) "
            f"when 4 then concat('são ', lower(n_name)) else concat('vila ', cast({key} % 9 as string)) end")


def _state(key: str) -> str:
    return f"case when {key} % 6 = 4 then 'XX' else concat('R', cast(n_regionkey as string)) end"


def customers(spark: SparkSession, folder: str) -> DataFrame:
    c = source(spark, folder, "customer")
    n = source(spark, folder, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).selectExpr(
        "cast(c_custkey as string) as customer_id", "concat('u', cast(c_custkey * 2 div 3 as string)) as customer_unique_id",
        "lpad(cast(c_custkey div 3 as string), 5, '0') as customer_zip_code_prefix",
        f"{_city('c_custkey')} as customer_city", f"{_state('c_custkey')} as customer_state")


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    s = source(spark, folder, "supplier")
    n = source(spark, folder, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).selectExpr(
        "cast(s_suppkey as string) as seller_id",
        "lpad(cast(s_suppkey * 5 + s_suppkey % 40 as string), 5, '0') as seller_zip_code_prefix",
        f"{_city('s_suppkey')} as seller_city", f"{_state('s_suppkey')} as seller_state")


def geolocation(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty points a prefix; prefixes lie along a diagonal, about 21 in a row for each city, with jitter and bad points."""
    e = source(spark, folder, "events").withColumn("_p", F.expr("(event_id div 20) % 520"))
    e = e.withColumn("_n", F.expr("cast(case when event_id % 11 = 0 then (_p + 5) % 25 else _p div 21 end as int)"))
    n = source(spark, folder, "nation")

    def tenths(start: int, span: int) -> str:
        return (f"cast(cast({start} + (_p % {span}) * 10 + event_id % 7 as decimal(18,0)) * 0.01 as decimal(18,2))")

    lat = (f"case when event_id % 89 = 0 or _p = 519 then '' when event_id % 83 = 0 then '95.00' "
           f"else cast({tenths(-3300, 380)} as string) end")
    return e.join(n, F.col("_n") == n.n_nationkey).selectExpr(
        "lpad(cast(event_id div 20 as string), 5, '0') as geolocation_zip_code_prefix", f"{lat} as geolocation_lat",
        f"cast({tenths(-7400, 400)} as string) as geolocation_lng",
        "case when event_id % 13 = 0 then concat('sao', replace(lower(n_name), '_', '')) "
        "when event_id % 17 = 0 then concat('ilha ', lower(n_name)) "
        "else concat('são ', lower(n_name)) end as geolocation_city",
        "concat('R', cast(n_regionkey as string)) as geolocation_state")


def municipalities(spark: SparkSession, folder: str) -> DataFrame:
    branch = "n_nationkey % 7 = 0"
    uf = "concat('R', cast(n_regionkey as string))"

    def first(expr: str) -> str:
        return f"case when {branch} then '' else {expr} end"

    a, b = "microrregiao_mesorregiao_uf", "regiao_imediata_regiao_intermediaria_uf"
    return _nations(spark, folder).selectExpr(
        "cast(1100000 + n_nationkey as string) as id", "concat('São ', n_name) as nome",
        f"{first(uf)} as {a}_sigla", f"{uf} as {b}_sigla", f"{first('r_name')} as {a}_nome", f"r_name as {b}_nome",
        f"{first('lower(r_name)')} as {a}_regiao_nome", f"lower(r_name) as {b}_regiao_nome",
        f"{first(uf)} as microrregiao_mesorregiao_nome", f"{first('n_name')} as microrregiao_nome")


def indicators(spark: SparkSession, folder: str) -> DataFrame:
    def known(expr: str) -> str:
        return f"case when n_nationkey = 24 then '' else cast({expr} as string) end"

    return source(spark, folder, "nation").selectExpr(
        "cast(1100000 + n_nationkey as string) as cod_ibge", "'2017' as ano_referencia",
        f"{known('n_nationkey * 30000')} as populacao_estimada",
        f"{known('cast(10000.50 + n_nationkey * 1234.25 as decimal(18,2))')} as pib_per_capita")


def crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    """The towns of one region are listed under names that no entity has."""
    return source(spark, folder, "nation").selectExpr(
        "concat(if(n_regionkey = 2, 'Outra ', 'São '), n_name) as cidade_origem", "' xx ' as uf_origem",
        "cast(1100000 + n_nationkey as string) as cod_ibge", "concat('uf divergente: ', n_name) as justificativa")


class RawTables(Mapping):  # names are fixed, tables may be put in the place of others
    """The landed tables of a folder by name; each is planned when it is first asked for."""

    BUILDERS = {
        "pedidos": orders, "itens_pedido": order_items, "pagamentos": payments, "avaliacoes": reviews,
        "produtos": products, "traducao_categorias": translations, "clientes": customers,
        "vendedores": sellers, "geolocalizacao": geolocation, "municipios": municipalities,
        "indicadores": indicators, "de_para": crosswalk,
    }

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.planned: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.planned:
            self.planned[name] = self.BUILDERS[name](self.spark, self.folder)
        return self.planned[name]

    def __setitem__(self, name: str, table: DataFrame) -> None:
        self.planned[name] = table

    def __iter__(self):
        return iter(self.BUILDERS)

    def __len__(self) -> int:
        return len(self.BUILDERS)


def raw_tables(spark: SparkSession, folder: str) -> RawTables:
    return RawTables(spark, folder)
