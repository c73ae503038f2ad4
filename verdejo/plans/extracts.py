"""The tables of a folder as files of the kinds that landing reads, landed, published and read back."""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks as C
from ..session import together
from ..sources import landing, publish
from . import gold, gold_quality, integration, pipeline, quality
from .warehouse import Warehouse, open_warehouse

FIRST, SECOND = datetime(2026, 1, 2, 3, 4, 5), datetime(2026, 2, 2, 3, 4, 5)
TAG = "loja"
REGISTER_FILES = 8


class Extracts:
    """CSV files of every landed table and JSON files of the register, landed twice: nothing changes in between.

    Files are written and landed when a query asks for them, so a query that reads none of them pays for none.
    """

    def __init__(self, w: Warehouse):
        self.w, self.spark, self.root = w, w.spark, f"{w.ws.root}/extracts"
        self.bronze = f"{self.root}/bronze"
        self.sources = [landing.Source(name, f"{self.root}/raw/{name}", TAG, "extrato", multi_line=name in landing.FREE_TEXT)
                        for name in w.raw if name != "de_para"]
        self.landings: dict[str, tuple[dict, dict]] = {}

    def _write(self, name: str) -> str:
        path = f"{self.root}/raw/{name}"
        if not landing.exists(self.spark, path):
            self.w.raw[name].write.option("header", True).option("quoteAll", True).option("escape", '"').option(
                "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
        return path

    @cached_property
    def crosswalk(self) -> str:
        return self._write("de_para")

    def _land(self, *tables: str) -> list[tuple[dict, dict]]:
        """What the first and the second landing of each table tell."""
        new = [t for t in tables if t not in self.landings]
        if new:
            together(self._write, new)
            first, second = (landing.land(self.spark, self.sources, self.bronze, self.w.ws, when, new) for when in (FIRST, SECOND))
            self.landings.update(zip(new, zip(first, second)))
        return [self.landings[t] for t in tables]

    @property
    def tables(self) -> list[str]:
        return [s.table for s in self.sources]

    @property
    def landed(self) -> dict[str, DataFrame]:
        self._land(*self.tables)
        return landing.landed_tables(self.spark, self.bronze, self.tables)

    def register(self) -> DataFrame:
        """The register written as arrays of nested records, one array a file, and read back flat."""
        path = f"{self.root}/register"
        if not landing.exists(self.spark, path):
            a, b = "microrregiao_mesorregiao_uf", "regiao_imediata_regiao_intermediaria_uf"

            def state(branch: str) -> F.Column:
                return F.struct(F.col(f"{branch}_sigla").alias("sigla"), F.col(f"{branch}_nome").alias("nome"),
                                F.struct(F.col(f"{branch}_regiao_nome").alias("nome")).alias("regiao"))

            record = F.struct("id", "nome", F.struct(
                F.col("microrregiao_nome").alias("nome"), F.struct(
                    F.col("microrregiao_mesorregiao_nome").alias("nome"), state(a).alias("UF")).alias("mesorregiao")).alias("microrregiao"),
                F.struct(F.struct(state(b).alias("UF")).alias("regiao-intermediaria")).alias("regiao-imediata"))
            rows = self.w.raw["municipios"].select(F.pmod(F.xxhash64("id"), F.lit(REGISTER_FILES)).alias("parte"), record.alias("r"))
            rows.groupBy("parte").agg(F.to_json(F.collect_list("r")).alias("value")).write.partitionBy("parte").text(path)
        return landing.read_register(self.spark, path).select(*self.w.raw["municipios"].columns)

    def landed_again(self) -> DataFrame:
        """Per table: rows of the source and of the output, columns, and whether the second landing kept the first one's time."""
        rows = [(a["tabela"], a["linhas_entrada"], b["linhas_saida"], a["colunas_dados"], a["fonte_alterada"], b["fonte_alterada"], b["data_ingestao"] == FIRST)
                for a, b in self._land(*self.tables)]  # a row for each source
        return self.spark.createDataFrame(rows, "tabela string, linhas_entrada long, linhas_saida long, colunas int, nova boolean, alterada boolean, data_mantida boolean")

    def manifest(self) -> DataFrame:
        """The manifest against the fingerprints of the sources as they are now."""
        self._land(*self.tables)
        known = landing.load_manifest(self.spark, self.bronze)
        now = self.spark.createDataFrame(
            list(zip([s.table for s in self.sources], together(lambda s: landing.fingerprint(self.spark, s), self.sources))), "t string, agora string")
        return known.join(now, F.col("tabela") == F.col("t")).select(
            "tabela", "arquivo_origem", "data_ingestao", "linhas", F.length("sha256").alias("digitos"), (F.col("sha256") == F.col("agora")).alias("igual"))

    def rows(self, table: str) -> DataFrame:
        self._land(table)
        return landing.landed_tables(self.spark, self.bronze, [table])[table].drop("_arquivo_origem", "_linha_origem")

    def numbers(self) -> DataFrame:
        """Per table: files, rows, and files whose record numbers are not 1..N."""
        landed = self.landed

        def one(table: str) -> DataFrame:
            files = landed[table].groupBy("_arquivo_origem").agg(
                F.count(F.lit(1)).alias("n"), F.min("_linha_origem").alias("a"), F.max("_linha_origem").alias("b"), F.countDistinct("_linha_origem").alias("d"))
            return files.agg(F.sum("n").alias("linhas"), F.count_if((F.col("a") != 1) | (F.col("b") != F.col("n")) | (F.col("d") != F.col("n"))).alias("arquivos_com_falha")
                             ).select(F.lit(table).alias("tabela"), "linhas", "arquivos_com_falha")
        return C.union([one(s.table) for s in self.sources])

    def source_checks(self) -> DataFrame:
        header = landing.read_text_csv(self.spark, self.crosswalk).columns
        return C.union([pipeline.source_checks(self.spark, self.sources, self.landed, self.bronze), quality.crosswalk_header(self.spark, header)])

    def crosswalk_rows(self) -> DataFrame:
        return integration.crosswalk(landing.read_text_csv(self.spark, self.crosswalk), self.w.places["referencia"])

    def published(self) -> dict[str, DataFrame]:
        """The star, published with its checks and read back through the pointer."""
        root = f"{self.root}/gold"
        if publish.current_version(self.spark, root) is None:
            contract = self.w.contract
            publish.publish(self.spark, root, lambda keep: gold.build(contract, self.w.ws, keep), check=lambda done: gold_quality.families(done, contract))
        return publish.read_published(self.spark, root, gold.KEYS)

    def published_counts(self) -> DataFrame:
        return gold_quality.counts(self.published())

    def published_report(self) -> DataFrame:
        """The check results that were written beside the published star."""
        self.published()
        root = f"{self.root}/gold"
        rows = self.spark.read.json(f"{root}/version={publish.current_version(self.spark, root)}/_qualidade")
        return C.outcome(rows)

    def sorted_outputs(self) -> DataFrame:
        """The sorted tables, written and read back: rows, and files whose keys do not follow those of the file before."""
        def one(name: str) -> DataFrame:
            path, order = f"{self.root}/sorted/{name}", integration.ORDER[name]
            if not landing.exists(self.spark, path):
                publish.write_table(self.w.integrated[name], path, order)
            return publish.borders(self.spark, path, order).select(F.lit(name).alias("tabela"), "linhas", "arquivos_fora_de_ordem", "linhas_fora_de_ordem")
        return C.union(together(one, integration.ORDER))

    def csv_sink(self) -> DataFrame:
        path = f"{self.root}/nao_resolvidos.csv"
        rows = integration.unresolved(self.w.places["mapa_clientes"], self.w.places["mapa_vendedores"])
        if not landing.exists(self.spark, path):
            publish.write_table(rows, path)
        return self.spark.read.schema(rows.schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


_OPEN: dict[tuple[str, str], Extracts] = {}


def open_extracts(spark: SparkSession, folder: str) -> Extracts:
    w = open_warehouse(spark, folder)
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        _OPEN[key] = Extracts(w)
    return _OPEN[key]
