"""Sinks and the all-or-nothing publication of a set of tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.checks import FAILED, outcome
from ..session import together
from .files import exists, prune, put_text

POINTER, HISTORY = "CURRENT", "HISTORY"
_BLOCK = 1 << 16  # rows that are checked together


def write_table(df: DataFrame, path: str, order: Sequence[str] = ()) -> int:
    """Parquet, or CSV with a header for a path that ends in .csv; returns the rows written.

    With ``order`` the rows are totally ordered over the files: each file holds a range of keys and is sorted.
    """
    if order:
        by = [F.col(c).asc_nulls_last() for c in order]
        df = df.repartitionByRange(*by).sortWithinPartitions(*by)
    if path.endswith(".csv"):
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
        # A quoted field may hold line breaks, so the count parses records like a reader would.
        return df.sparkSession.read.schema(df.schema).option("header", True).option("multiLine", True).option(
            "escape", '"').csv(path).count()
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def key_ranges(spark: SparkSession, path: str, order: Sequence[str]) -> DataFrame:
    """A row for each file of a sorted Parquet table: its rows, and its first and last key (NULLs after all values)."""
    key = F.struct(*(x for c in order for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))))
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("arquivo")).agg(
        F.count(F.lit(1)).alias("linhas"), F.min(key).alias("primeira"), F.max(key).alias("ultima"))


def borders(spark: SparkSession, path: str, order: Sequence[str]) -> DataFrame:
    """One row: rows, files that begin before the file before them ends, rows that stand before a smaller row of their file.

    The borders need the key ranges alone. Within files a row is held against its predecessor by its place in the file,
    in blocks, each of which takes along the last row of the block before.
    """
    ranges = key_ranges(spark, path, order)
    files = Window.orderBy("arquivo")  # one row for each file
    over = ranges.withColumn("antes", F.lag("ultima").over(files)).agg(
        F.coalesce(F.sum("linhas"), F.lit(0)).alias("linhas"), F.count_if(F.col("antes") > F.col("primeira")).alias("arquivos_fora_de_ordem"))
    key = F.struct(*(x for c in order for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))))
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"), key.alias("k"))
    ends = rows.withColumn("b", F.expr(f"i div {_BLOCK}"))
    ends = ends.unionByName(ends.filter(f"i % {_BLOCK} = {_BLOCK - 1}").withColumn("b", F.col("b") + 1))
    inside = ends.withColumn("p", F.lag("k").over(Window.partitionBy("f", "b").orderBy("i")))
    return over.crossJoin(inside.agg(F.count_if(F.col("p") > F.col("k")).alias("linhas_fora_de_ordem")))  # one row each


def current_version(spark: SparkSession, root: str) -> str | None:
    path = f"{root}/{POINTER}"
    if not exists(spark, path):
        return None
    return spark.read.text(path).first()[0].strip()


def _history(spark: SparkSession, root: str) -> list[str]:
    """The versions that were current, the last one at the end."""
    now = current_version(spark, root)
    past = [r[0] for r in spark.read.text(f"{root}/{HISTORY}").collect()] if exists(spark, f"{root}/{HISTORY}") else []
    return [v for v in past if v != now] + ([now] if now else [])


def read_published(spark: SparkSession, root: str, tables) -> dict[str, DataFrame]:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nenhuma versao publicada em {root}; execute a carga antes")
    return {t: spark.read.parquet(f"{root}/version={version}/{t}") for t in tables}


def published_if_any(spark: SparkSession, root: str, tables) -> dict[str, DataFrame]:
    """Those of the tables that the current version holds; none before the first publication."""
    version = current_version(spark, root)
    paths = {t: f"{root}/version={version}/{t}" for t in tables} if version else {}
    return {t: spark.read.parquet(path) for t, path in paths.items() if exists(spark, path)}


Keep = Callable[[str, DataFrame], DataFrame]
Build = Callable[[Keep], Mapping[str, DataFrame]]


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame] | Build,
            check: Callable[[dict[str, DataFrame]], DataFrame | Sequence[DataFrame]] | None = None, version: str | None = None,
            before_switch: Callable[[], None] | None = None, retain: int = 2) -> DataFrame | None:
    """Writes a full new version aside, checks what was written, then moves the pointer.

    ``tables`` are finished frames, or a builder that writes each table through the
    function it is given, so that no table is written twice. ``check`` may return its results in parts, which run one after
    the other: small tables that are sent to a part's joins, and its plan, go before the next begins. Readers see the old version
    until the pointer moves; on any failure it never does. ``before_switch`` may still raise. The ``retain`` versions
    that were current last stay, for readers that hold them; others and what failed runs left are removed. Returns the
    check results.
    """
    version = version or uuid.uuid4().hex
    home = f"{root}/version={version}"

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.option("compression", "snappy").parquet(f"{home}/{name}")
        return spark.read.schema(df.schema).parquet(f"{home}/{name}")

    written = dict(tables(keep)) if callable(tables) else dict(zip(tables, together(lambda n: keep(n, tables[n]), tables)))
    results = None
    if check is not None:
        found = check(written)
        if not isinstance(found, DataFrame):  # a row for each check
            found = spark.createDataFrame([r for part in found for r in part.collect()], found[0].schema)
        found.coalesce(1).write.json(f"{home}/_qualidade")
        results = spark.read.json(f"{home}/_qualidade")
        bad = [r[0] for r in results.filter(F.col("status") == FAILED).select("id").collect()]
        if bad:
            raise ValueError("Carga reprovada: " + "; ".join(bad))
    if before_switch is not None:
        before_switch()
    past = [v for v in _history(spark, root) if v != version]
    put_text(spark, f"{root}/{HISTORY}", "\n".join([*past, version][-retain:]))
    put_text(spark, f"{root}/{POINTER}", version)
    prune(spark, root, "version=", [f"version={v}" for v in [*past, version][-retain:]])
    return results


def write_report(results: DataFrame, root: str, title: str, extra: Mapping[str, DataFrame] | None = None) -> None:
    """Check results as JSON rows and as a markdown page; all parts are small result tables."""
    spark = results.sparkSession
    verdict = outcome(results).first()
    rows = results.collect()
    sections = {name: [r.asDict() for r in df.collect()] for name, df in (extra or {}).items()}
    body = {"resultado_geral": verdict["resultado_geral"], "resumo": verdict.asDict(),
            "testes": [r.asDict() for r in rows], **sections}
    put_text(spark, f"{root}/qualidade.json", json.dumps(body, ensure_ascii=False, indent=2, default=str) + "\n")
    lines = [f"# {title}", "", verdict["resultado_geral"], "", "| Verificacao | Esperado | Encontrado | Resultado |",
             "| --- | --- | --- | --- |"]
    lines += [f"| {r.id} | {r.esperado} | {r.encontrado} | {r.status} |" for r in rows]
    for name, content in sections.items():
        lines += ["", f"## {name}", ""] + [f"- {', '.join(f'{k}: {v}' for k, v in r.items())}" for r in content]
    put_text(spark, f"{root}/qualidade.md", "\n".join(lines) + "\n")
