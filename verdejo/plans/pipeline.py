"""The stages in order, from source files to a published and checked star."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators.checks import FAILED
from ..operators.contract import verify
from ..session import Workspace, together
from ..sources import landing, publish, snapshot
from ..sources.snapshot import Snapshot
from . import gold, gold_quality, integration, quality, silver
from .schemas import STAR_INPUTS

Tables = dict[str, DataFrame]
STAGES = ("bronze", "silver", "integracao", "validacao", "gold")


def load_star(spark: SparkSession, tables: Tables | Snapshot, root: str, ws: Workspace | None = None) -> DataFrame:
    """Contract, references, dimensions and facts, checks, then the switch to the new version.

    With a snapshot every step reads the files that it names, and a file that changed meanwhile stops the publication.
    """
    if ws is None:
        own = Workspace(spark)
        try:
            return load_star(spark, tables, root, own)
        finally:
            own.discard()
    pinned = tables if isinstance(tables, Snapshot) else None
    if pinned:
        tables = pinned.tables(spark)
    problems = verify(tables, STAR_INPUTS)
    if problems:
        raise ValueError("entradas fora do contrato:\n" + "\n".join(problems))
    gold.require_references(tables)
    # Members that an earlier version has numbered keep their keys.
    known = {dim: df for m, df in publish.published_if_any(spark, root, gold.KEY_MAPS).items() for dim in [gold.KEY_MAPS[m]]}
    results = publish.publish(spark, root, lambda keep: gold.build(tables, ws, keep, known),
                              check=lambda written: gold_quality.families(written, tables),
                              before_switch=pinned.guard(spark) if pinned else None)
    done = publish.read_published(spark, root, gold.KEYS)
    publish.write_report(results, root, "Qualidade da Gold", {
        "contagens": gold_quality.counts(done), "uso_desconhecidos": gold_quality.unknown_use(done),
        "match_municipal": gold_quality.match_coverage(tables), "assinaturas": gold_quality.signatures(done)})
    return results


def source_checks(spark: SparkSession, sources: Sequence[landing.Source], landed: Tables, root: str) -> DataFrame:
    """Every source landed; counts against the manifest and a recount; fresh fingerprints against the manifest."""
    there = [s for s in sources if landing.exists(spark, s.path)]
    prints = spark.createDataFrame(list(zip([s.table for s in there], together(lambda s: landing.fingerprint(spark, s), there))),
                                   "tabela string, sha256 string")  # a row for each source
    return C.union([
        quality.presence(spark, "BRZ-EST-001", "Estrutura", "Toda origem tem tabela gravada", [s.table for s in sources], landed),
        quality.landed_against_source(landed, {s.table: landing.read_source(spark, s) for s in there},
                                      landing.load_manifest(spark, root), prints)])


def validate(spark: SparkSession, landed: Tables, crosswalk: DataFrame, tables: Tables, tags: Sequence[str], root: str,
             more: Sequence[DataFrame] = ()) -> DataFrame:
    """Writes the report first and only then fails. ``more``: results of further checks."""
    results = C.union([
        *more,
        quality.landed_shape(spark, landed), quality.landed_content(landed, tags), quality.cleaned(landed, tables),
        quality.integrated(crosswalk, tables), quality.contract(spark, tables)])
    results.coalesce(1).write.mode("overwrite").json(f"{root}/_validacao")
    results = spark.read.json(f"{root}/_validacao")
    publish.write_report(results, root, "Validacao das camadas")
    bad = [r[0] for r in results.filter(F.col("status") == FAILED).select("id").collect()]
    if bad:
        raise ValueError("camadas reprovadas: " + "; ".join(bad))
    return results


def _write_all(tables: Tables, root: str) -> None:
    together(lambda name: publish.write_table(tables[name], f"{root}/{name}", integration.ORDER.get(name, ())), tables)


def run(spark: SparkSession, sources: Sequence[landing.Source], crosswalk_path: str | None, root: str,
        until: str = "gold", now: datetime | None = None) -> dict:
    """Runs the stages up to ``until``; each one reads what the one before has written."""
    if until not in STAGES:
        raise ValueError(f"etapa desconhecida: {until}")
    ws = Workspace(spark)
    try:
        return _run(spark, sources, crosswalk_path, root, STAGES.index(until), now, ws)
    finally:
        ws.discard()


def _run(spark: SparkSession, sources: Sequence[landing.Source], crosswalk_path: str | None, root: str, last: int,
         now: datetime | None, ws: Workspace) -> dict:
    summary = {"bronze": landing.land(spark, sources, f"{root}/bronze", ws, now)}
    landed = landing.landed_tables(spark, f"{root}/bronze", [s.table for s in sources])
    if last >= 1:
        _write_all(silver.build(landed), f"{root}/silver")
        clean = landing.landed_tables(spark, f"{root}/silver", quality.SILVER_GRAIN)
        summary["silver"] = {name: df.count() for name, df in clean.items()}
    more = []
    if last >= 2:
        curated = None
        if crosswalk_path and landing.exists(spark, crosswalk_path):
            curated = landing.read_text_csv(spark, crosswalk_path)
            more.append(quality.crosswalk_header(spark, curated.columns))
            header = more[-1].first()
            if header.status == FAILED:
                raise ValueError(f"de-para com colunas {header.encontrado}")
        places = integration.resolve_both(clean, curated, ws)
        _write_all(integration.outputs(clean, places), f"{root}/silver")
        publish.write_table(integration.unresolved(places["mapa_clientes"], places["mapa_vendedores"]),
                            f"{root}/silver/municipios_nao_resolvidos.csv")
        joined = {**clean, **landing.landed_tables(spark, f"{root}/silver", quality.INTEGRATION_GRAIN)}
        quality.require_acceptance(places, joined["distancias_itens"])
        summary["integracao"] = [r.asDict() for e in integration.ENTITIES for r in
                                 integration.coverage(places[f"mapa_{e}"], e).collect()]
    if last >= 3:
        tags = sorted({s.tag for s in sources})
        more.append(source_checks(spark, sources, landed, f"{root}/bronze"))
        results = validate(spark, landed, places["de_para"], joined, tags, f"{root}/silver", more)
        summary["validacao"] = C.outcome(results).first().asDict()
    if last >= 4:
        results = load_star(spark, snapshot.pin(spark, {t: f"{root}/silver/{t}" for t in STAR_INPUTS}), f"{root}/gold", ws)
        summary["gold"] = C.outcome(results).first().asDict()
    return summary
