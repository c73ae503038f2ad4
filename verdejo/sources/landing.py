"""Lossless landing: text columns with lineage, content hashes, a manifest and count checks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.keys import file_blocks, file_record_numbers
from ..operators.signature import signature
from ..session import Workspace, together
from .files import exists, get_text, prune, put_text, remove

MANIFEST = T.StructType([
    T.StructField("tabela", T.StringType()), T.StructField("arquivo_origem", T.StringType()),
    T.StructField("caminho_origem", T.StringType()), T.StructField("sha256", T.StringType()),
    T.StructField("data_ingestao", T.TimestampNTZType()), T.StructField("linhas", T.LongType()),
    T.StructField("pasta", T.StringType()),
])
MANIFEST_FILE = "manifesto.json"


class MissingSource(FileNotFoundError):
    pass


class CountMismatch(RuntimeError):
    pass


class UnexpectedStructure(RuntimeError):
    pass


@dataclass(frozen=True)
class Source:
    """A landed table: where its file lies, the tag of its lineage and how to get it."""

    table: str
    path: str
    tag: str
    hint: str
    format: str = "csv"
    multi_line: bool = True  # quoted fields may hold line breaks, so a file is not split; False is checked while landing


#: Extracts whose fields may hold line breaks.
FREE_TEXT = ("avaliacoes",)


def retail_sources(root: str, tags: tuple[str, str, str] = ("loja", "indicadores", "cadastro")) -> tuple[Source, ...]:
    """The ten CSV extracts and the register, with their usual file names under ``root``."""
    shop, facts, register = tags
    files = {
        "pedidos": "orders.csv", "itens_pedido": "order_items.csv", "produtos": "products.csv",
        "clientes": "customers.csv", "vendedores": "sellers.csv", "pagamentos": "order_payments.csv",
        "avaliacoes": "order_reviews.csv", "geolocalizacao": "geolocation.csv",
        "traducao_categorias": "category_translation.csv",
    }
    hint = "extrato da loja"
    return (
        *[Source(t, f"{root}/{f}", shop, hint, multi_line=t in FREE_TEXT) for t, f in files.items()],
        Source("indicadores", f"{root}/indicators.csv", facts, "consolidado dos indicadores municipais", multi_line=False),
        Source("municipios", f"{root}/municipalities.json", register, "cadastro de municipios", "json"),
    )


def chosen(sources: Sequence[Source], tables: Iterable[str] | None) -> list[Source]:
    if tables is None:
        return list(sources)
    known = {s.table: s for s in sources}
    unknown = [t for t in tables if t not in known]
    if unknown:
        raise ValueError(f"tabela(s) desconhecida(s): {', '.join(unknown)}; use {', '.join(known)}")
    return [known[t] for t in tables]


def require(spark: SparkSession, sources: Sequence[Source]) -> None:
    missing = [s for s in sources if not exists(spark, s.path)]
    if missing:
        raise MissingSource("Fonte ausente: " + "; ".join(
            f"{s.table}: {s.path} (onde obter: {s.hint})" for s in missing))


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Every field as text; an empty field stays ''. A ragged record stops the job.

    With ``multi_line`` a quoted field may hold line breaks, and one file is one
    task; spread a large extract over many files. Files without such fields can
    be read with ``multi_line=False`` and are then split.
    """
    df = (spark.read.option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
          .option("mode", "FAILFAST").csv(path))
    return df.na.fill("")


def flatten(df: DataFrame) -> DataFrame:
    """Nested records to text columns named by their path; a missing branch becomes ''."""
    out: list = []

    def walk(fields: T.StructType, path: str, name: str) -> None:
        for f in fields:
            here = f"{path}.`{f.name}`" if path else f"`{f.name}`"
            label = (f"{name}_{f.name}" if name else f.name).replace("-", "_").lower()
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, here, label)
            elif isinstance(f.dataType, T.ArrayType):
                raise UnexpectedStructure(f"campo '{label}' veio como lista")
            else:
                out.append(F.coalesce(F.col(here).cast("string"), F.lit("")).alias(label))

    walk(df.schema, "", "")
    return df.select(*out)


def read_register(spark: SparkSession, path: str) -> DataFrame:
    return flatten(_read_json(spark, path))


def _read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).option("primitivesAsString", True).option("mode", "FAILFAST").json(path)


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    return read_register(spark, source.path) if source.format == "json" else read_text_csv(spark, source.path, source.multi_line)


def with_lineage(df: DataFrame, tag: str, when: datetime, blocks: DataFrame | None = None) -> DataFrame:
    """Adds source tag, file name, ingest time and the record number within the file. ``blocks``: the file blocks as written."""
    named = file_record_numbers(df.select("*", F.col("_metadata")), "_linha_origem", blocks)
    return named.select(*df.columns, F.lit(tag).alias("_fonte"), F.col("_metadata.file_name").alias("_arquivo_origem"),
                        F.lit(when.isoformat()).cast("timestamp_ntz").alias("_data_ingestao"), "_linha_origem")


def land_parquet(spark: SparkSession, path: str, tag: str, when: datetime) -> DataFrame:
    """A columnar source as text with lineage. Record numbers come with the scan, without a shuffle."""
    df = spark.read.parquet(path)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]
    return df.select(*text, F.lit(tag).alias("_fonte"), F.col("_metadata.file_name").alias("_arquivo_origem"),
                     F.lit(when.isoformat()).cast("timestamp_ntz").alias("_data_ingestao"),
                     (F.col("_metadata.row_index") + 1).alias("_linha_origem"))


_WORDS = 6  # numbers of 30 bits taken from each line, two from each of its hashes: 180 bits
_ROW_BITS = (1 << 33) - 1  # the low bits of monotonically_increasing_id count rows of a partition


def fingerprint(spark: SparkSession, source: Source) -> str:
    return read_lines(spark, source)[0]


def read_lines(spark: SparkSession, source: Source) -> tuple[str, int]:
    """The fingerprint of a source, and how many of its lines leave a quoted field open.

    One rule for a file or a folder of any size: it changes with every byte, with the order of lines and with file names.

    Each line's hashes are summed plainly and weighted by the line's number in its file; the sums are hashed with the
    names and sizes of all files. A block adds up its lines by their place within it, and its weighted sums are moved
    to its place in the file afterwards, so the files are read once, no line moves, and the layout does not matter.
    """
    lines = spark.read.option("lineSep", "\n").text(source.path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("row"), *(F.xxhash64(F.lit(i), "value").alias(f"h{i}") for i in range(_WORDS // 2)),
        ((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).cast("bigint").alias("open"))
    low = (1 << 30) - 1
    words = lines.select("path", "name", "start", "row", "open", *(
        F.shiftright(f"h{i // 2}", 30 * (i % 2)).bitwiseAND(F.lit(low)).alias(f"w{i}") for i in range(_WORDS)))
    whole = "decimal(38,0)"

    def weighted(i: int) -> Column:
        """The sum of words times rows, each product of at most 63 bits summed in two halves."""
        product, half = F.col(f"w{i}") * F.col("row"), (1 << 31) - 1
        return (F.sum(F.shiftright(product, 31)).cast("decimal(19,0)") * F.lit(half + 1).cast("decimal(10,0)")
                + F.sum(product.bitwiseAND(F.lit(half)))).cast(whole)

    blocks = words.groupBy("path", "name", "start").agg(
        F.count(F.lit(1)).alias("n"), F.min("row").alias("first"), F.sum("open").alias("open"), *(F.sum(f"w{i}").alias(f"s{i}") for i in range(_WORDS)),
        *(weighted(i).alias(f"p{i}") for i in range(_WORDS)))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    moved = blocks.withColumn("move", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).cast("decimal(19,0)"))
    files = moved.groupBy("path", "name").agg(
        F.sum("n").alias("n"), F.sum("open").alias("open"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(_WORDS)),
        *(F.sum((F.col(f"p{i}") + F.col("move") * F.col(f"s{i}").cast("decimal(19,0)")).cast(whole)).cast(whole).alias(f"p{i}") for i in range(_WORDS)))
    total = signature(files.drop("path"), source.table, abertas=F.coalesce(F.sum("open"), F.lit(0)))
    sizes = spark.read.format("binaryFile").load(source.path).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").cast("string").alias("length"))
    shape = signature(sizes, source.table, abertas=F.lit(0).cast("bigint"))
    row = total.union(shape).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(
        F.concat_ws("|", "linhas", "s1", "s2", "s3", "s4", "esquema"))), "/"), 256).alias("sha"), F.sum("abertas").alias("abertas")).first()
    return row.sha, row.abertas


def _entries(spark: SparkSession, root: str) -> dict[str, tuple]:
    """The manifest by table; a row for each source."""
    path = f"{root}/{MANIFEST_FILE}"
    rows = json.loads(get_text(spark, path)) if exists(spark, path) else []
    when = MANIFEST.fieldNames().index("data_ingestao")
    return {r[0]: (*r[:when], datetime.fromisoformat(r[when]), *r[when + 1:]) for r in rows}


def load_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.createDataFrame(list(_entries(spark, root).values()), MANIFEST)


def _store_manifest(spark: SparkSession, root: str, entries: dict[str, tuple]) -> None:
    """Puts tables and manifest in place at once: readers find a table through its entry."""
    rows = [[v.isoformat() if isinstance(v, datetime) else v for v in e] for e in entries.values()]
    put_text(spark, f"{root}/{MANIFEST_FILE}", json.dumps(rows, ensure_ascii=False))


def ingest_time(entry: tuple | None, digest: str, output_exists: bool, now: datetime) -> tuple[datetime, bool]:
    """Keeps the earlier time while the content is the same and its output is still there."""
    if entry and entry[3] == digest and output_exists:
        return entry[4], False
    return now, True


def _still_there(spark: SparkSession, path: str, landed: DataFrame, tag: str, rows: int) -> bool:
    """Whether a table holds so many rows of the columns and the tag that a landing would write."""
    there = spark.read.parquet(path)
    if [(f.name, f.dataType) for f in there.schema] != [(f.name, f.dataType) for f in landed.schema]:
        return False
    found = there.agg(F.count(F.lit(1)), F.count_if(~F.col("_fonte").eqNullSafe(F.lit(tag)))).first()
    return tuple(found) == (rows, 0)


def land(spark: SparkSession, sources: Sequence[Source], root: str, ws: Workspace, now: datetime | None = None,
         tables: Iterable[str] | None = None) -> list[dict]:
    """Writes every source under ``root`` and returns one summary per table.

    A source is counted block by block, and written with record numbers from those counts; the rows that pass the
    writer and the rows that the written table holds are counted too, and all three have to agree. A table's new
    version lies beside the earlier one until the manifest, one small file, names it; the earlier one then stays for
    its readers until the next landing that writes. A source with the fingerprint of its last landing is counted, but
    not written again while the table of that landing holds as many rows of the same columns and tag.
    """
    picked = chosen(sources, tables)
    require(spark, picked)
    now = now or datetime.now().replace(microsecond=0)
    entries = _entries(spark, root)
    done: list[dict] = []

    def one(source: Source) -> None:
        entry = entries.get(source.table)
        df = read_source(spark, source)
        (digest, split), blocks = together(lambda job: job(), (
            lambda: read_lines(spark, source), lambda: ws.keep(f"blocks-{source.table}", file_blocks(df.select("*", F.col("_metadata"))))))
        if split and source.format == "csv" and not source.multi_line:
            raise UnexpectedStructure(f"{source.table}: {split} linhas com aspas abertas; a origem precisa de multi_line")
        when, changed = ingest_time(entry, digest, bool(entry) and exists(spark, f"{root}/{entry[6]}"), now)
        landed = with_lineage(df, source.tag, when, blocks)
        expected = blocks.agg(F.sum("_n")).first()[0] or 0
        name = source.path.rstrip("/").rsplit("/", 1)[-1]
        if not changed and _still_there(spark, f"{root}/{entry[6]}", landed, source.tag, expected):
            entries[source.table] = (source.table, name, source.path, digest, when, expected, entry[6])
            done.append({"tabela": source.table, "linhas_entrada": expected, "linhas_saida": expected, "colunas_dados": len(df.columns),
                         "data_ingestao": when, "fonte_alterada": False, "sha256": digest, "_antes": entry[6]})
            return
        folder = f"{source.table}/versao={uuid.uuid4().hex}"
        passed = Observation()
        landed.observe(passed, F.count(F.lit(1)).alias("n")).write.option("compression", "snappy").parquet(f"{root}/{folder}")
        written = spark.read.parquet(f"{root}/{folder}").count()
        if not written == expected == passed.get["n"]:
            remove(spark, f"{root}/{folder}")
            raise CountMismatch(f"{source.table}: {expected} registros na origem, {passed.get['n']} entregues, {written} gravados")
        entries[source.table] = (source.table, name, source.path, digest, when, written, folder)
        done.append({"tabela": source.table, "linhas_entrada": expected, "linhas_saida": written, "colunas_dados": len(df.columns),
                     "data_ingestao": when, "fonte_alterada": changed, "sha256": digest, "_antes": entry[6] if entry else None})

    try:
        together(one, picked)
    finally:
        # Also after a failure, so that the manifest tells what is on disk.
        if done:
            _store_manifest(spark, root, entries)
            for d in done:
                current, before = entries[d["tabela"]][6], d.pop("_antes")
                if current == before:
                    continue  # nothing was written, so nothing goes
                kept = [current, before]
                prune(spark, f"{root}/{d['tabela']}", "versao=", [f.rsplit("/", 1)[-1] for f in kept if f])
    order = [s.table for s in picked]
    return sorted(done, key=lambda d: order.index(d["tabela"]))


def landed_tables(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Tables as the manifest names them, or as folders of their own where there is no entry."""
    entries = _entries(spark, root)
    places = {n: f"{root}/{entries[n][6] if n in entries else n}" for n in names}
    missing = [n for n, path in places.items() if not exists(spark, path)]
    if missing:
        raise MissingSource("tabela(s) ausente(s): " + ", ".join(f"{n} -> {places[n]}" for n in missing))
    return {n: spark.read.parquet(path) for n, path in places.items()}
