"""A Merkle manifest of documents: eightfold hash trees of each language, joined under one root, with proofs.

H is the lower-case hex SHA-256 of its inputs written one after the other, digests as hex text. A document is a leaf:
H of doc_id, source, lang, n_chars and text, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value.

``build`` numbers the leaves of each language by doc_id with range partitions and the counts of the partitions
before, and takes every ``FAN`` consecutive nodes to their H, level by level, until one node is left; the languages'
subroots, in the order of their languages, become a tree of the same kind. Every level is written as node rows that
name their parent, their place in the parent's run and the digests of their own run.

``climb`` is one recursive query over those rows. It starts at each leaf with the digest to be proved, joins the
parent, appends the other digests of the run as a row of the result, folds, and goes on to the parent's parent. A row
of the loop holds one digest and one run, so what it shuffles grows with the height of the tree and not with its
square. A run holds at most ``FAN`` digests, so no step brings more than that together; the height is the logarithm
of the largest language.

Nulls: a null language is one of its own, before all others; a null doc_id comes first within its language. Rows with
one doc_id are ordered by their leaf; rows that are equal throughout are leaves side by side. An empty table has an
empty result. Extra columns are not read. One document alone is its language's subroot and the root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .kit import Scratch

#: Consecutive nodes under one parent.
FAN = 8

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Node ids are the number of their first leaf times ``_LEVELS``, plus the level; the tree over the languages counts from half of it.
_LEVELS = 64
_ROW_BITS = (1 << 33) - 1  # the low bits of monotonically_increasing_id count rows of a partition
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NODE = "node long, parent long, slot int, hash binary, kids binary, subroot boolean, doc_id long, proved binary"


@dataclass
class Manifest:
    """``nodes`` of all levels: id, parent, place in the parent's run, digest, the run's digests (null for a leaf),
    whether it is a language's subroot, and for leaves the doc_id and the digest to be proved."""

    nodes: DataFrame


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(_field(text if c == "text" else F.col(c)) for c in FIELDS)), 256))


def _digest(digests: Column) -> Column:
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def tampered(doc_id: Column, text: Column) -> Column:
    """The text after tampering: A-Z in lower case where 3 divides the CRC-32 of the decimal id."""
    return F.when(F.crc32(doc_id.cast("string")) % 3 == 0, F.translate(text, _UPPER, _LOWER)).otherwise(text)


def _numbered(rows: DataFrame, tree: str, order: list[str], ws: Scratch, name: str) -> tuple[DataFrame, int]:
    """Adds ``first`` (number over all rows by tree and order), ``pos`` (the same within the tree) and ``n`` (rows of the tree).

    Returns the rows and the size of the largest tree."""
    by = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    placed = ws.keep(name, rows.repartitionByRange(*by).sortWithinPartitions(*by)
                     .withColumn("part", F.spark_partition_id())
                     .withColumn("row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))))
    # A row for each partition and each tree in it: trees are runs of the order, so at most partitions plus trees.
    runs = placed.groupBy("part", tree).agg(F.count(F.lit(1)).alias("size"), F.min("row").alias("opens"))
    sizes = runs.groupBy("part").agg(F.sum("size").alias("all"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shuffle partition
    shifts = sizes.select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("shift"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = ws.keep(f"{name}-runs", runs.join(shifts, "part").select(
        F.col("part").alias("p"), F.col(tree).alias("t"), "shift", (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("opens")).alias("own"),
        F.sum("size").over(whole).alias("n")))
    numbered = placed.join(runs, (F.col("part") == F.col("p")) & F.col(tree).eqNullSafe(F.col("t"))).select(
        *rows.columns, (F.col("shift") + F.col("row")).alias("first"), (F.col("own") + F.col("row")).alias("pos"), "n")
    return numbered, runs.agg(F.max("n")).first()[0] or 0


def _raised(level: DataFrame, most: int, base: int, ws: Scratch, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Node rows of all trees of ``level(tree, pos, n, node, hash, kids, doc_id, proved, subroot)``, and the rows left at their tops.

    ``most`` is the size of the largest tree."""
    done, tops, height = [], [], 0
    while True:
        tops.append(level.where("n = 1"))
        if most <= 1:
            return done, tops
        height += 1
        run = F.array_sort(F.collect_list(F.struct("pos", "node", "hash", "kids", "subroot", "doc_id", "proved")))
        runs = ws.keep(f"{name}-{height}", level.where("n > 1").groupBy("tree", F.expr(f"pos div {FAN}").alias("up")).agg(
            F.max("n").alias("n"), run.alias("run")).withColumn(
            "parent", F.expr(f"run[0].node div {_LEVELS} * {_LEVELS} + {base + height}")))
        done.append(runs.select("parent", F.posexplode("run").alias("slot", "x")).select(
            "x.node", "parent", "slot", "x.hash", "x.kids", "x.subroot", "x.doc_id", "x.proved"))
        kids = F.unhex(F.array_join(F.transform("run", lambda x: F.hex(x["hash"])), ""))
        level = runs.select("tree", F.col("up").alias("pos"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), F.col("parent").alias("node"),
                            _digest(kids).alias("hash"), kids.alias("kids"), F.lit(None).cast("long").alias("doc_id"),
                            F.lit(None).cast("binary").alias("proved"), F.lit(False).alias("subroot"))
        most = -(-most // FAN)


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def build(docs: DataFrame, ws: Scratch, proved: Column | None = None) -> Manifest:
    """The trees over ``docs(doc_id, source, lang, n_chars, text)``. ``proved`` is the text whose leaf a proof starts from (its own by default)."""
    text = F.col("text")
    leaves = docs.select("doc_id", F.col("lang").alias("tree"), _leaf(text).alias("hash"), _leaf(text if proved is None else proved).alias("proved"),
                         F.monotonically_increasing_id().alias("copy"))  # equal rows are spread, too
    leaves, most = _numbered(leaves, "tree", ["doc_id", "hash", "copy"], ws, "leaves")
    leaves = leaves.select(
        "tree", "pos", "n", (F.col("first") * _LEVELS).alias("node"), "hash", F.lit(None).cast("binary").alias("kids"), "doc_id", "proved",
        F.lit(False).alias("subroot"))
    below, tops = _raised(leaves, most, 0, ws, "level")
    subroots = _all(tops).select("tree", "node", "hash", "kids", "doc_id", "proved").withColumn("one", F.lit(0))
    subroots, most = _numbered(subroots, "one", ["tree"], ws, "subroots")
    subroots = subroots.select(
        F.col("one").alias("tree"), "pos", "n", "node", "hash", "kids", "doc_id", "proved", F.lit(True).alias("subroot"))
    above, root = _raised(subroots, most, _LEVELS // 2, ws, "top")
    roots = _all(root).select("node", F.lit(None).cast("long").alias("parent"), F.lit(None).cast("int").alias("slot"), "hash", "kids", "subroot", "doc_id", "proved")
    return Manifest(ws.keep("nodes", _all([*below, *above, roots]).select(*(f.split()[0] for f in NODE.split(", ")))))


CLIMB = """
with recursive climb(leaf, at, slot, step, folded, siblings, mark, doc_id, original) as (
  select node, parent, slot, 0, proved, cast(null as binary), subroot, doc_id, hash from {nodes} where kids is null
  union all
  select c.leaf, r.parent, r.slot, c.step + 1,
    unhex(sha2(lower(hex(concat(substring(r.kids, 1, 32 * c.slot), c.folded, substring(r.kids, 32 * c.slot + 33)))), 256)),
    concat(substring(r.kids, 1, 32 * c.slot), substring(r.kids, 32 * c.slot + 33)), r.subroot, cast(null as bigint),
    case when r.subroot or r.parent is null then r.hash end
  from climb c join {inner} r on c.at = r.node)
select leaf, array_sort(collect_list(struct(step, siblings, folded, mark, doc_id, original))) steps from climb group by leaf"""


def climb(manifest: Manifest, ws: Scratch) -> DataFrame:
    """For every leaf its digest, subroot, root, the digest of its proof, and the root folded from the digest to be proved."""
    spark, limit = ws.spark, "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # a row for each leaf and level; the number of levels stays limited
    try:
        steps = ws.keep("climb", spark.sql(CLIMB, nodes=manifest.nodes, inner=manifest.nodes.where("kids is not null")))
    finally:
        spark.conf.set(limit, before)

    def text(digest: Column) -> Column:
        return F.lower(F.hex(digest))

    own, last = F.col("steps")[0], F.element_at("steps", -1)
    subroot = F.filter("steps", lambda x: x["mark"])[0]["original"]
    proof = F.array_join(F.transform(F.filter("steps", lambda x: x["step"] > 0), lambda x: text(x["siblings"])), "")
    return steps.select(
        own["doc_id"].alias("doc_id"), text(own["original"]).alias("leaf"), text(subroot).alias("subroot"), text(last["original"]).alias("root"),
        F.sha2(proof, 256).alias("proof_sha256"), text(last["folded"]).alias("folded_root"),
        (last["folded"] == last["original"]).alias("verified"))
