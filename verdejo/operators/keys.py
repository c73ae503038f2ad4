"""Dense numbers over a total order, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import Workspace

_ROW_BITS = (1 << 33) - 1  # the low bits of monotonically_increasing_id count rows of a partition


def dense_ids(df: DataFrame, order: Sequence[str], name: str, ws: Workspace, start: int = 1) -> DataFrame:
    """Number rows ``start, start+1, ...`` by ``order`` (ascending, NULLs last).

    Rows are range partitioned and sorted, written once so that the partition
    layout is fixed, then shifted by the row counts of the partitions before.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    placed = (df.repartitionByRange(*by).sortWithinPartitions(*by)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))))
    placed = ws.keep(f"ids-{name}", placed)
    return _shift(placed, "_part").select(
        (F.col("_shift") + F.col("_row") + start).cast("int").alias(name), *df.columns)


def lasting_ids(df: DataFrame, natural: Sequence[str], name: str, ws: Workspace, published: DataFrame | None = None) -> DataFrame:
    """Numbers that stay when the data grow: rows found in ``published(natural..., name)`` keep their number, the others follow the highest.

    ``natural`` is unique in both; its values may be null. Without ``published`` this is ``dense_ids``. A published
    number is never given again, also when its row is gone, so ``published`` has to hold all numbers ever given.
    """
    if published is None:
        return dense_ids(df, natural, name, ws)
    old = {c: f"_known{i}" for i, c in enumerate(natural)}
    known = published.select(*(F.col(c).alias(o) for c, o in old.items()), F.col(name).alias(name))
    same = F.lit(True)
    for c, o in old.items():
        same = same & F.col(c).eqNullSafe(F.col(o))
    # Written once, so that the kept and the new rows come from one reading.
    met = ws.keep(f"known-{name}", df.join(known, same, "left").select(F.col(name), *df.columns))
    last = published.agg(F.max(name)).first()[0] or 0
    fresh = dense_ids(met.filter(F.col(name).isNull()).drop(name), natural, name, ws, last + 1)
    return met.filter(F.col(name).isNotNull()).unionByName(fresh)


def all_ids(df: DataFrame, natural: Sequence[str], name: str, published: DataFrame | None = None) -> DataFrame:
    """The numbers ever given: the published ones and those of new rows."""
    now = df.select(*natural, name).filter(F.col(name) > 0)
    if published is None:
        return now
    known = published.select(F.col(name).alias("_taken"))
    return published.select(*natural, name).unionByName(now.join(known, F.col(name) == F.col("_taken"), "left_anti"))


def file_blocks(scan: DataFrame) -> DataFrame:
    """``(_path, _start, _first, _n, _before)``: a row for each block of each file that the scan reads."""
    before = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    return _placed(scan).groupBy("_path", "_start").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def _placed(scan: DataFrame) -> DataFrame:
    return scan.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"),
                       F.monotonically_increasing_id().alias("_id"))


def file_record_numbers(scan: DataFrame, name: str, blocks: DataFrame | None = None) -> DataFrame:
    """1..N per file in file order, for a scan of any layout: many files, equal base names, split files.

    A record's number is its place in its block of the file, after the records of the blocks before. The
    scan runs twice: once to count the records of each block, once for the rows. Both deal out the same
    blocks to the same partitions, since that depends on the files and the settings alone. Adds ``_path``.

    ``blocks`` are the scan's ``file_blocks`` as written. Spark then knows their size, and sends them to
    the rows as long as they are small (a row of about 100 bytes for each block), so that no row moves.
    """
    blocks = file_blocks(scan) if blocks is None else blocks
    return _placed(scan).join(blocks, ["_path", "_start"]).select(
        *scan.columns, "_path", (F.col("_id") - F.col("_first") + F.col("_before") + 1).alias(name))


def _shift(placed: DataFrame, part: str) -> DataFrame:
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_size"))
    # One row per shuffle partition: bounded by the partition count, not by the data.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(part, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    return placed.join(F.broadcast(shifts), part)
