"""Resolving free-text places to a register: names first, then a curated table, then distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import Grid, haversine_km

RADIUS_KM = 50.0  # fixed value: farther centroids are not accepted


def unique_keys(register: DataFrame, block: str, key: str, code: str) -> DataFrame:
    """(block, key) -> code, only for keys that name one place of the block."""
    return (register.groupBy(block, key)
            .agg(F.count(F.lit(1)).alias("_n"), F.min(code).alias(code))
            .filter("_n = 1").drop("_n"))


def match_names(rows: DataFrame, register: DataFrame, *, block: str, name: str, key: str,
                code: str, out_name: str, out_key: str) -> DataFrame:
    """Adds ``out_name`` (equal name in the block) and ``out_key`` (equal unique tight key).

    ``out_key`` is only set where the name found nothing.
    """
    by_name = register.select(F.col(block).alias("_nb"), F.col(name).alias("_nn"), F.col(code).alias(out_name))
    by_key = unique_keys(register, block, key, code).select(
        F.col(block).alias("_kb"), F.col(key).alias("_kk"), F.col(code).alias("_kc"))
    named = rows.join(by_name, (F.col(block) == F.col("_nb")) & (F.col(name) == F.col("_nn")), "left").drop("_nb", "_nn")
    # A settled row keeps its own key and only fails the condition: no empty key gathers rows, and nothing is read twice.
    return named.join(by_key, (F.col(block) == F.col("_kb")) & (F.col(key) == F.col("_kk")) & F.col(out_name).isNull(), "left"
                      ).withColumnRenamed("_kc", out_key).drop("_kb", "_kk")


def nearest_within(probes: DataFrame, targets: DataFrame, *, block: str, code: str,
                   radius_km: float = RADIUS_KM) -> DataFrame:
    """Nearest target of the same block within the radius, ties by code.

    Both frames carry ``block, latitude, longitude``; targets also ``code``. A grid
    as wide as the radius limits the pairs to neighbouring cells, and the nearest
    one is a partial aggregate.
    """
    grid = Grid(radius_km)
    ids = [c for c in probes.columns if c not in ("latitude", "longitude")]
    lat, lng = F.col("latitude"), F.col("longitude")
    spots = (probes.filter(lat.isNotNull() & lng.isNotNull())
             .withColumn("_cell", F.explode(grid.around(lat, lng)))
             .select("*", "_cell.band", "_cell.cell").drop("_cell"))
    placed = targets.filter(lat.isNotNull() & lng.isNotNull()).select(
        F.col(block).alias("_block"), F.col(code).alias("_code"),
        lat.alias("_lat"), lng.alias("_lng"), grid.band(lat).alias("_band"))
    placed = placed.withColumn("_cell", grid.cell(F.col("_band"), F.col("_lng")))
    pairs = spots.join(placed, (F.col(block) == F.col("_block")) & (F.col("band") == F.col("_band"))
                       & (F.col("cell") == F.col("_cell")))
    km = haversine_km(lat, lng, F.col("_lat"), F.col("_lng"))
    return (pairs.select(*ids, F.struct(km.alias("km"), F.col("_code").alias("code")).alias("_hit"))
            .filter(F.col("_hit.km") <= radius_km)
            .groupBy(*ids).agg(F.min("_hit").alias("_hit"))
            .select(*ids, F.col("_hit.code").alias(code), F.col("_hit.km").alias("distancia_km")))
