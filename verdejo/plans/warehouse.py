"""The layers of one source folder. Each stage hands over written tables, as the pipeline does, but writes only those that are asked for."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import Lazy, Workspace, tune
from . import gold, integration, silver, testbed

Tables = Mapping[str, DataFrame]


class Warehouse:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.ws = spark, folder, Workspace(spark)

    @cached_property
    def raw(self) -> Tables:
        return testbed.raw_tables(self.spark, self.folder)

    @cached_property
    def silver(self) -> Lazy:
        return Lazy(silver.builders(self.raw), self.ws.keep)

    @cached_property
    def places(self) -> Lazy:
        """Reference, centroids, crosswalk and both entity maps."""
        return integration.places(self.silver, lambda: self.raw["de_para"], self.ws)

    @cached_property
    def integrated(self) -> Lazy:
        return Lazy(integration.output_builders(self.silver, self.places), self.ws.keep)

    @property
    def contract(self) -> Tables:
        return ChainMap(self.integrated, self.silver)

    @cached_property
    def gold(self) -> Lazy:
        return gold.star(self.contract, self.ws)


_OPEN: dict[tuple[str, str], Warehouse] = {}


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """One warehouse per session and folder; later queries read the tables it wrote."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        tune(spark)
        _OPEN[key] = Warehouse(spark, folder)
    return _OPEN[key]
