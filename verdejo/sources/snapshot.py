"""Inputs of a run, pinned: the files as they were found, read by every step, and looked at again before publication."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .files import listing

FILES = T.StructType([T.StructField("tabela", T.StringType()), T.StructField("arquivo", T.StringType()),
                      T.StructField("bytes", T.LongType()), T.StructField("alterado_em", T.LongType())])


class InputsChanged(RuntimeError):
    pass


def _data(place: str) -> bool:
    name = place.rsplit("/", 1)[-1]
    return not name.startswith(("_", "."))


@dataclass(frozen=True)
class Snapshot:
    """Per table its folder and its files: place, bytes, time of change."""

    paths: Mapping[str, str]
    files: Mapping[str, tuple[tuple[str, int, int], ...]]

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Readers of exactly these files; a file that comes later is not seen. An empty folder is read for its schema's sake."""
        return {t: spark.read.option("basePath", self.paths[t]).parquet(*[f for f, _, _ in files]) if files else spark.read.parquet(self.paths[t])
                for t, files in self.files.items()}

    def as_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(t, *f) for t, files in self.files.items() for f in files], FILES)

    def changes(self, spark: SparkSession) -> list[str]:
        """What is no longer as it was found: files that are gone, replaced, grown or new."""
        out = []
        for t, path in self.paths.items():
            before, now = {f: rest for f, *rest in self.files[t]}, {f: rest for f, *rest in _files(spark, path)}
            out += [f"{t}: {f} {'sumiu' if f not in now else 'e novo' if f not in before else 'mudou'}"
                    for f in sorted({*before, *now}) if before.get(f) != now.get(f)]
        return out

    def guard(self, spark: SparkSession) -> Callable[[], None]:
        """A step before the switch to a new version: it raises if any input changed meanwhile."""
        def check() -> None:
            if changed := self.changes(spark):
                raise InputsChanged("entradas alteradas durante a carga: " + "; ".join(changed))
        return check


def _files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    return [f for f in listing(spark, path) if _data(f[0])]


def pin(spark: SparkSession, paths: Mapping[str, str]) -> Snapshot:
    return Snapshot(dict(paths), {t: tuple(_files(spark, path)) for t, path in paths.items()})
