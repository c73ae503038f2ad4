"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import Lock
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even when the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join on (order, item) keeps the layout by order that a join before it left; a huge order is split there.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app: str = "verdejo", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Turns on skew handling and kept layouts in a session that someone else has built."""
    for key in SETTINGS:
        if key.startswith("spark.sql.adaptive.") or key.endswith("ForCoPartition"):
            spark.conf.set(key, SETTINGS[key])


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="verdejo-")
        spark.conf.set("spark.checkpoint.dir", root)
        return root
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


Item = TypeVar("Item")
JOBS_AT_ONCE = 6


def together(work: Callable[[Item], object], items: Iterable[Item]) -> list:
    """Submit independent jobs from a few threads, so a small one does not wait for a large one."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        return list(pool.map(work, items))


class Lazy(Mapping):
    """Tables by name, each built when it is first asked for and only once, whichever thread asks.

    ``keep`` gets name and table and returns what is handed out. A builder may ask for other tables of the same mapping,
    as long as no circle of them arises.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]], keep: Callable[[str, DataFrame], DataFrame] | None = None):
        self.builders, self.done = dict(builders), {}
        self.keep = keep or (lambda name, df: df)
        self.locks = {name: Lock() for name in self.builders}

    def __getitem__(self, name: str) -> DataFrame:
        with self.locks[name]:
            if name not in self.done:
                self.done[name] = self.keep(name, self.builders[name]())
            return self.done[name]

    def __contains__(self, name: object) -> bool:
        return name in self.builders

    def __iter__(self) -> Iterator[str]:
        return iter(self.builders)

    def __len__(self) -> int:
        return len(self.builders)

    def all(self) -> dict[str, DataFrame]:
        """Every table, built from a few threads."""
        return dict(zip(self, together(self.__getitem__, self)))


class Workspace:
    """Intermediate tables written once and read back.

    A written table fixes what an expensive or non-repeatable step produced, so
    later jobs and retries after a lost executor all see the same rows, and the
    optimizer sees its true size when it chooses a join.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_root(spark)}/verdejo-{uuid.uuid4().hex}"

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def discard(self) -> None:
        """Removes the intermediate tables of this workspace."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def keep_all(self, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        names = list(tables)
        return dict(zip(names, together(lambda n: self.keep(n, tables[n]), names)))
