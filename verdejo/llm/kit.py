"""What the operators share: keys of rows, written intermediates, calls into Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import Workspace


class Scratch(Workspace):
    """Tables written to the shared folder once and read back; each can be removed when no plan needs it any more."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark)
        self.paths: dict[str, str] = {}

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        self.paths[name] = path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, self.paths.pop(name))


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def row_key(*columns: str) -> Column:
    """A key of a row by its values: rows that repeat share it, nulls have one too."""
    return F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns))


def rows_by(docs: DataFrame, key: Column) -> DataFrame:
    """``_row``, a whole row of ``docs``, and ``_key``; ``select("_row.*")`` gives the rows back, whatever their columns are called."""
    return docs.select(F.struct(*docs.columns).alias("_row"), key.alias("_key"))


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], ddl: str) -> DataFrame:
    """``mapInArrow`` for a function that yields dictionaries of columns."""
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(batches):
            arrays = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, type=f.type)
                      for f in schema for x in [out[f.name]]]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)
    return df.mapInArrow(run, ddl)


def signed(x):
    """Unsigned hashes as Spark longs."""
    return x.view("int64")
