"""Files and folders of any store that Spark reaches, and small texts that are replaced by one rename."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, store = _store(spark, path)
    return store.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, store = _store(spark, path)
    store.delete(p, True)


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder with their times of change; nothing for a folder that is not there."""
    p, store = _store(spark, path)
    return [(f.getPath().getName(), f.getModificationTime()) for f in store.listStatus(p)] if store.exists(p) else []


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Every file at or below a path: place, bytes, time of change, in order of place."""
    p, store = _store(spark, path)
    found, walk = [], store.listFiles(p, True)
    while walk.hasNext():
        f = walk.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, put in place by one rename: a reader finds the old text or the new one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, draft = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    conf = spark._jsc.hadoopConfiguration()
    out = target.getFileSystem(conf).create(draft, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    replace = spark._jvm.java.lang.reflect.Array.newInstance(hadoop.Options.Rename.OVERWRITE.getClass(), 1)
    replace[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, replace)


def get_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def prune(spark: SparkSession, root: str, prefix: str, keep: Iterable[str]) -> None:
    """Removes the folders of ``root`` whose names begin with ``prefix``, but for those to keep."""
    kept = set(keep)
    for name, _ in children(spark, root):
        if name.startswith(prefix) and name not in kept:
            remove(spark, f"{root}/{name}")
