"""Small helpers on the shared file system Spark itself uses."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none if it does not exist."""
    fs, p = _open(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def markers(spark: SparkSession, path: str, pattern: str) -> list[tuple[str, str]]:
    """(folder, file) names of the marker files in the folders below ``path``."""
    fs, _ = _open(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*/{pattern}"))
    paths = [status.getPath() for status in found or []]
    return [(p.getParent().getName(), p.getName()) for p in paths]


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, p = _open(spark, path)
    fs.create(p, True).close()


def make(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def stage_folder(spark: SparkSession, root: str) -> str:
    """Where intermediate tables of the warehouse at ``root`` are written: the
    shared folder the cluster names for checkpoints, else the warehouse itself."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        return f"{root}/_stage"
    return f"{shared.rstrip('/')}/wardflow-{hashlib.sha256(root.encode()).hexdigest()[:16]}"
