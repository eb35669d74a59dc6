"""Helpers the operators share: staged tables, word arrays, distributed ranks."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.sources import folders

SPACE = r"[\x20\x09-\x0D]+"  # what separates words
BLOCK_BYTES = 8 << 20  # text one vectorised step works on


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. In local mode, where
    driver and executors are one process, a fresh folder is set if none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wardflow-llm-"))
    return context.getCheckpointDir()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the lineage,
    and a lost executor costs a re-read instead of a recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@functools.lru_cache(maxsize=1)
def remembered(make: Callable[[str], object], path: str):
    """``make(path)``, kept by a Python worker for its next tasks. Workers outlive a stage: only
    one thing is kept, so what an operator has gathered is gone once another one has begun."""
    return make(path)


class Scratch:
    """Staged tables of one job, by name. Writing a name again deletes the table it named
    before, once the new one is there; so rounds that replace their tables take no more disk."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}
        self.folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                folders.delete(self.spark, self.paths.pop(name))


def stage_by(df: DataFrame, key: str) -> DataFrame:
    """Write ``df`` as a table bucketed by ``key``: what is grouped or joined by the key later
    on reads it as it lies, and only the other side is shuffled."""
    spark = df.sparkSession
    name = f"llm_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").option("compression", "zstd").option("path", f"{shared_folder(spark)}/{name}")
    writer.bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns an operator is about to add (its own replace them)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Array of the words of a text; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by`` (a NULL id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(by))


def blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // size)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(sizes)], strict=True):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def split_words(texts: pa.Array, lower: bool) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in order, and the number of words of each text."""
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, n = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    real = pc.greater(pc.binary_length(flat), 0)
    owner = np.repeat(np.arange(len(n)), n)[real.to_numpy(zero_copy_only=False)]
    return flat.filter(real), np.bincount(owner, minlength=len(n))


def coded_words(texts: pa.Array, lower: bool) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words as codes into the distinct words; those; the number of words of each text."""
    flat, n = split_words(texts, lower)
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, n


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixer, vectorised (the finaliser of a public hash)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], cell: Column, amount: str, out: str) -> DataFrame:
    """Exclusive running sum of ``amount`` within ``keys`` by ``order``, without ever
    bringing a key's rows into one task: sums of cells first, then within each cell.
    ``cell`` must not decrease along ``order`` and should cut a large key into many."""
    cut = df.withColumn("_cell", cell)
    per_cell = cut.groupBy(*keys, "_cell").agg(F.sum(amount).alias("_amount"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    per_cell = per_cell.select(*keys, "_cell", F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    on = None
    left, right = cut.alias("a"), per_cell.alias("b")
    for k in [*keys, "_cell"]:
        same = F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        on = same if on is None else on & same
    return left.join(right, on).select("a.*", (F.col("b._before") + F.col("a._inside")).alias(out)).drop("_cell", "_inside")
