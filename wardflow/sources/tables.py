"""Keyed tables on plain Parquet, written one change set at a time.

Parquet has no MERGE, and rewriting a table of terabytes for every small batch
is out of the question. A table is therefore a folder of immutable *segments*
``_segment=<low>-<high>``, each the outcome of the loads numbered low to high, and a
load adds one segment holding only the rows it inserted or changed.

* A segment counts once its marker file is there, which is written last. So
  readers never see half a load, and a retried load rewrites its own segment.
* A changed row is stored as a full new image flagged as an update; the older
  image of its key no longer counts. Inserts supersede nothing.
* The marker says how many updates the segment holds. Readers thus know, before
  running anything, how many rows can supersede others: none means a plain
  union of scans, up to ``BROADCAST_ROWS`` means these keys are broadcast and
  the table is not shuffled, and only beyond that both sides are.
* A segment is partitioned by a hash of the key and sorted by key in each file, so
  a small batch opens only the partitions its keys are in and, where its keys lie
  close together, only the row groups around them.
* ``fold`` combines many segments of single loads into one, rows keeping the number
  of their load. It writes a fresh base when updates have outgrown both the bound
  above and a share of the table, or when combined segments have become many.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.sources import folders

SEQUENCE = "_seq"
UPDATE = "_update"
SEGMENT = "_segment"
BUCKET = "_bucket"
BUCKETS = 32
BROADCAST_ROWS = 1_000_000  # keys of 8 bytes: some tens of MB once hashed
COMPRESSION = "zstd"
ROW_GROUP = {"parquet.block.size": str(16 << 20)}  # a scan splits no row group, and a usual one holds millions of these rows
FOLD_SHARE = 0.2  # updates beyond this share of the segments' rows call for a new base
FOLD_COUNT = 64  # segments of single loads that are combined into one, and such that call for a base


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True, order=True)
class Segment:
    low: int
    high: int
    rows: int = field(default=0, compare=False)
    updates: int = field(default=0, compare=False)

    @property
    def name(self) -> str:
        return f"{SEGMENT}={self.low}-{self.high}"


@dataclass(frozen=True)
class Reach:
    """The part of a table a batch can touch: a key range, the buckets of its keys
    and, if the batch is small, its keys themselves (at most ``BROADCAST_ROWS``,
    counted)."""

    low: int | None
    high: int | None
    keys: DataFrame | None = None
    buckets: tuple[int, ...] | None = None

    def narrow(self, rows: DataFrame, key: str) -> DataFrame:
        """Buckets prune files and the range row groups; the keys are matched in the
        scan stage itself, so what is left to shuffle is no larger than the batch."""
        if self.low is None:
            return rows.where(F.lit(False))
        near = rows.where(F.col(key).between(self.low, self.high))
        if self.buckets is not None:
            near = near.where(F.col(BUCKET).isin(*self.buckets))
        if self.keys is None:
            return near
        wanted = F.broadcast(self.keys.toDF("_wanted"))
        return near.join(wanted, F.col(key) == F.col("_wanted"), "left_semi")


@dataclass
class SegmentedTable:
    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    broadcast_rows: int = BROADCAST_ROWS
    buckets: int = BUCKETS

    def committed(self) -> set[Segment]:
        found = set()
        for folder, marker in folders.markers(self.spark, self.path, "_rows-*"):
            low, high = folder.removeprefix(f"{SEGMENT}=").split("-")
            rows, updates = marker.removeprefix("_rows-").split("-")
            found.add(Segment(int(low), int(high), int(rows), int(updates)))
        return found

    def live(self, before: int | None = None) -> list[Segment]:
        """Segments that make up the table, oldest first: from the newest load
        backwards the widest one each time. ``before`` gives the state a load
        saw when it started, also after later loads or folds."""
        chosen: list[Segment] = []
        for segment in sorted(self.committed(), key=lambda s: (-s.high, s.low)):
            if before is not None and segment.high >= before:
                continue
            if not chosen or segment.high < chosen[-1].low:
                chosen.append(segment)
        return chosen[::-1]

    def last(self) -> int:
        return max((s.high for s in self.committed()), default=0)

    def scan(self, segments: list[Segment], reach: Reach | None = None) -> DataFrame:
        own = [(SEQUENCE, T.LongType()), (UPDATE, T.BooleanType()), (SEGMENT, T.StringType()), (BUCKET, T.IntegerType())]
        stored = T.StructType([*self.schema.fields, *[T.StructField(*column) for column in own]])
        if not segments:
            return self.spark.createDataFrame([], stored)
        rows = self.spark.read.schema(stored).option("basePath", self.path).parquet(*[f"{self.path}/{s.name}" for s in segments])
        return rows if reach is None else reach.narrow(rows, self.key)

    def _images(self, segments: list[Segment], reach: Reach | None = None) -> DataFrame:
        """Rows that no later update supersedes."""
        rows = self.scan(segments, reach)
        updates = sum(s.updates for s in segments)
        if not updates:
            return rows
        newer = self.scan([s for s in segments if s.updates], reach).where(UPDATE)
        newer = newer.select(F.col(self.key).alias("_key"), F.col(SEQUENCE).alias("_newer"))
        if updates <= self.broadcast_rows:
            newer = F.broadcast(newer)
        superseded = (F.col(self.key) == F.col("_key")) & (F.col("_newer") > F.col(SEQUENCE))
        return rows.join(newer, superseded, "left_anti")

    def read(self, before: int | None = None, reach: Reach | None = None) -> DataFrame:
        return self._images(self.live(before), reach).select(*self.schema.names)

    def keys(self, before: int | None = None, reach: Reach | None = None) -> DataFrame:
        """Every key once: each was inserted exactly once, so nothing is shuffled."""
        return self.scan(self.live(before), reach).where(~F.col(UPDATE)).select(self.key)

    def stored_rows(self, before: int | None = None) -> int:
        """Rows the markers state, updates included: no fewer than there are keys."""
        return sum(s.rows for s in self.live(before))

    def is_empty(self, before: int | None = None) -> bool:
        return not self.stored_rows(before)

    def write(self, rows: DataFrame, sequence: int) -> Segment:
        """Add the change set of load ``sequence``; a retry replaces it. A boolean
        column ``_update``, if present, tells new images from inserts."""
        return self._write(rows, Segment(sequence, sequence))

    def replace(self, rows: DataFrame, sequence: int) -> Segment:
        """Make ``rows`` the whole table as of load ``sequence``."""
        return self._write(rows.drop(SEQUENCE, UPDATE), Segment(0, sequence))

    def copy(self, rows: DataFrame, segment: Segment) -> Segment:
        """Store rows derived one to one from another table's segment, whose files
        already hold a bucket each: they are not gathered again."""
        return self._write(rows, segment, gathered=True)

    def _write(self, rows: DataFrame, segment: Segment, *, gathered: bool = False) -> Segment:
        update = F.col(UPDATE) if UPDATE in rows.columns else F.lit(False)
        sequence = F.col(SEQUENCE) if SEQUENCE in rows.columns else F.lit(segment.high).cast("bigint")
        bucket = bucket_of(F.col(self.key), self.buckets).alias(BUCKET)
        stored = rows.select(*self.schema.names, sequence.alias(SEQUENCE), update.alias(UPDATE), bucket)
        if self.buckets > 1:
            # Gathered by bucket, large buckets in several tasks: few files, each sorted by key.
            if not gathered:
                stored = stored.hint("rebalance", F.col(BUCKET))
            stored = stored.sortWithinPartitions(BUCKET, self.key)
        counts = Observation()
        stored = stored.observe(
            counts, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(UPDATE)).alias("updates")
        )
        folder = f"{self.path}/{segment.name}"
        if self.buckets > 1:
            stored.write.mode("overwrite").options(compression=COMPRESSION, **ROW_GROUP).partitionBy(BUCKET).parquet(folder)
        else:  # nothing to sort by, and every task's rows stay where they are
            folders.delete(self.spark, folder)
            stored.drop(BUCKET).write.options(compression=COMPRESSION, **ROW_GROUP).parquet(f"{folder}/{BUCKET}=0")
        done = Segment(segment.low, segment.high, counts.get["rows"], counts.get["updates"])
        folders.touch(self.spark, f"{folder}/_rows-{done.rows}-{done.updates}")
        return done

    def fold(self, share: float = FOLD_SHARE, count: int = FOLD_COUNT) -> Segment | None:
        """Combine segments if that is due; returns the new one."""
        segments = self.live()
        updates, rows = sum(s.updates for s in segments), sum(s.rows for s in segments)
        combined = sum(0 < s.low < s.high for s in segments)
        if (updates > self.broadcast_rows and updates > share * rows) or combined >= count:
            return self.replace(self._images(segments), segments[-1].high)
        tail: list[Segment] = []
        for segment in reversed(segments):
            if segment.low != segment.high:
                break
            tail.insert(0, segment)
        if len(tail) < count:
            return None
        # Rows keep their load number, so they still supersede older images of their keys.
        return self._write(self._images(tail), Segment(tail[0].low, tail[-1].high))

    def prune(self) -> list[Segment]:
        """Delete segments that neither the table nor a retry of its last load needs."""
        needed = set(self.live()) | set(self.live(before=self.last()))
        unused = sorted(self.committed() - needed)
        for segment in unused:
            folders.delete(self.spark, f"{self.path}/{segment.name}")
        return unused
