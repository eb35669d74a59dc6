"""Landing to silver: consume new rows, validate, log, deduplicate, merge."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardflow.domains import DOMAINS, SOURCE_FILE, SOURCE_MODIFIED, Domain
from wardflow.functions.casts import try_key
from wardflow.functions.sizing import at_most, planned_bytes, setting, shuffle_partitions
from wardflow.operators import rules
from wardflow.operators.dedup import latest_per_key
from wardflow.operators.merge import merge_changes
from wardflow.sources import folders
from wardflow.sources.exception_log import write_exceptions
from wardflow.sources.tables import BROADCAST_ROWS, BUCKETS, COMPRESSION, ROW_GROUP, Reach, bucket_of
from wardflow.sources.warehouse import LOADS_PER_GENERATION, Warehouse

LANDED_FILE = "landed_file"
ADAPTIVE = "spark.sql.adaptive.enabled"
SPLIT = "spark.sql.files.maxPartitionBytes"
ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARTITIONS = "spark.sql.shuffle.partitions"
SMALL_SPLIT = 8 << 20  # compressed tables: what a task sorts before a shuffle fits its memory
SMALL_SHARE = 16 << 20  # the same after a shuffle, which packs rows less
SHARE_STORED = 2 << 20  # stored bytes of a batch for each partition of its shuffles


@dataclass
class LoadReport:
    domain: str
    status: str
    counts: dict[str, int] = field(default_factory=dict)


@contextmanager
def small_splits(session: SparkSession, size: int = 0) -> Iterator[None]:
    """The landing tables and segments pack a row into 10 to 30 bytes. A task that sorts the
    rows of a usual split would spill, the more the larger the table; smaller splits do not.
    Nor does a task behind a shuffle, if partitions grow with the stored bytes (``size``) and
    not with the cores; Spark's re-planning makes of many small ones as few as are due."""
    partitions = shuffle_partitions(session, size, SHARE_STORED)
    with at_most(session, SPLIT, SMALL_SPLIT), at_most(session, ADVISED, SMALL_SHARE), setting(session, PARTITIONS, str(partitions)):
        yield


@contextmanager
def adaptive(session: SparkSession, size: int = 0) -> Iterator[None]:
    """Streams run in a session of their own in which runtime re-planning is off.
    The work inside a batch is ordinary batch work and wants it on."""
    with setting(session, ADAPTIVE, "true"), small_splits(session, size):
        yield


def outcomes() -> list[Column]:
    """Counts of judged rows per outcome."""
    ok1, ok2 = F.col(rules.TYPED_OK), F.col(rules.BUSINESS_OK)
    return [
        F.count_if(ok1 & ok2).alias(rules.ACCEPTED),
        F.count_if(~ok1).alias(rules.DATA_ERROR),
        F.count_if(ok1 & ~ok2).alias(rules.BUSINESS_ERROR),
    ]


def measure(rows: DataFrame, columns: list[str], *counts: Column, with_buckets: bool = True) -> dict[str, int]:
    """Row count, smallest and largest key of every column and, if asked to, the buckets its
    keys are in (a few dozen at most), and further counts: one aggregate over a few columns."""
    keys = {c: try_key(F.col(c)) for c in columns}
    ends = [f(k).alias(f"{f.__name__}_{c}") for c, k in keys.items() for f in (F.min, F.max)]
    buckets = []
    if with_buckets:
        buckets = [F.collect_set(F.when(k.isNotNull(), bucket_of(k, BUCKETS))).alias(f"buckets_{c}") for c, k in keys.items()]
    return rows.agg(F.count(F.lit(1)).alias("rows"), *ends, *buckets, *counts).first().asDict()


def reach_of(rows: DataFrame, columns: list[str], seen: dict[str, int], small_batch: int) -> dict[str, Reach]:
    """Per column, what of the table it points to the measured rows can touch."""
    reach = {}
    for c in columns:
        keys = None
        if seen["rows"] <= small_batch:
            keys = rows.select(try_key(F.col(c)).alias(c)).where(F.col(c).isNotNull()).distinct()
        buckets = tuple(sorted(seen[f"buckets_{c}"])) if f"buckets_{c}" in seen else None
        reach[c] = Reach(seen[f"min_{c}"], seen[f"max_{c}"], keys, buckets)
    return reach


def load_batch(
    wh: Warehouse,
    domain: Domain,
    batch: DataFrame,
    sequence: int,
    *,
    strict: bool = False,
    log_time: Column | None = None,
    small_batch: int = BROADCAST_ROWS,
    **lookup_options,
) -> dict[str, int]:
    """Load one set of landing rows as load number ``sequence``.

    The tables may be any number of times larger than the batch. A batch of up
    to ``small_batch`` rows never makes them shuffle: its keys are broadcast to
    the scans of the parents and of the target. A larger one is joined to them
    by shuffles, but to parents of no more rows than that (their markers tell) by a
    broadcast of their keys; hot references are split by Spark's adaptive skew join.

    Repeating a load with the same number gives the same tables: the log folder
    and the segment are replaced, and the merge looks at the state before it.
    """
    now = F.current_timestamp().cast("timestamp_ntz") if log_time is None else log_time
    ties = (SOURCE_MODIFIED, SOURCE_FILE)
    rows = batch.select(*domain.column_names, "load_time", *ties)
    silver = wh.silver_table(domain.name)
    columns = [domain.key, *(fk.column for fk in domain.foreign_keys)]
    staged_path = None

    if domain.has_business_rules:
        # The keys of a large batch are in every bucket.
        seen = measure(rows, columns, with_buckets=rows.count() <= small_batch)
        reach = reach_of(rows, columns, seen, small_batch)
        parent_tables = {fk.parent: wh.silver_table(fk.parent) for fk in domain.foreign_keys}
        judged = rules.judge(
            rows,
            domain,
            {fk.parent: parent_tables[fk.parent].keys(reach=reach[fk.column]) for fk in domain.foreign_keys},
            strict=strict,
            parents_unique=True,
            parents_small={
                fk.parent: reach[fk.column].keys is not None or parent_tables[fk.parent].stored_rows() <= small_batch
                for fk in domain.foreign_keys
            },
            parents_empty={name: table.is_empty() for name, table in parent_tables.items()},
            **lookup_options,
        )
        # The lookups are the costly part and both outputs need them, so their
        # result is written once, typed, to shared storage. Lost executors then
        # cost a re-read, not the joins. Not split by verdict: that would sort all
        # rows. The outcomes are counted as the rows are written, where a repeated
        # task counts once.
        staged_path = f"{folders.stage_folder(wh.spark, wh.root)}/{domain.name}-{sequence}"
        counts = Observation()
        staged_rows = rules.to_stage(rules.with_verdict(judged.observe(counts, *outcomes())), domain, *ties)
        staged_rows.write.mode("overwrite").options(compression=COMPRESSION, **ROW_GROUP).parquet(staged_path)
        seen |= counts.get
        staged = wh.spark.read.schema(staged_rows.schema).parquet(staged_path)
        logged = staged.select(rules.VERDICT, F.col(rules.RECORD).alias(domain.key))
        exceptions = rules.staged_exceptions(logged, domain, now)
        accepted = staged.where(F.col(rules.VERDICT) == rules.ACCEPTED).drop(rules.VERDICT, rules.RECORD)
    else:
        # Level 1 only: testing the rows again is cheaper than writing them out.
        judged = rules.judge(rows, domain, strict=strict)
        seen = measure(judged, columns, *outcomes())
        reach = reach_of(rows, columns, seen, small_batch)
        exceptions = rules.data_errors(judged, domain, now)
        accepted = rules.typed(rules.select_accepted(rows, domain), domain, *ties)

    write_exceptions(exceptions, wh.exceptions_path, domain, sequence)
    newest = latest_per_key(accepted, domain.key, ties=ties).drop(*ties)
    find = silver.read if domain.update_columns else silver.keys
    target = find(before=sequence, reach=reach[domain.key])
    silver.write(merge_changes(target, newest, domain.key, domain.update_columns), sequence)
    silver.fold()
    if staged_path:
        folders.delete(wh.spark, staged_path)

    settled = {v: seen[v] for v in (rules.ACCEPTED, rules.DATA_ERROR, rules.BUSINESS_ERROR)}
    return {"rows": seen["rows"], **settled, rules.DROPPED: seen["rows"] - sum(settled.values())}


def load_domain(wh: Warehouse, name: str, *, strict: bool = False, **options) -> LoadReport:
    """Load all landing rows that arrived since the last load of this domain.

    All new rows form one batch, so the newest row per key is picked among all
    of them. Pass ``max_files`` to bound a batch instead.

    A batch of a stream is its rows, every column, read anew by each look at it. So the
    stream only tells the new files, and the load reads of them what each step needs.
    """
    domain = DOMAINS[name]
    max_files = options.pop("max_files", None)
    totals: dict[str, int] = {}
    first = wh.generation(name) * LOADS_PER_GENERATION + 1
    landing = wh.landing_path(name)

    def consume(batch: DataFrame, batch_id: int) -> None:
        sequence = first + batch_id
        session = batch.sparkSession
        with adaptive(session):
            names = sorted(row[0] for row in batch.distinct().collect())
        files = [f"{landing}/{f.rsplit('/', 1)[-1]}" for f in names]
        schema = domain.landing_schema()
        rows = session.read.schema(schema).parquet(*files) if files else session.createDataFrame([], schema)
        with adaptive(session, planned_bytes(rows)):
            # Staged rows and tables are read in the session of the batch, too, whose settings these are.
            outcome = load_batch(replace(wh, spark=session), domain, rows, sequence, strict=strict, **options)
        wh.note_consumed(session.createDataFrame([(f,) for f in names], f"{LANDED_FILE} string"), name, sequence)
        for verdict, n in outcome.items():
            totals[verdict] = totals.get(verdict, 0) + n

    if wh.has_landed(name):
        reader = wh.spark.readStream.schema(domain.landing_schema())
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        feed = reader.parquet(landing)
        query = (
            feed.select(F.col("_metadata.file_path").alias(LANDED_FILE))
            .writeStream.foreachBatch(consume)
            .queryName(f"load_{name}")
            .option("checkpointLocation", wh.checkpoint("load", name))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    if not totals.get("rows") and domain.no_data is not None:
        return LoadReport(name, domain.no_data)
    return LoadReport(name, domain.loaded, totals)
