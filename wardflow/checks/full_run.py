"""The streaming pipeline end to end on the given tables.

Spark writes the derived landing rows as CSV drops, the pipeline ingests and
loads them, and the resulting tables are what the ``pipeline_*`` queries read.
Admissions arrive in two parts, so that their time of arrival decides which row
of a key is the latest; all domains are delivered a second time. What can only be
seen on the way (rows waiting, times of arrival, the status of every run, a reset)
is noted in a journal. One run per session and data set serves all queries.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.checks import derive
from wardflow.domains import DOMAINS
from wardflow.sources.csv_drop import CSV_FORMAT, file_inventory
from wardflow.sources.warehouse import Warehouse
from wardflow.streaming.ingest import ingest_available
from wardflow.streaming.loads import load_domain
from wardflow.streaming.pipeline import RunReport, refresh_dimensions, run_pipeline, start_schedule

_RUNS: dict[tuple[str, str], tuple[Warehouse, RunReport, Journal]] = {}


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the one ``spark.checkpoint.dir`` names. Only in local mode,
    where driver and executors share every folder, may it be unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="wardflow-")
    return f"{shared.rstrip('/')}/wardflow-checks-{uuid.uuid4().hex[:12]}"


def write_drop(rows: DataFrame, name: str, folder: str) -> None:
    """Deliver rows as CSV files, in the format the drop folders use, compressed."""
    options = CSV_FORMAT | {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    rows.select(*DOMAINS[name].column_names).write.mode("append").options(**options).csv(folder)


def first_delivery(spark: SparkSession, sf_dir: str) -> Iterator[dict[str, DataFrame]]:
    """All landing rows, admissions in two parts. Within a part rows of one key go into one
    file, so they arrive together and their columns alone decide which is the latest."""
    rows = {name: raw(spark, sf_dir) for name, raw in derive.RAW.items() if name != "admissions"}
    admissions = derive.raw_admissions(spark, sf_dir, together=True)
    yield rows | {"admissions": admissions.where("ward = 'F'")}
    yield {"admissions": admissions.where("NOT ward <=> 'F'")}


def rows_of_listed(landing: DataFrame, inventory: DataFrame) -> DataFrame:
    """How many rows came from files the inventory lists. Rows are counted per file before the
    join: a few files own all of them, so a shuffle by file would send a file to one task."""
    listed = inventory.select(F.element_at(F.split("path", "/"), -1).alias("_source_file"))
    per_file = landing.groupBy("_source_file").agg(F.count(F.lit(1)).alias("rows"))
    return per_file.join(listed, "_source_file", "left_semi").agg(F.coalesce(F.sum("rows"), F.lit(0)))


@dataclass
class Journal:
    """Counts noted on the way: (measure, source_table, step, n)."""

    rows: list[tuple[str, str, str, int]] = field(default_factory=list)
    statuses: list[str] = field(default_factory=list)

    def note(self, measure: str, name: str, step: str, n: int) -> None:
        self.rows.append((measure, name, step, n))

    def pending(self, wh: Warehouse, step: str) -> None:
        for name in DOMAINS:
            self.note("pending", name, step, wh.read_table(f"raw_{name}_st").count())

    def arrivals(self, wh: Warehouse) -> None:
        """Rows per time of arrival, in order, and what the inventory says of their files."""
        for name in DOMAINS:
            landing = wh.landing(name)
            for k, row in enumerate(landing.groupBy("load_time").count().orderBy("load_time").collect()):
                self.note("arrived", name, str(k + 1), row["count"])
            known = rows_of_listed(landing, file_inventory(wh.spark, wh.drop_folder(name)))
            self.note("rows of listed files", name, "", known.first()[0])


def completed_run(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, RunReport, Journal]:
    """Deliver everything and run; deliver again and let a schedule of two ticks run the
    pipeline, the second time without anything new; then empty a landing table and load it anew."""
    run = (spark.sparkContext.applicationId, sf_dir)
    if run in _RUNS:
        return _RUNS[run]
    wh, journal = Warehouse(spark, scratch_folder(spark)), Journal()
    for part in first_delivery(spark, sf_dir):
        for name, rows in part.items():
            write_drop(rows, name, wh.drop_folder(name))
        ingest_available(wh)
    journal.pending(wh, "first delivery")
    report = run_pipeline(wh, dims=True, as_of=derive.FIRST_DAY)
    journal.statuses.append(report.status)
    journal.pending(wh, "first run")
    for name in DOMAINS:
        write_drop(derive.RAW[name](spark, sf_dir, second=True), name, wh.drop_folder(name))
    ingest_available(wh)
    journal.pending(wh, "second delivery")
    journal.arrivals(wh)
    clock = f"{wh.root}/ticks"
    for tick in range(2):
        spark.range(tick, tick + 1).coalesce(1).write.mode("append").parquet(clock)
    ticks = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(clock)
    schedule = start_schedule(wh, every=None, ticks=ticks, on_run=lambda r: journal.statuses.append(r.status))
    schedule.awaitTermination()
    refresh_dimensions(wh, derive.SECOND_DAY)
    journal.note("reset", "doctors", "1 before", wh.raw("doctors").count())
    wh.reset_landing("doctors")
    journal.note("reset", "doctors", "2 emptied", wh.raw("doctors").count())
    ingest_available(wh, ["doctors"])
    journal.note("reset", "doctors", "3 taken in", wh.raw("doctors").count())
    journal.note("reset", "doctors", "4 loaded", load_domain(wh, "doctors").counts["rows"])
    journal.note("reset", "doctors", "5 in silver", wh.silver("doctors").count())
    _RUNS[run] = (wh, report, journal)
    return _RUNS[run]
