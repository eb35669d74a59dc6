"""The whole run in dependency order, dimension and fact refresh, periodic runs."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wardflow.domains import DOMAINS
from wardflow.functions.sizing import planned_bytes
from wardflow.operators import scd2
from wardflow.plans.facts import FACTS
from wardflow.sources import exception_log, folders
from wardflow.sources.tables import SEQUENCE, UPDATE
from wardflow.sources.warehouse import DIMENSIONS, Warehouse
from wardflow.streaming.ingest import ingest_available
from wardflow.streaming.loads import LoadReport, load_domain, small_splits

log = logging.getLogger(__name__)


@dataclass
class RunReport:
    loads: list[LoadReport]

    @property
    def status(self) -> str:
        return " | ".join(f"{load.domain.capitalize()}: {load.status}" for load in self.loads)


def refresh_fact(wh: Warehouse, name: str) -> int:
    """Bring a fact table up to its silver table. Only segments it does not have
    yet are projected, so the cost follows the new data; returns their number."""
    fact, silver = wh.fact_table(name), wh.silver_table(name)
    have = fact.committed()
    missing = [s for s in silver.live() if s not in have]
    for segment in missing:
        fact.copy(FACTS[name](silver.scan([segment]), SEQUENCE, UPDATE), segment)
    return len(missing)


def side_by_side(task: Callable[[str], object], names: Iterable[str]) -> list:
    """Run independent tasks at the same time: their Spark jobs share the cluster."""
    names = list(names)
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        return list(pool.map(task, names))


def load_waves() -> list[list[str]]:
    """Domains grouped so that each one's parents are in an earlier group."""
    waves: list[list[str]] = []
    done: set[str] = set()
    while len(done) < len(DOMAINS):
        wave = [
            d.name
            for d in DOMAINS.values()
            if d.name not in done and all(fk.parent in done for fk in d.foreign_keys)
        ]
        waves.append(wave)
        done.update(wave)
    return waves


def refresh_facts(wh: Warehouse) -> None:
    side_by_side(lambda name: refresh_fact(wh, name), FACTS)


def refresh_dimension(
    wh: Warehouse, dim: str, as_of: dt.date | None = None, *, only_changed: bool = False
) -> None:
    """Close and reopen versions. The outcome is evaluated once, for one day, and staged;
    closed versions are appended to the history, the current ones replaced. The write of
    the current rows commits the refresh."""
    domain = DOMAINS[DIMENSIONS[dim]]
    current, history = wh.dim_current(dim), wh.dim_history(dim)
    sequence = current.last() + 1
    as_of = as_of or wh.spark.sql("SELECT current_date()").first()[0]
    after = scd2.refresh(current.read(), wh.silver(domain.name), domain.key, as_of, only_changed=only_changed)
    path = f"{folders.stage_folder(wh.spark, wh.root)}/{dim}-{sequence}"
    after.write.mode("overwrite").partitionBy(scd2.FLAG).parquet(path)
    staged = wh.spark.read.schema(after.schema).parquet(path)
    history.write(staged.where(staged[scd2.FLAG] != scd2.CURRENT), sequence)
    current.replace(scd2.current(staged), sequence)
    folders.delete(wh.spark, path)
    history.fold()


def refresh_dimensions(wh: Warehouse, as_of: dt.date | None = None, *, only_changed: bool = False) -> None:
    size = sum(planned_bytes(wh.silver(domain)) for domain in DIMENSIONS.values())
    with small_splits(wh.spark, size):
        side_by_side(lambda dim: refresh_dimension(wh, dim, as_of, only_changed=only_changed), DIMENSIONS)


def housekeep(wh: Warehouse) -> None:
    """Delete what tables no longer need. Called before a run, it spares what was still in
    use when the run before it began to replace it."""
    tables = [wh.silver_table(d) for d in DOMAINS] + [wh.fact_table(f) for f in FACTS]
    tables += [t for dim in DIMENSIONS for t in (wh.dim_current(dim), wh.dim_history(dim))]
    for table in [*tables, *(exception_log.log_table(wh.spark, wh.exceptions_path, d) for d in DOMAINS)]:
        table.prune()


def run_pipeline(
    wh: Warehouse,
    *,
    ingest: bool = True,
    dims: bool = False,
    as_of: dt.date | None = None,
    strict: bool = False,
) -> RunReport:
    """One run: take in new files, load the domains parents first (those that do
    not depend on each other together), refresh facts and, if asked to, the
    dimensions."""
    housekeep(wh)
    if ingest:
        ingest_available(wh)
    loads: list[LoadReport] = []
    for wave in load_waves():
        loads += side_by_side(lambda name: load_domain(wh, name, strict=strict), wave)
    report = RunReport(loads)
    with small_splits(wh.spark):
        refresh_facts(wh)
    if dims:
        refresh_dimensions(wh, as_of)
    return report


def start_schedule(
    wh: Warehouse,
    every: str | None = "5 minutes",
    *,
    max_failures: int = 10,
    ticks: DataFrame | None = None,
    on_run: Callable[[RunReport], None] | None = None,
    **options,
) -> StreamingQuery:
    """Run the pipeline periodically, on the trigger of one streaming query whose
    source merely ticks; runs never overlap. Stop it with ``query.stop()``. A run
    that fails is logged and the next one resumes its loads; ``max_failures`` in a
    row end the schedule with the last error. ``on_run`` gets the report of every
    run. With ``every=None`` the schedule takes the ``ticks`` that are there, one
    run a batch of that stream, and ends."""
    failures = 0

    def tick(batch: DataFrame, batch_id: int) -> None:
        nonlocal failures
        try:
            report = run_pipeline(wh, **options)
            failures = 0
        except Exception:
            failures += 1
            log.exception("run failed, %d in a row", failures)
            if failures >= max_failures:
                raise
            return
        if on_run is not None:
            on_run(report)

    if ticks is None:
        ticks = wh.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        ticks.writeStream.foreachBatch(tick)
        .queryName("pipeline_schedule")
        .option("checkpointLocation", f"{wh.root}/_checkpoints/schedule")
        .trigger(**trigger)
        .start()
    )
