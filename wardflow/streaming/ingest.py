"""Drop folder to landing table: every file once, rows exactly as received."""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import ExitStack

from pyspark.sql.streaming import StreamingQuery

from wardflow.domains import DOMAINS
from wardflow.functions.sizing import setting
from wardflow.sources import folders
from wardflow.sources.csv_drop import stream_csv
from wardflow.sources.tables import COMPRESSION, ROW_GROUP
from wardflow.sources.warehouse import Warehouse


def start_ingest(
    wh: Warehouse, name: str, every: str | None = None, **options: str
) -> StreamingQuery | None:
    """Stream new files of a domain into its landing table.

    With ``every`` (say ``"10 seconds"``) the query keeps running; without, it
    takes what is there and ends. The file sink commits whole batches, so a
    restarted query neither loses nor repeats a row. ``options`` go to the file
    source (``maxFilesPerTrigger`` bounds a batch, ``maxFileAge`` its memory).
    """
    folder = wh.drop_folder(name)
    if not folders.exists(wh.spark, folder):
        return None
    writer = (
        stream_csv(wh.spark, DOMAINS[name], folder, **options)
        .writeStream.format("parquet")
        .queryName(f"ingest_{name}")
        .option("checkpointLocation", wh.checkpoint("ingest", name))
        .option("compression", COMPRESSION)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    with ExitStack() as settings:  # the file sink of a stream passes Parquet's own settings on from the session only
        for key, value in ROW_GROUP.items():
            settings.enter_context(setting(wh.spark, key, value))
        return writer.trigger(**trigger).start(wh.landing_path(name))


def ingest_available(wh: Warehouse, names: Iterable[str] = DOMAINS, **options: str) -> None:
    """Initial or catch-up load: the domains are independent here and run side by side."""
    running = [start_ingest(wh, name, **options) for name in names]
    for query in running:
        if query is not None:
            query.awaitTermination()
