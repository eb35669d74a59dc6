"""The exception log: a table per source table, a segment per load, replaced on retry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.domains import DOMAINS, EXCEPTION_SCHEMA, Domain
from wardflow.sources.tables import SegmentedTable

_STORED = T.StructType([f for f in EXCEPTION_SCHEMA.fields if f.name != "source_table"])


def log_table(spark: SparkSession, path: str, name: str) -> SegmentedTable:
    """Rejects are few and are not looked up by key: one bucket."""
    return SegmentedTable(spark, f"{path}/{name}", _STORED, "record_id", buckets=1)


def write_exceptions(rows: DataFrame, path: str, domain: Domain, sequence: int) -> None:
    log = log_table(rows.sparkSession, path, domain.name)
    log.write(rows.drop("source_table"), sequence)
    log.fold()


def read_exceptions(spark: SparkSession, path: str) -> DataFrame:
    """All log rows. A filter on ``source_table`` only reads that table's log."""
    logs = [log_table(spark, path, d).read().withColumn("source_table", F.lit(d)) for d in DOMAINS]
    return reduce(DataFrame.unionAll, logs).select(*EXCEPTION_SCHEMA.names)
