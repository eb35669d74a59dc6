"""CSV drop folders: one per domain, comma-separated, one header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.domains import CORRUPT, LOAD_TIME, SOURCE_FILE, SOURCE_MODIFIED, Domain

# How the files are written, too. Quotes inside a quoted field are doubled.
CSV_FORMAT = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}

# Columns bind by position, whatever the header says. A record with too few or
# too many fields is kept (padded or cut) and its text stored alongside, so that
# it can be found later. An empty field is NULL, a quoted empty one is empty
# text: NULL is spelled as a character no file holds, so nothing else is taken
# for it.
CSV_OPTIONS = CSV_FORMAT | {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "nullValue": "\0",
    "emptyValue": "",
}


def read_options(domain: Domain) -> dict[str, str]:
    """Where records may span lines, a file is read from its beginning and is one
    split: the files of a folder are spread over tasks, one file is not."""
    return CSV_OPTIONS | {"multiLine": str(domain.multi_line).lower()}


def _schema(domain: Domain) -> T.StructType:
    return domain.drop_schema().add(CORRUPT, T.StringType())


def scan_csv(spark: SparkSession, domain: Domain, folder: str) -> DataFrame:
    """The delivered rows of a folder, all text."""
    return spark.read.schema(_schema(domain)).options(**read_options(domain)).csv(folder)


def stream_csv(spark: SparkSession, domain: Domain, folder: str, **options: str) -> DataFrame:
    """New files of a folder as a stream of landing rows."""
    reader = spark.readStream.schema(_schema(domain)).options(**read_options(domain)).options(**options)
    return arrivals(reader.csv(folder), domain)


def arrivals(rows: DataFrame, domain: Domain) -> DataFrame:
    """Stamp delivered rows with their time of arrival (one per batch) and origin."""
    return rows.select(
        *domain.column_names,
        F.current_timestamp().cast("timestamp_ntz").alias(LOAD_TIME),
        F.col("_metadata.file_modification_time").alias(SOURCE_MODIFIED),
        F.col("_metadata.file_name").alias(SOURCE_FILE),
        CORRUPT,
    )


def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a drop folder; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))
