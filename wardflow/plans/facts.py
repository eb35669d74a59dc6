"""Fact projections of the silver tables; ``extra`` columns are carried along."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fact_admissions(silver: DataFrame, *extra: str) -> DataFrame:
    return silver.select(
        "admission_id",
        "patient_id",
        F.col("attending_doctor_id").alias("doctor_id"),
        "admission_time",
        "discharge_time",
        "department",
        "bed_no",
        *extra,
    )


def fact_procedures(silver: DataFrame, *extra: str) -> DataFrame:
    return silver.select(
        "procedure_id",
        "admission_id",
        F.col("surgeon_id").alias("doctor_id"),
        "scheduled_time",
        "start_time",
        "end_time",
        "operating_room",
        *extra,
    )


def fact_billing(silver: DataFrame, *extra: str) -> DataFrame:
    return silver.select("bill_id", "admission_id", "patient_id", "total_amount", "billing_time", *extra)


# Silver domain -> its fact projection.
FACTS: dict[str, Callable[..., DataFrame]] = {
    "admissions": fact_admissions,
    "procedures": fact_procedures,
    "billing": fact_billing,
}
