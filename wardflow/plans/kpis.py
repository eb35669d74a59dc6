"""The five indicators, each over its fact table(s)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.domains import BILL_CEILING, HOURS_PER_DAY, ON_TIME_MINUTES
from wardflow.functions.ratios import ratio
from wardflow.functions.temporal import hours_between, minutes_between


def _finished(admissions: DataFrame) -> DataFrame:
    return admissions.where(F.col("admission_time").isNotNull() & F.col("discharge_time").isNotNull())


def _stay_hours() -> Column:
    return hours_between(F.col("admission_time"), F.col("discharge_time"))


def occupied_hours(admissions: DataFrame) -> DataFrame:
    return _finished(admissions).agg(F.sum(_stay_hours()).alias("occupied_hours"))


def distinct_beds(admissions: DataFrame) -> DataFrame:
    return _finished(admissions).agg(F.countDistinct("bed_no").alias("total_beds"))


def bed_utilization(admissions: DataFrame) -> DataFrame:
    """Occupied hours over the hours the distinct beds offer in one day.

    Hours are summed per bed first: one small aggregate then yields both the
    total and the number of beds, and only one row per bed and task is shuffled.
    """
    per_bed = _finished(admissions).groupBy("bed_no").agg(F.sum(_stay_hours()).alias("hours"))
    usage = per_bed.agg(F.sum("hours").alias("occupied_hours"), F.count("bed_no").alias("total_beds"))
    return usage.select(
        ratio(F.col("occupied_hours"), F.col("total_beds") * HOURS_PER_DAY).alias(
            "bed_utilization_score"
        )
    )


def turnaround(admissions: DataFrame) -> DataFrame:
    return _finished(admissions).agg(F.avg(_stay_hours()).alias("avg_stay_hours"))


def surgery_efficiency(procedures: DataFrame) -> DataFrame:
    """Share, in percent of all rows, of surgeries begun close to their schedule."""
    gap = F.abs(minutes_between(F.col("scheduled_time"), F.col("start_time")))
    on_time = F.count(F.when(gap <= ON_TIME_MINUTES, 1))
    return procedures.agg(
        ratio(on_time.cast("double") * 100.0, F.count(F.lit(1))).alias("surgery_efficiency_index")
    )


def combined_work(admissions: DataFrame, procedures: DataFrame) -> DataFrame:
    """One row per unit of work: an admission attended or a procedure begun."""
    return admissions.select("doctor_id", F.to_date("admission_time").alias("day")).unionAll(
        procedures.select("doctor_id", F.to_date("start_time").alias("day"))
    )


def daily_work(admissions: DataFrame, procedures: DataFrame) -> DataFrame:
    return (
        combined_work(admissions, procedures)
        .groupBy("doctor_id", "day")
        .agg(F.count(F.lit(1)).alias("daily_work"))
    )


def doctor_workload(admissions: DataFrame, procedures: DataFrame) -> DataFrame:
    """Average units of work per doctor and active day. Both aggregates combine
    before they shuffle, so a busy doctor is one row per task and day."""
    return (
        daily_work(admissions, procedures)
        .groupBy("doctor_id")
        .agg(F.avg("daily_work").alias("doctor_workload_index"))
    )


def billing_accuracy(billing: DataFrame) -> DataFrame:
    """One minus the share of anomalous bills; a single scan counts both."""
    amount = F.col("total_amount")
    anomalies = F.count_if((amount < 0) | (amount > BILL_CEILING))
    return billing.agg((1 - ratio(anomalies, F.count(F.lit(1)))).alias("billing_accuracy_index"))
