"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.checks import derive
from wardflow.checks.full_run import completed_run, scratch_folder, write_drop
from wardflow.domains import DOMAINS
from wardflow.functions import hours_between, minutes_between, try_date, try_number, try_time
from wardflow.operators import audit, lookups, masking, rules, scd2
from wardflow.operators.dedup import latest_per_key
from wardflow.operators.merge import merge
from wardflow.plans import facts, kpis
from wardflow.sources.csv_drop import scan_csv

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _fact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return facts.FACTS[name](derive.silver(spark, sf_dir, name))


# ---- scans and functions ---------------------------------------------------


@_query
def scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.table(spark, sf_dir, "orders").select("*")


@_query
def fn_try_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    key = F.col("c_custkey").cast("string")
    return derive.table(spark, sf_dir, "customer").select(
        "c_custkey",
        try_number(balance).cast("bigint").alias("from_balance"),
        try_number(F.concat(F.lit("  "), key, F.lit(" "))).cast("bigint").alias("from_padded"),
        try_number(F.concat(key, F.lit("e2"))).cast("bigint").alias("from_exponent"),
        try_number(F.col("c_name")).cast("bigint").alias("from_name"),
    )


@_query
def fn_try_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.raw_patients(spark, sf_dir).select(
        "patient_id",
        try_date(F.col("dob")).alias("dob"),
        try_date(F.col("registration_date")).alias("registration_date"),
    )


@_query
def fn_try_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.raw_admissions(spark, sf_dir).select(
        "admission_id",
        try_time(F.col("admission_time")).alias("admission_time"),
        try_time(F.col("discharge_time")).alias("discharge_time"),
        try_time(F.col("bed_no")).alias("no_time"),
    )


@_query
def fn_datediff_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.typed(derive.raw_admissions(spark, sf_dir), DOMAINS["admissions"])
    return rows.select(
        "admission_id",
        hours_between(F.col("admission_time"), F.col("discharge_time")).alias("stay_hours"),
    )


@_query
def fn_datediff_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("ts") + F.make_dt_interval(secs=F.floor(F.col("value") * 2))
    return derive.table(spark, sf_dir, "events").select(
        "event_id", minutes_between(F.col("ts"), start).alias("minutes")
    )


@_query
def fn_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.lit("Patient: "), F.col("name"), F.lit(" | Mail: "), F.col("email")]
    return derive.raw_patients(spark, sf_dir).select("patient_id", F.concat(*parts).alias("status_line"))


@_query
def typed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.silver(spark, sf_dir, "admissions")


# ---- validation ------------------------------------------------------------


@_query
def valid_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.accepted(spark, sf_dir, "patients")


@_query
def valid_doctors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.accepted(spark, sf_dir, "doctors")


@_query
def exceptions_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.data_errors(spark, sf_dir, "patients")


@_query
def exceptions_doctors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.data_errors(spark, sf_dir, "doctors")


@_query
def exceptions_admissions_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.data_errors(spark, sf_dir, "admissions")


@_query
def exceptions_procedures_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.data_errors(spark, sf_dir, "procedures")


@_query
def exceptions_billing_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.data_errors(spark, sf_dir, "billing")


@_query
def exceptions_admissions_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.business_errors(spark, sf_dir, "admissions")


@_query
def exceptions_procedures_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.business_errors(spark, sf_dir, "procedures")


@_query
def exceptions_billing_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.business_errors(spark, sf_dir, "billing")


@_query
def verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landing row has exactly one verdict, silently dropped ones included."""
    counts = [
        rules.with_verdict(derive.judged(spark, sf_dir, name))
        .groupBy("verdict")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("source_table"), "verdict", "n")
        for name in DOMAINS
    ]
    return reduce(DataFrame.unionAll, counts)


@_query
def strict_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict mode logs the undecided rows too."""
    domain = DOMAINS["patients"]
    judged = rules.judge(derive.raw_patients(spark, sf_dir), domain, strict=True)
    return rules.data_errors(judged, domain, derive._stamp(derive.LOG_TIME))


@_query
def rule_time_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = rules.in_time_order(F.col("admission_time"), F.col("discharge_time"))
    return derive.raw_admissions(spark, sf_dir).where(~ordered).select(
        "admission_id", "admission_time", "discharge_time"
    )


@_query
def rule_nonneg_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.raw_billing(spark, sf_dir).where(~rules.not_negative(F.col("total_amount"))).select(
        "bill_id", "total_amount"
    )


@_query
def exception_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every domain is judged once, for both levels."""
    judged = {name: rules.with_verdict(derive.judged(spark, sf_dir, name)) for name in DOMAINS}
    logs = [rules.staged_exceptions(rows, DOMAINS[name], derive._stamp(derive.LOG_TIME)) for name, rows in judged.items()]
    return audit.failure_summary(reduce(DataFrame.unionAll, logs))


@_query
def fk_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers that are not in debt."""
    parents = derive.table(spark, sf_dir, "customer").where("c_acctbal >= 0").select("c_custkey")
    orders = derive.table(spark, sf_dir, "orders")
    return lookups.semi(orders, "o_custkey", parents)


@_query
def fk_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of suppliers in debt, or shipped before they were ordered."""
    parents = derive.table(spark, sf_dir, "supplier").where("s_acctbal >= 0").select("s_suppkey")
    rows = derive.table(spark, sf_dir, "lineitem").join(
        derive.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    marked = lookups.mark_exists(rows, "l_suppkey", parents, "found", parents_unique=True)
    return marked.where(~F.col("found") | (F.col("l_shipdate") < F.col("o_orderdate"))).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "o_orderdate"
    )


@_query
def fk_not_in_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shuffled form, as used beyond the broadcast size: hot keys are Spark's skew join's."""
    parents = derive.table(spark, sf_dir, "supplier").where("s_acctbal >= 0").select("s_suppkey")
    rows = derive.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return lookups.not_in(rows, "l_suppkey", parents, parents_unique=True, shuffled=True)


@_query
def audit_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.typed(derive.raw_admissions(spark, sf_dir), DOMAINS["admissions"])
    return audit.duplicate_keys(rows, "admission_id")


@_query
def audit_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    bills = rules.typed(derive.raw_billing(spark, sf_dir), DOMAINS["billing"])
    admissions = derive.silver(spark, sf_dir, "admissions")
    return audit.orphans(bills, "admission_id", admissions, "admission_id")


# ---- dedup, merge, history, masking ----------------------------------------


@_query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.typed(derive.raw_admissions(spark, sf_dir), DOMAINS["admissions"])
    return latest_per_key(rows.where("admission_id IS NOT NULL"), "admission_id")


@_query
def merge_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = derive.silver(spark, sf_dir, "patients").where("state <> 'BUILDING'")
    source = derive.second_silver(spark, sf_dir, "patients")
    return merge(target, source, "patient_id", DOMAINS["patients"].update_columns)


@_query
def merge_doctors(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = derive.silver(spark, sf_dir, "doctors").where("specialization = 'Surgery'")
    source = derive.second_silver(spark, sf_dir, "doctors")
    return merge(target, source, "doctor_id", DOMAINS["doctors"].update_columns)


@_query
def merge_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = derive.silver(spark, sf_dir, "admissions").where("ward = 'F'")
    target = loaded.withColumns({"patient_id": F.lit(-1).cast("decimal(38,0)"), "department": F.lit("OLD")})
    source = derive.silver(spark, sf_dir, "admissions")
    return merge(target, source, "admission_id", DOMAINS["admissions"].update_columns)


@_query
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = derive.silver(spark, sf_dir, "billing").where("is_flagged = 'TRUE'")
    target = loaded.withColumn("total_amount", F.lit(0.0))
    source = derive.silver(spark, sf_dir, "billing")
    return merge(target, source, "bill_id", DOMAINS["billing"].update_columns)


@_query
def merge_procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = derive.silver(spark, sf_dir, "procedures").where("procedure_name = 'error'")
    target = loaded.withColumn("status", F.lit("OLD"))
    source = derive.silver(spark, sf_dir, "procedures")
    return merge(target, source, "procedure_id", DOMAINS["procedures"].update_columns)


def _patient_attributes() -> list[str]:
    return DOMAINS["patients"].column_names


def _first_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = derive.silver(spark, sf_dir, "patients").where("state <> 'BUILDING'")
    return scd2.open_versions(loaded, _patient_attributes(), derive.FIRST_DAY)


def _second_dim(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    silver = derive.second_silver(spark, sf_dir, "patients")
    return scd2.refresh(_first_dim(spark, sf_dir), silver, "patient_id", derive.SECOND_DAY, **options)


@_query
def scd2_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = derive.second_silver(spark, sf_dir, "patients").where("gender = 'F'")
    return scd2.expire(_first_dim(spark, sf_dir), silver, "patient_id", derive.SECOND_DAY)


@_query
def scd2_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = derive.second_silver(spark, sf_dir, "patients")
    return scd2.open_versions(silver, _patient_attributes(), derive.SECOND_DAY)


@_query
def scd2_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _second_dim(spark, sf_dir)


@_query
def scd2_only_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver equals the dimension for the segments that did not move."""
    domain = DOMAINS["patients"]
    same = derive.silver(spark, sf_dir, domain.name).where("state = 'MACHINERY'")
    moved = derive.second_silver(spark, sf_dir, domain.name).where("state <> 'MACHINERY'")
    return scd2.refresh(
        _first_dim(spark, sf_dir), same.unionByName(moved), domain.key, derive.SECOND_DAY, only_changed=True
    )


@_query
def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.current(_second_dim(spark, sf_dir))


@_query
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.history(_second_dim(spark, sf_dir), "patient_id", 1)


@_query
def scd2_doctors(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = DOMAINS["doctors"]
    loaded = derive.silver(spark, sf_dir, domain.name).where("status <> 'INACTIVE'")
    dim = scd2.open_versions(loaded, domain.column_names, derive.FIRST_DAY)
    silver = derive.second_silver(spark, sf_dir, domain.name)
    return scd2.refresh(dim, silver, domain.key, derive.SECOND_DAY)


@_query
def mask_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masking.masked(derive.silver(spark, sf_dir, "patients"), DOMAINS["patients"].pii, "ANALYST")


@_query
def mask_patients_admin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masking.masked(derive.silver(spark, sf_dir, "patients"), DOMAINS["patients"].pii, "SYSADMIN")


@_query
def mask_doctors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masking.masked(derive.silver(spark, sf_dir, "doctors"), DOMAINS["doctors"].pii, "ANALYST")


# ---- gold ------------------------------------------------------------------


@_query
def fact_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, "admissions")


@_query
def fact_procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, "procedures")


@_query
def fact_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, "billing")


@_query
def union_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.combined_work(_fact(spark, sf_dir, "admissions"), _fact(spark, sf_dir, "procedures"))


@_query
def agg_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        raw(spark, sf_dir).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source_table"), "n")
        for name, raw in derive.RAW.items()
    ]
    return reduce(DataFrame.unionAll, counts)


@_query
def agg_daily_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.daily_work(_fact(spark, sf_dir, "admissions"), _fact(spark, sf_dir, "procedures"))


@_query
def agg_distinct_beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.distinct_beds(_fact(spark, sf_dir, "admissions"))


@_query
def agg_occupied_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.occupied_hours(_fact(spark, sf_dir, "admissions"))


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 6))


@_query
def kpi_bed_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(kpis.bed_utilization(_fact(spark, sf_dir, "admissions")), "bed_utilization_score")


@_query
def kpi_att(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(kpis.turnaround(_fact(spark, sf_dir, "admissions")), "avg_stay_hours")


@_query
def kpi_surgery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(kpis.surgery_efficiency(_fact(spark, sf_dir, "procedures")), "surgery_efficiency_index")


@_query
def kpi_workload(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = kpis.doctor_workload(_fact(spark, sf_dir, "admissions"), _fact(spark, sf_dir, "procedures"))
    return _rounded(work, "doctor_workload_index")


@_query
def kpi_billing_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(kpis.billing_accuracy(_fact(spark, sf_dir, "billing")), "billing_accuracy_index")


# ---- files and the streaming pipeline --------------------------------------


@_query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients written as CSV (commas and quotes inside fields) and scanned back."""
    folder = scratch_folder(spark)
    write_drop(derive.raw_patients(spark, sf_dir), "patients", folder)
    domain = DOMAINS["patients"]
    return scan_csv(spark, domain, folder).select(*domain.column_names)


@_query
def pipeline_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status line and outcome counts per domain of the first run."""
    _, report, _ = completed_run(spark, sf_dir)
    rows = [(load.domain, load.status, verdict, n) for load in report.loads for verdict, n in load.counts.items()]
    return spark.createDataFrame(rows, "source_table string, status string, verdict string, n bigint")


@_query
def pipeline_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.exceptions().drop("load_time")


@_query
def pipeline_landing_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both deliveries exactly as received."""
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.raw("patients").drop("load_time")


@_query
def pipeline_exception_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return audit.failure_summary(wh.exceptions())


@_query
def pipeline_silver_doctors(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.silver("doctors").drop("load_time")


@_query
def pipeline_silver_procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.silver("procedures").drop("load_time")


@_query
def pipeline_silver_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.silver("billing").drop("load_time")


@_query
def pipeline_fact_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.read_table("fact_admissions")


@_query
def pipeline_fact_procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.read_table("fact_procedures")


@_query
def pipeline_masked_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.read_table("silver_patients", role="ANALYST").drop("load_time")


@_query
def pipeline_silver_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.silver("patients").drop("load_time")


@_query
def pipeline_silver_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.silver("admissions").drop("load_time")


@_query
def pipeline_dim_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.read_table("dim_patient")


@_query
def pipeline_dim_doctor(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.read_table("dim_doctor")


@_query
def pipeline_fact_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return wh.read_table("fact_billing")


@_query
def pipeline_workload(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _, _ = completed_run(spark, sf_dir)
    return _rounded(wh.read_table("kpi_doctor_workload"), "doctor_workload_index")


@_query
def pipeline_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four single-value indicators, one row each."""
    wh, _, _ = completed_run(spark, sf_dir)
    scores = [
        wh.read_table(view).toDF("score").select(F.lit(view).alias("view"), F.round("score", 6).alias("score"))
        for view in ("bed_occ", "att", "surgey_efficiny", "kpi_data_quality")
    ]
    return reduce(DataFrame.unionAll, scores)


def _journal(spark: SparkSession, sf_dir: str, measure: str) -> DataFrame:
    _, _, journal = completed_run(spark, sf_dir)
    rows = [row[1:] for row in journal.rows if row[0] == measure]
    return spark.createDataFrame(rows, "source_table string, step string, n bigint")


@_query
def pipeline_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows waiting to be loaded after each delivery, and none after a run."""
    return _journal(spark, sf_dir, "pending")


@_query
def pipeline_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery has one time of arrival, shared by all its rows."""
    return _journal(spark, sf_dir, "arrived")


@_query
def pipeline_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that came from files the inventory of the drop folder lists: all."""
    return _journal(spark, sf_dir, "rows of listed files").drop("step")


@_query
def pipeline_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An emptied landing table takes all files in again; loading them anew adds nothing."""
    return _journal(spark, sf_dir, "reset")


@_query
def pipeline_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined status of the first run and of the schedule's two ticks, the second without new rows."""
    _, _, journal = completed_run(spark, sf_dir)
    return spark.createDataFrame(list(enumerate(journal.statuses, 1)), "run bigint, status string")
