"""The five landing tables derived from the whole given tables.

customer -> patients, supplier -> doctors, lineitem with orders -> admissions,
events -> procedures, orders -> billing. Faulty values (ids that are no number,
impossible dates, e-mails without @, negative amounts ...) follow from the data
itself, so every validation rule has rows to accept and rows to reject.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.domains import DOMAINS
from wardflow.functions.sizing import planned_bytes, shuffle_partitions
from wardflow.operators import rules
from wardflow.operators.dedup import latest_per_key

FIRST_LOAD = dt.datetime(2024, 1, 1)
SECOND_LOAD = dt.datetime(2024, 1, 2)
LOG_TIME = dt.datetime(2024, 6, 1)
FIRST_DAY = dt.date(2026, 3, 17)
SECOND_DAY = dt.date(2026, 3, 18)


# Keys of the tables whose derivation is costly per row.
_SPREAD_BY = {"lineitem": "l_orderkey", "orders": "o_orderkey", "events": "event_id"}


SPLIT_BYTES = 4 << 20
TASK_BYTES = 16 << 20  # of a given table, for a task that sorts or writes its rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. One smaller than the least split per core is spread over the
    cores; a large one has splits enough and is read without this shuffle."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in _SPREAD_BY and planned_bytes(df) < cores * SPLIT_BYTES:
        return df.repartition(cores, _SPREAD_BY[name])
    return df


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _person(key: Column) -> Column:
    """A patient's id; some have more digits than fit 64 bits."""
    wide = F.concat(F.lit("9"), F.lpad(_text(key), 19, "0"))
    return F.when(key % 50 == 7, wide).otherwise(_text(key))


def _time_text(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def _stamp(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def raw_patients(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    """First delivery, or a second one in which everybody moved."""
    key, nation = _text("c_custkey"), F.col("c_nationkey")
    born = F.date_add(F.lit("1950-01-01").cast("date"), F.floor("c_acctbal").cast("int") + 1000)
    return table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < -500, F.concat(F.lit("X"), key)).otherwise(_person(F.col("c_custkey"))).alias("patient_id"),
        F.col("c_name").alias("name"),
        F.when(nation == 7, "1990-02-30").otherwise(_text(born)).alias("dob"),
        F.when(F.col("c_acctbal") < 5000, "F").otherwise("M").alias("gender"),
        F.when((F.col("c_mktsegment") == "FURNITURE") & (nation < 3), F.lit(None))
        .when(nation == 9, "")
        .when(nation == 11, F.concat("c_name", F.lit(".example.org")))
        .otherwise(F.concat("c_name", F.lit("@example.org")))
        .alias("email"),
        F.concat(F.lit("555-"), key).alias("phone"),
        F.concat("c_name", F.lit(', "Block '), _text(nation), F.lit('"\nMain St')).alias("address"),
        F.concat(F.lit("Moved " if second else "City "), _text(nation)).alias("city"),
        F.col("c_mktsegment").alias("state"),
        F.concat(F.lit("INS"), key).alias("insurance_id"),
        F.when(nation == 3, "soon").otherwise("2024-01-01").alias("registration_date"),
        _stamp(SECOND_LOAD if second else FIRST_LOAD).alias("load_time"),
    )


def raw_doctors(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    """First delivery, or a second one in which every department was renamed."""
    key, nation, balance = _text("s_suppkey"), F.col("s_nationkey"), F.col("s_acctbal")
    return table(spark, sf_dir, "supplier").select(
        F.when(balance < -500, F.concat(F.lit("X"), key)).otherwise(key).alias("doctor_id"),
        F.col("s_name").alias("name"),
        F.when(balance < 3000, "Cardiology").otherwise("Surgery").alias("specialization"),
        F.when(nation == 7, "2016-13-01").otherwise("2016-01-01").alias("join_date"),
        F.concat(F.lit("556-"), key).alias("phone"),
        F.when(nation == 5, F.lit(None))
        .when(nation == 11, F.concat("s_name", F.lit(".example.org")))
        .otherwise(F.concat("s_name", F.lit("@example.org")))
        .alias("email"),
        F.lit("MD").alias("qualification"),
        F.concat(F.lit("New " if second else "Dept "), _text(nation)).alias("department"),
        F.when(balance < 0, "ON_LEAVE").when(balance < 5000, "INACTIVE").otherwise("ACTIVE").alias("status"),
        _stamp(SECOND_LOAD if second else FIRST_LOAD).alias("load_time"),
    )


def raw_admissions(spark: SparkSession, sf_dir: str, second: bool = False, together: bool = False) -> DataFrame:
    """First delivery, or a second one of some departments: other patients, other status.
    ``together``: all rows of an order, so of an id, in one task. The join is by order, too,
    and needs no shuffle beyond this one. Tables that outgrow the session's partitions are
    joined in as many more."""
    lines = table(spark, sf_dir, "lineitem")
    parts = shuffle_partitions(spark, planned_bytes(lines), TASK_BYTES)
    if parts > shuffle_partitions(spark, 0, TASK_BYTES):
        lines = lines.repartition(parts, "l_orderkey")
    elif together:
        lines = lines.repartition("l_orderkey")
    rows = lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    key = _text(F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    flag, discount, tax = F.col("l_returnflag"), F.col("l_discount"), F.col("l_tax")
    quantity = F.col("l_quantity").cast("int")
    arrival = F.col("o_orderdate") + F.make_dt_interval(mins=F.col("l_linenumber") * 37)
    leave = F.col("l_shipdate") + F.make_dt_interval(mins=quantity * 53)
    return rows.select(
        F.when((flag == "R") & (discount == 0.1), F.concat(F.lit("A"), key)).otherwise(key).alias("admission_id"),
        F.when((discount == 0.03) & (F.col("l_linestatus") == "F"), F.lit(None))
        .when((discount == 0.01) & (tax == 0.07), "unknown")
        .otherwise(_person(F.col("o_custkey") + 1 if second else F.col("o_custkey")))
        .alias("patient_id"),
        _time_text(arrival).alias("admission_time"),
        F.when((tax == 0.08) & (discount == 0.05), "").otherwise(_time_text(leave)).alias("discharge_time"),
        flag.alias("department"),
        F.col("l_linestatus").alias("ward"),
        F.when((tax == 0.0) & (quantity == 1), "none").otherwise(_text(quantity)).alias("bed_no"),
        _text("l_suppkey").alias("attending_doctor_id"),
        F.when(flag == "A", "OPD").when(flag == "N", "IPD").otherwise("ER").alias("admission_type"),
        F.lit("MOVED").alias("status") if second else F.col("o_orderstatus").alias("status"),
        (F.col("l_shipdate") + F.make_dt_interval(secs=quantity)).alias("load_time"),
    ).where("department = 'A'" if second else "true")


def raw_procedures(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    """First delivery, or a second one of some kinds with another status."""
    kind, value, ts = F.col("event_type"), F.col("value"), F.col("ts")
    key = _text("event_id")
    start = ts + F.make_dt_interval(secs=F.floor(value * 2))
    number = F.col("event_id")
    early = ((kind == "view") & (value > 400)) | (number % 7 == 3)
    end = F.when(early, start - F.make_dt_interval(mins=F.lit(5))).otherwise(
        start + F.make_dt_interval(mins=F.lit(30))
    )
    admission = number * 10 + 1 + F.floor(value / 100)
    return table(spark, sf_dir, "events").select(
        F.when(((kind == "error") & (value > 450)) | (number % 37 == 0), F.concat(F.lit("P"), key)).otherwise(key).alias("procedure_id"),
        F.when(((kind == "click") & (value > 480)) | (number % 31 == 5), F.lit(None)).otherwise(_text(admission)).alias("admission_id"),
        _text("user_id").alias("patient_id"),
        kind.alias("procedure_name"),
        _text("user_id").alias("surgeon_id"),
        F.when((kind == "purchase") & (value < 50), F.lit(None)).otherwise(_time_text(ts)).alias("scheduled_time"),
        F.when(((kind == "signup") & (value < 20)) | (number % 41 == 6), F.lit(None)).otherwise(_time_text(start)).alias("start_time"),
        _time_text(end).alias("end_time"),
        F.concat(F.lit("OR-"), _text("user_id")).alias("operating_room"),
        F.col("props").alias("anaesthesia_type"),
        F.lit("REDONE" if second else "DONE").alias("status"),
        ts.alias("load_time"),
    ).where("procedure_name IN ('error', 'view')" if second else "true")


def raw_billing(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    """First delivery, or a second one of the flagged bills with another mode of payment."""
    price, key = F.col("o_totalprice"), _text("o_orderkey")
    amount = _text(price.cast("decimal(12,2)"))
    urgency = F.substring("o_orderpriority", 1, 1)
    return table(spark, sf_dir, "orders").select(
        F.when((urgency == "5") & (price > 450000), F.concat(F.lit("B"), key)).otherwise(key).alias("bill_id"),
        _text(F.col("o_orderkey") * 10 + urgency.cast("bigint")).alias("admission_id"),
        _person(F.col("o_custkey")).alias("patient_id"),
        F.when(price < 5000, "n/a")
        .when((F.col("o_orderstatus") == "P") & (price > 400000), F.concat(F.lit("-"), amount))
        .otherwise(amount)
        .alias("total_amount"),
        _text(F.floor(price)).alias("insurance_amount"),
        F.when(urgency == "1", "tbd").otherwise("100").alias("out_of_pocket_amount"),
        _time_text(F.col("o_orderdate")).alias("billing_time"),
        F.lit("AGAIN").alias("payment_mode") if second else F.col("o_orderpriority").alias("payment_mode"),
        F.when(price > 300000, "TRUE").otherwise("FALSE").alias("is_flagged"),
        F.col("o_orderdate").alias("load_time"),
    ).where("is_flagged = 'TRUE'" if second else "true")


RAW = {
    "patients": raw_patients,
    "doctors": raw_doctors,
    "admissions": raw_admissions,
    "procedures": raw_procedures,
    "billing": raw_billing,
}


def parents_of(spark: SparkSession, sf_dir: str, name: str) -> dict[str, DataFrame]:
    """Key columns of the parent silver tables: the keys of their accepted rows."""
    keys = {}
    for fk in DOMAINS[name].foreign_keys:
        parent = DOMAINS[fk.parent]
        keys[fk.parent] = rules.typed(accepted(spark, sf_dir, fk.parent), parent).select(parent.key)
    return keys


@functools.cache  # one lazy plan, however many others build on it
def accepted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    parents = parents_of(spark, sf_dir, name)
    return rules.select_accepted(RAW[name](spark, sf_dir), DOMAINS[name], parents)


def judged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    parents = parents_of(spark, sf_dir, name)
    return rules.judge(RAW[name](spark, sf_dir), DOMAINS[name], parents)


def data_errors(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Level 1 needs no lookup, so it is judged on the landing rows alone."""
    domain = DOMAINS[name]
    raw = RAW[name](spark, sf_dir).withColumn(rules.TYPED_OK, rules.type_rules(domain))
    return rules.data_errors(raw, domain, _stamp(LOG_TIME))


def business_errors(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return rules.business_errors(judged(spark, sf_dir, name), DOMAINS[name], _stamp(LOG_TIME))


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Accepted rows, typed, latest per key: the silver table after a first load."""
    domain = DOMAINS[name]
    return latest_per_key(rules.typed(accepted(spark, sf_dir, name), domain), domain.key)


def second_silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Source of a second load for patients or doctors."""
    domain = DOMAINS[name]
    rows = rules.select_accepted(RAW[name](spark, sf_dir, second=True), domain)
    return latest_per_key(rules.typed(rows, domain), domain.key)
