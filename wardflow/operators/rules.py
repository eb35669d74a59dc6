"""Two-level validation in one pass.

Each level is one nullable boolean: TRUE passes, FALSE is logged, NULL (the rule
cannot be decided, say a missing e-mail) is neither logged nor loaded. With
``strict=True`` an undecided rule counts as failed, so no row vanishes.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.domains import BUSINESS_ERROR, DATA_ERROR, LOAD_TIME, Domain
from wardflow.functions.casts import silver_value
from wardflow.operators.lookups import mark_exists, semi

TYPED_OK, BUSINESS_OK = "_typed_ok", "_business_ok"
VERDICT = "verdict"
RECORD = "_record_id"
ACCEPTED = "ACCEPTED"
DROPPED = "DROPPED"
LOGGED = (DATA_ERROR, BUSINESS_ERROR)


def has_at_sign(column: str) -> Column:
    return F.col(column).like("%@%")


def type_rules(domain: Domain) -> Column:
    """Level 1: required values parse and the e-mail has an @."""
    kinds = dict(domain.columns)

    def one(column: str, rule: str) -> Column:
        if rule == "email":
            return has_at_sign(column)
        return silver_value(F.col(column), kinds[column]).isNotNull()

    return reduce(and_, [one(column, rule) for column, rule in domain.required])


def in_time_order(earlier: Column, later: Column) -> Column:
    """Compared as times, so ``2024-1-5`` precedes ``2024-01-10``."""
    return silver_value(later, "timestamp") >= silver_value(earlier, "timestamp")


def not_negative(amount: Column) -> Column:
    return silver_value(amount, "double") >= 0


def row_rules(domain: Domain) -> list[Column]:
    """The level-2 rules that look at one row only: time order, no negative amount."""
    parts = []
    if domain.time_order:
        earlier, later = domain.time_order
        parts.append(in_time_order(F.col(earlier), F.col(later)))
    if domain.non_negative:
        parts.append(not_negative(F.col(domain.non_negative)))
    return parts


def select_accepted(
    raw: DataFrame, domain: Domain, parents: dict[str, DataFrame] | None = None, *, shuffled: bool = False
) -> DataFrame:
    """Only the rows that pass both levels: filters and semi joins, cheapest first."""
    rows = raw.where(reduce(and_, row_rules(domain), type_rules(domain)))
    for fk in domain.foreign_keys:
        rows = semi(rows, fk.column, parents[fk.parent], shuffled=shuffled)
    return rows


def judge(
    raw: DataFrame,
    domain: Domain,
    parents: dict[str, DataFrame] | None = None,
    *,
    strict: bool = False,
    shuffled: bool = False,
    parents_unique: bool = False,
    parents_small: dict[str, bool] | None = None,
    parents_empty: dict[str, Column | bool] | None = None,
) -> DataFrame:
    """Add the outcome of both levels to every landing row.

    ``parents`` maps a parent domain to a one-column DataFrame of its keys and
    is needed by the domains with references. Duplicates are judged one by one:
    dedup comes later.
    """
    columns = raw.columns
    ok1, ok2 = type_rules(domain), F.lit(True)
    rows = raw
    if domain.has_business_rules:
        for fk in domain.foreign_keys:
            rows = mark_exists(
                rows,
                fk.column,
                parents[fk.parent],
                f"_found_{fk.column}",
                parents_unique=parents_unique,
                parents_small=(parents_small or {}).get(fk.parent, False),
                parents_empty=(parents_empty or {}).get(fk.parent),
                shuffled=shuffled,
            )
        found = [F.col(f"_found_{fk.column}") for fk in domain.foreign_keys]
        ok2 = reduce(and_, found + row_rules(domain))
    if strict:
        ok1, ok2 = F.coalesce(ok1, F.lit(False)), F.coalesce(ok2, F.lit(False))
    return rows.select(*columns, ok1.alias(TYPED_OK), ok2.alias(BUSINESS_OK))


def accepted(judged: DataFrame) -> DataFrame:
    """Rows that pass both levels. A plain conjunction, so that Spark moves the
    level-1 tests below the lookups, down to the scan."""
    return judged.where(F.col(TYPED_OK) & F.col(BUSINESS_OK)).drop(TYPED_OK, BUSINESS_OK)


def with_verdict(judged: DataFrame) -> DataFrame:
    """The outcome as one word. Level 2 only counts for rows that passed level 1."""
    ok1, ok2 = F.col(TYPED_OK), F.col(BUSINESS_OK)
    verdict = (
        F.when(~ok1, DATA_ERROR)
        .when(ok1.isNull(), DROPPED)
        .when(~ok2, BUSINESS_ERROR)
        .when(ok2, ACCEPTED)
        .otherwise(DROPPED)
    )
    return judged.withColumn(VERDICT, verdict).drop(TYPED_OK, BUSINESS_OK)


def to_stage(rows: DataFrame, domain: Domain, *extra: str) -> DataFrame:
    """What later steps need of rows that carry their verdict: the values of accepted rows
    in the silver types, the delivered key of logged ones."""
    accepted_only = {c: F.when(F.col(VERDICT) == ACCEPTED, F.col(c)) for c in (*domain.column_names, LOAD_TIME, *extra)}
    record = F.when(F.col(VERDICT).isin(*LOGGED), F.col(domain.key)).alias(RECORD)
    return typed(rows.select(VERDICT, record, *[v.alias(c) for c, v in accepted_only.items()]), domain, *extra, VERDICT, RECORD)


def _log(rows: DataFrame, domain: Domain, error_type: str, load_time: Column) -> DataFrame:
    message = domain.data_error if error_type == DATA_ERROR else domain.business_error
    return rows.select(
        F.lit(domain.name).alias("source_table"),
        F.col(domain.key).alias("record_id"),
        F.lit(error_type).alias("error_type"),
        F.lit(message).alias("error_message"),
        load_time.alias("load_time"),
    )


def data_errors(judged: DataFrame, domain: Domain, load_time: Column) -> DataFrame:
    """One log row per landing row failing level 1, however many rules it broke."""
    return _log(judged.where(~F.col(TYPED_OK)), domain, DATA_ERROR, load_time)


def business_errors(judged: DataFrame, domain: Domain, load_time: Column) -> DataFrame:
    """One log row per landing row that passed level 1 and fails level 2."""
    failed = judged.where(F.col(TYPED_OK) & ~F.col(BUSINESS_OK))
    return _log(failed, domain, BUSINESS_ERROR, load_time)


def staged_exceptions(staged: DataFrame, domain: Domain, load_time: Column) -> DataFrame:
    """Log rows of both levels from rows that carry their verdict."""
    error_type = F.col(VERDICT)
    message = F.when(error_type == DATA_ERROR, domain.data_error).otherwise(F.lit(domain.business_error))
    return staged.where(error_type.isin(*LOGGED)).select(
        F.lit(domain.name).alias("source_table"),
        F.col(domain.key).alias("record_id"),
        error_type.alias("error_type"),
        message.alias("error_message"),
        load_time.alias("load_time"),
    )


def typed(rows: DataFrame, domain: Domain, *extra: str) -> DataFrame:
    """Landing rows in the silver types. A bad value in a column no rule checks
    becomes NULL and does not fail the load."""
    return rows.select(
        *[silver_value(F.col(c), kind).alias(c) for c, kind in domain.columns],
        F.col(LOAD_TIME).cast("timestamp_ntz").alias(LOAD_TIME),
        *extra,
    )
