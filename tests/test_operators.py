from __future__ import annotations

import datetime as dt
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardflow.domains import DOMAINS
from wardflow.functions import hours_between, minutes_between, ratio, try_amount, try_date, try_key, try_number
from wardflow.functions import try_time
from wardflow.operators import audit, lookups, masking, rules, scd2
from wardflow.operators.dedup import latest_per_key
from wardflow.operators.merge import merge, merge_changes

QUICK = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


# ---- functions -------------------------------------------------------------


def test_text_to_number(spark):
    df = texts(spark, ["12.5", " 7 ", "1e3", "", "NaN", "x", None, "01", "99999999999999999999"])
    assert column(df, try_number(F.col("t"))) == [13, 7, 1000, None, None, None, None, 1, 99999999999999999999]
    assert column(df, try_key(F.col("t"))) == [13, 7, 1000, None, None, None, None, 1, 99999999999999999999]


def test_text_to_amount_date_and_time(spark):
    assert column(texts(spark, ["1000.50", "-5", "abc", "NaN", "Infinity"]), try_amount(F.col("t"))) == [
        1000.5, -5.0, None, None, None,
    ]
    assert column(texts(spark, ["2024-02-29", "2024-13-01", "bad", None]), try_date(F.col("t"))) == [
        dt.date(2024, 2, 29), None, None, None,
    ]
    assert column(texts(spark, ["2024-01-01", "2024-1-5 3:04", "soon"]), try_time(F.col("t"))) == [
        dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5, 3, 4), None,
    ]


MOMENTS = st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 1, 1))


@QUICK
@given(pairs=st.lists(st.tuples(MOMENTS, MOMENTS), min_size=1, max_size=40))
def test_boundary_differences(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")

    def unit(moment, seconds):
        return int((moment - dt.datetime(1900, 1, 1)).total_seconds() // seconds)

    got = df.select("a", "b", hours_between(F.col("a"), F.col("b")), minutes_between(F.col("a"), F.col("b")))
    for a, b, hours, minutes in got.collect():
        assert hours == unit(b, 3600) - unit(a, 3600)
        assert minutes == unit(b, 60) - unit(a, 60)


def test_differences_ignore_the_session_zone(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 3, 31, 0, 30), dt.datetime(2024, 3, 31, 4, 10))], "a timestamp_ntz, b timestamp_ntz"
    )
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # a clock change lies in between
    try:
        assert column(df, hours_between(F.col("a"), F.col("b"))) == [4]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ratio_of_zero(spark):
    df = spark.createDataFrame([(1, 2), (1, 0)], "a int, b int")
    assert column(df, ratio(F.col("a"), F.col("b"))) == [0.5, None]


# ---- lookups ---------------------------------------------------------------


def expected_flag(reference, parents):
    """SQL's ``reference IN parents`` with no NULL among the parents."""
    if not parents:
        return False
    if reference is None:
        return None
    try:
        return int(reference) in parents
    except ValueError:
        return False


@pytest.mark.parametrize("shuffled", [False, True])
@QUICK
@given(
    references=st.lists(st.one_of(st.none(), st.sampled_from(["1", "2", "3", "x"])), max_size=40),
    parents=st.sets(st.integers(1, 4), max_size=3),
)
def test_lookup_has_three_values(spark, shuffled, references, parents):
    child = spark.createDataFrame([(i, r) for i, r in enumerate(references)], "i int, fk string")
    keys = spark.createDataFrame([(p,) for p in sorted(parents)] * 2, "k bigint")
    marked = lookups.mark_exists(child, "fk", keys, "found", shuffled=shuffled)
    assert sorted((r.i, r.found) for r in marked.collect()) == [
        (i, expected_flag(r, parents)) for i, r in enumerate(references)
    ]
    hits = lookups.semi(child, "fk", keys, shuffled=shuffled)
    assert sorted(r.i for r in hits.collect()) == [
        i for i, r in enumerate(references) if expected_flag(r, parents)
    ]


@pytest.fixture
def small_partitions(spark):
    """Skew handling as on large tables, at the size of a test."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "512",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def largest_share(joined) -> float:
    sizes = [len(part) for part in joined.rdd.glom().collect()]
    return max(sizes) / sum(sizes)


def test_hot_key_is_spread(spark, small_partitions):
    """One parent owns most rows; no task may receive them all."""
    child = spark.range(0, 9000, numPartitions=30).select(
        F.when(F.col("id") < 6000, "7").otherwise(F.col("id").cast("string")).alias("fk"), F.sha2(F.col("id").cast("string"), 256).alias("more")
    )
    keys = spark.range(0, 9000).select("id")
    joined = lookups.mark_exists(child, "fk", keys, "found", parents_unique=True)
    assert "NestedLoop" not in plan(joined) and "CartesianProduct" not in plan(joined)
    rows = joined.collect()
    assert len(rows) == 9000 and all(r.found for r in rows)
    assert "skew=true" in plan(joined)
    assert largest_share(joined) < 0.2
    # The same after another dealing of the rows.
    again = lookups.mark_exists(child.repartition(7, "more"), "fk", keys, "found", parents_unique=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_rows_without_reference_are_spread(spark, small_partitions):
    child = spark.range(0, 8000, numPartitions=20).select(
        F.when(F.col("id") % 10 == 9, F.col("id").cast("string")).alias("fk"), F.sha2(F.col("id").cast("string"), 256).alias("more")
    )
    joined = lookups.mark_exists(child, "fk", spark.range(1, 3000).select("id"), "found")
    rows = joined.collect()
    assert len(rows) == 8000 and sum(r.found is None for r in rows) == 7200
    assert largest_share(joined) < 0.3


def test_each_parent_is_read_once(spark, tmp_path):
    for name in ("patients", "doctors", "rows"):
        spark.range(20).write.parquet(str(tmp_path / name))
    domain = DOMAINS["admissions"]
    raw = spark.read.parquet(str(tmp_path / "rows")).select(*[F.col("id").cast("string").alias(c) for c in domain.column_names])
    parents = {name: spark.read.parquet(str(tmp_path / name)) for name in ("patients", "doctors")}
    for shuffled in (False, True):
        judged = rules.judge(raw, domain, parents, parents_unique=True, parents_empty=dict.fromkeys(parents, False), shuffled=shuffled)
        assert plan(judged).count("FileScan") == 3


# ---- validation ------------------------------------------------------------

TIMES = st.sampled_from(["2024-01-01 08:00:00", "2024-1-5", "2024-01-10", "", "bad", None])


@QUICK
@given(
    rows=st.lists(
        st.tuples(
            st.sampled_from(["1", "2", "x", None]), st.sampled_from(["1", "9", None, "y"]), TIMES, TIMES,
            st.sampled_from(["5", "8", None]),
        ),
        min_size=1,
        max_size=30,
    ),
    strict=st.booleans(),
)
def test_every_row_gets_one_outcome(spark, rows, strict):
    """Accepted, logged and dropped rows add up; strict mode drops nothing."""
    domain = DOMAINS["admissions"]
    records = [
        (a, p, t1, t2, "d", "w", "1", doc, "ER", "s", dt.datetime(2024, 1, 1)) for a, p, t1, t2, doc in rows
    ]
    schema = ", ".join(f"{c} string" for c in domain.column_names) + ", load_time timestamp_ntz"
    raw = spark.createDataFrame(records, schema)
    parents = {
        "patients": spark.createDataFrame([(1,), (2,)], "patient_id bigint"),
        "doctors": spark.createDataFrame([(5,)], "doctor_id bigint"),
    }
    judged = rules.judge(raw, domain, parents, strict=strict)
    now = F.lit(dt.datetime(2024, 1, 1))
    accepted = sorted(map(repr, rules.accepted(judged).collect()))
    logged = rules.data_errors(judged, domain, now).count() + rules.business_errors(judged, domain, now).count()
    verdicts = defaultdict(int, {r[0]: r[1] for r in rules.with_verdict(judged).groupBy("verdict").count().collect()})
    assert sum(verdicts.values()) == len(rows)
    assert len(accepted) == verdicts["ACCEPTED"]
    assert logged == verdicts["DATA_ERROR"] + verdicts["BUSINESS_ERROR"]
    assert not strict or verdicts["DROPPED"] == 0
    # The filter form picks the same rows as the judging form.
    assert sorted(map(repr, rules.select_accepted(raw, domain, parents).collect())) == accepted


def test_null_reference_with_no_parents_is_logged(spark):
    domain = DOMAINS["procedures"]
    schema = ", ".join(f"{c} string" for c in domain.column_names) + ", load_time timestamp_ntz"
    row = ("1", None, "1", "p", "1", "2024-01-01", "2024-01-01", "2024-01-02", "o", "a", "s", dt.datetime(2024, 1, 1))
    raw = spark.createDataFrame([row], schema)
    none = spark.createDataFrame([], "admission_id bigint")
    some = spark.createDataFrame([(5,)], "admission_id bigint")
    for keys, verdict in ((none, "BUSINESS_ERROR"), (some, "DROPPED")):
        judged = rules.judge(raw, domain, {"admissions": keys})
        assert column(rules.with_verdict(judged), F.col("verdict")) == [verdict]


def test_validation_never_pairs_rows_with_parents(spark):
    domain = DOMAINS["admissions"]
    schema = ", ".join(f"{c} string" for c in domain.column_names) + ", load_time timestamp_ntz"
    raw = spark.createDataFrame([], schema)
    parents = {"patients": spark.range(5), "doctors": spark.range(5)}
    for shuffled in (False, True):
        text = plan(rules.judge(raw, domain, parents, shuffled=shuffled))
        assert "NestedLoop" not in text and "Cartesian" not in text


# ---- dedup, merge ----------------------------------------------------------


def test_dedup_prefers_newest_and_breaks_ties(spark):
    rows = [(1, "a", dt.datetime(2024, 1, 1)), (1, "b", dt.datetime(2024, 1, 2)), (1, "c", dt.datetime(2024, 1, 2)),
            (2, None, dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "k bigint, v string, load_time timestamp_ntz")
    assert sorted((r.k, r.v) for r in latest_per_key(df, "k").collect()) == [(1, "c"), (2, None)]


def test_dedup_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.current_timestamp().alias("load_time"), "id")
    text = plan(latest_per_key(df, "k"))
    partial = text.index("row_number(), 1, Partial")
    assert text.index("Exchange hashpartitioning") < partial  # printed top-down: below the exchange


def test_dedup_and_merge_share_one_shuffle_of_the_source(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        source = spark.range(100).select((F.col("id") % 30).alias("k"), F.lit("n").alias("v"), F.lit(1).alias("load_time"))
        target = spark.range(50).select(F.col("id").alias("k"), F.lit("o").alias("v"), F.lit(0).alias("load_time"))
        for updates in ((), ("v",)):
            text = plan(merge_changes(target, latest_per_key(source, "k"), "k", updates))
            assert text.count("Exchange hashpartitioning") == 2  # one per side
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


TABLE = st.dictionaries(st.integers(1, 8), st.tuples(st.sampled_from([None, "p", "q"]), st.integers(0, 9)), max_size=8)


@QUICK
@given(target=TABLE, source=TABLE, updates=st.sampled_from([(), ("a",), ("a", "b")]))
def test_merge_equals_row_by_row_merge(spark, target, source, updates):
    schema = "k bigint, a string, b bigint"
    t = spark.createDataFrame([(k, *v) for k, v in target.items()], schema)
    s = spark.createDataFrame([(k, *v) for k, v in source.items()], schema)
    expected = dict(target)
    for k, new in source.items():
        if k not in target:
            expected[k] = new
        else:
            old = dict(zip("ab", target[k]))
            old.update({c: v for c, v in zip("ab", new) if c in updates})
            expected[k] = (old["a"], old["b"])
    merged = {r.k: (r.a, r.b) for r in merge(t, s, "k", updates).collect()}
    assert merged == expected
    changes = {r.k: (r.a, r.b) for r in merge_changes(t, s, "k", updates).collect()}
    assert changes == {k: expected[k] for k in source if updates or k not in target}


# ---- dimensions, masking, audits -------------------------------------------


def test_scd2_refresh(spark):
    day1, day2 = dt.date(2026, 3, 17), dt.date(2026, 3, 18)
    before = spark.createDataFrame([(101, "Hyderabad"), (102, "Pune")], "patient_id bigint, city string")
    after = spark.createDataFrame([(101, "Vijayawada"), (103, None)], "patient_id bigint, city string")
    dim = scd2.open_versions(before, ["patient_id", "city"], day1)
    dim = scd2.refresh(dim, after, "patient_id", day2)
    assert sorted(map(tuple, dim.collect())) == [
        (101, "Hyderabad", day1, day1, "N"),
        (101, "Vijayawada", day2, None, "Y"),
        (102, "Pune", day1, None, "Y"),  # no longer in silver: stays current
        (103, None, day2, None, "Y"),
    ]
    assert [r.city for r in scd2.history(dim, "patient_id", 101).collect()] == ["Hyderabad", "Vijayawada"]
    again = scd2.refresh(dim, after, "patient_id", day2, only_changed=True)
    assert again.count() == dim.count()  # nothing changed, NULL city included


def test_masking_covers_null(spark):
    df = spark.createDataFrame([(1, "a@x"), (2, None)], "id int, email string")
    assert column(masking.masked(df, ["email"], "ANALYST"), F.col("email")) == ["****MASKED****"] * 2
    assert column(masking.masked(df, ["email"], "ACCOUNTADMIN"), F.col("email")) == ["a@x", None]


def test_audits(spark):
    table = spark.createDataFrame([(1,), (1,), (2,)], "k bigint")
    assert [tuple(r) for r in audit.duplicate_keys(table, "k").collect()] == [(1, 2)]
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "fk bigint")
    assert [tuple(r) for r in audit.orphans(child, "fk", table.distinct(), "k").collect()] == [(9, 2)]
