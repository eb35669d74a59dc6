from __future__ import annotations

import datetime as dt
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from tests.fixture_data import INCREMENT, MASTER, deliver
from wardflow.checks import derive
from wardflow.checks.full_run import rows_of_listed
from wardflow.domains import DOMAINS
from wardflow.functions.sizing import bytes_of, planned_bytes
from wardflow.sources import folders
from wardflow.sources.csv_drop import file_inventory, scan_csv
from wardflow.sources.tables import ROW_GROUP, SegmentedTable
from wardflow.sources.warehouse import Warehouse
from wardflow.streaming import loads
from wardflow.streaming.ingest import ingest_available, start_ingest
from wardflow.streaming.loads import load_batch, load_domain
from wardflow.streaming.pipeline import refresh_dimensions, run_pipeline, start_schedule

DAY1, DAY2 = dt.date(2026, 3, 17), dt.date(2026, 3, 18)


def ids(wh: Warehouse, name: str) -> list[int]:
    key = DOMAINS[name].key
    return sorted(r[0] for r in wh.silver(name).select(key).collect())


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """Two deliveries, a run and a dimension refresh after each; state kept in between."""
    root = tmp_path_factory.mktemp("warehouse")
    wh = Warehouse(spark, str(root))
    state = {}
    deliver(root, MASTER, "master")
    state["status1"] = run_pipeline(wh, dims=True, as_of=DAY1)
    state["silver1"] = {d: ids(wh, d) for d in DOMAINS}
    state["exceptions1"] = wh.exceptions().count()
    state["dim1"] = wh.dim("dim_patient").count()
    deliver(root, INCREMENT, "inc")
    state["status2"] = run_pipeline(wh, dims=True, as_of=DAY2)
    state["rerun"] = run_pipeline(wh)
    return wh, state


def test_silver_after_each_delivery(runs):
    wh, state = runs
    assert state["silver1"] == {
        "patients": [1, 5], "doctors": [10, 11], "admissions": [100, 101],
        "procedures": [500, 501], "billing": [900, 901],
    }
    assert {d: ids(wh, d) for d in DOMAINS} == {
        "patients": [1, 5, 6], "doctors": [10, 11], "admissions": [100, 101, 107],
        "procedures": [500, 501, 505], "billing": [900, 901, 905],
    }


def test_status_and_counts(runs):
    _, state = runs
    assert state["status1"].status == (
        "Patients: Patients loaded | Doctors: Doctors loaded | Admissions: Admissions loaded | "
        "Procedures: Procedures loaded | Billing: Billing loaded"
    )
    counts = {load.domain: load.counts for load in state["status1"].loads}
    assert counts["patients"] == dict(rows=6, ACCEPTED=2, DATA_ERROR=3, BUSINESS_ERROR=0, DROPPED=1)
    assert counts["admissions"] == dict(rows=8, ACCEPTED=2, DATA_ERROR=2, BUSINESS_ERROR=3, DROPPED=1)
    assert counts["procedures"] == dict(rows=6, ACCEPTED=2, DATA_ERROR=1, BUSINESS_ERROR=2, DROPPED=1)
    assert counts["billing"] == dict(rows=5, ACCEPTED=2, DATA_ERROR=2, BUSINESS_ERROR=1, DROPPED=0)


def test_rerun_without_new_files_does_nothing(runs):
    _, state = runs
    # Patients has no empty-feed guard, the others say so.
    assert state["rerun"].status == (
        "Patients: Patients loaded | Doctors: No data in doctors stream | "
        "Admissions: No data in admissions stream | Procedures: No data in procedures stream | "
        "Billing: No data in billing stream"
    )


def test_exceptions(runs):
    wh, state = runs
    assert state["exceptions1"] == 15
    logged = wh.exceptions()
    assert logged.count() == 16
    by_kind = {(r[0], r[1]): r[2] for r in logged.groupBy("source_table", "error_type").count().collect()}
    assert by_kind == {
        ("patients", "DATA_ERROR"): 3, ("doctors", "DATA_ERROR"): 1,
        ("admissions", "DATA_ERROR"): 2, ("admissions", "BUSINESS_ERROR"): 3,
        ("procedures", "DATA_ERROR"): 1, ("procedures", "BUSINESS_ERROR"): 2,
        ("billing", "DATA_ERROR"): 2, ("billing", "BUSINESS_ERROR"): 2,
    }
    row = logged.where("record_id = '902'").collect()[0]
    assert (row.error_type, row.error_message) == ("BUSINESS_ERROR", "FK or negative amount")


def test_merge_updates_only_its_columns(runs):
    wh, _ = runs
    asha = wh.silver("patients").where("patient_id = 1").collect()[0]
    assert (asha.name, asha.city, asha.state, asha.email) == ("Asha R", "Vijayawada", "AP", "asha@x.org")
    assert asha.address == '12, "Main" St' and asha.registration_date == dt.date(2024, 1, 1)
    ana = wh.silver("doctors").where("doctor_id = 10").collect()[0]
    assert (ana.department, ana.status) == ("NEURO", "ACTIVE")
    stay = wh.silver("admissions").where("admission_id = 100").collect()[0]
    assert (stay.patient_id, stay.discharge_time) == (5, dt.datetime(2024, 1, 1, 11, 1))
    assert wh.silver("patients").where("patient_id = 5").collect()[0].registration_date is None
    assert wh.silver("billing").where("bill_id = 900").collect()[0].insurance_amount is None


def test_dimension_history(runs):
    wh, state = runs
    assert state["dim1"] == 2
    rows = wh.dim("dim_patient").collect()
    assert len(rows) == 5
    closed = [r for r in rows if r.current_flag == "N"]
    assert len(closed) == 2 and {r.effective_end_date for r in closed} == {DAY1}
    current = [r.patient_id for r in rows if r.current_flag == "Y"]
    assert sorted(current) == [1, 5, 6]


def test_kpis(runs):
    wh, _ = runs

    def value(view):
        return wh.kpi(view).collect()[0][0]

    assert value("bed_occ") == pytest.approx(61 / 48)
    assert value("att") == pytest.approx(61 / 3)
    assert value("surgey_efficiny") == pytest.approx(100 / 3)
    assert value("kpi_data_quality") == pytest.approx(2 / 3)
    assert {r[0]: r[1] for r in wh.kpi("kpi_doctor_workload").collect()} == {10: 1.5, 11: 1.0}


def test_published_names_and_masking(runs, spark):
    wh, _ = runs
    names = wh.register_views(role="ANALYST")
    for name in names:
        spark.sql(f"SELECT * FROM {name}").collect()
    masked = {r[0] for r in spark.sql("SELECT email FROM silver_patients").collect()}
    assert masked == {"****MASKED****"}
    assert wh.silver("patients", role="SYSADMIN").where("patient_id = 6").collect()[0].email == "gus@x.org"
    for name, column in (("silver_patients", "email"), ("silver_doctors", "email")):
        assert {r[0] for r in wh.read_table(name).select(column).collect()} == {"****MASKED****"}
    wh.register_views()
    assert {r[0] for r in spark.sql("SELECT phone FROM silver_patients").collect()} == {"****MASKED****"}
    assert spark.sql("SELECT count(*) FROM raw_patients").collect()[0][0] == 8
    assert spark.sql("SELECT count(*) FROM raw_patients_st").collect()[0][0] == 0


def test_repeated_load_changes_nothing(runs):
    """A batch that is delivered again under its number leaves every table as it was."""
    wh, _ = runs
    domain = DOMAINS["billing"]
    before = (sorted(map(tuple, wh.silver("billing").collect())), wh.exceptions().count())
    sequence = wh.silver_table("billing").last()
    inc = wh.landing("billing").where("_source_file LIKE '%_inc%'")
    load_batch(wh, domain, inc, sequence)
    assert (sorted(map(tuple, wh.silver("billing").collect())), wh.exceptions().count()) == before


def test_inventory_lists_files(runs, spark):
    wh, _ = runs
    files = file_inventory(spark, wh.drop_folder("patients"))
    assert files.columns == ["path", "length", "modified"] and files.count() == 2


def test_pending_rows_and_landing_reset(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    deliver(tmp_path, {d: MASTER[d] for d in DOMAINS}, "master")
    ingest_available(wh)
    assert wh.pending("procedures").count() == 6
    for name in DOMAINS:
        load_domain(wh, name)
    assert wh.pending("procedures").count() == 0
    wh.reset_landing("procedures")
    assert wh.raw("procedures").count() == 0
    ingest_available(wh, ["procedures"])
    assert wh.raw("procedures").count() == wh.pending("procedures").count() == 6
    assert load_domain(wh, "procedures").counts["rows"] == 6
    assert ids(wh, "procedures") == [500, 501]  # matched rows are left alone


def test_strict_mode_logs_undecided_rows(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    deliver(tmp_path, MASTER, "master")
    run_pipeline(wh, strict=True)
    assert wh.exceptions().count() == 18  # 15, and the three rows that are dropped otherwise
    assert {d: ids(wh, d) for d in ("patients", "admissions", "procedures")} == {
        "patients": [1, 5], "admissions": [100, 101], "procedures": [500, 501],
    }


def test_only_changed_dimension_refresh(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    deliver(tmp_path, {"doctors": MASTER["doctors"]}, "master")
    ingest_available(wh, ["doctors"])
    load_domain(wh, "doctors")
    refresh_dimensions(wh, DAY1, only_changed=True)
    deliver(tmp_path, {"doctors": INCREMENT["doctors"]}, "inc")
    ingest_available(wh, ["doctors"])
    load_domain(wh, "doctors")
    refresh_dimensions(wh, DAY2, only_changed=True)
    rows = wh.dim("dim_doctor").select("doctor_id", "department", "current_flag").collect()
    assert sorted(map(tuple, rows)) == [(10, "CARD", "N"), (10, "NEURO", "Y"), (11, "ORTH", "Y")]


def test_csv_details(spark, tmp_path):
    doctors = DOMAINS["doctors"]
    (tmp_path / "a.csv").write_text(
        "any,header,names,do,not,matter,here,at,all\n"
        '1,"12, Main St","q""r",2015-01-01,,"",x,y,z\n'
        "2,short\n"
        "3,a,b,c,d,e,f,g,h,too long\n"
    )
    rows = {r.doctor_id: r for r in scan_csv(spark, doctors, str(tmp_path)).collect()}
    assert (rows["1"].name, rows["1"].specialization) == ("12, Main St", 'q"r')
    assert rows["1"].phone is None and rows["1"]._corrupt_record is None
    assert rows["2"].status is None and rows["2"]._corrupt_record == "2,short"
    assert rows["3"].status == "h" and rows["3"]._corrupt_record is not None


def test_records_may_span_lines_and_empty_text_is_not_missing(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    folder = tmp_path / "drops" / "doctors"
    folder.mkdir(parents=True)
    (folder / "d.csv").write_text(
        "doctor_id,name,specialization,join_date,phone,email,qualification,department,status\n"
        '1,"Ann\nof two lines","a ""b""\n\nc",2015-01-01,,ann@h.org,MD,D,ok\n'
        '2,Bob,x,2015-01-01,,"",MD,D,ok\n'
        "3,Cy,x,2015-01-01,,,MD,D,ok\n"
    )
    run_pipeline(wh)
    rows = {r.doctor_id: r for r in wh.raw("doctors").collect()}
    assert rows["1"].name == "Ann\nof two lines" and rows["1"].specialization == 'a "b"\n\nc' and rows["1"].phone is None
    assert rows["2"].email == "" and rows["3"].email is None and wh.malformed("doctors").isEmpty()
    # An empty address is no address and is logged; whether a missing one is cannot be decided.
    assert [r.record_id for r in wh.exceptions().collect()] == ["2"] and ids(wh, "doctors") == [1]


def test_keys_beyond_64_bits(spark, tmp_path):
    wide, wider = 10**19 + 7, 10**37 + 9
    wh = Warehouse(spark, str(tmp_path))
    patient = {**MASTER["patients"][0], "patient_id": str(wide)}
    stay = {**MASTER["admissions"][0], "admission_id": str(wider), "patient_id": str(wide), "bed_no": str(wide)}
    deliver(tmp_path, {"patients": [patient], "doctors": MASTER["doctors"], "admissions": [stay]}, "a")
    run_pipeline(wh, dims=True, as_of=DAY1)
    deliver(tmp_path, {"patients": [{**patient, "city": "Elsewhere"}], "admissions": [stay]}, "b")
    run_pipeline(wh, dims=True, as_of=DAY2)
    assert ids(wh, "patients") == [wide] and ids(wh, "admissions") == [wider]
    assert wh.silver("patients").first().city == "Elsewhere"
    fact = wh.fact("admissions").collect()
    assert [(r.admission_id, r.patient_id, r.bed_no) for r in fact] == [(wider, wide, wide)]
    assert sorted(r.current_flag for r in wh.dim("dim_patient").collect()) == ["N", "Y"]


def test_many_runs_leave_a_bounded_number_of_segments(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(SegmentedTable.fold, "__defaults__", (0.2, 3))
    wh = Warehouse(spark, str(tmp_path))
    for k in range(8):
        rows = [{**MASTER["doctors"][0], "department": f"D{k}"}, {**MASTER["doctors"][1], "doctor_id": str(100 + k)}, MASTER["doctors"][2]]
        deliver(tmp_path, {"doctors": rows}, f"day{k}")
        run_pipeline(wh, dims=True, as_of=DAY1 + dt.timedelta(days=k))
    tables = [wh.silver_table("doctors"), wh.dim_history("dim_doctor"), wh.dim_current("dim_doctor")]
    assert all(len(t.live()) <= 5 and len(t.committed()) <= 9 for t in tables)
    assert wh.exceptions().count() == 8
    assert ids(wh, "doctors") == [10, *range(100, 108)] and wh.silver("doctors").where("doctor_id = 10").first().department == "D7"
    # Every refresh closed and reopened each doctor known by then.
    dim = wh.dim("dim_doctor")
    assert dim.where("current_flag = 'Y'").count() == 9 and dim.count() == sum(k + 2 for k in range(8))


def test_shuffled_lookups_give_the_same_tables(spark, tmp_path):
    """A batch too large to broadcast its keys takes the shuffle joins."""
    wh = Warehouse(spark, str(tmp_path))
    for delivery, suffix in ((MASTER, "master"), (INCREMENT, "inc")):
        deliver(tmp_path, delivery, suffix)
        ingest_available(wh)
        for name in ("patients", "doctors"):
            load_domain(wh, name, small_batch=0)
        for name in ("admissions", "procedures", "billing"):
            load_domain(wh, name, small_batch=0, shuffled=True)
    assert {d: ids(wh, d) for d in DOMAINS} == {
        "patients": [1, 5, 6], "doctors": [10, 11], "admissions": [100, 101, 107],
        "procedures": [500, 501, 505], "billing": [900, 901, 905],
    }
    assert wh.exceptions().count() == 16


def test_schedule_runs_the_pipeline(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    deliver(tmp_path, {"doctors": MASTER["doctors"]}, "master")
    query = start_schedule(wh, every="1 second")
    try:
        for _ in range(120):
            if query.exception() or wh.silver_table("doctors").last():
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert ids(wh, "doctors") == [10, 11]


def test_schedule_with_ticks_by_hand(spark, tmp_path):
    wh, told = Warehouse(spark, str(tmp_path / "root")), []
    deliver(tmp_path / "root", {"doctors": MASTER["doctors"]}, "master")
    for tick in range(2):
        spark.range(tick, tick + 1).coalesce(1).write.mode("append").parquet(str(tmp_path / "clock"))
    ticks = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "clock"))
    start_schedule(wh, every=None, ticks=ticks, on_run=told.append).awaitTermination()
    assert [report.loads[1].status for report in told] == ["Doctors loaded", "No data in doctors stream"]


def test_schedule_goes_on_after_a_failing_run(spark, tmp_path, monkeypatch):
    wh, runs = Warehouse(spark, str(tmp_path)), []

    def failing(*args, **options):
        runs.append(1)
        if len(runs) != 3:
            raise RuntimeError("a failing run")

    monkeypatch.setattr("wardflow.streaming.pipeline.run_pipeline", failing)
    query = start_schedule(wh, every="1 second", max_failures=3)
    with pytest.raises(Exception, match="a failing run"):
        query.awaitTermination(120)
    assert len(runs) == 6  # two failures, a good run, then three failures in a row


def test_ingest_takes_only_new_files_in_bounded_batches(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    deliver(tmp_path, {"doctors": MASTER["doctors"]}, "master")
    deliver(tmp_path, {"doctors": INCREMENT["doctors"]}, "inc")
    ingest_available(wh, ["doctors"], maxFilesPerTrigger="1")
    first = wh.landing("doctors").select("load_time", "_source_file").distinct().collect()
    assert len({r.load_time for r in first}) == 2 and len({r._source_file for r in first}) == 2
    ingest_available(wh, ["doctors"])
    assert wh.raw("doctors").count() == 4
    deliver(tmp_path, {"doctors": INCREMENT["doctors"]}, "inc2")
    ingest_available(wh, ["doctors"])
    assert wh.raw("doctors").count() == 5


def test_malformed_lines_can_be_found(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    folder = tmp_path / "drops" / "doctors"
    folder.mkdir(parents=True)
    (folder / "d.csv").write_text("doctor_id,name,etc\n1,short\n")
    ingest_available(wh, ["doctors"])
    assert [r._corrupt_record for r in wh.malformed("doctors").collect()] == ["1,short"]


def snapshot(wh: Warehouse):
    logged = sorted((r.source_table, r.record_id, r.error_type) for r in wh.exceptions().collect())
    return {d: sorted(map(repr, wh.silver(d).drop("load_time").collect())) for d in DOMAINS}, logged


def test_load_interrupted_at_any_step_recovers(spark, tmp_path, monkeypatch):
    """A failing step leaves the batch unconsumed; the next run repeats it and the
    tables end up as if nothing had happened."""
    from wardflow.streaming import loads

    def build(root: Path, broken: dict[str, list[str]]) -> Warehouse:
        wh = Warehouse(spark, str(root))
        deliver(root, MASTER, "master")
        ingest_available(wh)
        for name in DOMAINS:
            for step in broken.get(name, []):
                with monkeypatch.context() as patch:
                    patch.setattr(SegmentedTable if step == "fold" else loads, step, fail)
                    with pytest.raises(Exception, match="executor gone"):
                        load_domain(wh, name)
            load_domain(wh, name)
        return wh

    def fail(*args, **kwargs):
        raise RuntimeError("executor gone")

    smooth = build(tmp_path / "smooth", {})
    rough = build(tmp_path / "rough", {"patients": ["fold"], "billing": ["write_exceptions", "merge_changes"]})
    assert snapshot(rough) == snapshot(smooth)
    assert all(wh.pending(d).isEmpty() for wh in (smooth, rough) for d in DOMAINS)


def test_duplicates_are_logged_one_by_one(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    bad = MASTER["patients"][1]
    deliver(tmp_path, {"patients": [bad, bad, bad, MASTER["patients"][0], MASTER["patients"][0]]}, "master")
    ingest_available(wh, ["patients"])
    load_domain(wh, "patients")
    assert wh.exceptions().count() == 3 and ids(wh, "patients") == [1]


def test_spellings_of_one_key_are_one_row(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    first = MASTER["patients"][0]
    deliver(tmp_path, {"patients": [first, {**first, "patient_id": "01"}, {**first, "patient_id": " 1 "}]}, "m")
    ingest_available(wh, ["patients"])
    load_domain(wh, "patients")
    assert ids(wh, "patients") == [1]


def test_continuous_ingest_sees_files_as_they_arrive(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    deliver(tmp_path, {"doctors": MASTER["doctors"]}, "master")
    query = start_ingest(wh, "doctors", every="1 second")
    try:
        for expected, delivery in ((3, None), (4, INCREMENT)):
            if delivery:
                deliver(tmp_path, {"doctors": delivery["doctors"]}, "inc")
            for _ in range(60):
                if wh.raw("doctors").count() >= expected:
                    break
                time.sleep(0.5)
            assert wh.raw("doctors").count() == expected
    finally:
        query.stop()


def test_load_reads_the_columns_it_needs(spark, tmp_path, monkeypatch):
    """A batch is read from its files, column by column, in splits a task can sort in memory;
    it is staged in one piece, the values of accepted rows only."""
    wh = Warehouse(spark, str(tmp_path))
    plans, splits, staged = [], [], []

    def watched(wh, domain, batch, sequence, **options):
        plans.append(batch.select(domain.key)._jdf.queryExecution().executedPlan().toString())
        splits.append(int(batch.sparkSession.conf.get(loads.SPLIT).removesuffix("b")))
        return load_batch(wh, domain, batch, sequence, **options)

    def kept(rows, domain, log_time):
        staged.append(folders.children(spark, f"{folders.stage_folder(spark, wh.root)}/{domain.name}-1"))
        return staged_exceptions(rows, domain, log_time)

    staged_exceptions = loads.rules.staged_exceptions
    monkeypatch.setattr(loads, "load_batch", watched)
    monkeypatch.setattr(loads.rules, "staged_exceptions", kept)
    deliver(tmp_path, MASTER, "master")
    run_pipeline(wh)
    assert len(plans) == len(DOMAINS) and all(p.count("string>") == 1 and "FileScan" in p and "," not in p.split("ReadSchema: struct<")[1].split(">")[0] for p in plans)
    assert set(splits) == {loads.SMALL_SPLIT}
    assert len(staged) == 3 and not any(name.startswith("verdict=") for names in staged for name in names)
    assert ids(wh, "admissions") == [100, 101] and wh.exceptions().count() == 15


def test_partitions_follow_the_batch(spark, tmp_path, monkeypatch):
    """Shuffles get partitions by the bytes a batch holds, not by the session; the landing
    table's row groups are small, so that its splits are. The session is as before afterwards."""
    wh = Warehouse(spark, str(tmp_path))
    seen = []

    def watched(wh, domain, batch, sequence, **options):
        seen.append(int(batch.sparkSession.conf.get(loads.PARTITIONS)))
        return load_batch(wh, domain, batch, sequence, **options)

    monkeypatch.setattr(loads, "load_batch", watched)
    monkeypatch.setattr(loads, "SHARE_STORED", 100)
    monkeypatch.setitem(ROW_GROUP, "parquet.block.size", "1024")
    before = {k: spark.conf.get(k, None) for k in (loads.PARTITIONS, loads.SPLIT, loads.ADVISED, *ROW_GROUP)}
    rows = spark.range(20000).selectExpr(*[f"cast({'id' if c == 'doctor_id' else 'xxhash64(id)'} AS string) AS {c}" for c in DOMAINS["doctors"].column_names])
    rows.coalesce(1).write.option("header", True).csv(wh.drop_folder("doctors"))
    ingest_available(wh, ["doctors"])
    groups = [pq.ParquetFile(p).num_row_groups for p in (tmp_path / "bronze" / "doctors" / "gen-0").glob("*.parquet")]
    assert max(groups) > 1
    load_domain(wh, "doctors")
    assert seen and min(seen) > 100
    assert {k: spark.conf.get(k, None) for k in before} == before


def test_staged_rows_keep_the_settings_of_the_batch(spark, tmp_path, monkeypatch):
    """Reading back in the caller's session would sort usual splits in the session's partitions."""
    wh, seen = Warehouse(spark, str(tmp_path)), {}

    def watched(rows, key, **options):
        conf = rows.sparkSession.conf
        seen[key] = (int(conf.get(loads.PARTITIONS)), bytes_of(conf.get(loads.SPLIT)), bytes_of(conf.get(loads.ADVISED)))
        return latest(rows, key, **options)

    latest = loads.latest_per_key
    monkeypatch.setattr(loads, "latest_per_key", watched)
    monkeypatch.setattr(loads, "SHARE_STORED", 1000)
    deliver(tmp_path, MASTER, "master")
    run_pipeline(wh)
    assert len(seen) == len(DOMAINS)
    assert all(n > 4 and split == loads.SMALL_SPLIT and share == loads.SMALL_SHARE for n, split, share in seen.values())


def test_rows_are_counted_by_file_before_they_meet_the_inventory(spark):
    """A few files own all rows: a shuffle of rows by file would leave most tasks idle."""
    landing = spark.range(1000).selectExpr("concat('f', id % 3) AS _source_file")
    known = rows_of_listed(landing, spark.createDataFrame([("/drops/f0",), ("/drops/f1",)], "path string"))
    assert known.first()[0] == 667
    plan = known._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [_source_file" in plan.split("Join LeftSemi")[1]


def test_given_tables_are_joined_in_as_many_parts_as_they_hold(spark, monkeypatch):
    monkeypatch.setattr(derive, "TASK_BYTES", 10_000)
    lines = derive.table(spark, "/root/testdata/sf0.001", "lineitem")
    parts = -(-planned_bytes(lines) // 10_000)
    assert parts > spark.sparkContext.defaultParallelism
    for together in (False, True):
        rows = derive.raw_admissions(spark, "/root/testdata/sf0.001", together=together)
        assert f", {parts}), REPARTITION_BY_NUM" in rows._jdf.queryExecution().executedPlan().toString()
        assert rows.count() == lines.count()
