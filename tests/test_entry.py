"""The driver contract: names agree, and results equal the SQL on the small tables."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

import __spark_entry__ as contract
from wardflow.__main__ import main
from wardflow.checks.compare import differences
from wardflow.checks.oracle import all_sql
from tests.fixture_data import MASTER, deliver

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUICK = (
    "scan_all", "fn_try_number", "fn_datediff_minute", "exceptions_patients", "strict_patients",
    "fk_semi", "fk_not_in", "fk_not_in_salted", "audit_pk", "dedup_latest", "merge_patients", "merge_insert_only",
    "scd2_refresh", "scd2_only_changed", "mask_patients", "fact_admissions", "kpi_bed_utilization",
    "kpi_surgery", "kpi_workload", "kpi_billing_accuracy", "csv_scan",
)
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


def test_every_query_has_its_sql():
    assert {q for q in contract.queries() if q != "pipeline" and not q.startswith("op")} == set(all_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@needs_tables
@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, name):
    assert differences(contract.queries()[name](spark, SF_DIR), SF_DIR, contract.oracle_sql()[name]) is None


@needs_tables
def test_flagship(spark):
    assert contract.entry(spark).columns == ["doctor_id", "doctor_workload_index"]


def test_command_line(spark, tmp_path, capsys):
    deliver(tmp_path, {"doctors": MASTER["doctors"]}, "master")
    main(["--root", str(tmp_path), "files", "doctors"])
    main(["--root", str(tmp_path), "run"])
    main(["--root", str(tmp_path), "sql", "SELECT doctor_id FROM silver_doctors ORDER BY 1"])
    out = capsys.readouterr().out
    assert "doctors_master.csv" in out and "Doctors: Doctors loaded" in out and "10" in out
