"""The hand-made two-delivery data set: rows that hit every rule."""

from __future__ import annotations

import csv
from pathlib import Path

from wardflow.domains import DOMAINS

MASTER: dict[str, list[dict[str, str]]] = {
    "patients": [
        dict(patient_id="1", name="Asha", dob="1980-01-05", email="asha@x.org", city="Hyderabad", state="TS",
             phone="1", insurance_id="I1", address='12, "Main" St', registration_date="2024-01-01"),
        dict(patient_id="2", name="Ben", dob="1975-02-30", email="ben@x.org"),
        dict(patient_id="abc", name="Cal", dob="1990-01-01", email="cal@x.org"),
        dict(patient_id="3", name="Dee", dob="1991-03-03", email="dee.x.org"),
        dict(patient_id="4", name="Eli", dob="1960-07-07", email=""),
        dict(patient_id="5", name="Fay", dob="1988-08-08", email="fay@x.org", registration_date="bad"),
    ],
    "doctors": [
        dict(doctor_id="10", name="Ana", join_date="2015-01-01", email="ana@h.org", department="CARD",
             status="ACTIVE"),
        dict(doctor_id="11", name="Bob", join_date="2014-01-01", email="bob@h.org", department="ORTH",
             status="ACTIVE"),
        dict(doctor_id="12", name="Cy", join_date="2016-13-01", email="cy@h.org"),
    ],
    "admissions": [
        dict(admission_id="100", patient_id="1", admission_time="2024-01-01 10:59:00",
             discharge_time="2024-01-01 11:01:00", bed_no="1", attending_doctor_id="10"),
        dict(admission_id="101", patient_id="5", admission_time="2024-01-02 08:00:00",
             discharge_time="2024-01-04 08:30:00", bed_no="2", attending_doctor_id="11"),
        dict(admission_id="102", patient_id="99", admission_time="2024-01-02 08:00:00",
             discharge_time="2024-01-04 08:30:00", bed_no="2", attending_doctor_id="11"),
        dict(admission_id="103", patient_id="1", admission_time="2024-01-02 08:00:00",
             discharge_time="2024-01-04 08:30:00", bed_no="2", attending_doctor_id="12"),
        dict(admission_id="104", patient_id="1", admission_time="2024-01-04 08:00:00",
             discharge_time="2024-01-03 08:30:00", bed_no="2", attending_doctor_id="10"),
        dict(admission_id="105", patient_id="1", admission_time="2024-01-04 08:00:00", discharge_time="",
             bed_no="2", attending_doctor_id="10"),
        dict(admission_id="106", patient_id="", admission_time="2024-01-02 08:00:00",
             discharge_time="2024-01-04 08:30:00", bed_no="2", attending_doctor_id="11"),
        dict(admission_id="A7", patient_id="1", admission_time="2024-01-02 08:00:00",
             discharge_time="2024-01-04 08:30:00", bed_no="2", attending_doctor_id="11"),
    ],
    "procedures": [
        dict(procedure_id="500", admission_id="100", surgeon_id="10", scheduled_time="2024-01-01 11:00:00",
             start_time="2024-01-01 11:10:59", end_time="2024-01-01 12:00:00"),
        dict(procedure_id="501", admission_id="101", surgeon_id="11", scheduled_time="2024-01-03 09:00:59",
             start_time="2024-01-03 09:11:00", end_time="2024-01-03 10:00:00"),
        dict(procedure_id="502", admission_id="999", surgeon_id="11", scheduled_time="2024-01-03 09:00:59",
             start_time="2024-01-03 09:11:00", end_time="2024-01-03 10:00:00"),
        dict(procedure_id="503", admission_id="101", surgeon_id="11", scheduled_time="2024-01-03 11:00:00",
             start_time="2024-01-03 11:10:59", end_time="2024-01-03 10:00:00"),
        dict(procedure_id="504", admission_id="100", surgeon_id="11", scheduled_time="2024-01-03 11:00:00",
             start_time="", end_time="2024-01-03 10:00:00"),
        dict(procedure_id="P5", admission_id="100", surgeon_id="11", scheduled_time="2024-01-03 11:00:00",
             start_time="2024-01-03 11:10:59", end_time="2024-01-03 12:00:00"),
    ],
    "billing": [
        dict(bill_id="900", admission_id="100", total_amount="1000.50", insurance_amount="bad", is_flagged="TRUE"),
        dict(bill_id="901", admission_id="101", total_amount="150000"),
        dict(bill_id="903", admission_id="999", total_amount="10"),
        dict(bill_id="904", admission_id="100", total_amount="abc"),
        dict(bill_id="B9", admission_id="100", total_amount="10"),
    ],
}

INCREMENT: dict[str, list[dict[str, str]]] = {
    "patients": [
        dict(patient_id="1", name="Asha R", dob="1980-01-05", email="asha2@x.org", city="Vijayawada", state="AP"),
        dict(patient_id="6", name="Gus", dob="1970-01-01", email="gus@x.org"),
    ],
    "doctors": [
        dict(doctor_id="10", name="Ana", join_date="2015-01-01", email="ana@h.org", department="NEURO",
             status="ON_LEAVE"),
    ],
    "admissions": [
        dict(admission_id="100", patient_id="5", admission_time="2024-01-01 10:59:00",
             discharge_time="2024-01-09 11:01:00", bed_no="1", attending_doctor_id="10"),
        dict(admission_id="107", patient_id="6", admission_time="2024-01-05 00:00:00",
             discharge_time="2024-01-05 12:00:00", bed_no="1", attending_doctor_id="10"),
    ],
    "procedures": [
        dict(procedure_id="505", admission_id="107", surgeon_id="11", scheduled_time="",
             start_time="2024-01-05 02:00:00", end_time="2024-01-05 03:00:00"),
    ],
    "billing": [
        dict(bill_id="902", admission_id="107", total_amount="-5"),
        dict(bill_id="905", admission_id="107", total_amount="0"),
    ],
}


def deliver(root: Path, rows: dict[str, list[dict[str, str]]], suffix: str) -> None:
    """Write one delivery as CSV files into the drop folders."""
    for name, records in rows.items():
        folder = root / "drops" / name
        folder.mkdir(parents=True, exist_ok=True)
        with open(folder / f"{name}_{suffix}.csv", "w", newline="") as file:
            writer = csv.writer(file)
            columns = DOMAINS[name].column_names
            writer.writerow(columns)
            for record in records:
                writer.writerow([record.get(c, "x") for c in columns])
