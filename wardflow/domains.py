"""The five domains as data: columns, types, rules, keys and merge policy.

Everything the loads need to know about a domain is declared here, so the
operators stay generic DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Silver column kinds and the Spark type each one is stored as. Whole numbers have
# up to 38 digits: keys issued elsewhere need not fit 64 bits. Event times are
# zone-less wall-clock times, so results never depend on the session time zone.
SPARK_TYPES: dict[str, T.DataType] = {
    "key": T.DecimalType(38, 0),
    "int": T.DecimalType(38, 0),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "double": T.DoubleType(),
}

LOAD_TIME = "load_time"

# Arrival columns the landing tables carry besides the delivered ones. They
# order rows that share a load_time and keep malformed lines traceable.
SOURCE_FILE = "_source_file"
SOURCE_MODIFIED = "_source_modified"
CORRUPT = "_corrupt_record"
ARRIVAL_COLUMNS = (SOURCE_MODIFIED, SOURCE_FILE, CORRUPT)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class Domain:
    name: str
    key: str
    columns: tuple[tuple[str, str], ...]  # (name, kind) in file order
    required: tuple[tuple[str, str], ...]  # level 1: (column, number|date|timestamp|email)
    data_error: str
    update_columns: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    time_order: tuple[str, str] | None = None  # (earlier, later), level 2
    non_negative: str | None = None  # level 2
    business_error: str | None = None
    loaded: str = ""
    no_data: str | None = None  # status when the feed is empty; None = no guard
    pii: tuple[str, ...] = ()
    multi_line: bool = True  # a quoted field of its files may hold line breaks

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def has_business_rules(self) -> bool:
        return self.business_error is not None

    def drop_schema(self) -> T.StructType:
        """Schema of one delivered CSV file: every column text, bound by position."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.column_names])

    def landing_schema(self) -> T.StructType:
        schema = self.drop_schema().add(LOAD_TIME, T.TimestampNTZType())
        return (
            schema.add(SOURCE_MODIFIED, T.TimestampType())
            .add(SOURCE_FILE, T.StringType())
            .add(CORRUPT, T.StringType())
        )

    def silver_schema(self) -> T.StructType:
        fields = [T.StructField(c, SPARK_TYPES[kind]) for c, kind in self.columns]
        return T.StructType(fields).add(LOAD_TIME, T.TimestampNTZType())


# ---------------------------------------------------------------------------
# Names, rules and messages users of the data already rely on.
# ---------------------------------------------------------------------------

DATA_ERROR = "DATA_ERROR"
BUSINESS_ERROR = "BUSINESS_ERROR"
MASK_TEXT = "****MASKED****"
ADMIN_ROLES = ("ACCOUNTADMIN", "SYSADMIN")
ON_TIME_MINUTES = 10
BILL_CEILING = 100000
HOURS_PER_DAY = 24

PATIENTS = Domain(
    name="patients",
    key="patient_id",
    columns=(
        ("patient_id", "key"),
        ("name", "string"),
        ("dob", "date"),
        ("gender", "string"),
        ("email", "string"),
        ("phone", "string"),
        ("address", "string"),
        ("city", "string"),
        ("state", "string"),
        ("insurance_id", "string"),
        ("registration_date", "date"),
    ),
    required=(("patient_id", "number"), ("dob", "date"), ("email", "email")),
    data_error="Invalid patient data",
    update_columns=("name", "city", "state", "load_time"),
    loaded="Patients loaded",
    pii=("email", "phone", "insurance_id"),
)

DOCTORS = Domain(
    name="doctors",
    key="doctor_id",
    columns=(
        ("doctor_id", "key"),
        ("name", "string"),
        ("specialization", "string"),
        ("join_date", "date"),
        ("phone", "string"),
        ("email", "string"),
        ("qualification", "string"),
        ("department", "string"),
        ("status", "string"),
    ),
    required=(("doctor_id", "number"), ("join_date", "date"), ("email", "email")),
    data_error="Invalid doctor data",
    update_columns=("name", "department", "load_time"),
    loaded="Doctors loaded",
    no_data="No data in doctors stream",
    pii=("email", "phone"),
)

ADMISSIONS = Domain(
    name="admissions",
    key="admission_id",
    columns=(
        ("admission_id", "key"),
        ("patient_id", "key"),
        ("admission_time", "timestamp"),
        ("discharge_time", "timestamp"),
        ("department", "string"),
        ("ward", "string"),
        ("bed_no", "int"),
        ("attending_doctor_id", "key"),
        ("admission_type", "string"),
        ("status", "string"),
    ),
    required=(
        ("admission_id", "number"),
        ("admission_time", "timestamp"),
        ("discharge_time", "timestamp"),
    ),
    data_error="Invalid admission data",
    update_columns=("patient_id",),
    foreign_keys=(
        ForeignKey("patient_id", "patients", "patient_id"),
        ForeignKey("attending_doctor_id", "doctors", "doctor_id"),
    ),
    time_order=("admission_time", "discharge_time"),
    business_error="FK or time issue",
    loaded="Admissions loaded",
    no_data="No data in admissions stream",
)

PROCEDURES = Domain(
    name="procedures",
    key="procedure_id",
    columns=(
        ("procedure_id", "key"),
        ("admission_id", "key"),
        ("patient_id", "key"),
        ("procedure_name", "string"),
        ("surgeon_id", "key"),
        ("scheduled_time", "timestamp"),
        ("start_time", "timestamp"),
        ("end_time", "timestamp"),
        ("operating_room", "string"),
        ("anaesthesia_type", "string"),
        ("status", "string"),
    ),
    required=(("procedure_id", "number"),),
    data_error="Invalid procedure data",
    foreign_keys=(ForeignKey("admission_id", "admissions", "admission_id"),),
    time_order=("start_time", "end_time"),
    business_error="FK or time issue",
    loaded="Procedures loaded",
    no_data="No data in procedures stream",
)

BILLING = Domain(
    name="billing",
    key="bill_id",
    columns=(
        ("bill_id", "key"),
        ("admission_id", "key"),
        ("patient_id", "key"),
        ("total_amount", "double"),
        ("insurance_amount", "double"),
        ("out_of_pocket_amount", "double"),
        ("billing_time", "timestamp"),
        ("payment_mode", "string"),
        ("is_flagged", "string"),
    ),
    required=(("bill_id", "number"), ("total_amount", "number")),
    data_error="Invalid billing data",
    foreign_keys=(ForeignKey("admission_id", "admissions", "admission_id"),),
    non_negative="total_amount",
    business_error="FK or negative amount",
    loaded="Billing loaded",
    no_data="No data in billing stream",
)

# ---------------------------------------------------------------------------

# Parents come before children: this is also the load order.
DOMAINS: dict[str, Domain] = {
    d.name: d for d in (PATIENTS, DOCTORS, ADMISSIONS, PROCEDURES, BILLING)
}

EXCEPTION_SCHEMA = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("load_time", T.TimestampNTZType()),
    ]
)
