"""The same results in plain SQL, from the same tables."""

from __future__ import annotations

# Common table expressions, each built on the ones before it.
_CTES: dict[str, str] = {
    "raw_patients": """
        SELECT CASE WHEN c_acctbal < -500 THEN 'X' || c_custkey WHEN c_custkey % 50 = 7 THEN '9' || lpad(CAST(c_custkey AS VARCHAR), 19, '0')
                    ELSE CAST(c_custkey AS VARCHAR) END AS patient_id,
               c_name AS name,
               CASE WHEN c_nationkey = 7 THEN '1990-02-30'
                    ELSE strftime(DATE '1950-01-01' + (CAST(floor(c_acctbal) AS INT) + 1000), '%Y-%m-%d') END AS dob,
               CASE WHEN c_acctbal < 5000 THEN 'F' ELSE 'M' END AS gender,
               CASE WHEN c_mktsegment = 'FURNITURE' AND c_nationkey < 3 THEN NULL
                    WHEN c_nationkey = 9 THEN ''
                    WHEN c_nationkey = 11 THEN c_name || '.example.org'
                    ELSE c_name || '@example.org' END AS email,
               '555-' || c_custkey AS phone,
               c_name || ', "Block ' || c_nationkey || '"' || chr(10) || 'Main St' AS address,
               'City ' || c_nationkey AS city,
               c_mktsegment AS state,
               'INS' || c_custkey AS insurance_id,
               CASE WHEN c_nationkey = 3 THEN 'soon' ELSE '2024-01-01' END AS registration_date,
               TIMESTAMP '2024-01-01 00:00:00' AS load_time
        FROM customer""",
    "raw_patients2": """
        SELECT * REPLACE (replace(city, 'City', 'Moved') AS city, TIMESTAMP '2024-01-02 00:00:00' AS load_time)
        FROM raw_patients""",
    "raw_doctors": """
        SELECT CASE WHEN s_acctbal < -500 THEN 'X' || s_suppkey ELSE CAST(s_suppkey AS VARCHAR) END AS doctor_id,
               s_name AS name,
               CASE WHEN s_acctbal < 3000 THEN 'Cardiology' ELSE 'Surgery' END AS specialization,
               CASE WHEN s_nationkey = 7 THEN '2016-13-01' ELSE '2016-01-01' END AS join_date,
               '556-' || s_suppkey AS phone,
               CASE WHEN s_nationkey = 5 THEN NULL
                    WHEN s_nationkey = 11 THEN s_name || '.example.org'
                    ELSE s_name || '@example.org' END AS email,
               'MD' AS qualification,
               'Dept ' || s_nationkey AS department,
               CASE WHEN s_acctbal < 0 THEN 'ON_LEAVE' WHEN s_acctbal < 5000 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
               TIMESTAMP '2024-01-01 00:00:00' AS load_time
        FROM supplier""",
    "raw_doctors2": """
        SELECT * REPLACE (replace(department, 'Dept', 'New') AS department, TIMESTAMP '2024-01-02 00:00:00' AS load_time)
        FROM raw_doctors""",
    "raw_admissions": """
        SELECT CASE WHEN l_returnflag = 'R' AND l_discount = 0.1 THEN 'A' || (l_orderkey * 10 + l_linenumber)
                    ELSE CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) END AS admission_id,
               CASE WHEN l_discount = 0.03 AND l_linestatus = 'F' THEN NULL
                    WHEN l_discount = 0.01 AND l_tax = 0.07 THEN 'unknown'
                    WHEN o_custkey % 50 = 7 THEN '9' || lpad(CAST(o_custkey AS VARCHAR), 19, '0')
                    ELSE CAST(o_custkey AS VARCHAR) END AS patient_id,
               strftime(o_orderdate + to_minutes(l_linenumber * 37), '%Y-%m-%d %H:%M:%S') AS admission_time,
               CASE WHEN l_tax = 0.08 AND l_discount = 0.05 THEN ''
                    ELSE strftime(l_shipdate + to_minutes(CAST(l_quantity AS INT) * 53), '%Y-%m-%d %H:%M:%S')
               END AS discharge_time,
               l_returnflag AS department,
               l_linestatus AS ward,
               CASE WHEN l_tax = 0.0 AND CAST(l_quantity AS INT) = 1 THEN 'none'
                    ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS bed_no,
               CAST(l_suppkey AS VARCHAR) AS attending_doctor_id,
               CASE l_returnflag WHEN 'A' THEN 'OPD' WHEN 'N' THEN 'IPD' ELSE 'ER' END AS admission_type,
               o_orderstatus AS status,
               l_shipdate + to_seconds(CAST(l_quantity AS INT)) AS load_time
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_procedures": """
        SELECT CASE WHEN event_type = 'error' AND value > 450 OR event_id % 37 = 0 THEN 'P' || event_id
                    ELSE CAST(event_id AS VARCHAR) END AS procedure_id,
               CASE WHEN event_type = 'click' AND value > 480 OR event_id % 31 = 5 THEN NULL
                    ELSE CAST(event_id * 10 + 1 + CAST(floor(value / 100) AS BIGINT) AS VARCHAR) END AS admission_id,
               CAST(user_id AS VARCHAR) AS patient_id,
               event_type AS procedure_name,
               CAST(user_id AS VARCHAR) AS surgeon_id,
               CASE WHEN event_type = 'purchase' AND value < 50 THEN NULL
                    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS scheduled_time,
               CASE WHEN event_type = 'signup' AND value < 20 OR event_id % 41 = 6 THEN NULL
                    ELSE strftime(begun, '%Y-%m-%d %H:%M:%S') END AS start_time,
               strftime(CASE WHEN event_type = 'view' AND value > 400 OR event_id % 7 = 3 THEN begun - INTERVAL 5 MINUTE
                             ELSE begun + INTERVAL 30 MINUTE END, '%Y-%m-%d %H:%M:%S') AS end_time,
               'OR-' || user_id AS operating_room,
               props AS anaesthesia_type,
               'DONE' AS status,
               ts AS load_time
        FROM (SELECT *, ts + to_seconds(CAST(floor(value * 2) AS BIGINT)) AS begun FROM events)""",
    "raw_billing": """
        SELECT CASE WHEN o_orderpriority LIKE '5%' AND o_totalprice > 450000 THEN 'B' || o_orderkey
                    ELSE CAST(o_orderkey AS VARCHAR) END AS bill_id,
               CAST(o_orderkey * 10 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS VARCHAR) AS admission_id,
               CASE WHEN o_custkey % 50 = 7 THEN '9' || lpad(CAST(o_custkey AS VARCHAR), 19, '0')
                    ELSE CAST(o_custkey AS VARCHAR) END AS patient_id,
               CASE WHEN o_totalprice < 5000 THEN 'n/a'
                    WHEN o_orderstatus = 'P' AND o_totalprice > 400000
                    THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)
                    ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS total_amount,
               CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS insurance_amount,
               CASE WHEN o_orderpriority LIKE '1%' THEN 'tbd' ELSE '100' END AS out_of_pocket_amount,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS billing_time,
               o_orderpriority AS payment_mode,
               CASE WHEN o_totalprice > 300000 THEN 'TRUE' ELSE 'FALSE' END AS is_flagged,
               o_orderdate AS load_time
        FROM orders""",
}


def _key(column: str) -> str:
    return f"TRY_CAST({column} AS DECIMAL(38,0))"


def _amount(column: str) -> str:
    return f"CASE WHEN TRY_CAST({column} AS DECIMAL(38,0)) IS NOT NULL THEN TRY_CAST({column} AS DOUBLE) END"


def _date(column: str) -> str:
    return f"TRY_CAST({column} AS DATE)"


def _time(column: str) -> str:
    return f"TRY_CAST({column} AS TIMESTAMP)"


_TYPED = {
    "patients": f"""{_key('patient_id')} AS patient_id, name, {_date('dob')} AS dob, gender, email, phone, address,
        city, state, insurance_id, {_date('registration_date')} AS registration_date, load_time""",
    "doctors": f"""{_key('doctor_id')} AS doctor_id, name, specialization, {_date('join_date')} AS join_date, phone,
        email, qualification, department, status, load_time""",
    "admissions": f"""{_key('admission_id')} AS admission_id, {_key('patient_id')} AS patient_id,
        {_time('admission_time')} AS admission_time, {_time('discharge_time')} AS discharge_time, department, ward,
        {_key('bed_no')} AS bed_no, {_key('attending_doctor_id')} AS attending_doctor_id, admission_type, status,
        load_time""",
    "procedures": f"""{_key('procedure_id')} AS procedure_id, {_key('admission_id')} AS admission_id,
        {_key('patient_id')} AS patient_id, procedure_name, {_key('surgeon_id')} AS surgeon_id,
        {_time('scheduled_time')} AS scheduled_time, {_time('start_time')} AS start_time,
        {_time('end_time')} AS end_time, operating_room, anaesthesia_type, status, load_time""",
    "billing": f"""{_key('bill_id')} AS bill_id, {_key('admission_id')} AS admission_id,
        {_key('patient_id')} AS patient_id, {_amount('total_amount')} AS total_amount,
        {_amount('insurance_amount')} AS insurance_amount, {_amount('out_of_pocket_amount')} AS out_of_pocket_amount,
        {_time('billing_time')} AS billing_time, payment_mode, is_flagged, load_time""",
}

_COLUMNS = {
    "patients": "name dob gender email phone address city state insurance_id registration_date",
    "doctors": "name specialization join_date phone email qualification department status",
    "admissions": "patient_id admission_time discharge_time department ward bed_no attending_doctor_id "
    "admission_type status",
    "procedures": "admission_id patient_id procedure_name surgeon_id scheduled_time start_time end_time "
    "operating_room anaesthesia_type status",
    "billing": "admission_id patient_id total_amount insurance_amount out_of_pocket_amount billing_time "
    "payment_mode is_flagged",
}

_KEYS = {
    "patients": "patient_id",
    "doctors": "doctor_id",
    "admissions": "admission_id",
    "procedures": "procedure_id",
    "billing": "bill_id",
}

_LEVEL_ONE = {
    "patients": f"{_key('patient_id')} IS NOT NULL AND {_date('dob')} IS NOT NULL AND email LIKE '%@%'",
    "doctors": f"{_key('doctor_id')} IS NOT NULL AND {_date('join_date')} IS NOT NULL AND email LIKE '%@%'",
    "admissions": f"{_key('admission_id')} IS NOT NULL AND {_time('admission_time')} IS NOT NULL "
    f"AND {_time('discharge_time')} IS NOT NULL",
    "procedures": f"{_key('procedure_id')} IS NOT NULL",
    "billing": f"{_key('bill_id')} IS NOT NULL AND {_amount('total_amount')} IS NOT NULL",
}

# What level 2 rejects, with the references compared as delivered.
_LEVEL_TWO_FAILS = {
    "admissions": f"""patient_id NOT IN (SELECT CAST(patient_id AS VARCHAR) FROM silver_patients)
        OR attending_doctor_id NOT IN (SELECT CAST(doctor_id AS VARCHAR) FROM silver_doctors)
        OR {_time('discharge_time')} < {_time('admission_time')}""",
    "procedures": f"""admission_id NOT IN (SELECT CAST(admission_id AS VARCHAR) FROM silver_admissions)
        OR {_time('end_time')} < {_time('start_time')}""",
    "billing": f"""admission_id NOT IN (SELECT CAST(admission_id AS VARCHAR) FROM silver_admissions)
        OR {_amount('total_amount')} < 0""",
}

_LEVEL_TWO_PASSES = {
    "admissions": f"""patient_id IN (SELECT CAST(patient_id AS VARCHAR) FROM silver_patients)
        AND attending_doctor_id IN (SELECT CAST(doctor_id AS VARCHAR) FROM silver_doctors)
        AND {_time('discharge_time')} >= {_time('admission_time')}""",
    "procedures": f"""admission_id IN (SELECT CAST(admission_id AS VARCHAR) FROM silver_admissions)
        AND {_time('end_time')} >= {_time('start_time')}""",
    "billing": f"""admission_id IN (SELECT CAST(admission_id AS VARCHAR) FROM silver_admissions)
        AND {_amount('total_amount')} >= 0""",
}

_MESSAGES = {
    "patients": ("Invalid patient data", None),
    "doctors": ("Invalid doctor data", None),
    "admissions": ("Invalid admission data", "FK or time issue"),
    "procedures": ("Invalid procedure data", "FK or time issue"),
    "billing": ("Invalid billing data", "FK or negative amount"),
}


def _latest(name: str, rows: str) -> str:
    key = _KEYS[name]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["load_time", *_COLUMNS[name].split()])
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
        f"FROM ({rows})) WHERE rn = 1"
    )


def _build_chain() -> None:
    for name in _KEYS:
        data_error, business_error = _MESSAGES[name]
        log = (
            f"SELECT '{name}' AS source_table, {_KEYS[name]} AS record_id, '%s' AS error_type, "
            f"'%s' AS error_message, TIMESTAMP '2024-06-01 00:00:00' AS load_time FROM %s WHERE %s"
        )
        _CTES[f"valid_{name}"] = f"SELECT * FROM raw_{name} WHERE {_LEVEL_ONE[name]}"
        _CTES[f"data_errors_{name}"] = log % (
            "DATA_ERROR", data_error, f"raw_{name}", f"NOT ({_LEVEL_ONE[name]})",
        )
        passed = f"valid_{name}"
        if business_error:
            _CTES[f"business_errors_{name}"] = log % (
                "BUSINESS_ERROR", business_error, passed, _LEVEL_TWO_FAILS[name],
            )
            _CTES[f"passed_{name}"] = f"SELECT * FROM {passed} WHERE {_LEVEL_TWO_PASSES[name]}"
            passed = f"passed_{name}"
        _CTES[f"silver_{name}"] = _latest(name, f"SELECT {_TYPED[name]} FROM {passed}")
        if f"raw_{name}2" in _CTES:
            _CTES[f"silver_{name}2"] = _latest(
                name, f"SELECT {_TYPED[name]} FROM raw_{name}2 WHERE {_LEVEL_ONE[name]}"
            )
    _CTES["fact_admissions"] = (
        "SELECT admission_id, patient_id, attending_doctor_id AS doctor_id, admission_time, discharge_time, "
        "department, bed_no FROM silver_admissions"
    )
    _CTES["fact_procedures"] = (
        "SELECT procedure_id, admission_id, surgeon_id AS doctor_id, scheduled_time, start_time, end_time, "
        "operating_room FROM silver_procedures"
    )
    _CTES["fact_billing"] = (
        "SELECT bill_id, admission_id, patient_id, total_amount, billing_time FROM silver_billing"
    )
    _CTES["work"] = (
        "SELECT doctor_id, CAST(admission_time AS DATE) AS day FROM fact_admissions UNION ALL "
        "SELECT doctor_id, CAST(start_time AS DATE) AS day FROM fact_procedures"
    )
    _CTES["daily"] = "SELECT doctor_id, day, count(*) AS daily_work FROM work GROUP BY doctor_id, day"
    attributes = "patient_id, " + ", ".join(_COLUMNS["patients"].split())
    _CTES["dim1"] = (
        f"SELECT {attributes}, DATE '2026-03-17' AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date, "
        "'Y' AS current_flag FROM silver_patients WHERE state <> 'BUILDING'"
    )
    _CTES["opened"] = (
        f"SELECT {attributes}, DATE '2026-03-18' AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date, "
        "'Y' AS current_flag FROM silver_patients2"
    )
    _CTES["dim2"] = _expired("dim1", "silver_patients2", "patient_id") + " UNION ALL SELECT * FROM opened"
    doctor = "doctor_id, " + ", ".join(_COLUMNS["doctors"].split())
    _CTES["dim_doctor1"] = (
        f"SELECT {doctor}, DATE '2026-03-17' AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date, "
        "'Y' AS current_flag FROM silver_doctors WHERE status <> 'INACTIVE'"
    )
    _CTES["dim_doctor2"] = (
        _expired("dim_doctor1", "silver_doctors2", "doctor_id")
        + f" UNION ALL SELECT {doctor}, DATE '2026-03-18', CAST(NULL AS DATE), 'Y' FROM silver_doctors2"
    )


def _expired(dim: str, silver: str, key: str) -> str:
    hit = f"{key} IN (SELECT {key} FROM {silver}) AND current_flag = 'Y'"
    return (
        f"SELECT * REPLACE (CASE WHEN {hit} THEN DATE '2026-03-17' ELSE effective_end_date END AS effective_end_date, "
        f"CASE WHEN {hit} THEN 'N' ELSE current_flag END AS current_flag) FROM {dim}"
    )


_build_chain()


def _sql(select: str, bodies: dict[str, str] = _CTES) -> str:
    chain = ",\n".join(f"{name} AS ({body})" for name, body in bodies.items())
    return f"WITH {chain}\n{select}"


def _second_delivery(bodies: dict[str, str]) -> dict[str, str]:
    """What the second run adds: admissions of other patients, procedures and bills once more."""
    moved = bodies["raw_admissions"].replace("o_custkey", "(o_custkey + 1)")
    more = {
        "raw_admissions2": f"SELECT * REPLACE ('MOVED' AS status) FROM ({moved}) WHERE department = 'A'",
        "raw_procedures2": "SELECT * REPLACE ('REDONE' AS status) FROM raw_procedures WHERE procedure_name IN ('error', 'view')",
        "raw_billing2": "SELECT * REPLACE ('AGAIN' AS payment_mode) FROM raw_billing WHERE is_flagged = 'TRUE'",
    }
    for name in ("admissions", "procedures", "billing"):
        key, both = _KEYS[name], f"final_{name}"
        seen = {where: sql[name].replace("silver_admissions", "final_admissions") for where, sql in (("fails", _LEVEL_TWO_FAILS), ("passes", _LEVEL_TWO_PASSES))}
        log = bodies[f"data_errors_{name}"].replace(f"FROM raw_{name} ", f"FROM raw_{name}2 ")
        more[f"data_errors_{name}2"] = log
        more[f"valid_{name}2"] = f"SELECT * FROM raw_{name}2 WHERE {_LEVEL_ONE[name]}"
        more[f"business_errors_{name}2"] = bodies[f"business_errors_{name}"].replace(f"FROM valid_{name} ", f"FROM valid_{name}2 ").replace(
            _LEVEL_TWO_FAILS[name], seen["fails"]
        )
        more[f"silver_{name}2"] = _latest(name, f"SELECT {_TYPED[name]} FROM valid_{name}2 WHERE {seen['passes']}")
        kept = f"SELECT * FROM silver_{name}"
        if name == "admissions":
            kept = (
                f"SELECT t.* REPLACE (CASE WHEN s.{key} IS NULL THEN t.patient_id ELSE s.patient_id END AS patient_id) "
                f"FROM silver_{name} t LEFT JOIN silver_{name}2 s ON s.{key} = t.{key}"
            )
        more[both] = f"{kept} UNION ALL SELECT * FROM silver_{name}2 WHERE {key} NOT IN (SELECT {key} FROM silver_{name})"
    return more


def _delivered(select: str) -> str:
    """As ``_sql``, as in the pipeline run: admissions arrive in two parts, ward F first, and all
    domains twice. The facts are those after the second delivery."""
    bodies: dict[str, str] = {}
    for name, body in _CTES.items():
        if name == "raw_admissions":
            arrival = "CASE WHEN ward = 'F' THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-01-02 00:00:00' END"
            body = f"SELECT * REPLACE ({arrival} AS load_time) FROM ({body})"
        if name == "fact_admissions":
            # All rows of the second delivery arrive together.
            bodies |= _second_delivery(bodies | {"raw_admissions": _CTES["raw_admissions"].replace("l_shipdate + to_seconds(CAST(l_quantity AS INT)) AS load_time", "TIMESTAMP '2024-01-03 00:00:00' AS load_time")})
        if name.startswith("fact_"):
            body = body.replace("FROM silver_", "FROM final_")
        bodies[name] = body
    return _sql(select, bodies)


def _log(name: str) -> str:
    both = f"SELECT * FROM data_errors_{name}"
    if _MESSAGES[name][1]:
        both += f" UNION ALL SELECT * FROM business_errors_{name}"
    return both


def _merged(name: str, target: str, source: str, updates: tuple[str, ...]) -> str:
    """Target after the merge: matched rows patched, unmatched source rows added."""
    key = _KEYS[name]
    columns = [key, *_COLUMNS[name].split(), "load_time"]
    patched = ", ".join(f"s.{c} AS {c}" if c in updates else f"t.{c} AS {c}" for c in columns)
    kept = ", ".join(f"t.{c} AS {c}" for c in columns)
    new = ", ".join(f"s.{c} AS {c}" for c in columns)
    return _sql(
        f"SELECT {patched} FROM {target} t JOIN {source} s ON t.{key} = s.{key} UNION ALL "
        f"SELECT {kept} FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE s.{key} = t.{key}) UNION ALL "
        f"SELECT {new} FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE s.{key} = t.{key})"
    )


def _verdicts(name: str) -> str:
    valid = f"valid_{name}"
    failed = f"SELECT count(*) FROM data_errors_{name}"
    logged = f"SELECT count(*) FROM business_errors_{name}" if _MESSAGES[name][1] else "SELECT 0"
    passed = f"SELECT count(*) FROM passed_{name}" if _MESSAGES[name][1] else f"SELECT count(*) FROM {valid}"
    total = f"SELECT count(*) FROM raw_{name}"
    return f"""
        SELECT '{name}' AS source_table, 'ACCEPTED' AS verdict, ({passed}) AS n
        UNION ALL SELECT '{name}', 'DATA_ERROR', ({failed})
        UNION ALL SELECT '{name}', 'BUSINESS_ERROR', ({logged})
        UNION ALL SELECT '{name}', 'DROPPED', ({total}) - ({passed}) - ({failed}) - ({logged})"""


def _masked(name: str, columns: str) -> str:
    replaced = ", ".join(f"'****MASKED****' AS {c}" for c in columns.split())
    return _sql(f"SELECT * REPLACE ({replaced}) FROM silver_{name}")


_ATTRIBUTES = "patient_id, " + ", ".join(_COLUMNS["patients"].split())


def _pipeline_sql() -> dict[str, str]:
    loaded = {
        "patients": "Patients loaded",
        "doctors": "Doctors loaded",
        "admissions": "Admissions loaded",
        "procedures": "Procedures loaded",
        "billing": "Billing loaded",
    }
    counts = " UNION ALL ".join(
        f"SELECT source_table, '{loaded[name]}' AS status, verdict, CAST(n AS BIGINT) AS n FROM ({_verdicts(name)}) "
        f"UNION ALL SELECT '{name}', '{loaded[name]}', 'rows', count(*) FROM raw_{name}"
        for name in _KEYS
    )
    logs = " UNION ALL ".join(_log(name) for name in _KEYS)
    # The second delivery fails rules too, and that of doctors is loaded once more after the reset.
    logs += f" UNION ALL {_log('patients')}" + f" UNION ALL {_log('doctors')}" * 3
    for name in ("admissions", "procedures", "billing"):
        logs += f" UNION ALL SELECT * FROM data_errors_{name}2 UNION ALL SELECT * FROM business_errors_{name}2"
    patients = "patient_id, " + ", ".join(_COLUMNS["patients"].split())
    doctors = "doctor_id, " + ", ".join(_COLUMNS["doctors"].split())

    def versions(columns: str, name: str, moved: str) -> str:
        return (
            f"SELECT {columns}, DATE '2026-03-17' AS effective_start_date, DATE '2026-03-17' AS effective_end_date, "
            f"'N' AS current_flag FROM silver_{name} UNION ALL "
            f"SELECT {columns}, DATE '2026-03-18', CAST(NULL AS DATE), 'Y' FROM silver_{moved}"
        )

    admission = "admission_id, " + ", ".join(_COLUMNS["admissions"].split())
    first = {name: f"SELECT count(*) FROM raw_{name}" for name in _KEYS}
    second = {name: f"SELECT count(*) FROM raw_{name}2" for name in _KEYS}

    def steps(*told: tuple[str, str, str]) -> str:
        return " UNION ALL ".join(f"SELECT '{name}' AS source_table, '{step}' AS step, ({n}) AS n" for name, step, n in told)

    waiting = [(name, step, n) for name in _KEYS for step, n in (("first delivery", first[name]), ("first run", "0"), ("second delivery", second[name]))]
    arrived = [(name, "1", first[name]) for name in _KEYS if name != "admissions"] + [(name, "2", second[name]) for name in _KEYS if name != "admissions"]
    parts = [f"{first['admissions']} WHERE ward = 'F'", f"{first['admissions']} WHERE ward <> 'F'", second["admissions"]]
    arrived += [("admissions", str(k), n) for k, n in enumerate(parts, 1)]
    twice = "SELECT 2 * count(*) FROM raw_doctors"
    anew = [(f"{k} {step}", n) for k, (step, n) in enumerate((("before", twice), ("emptied", "0"), ("taken in", twice), ("loaded", twice), ("in silver", "SELECT count(*) FROM silver_doctors")), 1)]
    said = " || ' | ' || ".join(f"'{name.capitalize()}: {loaded[name]}'" for name in _KEYS)
    none = " || ' | ' || ".join(f"'{name.capitalize()}: " + (loaded[name] if name == "patients" else f"No data in {name} stream") + "'" for name in _KEYS)
    return {
        "pipeline_pending": _delivered(steps(*waiting)),
        "pipeline_arrivals": _delivered(steps(*arrived)),
        "pipeline_files": _delivered(" UNION ALL ".join(f"SELECT '{name}' AS source_table, ({first[name]}) + ({second[name]}) AS n" for name in _KEYS)),
        "pipeline_reset": _delivered(steps(*[("doctors", step, n) for step, n in anew])),
        "pipeline_ticks": f"SELECT 1 AS run, {said} AS status UNION ALL SELECT 2, {said} UNION ALL SELECT 3, {none}",
        "csv_scan": _sql("SELECT * EXCLUDE (load_time) FROM raw_patients"),
        "pipeline_status": _delivered(counts),
        "pipeline_exceptions": _delivered(f"SELECT * EXCLUDE (load_time) FROM ({logs})"),
        "pipeline_landing_patients": _delivered(
            f"SELECT {patients} FROM raw_patients UNION ALL SELECT {patients} FROM raw_patients2"
        ),
        "pipeline_exception_summary": _delivered(
            f"SELECT source_table, error_type, count(*) AS failures FROM ({logs}) GROUP BY source_table, error_type"
        ),
        "pipeline_silver_doctors": _delivered(f"SELECT {doctors} FROM silver_doctors2"),
        "pipeline_silver_procedures": _delivered("SELECT * EXCLUDE (load_time) FROM final_procedures"),
        "pipeline_silver_billing": _delivered("SELECT * EXCLUDE (load_time) FROM final_billing"),
        "pipeline_fact_admissions": _delivered("SELECT * FROM fact_admissions"),
        "pipeline_fact_procedures": _delivered("SELECT * FROM fact_procedures"),
        "pipeline_masked_patients": _delivered(
            f"SELECT * REPLACE ('****MASKED****' AS email, '****MASKED****' AS phone, "
            f"'****MASKED****' AS insurance_id) FROM (SELECT {patients} FROM silver_patients2)"
        ),
        "pipeline_silver_patients": _delivered(f"SELECT {patients} FROM silver_patients2"),
        "pipeline_silver_admissions": _delivered(f"SELECT {admission} FROM final_admissions"),
        "pipeline_dim_patient": _delivered(versions(patients, "patients", "patients2")),
        "pipeline_dim_doctor": _delivered(versions(doctors, "doctors", "doctors2")),
        "pipeline_fact_billing": _delivered("SELECT * FROM fact_billing"),
        "pipeline_workload": _delivered(
            "SELECT doctor_id, round(avg(daily_work), 6) AS doctor_workload_index FROM daily GROUP BY doctor_id"
        ),
        "pipeline_scores": _delivered(
            "SELECT 'bed_occ' AS view, round(CAST(sum(date_diff('hour', admission_time, discharge_time)) AS DOUBLE) "
            "/ nullif(count(DISTINCT bed_no) * 24, 0), 6) AS score FROM fact_admissions UNION ALL "
            "SELECT 'att', round(avg(date_diff('hour', admission_time, discharge_time)), 6) FROM fact_admissions "
            "UNION ALL SELECT 'surgey_efficiny', round(CAST(count(CASE WHEN "
            "abs(date_diff('minute', scheduled_time, start_time)) <= 10 THEN 1 END) AS DOUBLE) * 100 "
            "/ nullif(count(*), 0), 6) FROM fact_procedures UNION ALL "
            "SELECT 'kpi_data_quality', round(1 - CAST(count(*) FILTER (WHERE total_amount < 0 OR "
            "total_amount > 100000) AS DOUBLE) / nullif(count(*), 0), 6) FROM fact_billing"
        ),
    }


def all_sql() -> dict[str, str]:
    level_two = {
        name: _sql(f"SELECT * FROM business_errors_{name}") for name in ("admissions", "procedures", "billing")
    }
    level_one = {
        name: _sql(f"SELECT * FROM data_errors_{name}") for name in ("admissions", "procedures", "billing")
    }
    return {
        "scan_all": "SELECT * FROM orders",
        "fn_try_number": """
            SELECT c_custkey,
                   CAST(TRY_CAST(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS DECIMAL(38,0)) AS BIGINT)
                       AS from_balance,
                   c_custkey AS from_padded, c_custkey * 100 AS from_exponent, CAST(NULL AS BIGINT) AS from_name
            FROM customer""",
        "fn_try_date": _sql(
            f"SELECT patient_id, {_date('dob')} AS dob, {_date('registration_date')} AS registration_date "
            "FROM raw_patients"
        ),
        "fn_try_timestamp": _sql(
            f"SELECT admission_id, {_time('admission_time')} AS admission_time, "
            f"{_time('discharge_time')} AS discharge_time, CAST(NULL AS TIMESTAMP) AS no_time FROM raw_admissions"
        ),
        "fn_datediff_hour": _sql(
            f"SELECT {_key('admission_id')} AS admission_id, "
            f"date_diff('hour', {_time('admission_time')}, {_time('discharge_time')}) AS stay_hours FROM raw_admissions"
        ),
        "fn_datediff_minute": """
            SELECT event_id, date_diff('minute', ts, ts + to_seconds(CAST(floor(value * 2) AS BIGINT))) AS minutes
            FROM events""",
        "fn_concat": _sql(
            "SELECT patient_id, 'Patient: ' || name || ' | Mail: ' || email AS status_line FROM raw_patients"
        ),
        "typed_silver": _sql("SELECT * FROM silver_admissions"),
        "valid_patients": _sql("SELECT * FROM valid_patients"),
        "valid_doctors": _sql("SELECT * FROM valid_doctors"),
        "exceptions_patients": _sql(_log("patients")),
        "exceptions_doctors": _sql(_log("doctors")),
        "exceptions_admissions_l1": level_one["admissions"],
        "exceptions_procedures_l1": level_one["procedures"],
        "exceptions_billing_l1": level_one["billing"],
        "exceptions_admissions_l2": level_two["admissions"],
        "exceptions_procedures_l2": level_two["procedures"],
        "exceptions_billing_l2": level_two["billing"],
        "verdict_counts": _sql(
            "SELECT * FROM (" + " UNION ALL ".join(_verdicts(name) for name in _KEYS) + ") WHERE n > 0"
        ),
        "strict_patients": _sql(
            "SELECT 'patients' AS source_table, patient_id AS record_id, 'DATA_ERROR' AS error_type, "
            "'Invalid patient data' AS error_message, TIMESTAMP '2024-06-01 00:00:00' AS load_time "
            f"FROM raw_patients WHERE ({_LEVEL_ONE['patients']}) IS NOT TRUE"
        ),
        "rule_time_order": _sql(
            "SELECT admission_id, admission_time, discharge_time FROM raw_admissions "
            f"WHERE {_time('discharge_time')} < {_time('admission_time')}"
        ),
        "rule_nonneg_amount": _sql(
            f"SELECT bill_id, total_amount FROM raw_billing WHERE {_amount('total_amount')} < 0"
        ),
        "exception_summary": _sql(
            "SELECT source_table, error_type, count(*) AS failures FROM ("
            + " UNION ALL ".join(_log(name) for name in _KEYS)
            + ") GROUP BY source_table, error_type"
        ),
        "fk_semi": "SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)",
        "fk_not_in": """
            SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, o_orderdate
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) OR l_shipdate < o_orderdate""",
        "fk_not_in_salted": """
            SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
            WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""",
        "audit_pk": _sql(
            f"SELECT {_key('admission_id')} AS admission_id, count(*) AS copies FROM raw_admissions "
            "GROUP BY 1 HAVING count(*) > 1"
        ),
        "audit_fk": _sql(
            f"SELECT {_key('admission_id')} AS admission_id, count(*) AS orphan_rows FROM raw_billing "
            "WHERE admission_id NOT IN (SELECT CAST(admission_id AS VARCHAR) FROM silver_admissions) GROUP BY 1"
        ),
        "dedup_latest": _sql(
            _latest(
                "admissions",
                f"SELECT {_TYPED['admissions']} FROM raw_admissions WHERE {_key('admission_id')} IS NOT NULL",
            )
        ),
        "merge_patients": _merged(
            "patients",
            "(SELECT * FROM silver_patients WHERE state <> 'BUILDING')",
            "silver_patients2",
            ("name", "city", "state", "load_time"),
        ),
        "merge_doctors": _merged(
            "doctors",
            "(SELECT * FROM silver_doctors WHERE specialization = 'Surgery')",
            "silver_doctors2",
            ("name", "department", "load_time"),
        ),
        "merge_admissions": _merged(
            "admissions",
            "(SELECT * REPLACE (CAST(-1 AS DECIMAL(38,0)) AS patient_id, 'OLD' AS department) "
            "FROM silver_admissions WHERE ward = 'F')",
            "silver_admissions",
            ("patient_id",),
        ),
        "merge_insert_only": _merged(
            "billing",
            "(SELECT * REPLACE (CAST(0 AS DOUBLE) AS total_amount) FROM silver_billing WHERE is_flagged = 'TRUE')",
            "silver_billing",
            (),
        ),
        "merge_procedures": _merged(
            "procedures",
            "(SELECT * REPLACE ('OLD' AS status) FROM silver_procedures WHERE procedure_name = 'error')",
            "silver_procedures",
            (),
        ),
        "scd2_expire": _sql(
            _expired("dim1", "(SELECT * FROM silver_patients2 WHERE gender = 'F')", "patient_id")
        ),
        "scd2_insert": _sql("SELECT * FROM opened"),
        "scd2_refresh": _sql("SELECT * FROM dim2"),
        "scd2_only_changed": _sql(
            _expired("dim1", "(SELECT * FROM silver_patients2 WHERE state <> 'MACHINERY')", "patient_id")
            + " UNION ALL SELECT * FROM opened WHERE state <> 'MACHINERY'"
        ),
        "scd2_current": _sql("SELECT * FROM dim2 WHERE current_flag = 'Y'"),
        "scd2_history": _sql("SELECT * FROM dim2 WHERE patient_id = 1 ORDER BY effective_start_date"),
        "scd2_doctors": _sql("SELECT * FROM dim_doctor2"),
        "mask_patients": _masked("patients", "email phone insurance_id"),
        "mask_patients_admin": _sql("SELECT * FROM silver_patients"),
        "mask_doctors": _masked("doctors", "email phone"),
        "fact_admissions": _sql("SELECT * FROM fact_admissions"),
        "fact_procedures": _sql("SELECT * FROM fact_procedures"),
        "fact_billing": _sql("SELECT * FROM fact_billing"),
        "union_work": _sql("SELECT * FROM work"),
        "agg_count": _sql(
            " UNION ALL ".join(f"SELECT '{name}' AS source_table, count(*) AS n FROM raw_{name}" for name in _KEYS)
        ),
        "agg_daily_work": _sql("SELECT * FROM daily"),
        "agg_distinct_beds": _sql("SELECT count(DISTINCT bed_no) AS total_beds FROM fact_admissions"),
        "agg_occupied_hours": _sql(
            "SELECT CAST(sum(date_diff('hour', admission_time, discharge_time)) AS BIGINT) AS occupied_hours "
            "FROM fact_admissions"
        ),
        "kpi_bed_utilization": _sql(
            "SELECT round(CAST(sum(date_diff('hour', admission_time, discharge_time)) AS DOUBLE) "
            "/ nullif(CAST(count(DISTINCT bed_no) * 24 AS DOUBLE), 0), 6) AS bed_utilization_score FROM fact_admissions"
        ),
        "kpi_att": _sql(
            "SELECT round(avg(date_diff('hour', admission_time, discharge_time)), 6) AS avg_stay_hours "
            "FROM fact_admissions"
        ),
        "kpi_surgery": _sql(
            "SELECT round(CAST(count(CASE WHEN abs(date_diff('minute', scheduled_time, start_time)) <= 10 THEN 1 END) "
            "AS DOUBLE) * 100 / nullif(CAST(count(*) AS DOUBLE), 0), 6) AS surgery_efficiency_index "
            "FROM fact_procedures"
        ),
        "kpi_workload": _sql(
            "SELECT doctor_id, round(avg(daily_work), 6) AS doctor_workload_index FROM daily GROUP BY doctor_id"
        ),
        **_pipeline_sql(),
        "kpi_billing_accuracy": _sql(
            "SELECT round(1 - CAST(count(*) FILTER (WHERE total_amount < 0 OR total_amount > 100000) AS DOUBLE) "
            "/ nullif(CAST(count(*) AS DOUBLE), 0), 6) AS billing_accuracy_index FROM fact_billing"
        ),
    }
