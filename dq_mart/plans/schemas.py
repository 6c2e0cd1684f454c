"""Declared schemas and cleaning specs of the nine hospital tables.

The per-table cleaning of the reference is expressed as data (``TableSpec``)
and run by the generic ``transform`` / ``conform`` operators.  Renames follow
one rule (clean header, lower-cased, when that is a declared column) plus the
serial-number aliases.
"""

from __future__ import annotations

import re

from ..operators.conform import ColumnSpec, TableSpec

# --- fixed values -----------------------------------------------------------
# Declared column types of the loaded tables, in table order.
BRANCHES_DDL = (
    "serial_no INT, branch_id VARCHAR(10), location VARCHAR(100), ot_available BOOLEAN, "
    "inhouse_anesthetician BOOLEAN, no_of_ots INT, inhouse_pharmacy BOOLEAN, "
    "inhouse_nutritionist BOOLEAN, inpatient_rooms INT, luxury_suite_rooms BOOLEAN, "
    "prayer_room BOOLEAN, kids_play_area BOOLEAN")
DOCTORS_DDL = (
    "serial_no INT, doctor_name VARCHAR(100), doctor_id VARCHAR(20), "
    "specialization VARCHAR(100), qualification VARCHAR(20), surgery_experience INT, "
    "practicing_branch VARCHAR(10)")
BRIDGE_DDL = "doctor_id VARCHAR(20), branch_id VARCHAR(10)"
PATIENTS_DDL = (
    "serial_no INT, patient_id VARCHAR(10), date_of_registration DATE, "
    "date_of_first_consultation DATE, date_of_latest_consultation DATE, "
    "overall_satisfaction_rating INT, admission BOOLEAN, surgery_underwent BOOLEAN, "
    "total_number_of_visits INT")
APPOINTMENTS_DDL = (
    "serial_no INT, case_id BIGINT, patient_id VARCHAR(10), branch_id VARCHAR(10), "
    "date_of_consultation DATE, requested_doctor_id VARCHAR(20), "
    "consulted_doctor_id VARCHAR(20), reason_for_visit VARCHAR(200), diagnosis VARCHAR(200), "
    "prescribed_medication VARCHAR(200), followup_required BOOLEAN, "
    "nutritionist_recommended BOOLEAN")
BILLING_DDL = (
    "serial_no INT, claim_id BIGINT, patient_id VARCHAR(10), case_id BIGINT, "
    "branch_id VARCHAR(10), total_bill DECIMAL(10,2), insurance_provider VARCHAR(100), "
    "amount_covered DECIMAL(10,2), out_of_pocket_expenses DECIMAL(10,2), "
    "claim_status VARCHAR(10)")
SURGERIES_DDL = (
    "serial_no INT, case_id BIGINT, patient_id VARCHAR(10), doctor_id VARCHAR(20), "
    "branch_id VARCHAR(10), surgery_type VARCHAR(100), surgery_date DATE, "
    "anesthesia_type VARCHAR(20), surgery_outcome VARCHAR(20), surgery_duration_hours INT, "
    "recovery_period_days INT")
LAB_REPORTS_DDL = (
    "serial_no INT, report_id BIGINT, case_id BIGINT, patient_id VARCHAR(10), "
    "branch_id VARCHAR(10), test_name VARCHAR(100), test_date DATE, result VARCHAR(20)")
PRESCRIPTIONS_DDL = (
    "serial_no INT, bill_id BIGINT, patient_id VARCHAR(10), doctor_id VARCHAR(20), "
    "medication_name VARCHAR(100), dosage VARCHAR(20), quantity INT, "
    "pharmacy_availability BOOLEAN, issued_date DATE")
# Both spellings of the serial-number header.
SERIAL_ALIASES = {"Sl_No": "serial_no", "Serial_No": "serial_no"}
# The raw list-string column of doctors, unpacked into the bridge, and its id.
DOCTOR_LIST_COLUMN = "Other Branches Visited"
DOCTOR_ID_COLUMN = "Doctor ID"
# ---------------------------------------------------------------------------

_TYPES = {"INT": "int", "BIGINT": "bigint", "BOOLEAN": "boolean", "DATE": "date"}


def columns_of(ddl: str) -> tuple[ColumnSpec, ...]:
    """``name TYPE, ...`` -> column specs; VARCHAR(n) is text of at most n
    characters, DECIMAL(p,s) keeps its precision."""
    out = []
    for part in re.split(r",\s*(?![^()]*\))", ddl):
        name, typ = part.strip().split(None, 1)
        m = re.fullmatch(r"VARCHAR\((\d+)\)", typ)
        if m:
            out.append(ColumnSpec(name, "string", int(m.group(1))))
        elif typ.startswith("DECIMAL"):
            out.append(ColumnSpec(name, typ.lower().replace(" ", "")))
        else:
            out.append(ColumnSpec(name, _TYPES[typ]))
    return tuple(out)


def _spec(name, ddl, **kw) -> TableSpec:
    return TableSpec(name=name, columns=columns_of(ddl), rename=SERIAL_ALIASES,
                     match_lower=True, **kw)


BRANCHES = _spec("branches", BRANCHES_DDL, primary_key="branch_id",
                 yes_no=("ot_available", "inhouse_anesthetician", "inhouse_pharmacy",
                         "inhouse_nutritionist", "luxury_suite_rooms", "prayer_room",
                         "kids_play_area"))
DOCTORS = _spec("doctors", DOCTORS_DDL, primary_key="doctor_id",
                drop=("Other_Branches_Visited",))
BRIDGE = TableSpec(name="doctor_branch_visits", columns=columns_of(BRIDGE_DDL))
PATIENTS = _spec("patients", PATIENTS_DDL, primary_key="patient_id",
                 yes_no=("admission", "surgery_underwent"),
                 dates=("date_of_registration", "date_of_first_consultation",
                        "date_of_latest_consultation"))
APPOINTMENTS = _spec("appointments", APPOINTMENTS_DDL,
                     yes_no=("followup_required", "nutritionist_recommended"),
                     dates=("date_of_consultation",))
BILLING = _spec("billing", BILLING_DDL, bigint_default0=("claim_id", "case_id"))
SURGERIES = _spec("surgeries", SURGERIES_DDL, dates=("surgery_date",))
LAB_REPORTS = _spec("lab_reports", LAB_REPORTS_DDL, bigint_default0=("case_id",),
                    dates=("test_date",))
PRESCRIPTIONS = _spec("prescriptions", PRESCRIPTIONS_DDL,
                      yes_no=("pharmacy_availability",), dates=("issued_date",))

# Load order: dimensions, then facts (the bridge follows doctors).
SPECS = {s.name: s for s in (BRANCHES, DOCTORS, PATIENTS, APPOINTMENTS, BILLING,
                             SURGERIES, LAB_REPORTS, PRESCRIPTIONS)}
