"""Keys ``etl_<table>`` (T1-T8): each hospital table's cleaning and load,
run on a raw stand-in built from a driver table.

A stand-in is a list of ``(raw header, Spark expression, SQL expression)``:
the Spark side builds an all-text frame with the hospital's raw headers (as
the CSV reader would give it, null tokens applied) and runs
``transform`` + ``conform`` with the table's spec; the oracle builds the same
text in DuckDB and applies the spec with DuckDB's own casts
(``TRY_CAST``, regex trim, ``ROW_NUMBER`` for keep-first).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import idiv
from ..functions.text import NA_TOKENS
from ..operators.cleaning import normalize_null_tokens
from ..operators.conform import TableSpec, conform, good_rows, transform
from . import schemas as S
from .oracles import (ORACLES, bi_sql, bigint0_sql, declared_int_sql, dt_sql, ls_sql, nt_sql,
                      yes_no_sql, yn_sql)
from .registry import query
from .standins import (DriverTables, dirty_bigint, dirty_date, dirty_list,
                       dirty_null_token, dirty_yes_no)

ORD = "ingest_ord"
Raw = list[tuple[str, Callable[[], Column], str]]


def _txt(c: Column) -> Column:
    return c.cast("string")


def _cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _pad2(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


# --- raw stand-ins -----------------------------------------------------------------
# Each returns (source table, key column, [(raw header, Spark expr thunk, SQL)]).
# Spark expressions are thunks so that the SQL texts can be read without a
# session; ``k`` is the source row's key (also the ingest ordinal).

def col(name: str) -> Column:
    return F.col(name)


def branches_raw():
    k = lambda: col("k")
    return "nation", "n_nationkey", [
        ("Sl. No.", lambda: _txt(k() + 1), "CAST(k + 1 AS VARCHAR)"),
        ("Branch ID", lambda: _cat("BR", _pad2(idiv(k(), F.lit(2)))),
         "'BR' || lpad(CAST(k // 2 AS VARCHAR), 2, '0')"),
        ("Location", lambda: col("n_name"), "n_name"),
        ("OT_Available", lambda: dirty_yes_no(k()), yn_sql("k")),
        ("Inhouse Anesthetician", lambda: dirty_yes_no(k() + 1), yn_sql("(k + 1)")),
        ("No. of OTs", lambda: _txt(col("n_regionkey")), "CAST(n_regionkey AS VARCHAR)"),
        ("Inhouse Pharmacy", lambda: dirty_yes_no(k() + 2), yn_sql("(k + 2)")),
        ("Inhouse Nutritionist", lambda: dirty_yes_no(k() + 3), yn_sql("(k + 3)")),
        ("Inpatient Rooms", lambda: _txt(k() * 10), "CAST(k * 10 AS VARCHAR)"),
        ("Luxury Suite Rooms", lambda: dirty_yes_no(k() + 4), yn_sql("(k + 4)")),
        ("Prayer Room", lambda: dirty_yes_no(k() + 5), yn_sql("(k + 5)")),
        ("Kids Play Area", lambda: dirty_yes_no(k() + 6), yn_sql("(k + 6)")),
    ]


_BR_A_SQL = "('BR' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0'))"
_BR_B_SQL = "('BR' || lpad(CAST(s_nationkey + 1 AS VARCHAR), 2, '0'))"


def doctors_raw():
    k = lambda: col("k")
    nk = lambda: col("s_nationkey")
    a = lambda: _cat("BR", _pad2(nk()))
    b = lambda: _cat("BR", _pad2(nk() + 1))
    qual = lambda: (F.when(nk() % 3 == 0, "MBBS").when(nk() % 3 == 1, "MD")
                    .otherwise("MBBS, MD (Internal Medicine)"))
    return "supplier", "s_suppkey", [
        ("Sl. No.", lambda: _txt(k() + 1), "CAST(k + 1 AS VARCHAR)"),
        ("Doctor Name", lambda: col("s_name"), "s_name"),
        ("Doctor ID", lambda: _cat("DR", _txt(idiv(k(), F.lit(3)))), "'DR' || CAST(k // 3 AS VARCHAR)"),
        ("Specialization", lambda: _cat("Spec ", _txt(nk())), "'Spec ' || CAST(s_nationkey AS VARCHAR)"),
        ("Qualification", qual,
         "CASE s_nationkey % 3 WHEN 0 THEN 'MBBS' WHEN 1 THEN 'MD' ELSE 'MBBS, MD (Internal Medicine)' END"),
        ("Surgery Experience", lambda: _txt(nk()), "CAST(s_nationkey AS VARCHAR)"),
        ("Practicing Branch", a, _BR_A_SQL),
        ("Other Branches Visited", lambda: dirty_list(k(), a(), b()), ls_sql("k", _BR_A_SQL, _BR_B_SQL)),
    ]


def patients_raw():
    k = lambda: col("k")
    nk = lambda: col("c_nationkey")
    return "customer", "c_custkey", [
        ("Serial No", lambda: _txt(k() + 1), "CAST(k + 1 AS VARCHAR)"),
        ("Patient ID", lambda: _cat("PT", _txt(idiv(k(), F.lit(2)))), "'PT' || CAST(k // 2 AS VARCHAR)"),
        ("Date of Registration", lambda: dirty_date(k(), F.lit("2024-01-15")), dt_sql("k", "'2024-01-15'")),
        ("Date of First Consultation", lambda: dirty_date(k() + 1, F.lit("2024-02-01")),
         dt_sql("(k + 1)", "'2024-02-01'")),
        ("Date of Latest Consultation", lambda: dirty_date(k() + 2, F.lit("2024-03-01")),
         dt_sql("(k + 2)", "'2024-03-01'")),
        ("Overall Satisfaction Rating", lambda: _txt(idiv(nk(), F.lit(5)) + 1),
         "CAST(c_nationkey // 5 + 1 AS VARCHAR)"),
        ("Admission", lambda: dirty_yes_no(k()), yn_sql("k")),
        ("Surgery Underwent", lambda: dirty_yes_no(k() + 3), yn_sql("(k + 3)")),
        ("Total Number of Visits", lambda: _txt(nk()), "CAST(c_nationkey AS VARCHAR)"),
    ]


def appointments_raw():
    k = lambda: col("k")
    ck = lambda: col("o_custkey")
    return "orders", "o_orderkey", [
        ("Sl. No.", lambda: _txt(k() + 1), "CAST(k + 1 AS VARCHAR)"),
        ("Case ID", lambda: _txt(k() + F.lit(5000000000)), "CAST(k + 5000000000 AS VARCHAR)"),
        ("Patient ID", lambda: _cat("PT", _txt(idiv(ck(), F.lit(2)))), "'PT' || CAST(o_custkey // 2 AS VARCHAR)"),
        ("Branch ID", lambda: _cat("BR", F.substring(col("o_orderpriority"), 1, 1)),
         "'BR' || substr(o_orderpriority, 1, 1)"),
        ("Date of Consultation", lambda: dirty_date(k(), col("o_orderdate")), dt_sql("k", "o_orderdate")),
        ("Requested Doctor ID", lambda: _cat("DR", _txt(idiv(ck(), F.lit(5)))),
         "'DR' || CAST(o_custkey // 5 AS VARCHAR)"),
        ("Consulted Doctor ID", lambda: _cat("DR", _txt(idiv(ck(), F.lit(7)))),
         "'DR' || CAST(o_custkey // 7 AS VARCHAR)"),
        ("Reason for Visit", lambda: col("o_orderstatus"), "o_orderstatus"),
        ("Diagnosis", lambda: col("o_orderpriority"), "o_orderpriority"),
        ("Prescribed Medication", lambda: _cat("Med ", col("o_orderstatus")), "'Med ' || o_orderstatus"),
        ("Followup Required", lambda: dirty_yes_no(k()), yn_sql("k")),
        ("Nutritionist Recommended", lambda: dirty_yes_no(k() + 5), yn_sql("(k + 5)")),
    ]


_BILL_SQL = "CAST(o_totalprice AS DECIMAL(12,2))"
_COV_SQL = f"CAST(ROUND({_BILL_SQL} * CAST(0.8 AS DECIMAL(2,1)), 2) AS DECIMAL(12,2))"


def billing_raw():
    k = lambda: col("k")
    bill = lambda: col("o_totalprice").cast("decimal(12,2)")
    covered = lambda: F.round(bill() * F.lit(0.8).cast("decimal(2,1)"), 2).cast("decimal(12,2)")
    status = lambda: (F.when(col("o_orderstatus") == "F", "Approved")
                      .when(col("o_orderstatus") == "P", "Pending").otherwise("Rejected"))
    return "orders", "o_orderkey", [
        ("Sl. No.", lambda: _txt(k() + 1), "CAST(k + 1 AS VARCHAR)"),
        ("Claim ID", lambda: dirty_bigint(k()), bi_sql("k")),
        ("Patient ID", lambda: _cat("PT", _txt(idiv(col("o_custkey"), F.lit(2)))),
         "'PT' || CAST(o_custkey // 2 AS VARCHAR)"),
        ("Case ID", lambda: dirty_bigint(k() + 1), bi_sql("(k + 1)")),
        ("Branch ID", lambda: _cat("BR", F.substring(col("o_orderpriority"), 1, 1)),
         "'BR' || substr(o_orderpriority, 1, 1)"),
        ("Total Bill", lambda: _txt(bill()), f"CAST({_BILL_SQL} AS VARCHAR)"),
        ("Insurance Provider", lambda: dirty_null_token(k(), col("o_orderpriority")),
         nt_sql("k", "o_orderpriority")),
        ("Amount Covered", lambda: _txt(covered()), f"CAST({_COV_SQL} AS VARCHAR)"),
        ("Out of Pocket Expenses", lambda: _txt((bill() - covered()).cast("decimal(12,2)")),
         f"CAST(CAST({_BILL_SQL} - {_COV_SQL} AS DECIMAL(12,2)) AS VARCHAR)"),
        ("Claim Status", status,
         "CASE WHEN o_orderstatus = 'F' THEN 'Approved' WHEN o_orderstatus = 'P' THEN 'Pending' ELSE 'Rejected' END"),
    ]


def surgeries_raw():
    k = lambda: col("k")
    ln = lambda: col("l_linenumber")
    outcome = lambda: (F.when(col("l_returnflag") == "A", "Successful")
                       .when(col("l_returnflag") == "R", "Failed").otherwise("Complications"))
    anesthesia = lambda: (F.when(col("l_linestatus") == "F", "General")
                          .when(ln() == 1, "None").otherwise("Local"))
    return "lineitem", "l_orderkey", [
        ("Sl. No.", lambda: _txt(ln()), "CAST(l_linenumber AS VARCHAR)"),
        ("Case ID", lambda: _txt(k()), "CAST(k AS VARCHAR)"),
        ("Patient ID", lambda: _cat("PT", _txt(idiv(col("l_partkey"), F.lit(2)))),
         "'PT' || CAST(l_partkey // 2 AS VARCHAR)"),
        ("Doctor ID", lambda: _cat("DR", _txt(col("l_suppkey"))), "'DR' || CAST(l_suppkey AS VARCHAR)"),
        ("Branch ID", lambda: _cat("BR", _txt(ln())), "'BR' || CAST(l_linenumber AS VARCHAR)"),
        ("Surgery Type", lambda: _cat("Type ", col("l_linestatus")), "'Type ' || l_linestatus"),
        ("Surgery Date", lambda: dirty_date(k() + ln(), col("l_shipdate")),
         dt_sql("(k + l_linenumber)", "l_shipdate")),
        ("Anesthesia Type", anesthesia,
         "CASE WHEN l_linestatus = 'F' THEN 'General' WHEN l_linenumber = 1 THEN 'None' ELSE 'Local' END"),
        ("Surgery Outcome", outcome,
         "CASE WHEN l_returnflag = 'A' THEN 'Successful' WHEN l_returnflag = 'R' "
         "THEN 'Failed' ELSE 'Complications' END"),
        ("Surgery Duration (hours)", lambda: _txt(col("l_quantity").cast("bigint")),
         "CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR)"),
        ("Recovery Period (days)", lambda: _txt(ln() * 3), "CAST(l_linenumber * 3 AS VARCHAR)"),
    ]


def lab_reports_raw():
    k = lambda: col("k")
    ln = lambda: col("l_linenumber")
    return "lineitem", "l_orderkey", [
        ("Sl. No.", lambda: _txt(ln()), "CAST(l_linenumber AS VARCHAR)"),
        ("Report ID", lambda: _txt(k() * 10 + ln()), "CAST(k * 10 + l_linenumber AS VARCHAR)"),
        ("Case ID", lambda: dirty_bigint(k()), bi_sql("k")),
        ("Patient ID", lambda: _cat("PT", _txt(idiv(col("l_partkey"), F.lit(2)))),
         "'PT' || CAST(l_partkey // 2 AS VARCHAR)"),
        ("Branch ID", lambda: _cat("BR", _txt(ln())), "'BR' || CAST(l_linenumber AS VARCHAR)"),
        ("Test Name", lambda: _cat("Test ", col("l_returnflag")), "'Test ' || l_returnflag"),
        ("Test Date", lambda: dirty_date(k() + ln(), col("l_shipdate")),
         dt_sql("(k + l_linenumber)", "l_shipdate")),
        ("Result", lambda: col("l_linestatus"), "l_linestatus"),
    ]


def prescriptions_raw():
    k = lambda: col("k")
    size = lambda: col("p_size")
    return "part", "p_partkey", [
        ("Sl. No.", lambda: _txt(k() + 1), "CAST(k + 1 AS VARCHAR)"),
        ("Bill ID", lambda: _txt(k() + F.lit(7000000000)), "CAST(k + 7000000000 AS VARCHAR)"),
        ("Patient ID", lambda: _cat("PT", _txt(idiv(k(), F.lit(3)))), "'PT' || CAST(k // 3 AS VARCHAR)"),
        ("Doctor ID", lambda: _cat("DR", _txt(size())), "'DR' || CAST(p_size AS VARCHAR)"),
        ("Medication Name", lambda: col("p_name"), "p_name"),
        ("Dosage", lambda: _cat(_txt(size()), "mg"), "CAST(p_size AS VARCHAR) || 'mg'"),
        ("Quantity", lambda: _txt(size()), "CAST(p_size AS VARCHAR)"),
        ("Pharmacy Availability", lambda: dirty_yes_no(k()), yn_sql("k")),
        ("Issued Date", lambda: dirty_date(k(), F.lit("2024-05-01")), dt_sql("k", "'2024-05-01'")),
    ]


STANDINS: dict[str, Callable[[], tuple[str, str, Raw]]] = {
    "branches": branches_raw, "doctors": doctors_raw, "patients": patients_raw,
    "appointments": appointments_raw, "billing": billing_raw, "surgeries": surgeries_raw,
    "lab_reports": lab_reports_raw, "prescriptions": prescriptions_raw,
}


def raw_frame(t: DriverTables, table: str) -> DataFrame:
    """The all-text raw table with hospital headers and an ingest ordinal,
    as the CSV reader would return it."""
    source, key, raw = STANDINS[table]()
    src = t.table(source).withColumn("k", F.col(key))
    df = src.select(*[thunk().cast("string").alias(h) for h, thunk, _ in raw],
                    F.col("k").alias(ORD))
    return normalize_null_tokens(df, [h for h, _, _ in raw])


def etl_table(t: DriverTables, table: str) -> DataFrame:
    """Transform + conform; the rows that load."""
    spec = S.SPECS[table]
    cleaned = transform(raw_frame(t, table), spec, order=ORD if spec.primary_key else None)
    return good_rows(conform(cleaned, spec))


for _name in STANDINS:
    query(f"etl_{_name}")(lambda t, _n=_name: etl_table(t, _n))


# --- oracles: the spec applied with DuckDB's own casts -------------------------------

_TOKENS = ", ".join("'" + x.replace("'", "''") + "'" for x in NA_TOKENS)


def _clean_sql(spec: TableSpec, col: str, type_: str) -> tuple[str, str]:
    """(typed expression, 'does not fit' predicate) for one declared column,
    reading the text column ``r_<col>``."""
    v = f"r_{col}"
    if col in spec.yes_no:
        return yes_no_sql(v), "false"
    if col in spec.dates:
        return f"TRY_CAST({v} AS DATE)", "false"
    if col in spec.bigint_default0:
        return bigint0_sql(v), "false"
    if type_ in ("int", "bigint"):
        sql_t = "INTEGER" if type_ == "int" else "BIGINT"
        t = declared_int_sql(v, sql_t)
        return t, f"({v} IS NOT NULL AND ({t}) IS NULL)"
    if type_.startswith("decimal"):
        t = f"TRY_CAST({v} AS {type_.upper()})"
        return t, f"({v} IS NOT NULL AND {t} IS NULL)"
    return v, "false"


# The clean name of each raw header, written out so that the
# oracle does not rest on the operators under test.
CLEAN_NAMES = {
    "Sl. No.": "serial_no", "Serial No": "serial_no", "Branch ID": "branch_id",
    "Location": "location", "OT_Available": "ot_available",
    "Inhouse Anesthetician": "inhouse_anesthetician", "No. of OTs": "no_of_ots",
    "Inhouse Pharmacy": "inhouse_pharmacy", "Inhouse Nutritionist": "inhouse_nutritionist",
    "Inpatient Rooms": "inpatient_rooms", "Luxury Suite Rooms": "luxury_suite_rooms",
    "Prayer Room": "prayer_room", "Kids Play Area": "kids_play_area",
    "Doctor Name": "doctor_name", "Doctor ID": "doctor_id", "Specialization": "specialization",
    "Qualification": "qualification", "Surgery Experience": "surgery_experience",
    "Practicing Branch": "practicing_branch", "Other Branches Visited": "other_branches",
    "Patient ID": "patient_id", "Date of Registration": "date_of_registration",
    "Date of First Consultation": "date_of_first_consultation",
    "Date of Latest Consultation": "date_of_latest_consultation",
    "Overall Satisfaction Rating": "overall_satisfaction_rating", "Admission": "admission",
    "Surgery Underwent": "surgery_underwent", "Total Number of Visits": "total_number_of_visits",
    "Case ID": "case_id", "Date of Consultation": "date_of_consultation",
    "Requested Doctor ID": "requested_doctor_id", "Consulted Doctor ID": "consulted_doctor_id",
    "Reason for Visit": "reason_for_visit", "Diagnosis": "diagnosis",
    "Prescribed Medication": "prescribed_medication", "Followup Required": "followup_required",
    "Nutritionist Recommended": "nutritionist_recommended", "Claim ID": "claim_id",
    "Total Bill": "total_bill", "Insurance Provider": "insurance_provider",
    "Amount Covered": "amount_covered", "Out of Pocket Expenses": "out_of_pocket_expenses",
    "Claim Status": "claim_status", "Surgery Type": "surgery_type", "Surgery Date": "surgery_date",
    "Anesthesia Type": "anesthesia_type", "Surgery Outcome": "surgery_outcome",
    "Surgery Duration (hours)": "surgery_duration_hours",
    "Recovery Period (days)": "recovery_period_days", "Report ID": "report_id",
    "Test Name": "test_name", "Test Date": "test_date", "Result": "result", "Bill ID": "bill_id",
    "Medication Name": "medication_name", "Dosage": "dosage", "Quantity": "quantity",
    "Pharmacy Availability": "pharmacy_availability", "Issued Date": "issued_date",
}


def texts_sql(table: str) -> str:
    """The raw texts of a stand-in, as ``r_<clean name>``, and its order."""
    source, key, raw = STANDINS[table]()
    texts = ", ".join(f"CASE WHEN ({sql}) IN ({_TOKENS}) THEN NULL ELSE ({sql}) END "
                      f"AS r_{CLEAN_NAMES[h]}" for h, _, sql in raw)
    return f"(SELECT {texts}, k AS ord FROM (SELECT *, {key} AS k FROM {source}) s)"


def base_sql(table: str) -> str:
    """The rows of a stand-in after keep-first."""
    spec = S.SPECS[table]
    if not spec.primary_key:
        return texts_sql(table)
    return (f"(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY r_{spec.primary_key} "
            f"ORDER BY ord) AS rn FROM {texts_sql(table)} b0) WHERE rn = 1)")


def etl_oracle(table: str) -> str:
    spec = S.SPECS[table]
    have = {CLEAN_NAMES[h] for h, _, _ in STANDINS[table]()[2]}
    sel, bad = [], []
    for c in spec.columns:
        if c.name not in have:
            sel.append(f"NULL AS {c.name}")
            continue
        expr, unfit = _clean_sql(spec, c.name, c.type)
        sel.append(f"{expr} AS {c.name}")
        bad.append(unfit)
        if c.max_len is not None:
            bad.append(f"COALESCE(length({expr}) > {c.max_len}, false)")
    return f"SELECT {', '.join(sel)} FROM {base_sql(table)} b WHERE NOT ({' OR '.join(bad)})"


for _name in STANDINS:
    ORACLES[f"etl_{_name}"] = etl_oracle(_name)
