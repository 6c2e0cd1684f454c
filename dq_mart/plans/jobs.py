"""The four batch jobs: land, profile, ETL and report.

Paths and the run date are parameters; nothing reads the clock inside a
query.  Each job is a sequence of DataFrame plans; the only driver-side
values are per-table row counts observed on writes.
"""

from __future__ import annotations

import datetime as _dt
import functools
import logging
import operator
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators import integrity as I
from ..operators import profiling as P
from ..functions.casts import bigint_from_text, parse_list_string
from ..functions.text import normalize_header, quoted
from ..operators.cleaning import explode_list_pairs
from ..operators.conform import REJECT_REASONS, RAW, conform, transform
from ..operators.table_profile import TableProfile
from ..session import checkpoint_root
from ..sources.catalog import row_counts
from ..sources.csv import ORDINAL
from ..sources.incremental import land_changed, read_changed
from ..sources.landing import RAW_PREFIX, land_raw, verify_landing
from ..sources.sinks import load_count_audit, table_path
from ..sources.snapshots import Snapshot, Staged, commit, read_snapshot, stage_table
from . import schemas as S
from .report import Section, report_lines, write_report

log = logging.getLogger(__name__)

# --- fixed values -----------------------------------------------------------
# Raw file of each table.
HOSPITAL_FILES = {
    "appointments": "appointments.csv",
    "billing": "billing.csv",
    "patients": "patients.csv",
    "doctors": "doctors.csv",
    "surgeries": "surgeries.csv",
    "prescriptions": "prescriptions.csv",
    "lab_reports": "lab_reports.csv",
    "branches": "branches.csv",
}
# Profiling plan: columns audited per table (raw header names).
CATEGORICAL = {
    "surgeries": ["Surgery Outcome", "Anesthesia Type"],
    "prescriptions": ["Pharmacy Availability"],
    "patients": ["Admission", "Surgery Underwent"],
}
DATE_COLUMNS = {
    "appointments": ["Date of Consultation"],
    "patients": ["Date of Registration", "Date of First Consultation",
                 "Date of Latest Consultation"],
    "surgeries": ["Surgery Date"],
    "prescriptions": ["Issued Date"],
    "lab_reports": ["Test Date"],
}
YES_NO_COLUMNS = {
    "branches": ["OT_Available", "Inhouse Anesthetician", "Inhouse Pharmacy",
                 "Inhouse Nutritionist", "Luxury Suite Rooms", "Prayer Room", "Kids Play Area"],
    "patients": ["Admission", "Surgery Underwent"],
    "appointments": ["Followup Required", "Nutritionist Recommended"],
    "prescriptions": ["Pharmacy Availability"],
}
# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("appointments", "Patient ID", "patients", "Patient ID"),
    ("appointments", "Branch ID", "branches", "Branch ID"),
    ("appointments", "Consulted Doctor ID", "doctors", "Doctor ID"),
    ("billing", "Patient ID", "patients", "Patient ID"),
    ("surgeries", "Patient ID", "patients", "Patient ID"),
    ("surgeries", "Doctor ID", "doctors", "Doctor ID"),
    ("prescriptions", "Patient ID", "patients", "Patient ID"),
    ("lab_reports", "Patient ID", "patients", "Patient ID"),
]
LOAD_STATUS = "load_status"
# ---------------------------------------------------------------------------


# --- land -------------------------------------------------------------------------

def land_job(spark: SparkSession, csv_folder: str, root: str,
             files: Mapping[str, str] = HOSPITAL_FILES, multiline: bool = False) -> DataFrame:
    """Every raw CSV -> Parquet at ``<root>/raw/<table>`` with its
    ingest ordinal, then the audit of what landed: a row for each table
    (absent sources are skipped and audited as missing) and the total.
    Fails when nothing landed."""
    sources = {name: f"{csv_folder.rstrip('/')}/{fn}" for name, fn in files.items()}
    land_raw(spark, sources, root, multiline=multiline)
    raw = f"{root.rstrip('/')}/{RAW_PREFIX}"
    return verify_landing(spark, {name: table_path(spark, raw, name) for name in files})


def land_changed_job(spark: SparkSession, csv_folder: str, root: str,
                     files: Mapping[str, str] = HOSPITAL_FILES, multiline: bool = False) -> DataFrame:
    """S4, S5 incrementally: only files that are new or changed are read; a row
    for each file with its status."""
    sources = {name: f"{csv_folder.rstrip('/')}/{fn}" for name, fn in files.items()}
    return land_changed(spark, sources, root, multiline=multiline)


def read_landed(spark: SparkSession, root: str, names=HOSPITAL_FILES) -> dict[str, DataFrame]:
    """The landed raw tables that exist (whole, or file by file), null tokens
    applied as the reference's reader does."""
    from ..operators.cleaning import normalize_null_tokens
    out = {}
    for name in names:
        path = table_path(spark, f"{root.rstrip('/')}/{RAW_PREFIX}", name)
        df = spark.read.parquet(path) if path is not None else read_changed(spark, root, name)
        if df is not None:
            out[name] = normalize_null_tokens(df, [c for c in df.columns if c != ORDINAL])
    return out


# --- ETL --------------------------------------------------------------------------

def with_status(conformed: DataFrame) -> DataFrame:
    return conformed.withColumn(
        LOAD_STATUS, F.when(F.col(REJECT_REASONS).isNull(), "ok").otherwise("rejected"))


def etl_table(raw: DataFrame, spec, counters: Sequence[str] = ()) -> DataFrame:
    """transform + conform + status: the loaded form of one raw table;
    ``counters`` are number columns of the raw rows that go along."""
    order = ORDINAL if spec.primary_key else None
    clean = transform(raw, spec, order=order, totals=counters)
    return with_status(conform(clean, spec, keep=counters))


def doctor_bridge(raw_doctors: DataFrame) -> DataFrame | None:
    """The doctor/branch bridge from the raw list-string column, or None
    when the column is absent."""
    if S.DOCTOR_LIST_COLUMN not in raw_doctors.columns:
        log.warning("doctors: %s absent; no bridge", S.DOCTOR_LIST_COLUMN)
        return None
    pairs = explode_list_pairs(raw_doctors, S.DOCTOR_ID_COLUMN, S.DOCTOR_LIST_COLUMN)
    return with_status(conform(pairs, S.BRIDGE))


class AuditFailed(RuntimeError):
    """The refresh was not committed; ``audit`` holds the rows of its audit."""

    def __init__(self, root: str, audit: list):
        bad = ", ".join(r["table_name"] for r in audit if not r["ok"])
        super().__init__(f"{root}: audit failed for {bad}; the snapshot stays as it was")
        self.audit = audit


def etl_job(spark: SparkSession, raw: Mapping[str, DataFrame], out_root: str,
            guess_dates: bool = False) -> DataFrame:
    """Dimensions, bridge, facts; each written as a new version under
    ``<out_root>/<table>``, partitioned by ``load_status`` (rejected rows keep
    their reasons and raw text in the ``rejected`` partition: one scan, one
    write per table), then the row-count audit (S12) with the written, loaded
    and rejected rows and, per table, the ids that became 0 and the
    list-strings that don't parse (null where a table has no such column; both
    counted on the write).

    The audit is the gate: only if it holds for every table, one manifest makes
    all versions the current snapshot.  A job that fails or is killed before
    that, or whose audit is false (``AuditFailed``), leaves every table as it
    was; one that another job overtook fails (``SnapshotConflict``).
    ``guess_dates`` finds the layout of each date column from its values (one
    more scan of the tables that have any)."""
    base = read_snapshot(spark, out_root)
    staged: list[Staged] = []
    for name, spec in S.SPECS.items():
        if name not in raw:
            log.warning("etl: no raw %s; skipped", name)
            continue
        if guess_dates:
            spec = replace(spec, date_formats=())
        staged.append(stage_loaded(raw[name], spec, out_root))
        if name == "doctors":
            bridge = doctor_bridge(raw[name])
            if bridge is not None:
                staged.append(stage_table(bridge, out_root, S.BRIDGE.name, [LOAD_STATUS]))
    audit = load_count_audit(spark, staged, loaded=f"{LOAD_STATUS} = 'ok'")
    counted = spark.createDataFrame(
        [(s.table, s.metrics.get("zero_ids"), s.metrics.get("list_errors")) for s in staged],
        "table_name string, zero_ids bigint, list_errors bigint")
    # one row for each table
    rows = audit.join(counted, "table_name", "left").collect()
    if not rows or not all(r["ok"] for r in rows):
        raise AuditFailed(out_root, rows)
    commit(spark, out_root, base, {s.table: s.version for s in staged}, {s.table: s.rows for s in staged})
    return spark.createDataFrame(rows, "table_name string, rows_written bigint, rows_read bigint, "
                                 "rows_loaded bigint, rows_rejected bigint, ok boolean, "
                                 "zero_ids bigint, list_errors bigint")


def coercion_counters(raw: DataFrame, spec) -> dict[str, Column]:
    """``zero_ids``, ``list_errors`` of a raw row: its values of zero-defaulted
    id columns that are no number, and its list-string if that does not parse;
    only those that the table has columns for."""
    clean = {c: normalize_header(c) for c in raw.columns}
    final = spec.rename_for(list(clean.values()))
    ids = [c for c, name in clean.items() if final.get(name, name) in spec.bigint_default0]
    out = {}
    if ids:
        out["zero_ids"] = functools.reduce(operator.add, [
            bigint_from_text(F.col(quoted(c))).isNull().cast("bigint") for c in ids])
    if S.DOCTOR_LIST_COLUMN in raw.columns:
        out["list_errors"] = parse_list_string(F.col(quoted(S.DOCTOR_LIST_COLUMN))).isNull().cast("bigint")
    return out


def stage_loaded(raw: DataFrame, spec, root: str) -> Staged:
    """One raw table conformed and written, with its quality counters observed
    on the write: the raw rows are scanned once."""
    counters = {f"etl_{n}": c for n, c in coercion_counters(raw, spec).items()}
    rows = etl_table(raw.withColumns(counters) if counters else raw, spec, list(counters))
    metrics = {c[len("etl_"):]: F.coalesce(F.sum(c), F.lit(0)) for c in counters}
    return stage_table(rows, root, spec.name, [LOAD_STATUS], metrics, drop=list(counters))


def read_loaded(spark: SparkSession, root: str, table: str,
                snapshot: Snapshot | None = None) -> DataFrame:
    """The loaded rows of a table (the ``ok`` partition, pruned at scan) as of
    a snapshot (the latest without one); of a table published alone, its
    current version."""
    snapshot = snapshot or read_snapshot(spark, root)
    path = table_path(spark, root, table) if table not in snapshot.tables \
        else f"{root.rstrip('/')}/{snapshot.tables[table]}"
    if path is None:
        raise FileNotFoundError(f"no table {table} under {root}")
    df = spark.read.parquet(path)
    return df.filter(F.col(LOAD_STATUS) == "ok").drop(LOAD_STATUS, REJECT_REASONS, RAW)


# --- profile ------------------------------------------------------------------------

def bad_date_examples(df: DataFrame, table: str, column: str, order: str) -> DataFrame:
    """The first distinct bad values of a date column, as long metrics; a
    missing value as ``NULL``."""
    bad = P.profile_dates_bad_values(df, table, column, order)
    return P.long_metrics(bad.withColumn("bad_value", F.coalesce("bad_value", F.lit("NULL"))),
                          6, "dates_bad_values", ["bad_value"])


def bridge_preview(df: DataFrame, table: str, id_col: str, list_col: str, order: str) -> DataFrame:
    """The first unpacked (id, item) pairs as long metrics, numbered."""
    top = P.list_column_preview(df, id_col, list_col, order)
    return P.long_metrics(
        top.select(F.lit(table).alias("table_name"), F.lit(list_col).alias("column_name"),
                   F.col("pair_no").cast("string").alias("pair_no"),
                   F.concat_ws(" -> ", F.col("doctor_id").cast("string"), "branch_id").alias("pair")),
        8, "list_column_preview", ["pair"], item_col="pair_no")


def profile_job(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """All checks over the raw catalog, in the reference's order, as one
    long metrics table.  Each table is scanned twice (one aggregate pass for
    nulls, types, integer range, dates and the requested/consulted check;
    one value pass for categorical and yes/no audits), plus the list-string
    profile of doctors and the FK checks on distinct keys."""
    parts = [P.long_metrics(row_counts(tables), 1, "row_counts", ["row_count"],
                            column_col=None)]
    for name, df in tables.items():
        data = [c for c in df.columns if c != ORDINAL]
        prof = TableProfile(df, name).nulls(cols=data)
        if ORDINAL in df.columns:
            prof.types(ORDINAL, cols=data)
        if name == "billing":
            prof.int_range(cols=data)
        if name in DATE_COLUMNS:
            prof.dates(DATE_COLUMNS[name])
            if ORDINAL in df.columns:
                parts += [bad_date_examples(df, name, c, ORDINAL)
                          for c in DATE_COLUMNS[name] if c in df.columns]
        if name in CATEGORICAL:
            prof.categorical(CATEGORICAL[name])
        if name in YES_NO_COLUMNS:
            prof.yes_no(YES_NO_COLUMNS[name], values=True)
        if name == "appointments":
            prof.mismatch("Requested Doctor ID", "Consulted Doctor ID")
        parts.append(prof.long())
    if "doctors" in tables and S.DOCTOR_LIST_COLUMN in tables["doctors"].columns:
        prof = P.profile_list_column(tables["doctors"], S.DOCTOR_LIST_COLUMN).select(
            F.lit("doctors").alias("table_name"),
            F.lit(S.DOCTOR_LIST_COLUMN).alias("column_name"), "*")
        parts.append(P.long_metrics(prof, 8, "list_column",
                                    ["total_rows", "parse_errors", "pairs", "distinct_items"]))
        if ORDINAL in tables["doctors"].columns:
            parts.append(bridge_preview(tables["doctors"], "doctors", S.DOCTOR_ID_COLUMN,
                                        S.DOCTOR_LIST_COLUMN, ORDINAL))
    fks = [I.ForeignKey(f"{c}.{cc} -> {p}.{pc}", tables[c], cc, tables[p], pc)
           for c, cc, p, pc in FOREIGN_KEYS if c in tables and p in tables]
    if fks:
        parts.append(P.long_metrics(I.fk_integrity(fks), 9, "foreign_keys",
                                    ["child_ids", "orphans", "examples"], table_col=None,
                                    column_col=None, item_col="label"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- report -------------------------------------------------------------------------

def _grouped_once(df: DataFrame, sets: list[list[str]], cols: list[str],
                  aggs: list) -> DataFrame:
    """One ``GROUPING SETS`` aggregation over a fact, materialised with a
    reliable checkpoint.  Its result is small (one row per group of every
    set); cutting the lineage stops Catalyst from pushing each section's
    ``grouping_id`` filter below the aggregate, which would scan the fact
    once per section again."""
    checkpoint_root(df.sparkSession)
    return (df.groupingSets(sets, *cols).agg(*aggs, F.grouping_id().alias("__gid"))
            .checkpoint(eager=True))


def report_sections(tables: Mapping[str, DataFrame]) -> list[Section]:
    """R1 with one pass per fact: the three appointment sections come from
    one grouping-sets aggregation, the two billing sections from another."""
    asc, desc = (lambda c: (c, "asc")), (lambda c: (c, "desc"))
    appt = tables["appointments"].withColumn("month", A.month_of("date_of_consultation"))
    ga = _grouped_once(
        appt, [["branch_id", "month"], ["diagnosis"], ["branch_id"]],
        ["branch_id", "month", "diagnosis"],
        [A.count_all().alias("n"),
         A._cnt_when(A._substituted("requested_doctor_id", "consulted_doctor_id")).alias("s")])
    # grouping_id bits follow (branch_id, month, diagnosis); 1 = rolled up
    visits = ga.filter("__gid = 1").select("branch_id", "month", F.col("n").alias("visit_count"))
    top = (ga.filter("__gid = 6").select("diagnosis", F.col("n").alias("frequency"))
           .orderBy(F.desc_nulls_first("frequency"), F.asc_nulls_last("diagnosis")).limit(10))
    subst = ga.filter("__gid = 3").select("branch_id", F.col("n").alias("total_appointments"),
                                          F.col("s").alias("substitutions"))
    bill = tables["billing"]
    st = F.col("claim_status")
    gb = _grouped_once(
        bill, [["branch_id"], ["insurance_provider"]], ["branch_id", "insurance_provider"],
        [A.count_all().alias("n"), A.sum_money("total_bill").alias("total"),
         F.count("total_bill").alias("n_bill"),
         A._cnt_when(st == A.APPROVED).alias("approved"),
         A._cnt_when(st == A.REJECTED).alias("rejected"),
         A._cnt_when(st == A.PENDING).alias("pending")])
    revenue = gb.filter("__gid = 1").select(
        "branch_id", F.col("n").alias("total_claims"), F.col("total").alias("total_revenue"),
        A.avg_money_from("total", "n_bill").alias("avg_bill"))
    claims = gb.filter("__gid = 2").select("insurance_provider", F.col("n").alias("total_claims"),
                                           "approved", "rejected", "pending")
    return [
        Section("visits_by_branch", visits, (asc("month"), desc("visit_count"), asc("branch_id"))),
        Section("revenue_by_branch", revenue, (desc("total_revenue"), asc("branch_id"))),
        Section("top_diagnoses", top, (desc("frequency"), asc("diagnosis"))),
        Section("surgery_outcomes", A.surgery_outcomes(tables["surgeries"]),
                (desc("total_surgeries"), asc("doctor_id"))),
        Section("claim_status", claims, (desc("total_claims"), asc("insurance_provider"))),
        Section("doctor_substitution", subst, (desc("substitutions"), asc("branch_id"))),
    ]


def report_job(spark: SparkSession, loaded_root: str, out_root: str,
               run_date: _dt.date | None = None) -> str:
    """Write ``<out_root>/reports/daily_report_<YYYY-MM-DD>`` and return its
    path.  Each fact is scanned once (``report_sections``)."""
    run_date = run_date or _dt.date.today()
    # all tables of one snapshot, whatever is committed meanwhile
    snapshot = read_snapshot(spark, loaded_root)
    tables = {n: read_loaded(spark, loaded_root, n, snapshot)
              for n in ("appointments", "billing", "surgeries")}
    path = f"{out_root.rstrip('/')}/reports/daily_report_{run_date.isoformat()}"
    write_report(report_lines(report_sections(tables)), path)
    return path
