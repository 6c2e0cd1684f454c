"""Keys of SURVEY section 2.1: scans, landing, sinks and audits, plus the
profiling report (C13).  Files are written under the shared folder named by
``spark.checkpoint.dir`` (a fresh sub-folder per call)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import integrity as I
from ..operators import profiling as P
from ..operators.cleaning import dedup_keep_first
from ..operators.conform import ColumnSpec, TableSpec
from ..operators.table_profile import TableProfile
from ..session import scratch_path
from ..sources.csv import ORDINAL, read_raw_csv, write_csv
from ..sources.catalog import DRIVER_TABLES, row_counts
from ..sources.incremental import land_changed, read_changed
from ..sources.landing import land_raw, landing_audit
from ..sources.sinks import _fs, delete_path, load_count_audit, write_table
from ..sources.snapshots import read_snapshot, snapshot_table
from . import profiling_keys as PK
from . import etl_keys as EK
from .jobs import bad_date_examples, bridge_preview, etl_job, etl_table, read_loaded
from . import schemas as S
from .oracles import ORACLES, bigint_or_null_sql, list_items_sql
from .registry import query
from .standins import DriverTables, dirty_list, mismatch_pair

ORDERS_TEXT_SPEC = TableSpec(
    name="orders",
    columns=(ColumnSpec("o_orderkey", "bigint"), ColumnSpec("o_custkey", "bigint"),
             ColumnSpec("o_orderstatus", "string", 1), ColumnSpec("o_totalprice", "double"),
             ColumnSpec("o_orderdate", "date"), ColumnSpec("o_orderpriority", "string", 15)),
)
LOADED_ORDERS_SPEC = TableSpec(
    name="orders",
    columns=(ColumnSpec("o_orderkey", "bigint"), ColumnSpec("o_custkey", "bigint"),
             ColumnSpec("o_orderstatus", "string", 1), ColumnSpec("o_totalprice", "decimal(12,2)"),
             ColumnSpec("o_orderdate", "date"), ColumnSpec("o_orderpriority", "string", 15)),
)


def _orders_as_csv(t: DriverTables, name: str) -> str:
    """orders written as CSV (in key order, several part files) under the
    shared folder; returns the folder."""
    path = scratch_path(t.spark, name)
    o = t.orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    write_csv(o.orderBy("o_orderkey"), path)
    return path


def _typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.select(*[F.col(c.name).try_cast(c.type).alias(c.name) for c in spec.columns])


@query("scan_csv_roundtrip")
def _scan_csv_roundtrip(t: DriverTables) -> DataFrame:
    raw = read_raw_csv(t.spark, _orders_as_csv(t, "scan_csv"), with_ordinal=False)
    return _typed(raw, ORDERS_TEXT_SPEC)


@query("land_raw_roundtrip")
def _land_raw_roundtrip(t: DriverTables) -> DataFrame:
    """CSV -> landed Parquet with the ingest ordinal -> keep the first order
    of each customer *in file order*: equals the smallest order key, since
    the file was written in key order across several part files."""
    root = scratch_path(t.spark, "landing")
    written = land_raw(t.spark, {"orders": _orders_as_csv(t, "land_src")}, root)
    landed = t.spark.read.parquet(written[0].path)
    first = dedup_keep_first(landed.select("o_custkey", "o_orderkey", "o_orderstatus", ORDINAL),
                             ["o_custkey"], ORDINAL)
    return first.select(F.col("o_custkey").cast("bigint").alias("o_custkey"),
                        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                        "o_orderstatus")


@query("landing_file_audit")
def _landing_file_audit(t: DriverTables) -> DataFrame:
    """Every table of the catalog by its files, with its rows beside them;
    one name has no files."""
    paths = {n: f"{t.sf_dir}/{n}.parquet" for n in (*DRIVER_TABLES, "absent_table")}
    audit = landing_audit(t.spark, paths).select("table_name", "present", "non_empty", "status")
    rows = row_counts({n: t.table(n) for n in DRIVER_TABLES})
    return audit.join(rows, "table_name", "left").select(
        "table_name", "present", "non_empty", "status", F.coalesce("row_count", F.lit(0)).alias("rows"))


def _put_csv(df: DataFrame, folder: str, name: str) -> None:
    """Rows as one CSV file of that name (a raw file of the stand-ins)."""
    spark, tmp = df.sparkSession, f"{folder}/_{name}"
    write_csv(df.coalesce(1), tmp)
    fs, src = _fs(spark, tmp)
    part = next(s.getPath() for s in fs.listStatus(src) if s.getPath().getName().startswith("part-"))
    target = _fs(spark, f"{folder}/{name}")[1]
    fs.delete(target, False)
    fs.rename(part, target)
    fs.delete(src, True)


@query("land_changed_files")
def _land_changed_files(t: DriverTables) -> DataFrame:
    """orders as five raw files; then one is changed, one goes, one comes and two
    stay: what the second landing says of each, and the rows and prices that the
    table then holds."""
    root = scratch_path(t.spark, "incremental")
    o = t.orders.select("o_orderkey", (F.col("o_orderkey") % 6).alias("file"),
                        F.col("o_totalprice").cast("decimal(12,2)").alias("price"))

    def put(i: int, price) -> None:
        _put_csv(o.where(F.col("file") == i).select("o_orderkey", price.cast("decimal(12,2)").alias("price")),
                 f"{root}/csv", f"orders_{i}.csv")
    for i in range(5):
        put(i, F.col("price"))
    land_changed(t.spark, {"orders": f"{root}/csv"}, root)
    put(1, F.col("price") + 1000000)
    put(5, F.col("price"))
    fs, gone = _fs(t.spark, f"{root}/csv/orders_2.csv")
    fs.delete(gone, False)
    report = land_changed(t.spark, {"orders": f"{root}/csv"}, root)
    held = read_changed(t.spark, root, "orders").select(
        F.concat(F.lit("orders_"), (F.col("o_orderkey").cast("bigint") % 6).cast("string"), F.lit(".csv")).alias("file"),
        F.col("price").cast("decimal(12,2)").alias("price"))
    sums = held.groupBy("file").agg(F.count(F.lit(1)).alias("rows_held"), F.sum("price").alias("price_held"))
    report = report.select(F.element_at(F.split("path", "/"), -1).alias("file"), "status", "rows")
    return report.join(sums, "file", "left").select(
        "file", "status", "rows", F.coalesce("rows_held", F.lit(0)).alias("rows_held"),
        F.col("price_held").cast("string").alias("price_held"))


def _small(t: DriverTables, audit: DataFrame, root: str) -> DataFrame:
    """An audit (one row per table) taken before its tables are removed."""
    rows = audit.collect()
    delete_path(t.spark, root)
    return t.spark.createDataFrame(rows, audit.schema)


@query("load_count_audit")
def _load_count_audit(t: DriverTables) -> DataFrame:
    root = scratch_path(t.spark, "warehouse")
    written = [write_table(t.spark, t.table(n), root, n) for n in DRIVER_TABLES]
    return _small(t, load_count_audit(t.spark, written), root)


@query("etl_job")
def _etl_job(t: DriverTables) -> DataFrame:
    """Dimensions, bridge and facts of all eight raw stand-ins, written,
    audited and committed as one snapshot; ``snapshot_rows`` are those of the
    nine tables that its manifest names, read back."""
    root = scratch_path(t.spark, "mart")
    raw = {n: EK.raw_frame(t, n) for n in EK.STANDINS}
    audit = etl_job(t.spark, raw, root)
    snapshot = read_snapshot(t.spark, root)
    read = row_counts({n: snapshot_table(t.spark, root, n, snapshot) for n in snapshot.tables},
                      with_total=False)
    return _small(t, audit.join(read.withColumnRenamed("row_count", "snapshot_rows"), "table_name"), root)


@query("etl_load_roundtrip")
def _etl_load_roundtrip(t: DriverTables) -> DataFrame:
    """orders as raw text -> conform to the declared schema -> published
    with a load-status partition -> the loaded rows read back."""
    root = scratch_path(t.spark, "etl")
    raw = t.orders.select(*[F.col(c).cast("string").alias(c) for c in
                            ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]],
                          F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"),
                          "o_orderpriority")
    write_table(t.spark, etl_table(raw, LOADED_ORDERS_SPEC), root, "orders",
                partition_by=["load_status"])
    return read_loaded(t.spark, root, "orders")


# --- C13 on the stand-ins ---------------------------------------------------------

PROFILE_STEPS = [
    # (step, check, key, metrics, table_col, column_col, item_col)
    (1, "row_counts", "catalog_row_counts", ["row_count"], "table_name", None, None),
    (2, "nulls", "profile_nulls", ["null_count", "pct"], "table_name", "column_name", None),
    (3, "types", "profile_types", ["dtype", "sample"], "table_name", "column_name", None),
    (4, "int_range", "profile_int_range", ["max_value", "needs_bigint"], "table_name",
     "column_name", None),
    (5, "categorical", "profile_categorical", ["cnt", "pct", "status"], "table_name",
     "column_name", "value"),
    (6, "dates", "profile_dates", ["bad_count", "min_date", "max_date"], "table_name",
     "column_name", None),
    (7, "yes_no", "profile_yes_no", ["yes_count", "no_count", "unexpected_count"],
     "table_name", "column_name", None),
    (8, "list_column", "bridge_profile", ["total_rows", "parse_errors", "pairs",
                                          "distinct_items"], None, None, None),
    (9, "foreign_keys", "fk_integrity", ["child_ids", "orphans", "examples"], None, None,
     "label"),
    (10, "requested_vs_consulted", "profile_mismatch",
     ["mismatches", "total", "pct", "all_mismatch"], None, None, None),
]


def orders_audited(t: DriverTables) -> DataFrame:
    """orders once, with every derived column that the report profiles."""
    src, k = t.orders, t.orders.o_orderkey
    a, b = mismatch_pair(k, src.o_orderstatus)
    return src.select(*[c.alias(n) for n, c in PK.profiled_columns(t).items()],
                      a.alias("requested"), b.alias("consulted"),
                      dirty_list(k, src.o_orderstatus, src.o_orderpriority).alias("ls_raw"))


@query("profile_report")
def _profile_report(t: DriverTables) -> DataFrame:
    """C13 on the stand-ins: each table is scanned twice (one aggregate
    pass, one value pass) whatever the number of checks; examples and
    previews are bounded."""
    cust, op = PK.customer_nt(t), orders_audited(t)
    profiled = list(PK.profiled_columns(t))
    parts = [
        P.long_metrics(row_counts(PK.counted_tables(t)), 1, "row_counts",
                       ["row_count"], "table_name", None),
        TableProfile(cust, "customer").nulls().types("c_custkey", cols=cust.columns)
        .categorical(["segment", "c_nationkey", "Anesthesia Type"]).long(),
        TableProfile(op, "orders").nulls(cols=["o_orderkey", "requested", "consulted"])
        .int_range(cols=[c for c in P.numeric_columns(op) if c in profiled])
        .dates(["dt_raw", "dt_clean", "o_orderdate"]).yes_no(["yn_raw", "yn_clean"], values=True)
        .mismatch("requested", "consulted").list_column("ls_raw").long(),
        bad_date_examples(op, "orders", "dt_raw", "o_orderkey"),
        bridge_preview(op, "orders", "o_orderkey", "ls_raw", "o_orderkey"),
        P.long_metrics(I.fk_integrity(PK.driver_fks(t)), 9, "foreign_keys",
                       ["child_ids", "orphans", "examples"], None, None, "label"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- oracles -------------------------------------------------------------------------

ORACLES["scan_csv_roundtrip"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority FROM orders"""

ORACLES["land_raw_roundtrip"] = ORACLES["dedup_keep_first"]

ORACLES["land_changed_files"] = """
WITH f AS (SELECT o_orderkey % 6 AS i, CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders),
g AS (SELECT i, COUNT(*) AS n, SUM(price + CASE WHEN i = 1 THEN 1000000 ELSE 0 END) AS p FROM f GROUP BY i)
SELECT 'orders_' || i || '.csv' AS file,
       CASE i WHEN 1 THEN 'changed' WHEN 2 THEN 'vanished' WHEN 5 THEN 'new' ELSE 'unchanged' END AS status,
       CAST(n AS BIGINT) AS rows, CAST(CASE WHEN i = 2 THEN 0 ELSE n END AS BIGINT) AS rows_held,
       CASE WHEN i <> 2 THEN CAST(CAST(p AS DECIMAL(22,2)) AS VARCHAR) END AS price_held
FROM g"""

ORACLES["load_count_audit"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows_written, "
    f"CAST(COUNT(*) AS BIGINT) AS rows_read, CAST(COUNT(*) AS BIGINT) AS rows_loaded, "
    f"CAST(0 AS BIGINT) AS rows_rejected, true AS ok FROM {n}" for n in DRIVER_TABLES)

ORACLES["landing_file_audit"] = " UNION ALL ".join(
    [f"SELECT '{n}' AS table_name, true AS present, true AS non_empty, 'ok' AS status, "
     f"CAST(COUNT(*) AS BIGINT) AS rows FROM {n}" for n in DRIVER_TABLES]
    + ["SELECT 'absent_table', false, false, 'missing', CAST(0 AS BIGINT)",
       "SELECT 'TOTAL', true, true, 'ok', CAST("
       + " + ".join(f"(SELECT COUNT(*) FROM {n})" for n in DRIVER_TABLES) + " AS BIGINT)"])


def _etl_job_sql() -> str:
    parts = []
    for name in EK.STANDINS:
        ids = " + ".join(f"COUNT(*) FILTER (WHERE {bigint_or_null_sql(f'r_{c}')} IS NULL)"
                         for c in S.SPECS[name].bigint_default0)
        raw = EK.texts_sql(name)
        errors = (f"(SELECT COUNT(*) FROM {raw} r WHERE r_other_branches IS NULL "
                  f"OR r_other_branches NOT LIKE '[%]')" if name == "doctors" else "NULL")
        parts.append(f"""SELECT '{name}' AS table_name,
          (SELECT COUNT(*) FROM {EK.base_sql(name)} b) AS w,
          (SELECT COUNT(*) FROM ({ORACLES[f'etl_{name}']}) l) AS l,
          {f'(SELECT {ids} FROM {raw} r)' if ids else 'NULL'} AS z, {errors} AS e""")
    doctors = EK.texts_sql("doctors")
    pairs = f"""(SELECT DISTINCT r_doctor_id, unnest({list_items_sql('r_other_branches')}) AS b
       FROM {doctors} d)"""
    parts.append(f"""SELECT 'doctor_branch_visits', (SELECT COUNT(*) FROM {pairs} p),
      (SELECT COUNT(*) FROM {pairs} p WHERE length(b) <= 10 AND length(r_doctor_id) <= 20), NULL, NULL""")
    return f"""SELECT table_name, CAST(w AS BIGINT) AS rows_written, CAST(w AS BIGINT) AS rows_read,
      CAST(l AS BIGINT) AS rows_loaded, CAST(w - l AS BIGINT) AS rows_rejected, true AS ok,
      CAST(z AS BIGINT) AS zero_ids, CAST(e AS BIGINT) AS list_errors, CAST(w AS BIGINT) AS snapshot_rows
    FROM ({' UNION ALL '.join(parts)}) u"""


ORACLES["etl_job"] = _etl_job_sql()

ORACLES["etl_load_roundtrip"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"""


def _metric_sql(v: str, is_float: bool) -> str:
    if is_float:
        return f"CAST(CAST({v} AS DECIMAL(38,6)) AS VARCHAR)"
    return f"CAST({v} AS VARCHAR)"


# metrics printed from DOUBLE columns
_FLOAT_METRICS = {"pct"}


def _profile_report_sql() -> str:
    parts = []
    for step, check, key, metrics, tcol, ccol, icol in PROFILE_STEPS:
        def pick(c):
            return f"CAST({c} AS VARCHAR)" if c else "CAST(NULL AS VARCHAR)"
        for m in metrics:
            parts.append(
                f"SELECT {step} AS step, '{check}' AS check_name, {pick(tcol)} AS table_name, "
                f"{pick(ccol)} AS column_name, {pick(icol)} AS item, '{m}' AS metric, "
                f"{_metric_sql(m, m in _FLOAT_METRICS)} AS value FROM ({ORACLES[key]}) q")
    examples = [
        ("6 AS step, 'dates_bad_values'", "table_name", "column_name", "NULL", "'bad_value'",
         "COALESCE(bad_value, 'NULL')", "profile_dates_bad_values"),
        ("7 AS step, 'yes_no_unexpected'", "table_name", "column_name", "unexpected_value", "'value'",
         "COALESCE(unexpected_value, 'NULL')", "profile_yes_no_unexpected"),
        ("8 AS step, 'list_column_preview'", "'orders'", "'ls_raw'", "CAST(pair_no AS VARCHAR)", "'pair'",
         "CAST(doctor_id AS VARCHAR) || ' -> ' || branch_id", "bridge_preview")]
    for head, table, column, item, metric, value, key in examples:
        parts.append(f"SELECT {head} AS check_name, {table} AS table_name, {column} AS column_name, "
                     f"{item} AS item, {metric} AS metric, {value} AS value FROM ({ORACLES[key]}) q")
    return " UNION ALL ".join(parts)


ORACLES["profile_report"] = _profile_report_sql()

