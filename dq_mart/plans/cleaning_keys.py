"""Keys of SURVEY sections 2.2, 2.7 and 2.12: cleaning operators, keep-first
de-duplication, the list-string bridge and schema conformance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import NA_TOKENS
from ..operators import cleaning as C
from ..operators import profiling as P
from ..operators.date_layout import cast_guessed_dates, guess_layouts, guessed_formats
from ..operators.conform import (ColumnSpec, TableSpec, conform, good_rows,
                                 rejected_rows, transform)
from .oracles import (ORACLES, bi_sql, bigint0_sql, declared_int_sql, dt_sql, list_items_sql,
                      ls_sql, nt_sql, yes_no_sql, yn_sql)
from .registry import query
from .standins import (DriverTables, dirty_bigint, dirty_date, dirty_list,
                       dirty_null_token, dirty_yes_no)

# Noisy raw headers for the orders columns (P1 input) and their clean forms.
NOISY_ORDERS = {
    "o_orderkey": " Order Key ",
    "o_custkey": "Cust.(Key)",
    "o_orderstatus": "Order-Status",
    "o_totalprice": "Total  Price",
    "o_orderdate": "Order\tDate",
    "o_orderpriority": "Order Priority (level)",
}
CLEAN_ORDERS = {
    "o_orderkey": "Order_Key",
    "o_custkey": "Cust_Key",
    "o_orderstatus": "Order_Status",
    "o_totalprice": "Total_Price",
    "o_orderdate": "Order_Date",
    "o_orderpriority": "Order_Priority_level",
}
RENAME_ORDERS = {"Order_Key": "order_key", "Cust_Key": "customer_id",
                 "Order_Status": "status", "Not_A_Column": "ignored"}


def _noisy_orders(t: DriverTables) -> DataFrame:
    return t.orders.select(*[F.col(c).alias(n) for c, n in NOISY_ORDERS.items()])


@query("clean_headers")
def _clean_headers(t: DriverTables) -> DataFrame:
    return C.clean_headers(_noisy_orders(t))


@query("rename_columns")
def _rename_columns(t: DriverTables) -> DataFrame:
    return C.rename_columns(C.clean_headers(_noisy_orders(t)), RENAME_ORDERS)


@query("normalize_null_tokens")
def _normalize_null_tokens(t: DriverTables) -> DataFrame:
    c = t.customer
    raw = c.select("c_custkey", dirty_null_token(c.c_custkey, c.c_mktsegment).alias("segment"))
    return C.normalize_null_tokens(raw, ["segment"])


def _orders_dirty(t: DriverTables) -> DataFrame:
    o = t.orders
    k = o.o_orderkey
    return o.select(k.alias("o_orderkey"),
                    dirty_yes_no(k).alias("yn_raw"),
                    dirty_date(k, o.o_orderdate).alias("dt_raw"),
                    dirty_bigint(k).alias("bi_raw"),
                    dirty_list(k, o.o_orderstatus, o.o_orderpriority).alias("ls_raw"),
                    o.o_orderpriority, o.o_totalprice, o.o_orderdate)


@query("cast_yes_no")
def _cast_yes_no(t: DriverTables) -> DataFrame:
    d = _orders_dirty(t).select("o_orderkey", "yn_raw", F.col("yn_raw").alias("yn"))
    return C.cast_yes_no(d, ["yn", "absent_column"])


@query("cast_dates")
def _cast_dates(t: DriverTables) -> DataFrame:
    d = _orders_dirty(t).select("o_orderkey", "dt_raw", F.col("dt_raw").alias("dt"))
    return C.cast_dates(d, ["dt"])


def orders_dated(t: DriverTables) -> DataFrame:
    """Order dates in several layouts: clear ones, one that few values decide,
    one that none decides, and junk."""
    o = t.orders
    k, day = o.o_orderkey, o.o_orderdate.cast("date")
    low = F.make_date(F.year(day), F.month(day), F.lit(1) + k.cast("int") % 12)     # a day that may be a month
    junk = F.when(k % 11 == 0, "not-a-date").when(k % 13 == 0, None)
    fmt = lambda d, f: junk.otherwise(F.date_format(d, f))
    return o.select(
        "o_orderkey", fmt(day, "yyyy-MM-dd").alias("iso"), fmt(day, "dd/MM/yyyy").alias("day_first"),
        fmt(F.when(k % 64 == 1, F.make_date(F.year(day), F.month(day), F.lit(25))).otherwise(low), "MM-dd-yyyy")
        .alias("month_first"), fmt(low, "dd/MM/yyyy").alias("undecided"), fmt(day, "yyyyMMdd").alias("compact"),
        fmt(day, "dd.MM.yyyy").alias("dotted"), fmt(day, "dd-MMM-yyyy").alias("named"),
        fmt(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("timed"), o.o_orderpriority.alias("none"))


DATED = ["iso", "day_first", "month_first", "undecided", "compact", "dotted", "named", "timed", "none"]


@query("date_layouts")
def _date_layouts(t: DriverTables) -> DataFrame:
    return guess_layouts(orders_dated(t), DATED)


@query("cast_guessed_dates")
def _cast_guessed_dates(t: DriverTables) -> DataFrame:
    """The columns cast by the layouts that their values voted for."""
    d = orders_dated(t)
    return cast_guessed_dates(d, guessed_formats(d, DATED))


@query("cast_bigint_default0")
def _cast_bigint_default0(t: DriverTables) -> DataFrame:
    d = _orders_dirty(t).select("o_orderkey", "bi_raw", F.col("bi_raw").alias("bi"))
    return C.cast_bigint_default0(d, ["bi"])


@query("dedup_keep_first")
def _dedup_keep_first(t: DriverTables) -> DataFrame:
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return C.dedup_keep_first(o, ["o_custkey"], "o_orderkey")


@query("bridge_explode")
def _bridge_explode(t: DriverTables) -> DataFrame:
    return C.explode_list_pairs(_orders_dirty(t), "o_orderkey", "ls_raw")


@query("bridge_profile")
def _bridge_profile(t: DriverTables) -> DataFrame:
    return P.profile_list_column(_orders_dirty(t), "ls_raw")


@query("bridge_preview")
def _bridge_preview(t: DriverTables) -> DataFrame:
    return P.list_column_preview(_orders_dirty(t), "o_orderkey", "ls_raw", "o_orderkey", n=8)


@query("bridge_doctor_dim")
def _bridge_doctor_dim(t: DriverTables) -> DataFrame:
    d = _orders_dirty(t).select(F.col("o_orderkey").alias("Doctor_ID"),
                                F.col("o_orderpriority").alias("Practicing_Branch"),
                                F.col("ls_raw").alias("Other_Branches_Visited"))
    return transform(d, TableSpec(name="doctors", columns=(),
                                  drop=("Other_Branches_Visited", "Not_A_Column")))


# Declared schema of the conformance stand-in: ids, a date, VARCHAR(10) texts
# and DECIMAL(10,2) money, fed from dirty text.
VISITS_SPEC = TableSpec(
    name="visits",
    columns=(ColumnSpec("case_id", "bigint"),
             ColumnSpec("visit_date", "date"),
             ColumnSpec("priority", "string", 10),
             ColumnSpec("total_bill", "decimal(10,2)"),
             ColumnSpec("branches", "string", 10)),
)


def _visits_conformed(t: DriverTables) -> DataFrame:
    d = _orders_dirty(t).select(
        "o_orderkey",
        F.col("bi_raw").alias("case_id"),
        F.col("dt_raw").alias("visit_date"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("total_bill"),
        F.col("ls_raw").alias("branches"))
    return conform(d, VISITS_SPEC, keep=["o_orderkey"])


@query("conform_to_schema")
def _conform_to_schema(t: DriverTables) -> DataFrame:
    return good_rows(_visits_conformed(t))


@query("conform_rejects")
def _conform_rejects(t: DriverTables) -> DataFrame:
    return rejected_rows(_visits_conformed(t), keep=["o_orderkey"])


# --- oracles -------------------------------------------------------------------

_CLEAN_SEL = ", ".join(f"{c} AS {n}" for c, n in CLEAN_ORDERS.items())
ORACLES["clean_headers"] = f"SELECT {_CLEAN_SEL} FROM orders"

_RENAMED = {c: RENAME_ORDERS.get(n, n) for c, n in CLEAN_ORDERS.items()}
ORACLES["rename_columns"] = ("SELECT " + ", ".join(f"{c} AS {n}" for c, n in _RENAMED.items())
                             + " FROM orders")

_TOKENS = ", ".join("'" + x.replace("'", "''") + "'" for x in NA_TOKENS)
ORACLES["normalize_null_tokens"] = f"""
SELECT c_custkey, CASE WHEN v IN ({_TOKENS}) THEN NULL ELSE v END AS segment
FROM (SELECT c_custkey, {nt_sql('c_custkey', 'c_mktsegment')} AS v FROM customer)"""

_DIRTY_ORDERS = f"""(SELECT o_orderkey, {yn_sql('o_orderkey')} AS yn_raw,
        {dt_sql('o_orderkey', 'o_orderdate')} AS dt_raw,
        {bi_sql('o_orderkey')} AS bi_raw,
        {ls_sql('o_orderkey', 'o_orderstatus', 'o_orderpriority')} AS ls_raw,
        o_orderpriority, o_totalprice, o_orderdate FROM orders)"""

ORACLES["cast_yes_no"] = f"""
SELECT o_orderkey, yn_raw, {yes_no_sql('yn_raw')} AS yn FROM {_DIRTY_ORDERS} d"""

ORACLES["cast_dates"] = f"""
SELECT o_orderkey, dt_raw, TRY_CAST(dt_raw AS DATE) AS dt FROM {_DIRTY_ORDERS} d"""

_DAY = "CAST(o_orderdate AS DATE)"
_LOW = f"make_date(year({_DAY}), month({_DAY}), 1 + o_orderkey % 12)"
_DECIDED = f"CASE WHEN o_orderkey % 64 = 1 THEN make_date(year({_DAY}), month({_DAY}), 25) ELSE {_LOW} END"
# column: (day, format of its text, layout that wins, whether it is a guess)
_DATED_SQL = {
    "iso": (_DAY, "%Y-%m-%d", "yyyy-MM-dd", False), "day_first": (_DAY, "%d/%m/%Y", "dd/MM/yyyy", False),
    "month_first": (_DECIDED, "%m-%d-%Y", "MM-dd-yyyy", False), "undecided": (_LOW, "%d/%m/%Y", "dd/MM/yyyy", True),
    "compact": (_DAY, "%Y%m%d", "yyyyMMdd", False), "dotted": (_DAY, "%d.%m.%Y", "dd.MM.yyyy", False),
    "named": (_DAY, "%d-%b-%Y", "dd-MMM-yyyy", False), "timed": (_DAY, "%Y-%m-%d", "yyyy-MM-dd HH:mm:ss", False),
}
_JUNK = "o_orderkey % 11 = 0 OR o_orderkey % 13 = 0"

# a value is at stake where its day may be a month and is not the month itself
ORACLES["date_layouts"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{layout}' AS layout, COUNT(*) FILTER (WHERE NOT ({_JUNK})) AS parsed,
      COUNT(*) FILTER (WHERE o_orderkey % 11 = 0) AS unparsed, {str(guess).lower()} AS ambiguous,
      COUNT(*) FILTER (WHERE NOT ({_JUNK}) AND {c in ('day_first', 'month_first', 'undecided')}
        AND day({day}) <= 12 AND day({day}) <> month({day})) AS disputed FROM orders"""
    for c, (day, _, layout, guess) in _DATED_SQL.items()) + """
  UNION ALL SELECT 'none', NULL, 0, COUNT(*), false, 0 FROM orders"""

ORACLES["cast_guessed_dates"] = (
    "SELECT o_orderkey, " + ", ".join(f"CASE WHEN NOT ({_JUNK}) THEN {day} END AS {c}"
                                      for c, (day, _, _, _) in _DATED_SQL.items())
    + ", o_orderpriority AS none FROM orders")

ORACLES["cast_bigint_default0"] = f"""
SELECT o_orderkey, bi_raw, {bigint0_sql('bi_raw')} AS bi FROM {_DIRTY_ORDERS} d"""

ORACLES["dedup_keep_first"] = """
SELECT o_custkey, o_orderkey, o_orderstatus FROM
 (SELECT o_custkey, o_orderkey, o_orderstatus,
         ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
WHERE rn = 1"""

_ITEMS = f"""(SELECT o_orderkey, ls_raw, {list_items_sql('ls_raw')} AS items
   FROM {_DIRTY_ORDERS} d)"""

ORACLES["bridge_explode"] = f"""
SELECT DISTINCT o_orderkey AS doctor_id, unnest(items) AS branch_id FROM {_ITEMS} i"""

ORACLES["bridge_profile"] = f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_rows,
       CAST(COUNT(*) FILTER (WHERE items IS NULL) AS BIGINT) AS parse_errors,
       CAST(COALESCE(SUM(len(items)), 0) AS BIGINT) AS pairs,
       CAST((SELECT COUNT(DISTINCT b) FROM (SELECT unnest(items) AS b FROM {_ITEMS} j)) AS BIGINT)
         AS distinct_items
FROM {_ITEMS} i"""

ORACLES["bridge_preview"] = f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY o_orderkey, pos) AS INTEGER) AS pair_no,
       doctor_id, branch_id FROM (
  SELECT o_orderkey, o_orderkey AS doctor_id, unnest(items) AS branch_id,
         unnest(range(len(items))) AS pos FROM {_ITEMS} i)
ORDER BY o_orderkey, pos LIMIT 8"""

ORACLES["bridge_doctor_dim"] = """
SELECT o_orderkey AS Doctor_ID, o_orderpriority AS Practicing_Branch FROM orders"""

_VISITS_RAW = f"""(SELECT o_orderkey, bi_raw AS case_id, dt_raw AS visit_date,
        o_orderpriority AS priority,
        CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS total_bill,
        ls_raw AS branches FROM {_DIRTY_ORDERS} d)"""

_VISITS_CHECKED = f"""(SELECT *,
   {declared_int_sql('case_id', 'BIGINT')} AS t_case_id,
   TRY_CAST(visit_date AS DATE) AS t_visit_date,
   TRY_CAST(total_bill AS DECIMAL(10,2)) AS t_total_bill
   FROM {_VISITS_RAW} r)"""

_REASONS = """concat_ws('; ',
   CASE WHEN case_id IS NOT NULL AND t_case_id IS NULL THEN 'case_id: not a valid bigint' END,
   CASE WHEN visit_date IS NOT NULL AND t_visit_date IS NULL THEN 'visit_date: not a valid date' END,
   CASE WHEN length(priority) > 10 THEN 'priority: longer than 10' END,
   CASE WHEN total_bill IS NOT NULL AND t_total_bill IS NULL THEN 'total_bill: not a valid decimal(10,2)' END,
   CASE WHEN length(branches) > 10 THEN 'branches: longer than 10' END)"""

ORACLES["conform_to_schema"] = f"""
SELECT t_case_id AS case_id, t_visit_date AS visit_date, priority, t_total_bill AS total_bill,
       branches, o_orderkey
FROM {_VISITS_CHECKED} c WHERE {_REASONS} = ''"""

ORACLES["conform_rejects"] = f"""
SELECT o_orderkey, {_REASONS} AS reasons, case_id, visit_date, priority, total_bill, branches
FROM {_VISITS_CHECKED} c WHERE {_REASONS} <> ''"""

