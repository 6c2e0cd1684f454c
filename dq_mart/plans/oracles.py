"""Independent DuckDB SQL for each registered query key.

Each text runs on the driver's tables registered as views and must give the
same rows (as a multiset) and the same column names as the Spark query.
Where the Spark side uses a Spark-specific method (from_json, try_to_date,
struct min), the SQL deliberately uses another one, so the check is
independent.  Numeric conventions (SURVEY section 7.4): percentages by the
exact integer formula with ``//``, money summed as DECIMAL(12,2), counts
cast to BIGINT.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def pct_sql(n: str, d: str, digits: int) -> str:
    scale = 10 ** digits
    return (f"CAST((CAST({2 * 100 * scale} AS BIGINT) * ({n}) + ({d})) // "
            f"NULLIF(2 * ({d}), 0) AS DOUBLE) / {float(scale)}")


# --- SQL twins of the dirty derivations in standins.py ------------------------

def yn_sql(k: str) -> str:
    return (f"CASE CAST({k} % 8 AS INTEGER) WHEN 0 THEN 'Yes' WHEN 1 THEN ' no ' "
            f"WHEN 2 THEN 'TRUE' WHEN 3 THEN '1' WHEN 4 THEN NULL WHEN 5 THEN 'NO' "
            f"WHEN 6 THEN chr(9) || 'yes' ELSE 'maybe' END")


def dt_sql(k: str, clean: str) -> str:
    return (f"CASE WHEN {k} % 11 = 0 THEN 'not-a-date' WHEN {k} % 13 = 0 THEN NULL "
            f"WHEN {k} % 17 = 0 THEN '2024-13-45' "
            f"ELSE CAST(CAST({clean} AS DATE) AS VARCHAR) END")


def bi_sql(k: str) -> str:
    return (f"CASE WHEN {k} % 10 = 0 THEN 'x1' WHEN {k} % 10 = 1 THEN NULL "
            f"WHEN {k} % 10 = 2 THEN CAST({k} AS VARCHAR) || '.7' "
            f"WHEN {k} % 10 = 3 THEN CAST({k} AS VARCHAR) || '.0' "
            f"WHEN {k} % 70 = 4 THEN '12d' WHEN {k} % 70 = 14 THEN '77F' "
            f"WHEN {k} % 70 = 24 THEN '1e3' WHEN {k} % 70 = 34 THEN '0x1p3' "
            f"WHEN {k} % 70 = 44 THEN '9223372036854775808' "
            f"WHEN {k} % 70 = 54 THEN '9223372036854775807.99999999999' "
            f"ELSE CAST({k} + 3000000000 AS VARCHAR) END")


def nt_sql(k: str, v: str) -> str:
    return (f"CASE CAST({k} % 6 AS INTEGER) WHEN 0 THEN 'None' WHEN 1 THEN 'NA' "
            f"WHEN 2 THEN 'none' WHEN 3 THEN '  ' WHEN 4 THEN '' ELSE {v} END")


def ls_sql(k: str, a: str, b: str) -> str:
    return (f"CASE CAST({k} % 9 AS INTEGER) WHEN 0 THEN '[]' WHEN 1 THEN NULL "
            f"WHEN 2 THEN 'oops' "
            f"WHEN 3 THEN '[' || chr(39) || {a} || chr(39) || ', ' || chr(39) || {a} || ' ' || chr(39) || ']' "
            f"WHEN 4 THEN '[' || chr(39) || {b} || chr(39) || ',]' "
            f"ELSE '[' || chr(34) || {a} || chr(34) || ', ' || chr(39) || {b} || chr(39) || ']' END")


def mm_sql(k: str, v: str) -> tuple[str, str]:
    a = f"CASE WHEN {k} % 5 = 0 THEN NULL ELSE {v} END"
    b = f"CASE WHEN {k} % 3 = 0 THEN NULL WHEN {k} % 4 = 0 THEN 'Z' ELSE {v} END"
    return a, b


# Independent forms of the casts (not the Spark method):
def strip_sql(v: str) -> str:
    return f"regexp_replace({v}, '^\\s+|\\s+$', '', 'g')"


def yes_no_sql(v: str) -> str:
    return f"COALESCE(lower({strip_sql(v)}) IN ('yes', 'true', '1'), false)"


def bigint_or_null_sql(v: str) -> str:
    """Text as BIGINT through HUGEINT (no double): fractions cut off, NULL out of
    range and for what is no number."""
    return (f"CASE WHEN regexp_full_match({v}, '\\s*[+-]?[0-9]*\\.?[0-9]*\\s*') "
            f"THEN TRY_CAST(TRY_CAST(split_part(trim({v}), '.', 1) AS HUGEINT) AS BIGINT) "
            f"ELSE TRY_CAST(trunc(TRY_CAST({v} AS DECIMAL(38,10))) AS BIGINT) END")


def bigint0_sql(v: str) -> str:
    return f"COALESCE({bigint_or_null_sql(v)}, 0)"


def declared_int_sql(v: str, type_: str) -> str:
    """Text as an integer type: any plain number, rounded; else NULL."""
    return (f"CASE WHEN regexp_full_match({v}, '\\s*[+-]?[0-9]+\\s*') THEN TRY_CAST(trim({v}) AS {type_}) "
            f"WHEN regexp_full_match({v}, '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*') "
            f"THEN TRY_CAST(round(TRY_CAST({v} AS DECIMAL(38,10))) AS {type_}) END")


def list_items_sql(v: str) -> str:
    """Items of a list-string, or NULL when it does not parse (valid for the
    LS derivation, which has no escaped quotes)."""
    return (f"CASE WHEN {v} LIKE '[%]' THEN "
            f"list_transform(regexp_extract_all({v}, '[''\"]([^''\"]*)[''\"]', 1), lambda x: {strip_sql('x')}) "
            f"END")
