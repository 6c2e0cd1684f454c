"""Keys of SURVEY section 2.13: the twelve named analytical queries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import analytics as A
from .oracles import ORACLES, pct_sql as _pct
from .registry import query
from .sql_texts import SQL, register_views, run_query
from .standins import DriverTables


@query("monthly_visits")
def _monthly_visits(t: DriverTables) -> DataFrame:
    return A.monthly_visits(t.order_visits)


@query("visits_by_branch")
def _visits_by_branch(t: DriverTables) -> DataFrame:
    return A.visits_by_branch(t.order_visits)


@query("revenue_coverage")
def _revenue_coverage(t: DriverTables) -> DataFrame:
    return A.revenue_coverage(t.lineitem_billing)


@query("revenue_by_branch")
def _revenue_by_branch(t: DriverTables) -> DataFrame:
    return A.revenue_by_branch(t.order_billing)


@query("top_diagnoses")
def _top_diagnoses(t: DriverTables) -> DataFrame:
    return A.top_diagnoses(t.part_diagnoses)


@query("top_diagnoses_pct")
def _top_diagnoses_pct(t: DriverTables) -> DataFrame:
    return A.top_diagnoses_pct(t.part_diagnoses)


@query("surgery_outcomes")
def _surgery_outcomes(t: DriverTables) -> DataFrame:
    return A.surgery_outcomes(t.lineitem_surgeries)


@query("surgery_outcomes_rate")
def _surgery_outcomes_rate(t: DriverTables) -> DataFrame:
    return A.surgery_outcomes_rate(t.lineitem_surgeries)


@query("substitution_rate")
def _substitution_rate(t: DriverTables) -> DataFrame:
    return A.substitution_rate(t.substitution_visits, t.nation_branches)


@query("substitution_by_branch")
def _substitution_by_branch(t: DriverTables) -> DataFrame:
    return A.substitution_by_branch(t.substitution_visits)


@query("claim_status")
def _claim_status(t: DriverTables) -> DataFrame:
    return A.claim_status(t.order_billing)


@query("claim_status_rate")
def _claim_status_rate(t: DriverTables) -> DataFrame:
    return A.claim_status_rate(t.order_billing)


# --- the same queries as SQL texts (S8, S14) -----------------------------------

#: The table that each SQL text reads, by the role views that play it.
_SQL_ROLES = {
    "monthly_visits": {"appointments": "order_visits"},
    "visits_by_branch": {"appointments": "order_visits"},
    "revenue_coverage": {"billing": "lineitem_billing"},
    "revenue_by_branch": {"billing": "order_billing"},
    "top_diagnoses": {"appointments": "part_diagnoses"},
    "top_diagnoses_pct": {"appointments": "part_diagnoses"},
    "surgery_outcomes": {"surgeries": "lineitem_surgeries"},
    "surgery_outcomes_rate": {"surgeries": "lineitem_surgeries"},
    "substitution_rate": {"appointments": "substitution_visits", "branches": "nation_branches"},
    "substitution_by_branch": {"appointments": "substitution_visits"},
    "claim_status": {"billing": "order_billing"},
    "claim_status_rate": {"billing": "order_billing"},
}


def _sql_key(t: DriverTables, name: str) -> DataFrame:
    register_views({view: getattr(t, role) for view, role in _SQL_ROLES[name].items()})
    return run_query(t.spark, name)


for _name in SQL:
    query(f"sql_{_name}")(lambda t, _n=_name: _sql_key(t, _n))


# --- oracles (output names and literals of the contract are fixed values) ----------------------------------------------------------------------

_ORDER_VISITS = """(SELECT CASE WHEN o_orderkey % 41 <> 0 THEN o_orderpriority END AS branch_id,
        CASE WHEN o_orderkey % 31 <> 0 THEN CAST(o_orderdate AS DATE) END AS date_of_consultation
   FROM orders)"""

ORACLES["monthly_visits"] = f"""
SELECT branch_id, CAST(COUNT(*) AS BIGINT) AS visits,
       strftime(date_of_consultation, '%Y-%m') AS month
FROM {_ORDER_VISITS} v
GROUP BY branch_id, strftime(date_of_consultation, '%Y-%m')
ORDER BY month NULLS LAST, branch_id NULLS LAST"""

ORACLES["visits_by_branch"] = f"""
SELECT branch_id, strftime(date_of_consultation, '%Y-%m') AS month,
       CAST(COUNT(*) AS BIGINT) AS visit_count
FROM {_ORDER_VISITS} v
GROUP BY branch_id, strftime(date_of_consultation, '%Y-%m')
ORDER BY month, visit_count DESC, branch_id"""

_LINEITEM_BILLING = """(SELECT l_suppkey AS branch_id,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS total_bill,
        CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
             AS DECIMAL(12,2)) AS amount_covered
   FROM lineitem)"""

ORACLES["revenue_coverage"] = f"""
SELECT branch_id, CAST(COUNT(*) AS BIGINT) AS total_claims,
       CAST(SUM(total_bill) AS DECIMAL(38,2)) AS total_revenue,
       CAST(SUM(amount_covered) AS DECIMAL(38,2)) AS total_covered,
       CAST(SUM(total_bill - amount_covered) AS DECIMAL(38,2)) AS total_out_of_pocket
FROM {_LINEITEM_BILLING} b
GROUP BY branch_id ORDER BY total_revenue DESC, branch_id"""

_ORDER_BILLING = """(SELECT o_orderpriority AS branch_id, o_totalprice AS total_bill,
        c_mktsegment AS insurance_provider,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL
             WHEN o_orderstatus = 'F' THEN 'Approved'
             WHEN o_orderstatus = 'P' THEN 'Pending'
             WHEN o_orderstatus = 'O' THEN 'Rejected' END AS claim_status
   FROM orders JOIN customer ON o_custkey = c_custkey)"""

ORACLES["revenue_by_branch"] = f"""
WITH g AS (
  SELECT branch_id, COUNT(*) AS n_all, COUNT(total_bill) AS n,
         SUM(CAST(total_bill AS DECIMAL(12,2))) AS s
  FROM {_ORDER_BILLING} b GROUP BY branch_id)
SELECT branch_id, CAST(n_all AS BIGINT) AS total_claims,
       CAST(s AS DECIMAL(38,2)) AS total_revenue,
       CAST(CAST(sign(CAST(s * 100 AS BIGINT)) * ((2 * abs(CAST(s * 100 AS BIGINT)) + n)
            // NULLIF(2 * n, 0)) AS DECIMAL(30,0)) * 0.01 AS DECIMAL(38,2)) AS avg_bill
FROM g ORDER BY total_revenue DESC, branch_id"""

ORACLES["top_diagnoses"] = """
SELECT p_name AS diagnosis, CAST(COUNT(*) AS BIGINT) AS frequency
FROM part GROUP BY p_name ORDER BY frequency DESC, diagnosis LIMIT 10"""

ORACLES["top_diagnoses_pct"] = f"""
WITH t AS (SELECT COUNT(*) AS d FROM part)
SELECT p_name AS diagnosis, CAST(COUNT(*) AS BIGINT) AS frequency,
       {_pct('COUNT(*)', 'MAX(d)', 2)} AS pct
FROM part, t GROUP BY p_name ORDER BY frequency DESC, diagnosis LIMIT 10"""

_SURGERIES = """(SELECT l_suppkey AS doctor_id,
        CASE l_returnflag WHEN 'A' THEN 'Successful' WHEN 'R' THEN 'Failed'
                          WHEN 'N' THEN 'Complications' END AS surgery_outcome
   FROM lineitem)"""

ORACLES["surgery_outcomes"] = f"""
SELECT doctor_id, CAST(COUNT(*) AS BIGINT) AS total_surgeries,
       CAST(SUM(CASE WHEN surgery_outcome = 'Successful' THEN 1 ELSE 0 END) AS BIGINT) AS successful,
       CAST(SUM(CASE WHEN surgery_outcome = 'Failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed
FROM {_SURGERIES} s GROUP BY doctor_id
ORDER BY total_surgeries DESC, doctor_id LIMIT 20"""

ORACLES["surgery_outcomes_rate"] = f"""
WITH g AS (
  SELECT doctor_id, CAST(COUNT(*) AS BIGINT) AS total_surgeries,
       CAST(SUM(CASE WHEN surgery_outcome = 'Successful' THEN 1 ELSE 0 END) AS BIGINT) AS successful,
       CAST(SUM(CASE WHEN surgery_outcome = 'Failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       CAST(SUM(CASE WHEN surgery_outcome = 'Complications' THEN 1 ELSE 0 END) AS BIGINT) AS complications
  FROM {_SURGERIES} s GROUP BY doctor_id
  ORDER BY total_surgeries DESC, doctor_id LIMIT 20)
SELECT *, {_pct('successful', 'total_surgeries', 1)} AS success_rate_pct FROM g"""

_SUBST = """(SELECT CASE WHEN l_orderkey % 19 <> 0 THEN l_linenumber END AS serial_no,
        CASE WHEN l_orderkey % 43 = 0 THEN s_nationkey + 100
             WHEN l_orderkey % 47 <> 0 THEN s_nationkey END AS branch_id,
        CASE WHEN l_orderkey % 11 <> 0 THEN c_nationkey END AS requested_doctor_id,
        CASE WHEN l_orderkey % 13 <> 0 THEN s_nationkey END AS consulted_doctor_id
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey)"""

ORACLES["substitution_rate"] = f"""
WITH g AS (
  SELECT CASE WHEN n_nationkey % 4 = 0 THEN 'SHARED' ELSE n_name END AS branch_name,
         CAST(COUNT(a.serial_no) AS BIGINT) AS total_appointments,
         CAST(SUM(CASE WHEN a.requested_doctor_id <> a.consulted_doctor_id THEN 1 ELSE 0 END)
              AS BIGINT) AS substituted_appointments
  FROM {_SUBST} a JOIN nation ON a.branch_id = n_nationkey
  GROUP BY 1)
SELECT *, {_pct('substituted_appointments', 'total_appointments', 2)} AS substitution_rate_pct
FROM g ORDER BY substitution_rate_pct DESC, branch_name"""

ORACLES["substitution_by_branch"] = f"""
SELECT branch_id, CAST(COUNT(*) AS BIGINT) AS total_appointments,
       CAST(SUM(CASE WHEN requested_doctor_id <> consulted_doctor_id THEN 1 ELSE 0 END)
            AS BIGINT) AS substitutions
FROM {_SUBST} a GROUP BY branch_id ORDER BY substitutions DESC, branch_id"""

ORACLES["claim_status"] = f"""
SELECT insurance_provider, CAST(COUNT(*) AS BIGINT) AS total_claims,
       CAST(SUM(CASE WHEN claim_status = 'Approved' THEN 1 ELSE 0 END) AS BIGINT) AS approved,
       CAST(SUM(CASE WHEN claim_status = 'Rejected' THEN 1 ELSE 0 END) AS BIGINT) AS rejected,
       CAST(SUM(CASE WHEN claim_status = 'Pending' THEN 1 ELSE 0 END) AS BIGINT) AS pending
FROM {_ORDER_BILLING} b GROUP BY insurance_provider
ORDER BY total_claims DESC, insurance_provider"""

ORACLES["claim_status_rate"] = f"""
WITH g AS (
  SELECT insurance_provider, CAST(COUNT(claim_status) AS BIGINT) AS total_claims,
         CAST(COUNT(CASE WHEN claim_status = 'Approved' THEN 1 END) AS BIGINT) AS approved_claims,
         CAST(COUNT(CASE WHEN claim_status = 'Pending' THEN 1 END) AS BIGINT) AS pending_claims,
         CAST(COUNT(CASE WHEN claim_status = 'Rejected' THEN 1 END) AS BIGINT) AS rejected_claims
  FROM {_ORDER_BILLING} b GROUP BY insurance_provider)
SELECT *, {_pct('approved_claims', 'total_claims', 2)} AS approved_rate_pct
FROM g ORDER BY approved_rate_pct DESC, insurance_provider"""

for _name in SQL:
    ORACLES[f"sql_{_name}"] = ORACLES[_name]
