"""The named analytical queries (two versions of six), as DataFrame functions.

Each takes the fact table and the names of the columns that play each role,
and returns the reference's output columns under the reference's aliases.
Version "a" is the stand-alone SQL file, version "b" the daily report; they
differ on purpose (null handling, joins, extra columns), so both exist.

Plan shape, at any scale:
* every GROUP BY is a partial + final hash aggregate, so a hot key costs
  one row per map task on the shuffle, never a whole group in one task;
* the one dimension join (substitution rate) is applied *after* a partial
  aggregate of the fact by branch, so only one row per branch meets the
  dimension, whatever the fact size and whatever the dimension size;
* top-k is ``orderBy(...).limit(k)`` -> ``TakeOrderedAndProject``;
* a grand total is a scalar subquery (computed once), not a join.
Sorts of the final (already aggregated) result follow the reference's
ORDER BY with PostgreSQL null placement and the group key as tie-breaker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import avg_money_from, pct_half_up, sum_money
from ..functions.text import col_of


def count_all() -> Column:
    """``COUNT(*)``."""
    return F.count(F.lit(1))


def _cnt_when(pred: Column) -> Column:
    """``SUM(CASE WHEN p THEN 1 ELSE 0 END)`` -> BIGINT (null on no rows)."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def _count_case(pred: Column) -> Column:
    """``COUNT(CASE WHEN p THEN 1 END)`` -> BIGINT (0 on no rows)."""
    return F.count(F.when(pred, F.lit(1)))


def month_of(c: Column | str) -> Column:
    """``TO_CHAR(d, 'YYYY-MM')``; a null date gives a null month."""
    return F.date_format(col_of(c), "yyyy-MM")


# --- Q1: visits per branch and month -----------------------------------------

def _visits(appts: DataFrame, branch: str, date: str, count_alias: str) -> DataFrame:
    return (appts
            .groupBy(F.col(branch).alias("branch_id"),
                     month_of(date).alias("month"))
            .agg(count_all().alias(count_alias)))


def monthly_visits(appts: DataFrame, branch: str = "branch_id",
                   date: str = "date_of_consultation") -> DataFrame:
    """(branch_id, visits, month) ordered by month, branch."""
    return (_visits(appts, branch, date, "visits")
            .select("branch_id", "visits", "month")
            .orderBy(F.asc_nulls_last("month"), F.asc_nulls_last("branch_id")))


def visits_by_branch(appts: DataFrame, branch: str = "branch_id",
                     date: str = "date_of_consultation") -> DataFrame:
    """(branch_id, month, visit_count) by month, then count DESC."""
    return (_visits(appts, branch, date, "visit_count")
            .select("branch_id", "month", "visit_count")
            .orderBy(F.asc_nulls_last("month"), F.desc_nulls_first("visit_count"),
                     F.asc_nulls_last("branch_id")))


# --- Q2: revenue -----------------------------------------------------------------

def revenue_coverage(billing: DataFrame, branch: str = "branch_id",
                     bill: str = "total_bill", covered: str = "amount_covered",
                     out_of_pocket: str = "out_of_pocket_expenses") -> DataFrame:
    """Claims and exact money sums per branch, by revenue DESC."""
    return (billing
            .groupBy(F.col(branch).alias("branch_id"))
            .agg(count_all().alias("total_claims"),
                 sum_money(bill).alias("total_revenue"),
                 sum_money(covered).alias("total_covered"),
                 sum_money(out_of_pocket).alias("total_out_of_pocket"))
            .orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("branch_id")))


def revenue_by_branch(billing: DataFrame, branch: str = "branch_id",
                      bill: str = "total_bill") -> DataFrame:
    """Claims, revenue and average bill per branch, by revenue DESC."""
    agg = (billing
           .groupBy(F.col(branch).alias("branch_id"))
           .agg(count_all().alias("total_claims"),
                sum_money(bill).alias("_sum"),
                F.count(bill).alias("_n")))
    return (agg.select("branch_id", "total_claims",
                       F.col("_sum").alias("total_revenue"),
                       avg_money_from("_sum", "_n").alias("avg_bill"))
            .orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("branch_id")))


# --- Q3: top diagnoses -------------------------------------------------------------

def _diagnosis_counts(appts: DataFrame, diagnosis: str) -> DataFrame:
    return (appts.groupBy(F.col(diagnosis).alias("diagnosis"))
            .agg(count_all().alias("frequency")))


def top_diagnoses(appts: DataFrame, diagnosis: str = "diagnosis",
                  k: int = 10) -> DataFrame:
    """The k most frequent diagnoses; ties broken by the diagnosis."""
    return (_diagnosis_counts(appts, diagnosis)
            .orderBy(F.desc_nulls_first("frequency"), F.asc_nulls_last("diagnosis"))
            .limit(k))


def top_diagnoses_pct(appts: DataFrame, diagnosis: str = "diagnosis",
                      k: int = 10) -> DataFrame:
    """Top k with their percent of all appointments (2 digits).

    The grand total is a scalar subquery over the same scan: run once,
    not joined."""
    total = appts.select(count_all()).scalar()
    top = top_diagnoses(appts, diagnosis, k)
    return top.select("diagnosis", "frequency",
                      pct_half_up("frequency", total, 2).alias("pct"))


# --- Q4: surgery outcomes ------------------------------------------------------------

# --- fixed values -----------------------------------------------------------
SUCCESSFUL, FAILED, COMPLICATIONS = "Successful", "Failed", "Complications"
APPROVED, PENDING, REJECTED = "Approved", "Pending", "Rejected"
# ---------------------------------------------------------------------------


def surgery_outcomes(surgeries: DataFrame, doctor: str = "doctor_id",
                     outcome: str = "surgery_outcome", k: int = 20) -> DataFrame:
    """Top k doctors by surgeries with success and failure counts."""
    o = F.col(outcome)
    return (surgeries.groupBy(F.col(doctor).alias("doctor_id"))
            .agg(count_all().alias("total_surgeries"),
                 _cnt_when(o == SUCCESSFUL).alias("successful"),
                 _cnt_when(o == FAILED).alias("failed"))
            .orderBy(F.desc_nulls_first("total_surgeries"), F.asc_nulls_last("doctor_id"))
            .limit(k))


def surgery_outcomes_rate(surgeries: DataFrame, doctor: str = "doctor_id",
                          outcome: str = "surgery_outcome", k: int = 20) -> DataFrame:
    """As Q4b plus complications and the success percent (1 digit)."""
    o = F.col(outcome)
    top = (surgeries.groupBy(F.col(doctor).alias("doctor_id"))
           .agg(count_all().alias("total_surgeries"),
                _cnt_when(o == SUCCESSFUL).alias("successful"),
                _cnt_when(o == FAILED).alias("failed"),
                _cnt_when(o == COMPLICATIONS).alias("complications"))
           .orderBy(F.desc_nulls_first("total_surgeries"), F.asc_nulls_last("doctor_id"))
           .limit(k))
    return top.withColumn("success_rate_pct",
                          pct_half_up("successful", "total_surgeries", 1))


# --- Q5: doctor substitution -----------------------------------------------------------

def _substituted(requested: str, consulted: str) -> Column:
    # SQL inequality: a null on either side is unknown, so the row counts 0.
    return F.col(requested) != F.col(consulted)


def substitution_rate(appts: DataFrame, branches: DataFrame,
                      branch: str = "branch_id", serial: str = "serial_no",
                      requested: str = "requested_doctor_id",
                      consulted: str = "consulted_doctor_id",
                      dim_branch: str = "branch_id",
                      location: str = "location") -> DataFrame:
    """Substitution percent per branch *location* (inner join).

    The fact is first reduced to one row per branch (partial aggregate),
    then joined to the dimension and re-aggregated by location, which is
    the same answer as join-then-group since both measures are additive.
    """
    per_branch = (appts
                  .groupBy(F.col(branch).alias("_b"))
                  .agg(F.count(serial).alias("_n"),
                       _cnt_when(_substituted(requested, consulted)).alias("_s")))
    dim = branches.select(F.col(dim_branch).alias("_b"),
                          F.col(location).alias("branch_name"))
    joined = per_branch.join(dim, "_b", "inner")
    out = (joined.groupBy("branch_name")
           .agg(F.sum("_n").cast("bigint").alias("total_appointments"),
                F.sum("_s").cast("bigint").alias("substituted_appointments")))
    return (out.withColumn("substitution_rate_pct",
                           pct_half_up("substituted_appointments", "total_appointments", 2))
            .orderBy(F.desc_nulls_first("substitution_rate_pct"),
                     F.asc_nulls_last("branch_name")))


def substitution_by_branch(appts: DataFrame, branch: str = "branch_id",
                           requested: str = "requested_doctor_id",
                           consulted: str = "consulted_doctor_id") -> DataFrame:
    """Appointments and substitutions per branch_id (no join)."""
    return (appts.groupBy(F.col(branch).alias("branch_id"))
            .agg(count_all().alias("total_appointments"),
                 _cnt_when(_substituted(requested, consulted)).alias("substitutions"))
            .orderBy(F.desc_nulls_first("substitutions"), F.asc_nulls_last("branch_id")))


# --- Q6: claim status -----------------------------------------------------------------

def claim_status_rate(billing: DataFrame, insurer: str = "insurance_provider",
                      status: str = "claim_status") -> DataFrame:
    """Non-null claims per insurer, three status counts and the
    approved percent (2 digits), by that percent DESC."""
    s = F.col(status)
    agg = (billing.groupBy(F.col(insurer).alias("insurance_provider"))
           .agg(F.count(s).alias("total_claims"),
                _count_case(s == APPROVED).alias("approved_claims"),
                _count_case(s == PENDING).alias("pending_claims"),
                _count_case(s == REJECTED).alias("rejected_claims")))
    return (agg.withColumn("approved_rate_pct",
                           pct_half_up("approved_claims", "total_claims", 2))
            .orderBy(F.desc_nulls_first("approved_rate_pct"),
                     F.asc_nulls_last("insurance_provider")))


def claim_status(billing: DataFrame, insurer: str = "insurance_provider",
                 status: str = "claim_status") -> DataFrame:
    """All claims per insurer and three status counts, by total DESC."""
    s = F.col(status)
    return (billing.groupBy(F.col(insurer).alias("insurance_provider"))
            .agg(count_all().alias("total_claims"),
                 _cnt_when(s == APPROVED).alias("approved"),
                 _cnt_when(s == REJECTED).alias("rejected"),
                 _cnt_when(s == PENDING).alias("pending"))
            .orderBy(F.desc_nulls_first("total_claims"),
                     F.asc_nulls_last("insurance_provider")))
