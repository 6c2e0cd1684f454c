"""Keys of the report (R1): ``report_sections``, the daily report as the report job makes it,
as ordered text lines; ``report_file`` is the file it writes, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.catalog import union_all
from . import monthly as M
from .jobs import report_sections
from .oracles import ORACLES
from .registry import query
from .report import report_lines, write_report
from .standins import APPOINTMENTS_SQL, DriverTables


def _lines(t: DriverTables) -> DataFrame:
    return report_lines(report_sections({
        "appointments": t.lineitem_appointments, "billing": t.order_billing,
        "surgeries": t.lineitem_surgeries}))


@query("report_sections")
def _report_sections(t: DriverTables) -> DataFrame:
    return _lines(t)


@query("report_file")
def _report_file(t: DriverTables) -> DataFrame:
    """The written file's lines with their numbers: its one part file is read
    in one piece, so the order of its lines is known."""
    path = scratch_path(t.spark, "report")
    write_report(_lines(t), path)
    text = t.spark.read.text(path, wholetext=True)
    return text.select(F.posexplode(F.split(F.regexp_replace("value", r"\n$", ""), "\n"))
                       .alias("line_no", "line"))


# --- oracle ----------------------------------------------------------------------


def _num(c: str) -> str:
    return (f"regexp_replace(regexp_replace(CAST(CAST({c} AS DECIMAL(38,2)) AS VARCHAR), "
            f"'0$', ''), '\\.$', '.0')")


def _txt(c: str) -> str:
    v = f"CAST({c} AS VARCHAR)"
    return (f"COALESCE(CASE WHEN {v} LIKE '%,%' OR {v} LIKE '%\"%' "
            f"THEN '\"' || replace({v}, '\"', '\"\"') || '\"' ELSE {v} END, '')")


def _sections_over(appointments: str) -> dict[str, str]:
    return {
        "visits": f"""SELECT branch_id, strftime(date_of_consultation, '%Y-%m') AS month,
            COUNT(*) AS visit_count FROM {appointments} a GROUP BY ALL""",
        "diagnoses": f"""SELECT diagnosis, COUNT(*) AS frequency FROM {appointments} a
            GROUP BY ALL ORDER BY frequency DESC, diagnosis NULLS LAST LIMIT 10""",
        "substitution": f"""SELECT branch_id, COUNT(*) AS total_appointments,
            COUNT(*) FILTER (WHERE requested_doctor_id <> consulted_doctor_id) AS substitutions
            FROM {appointments} a GROUP BY ALL""",
    }


_OVER = _sections_over(APPOINTMENTS_SQL)

# (section, its SQL, [(column, is_float)], ORDER BY)
_SECTIONS = [
    ("visits_by_branch", _OVER["visits"],
     [("branch_id", False), ("month", False), ("visit_count", False)],
     "month NULLS LAST, visit_count DESC, branch_id NULLS LAST"),
    ("revenue_by_branch", ORACLES["revenue_by_branch"],
     [("branch_id", False), ("total_claims", False), ("total_revenue", True), ("avg_bill", True)],
     "total_revenue DESC, branch_id"),
    ("top_diagnoses", _OVER["diagnoses"], [("diagnosis", False), ("frequency", False)],
     "frequency DESC, diagnosis"),
    ("surgery_outcomes", ORACLES["surgery_outcomes"],
     [("doctor_id", False), ("total_surgeries", False), ("successful", False), ("failed", False)],
     "total_surgeries DESC, doctor_id"),
    ("claim_status", ORACLES["claim_status"],
     [("insurance_provider", False), ("total_claims", False), ("approved", False),
      ("rejected", False), ("pending", False)],
     "total_claims DESC, insurance_provider"),
    ("doctor_substitution", _OVER["substitution"],
     [("branch_id", False), ("total_appointments", False), ("substitutions", False)],
     "substitutions DESC, branch_id NULLS LAST"),
]


def _section_sql(i: int, name: str, key: str, cols, order: str) -> str:
    line = " || ',' || ".join(_num(c) if f else _txt(c) for c, f in cols)
    header = ",".join(c for c, _ in cols)
    return f"""
SELECT {i} AS section_ord, '{name}' AS section, 0 AS line_ord, '' AS line UNION ALL
SELECT {i}, '{name}', 1, '### {name.upper()} ###' UNION ALL
SELECT {i}, '{name}', 2, '{header}' UNION ALL
SELECT {i}, '{name}', CAST(ROW_NUMBER() OVER (ORDER BY {order}) + 2 AS INTEGER), {line}
FROM ({key}) s{i}"""


def _report_sql() -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({_section_sql(i, *s)}) r{i}"
                              for i, s in enumerate(_SECTIONS))


ORACLES["report_sections"] = _report_sql()
ORACLES["report_file"] = f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY section_ord, line_ord) - 1 AS INTEGER) AS line_no, line
FROM ({_report_sql()}) r"""


@query("report_monthly")
def _report_monthly(t: DriverTables) -> DataFrame:
    """The sections of dated facts from monthly partials.  The facts are first
    stored with a part of the last year's rows missing; then the last year's
    months come again, whole, and only they are computed again."""
    root = scratch_path(t.spark, "monthly")
    appointments, surgeries = M.appointments_fact(), M.surgeries_fact()
    li = t.lineitem
    operated = li.select(
        F.col("l_suppkey").alias("doctor_id"),
        F.when(li.l_returnflag == "A", "Successful").when(li.l_returnflag == "R", "Failed")
        .when(li.l_returnflag == "N", "Complications").alias("surgery_outcome"),
        F.when(li.l_orderkey % 37 != 0, F.col("l_shipdate").cast("date")).alias("surgery_date"))
    again = {}
    for fact, rows in ((appointments, t.lineitem_appointments), (surgeries, operated)):
        last = rows.select(F.max(F.year(fact.date))).scalar()
        late = F.coalesce(F.year(fact.date) == last, F.lit(False))
        odd = F.coalesce(F.col(fact.groups[0]) % 2 == 1, F.lit(False))
        M.replace_months(rows.where(~(late & odd)), root, fact)
        M.refresh(t.spark, root, fact)
        M.replace_months(rows.where(late), root, fact)
        again[fact.name] = len(M.refresh(t.spark, root, fact))
    a, s = M.partials(t.spark, root, appointments), M.partials(t.spark, root, surgeries)

    def lines(name: str, df: DataFrame, keys: list[str], numbers: list[str]) -> DataFrame:
        k = [F.col(c).cast("string") for c in keys] + [F.lit(None).cast("string")] * (2 - len(keys))
        n = [F.col(c).cast("bigint") for c in numbers] + [F.lit(None).cast("bigint")] * (3 - len(numbers))
        return df.select(F.lit(name).alias("section"), k[0].alias("key_1"), k[1].alias("key_2"),
                         *[c.alias(f"number_{i}") for i, c in enumerate(n, 1)])
    # one line for each fact
    counted = t.spark.createDataFrame(sorted(again.items()), "fact string, months int")
    return union_all([
        lines("visits_by_branch", M.visits_by_branch(a), ["branch_id", "month"], ["visit_count"]),
        lines("top_diagnoses", M.top_diagnoses(a), ["diagnosis"], ["frequency"]),
        lines("doctor_substitution", M.substitutions(a), ["branch_id"], ["total_appointments", "substitutions"]),
        lines("surgery_outcomes", M.surgery_outcomes(s), ["doctor_id"], ["total_surgeries", "successful", "failed"]),
        lines("months computed again", counted, ["fact"], ["months"])])


_SURGERIES_SQL = """(SELECT l_suppkey AS doctor_id, l_returnflag AS flag,
   CASE WHEN l_orderkey % 37 <> 0 THEN CAST(l_shipdate AS DATE) END AS surgery_date FROM lineitem)"""

ORACLES["report_monthly"] = f"""
SELECT 'visits_by_branch' AS section, CAST(branch_id AS VARCHAR) AS key_1, strftime(date_of_consultation, '%Y-%m') AS key_2,
       CAST(COUNT(*) AS BIGINT) AS number_1, CAST(NULL AS BIGINT) AS number_2, CAST(NULL AS BIGINT) AS number_3
FROM {APPOINTMENTS_SQL} a GROUP BY ALL
UNION ALL (SELECT 'top_diagnoses', diagnosis, NULL, COUNT(*), NULL, NULL FROM {APPOINTMENTS_SQL} a
           GROUP BY diagnosis ORDER BY COUNT(*) DESC, diagnosis NULLS LAST LIMIT 10)
UNION ALL SELECT 'doctor_substitution', CAST(branch_id AS VARCHAR), NULL, COUNT(*),
       COUNT(*) FILTER (WHERE requested_doctor_id <> consulted_doctor_id), NULL FROM {APPOINTMENTS_SQL} a GROUP BY branch_id
UNION ALL (SELECT 'surgery_outcomes', CAST(doctor_id AS VARCHAR), NULL, COUNT(*), COUNT(*) FILTER (WHERE flag = 'A'),
           COUNT(*) FILTER (WHERE flag = 'R') FROM {_SURGERIES_SQL} s GROUP BY doctor_id
           ORDER BY COUNT(*) DESC, doctor_id NULLS LAST LIMIT 20)
UNION ALL SELECT 'months computed again', 'appointments', NULL, COUNT(DISTINCT month(date_of_consultation)), NULL, NULL
  FROM {APPOINTMENTS_SQL} a WHERE year(date_of_consultation) = (SELECT MAX(year(date_of_consultation)) FROM {APPOINTMENTS_SQL} b)
UNION ALL SELECT 'months computed again', 'surgeries', NULL, COUNT(DISTINCT month(surgery_date)), NULL, NULL
  FROM {_SURGERIES_SQL} s WHERE year(surgery_date) = (SELECT MAX(year(surgery_date)) FROM {_SURGERIES_SQL} r)"""
