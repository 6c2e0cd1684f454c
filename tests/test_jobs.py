"""End to end on tiny hand-written hospital CSVs: land -> profile -> ETL ->
report, with hand-computed expectations.  ``lab_reports.csv`` is absent on
purpose (a missing file is skipped)."""

from __future__ import annotations

import os

import pytest

from dq_mart.plans import jobs as J
from dq_mart.session import local_fs_path, shared_path

CSV = {
    "branches.csv": """Sl. No.,Branch ID,Location,OT_Available,Inhouse Anesthetician,No. of OTs,Inhouse Pharmacy,Inhouse Nutritionist,Inpatient Rooms,Luxury Suite Rooms,Prayer Room,Kids Play Area
1,BR01,Pune,Yes,No,2,Yes,No,20,No,Yes,No
2,BR02,Pune,yes,no,1,TRUE,1,10,maybe,NO,\tyes
3,BR01,Mumbai,No,No,3,No,No,5,No,No,No
""",
    "doctors.csv": """Sl. No.,Doctor Name,Doctor ID,Specialization,Qualification,Surgery Experience,Practicing Branch,Other Branches Visited
1,Dr A,DR1,Ortho,MBBS,5,BR01,"['BR02', 'BR01 ']"
2,Dr B,DR2,Cardio,MD,7,BR02,[]
3,Dr C,DR3,Neuro,MS,2,BR01,oops
""",
    "patients.csv": """﻿Serial No,Patient ID,Date of Registration,Date of First Consultation,Date of Latest Consultation,Overall Satisfaction Rating,Admission,Surgery Underwent,Total Number of Visits
1,PT1,2024-01-02,2024-01-05,2024-02-01,4,Yes,No,3
2,PT2,not-a-date,2024-01-06,,5,No,Yes,1
3,PT1,2024-02-02,2024-02-05,2024-03-01,3,No,No,2
""",
    "appointments.csv": """Sl. No.,Case ID,Patient ID,Branch ID,Date of Consultation,Requested Doctor ID,Consulted Doctor ID,Reason for Visit,Diagnosis,Prescribed Medication,Followup Required,Nutritionist Recommended
1,100,PT1,BR01,2024-01-05,DR1,DR2,Pain,Arthritis,Med1,Yes,No
2,101,PT2,BR02,2024-01-20,DR2,DR2,Check,Flu,Med2,No,No
3,102,PT9,BR01,2024-02-03,DR1,DR3,Pain,Arthritis,Med1,No,Yes
""",
    "billing.csv": """Sl. No.,Claim ID,Patient ID,Case ID,Branch ID,Total Bill,Insurance Provider,Amount Covered,Out of Pocket Expenses,Claim Status
1,9000000001,PT1,100,BR01,100.50,Acme,80.00,20.50,Approved
2,x,PT2,101.7,BR02,200.25,None,0,200.25,
3,9000000003,PT1,102,BR01,50.00,Acme,25.00,25.00,Rejected
""",
    "surgeries.csv": """Sl. No.,Case ID,Patient ID,Doctor ID,Branch ID,Surgery Type,Surgery Date,Anesthesia Type,Surgery Outcome,Surgery Duration (hours),Recovery Period (days)
1,100,PT1,DR1,BR01,Knee,2024-01-06,General,Successful,2,10
2,102,PT1,DR1,BR01,Hip,2024-02-04,None,Failed,3,20
3,101,PT2,DR2,BR02,Heart,2024-01-21,Local,Complications,5,30
""",
    "prescriptions.csv": """Sl. No.,Bill ID,Patient ID,Doctor ID,Medication Name,Dosage,Quantity,Pharmacy Availability,Issued Date
1,500,PT1,DR1,Med1,10mg,2,Yes,2024-01-05
2,501,PT2,DR2,Med2,5mg,1,No,2024-01-20
""",
}


@pytest.fixture(scope="module")
def lake(spark):
    base = shared_path(spark, "tests", "hospital")
    csv_dir = local_fs_path(f"{base}/csv")
    os.makedirs(csv_dir, exist_ok=True)
    for name, text in CSV.items():
        with open(os.path.join(csv_dir, name), "w", encoding="utf-8") as f:
            f.write(text)
    landed = {r.table_name: r for r in J.land_job(spark, csv_dir, f"{base}/lake").collect()}
    raw = J.read_landed(spark, f"{base}/lake")
    return {"base": base, "landed": landed, "raw": raw}


def test_landing_skips_missing_file(spark, lake):
    landed = lake["landed"]
    assert sorted(n for n, r in landed.items() if r.status == "ok" and n != "TOTAL") == sorted(
        n for n in J.HOSPITAL_FILES if n != "lab_reports")
    assert landed["lab_reports"].status == "missing" and landed["lab_reports"].size_bytes == 0
    assert lake["raw"]["branches"].count() == 3
    # sizes against the file system
    import glob
    import os

    from dq_mart.sources.sinks import table_path
    folder = local_fs_path(table_path(spark, f"{lake['base']}/lake/raw", "branches"))
    sizes = [os.path.getsize(f) for f in glob.glob(f"{folder}/*.parquet")]
    assert landed["branches"].size_bytes == sum(sizes) and landed["branches"].files == len(sizes)
    total = [r for n, r in landed.items() if n != "TOTAL"]
    assert landed["TOTAL"].size_bytes == sum(r.size_bytes for r in total)


def test_landing_nothing_fails(spark, lake):
    with pytest.raises(FileNotFoundError):
        J.land_job(spark, f"{lake['base']}/no-such-folder", f"{lake['base']}/empty-lake")


def test_profile_job(spark, lake):
    rep = J.profile_job(spark, lake["raw"])
    rows = rep.collect()
    total = [r.value for r in rows if r.check_name == "row_counts" and r.table_name == "TOTAL"]
    assert total == ["20"]
    fk = {(r.item, r.metric): r.value for r in rows if r.check_name == "foreign_keys"}
    assert fk[("appointments.Patient ID -> patients.Patient ID", "orphans")] == "1"
    assert fk[("appointments.Patient ID -> patients.Patient ID", "examples")] == "PT9"
    mm = {r.metric: r.value for r in rows if r.check_name == "requested_vs_consulted"}
    assert mm["mismatches"] == "2" and mm["pct"] == "66.700000"
    cat = {(r.column_name, r.item, r.metric): r.value for r in rows
           if r.check_name == "categorical"}
    # "None" is a reader null token: not listed among the values
    assert ("Anesthesia Type", "None", "cnt") not in cat
    assert cat[("Anesthesia Type", "General", "cnt")] == "1"
    bad = {(r.table_name, r.column_name): r.value for r in rows
           if r.check_name == "dates" and r.metric == "bad_count"}
    assert bad[("patients", "Date of Registration")] == "1"
    assert bad[("patients", "Date of Latest Consultation")] == "1"


@pytest.fixture(scope="module")
def mart(spark, lake):
    root = f"{lake['base']}/mart"
    audit = {r.table_name: r for r in J.etl_job(spark, lake["raw"], root).collect()}
    return root, audit


def test_etl_and_report(spark, lake, mart):
    base = lake["base"]
    _, audit = mart
    assert all(r.ok for r in audit.values())
    assert audit["branches"].rows_written == 2 and audit["doctor_branch_visits"].rows_written == 2
    assert "lab_reports" not in audit
    mart = f"{base}/mart"
    br = {r.branch_id: r for r in J.read_loaded(spark, mart, "branches").collect()}
    assert br["BR01"].location == "Pune" and br["BR02"].kids_play_area is True
    assert br["BR02"].luxury_suite_rooms is False and br["BR02"].inhouse_nutritionist is True
    bill = {r.serial_no: r for r in J.read_loaded(spark, mart, "billing").collect()}
    assert bill[2].claim_id == 0 and bill[2].case_id == 101 and bill[2].insurance_provider is None
    pats = {r.patient_id: r for r in J.read_loaded(spark, mart, "patients").collect()}
    assert pats["PT1"].serial_no == 1 and pats["PT2"].date_of_registration is None
    bridge = sorted(tuple(r) for r in J.read_loaded(spark, mart, "doctor_branch_visits").collect())
    assert bridge == [("DR1", "BR01"), ("DR1", "BR02")]

    import datetime as dt
    path = J.report_job(spark, mart, base, dt.date(2026, 1, 2))
    assert path.endswith("daily_report_2026-01-02")
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines[:5] == ["", "### VISITS_BY_BRANCH ###", "branch_id,month,visit_count",
                         "BR01,2024-01,1", "BR02,2024-01,1"]
    i = lines.index("### REVENUE_BY_BRANCH ###")
    assert lines[i + 1:i + 4] == ["branch_id,total_claims,total_revenue,avg_bill",
                                  "BR02,1,200.25,200.25", "BR01,2,150.5,75.25"]
    i = lines.index("### CLAIM_STATUS ###")
    assert lines[i + 2:i + 4] == ["Acme,2,1,1,0", ",1,0,0,0"]
    i = lines.index("### DOCTOR_SUBSTITUTION ###")
    assert lines[i + 2:i + 4] == ["BR01,2,2", "BR02,1,0"]


def test_sql_texts_match_dataframe_forms(spark, mart):
    from dq_mart.operators import analytics as A
    from dq_mart.plans.sql_texts import SQL, register_views, run_query
    root, _ = mart
    t = {n: J.read_loaded(spark, root, n)
         for n in ("appointments", "billing", "surgeries", "branches")}
    register_views(t)
    forms = {
        "monthly_visits": A.monthly_visits(t["appointments"]),
        "visits_by_branch": A.visits_by_branch(t["appointments"]),
        "revenue_coverage": A.revenue_coverage(t["billing"]),
        "revenue_by_branch": A.revenue_by_branch(t["billing"]),
        "top_diagnoses": A.top_diagnoses(t["appointments"]),
        "top_diagnoses_pct": A.top_diagnoses_pct(t["appointments"]),
        "surgery_outcomes": A.surgery_outcomes(t["surgeries"]),
        "surgery_outcomes_rate": A.surgery_outcomes_rate(t["surgeries"]),
        "substitution_rate": A.substitution_rate(t["appointments"], t["branches"]),
        "substitution_by_branch": A.substitution_by_branch(t["appointments"]),
        "claim_status": A.claim_status(t["billing"]),
        "claim_status_rate": A.claim_status_rate(t["billing"]),
    }
    assert set(forms) == set(SQL)
    for name, df in forms.items():
        got = run_query(spark, name)
        assert got.columns == df.columns, name
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in df.collect()], name


def test_cli_runs_all_jobs(spark, lake, capsys):
    import json

    from dq_mart.__main__ import main
    base = lake["base"]
    csv_dir = local_fs_path(f"{base}/csv")
    out = f"{base}/cli"
    assert main(["land", "--csv", csv_dir, "--lake", f"{out}/lake"]) == 0
    assert main(["profile", "--lake", f"{out}/lake", "--out", f"{out}/profile"]) == 0
    assert main(["etl", "--lake", f"{out}/lake", "--mart", f"{out}/mart"]) == 0
    assert main(["report", "--mart", f"{out}/mart", "--out", out,
                 "--run-date", "2026-01-02"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert lines[0]["job"] == "land" and lines[0]["branches"][:2] == ["ok", lines[0]["branches"][1]]
    assert lines[2]["branches"] == [2, 0, True]
    assert spark.read.parquet(f"{out}/profile").count() > 50
    assert spark.read.text(f"{out}/reports/daily_report_2026-01-02").count() > 10


def test_version_a_queries_on_hospital_mart(spark, mart):
    from decimal import Decimal as D

    from dq_mart.operators import analytics as A
    root, _ = mart
    appt = J.read_loaded(spark, root, "appointments")
    bill = J.read_loaded(spark, root, "billing")
    surg = J.read_loaded(spark, root, "surgeries")
    branches = J.read_loaded(spark, root, "branches")
    assert [tuple(r) for r in A.monthly_visits(appt).collect()] == [
        ("BR01", 1, "2024-01"), ("BR02", 1, "2024-01"), ("BR01", 1, "2024-02")]
    assert [tuple(r) for r in A.top_diagnoses_pct(appt).collect()] == [
        ("Arthritis", 2, 66.67), ("Flu", 1, 33.33)]
    assert [tuple(r) for r in A.revenue_coverage(bill).collect()] == [
        ("BR02", 1, D("200.25"), D("0.00"), D("200.25")),
        ("BR01", 2, D("150.50"), D("105.00"), D("45.50"))]
    assert [tuple(r) for r in A.surgery_outcomes_rate(surg).collect()] == [
        ("DR1", 2, 1, 1, 0, 50.0), ("DR2", 1, 0, 0, 1, 0.0)]
    # both branches are in Pune: merged by location
    assert [tuple(r) for r in A.substitution_rate(appt, branches).collect()] == [
        ("Pune", 3, 2, 66.67)]
    # the insurer "None" is a reader null token: its claim status is empty
    assert [tuple(r) for r in A.claim_status_rate(bill).collect()] == [
        (None, 0, 0, 0, 0, None), ("Acme", 2, 1, 0, 1, 50.0)]


def test_report_sections_equal_the_single_queries(spark, mart):
    from dq_mart.operators import analytics as A
    root, _ = mart
    t = {n: J.read_loaded(spark, root, n) for n in ("appointments", "billing", "surgeries")}
    single = {"visits_by_branch": A.visits_by_branch(t["appointments"]),
              "revenue_by_branch": A.revenue_by_branch(t["billing"]),
              "top_diagnoses": A.top_diagnoses(t["appointments"]),
              "surgery_outcomes": A.surgery_outcomes(t["surgeries"]),
              "claim_status": A.claim_status(t["billing"]),
              "doctor_substitution": A.substitution_by_branch(t["appointments"])}
    sections = J.report_sections(t)
    assert [s.name for s in sections] == list(single)
    for s in sections:
        assert s.df.columns == single[s.name].columns
        assert sorted(map(str, s.df.collect())) == sorted(map(str, single[s.name].collect())), s.name


def test_audit_tells_loaded_from_rejected(spark, lake, mart):
    _, audit = mart
    for r in audit.values():
        assert r.rows_loaded + r.rows_rejected == r.rows_written
    assert audit["billing"].zero_ids is not None and audit["branches"].zero_ids is None
    assert audit["doctors"].list_errors is not None


def test_profile_job_lists_bad_values_and_pairs(spark, lake):
    rows = J.profile_job(spark, lake["raw"]).collect()
    checks = {r.check_name for r in rows}
    assert {"dates_bad_values", "list_column_preview"} <= checks
    bad = [r.value for r in rows if r.check_name == "dates_bad_values"]
    assert bad


def test_changed_files_and_guessed_dates_end_to_end(spark, lake, capsys):
    """Landing by manifest, then a load whose dates are in another layout."""
    import json
    import shutil

    from dq_mart.__main__ import main
    base = lake["base"]
    csv_dir = local_fs_path(f"{base}/csv2")
    shutil.copytree(local_fs_path(f"{base}/csv"), csv_dir)
    path = os.path.join(csv_dir, "appointments.csv")
    text = open(path, encoding="utf-8").read()
    for iso, shown in (("2024-01-05", "05/01/2024"), ("2024-01-20", "20/01/2024"), ("2024-02-03", "03/02/2024")):
        text = text.replace(iso, shown)
    open(path, "w", encoding="utf-8").write(text)
    out = f"{base}/changed"
    assert main(["land", "--csv", csv_dir, "--lake", f"{out}/lake", "--changed"]) == 0
    assert main(["land", "--csv", csv_dir, "--lake", f"{out}/lake", "--changed"]) == 0
    assert main(["etl", "--lake", f"{out}/lake", "--mart", f"{out}/mart", "--guess-dates"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert lines[0] == {"job": "land", "new": 7} and lines[1] == {"job": "land", "unchanged": 7}
    got = {r.serial_no: str(r.date_of_consultation)
           for r in J.read_loaded(spark, f"{out}/mart", "appointments").collect()}
    assert got == {1: "2024-01-05", 2: "2024-01-20", 3: "2024-02-03"}
    pats = {r.patient_id: r for r in J.read_loaded(spark, f"{out}/mart", "patients").collect()}
    assert pats["PT1"].serial_no == 1 and pats["PT2"].date_of_registration is None
