"""Five-entity medallion run (our own 10-row fixtures per FIXTURES.md §A), two waves."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.operators.gold import readmissions
from lakeledger.plans.medallion import oncology_entities, oncology_gold, production_entities, run_medallion
from lakeledger.session import scratch_path

IDS = [f"P{i:03d}" for i in range(1, 11)]
STATUSES = ["Active", "Remission", "Progressive", "Stable"]


def _csv(header, rows, trailing_blank=False):
    body = "\n".join([header] + [",".join(r) for r in rows]) + "\n"
    return body + ("\n\n" if trailing_blank else "")


def _land(root, entity, name, text):
    d = os.path.join(root.replace("file:", "", 1), "landing", entity)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def _wave1(root):
    _land(root, "cancer_patient", "w1.csv", _csv(
        "Patient_ID,Name,Age,Gender,Cancer_Patient",
        [(p, f"Name {p}", str(40 + i), "Female" if i % 2 else "male", "Yes") for i, p in enumerate(IDS)],
        trailing_blank=True))
    _land(root, "cancer_disease_status", "w1.csv", _csv(
        "Patient_ID,Cancer_Disease_Status,Last_Update,On_Treatment",
        [(p, STATUSES[i % 4], f"2024-01-{i + 1:02d}", "Yes" if i % 2 else "No") for i, p in enumerate(IDS)]))
    _land(root, "observation", "w1.csv", _csv(
        "Patient_ID,Observation,Doctor,Observation_Date",
        [(p, f"\"Note, {p}\"", "Dr A" if i % 2 else "Dr B", f"2024-02-{i + 1:02d}") for i, p in enumerate(IDS)]
        + [("", "no patient", "Dr A", "2024-02-03"),            # null key -> quarantine
           ("P001", "bad date", "Dr C", "2024-13-45")]))         # unparseable date -> quarantine
    _land(root, "primary_cancer_condition", "w1.csv", _csv(
        "Patient_ID,Primary_Cancer_Condition,Diagnosis_Date,Hospital",
        [(p, "Breast" if i % 2 else "Lung", f"2024-03-{i + 1:02d}", "North") for i, p in enumerate(IDS)]))
    _land(root, "tnm_stage_group", "w1.csv", _csv(
        "Patient_ID,TNM_Stage_Group,Tumor_Size_cm,Node_Involvement,Metastasis",
        [(p, "t1n0m0", "big" if p == "P010" else f"{1.2 + i / 2:.1f}", "No", "Yes" if i > 7 else "No")
         for i, p in enumerate(IDS)]))


def _wave2(root):
    _land(root, "cancer_patient", "w2.csv", _csv(
        "Patient_ID,Name,Age,Gender,Cancer_Patient", [("P001", "Renamed", "41", "Female", "Yes"),
                                                     ("P011", "New", "30", "Male", "No")]))
    _land(root, "cancer_disease_status", "w2.csv", _csv(
        "Patient_ID,Cancer_Disease_Status,Last_Update,On_Treatment",
        [("P001", "Remission", "2024-02-01", "No"),     # changed -> new version
         ("P002", "Remission", "2024-02-01", "Yes")]))  # same values -> no new version
    _land(root, "primary_cancer_condition", "w2.csv", _csv(
        "Patient_ID,Primary_Cancer_Condition,Diagnosis_Date,Hospital",
        [("P003", "Lung", "2024-03-23", "South")]))     # 20 days after its first diagnosis


@pytest.mark.parametrize("buckets", [None, 4])
def test_five_entities_two_waves(spark, buckets):
    root = scratch_path(spark, "oncology")
    now = lambda b: "2024-06-01 00:00:00"
    _wave1(root)
    s1 = run_medallion(spark, oncology_entities(buckets=buckets), f"{root}/landing", f"{root}/lake", now)
    assert s1["cancer_patient"].count() == 10                       # blank trailing lines ignored
    assert dict(s1["cancer_patient"].dtypes)["Cancer_Patient"] == "boolean"
    assert {r.Gender for r in s1["cancer_patient"].collect()} == {"FEMALE", "MALE"}
    assert s1["cancer_disease_status"].count() == 10
    assert s1["observation"].filter(F.col("Observation") == "Note, P001").count() == 1
    assert s1["tnm_stage_group"].count() == 9                        # 'big' quarantined
    q = spark.read.parquet(f"{root}/lake/quarantine/tnm_stage_group")
    assert [r.Patient_ID for r in q.collect()] == ["P010"]
    qo = {r.Observation: list(r._reject_reasons) for r in
          spark.read.parquet(f"{root}/lake/quarantine/observation").collect()}
    assert qo == {"no patient": ["Patient_ID_not_null"],                     # date is part of the key
                  "bad date": ["Observation_Date_not_null", "cast_ok"]}
    assert s1["observation"].count() == 10

    _wave2(root)
    s2 = run_medallion(spark, oncology_entities(buckets=buckets), f"{root}/landing", f"{root}/lake", now)
    pats = {r.Patient_ID: r for r in s2["cancer_patient"].collect()}
    assert len(pats) == 11 and pats["P001"].Name == "Renamed"
    hist = s2["cancer_disease_status"]
    versions = {r.Patient_ID: r.n for r in hist.groupBy("Patient_ID").agg(F.count("*").alias("n")).collect()}
    assert versions["P001"] == 2 and versions["P002"] == 1
    cur = {r.Patient_ID: r.Cancer_Disease_Status for r in hist.filter("is_current").collect()}
    assert cur["P001"] == "Remission" and len(cur) == 10
    cond = s2["primary_cancer_condition"]
    gold = readmissions(cond, "Patient_ID", "Diagnosis_Date", tie_break=["Hospital"])
    flagged = {r.Patient_ID for r in gold.filter(F.col("is_readmission_30d") == 1).collect()}
    assert flagged == {"P003"}
    assert isinstance(cond.schema["Diagnosis_Date"].dataType, T.DateType)

    gold = oncology_gold(s2)
    assert {r.Patient_ID for r in gold["readmission_30d"].filter("is_readmission_30d = 1").collect()} == {"P003"}
    tr = {(r.from_status, r.to_status): r.n_transitions for r in gold["status_transitions"].collect()}
    assert tr == {("Active", "Remission"): 1}
    total = gold["cohort"].filter(F.col("grouping_level") == 3).first()
    assert total.n_patients == 9                                     # P010's stage row was quarantined
    p360 = {r.Patient_ID: r for r in gold["patient_360"].collect()}
    assert len(p360) == 11 and p360["P003"].Diagnosis_Date.isoformat() == "2024-03-23"
    assert p360["P001"].n_observations == 1 and p360["P011"].Cancer_Disease_Status is None
    rates = {r.TNM_Stage_Group: r.remission_rate for r in gold["outcome_rates"].collect()}
    assert set(rates) == {"T1N0M0"}


def test_an_entity_without_data_does_not_end_the_run(spark):
    """One landing folder is missing, one is empty, one extract has no rows and one has no mark."""
    root = scratch_path(spark, "no_data")
    now = lambda b: f"2024-06-0{b + 1} 00:00:00"
    entities = {e.name: e for e in oncology_entities(buckets=4)}
    spark.createDataFrame([("P1", "Ann", "5", "f", "Yes")], entities["cancer_patient"].schema) \
        .write.option("header", True).csv(f"{root}/landing/cancer_patient")
    os.makedirs(f"{root}/landing/observation".replace("file:", "", 1))
    got = run_medallion(spark, list(entities.values()), f"{root}/landing", f"{root}/lake", now)
    assert {n: df.count() for n, df in got.items()} == {"cancer_patient": 1, **{n: 0 for n in entities if n != "cancer_patient"}}
    gold = oncology_gold(got)
    assert [(r.Patient_ID, r.n_observations) for r in gold["patient_360"].collect()] == [("P1", None)]

    for kind in ("patients_scd1", "patients_scd2"):
        e = production_entities()[kind]
        extract = spark.createDataFrame([(f"{i}", "n", "1980-01-01", "s", "f", "Yes") for i in range(3)], e.schema)
        here = f"{root}/landing/{kind}"
        assert run_medallion(spark, [e], f"{root}/landing", f"{root}/lake", now)[kind].count() == 0
        extract.write.option("header", True).csv(f"{here}/extract=0")
        extract.filter("patient_id <> '1'").write.option("header", True).csv(f"{here}/extract=1")
        extract.write.option("header", True).option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").csv(f"{here}/extract=2")  # not complete
        live = "not _is_deleted" if kind == "patients_scd1" else "is_current"
        both = run_medallion(spark, [e], f"{root}/landing", f"{root}/lake", now)[kind]  # the two that wait stay two
        assert sorted(r.patient_id for r in both.filter(live).collect()) == ["0", "2"] and both.count() == 3
        extract.limit(0).write.option("header", True).csv(f"{here}/extract=3")  # complete, and empty
        gone = run_medallion(spark, [e], f"{root}/landing", f"{root}/lake", now)[kind]
        assert gone.filter(live).count() == 0 and gone.count() == 3
        again = run_medallion(spark, [e], f"{root}/landing", f"{root}/lake", now)[kind]
        assert sorted(map(str, again.collect())) == sorted(map(str, gone.collect()))
