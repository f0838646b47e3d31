"""Worked CDC example (customers) and gold readmission edge rows (FIXTURES D, E)."""

import datetime as dt

from pyspark.sql import functions as F

from lakeledger.operators.cdc import apply_changes
from lakeledger.operators.gold import readmissions

D = dt.date
SCHEMA = "CustomerID int, Name string, Address string, ProcessDate date, operation string"

INITIAL = [(1, "Peter", "1 Blue Rd.", D(2025, 5, 1), "INSERT"),
           (2, "Samarth", "22 Front St", D(2025, 5, 1), "INSERT")]
# Our choices where the example's values are not given: the 5/15 address,
# the delete and insert dates, Kostas's address.
CHANGES = [(1, "Peter", "5 Green Ave", D(2025, 5, 15), "UPDATE"),
           (1, "Peter", "123 Main St.", D(2025, 5, 20), "UPDATE"),
           (2, None, None, D(2025, 5, 18), "DELETE"),
           (3, "Kostas", "9 Oak Ln", D(2025, 5, 19), "INSERT")]


def _log(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _type1(spark, rows):
    out = apply_changes(_log(spark, rows), ["CustomerID"], "ProcessDate",
                        apply_as_deletes=F.col("operation") == "DELETE",
                        except_column_list=["operation"], stored_as_scd_type=1)
    return {r.CustomerID: r for r in out.collect()}


def _type2(spark, rows):
    out = apply_changes(_log(spark, rows), ["CustomerID"], "ProcessDate",
                        apply_as_deletes=F.col("operation") == "DELETE",
                        except_column_list=["operation"], stored_as_scd_type=2)
    rows = [(r.CustomerID, r.Address, r["__START_AT"], r["__END_AT"]) for r in out.collect()]
    return sorted(rows, key=lambda x: (x[0], x[2]))


def test_type1_latest_wins_and_delete_removes(spark):
    got = _type1(spark, INITIAL + CHANGES)
    assert set(got) == {1, 3}
    assert got[1].Address == "123 Main St."
    assert got[3].Name == "Kostas"


def test_type1_independent_of_arrival_order(spark):
    assert _type1(spark, list(reversed(INITIAL + CHANGES))) == _type1(spark, INITIAL + CHANGES)


def test_type2_complete_log_gives_three_versions_for_key_1(spark):
    got = _type2(spark, INITIAL + CHANGES)
    assert got == [
        (1, "1 Blue Rd.", D(2025, 5, 1), D(2025, 5, 15)),
        (1, "5 Green Ave", D(2025, 5, 15), D(2025, 5, 20)),
        (1, "123 Main St.", D(2025, 5, 20), None),
        (2, "22 Front St", D(2025, 5, 1), D(2025, 5, 18)),   # delete closes, no new row
        (3, "9 Oak Ln", D(2025, 5, 19), None),
    ]


def test_type2_change_log_alone_gives_two_versions_for_key_1(spark):
    got = _type2(spark, CHANGES)
    assert [g for g in got if g[0] == 1] == [(1, "5 Green Ave", D(2025, 5, 15), D(2025, 5, 20)),
                                             (1, "123 Main St.", D(2025, 5, 20), None)]
    assert [g for g in got if g[0] == 2] == []   # delete of an unknown key is a no-op


def test_type2_noop_update_adds_no_version(spark):
    rows = INITIAL + [(1, "Peter", "1 Blue Rd.", D(2025, 5, 3), "UPDATE")]
    got = _type2(spark, rows)
    assert [g for g in got if g[0] == 1] == [(1, "1 Blue Rd.", D(2025, 5, 1), None)]


def test_type2_current_rows_equal_type1(spark):
    t2 = {g[0]: g[1] for g in _type2(spark, INITIAL + CHANGES) if g[3] is None}
    t1 = {k: r.Address for k, r in _type1(spark, INITIAL + CHANGES).items()}
    assert t2 == t1


def test_readmission_edge_rows(spark, hot):
    rows = [("A", 1, D(2024, 1, 1)), ("A", 2, D(2024, 1, 1)),      # same day -> 0 days, flag 1
            ("A", 3, D(2024, 1, 31)),                                # gap 30 -> 1
            ("A", 4, D(2024, 3, 2)),                                 # gap 31 -> 0
            ("B", 5, D(2024, 5, 5)),                                 # first event -> NULL, 0
            ("C", 6, None), ("C", 7, D(2024, 2, 2))]                 # NULL date sorts first
    df = spark.createDataFrame(rows, "patient_id string, visit_id int, Diagnosis_Date date")
    got = {r.visit_id: (r.days_since_last, r.is_readmission_30d)
           for r in readmissions(df, "patient_id", "Diagnosis_Date", tie_break=["visit_id"]).collect()}
    assert got == {1: (None, 0), 2: (0, 1), 3: (30, 1), 4: (31, 0), 5: (None, 0),
                   6: (None, 0), 7: (None, 0)}
