"""Declared schemas of the medallion layers and schema persistence.

Field lists below are fixed values: they must equal the layouts of the
bronze / silver tables described for the reference (see FIXTURES.md).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, TS, B, L, DB, I = (T.StringType(), T.DateType(), T.TimestampType(), T.BooleanType(),
                         T.LongType(), T.DoubleType(), T.IntegerType())


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


INGEST_FIELDS = [_f("_source_file", S), _f("_source_file_mtime", TS), _f("_load_datetime", TS), _f("_batch_id", S)]

# --- fixed values: layer layouts -------------------------------------------
ENCOUNTER_BRONZE_IN = T.StructType([
    _f("Encounter_ID", S, False), _f("Patient_ID", S, False), _f("Cancer_Disease_Status", S, False),
    _f("Last_Update", D, False), _f("On_Treatment", S, False)])
ENCOUNTER_SILVER_SCD2 = T.StructType([
    _f("Encounter_ID", S), _f("Patient_ID", S), _f("Cancer_Disease_Status", S), _f("Last_Update", D),
    _f("On_Treatment", S), _f("scd_start_date", TS, False), _f("scd_end_date", TS),
    _f("is_current", B, False), _f("scd_version", L, False),
    _f("_bronze_load_datetime", TS), _f("_silver_load_datetime", TS)])
PATIENTS_BRONZE_IN = T.StructType([
    _f("patient_id", S, False), _f("name", S), _f("dob", S), _f("ssn", S), _f("gender", S), _f("cancer_patient", S)])
PATIENTS_SILVER_SCD1 = T.StructType([
    _f("patient_sk", S, False), _f("patient_id", S, False), _f("name", S), _f("dob", D), _f("ssn", S),
    _f("gender", S), _f("cancer_patient", B), _f("_created_datetime", TS), _f("_updated_datetime", TS),
    _f("_bronze_load_datetime", TS), _f("_silver_load_datetime", TS), _f("_is_deleted", B)])
PATIENTS_SILVER_SCD2 = T.StructType([
    _f("patient_id", S, False), _f("name", S), _f("dob", D), _f("ssn", S), _f("gender", S),
    _f("cancer_patient", B), _f("scd_start_date", TS, False), _f("scd_end_date", TS),
    _f("is_current", B, False), _f("scd_version", L, False),
    _f("_bronze_load_datetime", TS), _f("_silver_load_datetime", TS)])
LANDING = {
    "cancer_patient": T.StructType([_f("Patient_ID", S), _f("Name", S), _f("Age", I), _f("Gender", S),
                                    _f("Cancer_Patient", B)]),
    "cancer_disease_status": T.StructType([_f("Patient_ID", S), _f("Cancer_Disease_Status", S),
                                           _f("Last_Update", D), _f("On_Treatment", B)]),
    "observation": T.StructType([_f("Patient_ID", S), _f("Observation", S), _f("Doctor", S),
                                 _f("Observation_Date", D)]),
    "primary_cancer_condition": T.StructType([_f("Patient_ID", S), _f("Primary_Cancer_Condition", S),
                                              _f("Diagnosis_Date", D), _f("Hospital", S)]),
    "tnm_stage_group": T.StructType([_f("Patient_ID", S), _f("TNM_Stage_Group", S), _f("Tumor_Size_cm", DB),
                                     _f("Node_Involvement", B), _f("Metastasis", B)]),
}
# ---------------------------------------------------------------------------


def bronze_out(schema: T.StructType) -> T.StructType:
    """Bronze layout: the input fields made nullable, plus ingest metadata."""
    return T.StructType([_f(f.name, f.dataType) for f in schema.fields] + INGEST_FIELDS)


def read_layout(schema: T.StructType) -> T.StructType:
    """Reader schema for a landing file: booleans stay text ('Yes'/'No' are not
    CSV booleans) and are typed in silver with ``to_bool_safe``."""
    return T.StructType([_f(f.name, S if isinstance(f.dataType, T.BooleanType) else f.dataType, f.nullable)
                         for f in schema.fields])


def all_strings(schema: T.StructType) -> T.StructType:
    """String-only variant (type inference off; typed later in silver)."""
    return T.StructType([_f(f.name, S, f.nullable) for f in schema.fields])


def save_schema(spark: SparkSession, schema: T.StructType, schema_path: str) -> None:
    """Persist ``schema.json()`` as one text file, through Spark (any filesystem)."""
    (spark.createDataFrame([(schema.json(),)], "schema_json string")
          .coalesce(1).write.mode("overwrite").text(schema_path))


def load_schema(spark: SparkSession, schema_path: str) -> T.StructType | None:
    from .snapshots import path_exists
    if not path_exists(spark, schema_path):  # any other failure must not re-infer the types
        return None
    rows = spark.read.text(schema_path).limit(1).collect()
    return T.StructType.fromJson(json.loads(rows[0][0])) if rows else None


def infer_or_load_schema(spark: SparkSession, path: str, schema_path: str, fmt: str = "csv",
                         options: dict | None = None) -> T.StructType:
    """Infer once with a batch read of all rows, persist, and reuse on every later run.

    Streams refuse to start without a schema; the persisted one keeps the
    types stable across runs.
    """
    saved = load_schema(spark, schema_path)
    if saved is not None:
        return saved
    from .files import CSV_OPTIONS
    opts = dict(CSV_OPTIONS) if fmt == "csv" else {}
    opts.update(options or {})
    opts["inferSchema"] = "true"
    schema = spark.read.format(fmt).options(**opts).load(path).schema
    save_schema(spark, schema, schema_path)
    return schema


def describe_schema(spark: SparkSession, schema_path: str) -> DataFrame:
    """Rows (column_name, data_type, nullable, position) of a persisted schema."""
    js = spark.read.json(schema_path)
    return (js.select(F.posexplode("fields").alias("position", "f"))
              .select(F.col("f.name").alias("column_name"), F.col("f.type").alias("data_type"),
                      F.col("f.nullable").alias("nullable"), F.col("position").cast("int").alias("position")))
