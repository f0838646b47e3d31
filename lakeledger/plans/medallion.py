"""Bronze -> silver -> gold for a set of entities, as ordinary streaming queries.

Per entity, in order (bronze, then silver, as a job with two tasks per
entity would run them):

1. **bronze**: landing directory -> file stream with a declared (string)
   schema and rescue column -> ingest metadata -> checkpointed Parquet append.
2. **silver**: bronze directory as a stream -> ``foreachBatch``: type the
   raw strings, quarantine rows with a null key, a failed cast or rescued data
   (kept with their reasons under ``quarantine/<entity>/_batch=<version>``), then
   merge the valid rows into a new snapshot version (upsert / SCD1 / SCD2 / type-1 CDC).

Each stream uses ``availableNow`` and is awaited before the next step.

Entities of full extracts (``source_kind="snapshot"``) are not cut into micro-batches
but along their extracts, by a manifest (:mod:`lakeledger.sources.extracts`): an extract
is read once it is complete, however many wait.  An entity without data, or without a
landing folder, gets an empty silver table; the run goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import cast_failures, text
from ..operators import quality
from ..operators.cdc import apply_changes
from ..operators.dedup import latest_per_key
from ..operators.merge import as_timestamp, scd1_apply, upsert
from ..operators.extracts import scd2_extract_series
from ..operators.scd2 import scd2_apply, scd2_history
from ..sources.extracts import REFUSED, Manifest
from ..sources.files import RESCUE_COL, read_file_stream, read_files, with_ingest_metadata
from ..sources.schemas import bronze_out
from ..sources.snapshots import list_versions, path_exists, publish_snapshot, read_snapshot
from ..streaming.silver import (BucketedWriter, Scd2Store, SnapshotWriter, bucketed_scd2_writer, bucketed_table,
                                published, read_batches, visible)
from ..streaming.sinks import append_stream, foreach_batch_stream


HOPS = ["_bronze_load_datetime", "_silver_load_datetime"]  # when a row reached each layer


@dataclass
class Entity:
    name: str
    schema: T.StructType                 # landing layout (usually all strings)
    keys: list[str]
    sequence: list[str]                  # total order within a key, after typing
    clean: dict[str, Column] = field(default_factory=dict)
    tracked: list[str] = field(default_factory=list)
    kind: str = "scd1"                   # upsert | scd1 | scd2 | cdc1
    is_delete: Column | None = None
    fmt: str = "csv"
    options: dict | None = None
    max_files: int | None = None
    columns: list[str] | None = None     # silver payload (default: all typed columns)
    buckets: int | None = 16             # rewrite only touched key buckets; None: a whole version per batch
    sk_col: str | None = None            # surrogate key (scd1)
    source_kind: str = "delta"           # "snapshot": landing sub-folders are full extracts (scd1, scd2)
    mark: str = "_SUCCESS"               # file that says an extract is complete
    extract_time: str = "load"           # instant of an extract: "load" (now of its number) or "name" (its folder)
    late: str = "refuse"                 # an extract older than a known one; "place" (scd2): build anew from all
    layout: T.StructType | None = None   # declared silver layout: columns in its order

    def __post_init__(self):
        if self.source_kind == "snapshot":
            if self.max_files or self.kind not in ("scd1", "scd2"):
                raise ValueError("a full extract is one batch, for scd1 or scd2")
            if self.late != "refuse" and self.kind != "scd2":
                raise ValueError("only a history can place a late extract")
            self.buckets = None  # keys may be gone from any bucket


def _typed(e: Entity, batch: DataFrame, load_time) -> tuple[DataFrame, DataFrame]:
    """Valid rows with typed columns, and the rejected ones with their reasons."""
    typed = cast_failures(batch, e.clean) if e.clean else batch.withColumn("_cast_failures", F.array())
    rules = {f"{k}_not_null": F.col(k).isNotNull() for k in e.keys}
    rules["cast_ok"] = F.size("_cast_failures") == 0
    if RESCUE_COL in batch.columns:
        rules["nothing_rescued"] = F.col(RESCUE_COL).isNull()
    valid, rejects = quality.split_valid(typed, rules)
    return valid.select(*dict.fromkeys([*e.keys, *_payload(e), *e.sequence]),
                        F.col("_load_datetime").alias("_bronze_load_datetime"),
                        as_timestamp(load_time).alias("_silver_load_datetime")), rejects


def _payload(e: Entity) -> list[str]:
    return e.columns or list(e.schema.fieldNames())


def _next_state(e: Entity, src: DataFrame, prev: DataFrame | None, load_time,
                log: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Silver after the valid rows ``src``; ``log(src)`` keeps them and gives all there were (scd2)."""
    if e.kind == "upsert":
        return latest_per_key(src, e.keys, e.sequence) if prev is None else \
            upsert(prev, src.select(*prev.columns), e.keys, sequence=e.sequence)
    if e.kind == "scd1":
        return scd1_apply(prev, src, e.keys, e.tracked, load_time, sequence=e.sequence,
                          is_delete=e.is_delete, keep_tombstones=True, sk_col=e.sk_col,
                          source_kind=e.source_kind)
    if e.kind == "cdc1":
        return apply_changes(src, e.keys, e.sequence, apply_as_deletes=e.is_delete,
                             target=prev, keep_tombstones=True)
    if e.kind == "scd2":
        whole = log(src)
        cols = [*[c for c in _payload(e) if c not in e.keys], *HOPS]
        if prev is None:
            return scd2_history(whole, e.keys, e.tracked, e.sequence, is_delete=e.is_delete, columns=cols)
        return scd2_apply(prev, whole, src, e.keys, e.tracked, e.sequence, is_delete=e.is_delete, columns=cols)
    raise ValueError(f"unknown silver kind {e.kind}")


def _series(e: Entity, prev: DataFrame | None, extracts: DataFrame, instants: Sequence[str]) -> DataFrame:
    once = latest_per_key(extracts, [*e.keys, "_at"], e.sequence)
    return scd2_extract_series(prev, once, instants, e.keys, e.tracked, columns=[*_payload(e), *HOPS])


def _store(e: Entity, out: str) -> Scd2Store:
    return bucketed_scd2_writer(out, e.keys, e.tracked, e.sequence, e.buckets, is_delete=e.is_delete,
                                columns=[*[c for c in _payload(e) if c not in e.keys], *HOPS])


def _typed_batches(e: Entity, base: str, now: Callable[[int], object], writer: Scd2Store | BucketedWriter):
    """``foreachBatch`` callback: rejects to quarantine, valid rows, typed as they are stored, to the writer."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            version = writer.number(batch.sparkSession, batch_id)
            src, rejects = _typed(e, batch, now(version))
            rejects.write.mode("overwrite").parquet(f"{base}/quarantine/{e.name}/_batch={version}")
            writer(src, batch_id)
        finally:
            batch.unpersist()
    return write


def _silver_builder(e: Entity, base: str, now: Callable[[int], object]):
    def build(batch: DataFrame, prev: DataFrame | None, version: int) -> DataFrame:
        src, rejects = _typed(e, batch, now(version))
        rejects.write.mode("overwrite").parquet(f"{base}/quarantine/{e.name}/_batch={version}")
        log_base = f"{base}/silver_log/{e.name}"

        def log(rows: DataFrame) -> DataFrame:
            rows.write.mode("overwrite").parquet(f"{log_base}/_batch={version}")
            return read_batches(batch.sparkSession, log_base, rows.schema)
        return _next_state(e, src, prev, now(version), log)
    return build


def _bronze_schema(e: Entity) -> T.StructType:
    schema = bronze_out(e.schema)
    if e.fmt in ("csv", "json"):
        n = len(e.schema.fields)
        schema = T.StructType(schema.fields[:n] + [T.StructField(RESCUE_COL, T.StringType(), True)] + schema.fields[n:])
    return schema


def run_extracts(spark: SparkSession, e: Entity, landing_root: str, base: str, now: Callable[[int], object]) -> str:
    """Bronze and silver of an entity of full extracts; returns the silver folder.

    Extract ``n`` of the manifest goes to ``bronze/<entity>/_extract=<n>``; silver's
    version is the number of the last extract applied, so a run that is repeated
    after a failure applies the same ones again to the same version.  SCD2 takes all
    that wait in one step.  An extract that is complete and has no rows deletes all keys.
    """
    bronze, out = f"{base}/bronze/{e.name}", f"{base}/silver/{e.name}"
    manifest = Manifest(spark, f"{base}/_extracts/{e.name}")
    entries = manifest.discover(f"{landing_root}/{e.name}", e.mark, e.late,
                                at=(lambda n: str(now(n))) if e.extract_time == "load" else None)
    done = max(list_versions(spark, out), default=-1)
    usable = [x for x in entries if x.state != REFUSED]
    pending = [x for x in usable if x.number > done]
    for x in pending:
        if x.n_rows is None:
            rows = with_ingest_metadata(read_files(spark, x.folder, e.schema, fmt=e.fmt, options=e.options))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{bronze}/_extract={x.number}")
            x.n_rows = spark.read.schema(_bronze_schema(e)).parquet(f"{bronze}/_extract={x.number}").count()
            manifest.put(x)
    if not pending:
        return out

    def typed(x):
        rows = spark.read.schema(_bronze_schema(e)).parquet(f"{bronze}/_extract={x.number}")
        src, rejects = _typed(e, rows, now(x.number))
        rejects.write.mode("overwrite").parquet(f"{base}/quarantine/{e.name}/_batch={x.number}")
        return src

    if e.kind == "scd1":
        for x in pending:
            prev = read_snapshot(spark, out, below=x.number)
            publish_snapshot(_next_state(e, typed(x), prev, now(x.number), lambda s: s), out, x.number)
        return out
    applied = max((x.at for x in usable if x.number <= done), default="")
    prev = read_snapshot(spark, out, below=pending[0].number)
    if min(x.at for x in pending) < applied:  # a late one: its place is among those applied before
        pending, prev = sorted(usable, key=lambda x: x.at), None
    rows = None
    for x in pending:
        each = typed(x).withColumn("_at", F.lit(x.at))
        rows = each if rows is None else rows.unionByName(each)
    publish_snapshot(_series(e, prev, rows, [x.at for x in pending]), out, max(x.number for x in pending))
    return out


def _empty_silver(spark: SparkSession, e: Entity, now: Callable[[int], object]) -> DataFrame:
    """The silver table of an entity that has no data yet."""
    src, _ = _typed(e, spark.createDataFrame([], _bronze_schema(e)), now(0))
    if e.kind == "scd2" and e.source_kind == "snapshot":
        return _series(e, None, src.withColumn("_at", F.lit(str(now(0)))), [str(now(0))])
    return visible(_next_state(e, src, None, now(0), lambda s: s))


def run_bronze(spark: SparkSession, e: Entity, landing_root: str, base: str) -> str:
    out = f"{base}/bronze/{e.name}"
    if path_exists(spark, f"{landing_root}/{e.name}"):  # nothing has landed: nothing to read
        src = read_file_stream(spark, f"{landing_root}/{e.name}", e.schema, fmt=e.fmt,
                               options=e.options, max_files=e.max_files)
        append_stream(with_ingest_metadata(src), out, f"{base}/_checkpoints/bronze_{e.name}")
    return out


def run_silver(spark: SparkSession, e: Entity, base: str, now: Callable[[int], object]) -> str:
    bronze_dir = f"{base}/bronze/{e.name}"
    out = f"{base}/silver/{e.name}"
    if not path_exists(spark, bronze_dir):
        return out
    stream = spark.readStream.schema(_bronze_schema(e)).parquet(bronze_dir)
    if not e.buckets:
        writer = SnapshotWriter(out, _silver_builder(e, base, now), log_base=f"{base}/silver_log/{e.name}")
    elif e.kind == "scd2":
        writer = _typed_batches(e, base, now, _store(e, out))
    else:
        writer = _typed_batches(e, base, now, BucketedWriter(
            out, e.keys, e.buckets, lambda src, prev, version: _next_state(e, src, prev, now(version), lambda rows: rows)))
    foreach_batch_stream(stream, writer, f"{base}/_checkpoints/silver_{e.name}")
    return out


def run_medallion(spark: SparkSession, entities: Sequence[Entity], landing_root: str, base: str,
                  now: Callable[[int], object]) -> dict[str, DataFrame]:
    """Run bronze then silver for each entity; return the published silver tables."""
    out = {}
    for e in entities:
        if e.source_kind == "snapshot":
            df = published(spark, run_extracts(spark, e, landing_root, base, now))
        else:
            run_bronze(spark, e, landing_root, base)
            silver_dir = run_silver(spark, e, base, now)
            if not e.buckets:
                df = published(spark, silver_dir)
            else:
                df = bucketed_table(spark, _store(e, silver_dir) if e.kind == "scd2" else silver_dir)
        if df is None:
            df = _empty_silver(spark, e, now)
        out[e.name] = df.select(*e.layout.fieldNames()) if e.layout is not None else df
    return out


def oncology_entities(max_files: int | None = 1, buckets: int | None = 16) -> list[Entity]:
    """The five landing entities of the reference job, as :class:`Entity` specs.

    Bronze keeps text (type inference off); silver try-casts and quarantines
    failures.  Keys follow the data, not the one-key-for-all of the
    reference (X3): observations and conditions are many per patient.
    Rows of one key are ordered by the business date where there is one,
    then by file modification time and file name (a total order, X10).
    """
    from ..functions.clean import to_bool_safe, to_date_safe, to_type_safe, upper_text
    from ..sources.schemas import LANDING, all_strings

    arrival = ["_source_file_mtime", "_source_file"]

    def strings(name):
        return all_strings(LANDING[name])

    return [
        Entity("cancer_patient", strings("cancer_patient"), ["Patient_ID"], arrival,
               clean={"Patient_ID": text("Patient_ID"), "Name": text("Name"),
                      "Age": to_type_safe("Age", "int"), "Gender": upper_text("Gender"),
                      "Cancer_Patient": to_bool_safe("Cancer_Patient")},
               kind="upsert", max_files=max_files, buckets=buckets),
        Entity("cancer_disease_status", strings("cancer_disease_status"), ["Patient_ID"],
               ["Last_Update", *arrival],
               clean={"Patient_ID": text("Patient_ID"), "Cancer_Disease_Status": text("Cancer_Disease_Status"),
                      "Last_Update": to_date_safe("Last_Update"), "On_Treatment": to_bool_safe("On_Treatment")},
               tracked=["Cancer_Disease_Status", "On_Treatment"], kind="scd2", max_files=max_files, buckets=buckets),
        Entity("observation", strings("observation"), ["Patient_ID", "Observation_Date", "Doctor"], arrival,
               clean={"Patient_ID": text("Patient_ID"), "Observation": text("Observation"),
                      "Doctor": text("Doctor"), "Observation_Date": to_date_safe("Observation_Date")},
               kind="upsert", max_files=max_files, buckets=buckets),
        Entity("primary_cancer_condition", strings("primary_cancer_condition"), ["Patient_ID", "Diagnosis_Date"],
               arrival,
               clean={"Patient_ID": text("Patient_ID"),
                      "Primary_Cancer_Condition": text("Primary_Cancer_Condition"),
                      "Diagnosis_Date": to_date_safe("Diagnosis_Date"), "Hospital": text("Hospital")},
               kind="upsert", max_files=max_files, buckets=buckets),
        Entity("tnm_stage_group", strings("tnm_stage_group"), ["Patient_ID"], arrival,
               clean={"Patient_ID": text("Patient_ID"), "TNM_Stage_Group": upper_text("TNM_Stage_Group"),
                      "Tumor_Size_cm": to_type_safe("Tumor_Size_cm", "double"),
                      "Node_Involvement": to_bool_safe("Node_Involvement"),
                      "Metastasis": to_bool_safe("Metastasis")},
               tracked=["TNM_Stage_Group", "Tumor_Size_cm", "Node_Involvement", "Metastasis"],
               kind="scd1", max_files=max_files, buckets=buckets),
    ]


def production_entities(max_files: int | None = None, buckets: int | None = 16) -> dict[str, Entity]:
    """Patients as SCD1 (full extracts) and as SCD2, and encounters as SCD2, in their declared layouts."""
    from ..functions.clean import to_bool_safe, to_date_safe, upper_text
    from ..sources import schemas as L

    arrival = ["_source_file_mtime", "_source_file"]
    patient = L.all_strings(L.PATIENTS_BRONZE_IN)
    clean = {"patient_id": text("patient_id"), "name": text("name"), "dob": to_date_safe("dob"), "ssn": text("ssn"),
             "gender": upper_text("gender"), "cancer_patient": to_bool_safe("cancer_patient")}
    tracked = ["name", "dob", "ssn", "gender", "cancer_patient"]
    return {
        "patients_scd1": Entity("patients_scd1", patient, ["patient_id"], arrival, clean=clean, tracked=tracked,
                                kind="scd1", sk_col="patient_sk", source_kind="snapshot",
                                layout=L.PATIENTS_SILVER_SCD1),
        "patients_scd2": Entity("patients_scd2", patient, ["patient_id"], arrival, clean=clean, tracked=tracked,
                                kind="scd2", source_kind="snapshot", layout=L.PATIENTS_SILVER_SCD2),
        "encounter": Entity("encounter", L.all_strings(L.ENCOUNTER_BRONZE_IN), ["Patient_ID"],
                            ["Last_Update", "Encounter_ID"],
                            clean={"Encounter_ID": text("Encounter_ID"), "Patient_ID": text("Patient_ID"),
                                   "Cancer_Disease_Status": text("Cancer_Disease_Status"),
                                   "Last_Update": to_date_safe("Last_Update"), "On_Treatment": text("On_Treatment")},
                            tracked=["Cancer_Disease_Status", "On_Treatment"], kind="scd2", max_files=max_files,
                            buckets=buckets, layout=L.ENCOUNTER_SILVER_SCD2),
    }


def oncology_gold(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Gold reports over the five silver entities of :func:`oncology_entities`.

    * ``readmission_30d``: previous diagnosis per patient (event-level
      conditions, not a one-row-per-patient table, X2);
    * ``status_transitions``: status changes along the SCD2 history;
    * ``cohort``: current status x TNM stage, with roll-up subtotals;
    * ``outcome_rates``: share in remission per TNM stage;
    * ``patient_360``: patient + current status + stage + latest condition +
      number of observations (each side reduced to one row per patient first).
    """
    from ..operators.gold import cohort_rollup, entity_360, outcome_rates, readmissions, status_transitions

    cond = silver["primary_cancer_condition"]
    hist = silver["cancer_disease_status"]
    stage = silver["tnm_stage_group"].filter(~F.col("_is_deleted"))
    current = hist.filter(F.col("is_current")).select("Patient_ID", "Cancer_Disease_Status", "On_Treatment")
    staged = current.join(stage.select("Patient_ID", "TNM_Stage_Group", "Metastasis"), "Patient_ID")
    latest_cond = latest_per_key(cond.select("Patient_ID", "Primary_Cancer_Condition", "Diagnosis_Date",
                                             "Hospital"), ["Patient_ID"], ["Diagnosis_Date", "Hospital"])
    n_obs = silver["observation"].groupBy("Patient_ID").agg(F.count(F.lit(1)).alias("n_observations"))
    return {
        "readmission_30d": readmissions(cond, "Patient_ID", "Diagnosis_Date", tie_break=["Hospital"]),
        "status_transitions": status_transitions(hist, "Patient_ID", ["scd_start_date", "scd_version"],
                                                 "Cancer_Disease_Status"),
        "cohort": cohort_rollup(staged, ["Cancer_Disease_Status", "TNM_Stage_Group"],
                                {"n_patients": F.count(F.lit(1))}),
        "outcome_rates": outcome_rates(staged, ["TNM_Stage_Group"],
                                       F.col("Cancer_Disease_Status") == F.lit("Remission"),
                                       total_col="n_patients", hit_col="n_remission",
                                       rate_col="remission_rate"),
        "patient_360": entity_360(silver["cancer_patient"].select("Patient_ID", "Name", "Age", "Gender"),
                                  "Patient_ID", {"status": current, "stage": stage.select(
                                      "Patient_ID", "TNM_Stage_Group", "Tumor_Size_cm"),
                                      "condition": latest_cond, "observations": n_obs}),
    }
