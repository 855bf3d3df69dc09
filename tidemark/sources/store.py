"""Landing tables, sinks and versioned outputs on any file system that Spark reaches."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import AREAS
from tidemark.gates import DataGateError

LANDING = {
    "RAW_TRIALS": "nct_id string, status string, phase string, start_date date, number_of_arms int, label int, stop_reason string, has_dmc boolean, allocation string, intervention_model string, primary_purpose string, masking string, sponsor_name string, sponsor_class string, brief_title string",
    "RAW_TRIAL_ATTRIBUTES": "nct_id string, n_countries int, us_only boolean, min_age_years double, max_age_years double, healthy_volunteers boolean, sex string, criteria_count int, criteria_chars int, "
    + ", ".join(f"area_{k} boolean" for k in AREAS)
    + ", responsible_party string, n_collaborators int, n_keywords int",
    "RAW_SPONSOR_OUTCOMES": "nct_id string, terminated int, start_date date, completion_date date, sponsor_name string",
    "RAW_TRIAL_DRUG_MAP": "nct_id string, substance string",
    "RAW_FAERS_DRUG_EVENTS": "safetyreportid string, substance string, receivedate date, receiptdate date, serious boolean, death boolean, suspect boolean, harmonized boolean, active_substance boolean",
    "RAW_TRIAL_TEXT": "nct_id string, text string",
    "RAW_SPONSOR_STARTS": "nct_id string, sponsor_name string, start_date date",
}


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether there is a data file below ``path``; stops at the first."""
    p, fs = _fs(spark, path)
    files = fs.listFiles(p, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def typed(df: DataFrame, ddl: str) -> DataFrame:
    """Columns by name, whatever their case, cast to the landing types; missing ones are null, others left out."""
    from pyspark.sql.types import StructType

    have = {c.lower(): c for c in df.columns}
    fields = StructType.fromDDL(ddl).fields
    return df.select(*[(F.col(have[f.name.lower()]).try_cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields])


def load(spark: SparkSession, folder: str, names: dict[str, str] | None = None) -> None:
    """Each landing table as a view over its Parquet folder; an empty or missing folder stops the job."""
    for name, sub in (names or {n: n.removeprefix("RAW_").lower() for n in LANDING}).items():
        if not exists(spark, f"{folder}/{sub}"):
            raise DataGateError(f"{folder}/{sub} is missing")
        if not has_files(spark, f"{folder}/{sub}"):
            raise DataGateError(f"{folder}/{sub} is empty")
        typed(spark.read.parquet(f"{folder}/{sub}"), LANDING[name]).createOrReplaceTempView(name)


def publish(df: DataFrame, out: str) -> None:
    """Write beside ``out``, then swap: readers see the old or the new rows, and a failed write leaves the old ones."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{out}__incoming")
    path, fs = _fs(spark, out)
    new, _ = _fs(spark, f"{out}__incoming")
    old, _ = _fs(spark, f"{out}__old")
    fs.delete(old, True)
    if fs.exists(path) and not fs.rename(path, old):
        raise RuntimeError(f"could not set {out} aside")
    if not fs.rename(new, path):
        fs.rename(old, path)
        raise RuntimeError(f"could not move {out}__incoming to {out}")
    fs.delete(old, True)


def single_file(df: DataFrame, out: str) -> None:
    """One Parquet file for a reader that wants one; for tables of bounded size only."""
    df.coalesce(1).write.mode("overwrite").parquet(out)


def point_to(spark: SparkSession, pointer: str, document: dict) -> None:
    """Write the pointer after the data, so that it never names what is not there."""
    path, fs = _fs(spark, pointer)
    out = fs.create(path, True)
    out.write(bytearray(json.dumps(document, sort_keys=True).encode()))
    out.close()


def pointed_at(spark: SparkSession, pointer: str) -> dict:
    return json.loads("\n".join(r.value for r in spark.read.text(pointer).collect()))


def append(df: DataFrame, out: str) -> None:
    """Append rows; new columns may come, readers merge the schemas."""
    df.write.mode("append").parquet(out)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def replace_version(df: DataFrame, out: str, column: str = "model_version") -> None:
    """Replace the rows of the versions in ``df`` and keep all others: running again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(out)


def resume(df: DataFrame, out: str, key: str, compute, shards: int = 64) -> None:
    """Append computed rows for the keys that ``out`` lacks, shard by shard, so that a stopped run goes on where it was."""
    spark = df.sparkSession
    for k in range(shards):
        part = df.where(F.pmod(F.xxhash64(key), F.lit(shards)) == k)
        if exists(spark, f"{out}/shard={k}/_SUCCESS"):
            continue
        compute(part).write.mode("overwrite").parquet(f"{out}/shard={k}")
