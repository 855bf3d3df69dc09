"""Adverse-event reports: zipped JSON documents to one row per report and substance."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import names as N
from tidemark.functions import scalars as S
from tidemark.session import ship_package

REPORT = (
    "safetyreportid string, safetyreportversion string, receivedate string, receiptdate string, serious string, seriousnessdeath string, "
    "patient struct<drug: array<struct<drugcharacterization: string, medicinalproduct: string, openfda: struct<substance_name: array<string>>, activesubstance: struct<activesubstancename: string>>>>"
)
BATCH = 500


def items(stream: io.TextIOBase, key: str = "results", chunk: int = 1 << 20) -> Iterator[dict]:
    """The objects of the array ``key`` of one JSON document, read in chunks: a chunk and one object are held."""
    decoder, held = json.JSONDecoder(), ""
    mark = f'"{key}"'
    while mark not in held:
        more = stream.read(chunk)
        if not more:
            return
        held = held[-len(mark) :] + more
    held = held.split(mark, 1)[1]
    while "[" not in held:
        more = stream.read(chunk)
        if not more:
            return
        held += more
    at = held.index("[") + 1
    while True:
        while at < len(held) and held[at] in " \t\r\n,":
            at += 1
        if held.startswith("]", at):
            return
        try:
            value, at = decoder.raw_decode(held, at)
        except json.JSONDecodeError:
            more = stream.read(chunk)
            if not more:
                return
            held, at = held[at:] + more, 0
            continue
        yield value


#: File systems that a task opens by path; others come through Spark, a file in one value.
OPENED = {"file": "file", "s3": "s3", "s3a": "s3", "gs": "gs"}


def opened(path: str) -> io.IOBase:
    """A stream of the file at a URI as Spark lists it, seekable, of which only what is read is held."""
    scheme, _, rest = path.partition(":")
    rest = f"/{rest.lstrip('/')}" if scheme == "file" else rest.lstrip("/")
    files, inner = pafs.FileSystem.from_uri(f"{OPENED[scheme]}://{quote(unquote(rest))}")
    return files.open_input_file(inner)


def read_reports(spark: SparkSession, glob: str, by_path: bool | None = None) -> DataFrame:
    """Reports of all zips. A task opens one file at a time and inflates it as it reads: a batch of reports is held, whatever its size.

    ``by_path``: open files in the task; None: where ``OPENED`` has their file system. Otherwise Spark hands over whole files, which
    must stay below 2 GB.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").load(glob)
    if by_path is None:
        first = files.select("path").limit(1).collect()  # files are listed, not read
        by_path = bool(first) and first[0].path.partition(":")[0] in OPENED

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.column(0):
                with opened(one.as_py()) if by_path else io.BytesIO(one.as_py()) as file, zipfile.ZipFile(file) as z, z.open(z.namelist()[0]) as raw:
                    held = []
                    for report in items(io.TextIOWrapper(raw, "utf-8")):
                        held.append(json.dumps(report))
                        if len(held) == BATCH:
                            yield pa.RecordBatch.from_arrays([pa.array(held)], ["report"])
                            held = []
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(held)], ["report"])

    lines = files.select("path" if by_path else "content").mapInArrow(unpack, "report string")
    return lines.select(F.from_json("report", REPORT).alias("r")).select("r.*")


def report_rows(reports: DataFrame) -> DataFrame:
    """One row per report version, drug and substance name, normalized; reports without an id or drugs have none."""
    version = F.when(F.col("safetyreportversion").rlike("^[0-9]+$"), F.col("safetyreportversion").try_cast("int")).otherwise(1)
    base = reports.where(F.coalesce("safetyreportid", F.lit("")) != "").select(
        "safetyreportid", version.alias("version"), "receivedate", "receiptdate", (F.coalesce("serious", F.lit("")) == "1").alias("serious"), (F.coalesce("seriousnessdeath", F.lit("")) == "1").alias("death"), F.explode("patient.drug").alias("d")
    )
    coded = F.coalesce(F.size("d.openfda.substance_name"), F.lit(0)) > 0
    active = F.nullif(F.col("d.activesubstance.activesubstancename"), F.lit(""))
    found = F.when(coded, F.col("d.openfda.substance_name")).otherwise(F.array(F.coalesce(active, F.nullif(F.col("d.medicinalproduct"), F.lit("")), F.lit(""))))
    names = F.array_sort(F.array_distinct(F.filter(F.transform(found, N.normalize), lambda n: n != "")))
    rows = base.withColumn("substance", F.explode(names))
    return rows.select(
        "safetyreportid", "version", "receivedate", "receiptdate", "serious", "death", (F.coalesce("d.drugcharacterization", F.lit("")) == "1").alias("suspect"), coded.alias("harmonized"), (~coded & active.isNotNull()).alias("active_substance"), "substance"
    )


def drug_events(rows: DataFrame) -> DataFrame:
    """The latest version of each report, one row per report and substance; impossible dates are null."""
    latest = F.max("version").over(Window.partitionBy("safetyreportid"))
    kept = rows.withColumn("latest_", latest).where("version = latest_")
    flags = ("serious", "death", "suspect", "harmonized", "active_substance")
    out = kept.groupBy("safetyreportid", "substance").agg(F.max("receivedate").alias("receivedate"), F.max("receiptdate").alias("receiptdate"), *[F.bool_or(c).alias(c) for c in flags])
    return out.withColumn("receivedate", S.valid_date(F.col("receivedate"))).withColumn("receiptdate", S.valid_date(F.col("receiptdate")))


def build_drug_events(spark: SparkSession, glob: str) -> DataFrame:
    return drug_events(report_rows(read_reports(spark, glob)))


def vocabulary(events: DataFrame) -> DataFrame:
    """Coded, specific substances."""
    return events.where(F.col("harmonized") | F.col("active_substance")).select("substance").distinct().where(N.is_specific(F.col("substance")))
