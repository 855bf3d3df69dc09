"""Numbered versions on any file system that Spark reaches: of models, and of tables whose files are never rewritten.

A number is claimed by writing a file of one's own into the folder of the number and then listing it: whoever finds only its own
file there holds the number. Of two writers at most one does, since one of them lists after both have written; no file system
needs to create a file exclusively for that. A number that several want at once is left unused.
"""

from __future__ import annotations

import json
import random
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.store import _fs, exists, point_to, pointed_at


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in ``folder``; none if it is missing."""
    path, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def _numbers(found: list[str], before: str = "") -> list[int]:
    return sorted(int(n[len(before) :]) for n in found if n.startswith(before) and n[len(before) :].isdigit())


def claim(spark: SparkSession, root: str, number: int) -> bool:
    """Whether this call alone holds ``number`` below ``root``."""
    own = uuid.uuid4().hex
    point_to(spark, f"{root}/_claims/{number}/{own}", {})
    return [n for n in names(spark, f"{root}/_claims/{number}") if not n.startswith(".")] == [own]


def claim_next(spark: SparkSession, root: str, tries: int = 100) -> int:
    """The next number below ``root`` that this call alone holds."""
    for _ in range(tries):
        number = max(_numbers(names(spark, f"{root}/_claims")), default=0) + 1
        if claim(spark, root, number):
            return number
        time.sleep(random.random() * 0.1)
    raise RuntimeError(f"no number below {root} could be claimed")


class Registry:
    """Versions of fitted models and their documents in a folder; a version is never overwritten.

    ``model``: anything with ``save_to(spark, folder)``, or a model of ``pyspark.ml``. A version counts once its last file, which
    names its documents, is written; what a stopped writer leaves is never read.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def versions(self) -> list[int]:
        return [n for n in _numbers(names(self.spark, self.root), "v") if exists(self.spark, f"{self.root}/v{n}/complete.json")]

    def latest(self) -> int:
        found = self.versions()
        if not found:
            raise FileNotFoundError(f"{self.root} has no versions")
        return found[-1]

    def claim(self) -> int:
        return claim_next(self.spark, self.root)

    def save(self, version: int, model=None, **documents: dict) -> str:
        """``version`` comes from ``claim``; an error if it is there already."""
        folder = f"{self.root}/v{version}"
        if exists(self.spark, folder):
            raise FileExistsError(f"{folder} is there already")
        if model is not None:
            if hasattr(model, "save_to"):
                model.save_to(self.spark, f"{folder}/model")
            else:
                model.write().save(f"{folder}/model")
        for name, doc in documents.items():
            point_to(self.spark, f"{folder}/{name}.json", doc)
        point_to(self.spark, f"{folder}/complete.json", {"documents": sorted(documents), "model": model is not None})
        return folder

    def load(self, version: int, name: str) -> dict:
        return pointed_at(self.spark, f"{self.root}/v{version}/{name}.json")

    def documents(self, version: int) -> dict[str, dict]:
        return {n: self.load(version, n) for n in self.load(version, "complete")["documents"]}

    def model(self, version: int, kind):
        """The model, by ``kind.load_from(spark, folder)`` or ``kind.load(folder)``."""
        folder = f"{self.root}/v{version}/model"
        return kind.load_from(self.spark, folder) if hasattr(kind, "load_from") else kind.load(folder)


class Table:
    """A table of immutable Parquet folders. Each write adds one and a manifest of those that make up the table from then on.

    A reader of a manifest sees the rows that it named, whatever is written later. ``freeze`` gives a version a name and copies no
    row: its folders stay until no name and no recent version lists them and ``vacuum`` is called.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def versions(self) -> list[int]:
        return _numbers([n.removesuffix(".json") for n in names(self.spark, f"{self.root}/manifests") if n.endswith(".json")])

    def _manifest(self, version: int | None) -> dict:
        found = self.versions()
        if version is None and not found:
            raise FileNotFoundError(f"{self.root} has no versions")
        return pointed_at(self.spark, f"{self.root}/manifests/{found[-1] if version is None else version}.json")

    def _write(self, df: DataFrame, before: list[str]) -> int:
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        version = claim_next(self.spark, self.root)
        point_to(self.spark, f"{self.root}/manifests/{version}.json", {"folders": [*before, folder], "schema": df.schema.jsonValue(), "version": version})
        return version

    def overwrite(self, df: DataFrame) -> int:
        """A version of the rows of ``df`` only; ``df`` may read this table."""
        return self._write(df, [])

    def append(self, df: DataFrame) -> int:
        """A version with the rows of ``df`` besides those of the last one; its columns are the last one's."""
        last = self._manifest(None)
        schema = StructType.fromJson(last["schema"])
        return self._write(df.select(*[df[f.name].cast(f.dataType) for f in schema.fields]), last["folders"])

    def _rows(self, manifest: dict) -> DataFrame:
        return self.spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(*[f"{self.root}/{f}" for f in manifest["folders"]])

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self._manifest(version))

    def freeze(self, name: str, version: int | None = None) -> dict:
        """The manifest that ``name`` stands for from now on; an error if the name is taken."""
        if not claim(self.spark, f"{self.root}/frozen", name) or exists(self.spark, f"{self.root}/frozen/{name}.json"):
            raise FileExistsError(f"{name} is taken")
        manifest = self._manifest(version)
        point_to(self.spark, f"{self.root}/frozen/{name}.json", manifest)
        return manifest

    def frozen(self, name: str) -> DataFrame:
        return self._rows(pointed_at(self.spark, f"{self.root}/frozen/{name}.json"))

    def vacuum(self, keep: int = 1) -> list[str]:
        """Removes the folders that neither the last ``keep`` versions nor a name lists, and the older manifests; no writer may be at work."""
        found = self.versions()
        kept = [self._manifest(v) for v in found[-keep:]]
        kept += [pointed_at(self.spark, f"{self.root}/frozen/{n}") for n in names(self.spark, f"{self.root}/frozen") if n.endswith(".json")]
        listed = {f for m in kept for f in m["folders"]}
        gone = [f"data/{n}" for n in names(self.spark, f"{self.root}/data") if f"data/{n}" not in listed]
        for old in [*gone, *(f"manifests/{v}.json" for v in found[:-keep])]:
            path, fs = _fs(self.spark, f"{self.root}/{old}")
            fs.delete(path, True)
        return gone


class Lookup:
    """Single rows by key without a scan: rows lie in one sorted file for each bucket of a hash of the key.

    ``publish`` writes the files and then the pointer to them, so that a reader sees the old rows or the new ones.
    """

    #: Rows that a bucket should hold.
    ROWS = 100_000

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.told = pointed_at(spark, f"{root}/current.json")
        self.schema = StructType.fromJson(self.told["schema"])

    @staticmethod
    def publish(df: DataFrame, root: str, key: str, rows: int = ROWS) -> Lookup:
        spark, n = df.sparkSession, df.count()
        if not n:
            raise ValueError("a lookup without rows is not published")
        buckets = -(-n // rows)
        bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets))
        folder = f"data-{uuid.uuid4().hex}"
        dealt = df.withColumn("bucket__", bucket).repartition(buckets, "bucket__").sortWithinPartitions("bucket__", key)
        dealt.write.option(f"parquet.bloom.filter.enabled#{key}", "true").partitionBy("bucket__").parquet(f"{root}/{folder}")
        point_to(spark, f"{root}/current.json", {"key": key, "buckets": buckets, "folder": folder, "rows": n, "schema": df.schema.jsonValue()})
        return Lookup(spark, root)

    def rows(self, value) -> DataFrame:
        """The rows with that key: a plan over the one file that can hold them."""
        if value is None:
            return self.spark.createDataFrame([], self.schema)
        # a plan over no table: the optimizer works it out, no job runs
        bucket = self.spark.sql("SELECT pmod(xxhash64(:v), :n) AS b", {"v": str(value), "n": self.told["buckets"]}).collect()[0].b
        folder = f"{self.root}/{self.told['folder']}/bucket__={bucket}"
        if not exists(self.spark, folder):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(folder).where(F.col(self.told["key"]) == F.lit(value))

    def get(self, value) -> dict | None:
        """One row as a dictionary: dates as text, NaN as None, reasons parsed; None if there is none."""
        found = self.rows(value).limit(1).collect()
        return as_document(found[0]) if found else None

    def many(self, keys: DataFrame) -> DataFrame:
        """The rows of many keys (one column): a join over all files."""
        all_rows = self.spark.read.schema(self.schema).parquet(f"{self.root}/{self.told['folder']}")
        return all_rows.join(keys.toDF(self.told["key"]).distinct(), self.told["key"])


def as_document(row) -> dict:
    out = {}
    for k, v in row.asDict(recursive=True).items():
        if isinstance(v, float) and v != v:
            v = None
        elif hasattr(v, "isoformat"):
            v = v.isoformat()[:10]
        elif k == "reasons":
            v = json.loads(v or "[]") if v is None or isinstance(v, str) else v
        out[k] = v
    return out
