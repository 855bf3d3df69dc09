"""Reading registry tables, archives and partition lists; see also ``reports`` and ``store``."""

from __future__ import annotations

import re
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A pipe-delimited table with a header: quoted fields may span lines, doubled quotes are escapes, all columns strings."""
    return spark.read.csv(f"{folder}/{name}.txt", sep="|", header=True, multiLine=True, quote='"', escape='"')


def to_parquet(spark: SparkSession, folder: str, names: list[str], out: str) -> None:
    """Text tables once as Parquet: multi-line text can't be split between tasks, Parquet can."""
    for n in names:
        read_table(spark, folder, n).write.mode("overwrite").parquet(f"{out}/{n}")


def extract(archive: str, folder: str, tables: list[str]) -> list[Path]:
    """The wanted members of a zip archive; a missing one is an error that names it."""
    wanted = {f"{t}.txt" for t in tables}
    with zipfile.ZipFile(archive) as z:
        missing = sorted(wanted - {Path(n).name for n in z.namelist()})
        if missing:
            raise ValueError(f"{archive} lacks {', '.join(missing)}")
        Path(folder).mkdir(parents=True, exist_ok=True)
        out = []
        for n in z.namelist():
            if Path(n).name in wanted:
                target = Path(folder) / Path(n).name
                target.write_bytes(z.read(n))
                out.append(target)
    return out


def fetch(source: str, folder: str, tables: list[str]) -> list[Path]:
    """From an archive, or as they are from a folder that has them."""
    if zipfile.is_zipfile(source):
        return extract(source, folder, tables)
    found = [Path(source) / f"{t}.txt" for t in tables]
    missing = [p.name for p in found if not p.exists()]
    if missing:
        raise ValueError(f"{source} lacks {', '.join(missing)}")
    return found


def quarter_of(url: str) -> tuple[int, int] | None:
    m = re.search(r"/(\d{4})q(\d)/", url)
    return (int(m[1]), int(m[2])) if m else None


def select_partitions(urls: list[str], years: range, quarters: set[int]) -> list[str]:
    return [u for u in urls if (q := quarter_of(u)) and q[0] in years and q[1] in quarters]


def local_path(url: str, root: str) -> Path:
    q = quarter_of(url)
    if not q:
        raise ValueError(f"{url} names no quarter")
    return Path(root) / f"{q[0]}q{q[1]}" / url.rsplit("/", 1)[-1]


def share(items: list, task: int, tasks: int) -> list:
    """Every ``tasks``-th item, from ``task`` on."""
    return items[task::tasks]


def not_yet(items: list[str], present: set[str]) -> list[str]:
    """Items whose name is not there; sizes do not matter."""
    return [i for i in items if i.rsplit("/", 1)[-1] not in present]


def retried(action, attempts: int = 4, wait: float = 5.0, sleep=None):
    """The action's result, tried again after rising waits."""
    import time

    for k in range(attempts):
        try:
            return action()
        except OSError:
            if k + 1 == attempts:
                raise
            (sleep or time.sleep)(wait * (k + 1))


def by_archive(spark: SparkSession, folder: str) -> DataFrame:
    """All reduced archives of a folder; partition columns prune what is read."""
    return spark.read.parquet(folder)


def reduce_archive(spark: SparkSession, date: str, out: str, build, force: bool = False) -> str:
    """Write one archive's rows into its folder unless that is complete already."""
    path = f"{out}/archive_date={date}"
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done) and not force:
        return f"{date}: already reduced"
    build().drop("archive_date").write.mode("overwrite").parquet(path)
    return f"{date}: reduced"


def with_source_quarter(df: DataFrame) -> DataFrame:
    name = F.input_file_name()
    return df.withColumn("year", F.regexp_extract(name, r"/(\d{4})q\d/", 1).try_cast("int")).withColumn("quarter", F.regexp_extract(name, r"/\d{4}q(\d)/", 1).try_cast("int"))
