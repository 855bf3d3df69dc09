"""Versions that two writers can't both take, tables frozen without a copy, lookups of one file, archives as streams, exact percentiles."""

import json
import random
import zipfile
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions.percentiles import exact_percentiles
from tidemark.models.risk import RiskModel
from tidemark.models.survival import BoostedHazards
from tidemark.sources import reports, versions


def test_writers_at_the_same_time_never_hold_the_same_number(spark, tmp_path):
    root = f"file://{tmp_path}/models"
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: versions.claim_next(spark, root), range(24)))
    assert len(set(got)) == 24
    assert not versions.claim(spark, root, got[0])


def test_registry(spark, tmp_path):
    reg = versions.Registry(spark, f"file://{tmp_path}/models")
    with pytest.raises(FileNotFoundError):
        reg.latest()
    one, two = reg.claim(), reg.claim()
    reg.save(two, report={"auc": 0.7}, manifest={"version": two})
    assert reg.latest() == two > one and reg.versions() == [two]  # what was claimed but never saved isn't there
    assert reg.documents(two) == {"report": {"auc": 0.7}, "manifest": {"version": two}}
    with pytest.raises(FileExistsError):
        reg.save(two, report={})


def test_registry_gives_models_back(spark, tmp_path):
    rng = random.Random(1)
    rows = [(k, rng.gauss(0, 1), rng.choice(["a", "b", None]), rng.random() * 4, rng.randrange(3)) for k in range(200)]
    df = spark.createDataFrame(rows, "id int, x double, kind string, time double, event int").withColumn("label", (F.col("x") > 0).cast("int"))
    risk = RiskModel(["x", "kind"], (0,), maxIter=2, maxDepth=2).fit(df, "label")
    hazards = BoostedHazards(["kind", "x"], trees=2, depth=1, rate=0.5).fit(df)
    reg = versions.Registry(spark, f"file://{tmp_path}/models")
    a, b = reg.claim(), reg.claim()
    reg.save(a, risk), reg.save(b, hazards)
    again = reg.model(a, RiskModel)
    assert again.score(df).orderBy("id").collect() == risk.score(df).orderBy("id").collect()
    assert again.contributions(df).orderBy("id").first().contributions == risk.contributions(df).orderBy("id").first().contributions
    key = lambda m: sorted(map(tuple, m.hazards(df, "id").collect()))
    assert key(reg.model(b, BoostedHazards)) == key(hazards)


def test_table_is_frozen_without_a_copy(spark, tmp_path):
    t = versions.Table(spark, f"file://{tmp_path}/t")
    with pytest.raises(FileNotFoundError):
        t.read()
    t.overwrite(spark.range(5).withColumn("x", F.lit("old")))
    files = lambda: {p for p in Path(tmp_path).rglob("*.parquet")}
    before = files()
    t.freeze("v1")
    assert files() == before
    with pytest.raises(FileExistsError):
        t.freeze("v1")
    t.overwrite(t.read().where("id > 2").withColumn("x", F.lit("new")))  # a table may be written from itself
    t.append(spark.createDataFrame([("more", 9)], "x string, id int"))
    assert sorted(map(tuple, t.read().collect())) == [(3, "new"), (4, "new"), (9, "more")]
    assert [r.x for r in t.frozen("v1").collect()] == ["old"] * 5 and t.read(t.versions()[1]).count() == 2
    t.overwrite(spark.range(1).withColumn("x", F.lit("last")))
    assert len(t.vacuum()) == 2 and before <= files() and len(files()) > len(before)
    assert t.frozen("v1").count() == 5 and t.read().count() == 1 and len(t.versions()) == 1


def test_lookup_opens_one_file(spark, tmp_path):
    df = spark.range(5000).select(F.concat(F.lit("N"), "id").alias("nct_id"), F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(1.5).alias("x"), F.lit('[{"feature": "a"}]').alias("reasons"), F.lit(date(2020, 1, 2)).alias("start_date"))
    found = versions.Lookup.publish(df, f"file://{tmp_path}/l", "nct_id", rows=500)
    assert found.told["buckets"] == 10
    assert found.get("N4") == {"nct_id": "N4", "x": None, "reasons": [{"feature": "a"}], "start_date": "2020-01-02"}
    assert found.get("N5")["x"] == 1.5 and found.get("none") is None and found.get(None) is None
    rows = found.rows("N77")
    assert len(rows.inputFiles()) == 1 and rows.count() == 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(nct_id), EqualTo(nct_id,N77)]" in plan
    many = found.many(spark.createDataFrame([("N1",), ("N2",), ("N2",), ("x",)], "k string"))
    assert sorted(r.nct_id for r in many.collect()) == ["N1", "N2"]
    versions.Lookup.publish(df.limit(1), f"file://{tmp_path}/l", "nct_id")
    assert versions.Lookup(spark, f"file://{tmp_path}/l").told["rows"] == 1 and found.get("N5")["x"] == 1.5  # the old reader keeps its files
    with pytest.raises(ValueError):
        versions.Lookup.publish(df.limit(0), f"file://{tmp_path}/l", "nct_id")


@pytest.mark.parametrize("by_path", [True, False, None])
def test_archives_are_read_as_streams(spark, tmp_path, by_path):
    for n in range(3):
        with zipfile.ZipFile(tmp_path / f"part {n}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("a.json", json.dumps({"meta": {"x": "results of"}, "results": [{"safetyreportid": f"{n}-{k}", "patient": {"drug": [{"medicinalproduct": f"d{k}"}]}} for k in range(700)]}))
    got = reports.read_reports(spark, f"file://{tmp_path}/*.zip", by_path)
    assert got.count() == 2100 and got.select("safetyreportid").distinct().count() == 2100


def test_a_stream_holds_little_of_a_large_archive(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("a.json", "w") as f:
        f.write(b'{"results": [')
        for k in range(40):
            f.write(b'%s{"k": %d, "pad": "%s"}' % (b"," if k else b"", k, b"x" * 1_000_000))
        f.write(b"]}")
    import io
    import tracemalloc

    tracemalloc.start()
    with reports.opened(f"file:{tmp_path}/a.zip") as file, zipfile.ZipFile(file) as z, z.open("a.json") as raw:
        assert [r["k"] for r in reports.items(io.TextIOWrapper(raw, "utf-8"))] == list(range(40))
    assert tracemalloc.get_traced_memory()[1] < 16_000_000
    tracemalloc.stop()


SHARES = {"low": 0.0, "third": 1 / 3, "half": 0.5, "odd": 0.9137, "top": 1.0}


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_percentiles_of_groups(spark, few, monkeypatch):
    rng = random.Random(3)
    rows = [("a", rng.gauss(0, 1)) for _ in range(700)] + [("b", float(rng.randrange(4))) for _ in range(500)] + [(None, rng.choice([-1, 1]) * 10.0 ** rng.uniform(-200, 200)) for _ in range(300)]
    rows += [("one", 4.25), ("none", None), ("nan", float("nan")), ("a", None), ("b", float("inf")), ("same", 2.0), ("same", 2.0), ("edge", -1.7e308), ("edge", 1.7e308), ("edge", 5e-324)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    monkeypatch.setattr("tidemark.functions.percentiles.BINS", 64)
    got = {r.g: tuple(r)[1:] for r in exact_percentiles(df, ["g"], "x", SHARES, few).collect()}
    clean = df.where("x is null or (not isnan(x) and abs(x) < double('inf'))")
    want = {r.g: tuple(r.p or [None] * 5) for r in clean.groupBy("g").agg(F.percentile("x", F.array(*map(F.lit, SHARES.values()))).alias("p")).collect()} | {"nan": (None,) * 5}
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12) if want[g][0] is not None else got[g] == want[g]


def test_percentiles_of_all_rows_and_of_none(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    for few in (0, 1_000_000):
        assert tuple(exact_percentiles(df, [], "x", {"a": 0.25, "b": 0.9995}, few).first()) == pytest.approx((250.0, 999.5))
        assert exact_percentiles(df.limit(0).withColumn("g", F.lit(1)), ["g"], "x", {"a": 0.5}, few).count() == 0
        assert tuple(exact_percentiles(df.limit(0), [], "x", {"a": 0.5}, few).first()) == (None,)
