import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.gates import DataGateError
from tidemark.operators import checks
from tidemark.operators import registry as R
from tidemark.operators.snapshot import Snapshot, gate_trials
from tidemark.sources import registry as A
from tidemark.sources import reports, store


def table(spark, folder, name, header, rows):
    (folder / f"{name}.txt").write_text("|".join(header) + "\n" + "\n".join("|".join(r) for r in rows) + "\n")
    return A.read_table(spark, f"file://{folder}", name)


def test_registry_jobs(spark, tmp_path):
    studies = table(
        spark, tmp_path, "studies",
        "nct_id study_type overall_status phase start_date number_of_arms completion_date why_stopped has_dmc brief_title official_title start_date_type".split(),
        [
            ["N1", "Interventional", "Completed", "Phase 2", "2015-01-01", "2", "2016-01-01", "", "t", "b1", '"A ""quoted""\ntitle"', "ACTUAL"],
            ["N2", "INTERVENTIONAL", "TERMINATED", "PHASE3", "2016-05-01", "x", "2016-09-01", "Low enrollment", "f", "b2", "", ""],
            ["N3", "INTERVENTIONAL", "RECRUITING", "PHASE1/PHASE2", "2024-01-01", "", "", "", "", "b3", "", ""],
            ["N4", "OBSERVATIONAL", "COMPLETED", "PHASE2", "2015-01-01", "", "2016-01-01", "", "", "b4", "", ""],
            ["N5", "INTERVENTIONAL", "COMPLETED", "PHASE4", "2015-01-01", "", "2016-01-01", "", "", "b5", "", ""],
            ["N6", "INTERVENTIONAL", "COMPLETED", "PHASE2", "2007-12-31", "", "2016-01-01", "", "", "b6", "", ""],
            ["N7", "INTERVENTIONAL", "WITHDRAWN", "PHASE2", "2015-01-01", "", "", "", "", "b7", "", ""],
        ],
    )
    designs = table(spark, tmp_path, "designs", "id nct_id allocation intervention_model primary_purpose masking".split(), [["1", "N1", "", "Single Group Assignment", "Treatment", "Double"]])
    sponsors = table(spark, tmp_path, "sponsors", "id nct_id agency_class lead_or_collaborator name".split(), [[str(k), f"N{k}", "Industry" if k % 2 else "NIH", "lead", "S"] for k in range(1, 8)] + [["9", "N1", "", "collaborator", "T"]])
    drugs = table(spark, tmp_path, "interventions", "id nct_id intervention_type name".split(), [[str(k), f"N{k}", "Drug", f"d{k}"] for k in range(1, 8)])
    snap = Snapshot(studies=studies, designs=designs, sponsors=sponsors, interventions=drugs)
    trials = snap.eligible()
    got = {r.nct_id: r for r in trials.collect()}
    assert {k: v.label for k, v in got.items()} == {"N1": 0, "N2": 1, "N3": None}
    assert got["N2"].stop_reason == "enrollment" and got["N1"].allocation == "NA" and got["N1"].sponsor_class == "INDUSTRY" and got["N2"].number_of_arms is None
    assert snap.drugs(trials).count() == 3
    assert sorted(r.nct_id for r in snap.ended().collect()) == ["N1", "N2", "N5", "N6"]
    assert snap.begun().count() == 5
    with pytest.raises(DataGateError, match="2 labeled"):
        gate_trials(trials, 100)
    assert studies.where("nct_id = 'N1'").first().official_title == 'A "quoted"\ntitle'
    countries = spark.createDataFrame([("N1", "France"), ("N1", "France"), ("N2", "United States")], "nct_id string, name string")
    elig = spark.createDataFrame([("N1", "Both", "18 Years", "N/A", "No", "Inclusion Criteria:~a~b")], "nct_id string, gender string, minimum_age string, maximum_age string, healthy_volunteers string, criteria string")
    cond = spark.createDataFrame([("N1", "Neoplasms"), ("N1", "Other")], "nct_id string, mesh_term string")
    party = spark.createDataFrame([("N1", "Sponsor-Investigator")], "nct_id string, responsible_party_type string")
    words = spark.createDataFrame([("N1", "b"), ("N1", "a")], "nct_id string, name string")
    told = spark.createDataFrame([("N1", "Good. It was halted.")], "nct_id string, description string")
    snap = Snapshot(studies=studies, sponsors=sponsors, countries=countries, eligibilities=elig, browse_conditions=cond, responsible_parties=party, keywords=words, brief_summaries=told)
    a = {r.nct_id: r for r in snap.attributes(trials).collect()}
    assert (a["N1"].n_countries, a["N1"].us_only, a["N1"].sex, a["N1"].criteria_count, a["N1"].area_neoplasms, a["N1"].n_collaborators, a["N1"].n_keywords) == (1, False, "ALL", 2, True, 1, 2)
    assert a["N2"].us_only is True and a["N3"].n_countries == 0 and a["N3"].area_blood is False
    text = {r.nct_id: r.text for r in snap.texts(trials).collect()}
    assert text["N1"].split("\n")[2:] == ["Good. ", "Inclusion Criteria: a b", "a, b"] and text["N2"] == "b2"


def zipped(path, reports_):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("r.json", json.dumps({"meta": {"x": [1]}, "results": reports_}))


def test_reports(spark, tmp_path):
    drug = lambda **k: {"drugcharacterization": "1", **k}
    zipped(tmp_path / "a.zip", [
        {"safetyreportid": "1", "safetyreportversion": "1", "receivedate": "20150101", "serious": "2", "patient": {"drug": [drug(medicinalproduct="Old 5 mg")]}},
        {"safetyreportid": "2", "receivedate": "00010101", "receiptdate": "20991231", "serious": "1", "seriousnessdeath": "1",
         "patient": {"drug": [drug(openfda={"substance_name": ["CISPLATIN", "CISPLATIN HYDROCHLORIDE"]}), {"activesubstance": {"activesubstancename": "Ondansetron"}}]}},
        {"safetyreportid": None, "patient": {"drug": [drug(medicinalproduct="z")]}},
        {"safetyreportid": "3", "patient": {"drug": None}},
    ])
    zipped(tmp_path / "b.zip", [{"safetyreportid": "1", "safetyreportversion": "2", "receivedate": "20160101", "serious": "1", "patient": {"drug": [drug(medicinalproduct="New")]}}])
    events = reports.build_drug_events(spark, f"file://{tmp_path}/*.zip")
    got = {(r.safetyreportid, r.substance): r for r in events.collect()}
    assert set(got) == {("1", "new"), ("2", "cisplatin"), ("2", "ondansetron")}
    assert got["2", "cisplatin"].harmonized and got["2", "ondansetron"].active_substance and not got["1", "new"].harmonized
    assert got["2", "cisplatin"].receivedate is None and str(got["1", "new"].receivedate) == "2016-01-01" and got["2", "cisplatin"].death
    assert sorted(r.substance for r in reports.vocabulary(events).collect()) == ["cisplatin", "ondansetron"]
    assert list(reports.items(io.StringIO('{"meta": 1, "results": [{"a": 1}, {"a": "]}"}]}'), chunk=3)) == [{"a": 1}, {"a": "]}"}]


def test_store(spark, tmp_path):
    out = f"file://{tmp_path}/t"
    store.publish(spark.range(3), out)
    store.publish(spark.range(5), out)
    assert spark.read.parquet(out).count() == 5 and not store.exists(spark, out + "__incoming")
    v = f"file://{tmp_path}/v"
    for version, n in (("v1", 2), ("v2", 3), ("v1", 4)):
        store.replace_version(spark.range(n).withColumn("model_version", F.lit(version)), v)
    assert {r.model_version: r["count"] for r in spark.read.parquet(v).groupBy("model_version").count().collect()} == {"v1": 4, "v2": 3}
    store.append(spark.range(1), f"file://{tmp_path}/e")
    store.append(spark.range(1).withColumn("more", F.lit(1)), f"file://{tmp_path}/e")
    assert store.read_evolved(spark, f"file://{tmp_path}/e").columns == ["id", "more"]
    store.point_to(spark, f"file://{tmp_path}/current.json", {"file": "x"})
    assert store.pointed_at(spark, f"file://{tmp_path}/current.json") == {"file": "x"}
    typed = store.typed(spark.createDataFrame([("a", "1", "x")], "NCT_ID string, Label string, other string"), "nct_id string, label int, phase string")
    assert typed.first().asDict() == {"nct_id": "a", "label": 1, "phase": None}


def test_load_stops_on_missing_and_empty_folders(spark, tmp_path):
    folder = f"file://{tmp_path}"
    with pytest.raises(DataGateError, match="missing"):
        store.load(spark, folder, {"RAW_TRIAL_TEXT": "text"})
    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "_SUCCESS").touch()
    with pytest.raises(DataGateError, match="empty"):
        store.load(spark, folder, {"RAW_TRIAL_TEXT": "text"})
    spark.createDataFrame([("N1", "x")], "NCT_ID string, text string").write.mode("overwrite").parquet(f"{folder}/text")
    store.load(spark, folder, {"RAW_TRIAL_TEXT": "text"})
    assert spark.table("RAW_TRIAL_TEXT").first().asDict() == {"nct_id": "N1", "text": "x"}


def test_archives_and_partitions(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("studies.txt", "x")
    assert [p.name for p in A.fetch(str(tmp_path / "a.zip"), str(tmp_path / "o"), ["studies"])] == ["studies.txt"]
    with pytest.raises(ValueError, match="designs"):
        A.fetch(str(tmp_path / "a.zip"), str(tmp_path / "o"), ["designs"])
    urls = ["h/2004q1/a.zip", "h/2004q2/b.zip", "h/other/c.zip"]
    assert A.select_partitions(urls, range(2004, 2005), {1}) == urls[:1] and A.share(urls, 1, 2) == [urls[1]] and A.not_yet(urls, {"a.zip"}) == urls[1:]
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return 7

    assert A.retried(flaky, sleep=lambda s: None) == 7


def test_checks(spark):
    spark.range(3).createOrReplaceTempView("t_checks")
    text = "-- only a comment;\n\n-- check: fine\nSELECT 1 FROM t_checks WHERE id < 0;\n-- check: bad\nSELECT id FROM t_checks;"
    assert checks.failed(spark, text)[0].startswith("bad: 3 rows")
    with pytest.raises(DataGateError):
        checks.gate(spark, text)
    with pytest.raises(ValueError):
        checks.named("SELECT 1;")
    nulls = spark.createDataFrame([(1,), (None,)], "k int")
    assert checks.missing(spark.range(3), "id", nulls, "k").count() == 0


def test_archive_features_keep_unknown_areas(spark):
    f = lambda cols, rows: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols.split()))
    t = {
        "studies": f("nct_id study_type overall_status phase start_month_year number_of_arms brief_title official_title why_stopped has_dmc", [("N1", "Interventional", "Completed", "Phase 2", "January 2015", "1", "b", "o", None, "Yes")]),
        "designs": f("nct_id allocation intervention_model primary_purpose masking subject_masked caregiver_masked investigator_masked outcomes_assessor_masked", [("N1", None, "Single Group Assignment", "Treatment", "Double Blind", "t", "t", "t", None)]),
        "sponsors": f("nct_id agency_class lead_or_collaborator name", [("N1", "U.S. Fed", "lead", "S")]),
        "countries": f("nct_id name", [("N1", "France")]),
        "eligibilities": f("nct_id gender minimum_age maximum_age healthy_volunteers criteria", [("N1", "Both", "1 Year", None, None, "- a~  b~ - c")]),
        "browse_conditions": f("nct_id mesh_term", [("N1", "Neoplasms")]),
        "responsible_parties": f("nct_id responsible_party_type", [("N1", "Sponsor")]),
        "keywords": f("nct_id name", [("N1", "k")]),
        "brief_summaries": f("nct_id description", [("N1", "d")]),
    }
    r = Snapshot(**t).features(spark.createDataFrame([("N1",)], "nct_id string"), "2017-01-01", R.unwrapped_criteria).first()
    assert (str(r.archive_start_date), r.masking, r.sponsor_class, r.area_neoplasms, r.criteria_count) == ("2015-01-31", "TRIPLE", "GOVERNMENT", None, 2)
