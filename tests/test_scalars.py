import re

import duckdb
import pytest
from conftest import rows_of, rows_of_sql
from pyspark.sql import functions as F

from tidemark import catalog
from tidemark.functions import names as N
from tidemark.functions import scalars as S
from tidemark.operators.registry import unwrapped_criteria


def one(spark, expression, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{k} string" for k in range(len(values))))
    return df.select(expression(*[F.col(f"c{k}") for k in range(len(values))]).alias("x")).first().x


@pytest.mark.parametrize(
    "text, reason",
    [
        ("Safety concerns", "safety"),
        ("Business decision; no safety concerns", "business"),
        ("Slow accrual", "enrollment"),
        ("Lack of efficacy", "efficacy"),
        ("", None),
        (None, None),
        ("Unknown cause", "other"),
        ("SAE in two subjects", "safety"),
    ],
)
def test_stop_reason(spark, text, reason):
    assert one(spark, S.stop_reason, text) == reason


def test_enums(spark):
    assert one(spark, S.enum, "Active, not recruiting") == "ACTIVE_NOT_RECRUITING"
    assert one(spark, S.enum, "Phase 1/Phase 2") == "PHASE1/PHASE2"
    assert one(spark, S.design_enum, "Parallel Assignment") == "PARALLEL"
    assert one(spark, S.design_enum, "N/A") == "NA"
    assert one(spark, S.masking_level, "Double Blind (Subject, Investigator)") == "DOUBLE"
    assert one(spark, S.masking_level, "None (Open Label)") == "NONE"
    assert one(spark, S.masking_level, "Participant, Investigator") == "DOUBLE"
    assert one(spark, lambda c: S.masking_level(c, F.lit(3)), "Double Blind") == "TRIPLE"
    assert [one(spark, S.truth, w) for w in ("t", "No", "Accepts Healthy Volunteers", "?", None)] == [True, False, True, None, None]
    assert [one(spark, S.years_of_age, w) for w in ("18 Years", "6 Months", "N/A", None)] == [18.0, 0.5, None, None]


def test_dates_and_ids(spark):
    assert str(one(spark, lambda c: S.start_date(None, c), "January 2015")) == "2015-01-31"
    assert str(one(spark, lambda c: S.start_date(None, c), "March 3, 2016")) == "2016-03-03"
    assert [one(spark, S.valid_date, d) for d in ("00010101", "20991231", "x", None)] == [None] * 4
    assert one(spark, S.registry_id, "nct 123") == "NCT00000123" and one(spark, S.registry_id, "none") == ""
    assert one(spark, S.archive_date, "a/20170101_export.zip") == "2017-01-01"
    with pytest.raises(Exception, match="no date"):
        one(spark, S.archive_date, "a/export.zip")


def test_text_rules(spark):
    assert one(spark, S.criteria_count, "Inclusion criteria:~ a~~b ~Exclusion Criteria") == 2
    assert one(spark, S.without_ending, "It ran. It was terminated early. Then more") == "It ran.  Then more"
    assert one(spark, S.without_ending, None) is None
    assert one(spark, unwrapped_criteria, "Inclusion criteria:~ - first line~   goes on~ - second") == "Inclusion criteria:~* first line goes on~* second"


def test_names(spark):
    for raw, clean in (("Cisplatin 75 mg/m2 IV infusion", "cisplatin"), ("ONDANSETRON HYDROCHLORIDE", "ondansetron"), ("IL-2", "il2"), ("S-malate salt", "salt"), ("X monohydrate 5", "x"), (None, "")):
        assert one(spark, N.normalize, raw) == clean
    assert one(spark, N.is_specific, "vitamin d nos") is False and one(spark, N.is_specific, "water") is False and one(spark, N.is_specific, "cisplatin") is True


def test_longest_phrase_wins(spark):
    names = spark.createDataFrame([("a", "folic acid and tea folic"), ("b", ""), ("c", None), ("d", "acid reflux")], "id string, name string")
    vocab = spark.createDataFrame([("folic acid",), ("folic",), ("tea",), ("acid",)], "substance string")
    assert sorted(map(tuple, N.match_phrases(names, vocab, "id", "name").collect())) == [("a", "folic"), ("a", "folic acid"), ("d", "acid")]


def test_phrases_of_five_words_are_found_if_they_are_asked_for(spark):
    names = spark.createDataFrame([("a", "one two three four five six")], "id string, name string")
    vocab = spark.createDataFrame([("one two three four five",), ("three four",)], "substance string")
    found = lambda **k: sorted(r.substance for r in N.match_phrases(names, vocab, "id", "name", **k).collect())
    assert found() == ["three four"] and found(longest=None) == found(longest=5) == ["one two three four five"]


def brute_phrases(text, vocabulary, shortest=4):
    words, out, i = [w for w in re.split("[^a-z]+", text.lower()) if w], set(), 0
    while i < len(words):
        two = " ".join(words[i : i + 2])
        if i + 1 < len(words) and two in vocabulary:
            out.add(two)
            i += 2
            continue
        if len(words[i]) >= shortest and words[i] in vocabulary:
            out.add(words[i])
        i += 1
    return out


def test_phrases_of_whole_texts_in_all_languages(spark, sample, tmp_path):
    vocabulary = {"that the", "that", "this", "with the", "with", "from", "the"}
    rows = [(1, "x " * 100 + "this", "en"), (2, "Käse with the that", "de"), (3, "from", None), (4, None, "en"), (5, "x " * 30_000 + "that the end", "fr"), (6, " ", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df.unionByName(spark.read.parquet(f"{sample}/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text", "lang")).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").collect()
    expected = {(r.doc_id, p) for r in docs for p in brute_phrases(r.text or "", vocabulary)}
    got = [tuple(r) for r in catalog.QUERIES["phrase_match"](spark, str(tmp_path)).collect()]
    assert {(1, "this"), (2, "with the"), (2, "that"), (3, "from"), (5, "that the")} <= set(got)
    assert len(got) == len(set(got)) and set(got) == expected


def test_scrub_of_all_languages_equals_sql(spark, tmp_path):
    texts = ["This goes. \u0130this stays? was", "Es war. this geht.", "th\u0130s. WAS~ja", "\u212awas. \u00e9this", None, "", "no end", "th\u0131s. \u017fwas. thi\u017f."]
    rows = [(i, t, (None, "de", "fr", "en")[i % 4]) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = rows_of(catalog.QUERIES["sentence_scrub"](spark, str(tmp_path)))
    assert len(got[1]) == len(texts) and got == rows_of_sql(con, catalog.SQL["sentence_scrub"])
    kept = {r.doc_id: r.k for r in spark.read.parquet(f"{tmp_path}/documents.parquet").select("doc_id", S.without_ending(F.col("text"), "(?:^|[^a-z0-9_])(?:was|this)(?:$|[^a-z0-9_])").alias("k")).collect()}
    assert kept[1] == "Es war. " and kept[2] == "th\u0130s. ja"
