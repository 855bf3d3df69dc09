"""The corpus pipeline's stages, each against a plain reading of its input."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_llm import DOC, brute_groups, brute_removed

import corpus_pipeline as P
from tidemark.llm import pieces
from tidemark.llm.common import staged

PROSE = {"en": "the and of that with this from have were which", "de": "der die und nicht mit sich auch eine sein werden"}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "de"
        text = " ".join(rng.choice(PROSE[lang].split()) + rng.choice(["", "s", "er", "ing"]) for _ in range(120))
        rows.append((i, text, lang, f"s{i % 3}", len(text)))
    rows += [(100, rows[1][1] + " tail", "en", "s1", 1), (101, rows[1][1], "en", "s2", 1), (102, "1234 5678 !!", None, "s0", 12), (103, None, None, None, None), (104, "   ", "en", "s0", 3)]
    shared = " ".join(f"passage{k}" for k in range(60))
    rows += [(110 + k, f"{rows[2 + k][1]} {shared} {rows[20 + k][1]}", "en", "s0", 1) for k in range(3)]
    return spark.createDataFrame(rows, DOC).withColumn("extra", F.lit("kept")).withColumn("n", F.col("doc_id"))


def test_stages(spark, docs):
    names = [n for n, _ in P.STAGES]
    assert names == ["language", "near_duplicates", "repeats", "mixing", "pieces"]
    now = docs
    for name, stage in P.STAGES:
        before = now.collect()
        now = staged(stage(spark, now, ""), f"test-{name}")
        after = now.collect()
        if name != "pieces":
            assert now.columns == docs.columns and all(r.extra == "kept" for r in after)
        ids = {r.doc_id for r in after}
        if name == "language":
            assert {r.doc_id for r in before} - ids == {102, 103, 104}
        elif name == "near_duplicates":
            assert ids == {c for _, c in brute_groups([(r.doc_id, r.text) for r in before], 5, 4, 5).values()} and len(after) == len(ids)
        elif name == "repeats":
            want = brute_removed([(r.doc_id, r.text) for r in before], 200, 50)
            assert 110 not in want or b"passage30" not in want[110]
            assert {r.doc_id: r.text for r in after} == {i: b.decode("utf-8", "ignore") for i, b in want.items()}
            assert all(r.n_chars == len(r.text) for r in after if r.doc_id >= 110)
        elif name == "mixing":
            times = Counter(r.doc_id for r in after)
            size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in before}
            target, per = brute_targets([(r.source, size[r.doc_id]) for r in before]), defaultdict(list)
            for r in before:
                per[r.source].append(r.doc_id)
            for source, own in per.items():
                taken = sum(size[i] * times[i] for i in own)
                assert abs(taken - target[source]) <= max(size[i] for i in own) / 2 + 1e-6, source
                assert all(times[i] - int(target[source] // sum(size[j] for j in own)) in (0, 1) for i in own)
            assert ids <= set(size) and all({r.text for r in after if r.doc_id == i} <= {r.text for r in before if r.doc_id == i} for i in ids)
        else:
            own = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
            want = Counter()
            for r in before:
                got = own.encode(r.text)
                digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
                want[r.doc_id, r.source, len(got), digest(",".join(map(str, got))), digest(own.decode(got))] += 1
            assert Counter((r.doc_id, r.source, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in after) == want


def brute_targets(rows):
    """Targets of sources by refilling: weights 5, 2, 1 in turn, none above 3 times its size."""
    size = defaultdict(int)
    for source, n in rows:
        size[source] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, free = {}, float(sum(size.values())), set(order)
    while free:
        share = left / sum(weight[s] for s in free)
        full = {s for s in free if share * weight[s] >= 3 * size[s]}
        if not full:
            return target | {s: share * weight[s] for s in free}
        for s in full:
            target[s] = 3.0 * size[s]
            left -= target[s]
        free -= full
    return target


def test_stages_take_odd_rows(spark, docs):
    """Rows without doc_id, repeated rows, a very long text, nulls in every column, and columns with the stages' inner names."""
    long = "the of and that with this from have were which " * 20_000
    rows = [(900, long, "en", "s0", len(long)), (None, "that with this from have were which the and of it", "en", "s1", 9), (None, "that with this from have were which the and of it", "en", "s1", 9), (901, "the and of that with", "en", None, None), (901, "the and of that with", "en", None, None), (None, None, None, None, None)]
    odd = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(rows, DOC))
    for c in ("others__", "gone__", "often__", "time__", "spot__", "starts", "kept_text", "n_bytes", "k1", "comp", "f", "size", "lang_pred", "extra", "n"):
        odd = odd.withColumn(c, F.lit(7))
    now = odd
    for name, stage in P.STAGES:
        now = staged(stage(spark, now, ""), f"odd-{name}")
        if name != "pieces":
            assert now.columns == odd.columns and all(r.others__ == r.comp == r.often__ == 7 for r in now.collect())
        ids = Counter(r.doc_id for r in now.collect())
        if name == "language":
            assert ids[None] == 2 and ids[901] == 2 and ids[900] == 1
        if name == "near_duplicates":
            assert ids[None] == 2 and ids[901] == 1 and ids[900] == 1
        if name == "repeats":
            assert now.where("doc_id = 900").first().text == ""  # it repeats itself
    assert now.count() > 0


def test_stages_take_an_empty_table(spark, docs):
    now = docs.limit(0)
    for name, stage in P.STAGES:
        now = staged(stage(spark, now, ""), f"none-{name}")
        assert now.count() == 0


def test_run(spark, sample):
    assert P.run(spark, sample).count() > 0 and P.ORACLE_SQL is None


def test_many_ids_that_go_shuffle_no_text(spark, monkeypatch):
    monkeypatch.setattr(P, "IDS_SENT", 100)
    docs = spark.range(-3000, 3000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "id AS word__").unionByName(spark.createDataFrame([(None, "no id", 0)], "doc_id long, text string, word__ long"))
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for gone, shuffled in ((spark.range(-3000, 3000).where("id % 3 = 0"), False), (spark.range(0, 3000).selectExpr("id * 1000003 AS id"), True)):
            kept = P._without(docs, gone.withColumnRenamed("id", "gone__"), "gone__")
            lost = {r.id for r in gone.collect()}
            assert sorted(map(tuple, kept.collect()), key=str) == sorted((tuple(r) for r in docs.collect() if r.doc_id not in lost), key=str)
            assert ("SortMergeJoin" in kept._jdf.queryExecution().executedPlan().toString()) == shuffled
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
