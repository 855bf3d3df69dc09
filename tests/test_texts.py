"""Text components against a dense decomposition, windows, pooled and principal components."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.models import features


def dense(texts, known):
    terms = []
    for t in texts:
        words = re.findall(r"\b\w\w+\b", (t or "").lower())
        terms.append(Counter([*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]))
    df = Counter(x for c in terms for x in c)
    out = np.zeros((len(texts), len(known)))
    for i, c in enumerate(terms):
        for x, n in c.items():
            if x in known:
                out[i, known[x]] = (1 + math.log(n)) * (math.log((1 + len(texts)) / (1 + df[x])) + 1)
        size = np.linalg.norm(out[i])
        out[i] /= size or 1
    return out


def test_text_components_are_those_of_the_dense_matrix(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choice(words[: rng.choice([10, 30, 60])]) for _ in range(rng.randint(1, 50))) for _ in range(250)] + [None, "", "only unknown here"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(5)
    t = features.TextComponents(components=6, min_df=3, terms=200).fit(df)
    assert 100 < len(t.known) <= 200
    a = dense(texts, t.known)
    _, values, v = np.linalg.svd(a)
    assert t.values == pytest.approx(values[:6], rel=1e-6)
    assert np.abs((t.v * v[:6].T).sum(0)) == pytest.approx(np.ones(6), abs=1e-6)
    got = {r.id: [r[f"txt_{k}"] for k in range(6)] for r in t.transform(df).collect()}
    assert np.array([got[i] for i in range(len(texts))]) == pytest.approx(a @ t.v, abs=1e-9)
    again = features.TextComponents(components=6, min_df=3, terms=200).fit(df.orderBy("text").coalesce(1))
    order = [again.known[x] for x in t.known]
    assert again.v[order] == pytest.approx(t.v, abs=1e-5)


def test_rows_that_span_less_than_is_asked(spark):
    df = spark.createDataFrame([("aa bb",), ("aa bb",), ("cc dd",)] * 3, "text string")
    t = features.TextComponents(components=5, min_df=1, terms=50).fit(df)
    assert t.v.shape[0] == 6 and t.values[:2] == pytest.approx([math.sqrt(6), math.sqrt(3)]) and all(x < 1e-6 for x in t.values[2:])


def test_windows_and_principal_components(spark):
    assert features.windows(list(range(10)), 4, 2) == [[0, 1, 2, 3], [4, 5, 6, 7]] and features.windows([], 4) == []
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 2)) @ np.array([[3.0, 0, 1, 0], [0, 1.0, 0, 0]]) + 0.01 * rng.normal(size=(300, 4))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, v array<float>")
    _, out = features.components_of(df, "v", 2)
    got = np.array([[r.emb_0, r.emb_1] for r in out.orderBy("id").collect()])
    _, _, axes = np.linalg.svd(x - x.mean(0))
    assert np.abs(got) == pytest.approx(np.abs(x @ axes[:2].T), abs=1e-3)


def test_a_pass_over_the_rows_hands_on_as_many_sums_as_tasks_run_at_once(spark):
    rng = np.random.default_rng(3)
    held = [np.sort(rng.choice(100, rng.integers(1, 20), replace=False)).astype(np.int32) for _ in range(300)]
    weights = [rng.normal(size=len(x)) for x in held]
    rows = spark.createDataFrame([(bytearray(t.tobytes()), bytearray(w.tobytes())) for t, w in zip(held, weights)], "term binary, weight binary").repartition(40)
    a = np.zeros((300, 100))
    for i, (t, w) in enumerate(zip(held, weights)):
        a[i, t] = w
    block = rng.normal(size=(100, 3))
    spark.sparkContext.setJobGroup("passes", "")
    assert features._gram_times(rows.localCheckpoint(), block) == pytest.approx(a.T @ a @ block)
    told = spark.sparkContext.statusTracker()
    last = told.getJobInfo(max(told.getJobIdsForGroup("passes")))
    assert max(told.getStageInfo(k).numTasks for k in last.stageIds) < 40
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_terms_are_counted_in_batches_as_one_by_one():
    texts = [["aa", "bb", "aa", "bb"], [], ["bb"], ["aa", "bb", "cc"], ["cc"], ["dd", "aa"]]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.string()))], ["w"]) for x in (texts[:3], texts[3:])]
    got = pa.Table.from_batches(features.counted_terms(batches)).to_pylist()
    every = [[*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))] for w in texts]
    n, df = Counter(t for x in every for t in x), Counter(t for x in every for t in set(x))
    assert {r["term"]: (r["n"], r["df"]) for r in got} == {t: (n[t], df[t]) for t in n} and len(got) == len(n)
    row, term = features.Vocabulary(["bb", "aa bb", "cc"]).found(texts)
    assert Counter(zip(row.tolist(), term.tolist())) == Counter((i, k) for i, x in enumerate(every) for t in x for k, y in enumerate(["bb", "aa bb", "cc"]) if t == y)
