"""Phrases, centroids and approximate neighbours against brute force and odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import staging
from tidemark.llm import ann, centroids, language, neardup_pq, ngram_join, phrases

VEC = "vec_id long, embedding array<float>, label int"

# 11 phrases


def brute_phrases(rows, least, within=100, reported=2000):
    """``rows`` of (text, lang), read plainly."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        many = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in many.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and 100 * a >= within * f[p[i:j]]:
                        gone.add(p[i:j])
        ranked = []
        for p, a in many.items():
            if p not in gone:
                score, k = min((floor(Fraction(1000 * a * total[lang], f[p[:k]] * f[p[k:]])), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(ranked)[:reported], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def made_texts(seed, many=300):
    rng = random.Random(seed)
    words = ["a", "B", "cc", "Dé", "e'", "ÀB", "\x85x", "日本"]
    marks = [". ", ", ", " ", " ", " ", "  ", "\t", "\n", "\r\n", "! ", "\x0b"]
    texts = []
    for _ in range(many):
        texts.append(("".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de", None, "und"])))
    fixed = "One two three four five. "
    return texts + [(fixed * 20, "en"), (None, "en"), ("", None), (" \t\n", "de"), ("x y " * 3, "fr")]


@pytest.mark.parametrize("least, within", [(3, 100), (12, 60)])
def test_phrases(spark, least, within, monkeypatch):
    if within < 100:  # as beyond the bounds
        monkeypatch.setattr(phrases, "WORDS_SENT", 0)
        monkeypatch.setattr(phrases, "PHRASES_SENT", 0)
    rows = made_texts(least)
    df = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    df = df.repartition(5).withColumns({c: F.lit(1) for c in ("n", "shard", "phrase", "word", "words")})
    got = sorted(map(tuple, phrases.collocations(df, least, within=within).collect()))
    assert got == brute_phrases(rows, least, within) and len(got) > 20


def test_phrases_of_texts_longer_than_a_shard(spark, monkeypatch):
    """Shards of a few positions, cut inside pieces and words' runs: every phrase over a border is counted once."""
    rows = made_texts(9, 60) + [("p q r s t u " * 200, "en"), ("word" * 50, "en")]
    whole = [shard for text, _ in rows for shard in _shards_of(text)]
    monkeypatch.setattr(phrases, "SHARD", 64)
    monkeypatch.setattr(phrases, "SLICE", 16)
    cut = [shard for text, _ in rows for shard in _shards_of(text)]
    assert len(cut) > len(whole)
    monkeypatch.setattr(phrases, "SHARD", 1 << 20)
    for least in (1, 5):
        assert _counted(cut, least) == _counted(whole, least)


def _shards_of(text):
    held = phrases.Positions()
    return [*held.add((text or "").encode()), *held.rest()]


def _counted(shards, least):
    """Phrases of two to five words by the bitmaps of shards."""
    out = Counter()
    for words, at, own in shards:
        ends, number, bits = phrases.bitmaps(at, len(words))
        assert all((x == y).all() for x, y in zip(phrases.unpack(phrases.pack(number, bits)), (number, bits)))
        shard = phrases.Shard(own, ends, number, bits)
        for last, prefix, number, bits in shard.branches():
            name = [(words[1 + k],) for k in last.tolist()]
            for _ in range(4):
                parent, last, count, (prefix, number, bits) = shard.extend(last, prefix, number, bits)
                name = [(*name[p], words[1 + w]) for p, w in zip(parent.tolist(), last.tolist())]
                out.update(dict(zip(name, count.tolist())))
    return {p: n for p, n in out.items() if n >= least}


def test_phrases_on_odd_tables(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None), ("", "en"), ("one", None)], "text string, lang string")).count() == 0
    long = "a b c. " * 60_000
    got = phrases.collocations(spark.createDataFrame([(long, None), (long, "und")], "text string, lang string"))
    assert [tuple(r) for r in got.collect()] == [("und", 1, "a b c", 120_000, 120_000, 120_000, 360_000, 3000)]
    with pytest.raises(ValueError):
        phrases.collocations(got, longest=6)


# 12 centroids


def brute_clusters(rows, many=16, rounds=3):
    kept = [(i, np.floor(64 * np.asarray(v, np.float32).astype(float)).astype(np.int64)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    seeds = sorted((i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", v.tolist()) for i, v in kept)[:many]
    centres = [np.array(s[2]) for s in seeds]

    def assign():
        return [min((int(((v - c) ** 2).sum()), k) for k, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for k in range(len(centres)):
            own = [v for (_, v), (_, c) in zip(kept, near) if c == k]
            if own:
                centres[k] = np.array([int(s) // len(own) for s in np.sum(own, axis=0)])
    near = assign()
    inertia = Counter()
    for d, k in near:
        inertia[k] += d
    sha = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centres]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), sha[k]) for (i, _), (d, k) in zip(kept, near)), key=str)


def vectors(seed, many, size=64):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=size).astype(np.float32).tolist()) for i in range(many)]


@pytest.mark.parametrize("many", [3, 16, 400])
def test_clusters(spark, many):
    rows = vectors(many, many)
    rows += [(1000 + i, rows[i % 3][1]) for i in range(200)]  # copies
    rows += [(5, rows[0][1]), (5, rows[1][1]), (None, rows[2][1]), (2000, None), (2001, [1.0] * 63), (2002, [float("nan")] * 64), (2003, [None] * 64), (2004, [float("inf")] * 64), (2005, []), (2006, [0.0] * 64)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VEC).withColumns({c: F.lit("x") for c in ("v", "n", "cluster")})
    got = sorted(map(tuple, centroids.clusters(df).collect()), key=str)
    assert got == brute_clusters(rows)


def test_clusters_keep_ties_and_empty_centroids(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(40)]  # two distinct vectors, sixteen centroids: most stay empty
    got = sorted(map(tuple, centroids.clusters(spark.createDataFrame([(i, v, 0) for i, v in rows], VEC)).collect()), key=str)
    assert got == brute_clusters(rows)
    assert centroids.clusters(spark.createDataFrame([], VEC)).count() == 0
    assert centroids.clusters(spark.createDataFrame([(1, [1e30] * 64, 0)], VEC)).count() == 0  # distances would pass 64 bits


# 13 approximate neighbours


def brute_near(rows, k):
    out = {}
    for i in sorted({i for i, _ in rows if i % 20 == 0}):
        q = np.asarray(next(v for j, v in rows if j == i), np.float32).astype(float)
        best = []
        for j, v in rows:
            v = np.asarray(v, np.float32).astype(float)
            if j != i and len(v) == len(q):
                best.append((-float(np.cumsum(q * v)[-1]), j))
        out[i] = sorted(best)[:k]
    return out


def test_neighbours_reach_the_calibrated_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 500)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 20)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 16))
    rows = [(i, (centres[i % 60] + 0.3 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(6000)]
    rows += [(6001 + i, rows[40][1]) for i in range(1500)]  # one vector many times: its leaf lies in several blocks
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VEC)
    good = ann.usable(df)
    found = ann.nearest(good, good.where("vec_id % 20 = 0")).collect()
    truth = brute_near(rows, 20)
    by = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        by[r.query_id].append((-r.score, r.vec_id))
        assert r["rank"] == len(by[r.query_id])
    assert by.keys() == truth.keys() and all(len(x) == 20 for x in by.values())
    assert all(x == sorted(x) for x in by.values())
    # of equal scores any row is as near: compare scores
    hit = sum(sum(s <= truth[q][-1][0] + 1e-12 for s, _ in by[q]) for q in truth)
    assert hit >= 0.9 * 20 * len(truth)
    exact = {(q, j): s for q in truth for s, j in truth[q]}
    assert all(exact.get((q, j), s) == pytest.approx(s, abs=1e-12) for q in by for s, j in by[q])


def test_neighbours_of_odd_rows(spark):
    rows = [(i, [float(i % 7 - 3), 1.0, float(i % 3)]) for i in range(90)]  # many ties; fewer leaves than asked
    other = [(100, [1.0, 2.0]), (120, [2.0, 1.0]), (121, [5.0, 5.0]), (140, [9.0])]  # rare lengths
    bad = [(160, None), (180, []), (200, [0.0, 0.0, 0.0]), (220, [float("nan"), 1.0, 1.0]), (240, [None, 1.0, 1.0]), (260, [float("inf"), 0.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, None) for i, v in rows + other + bad + rows[1:3]], VEC).withColumns({c: F.lit("x") for c in ("v", "size", "leaf", "score", "rank")})
    good = ann.usable(df)
    got = defaultdict(list)
    for r in sorted(ann.nearest(good, good.where("vec_id % 20 = 0"), recall=1.0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((-r.score, r.vec_id))
    truth = brute_near(rows + other + rows[1:3], 20)
    assert truth.pop(140) == [] and got == truth
    none = ann.usable(df.limit(0))
    assert ann.nearest(none, none).count() == 0
    assert ann.nearest(good, good.limit(0)).count() == 0


def test_only_results_stay_in_the_shared_folder(spark):
    """What an operator wrote in between is gone when it returns: one table is left of each."""
    words = [f"w{k}" for k in range(40)]
    docs = spark.createDataFrame([(k, " ".join(words[k % 3 : 30 + k % 7]), "en") for k in range(60)], "doc_id long, text string, lang string")
    rows = spark.createDataFrame([(i, v, 0) for i, v in vectors(4, 200)], VEC)
    good = ann.usable(rows)
    calls = {
        "phrases": lambda: phrases.collocations(docs, 5),
        "ngrams": lambda: ngram_join.jaccard_components(docs, 3, 8, 10),
        "near": lambda: neardup_pq.near_duplicates(rows),
        "clusters": lambda: centroids.clusters(rows),
        "ann": lambda: ann.nearest(good, good.where("vec_id % 20 = 0")),
    }
    folder = Path(staging.checkpoint_folder(spark).removeprefix("file://")) / "tidemark"
    for name, call in calls.items():
        before = set(folder.glob("*")) if folder.exists() else set()
        call().count()
        left = {p.name for p in set(folder.glob("*")) - before}
        assert len(left) == 1, (name, left)


# 10 the query against a plain reading: sets of strings in place of filters of hashes


def plain_grams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").replace("\0", " ").lower())
    kept = " " + re.sub(" +", " ", words).lstrip(" ")
    if not kept.strip():
        return []
    return [kept[i : i + language.GRAM] for i in range(len(kept) - language.GRAM + 1)]


def test_language_query_equals_a_plain_reading(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text", "lang", (language.remainder(5) == 0).alias("held")).collect()
    count, many = defaultdict(Counter), Counter()
    for d in docs:
        if not d.held and d.lang is not None and d.text is not None:
            count[d.lang].update(set(plain_grams(d.text)))
            many[d.lang] += 1
    sure = Counter()
    for lang, c in count.items():
        for g, n in c.items():
            if n > 1 or many[lang] < language.FEW_DOCS:
                sure[g] = max(sure[g], n / (many[lang] + language.FEW_DOCS))
    own = {}
    for lang, c in count.items():
        fits = [(-n, g) for g, n in c.items() if (n > 1 or many[lang] < language.FEW_DOCS) and n / many[lang] >= language.OWN_SHARE * sure[g]]
        own[lang] = {g for _, g in sorted(fits)[: language.GRAMS_KEPT]}
    got = {r.doc_id: r for r in language.op10_language(spark, sample).collect()}
    assert got.keys() == {d.doc_id for d in docs}
    for d in docs:
        grams = plain_grams(d.text)
        hits = {lang: sum(g in own[lang] for g in grams) for lang in sorted(own)}
        best = max(sorted(own), key=lambda k: hits[k]) if grams else "und"
        r = got[d.doc_id]
        assert r.held_out == d.held
        if grams and sorted(hits.values())[-2] < 0.9 * hits[best]:  # the filter's wrong hits may turn a draw
            assert r.lang_pred == best
            assert r.score == pytest.approx(hits[best] / sum(hits.values()) * len(grams) / (len(grams) + 1), abs=0.05)
        elif not grams:
            assert r.lang_pred == "und" or any(c.isalpha() for c in d.text)
