"""The text-corpus operators against libraries, brute force, SQL and odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import rows_of, rows_of_sql
from pyspark.sql import functions as F

from tidemark.llm import bwt, common, html, language, mixing, neardup_pq, ngram_join, pieces, registry, suffix_dedup, tokenstore, topk, toxicity

LONG = "the long text goes on. " * 8000
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, equal rows, and columns whose names operators use."""
    rows = [
        (1, "Hello there, this is plain text.", "en", "a", 32),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \t\n ", "de", "b", 4),
        (5, LONG, "en", "b", len(LONG)),
        (5, LONG, "en", "b", len(LONG)),
        (None, "no id here at all", "en", None, 17),
        (7, "日本語 😀 é ▁ <s> <|endoftext|>  two", "fr", "c", 30),
        (8, "Hello there, this is plain text.", "en", "a", 32),
    ]
    df = spark.createDataFrame(rows, DOC)
    for c in ("f", "n", "size", "spot", "k1", "comp", "ids", "text__", "lang_pred", "toxic_score", "others__"):
        df = df.withColumn(c, F.lit(7))
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def test_registry_matches_the_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(name, spark, duck, sample):
    assert rows_of(registry.QUERIES[name](spark, sample)) == rows_of_sql(duck, registry.SQL[name])


# 1 exact top-k


def brute_top(rows, k=5):
    q = {i: np.floor(256 * np.asarray(v, np.float64)).astype(np.int64) for i, v in rows}
    out = []
    for i in sorted(q):
        if i % 50 == 0:
            best = sorted((-int(q[i] @ q[j]), j) for j in q if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return out


def test_topk(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(160)]  # many ties
    bad = [(200, None), (250, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (300, [float("nan")] * 6), (350, [float("inf")] * 6), (400, [1.0]), (None, [1.0] * 6), (401, [])]
    df = spark.createDataFrame(rows + bad + rows[:2], "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    found = topk.scaled(df)
    got = sorted(map(tuple, topk.top_k(found, found.where("vec_id % 50 = 0")).collect()))
    # repeated rows are candidates like any other, so leave them to the distinct reading
    distinct = topk.scaled(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, topk.top_k(distinct, distinct.where("vec_id % 50 = 0")).collect())) == brute_top(rows)
    assert {g[0] for g in got} == {0, 50, 100, 150}
    monkeypatch.setattr(topk, "QUERY_BLOCK", 6)  # a block for each query or two
    assert sorted(map(tuple, topk.top_k(distinct, distinct.where("vec_id % 50 = 0")).collect())) == brute_top(rows)
    none = topk.scaled(df.limit(0))
    assert topk.top_k(none, none).count() == 0


# 2 toxicity


def test_toxicity_learns_stems_and_reads_clauses(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeo") for _ in range(rng.randint(2, 6))) for _ in range(200)]
    docs, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(40)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), "zorg" + rng.choice(["ak", "en", "isch", "o", "ul"]))
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    g = toxicity.train(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any(s.startswith("zorg") for s in g.stems)
    scored = {r.doc_id: r for r in toxicity.assess(d, g).collect()}
    assert all((scored[i].toxic_score >= 0.7) == bool(t) for i, t in labels)
    assert scored[0].toxic_clauses and not scored[1].toxic_clauses
    unseen = g.evidence("aa zorgnew bb zorgelse")[0]
    assert unseen > 0 and g.evidence("said aa not zorgnew")[0] < g.evidence("aa zorgnew")[0] < g.evidence("you zorgnew")[0]


def all_paths(machines, read):
    """The best accepted path when each machine reads, one after another, every string that the one before can write."""
    strings = [list(read)]
    for m in machines:
        after = []
        for string in strings:
            paths = [(m.start, [])]
            for symbol, value in string:
                paths = [(to, [*out, (y, value * f + c)]) for state, out in paths for to, y, f, c in m.arcs(state, symbol)]
            after += [out for state, out in paths if m.final(state)]
        strings = after
    return max((sum(v for _, v in out) for out in strings), default=0.0)


def test_composed_transducers_equal_all_paths_of_the_single_ones():
    rng = random.Random(12)
    single = [toxicity.negation(), toxicity.reported(), toxicity.threat(), toxicity.target()]
    table = toxicity.composed()
    for _ in range(1500):
        read = [(k, rng.choice([1.0, 2.5]) if k in (toxicity.INSULT, toxicity.THREATS) else 0.0) for k in rng.choices(range(8), [3, 4, 3, 2, 2, 1, 2, 2], k=rng.randint(0, 9))]
        read.append((toxicity.BREAK, 0.0))
        assert table.best(read) == pytest.approx(all_paths(single, read)), read


def test_toxicity_clauses():
    g = toxicity.Grammar({"zorg": 3.0})
    weigh = lambda text: g.evidence(text)[0]
    direct = weigh("you zorg")
    assert direct == 3.5 and weigh("zorg") == 3.0 and weigh("you are not a zorg") == 3.0 * 0.25 + 0.5
    for told in ('"you zorg" he said', "he said you zorg", "you zorg, he said", 'He said: "you zorg"', '"you zorg!" she wrote'):
        assert weigh(told) == pytest.approx(3.0 * 0.6 + 0.5), told
    assert weigh("He said so. You zorg!") == 3.5  # another sentence
    assert weigh("i will kill you") == 3.5 and weigh("will kill, you") == 0 and weigh("kill the process") == 0 and weigh("i will never kill you") == 0
    assert weigh("you zorg " + "aa " * 50_000 + "zorg") == 6.5 and weigh("zorg " * 100) == 12.0
    assert g.evidence("Fine. You zorg! Bye")[1] == ["You zorg"]


def brute_score(g, text):
    """A text's evidence by the single transducers, from words found anew."""
    total = 0.0
    for sentence in toxicity.SENTENCE.split(text or ""):
        read = [(toxicity.BREAK, 0.0) if w in ".!?…;:," else g._symbol(w) for w in toxicity.WORD_OR_BREAK.findall(sentence.lower())]
        if any(k in (toxicity.INSULT, toxicity.THREATS) for k, _ in read):
            total += min(12.0, toxicity.composed().best([*read, (toxicity.BREAK, 0.0)]))
    return total


def test_toxicity_query(spark, sample):
    """Held-out flags, learning without the held-out labels, scores against a plain reading, and quality on held-out rows."""
    rows = toxicity.op2_toxicity(spark, sample).collect()
    docs, labels = spark.read.parquet(f"{sample}/documents.parquet"), spark.read.parquet(f"{sample}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in rows)
    g = toxicity.train(docs, labels.where("pmod(crc32(cast(doc_id as string)), 3) <> 1"))
    assert all(r.score == pytest.approx(g.score(brute_score(g, texts[r.doc_id]))) for r in rows)


def test_toxicity_odd_rows(spark, odd, empty):
    g = toxicity.Grammar({"hell": 3.0})
    got = toxicity.assess(odd, g).collect()
    assert len(got) == 9 and all(0 <= r.toxic_score <= 1 for r in got)
    assert toxicity.assess(empty, g).count() == 0
    assert not toxicity.train(empty, spark.createDataFrame([], "doc_id long, toxic int")).stems


# 3 embedding near-duplicates


def test_neardup(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    rows = [base[i % 60] + (0 if i < 60 else 0.06) * rng.normal(size=16) for i in range(400)]
    rows += [rows[0]] * 3
    bad = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, None] * 8), (None, [1.0] * 16)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)] + bad, "vec_id long, embedding array<double>").withColumn("n_links", F.lit(0))
    got = {r.vec_id: r for r in neardup_pq.near_duplicates(df).collect()}
    u = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    links = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    total = sum(got[i].n_links for i in range(len(u)))
    assert total >= 0.9 * links.sum() and all(got[i].n_links <= links[i].sum() for i in range(len(u)))
    assert all(got[i].component_id <= i and got[i].kept == (got[i].component_id == i) for i in range(len(u)))
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (900, 901, 902, 903)) and got[None].kept
    assert neardup_pq.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("list_rows, flat", [(256, 1024), (16, 8)])
def test_neardup_recall_with_more_lists_than_probes(spark, monkeypatch, list_rows, flat):
    """35 lists of which 8 are probed, 576 pairs of centroids of halves of which 48 are: groups around 1,200 centres, some tight
    enough for balls, links from 0.9 up."""
    monkeypatch.setattr(neardup_pq, "LIST_ROWS", list_rows)
    monkeypatch.setattr(neardup_pq, "FLAT_LISTS", flat)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(1200, 64)) / 8
    spread = np.repeat(rng.choice([0.02, 0.1, 0.18, 0.26, 0.32], size=1200), 6)
    rows = np.concatenate([np.repeat(centre, 6, axis=0) + spread[:, None] * rng.normal(size=(7200, 64)) / 8, rng.normal(size=(1800, 64)) / 8])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in neardup_pq.near_duplicates(df).collect()}
    u = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    links = np.concatenate([(u[a : a + 1000] @ u.T >= 0.9).sum(1) - 1 for a in range(0, len(u), 1000)])
    found = np.array([got[i] for i in range(len(u))])
    assert len(u) // list_rows > 4 * neardup_pq.PROBES and (found <= links).all() and links.sum() > 10_000
    recall = found.sum() / links.sum()
    print(f"recall {recall:.4f} of {links.sum() // 2} links")
    assert recall >= 0.95


def test_neardup_lists_grow_with_the_table(monkeypatch):
    """Beyond the flat lists, what is fitted grows with the root of their number, and the nearest pair is found first."""
    monkeypatch.setattr(neardup_pq, "FLAT_LISTS", 8)
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(4000, 12))
    for lists in (64, 900):
        q = neardup_pq.Quantiser(sample, lists)
        a, b = q.halves
        assert len(a) == len(b) == math.isqrt(lists)
        whole = np.array([q.centre(k) for k in range(lists)])
        far = ((sample[:50, None, :] - whole[None]) ** 2).sum(2)
        got = q.near(sample[:50], 20)
        assert (np.take_along_axis(far, got, 1) == pytest.approx(np.sort(far, 1)[:, :20]))


def test_neardup_of_several_lengths(spark):
    rows = [(k, [1.0, 0.1 * (k % 2)] if k < 30 else [1.0, 0.0, 0.05 * (k % 2)]) for k in range(40)] + [(90, [7.0]), (91, [5.0]), (92, [0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in neardup_pq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert {got[k] for k in range(30)} == {(29, 0)} and {got[k] for k in range(30, 40)} == {(9, 30)}
    assert got[90] == got[91] == (1, 90) and got[92] == (0, 92)


# 4 pieces


def test_pieces_equal_the_library(spark, odd, empty):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    with open(pieces.default_model(), "rb") as f:
        mine = pieces.PieceEncoder(f.read())
    rng = random.Random(5)
    texts = ["".join(rng.choice(" ▁\t\nabehtionsrdl.,!éß日😀\x00　A1-_'") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", " ", " " * 70, "a" + " " * 33 + "b", "x" * 3000, "<unk><s></s>", "<0x41>", LONG]
    for t in texts:
        ids = mine.encode(t)
        assert ids.tolist() == own.encode(t) and mine.decode(ids) == own.decode(own.encode(t))
    odd_ids = np.array([3 + 0xE6, 3 + 0x97, 5000, 3 + 0xFF], np.int32)
    assert mine.decode(odd_ids).count("�") >= 1
    rows = pieces.tokenize(odd.select("doc_id", "text")).collect()
    assert sorted(len(r.ids) for r in rows) == sorted(len(own.encode(r.text or "")) for r in odd.collect())
    assert pieces.digests(pieces.tokenize(empty)).count() == 0


# 5 html


PAGE = '<html><head><title>T</title><script>var x="</p>";</script></head><body><nav><a>menu</a></nav><div class="ad">buy</div>{}<div id="comments"><p>first!</p></div><footer>&copy; x</footer></body></html>'


def test_html(spark):
    article = "<article><h1>A &amp; B</h1><p><b>one\n two<br>three<p>four</p><aside>side</aside></article>"
    assert html.main_text(PAGE.format(article)) == "A & B\none two three\nfour"
    assert html.main_text(PAGE.format("<p>a</p>text<p>b")) == "a\ntext\nb"
    assert html.main_text("<p>cut <b>off</b> he") == "cut off he" and html.main_text("a < b <p") == "a < b"
    assert [html.main_text(x) for x in (None, "", "<!-- only -->", "<p>&#x41;&nbsp;&lt;</p>")] == ["", "", "", "A <"]
    boiler = "<div class=x><p>the same on every page</p></div>"
    pages = [(i, f"http://h.example/{i}", f"<body>{boiler}<p>own text {i}</p></body>", "extra") for i in range(20)] + [(99, None, None, "extra"), (100, "http://o.example/", f"<body>{boiler}</body>", "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in html.extract(df).collect()}
    assert got[3] == "own text 3" and got[99] == "" and got[100] == "the same on every page"
    assert html.extract(df.limit(0)).count() == 0
    assert len(html.main_text("<div>" * 3000 + "deep")) == 4
    # an end tag behind any depth closes its own element, so what follows is outside the marked one
    deep = "<nav>" + "<div>" * 600 + "in" + "</div>" * 600 + "</nav><p>out</p>"
    assert html.main_text(deep) == "out" and html.main_text("<p>" + "long " * 100_000 + "</p>") == ("long " * 100_000).strip()
    twice = spark.createDataFrame(pages[:8] + pages[:8], "page_id long, url string, html string, host string")
    assert all(r.text == f"own text {r.page_id}" for r in html.extract(twice).collect())


def test_html_importance_decides_inside_and_outside_articles(spark):
    def page(i, more=""):
        own = f"<div class=story><p>body text {i} beside the teaser</p></div><article class=teaser><p>teaser {i}</p><div class=x>the same in every article</div></article>"
        rest = f"<article class=comment><p>remark {i}</p></article><nav>entry {i}</nav><div class=y>the same on every page</div>skip"
        return f"<body>{own}{rest}{more}</body>"

    pages = [(i, f"http://h.example/{i}", page(i)) for i in range(20)]
    pages += [(100 + i, f"http://side.example/{i}", f"<body><div class=sidebar><p>{f'long own text {i} ' * 20}</p></div><nav>entry {i}</nav></body>") for i in range(20)]
    pages += [(200, "http://small.example/", page(0)), *((300 + i, "http://one.example/", "<article><p>one</p></article>") for i in range(9))]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[3] == "body text 3 beside the teaser\nteaser 3"
    assert got[103] == ("long own text 3 " * 20).strip() and got[303] == "one"
    assert got[200] == "body text 0 beside the teaser\nteaser 0\nthe same in every article\nthe same on every page\nskip"


def brute_turned(pages):
    """For each host the style nodes that overrule the rules, by counting over its pages in plain Python."""
    hosts = defaultdict(list)
    for url, page in pages:
        hosts[url.split("/")[2]].append([(b[0], b[3]) for b in html.blocks(page)])
    out = {}
    for host, own in hosts.items():
        whole = sum(len(x) for page in own for _, x in page)
        out[host] = set()
        for path in {p for page in own for p, _ in page}:
            on = [[x for p, x in page if p == path] for page in own]
            on = [x for x in on if x]
            m, base = len(on), math.log(max(len(on), html.PRIOR_PAGES))
            texts = Counter(x for page in on for x in set(page))
            times = Counter(len(set(page)) for page in on)
            shared = sum(math.log(c) for c in texts.values()) / len(texts)
            style = (math.log(m) - sum(c * math.log(c) for c in times.values()) / m) / base
            if path.startswith("-"):
                turned = (math.log(m) - shared) / base >= html.HIGH and sum(len(x) for page in on for x in page) >= html.MASS * whole
            else:
                turned = max(1 - shared / base, style) < (html.LOW / 2 if path.startswith("+") else html.LOW)
            if turned:
                out[host].add(path)
    return out


def test_html_tree_equals_brute_force(spark):
    rng = random.Random(21)
    pages = []
    for h in range(8):
        kinds = [(rng.choice(["div class=a", "div class=sidebar", "section", "nav", "article", "footer"]), rng.random()) for _ in range(6)]
        for i in range(rng.choice([1, 2, 4, 6, 9, 20])):
            parts = []
            for k, (tag, common) in enumerate(kinds):
                for _ in range(rng.choice([0, 1, 1, 1, 2])):
                    own = f"block {k} of {h}" if rng.random() < common else f"own {rng.random()} " * rng.randint(1, 9)
                    parts.append(f"<{tag}><p>{own}</p></{tag.split()[0]}>")
            pages.append((f"http://h{h}.example/{i}", "<body>" + "".join(parts) + "</body>"))
    turned = brute_turned(pages)
    assert sum(p.startswith("-") for x in turned.values() for p in x) and sum(not p.startswith("-") for x in turned.values() for p in x)
    got = {r.url: r.text for r in html.extract(spark.createDataFrame(pages, "url string, html string")).collect()}
    changed = 0
    for url, page in pages:
        want = html.main_text(page, frozenset(turned[url.split("/")[2]]))
        changed += want != html.main_text(page)
        assert got[url] == want
    assert changed > 10


# 6 n-gram join


def brute_groups(rows, width, num, den):
    sets = {}
    for i, t in rows:
        words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or "")).replace("\t", " ").replace("\n", " ").split(" ") if w]
        sets[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("width, num, den", [(3, 9, 10), (5, 4, 5)])
def test_ngram_join(spark, width, num, den):
    rng = random.Random(6)
    word = ["w%d" % k for k in range(400)]
    rows = []
    for i in range(260):
        if i % 3 and rows:
            text = rng.choice(rows)[1].split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(word)
        else:
            text = [rng.choice(word) for _ in range(rng.choice([0, 1, 2, 4, 9, 20, 60, 150]))]
        rows.append((i, " ".join(text).upper() if i % 7 == 0 else " ".join(text)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), width, num, den).collect()}
    assert got == brute_groups(rows, width, num, den)


def test_ngram_join_takes_repeated_rows_once(spark, monkeypatch):
    """Many equal rows, many texts under one doc_id, and near copies beside them: the rows that blocks get do not grow with the copies."""
    words = [f"w{k}" for k in range(60)]
    near = [" ".join([*words[:k], "other", *words[k + 1 :]]) for k in range(0, 60, 20)]
    rows = [(5, " ".join(words))] * 20_000 + [(7, " ".join(words))] * 50 + [(9, t) for t in near] * 30 + [(None, near[0])] * 3 + [(11, "far away from all of these texts")] * 2
    seen = []
    verified = ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda grouped, *a: seen.append(grouped.groupBy("comp", "i", "j").count().agg(F.max("count")).first()[0]) or verified(grouped, *a))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = ngram_join.jaccard_components(df, 3, 8, 10).groupBy("doc_id", "component_id").count().collect()
    assert {(r.doc_id, r.component_id): r["count"] for r in got} == {(5, 5): 20_000, (7, 5): 50, (9, 5): 90, (None, None): 3, (11, 11): 2}
    assert seen == [4]


def test_ngram_join_odd_rows_and_small_blocks(spark, odd, empty, monkeypatch):
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(odd, 3, 9, 10).collect()), key=str)
    assert len(got) == 9 and (2, 0, 2) in got and (3, 0, 3) in got and (8, 4, 1) in got and [g for g in got if g[0] == 0][0][2] is None
    assert sum(g[0] == 5 and g[2] == 5 for g in got) == 2
    assert ngram_join.jaccard_components(empty, 3, 9, 10).count() == 0
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 3)
    monkeypatch.setattr(ngram_join, "IDS_SENT", 0)  # all joins by a shuffle
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(base[:30] + [f"x{i}"] + base[31:])) for i in range(14)]
    got = {r.component_id for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 8, 10).collect()}
    assert got == {0}


def test_candidates_of_a_signature_that_all_share(spark):
    """One signature of 3,000 ids over 16 tasks, next to rare ones: all ids are tied together, the others by theirs alone."""
    rows = [(i, [7, i << 20]) for i in range(3000)] + [(5000 + i, [1 << 50 | i // 2]) for i in range(100)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        edges = ngram_join._candidates(spark.createDataFrame(rows, "id long, signatures array<long>"))
        got = {r.id: r.comp for r in common.components(edges, "id", "low").collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: 0 for i in range(3000)} | {5000 + i: 5000 + i // 2 * 2 for i in range(100)}


# 7 token store


def test_token_store(spark, odd, empty, tmp_path):
    import tokenizers

    path = f"file://{tmp_path}/s"
    tokenstore.write_store(odd, path)
    own = tokenizers.Tokenizer.from_file(tokenstore.default_tokenizer())
    want, at = [], 0
    for r in sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = own.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, tokenstore.read_store(spark, path, digest=True).collect()), key=lambda r: r[1]) == want
    assert tokenstore.fetch(spark, path, 7)[0].tolist() == own.encode(odd.where("doc_id = 7").first().text, add_special_tokens=False).ids + [2]
    assert len(tokenstore.fetch(spark, path, 5)) == 2 and tokenstore.fetch(spark, path, 999) == []
    tokenstore.write_store(empty, f"file://{tmp_path}/e")
    assert tokenstore.read_store(spark, f"file://{tmp_path}/e").count() == 0


def test_token_store_checks_its_dictionary(spark, sample, tmp_path):
    path = f"file://{tmp_path}/d"
    tokenstore.write_store(spark.read.parquet(f"{sample}/documents.parquet").limit(60), path)
    row = spark.read.parquet(f"{path}/dictionary").first()
    spark.createDataFrame([(row.dict_id, b"other", row.dtype, row.end_id)], "dict_id string, dictionary binary, dtype string, end_id long").write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(ValueError, match="hash"):
        tokenstore.read_store(spark, path)


# 8 mixing


def test_mixing(spark, odd, empty):
    rows = [(i, "w " * (i % 9 + 1), "en", f"s{i % 4}" if i % 11 else None, 0) for i in range(600)] + [(600 + i, "w", "en", "tiny", 1) for i in range(3)]
    got = mixing.mix(spark.createDataFrame(rows, DOC)).collect()
    by = defaultdict(lambda: [0, 0, 0.0])
    for r in got:
        by[r.source][0] += r.size
        by[r.source][1] += r.size * r.copies
        by[r.source][2] = r.target
        assert r.copies <= 3
    assert all(v[2] <= 3 * v[0] + 1e-6 and abs(v[1] - v[2]) <= 9 for v in by.values())
    assert sum(v[2] for v in by.values()) == pytest.approx(sum(v[0] for v in by.values()), rel=1e-6)
    again = mixing.mix(spark.createDataFrame(rows[::-1], DOC).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    # rows without an id, with other texts of one size, and rows equal in all columns: a budget ends among them
    same = [(None, f"w{i} x", "en", "null ids", 0) for i in range(400)] + [(7, "a b c", "en", "equal", 0) for _ in range(400)] + [(i, "w " * 50, "en", "z", 0) for i in range(60)]
    for mixed in (mixing.mix(spark.createDataFrame(same, DOC)).collect(), mixing.mix(spark.createDataFrame(same, DOC).repartition(5)).collect()):
        for source, size in (("null ids", 2), ("equal", 3)):
            own = [r for r in mixed if r.source == source]
            assert len(own) == 400 and abs(sum(r.size * r.copies for r in own) - own[0].target) <= size / 2 and own[0].target % (400 * size) > 0
    assert mixing.take(spark.createDataFrame(same, DOC)).count() == sum(r.copies for r in mixed)
    o = {(r.doc_id, r.size, r.copies) for r in mixing.mix(odd).collect()}
    assert {(2, 0, 0)} <= {(a, b, 0) for a, b, _ in o} and mixing.mix(empty).count() == 0
    assert mixing.take(odd).columns == odd.columns
    assert mixing.take(spark.createDataFrame(rows, DOC)).count() == sum(r.copies for r in got)


# 9 repeated byte strings


def brute_runs(rows, span):
    """Maximal runs of bytes that a repeated string of ``span`` bytes covers, by id."""
    seen = defaultdict(int)
    for _, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - span + 1):
            seen[hash(b[p : p + span])] += 1
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        runs = out[i] = []
        for p in range(len(b) - span + 1):
            if seen[hash(b[p : p + span])] > 1:
                if runs and p <= runs[-1][1]:
                    runs[-1][1] = p + span
                else:
                    runs.append([p, p + span])
    return out


def brute_removed(rows, span, least_words=0):
    runs, out = brute_runs(rows, span), {}
    for i, t in rows:
        b = (t or "").encode()
        cut = [(x, y) for x, y in runs[i] if y - x >= 400 or len(b[x:y].split()) >= least_words]
        out[i] = b"".join(b[x:y] for x, y in zip([0, *(y for _, y in cut)], [*(x for x, _ in cut), len(b)]))
    return out


def test_interleave_refinement_finds_repeats():
    rng = random.Random(7)
    for _ in range(120):
        strings = [np.array([rng.randint(1, 3) for _ in range(rng.randint(1, 14))], np.uint16) for _ in range(rng.randint(1, 12))]
        depth, shards, first, k = rng.randint(1, 6), [], [0], 0
        while k < len(strings):
            n = rng.randint(1, 4)
            shards.append(bwt.Shard(strings[k : k + n]))
            k += n
            first.append(k)
        s, t, o = bwt.repeated(shards, depth)
        places = defaultdict(list)
        for i, x in enumerate(strings):
            for p in range(len(x) - depth + 1):
                places[tuple(x[p : p + depth].tolist())].append((i, p))
        assert {(first[a] + b, c) for a, b, c in zip(s.tolist(), t.tolist(), o.tolist())} == {x for v in places.values() if len(v) > 1 for x in v}


@pytest.mark.parametrize("hot, stretch", [(4096, 1 << 19), (2, 1 << 19), (4096, 50)])
def test_repeats(spark, hot, stretch, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
    rng = random.Random(8)
    word = ["ab", "ba", "aab", "é", "zz", "q", "x y"]
    base = ["".join(rng.choice(word) for _ in range(60)) for _ in range(6)]
    rows = []
    for i in range(110):
        u, v = rng.choice(base), rng.choice(base)
        k = rng.randint(0, len(u))
        edited = u[:k] + rng.choice(["", "!", "ZZ", v[rng.randint(0, len(v)) :]]) + u[k + rng.randint(0, 3) :]
        rows.append((i, rng.choice([edited, edited, "ab" * rng.randint(0, 60), "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))])))
    rows += [(500, None), (501, "")]
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 32, ["doc_id"], gram=8, block=8, hot=hot).collect()}
    assert got == brute_removed(rows, 32)
    # the same through the runs of shorter strings
    both = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 32, ["doc_id"], passage=18, gram=8, block=8, hot=hot)
    assert {r.doc_id: bytes(r.kept) for r in both.collect()} == got


def test_repeats_query_equals_brute_force(spark):
    """Every column of the query over 2.5 MB of documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs]
    long, short, kept = brute_runs(rows, 400), brute_runs(rows, suffix_dedup.PASSAGE), brute_removed(rows, 400)
    got = {r.doc_id: r for r in suffix_dedup.op9_suffix_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(rows) and sum(len(x) > 0 for x in long.values()) > 100
    for i, t in rows:
        b, r = (t or "").encode(), got[i]
        passages = sum(y - x for x, y in short[i] if y - x >= 400 or len(b[x:y].split()) >= 50)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_passage) == (len(b), len(b) - len(kept[i]), len(long[i]), hashlib.sha256(kept[i]).hexdigest(), passages)


def test_repeats_finds_passages_of_51_to_80_words(spark):
    rng = random.Random(17)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))
    rows, inside = [], {}
    for k in range(30):
        passage = prose(51 + k)
        for m in range(rng.randint(2, 4)):
            i = 10 * k + m
            before = prose(rng.randint(30, 90))
            rows.append((i, f"{before} {passage} {prose(rng.randint(30, 90))}"))
            inside[i] = passage
    rows += [(1000 + k, prose(150)) for k in range(30)]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), suffix_dedup.PASSAGE, ["doc_id"], least_words=50).collect()}
    caught = [inside[i] not in got[i].kept_text and got[i].n_bytes - len(got[i].kept) <= len(inside[i]) + 4 for i in inside]
    assert all(caught) and all(not got[1000 + k].starts for k in range(30))


def test_repeats_odd_rows(odd, empty):
    got = suffix_dedup.remove_repeats(odd).collect()
    assert len(got) == 9 and sum(len(r.kept) == 0 and r.n_bytes == len(LONG) for r in got) == 2
    assert suffix_dedup.remove_repeats(empty).count() == 0 and suffix_dedup.remove_repeats(empty, passage=200).count() == 0


# 10 language


def test_language(spark, sample, odd, empty):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    own = docs.where(language.remainder(5) != 0)
    got = language.identify(docs, language.train(own), ["doc_id", "lang"]).where(language.remainder(5) == 0).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)
    rows = language.identify(odd, language.train(own)).collect()
    assert len(rows) == 9 and all(0 <= r.lang_score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if not (r.text or "").strip()} == {"und"}
    none = language.train(empty)
    assert {r.lang_pred for r in language.identify(odd, none).collect()} == {"und"} and language.identify(empty, none).count() == 0


def test_language_samples_each_language(spark):
    pick = random.Random(3)
    words = {lang: ["".join(pick.choices(letters, k=5)) for _ in range(200)] for lang, letters in (("en", "abcdefghijklm"), ("rare", "αβγδεζηθικλμ"), ("one", "абвгдежзиклм"))}
    rows = [(i, " ".join(pick.choices(words[lang], k=40)), lang) for lang, n, at in (("en", 3000, 0), ("rare", 3, 5000), ("one", 1, 6000)) for i in range(at, at + n)]
    rows += [(7000, rows[0][1], "wrong"), (None, rows[1][1], "en"), (7001, "... 12", "none"), (7002, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df, sample_docs=100)
    assert model.languages == ["en", "one", "rare", "wrong"]
    got = language.identify(df, model).where("text is not null and lang in ('en', 'one', 'rare')").collect()
    wrong = [r.doc_id for r in got if r.lang_pred != r.lang and r.doc_id != 0]  # 0 is the text labelled wrong
    assert not wrong and all(r.lang_cover >= 0.3 for r in got)


def test_language_filter_tells_all_languages_of_a_gram():
    many = [f"l{k:03d}" for k in range(70)]  # more than one word of bits
    grams = [np.arange(k * 50, k * 50 + 50, dtype=np.uint64) for k in range(70)]
    f = language.LanguageFilter(many, grams)
    assert f.words == 2 and all(w < 0.05 for w in f.wrong)


# what they share


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (20, 21), (7, 7), (30, 29), (29, 31), (31, 30)], "a long, b long")
    assert {r.id: r.comp for r in common.components(edges).collect()} == {3: 3, 4: 3, 5: 3, 9: 3, 20: 20, 21: 20, 29: 29, 30: 29, 31: 29}
    path = spark.range(40).selectExpr("id as a", "id + 1 as b")
    assert {r.comp for r in common.components(path).collect()} == {0}
    assert common.components(edges.limit(0)).count() == 0




# the queries themselves, over whole tables


def schema_of(df):
    return {n: t for n, t in df.dtypes}


def test_queries_follow_their_contracts(spark, sample):
    import sentencepiece
    import tokenizers

    docs = {r.doc_id: r for r in spark.read.parquet(f"{sample}/documents.parquet").collect()}
    q = lambda name: registry.QUERIES[name](spark, sample)

    df = q("op4_sentencepiece")
    assert schema_of(df) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    own, sha = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model()), lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = {r.doc_id: r for r in df.collect()}
    assert set(got) == set(docs)
    for i, d in docs.items():
        ids = own.encode(d.text or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(own.decode(ids)))

    df = q("op7_token_store")
    assert schema_of(df) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    own, at, got = tokenizers.Tokenizer.from_file(tokenstore.default_tokenizer()), 0, {r.doc_id: r for r in df.collect()}
    for i in sorted(docs):
        ids = own.encode(docs[i].text or "", add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)

    df = q("op6_ngram_join")
    assert set(schema_of(df)) == {"doc_id", "n_shingles", "component_id"}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()} == brute_groups([(i, d.text) for i, d in docs.items()], 3, 9, 10)

    df = q("op10_language")
    assert schema_of(df) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    got = {r.doc_id: r for r in df.collect()}
    known = {d.lang for i, d in docs.items() if d.lang and zlib.crc32(str(i).encode()) % 5} | {"und"}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.lang_pred in known and 0 <= r.score <= 1 for i, r in got.items())
    assert all((got[i].lang_pred == "und") == (not any(c.isalpha() for c in d.text or "")) for i, d in docs.items())
    held = [i for i, r in got.items() if r.held_out and docs[i].lang and r.lang_pred != "und"]
    assert sum(got[i].lang_pred == docs[i].lang for i in held) >= 0.97 * len(held) > 20

    df, rows = q("op5_html"), {r.page_id: r for r in spark.read.parquet(f"{sample}/pages.parquet").collect()}
    assert schema_of(df) == {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}
    turned = brute_turned([(r.url, r.html) for r in rows.values()])
    for r in df.collect():
        assert r.url == rows[r.page_id].url and r.text == html.main_text(rows[r.page_id].html, frozenset(turned[r.url.split("/")[2].lower()])) and r.n_chars == len(r.text)

    df, vectors = q("op3_embedding_neardup"), {r.vec_id: r.embedding for r in spark.read.parquet(f"{sample}/embeddings.parquet").collect()}
    assert schema_of(df) == {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}
    keys = sorted(vectors)
    u = np.array([vectors[k] for k in keys], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.9).sum(1) - 1
    got = {r.vec_id: r for r in df.collect()}
    assert set(got) == set(vectors) and all(got[k].n_links <= n and got[k].kept == (got[k].component_id == k) for k, n in zip(keys, links)) and sum(got[k].n_links for k in keys) >= 0.9 * links.sum()


def test_beyond_the_broadcast_no_text_is_shuffled_for_its_signatures(spark, monkeypatch):
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[k % 60 : k % 60 + 30] + [f"own{k // 120}"])) for k in range(240)] + [(7, "another text under this id"), (None, "no id"), (500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    usual = sorted(map(tuple, ngram_join.jaccard_components(docs, 5, 4, 5).collect()), key=str)
    asked, found = [], ngram_join._signatures
    monkeypatch.setattr(ngram_join, "IDS_SENT", 10)
    monkeypatch.setattr(ngram_join, "_signatures", lambda docs, texts, *more: asked.append(texts) or found(docs, texts, *more))
    assert sorted(map(tuple, ngram_join.jaccard_components(docs, 5, 4, 5).collect()), key=str) == usual
    assert "Exchange" not in asked[0]._jdf.queryExecution().executedPlan().toString()


def test_signatures_of_one_text_alone_are_not_shuffled(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "PACKED", 500)  # a signature that is met again lies in different parcels
    rows = [(k, " ".join(f"a{k}x{j}" for j in range(120))) for k in range(200)]
    rows += [(1000 + k, " ".join(f"b{k // 2}x{j}" for j in range(120)) + f" end{k}") for k in range(200)]
    every = [(k, s) for (k, t) in rows for s in ngram_join.Parts(4, 5).signatures(ngram_join.ngram_sets(pa.array([t]), 5)[0]).view(np.int64).tolist()]
    many = Counter(s for _, s in every)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for grams in (400 * 117, 1 << 40):  # few buckets, and as many as there can be
        got = {(r.id, s) for r in ngram_join._signatures(docs, docs, 5, 4, 5, grams).collect() for s in r.signatures}
        assert {(k, s) for k, s in every if many[s] > 1} <= got <= set(every)
        alone = [e for e in every if many[e[1]] == 1]
        assert len(alone) > 1000 and len(got & set(alone)) < len(alone) / 8


def test_what_is_likely_wanted_holds_all_that_is_and_few_others(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    wanted = docs.where("doc_id < 1000").selectExpr("doc_id", "xxhash64(text) AS t")
    got = {r.doc_id for r in ngram_join._likely(docs, wanted).collect()}
    assert set(range(1000)) <= got and len(got) < 1000 + 3000 / 8


def test_training_a_language_drops_what_other_operators_hold(monkeypatch):
    from tidemark.llm import common, language

    gone = []
    monkeypatch.setattr(common, "_HELD", {"pieces": lambda: gone.append("pieces")})
    assert list(language._counted(iter([]))) == [] and gone == ["pieces"]
