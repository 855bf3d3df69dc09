"""Toxicity by a weighted finite-state pattern grammar over clauses."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from tidemark.llm.common import arrow_map, drop_staged, only, staged, table, unused
from tidemark.llm.transducers import Table, Transducer

#: Training reads about so many labelled documents, spread by a hash of doc_id, whole texts each.
SAMPLE_DOCS = 20_000
#: Stems of the learned lexicon; the strongest are kept.
STEMS_KEPT = 4_000
#: Stems of toxic documents, the most frequent first, that are counted in the others.
CANDIDATES = 100_000
#: Shortest stem; a word's stems are its starts of this length up to the whole word, at most ``LONGEST``.
SHORTEST, LONGEST = 4, 14
#: A stem enters the lexicon if it is in as many toxic documents at least, and so many times likelier there.
LEAST_DOCS, LEAST_RATIO = 3, 8.0
#: The likelihood ratio counts as this many standard errors less; and the stem must stand behind as many different words, as a
#: share of the toxic documents.
Z, LEAST_SPREAD = 1.64, 0.006
ROWS = 128

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
#: A sentence goes on behind a closing quote if a small letter follows: "...!" he said. Clauses within it part at these signs.
SENTENCE = re.compile(r"[.!?…]++(?![\"”»“'’]\s*,?\s*[a-zß-öø-ÿ])|\n+")
WORD_OR_BREAK = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?…;:]|,(?=[\s\"”»“'’])")
# Closed word classes of the grammar, by language: en, de, fr, es.
TARGET = frozenset(
    "you your yours yourself ur u they them those these he she him her his people du dich dir dein deine ihr euch sie ihm tu toi te ton ta vous votre vos lui eux ils elles tú ti tus usted ustedes él ella ellos ellas vosotros".split()
)
NEGATION = frozenset("not no never isn't aren't wasn't weren't don't doesn't didn't won't can't cannot nobody nor without hardly nicht kein keine keinen nie niemals niemand ohne ne pas jamais aucun aucune sans nunca jamás sin ningún ninguna nadie".split())
REPORT = frozenset(
    "said says say called calls quote quoted wrote claimed reported according alleged word term sagte sagt nannte schrieb behauptet laut zufolge dit disait écrit appelé selon dijo dice llamó escribió según".split()
)
THREAT = frozenset("kill murder hurt stab shoot burn hang strangle destroy beat smash rape töten umbringen erschießen schlagen tuer frapper brûler égorger matar golpear quemar degollar die sterben mourir morir".split())
INTENT = frozenset("will gonna shall going must should want hope i'll we'll werde werden wirst soll vais va allons veux espère voy vamos quiero espero deberías deserve deserves".split())

# Word classes; BREAK stands between clauses and behind the last.
OTHER, INSULT, THREATS, TARGETS, NEGATES, REPORTS, INTENTS, BREAK = range(8)
#: Words that a negation covers; value factors under a negation and in reported speech; what a target adds; a threat's value; the
#: most that a sentence counts.
REACH = 3
FLIPPED, REPORTED, AIMED, THREATENED, MOST = 0.25, 0.6, 0.5, 3.0, 12.0


def negation() -> Transducer:
    """Up to ``REACH`` words behind a negation an insult counts ``FLIPPED`` and a threat not at all. State: words still covered."""

    def arcs(left: int, symbol: int) -> list:
        if symbol in (BREAK, NEGATES):
            return [(REACH if symbol == NEGATES else 0, symbol, 1.0, 0.0)]
        after = max(0, left - 1)
        if left and symbol == INSULT:
            return [(after, INSULT, FLIPPED, 0.0)]
        if left and symbol == THREATS:
            return [(after, OTHER, 0.0, 0.0)]
        return [(after, symbol, 1.0, 0.0)]

    return Transducer(0, arcs)


def reported() -> Transducer:
    """In a sentence with a verb of report, on whichever side, insults and threats count ``REPORTED``.

    From the start a path may suppose that the verb is still to come (``guess``); it is accepted only if it does come. A path
    that has read an insult as the writer's own (``own``) dies at such a verb.
    """

    def arcs(state: str, symbol: int) -> list:
        hostile = symbol in (INSULT, THREATS)
        if state == "start" and symbol != REPORTS:
            return [("own" if hostile else "start", symbol, 1.0, 0.0), ("guess", symbol, REPORTED if hostile else 1.0, 0.0)]
        if state == "own":
            return [] if symbol == REPORTS else [("own", symbol, 1.0, 0.0)]
        return [("told" if symbol == REPORTS else state, symbol, REPORTED if hostile else 1.0, 0.0)]

    return Transducer("start", arcs, lambda state: state != "guess")


def threat() -> Transducer:
    """A threat counts once a clause, if the clause has an intent, and a target or an insult, before or behind it.

    A path either leaves a threat out or counts it; one that counts it dies at the end of a clause without the rest. State:
    intent seen, target or insult seen, threat counted.
    """

    def arcs(state: tuple, symbol: int) -> list:
        intent, aimed, counted = state
        if symbol == BREAK:
            return [] if counted and not (intent and aimed) else [((False, False, False), BREAK, 1.0, 0.0)]
        if symbol == THREATS:
            out = [(state, OTHER, 0.0, 0.0)]
            return out if counted else [*out, ((intent, aimed, True), THREATS, 1.0, 0.0)]
        return [((intent or symbol == INTENTS, aimed or symbol in (TARGETS, INSULT), counted), symbol, 1.0, 0.0)]

    return Transducer((False, False, False), arcs)


def target() -> Transducer:
    """A clause with an insult or a counted threat and a target gets ``AIMED`` more. State: hit, target seen."""

    def arcs(state: tuple, symbol: int) -> list:
        hit, aimed = state
        if symbol == BREAK:
            return [((False, False), BREAK, 1.0, AIMED if hit and aimed else 0.0)]
        return [((hit or symbol in (INSULT, THREATS), aimed or symbol == TARGETS), symbol, 1.0, 0.0)]

    return Transducer((False, False), arcs)


def composed() -> Table:
    """The table of all transducers after one another; which word is what the insult transducer, ``Grammar.symbol``, decides."""
    return Table(target().after(threat().after(reported().after(negation()))), range(8))


class Grammar:
    """The lexicon of weighted stems and the score of a text: a logistic function of the sum of its sentences' weights.

    ``stems`` maps a word's start, or a whole word closed by "$", to its weight; the longest that fits counts. A sentence's
    weight is that of the best path through the composed transducers.
    """

    def __init__(self, stems: dict[str, float], bias: float = -3.0, slope: float = 1.0):
        self.stems, self.bias, self.slope = stems, bias, slope
        self.table = composed()
        self.words: dict[str, tuple[int, float]] = {x: (BREAK, 0.0) for x in ".!?…;:,"}

    def symbol(self, word: str) -> tuple[int, float]:
        found = self.words.get(word)
        if found is None:
            found = self._symbol(word)
            if len(self.words) >= 300_000:
                self.words = {x: (BREAK, 0.0) for x in ".!?…;:,"}
            if len(word) <= 40:
                self.words[word] = found
        return found

    def _symbol(self, word: str) -> tuple[int, float]:
        w = self.stems.get(word[: LONGEST + 1] + "$")
        for n in range(min(len(word), LONGEST), SHORTEST - 1, -1):
            if w is not None:
                break
            w = self.stems.get(word[:n])
        if w is not None:
            return INSULT, w
        for symbol, own in ((NEGATES, NEGATION), (THREATS, THREAT), (REPORTS, REPORT), (TARGETS, TARGET), (INTENTS, INTENT)):
            if word in own:
                return symbol, THREATENED if symbol == THREATS else 0.0
        return OTHER, 0.0

    def evidence(self, text: str | None) -> tuple[float, list[str]]:
        """Sum of the weights of the matched sentences, and those sentences."""
        total, spans = 0.0, []
        for sentence in SENTENCE.split(text or ""):
            symbols, telling, quiet = [], False, 0
            for word in WORD_OR_BREAK.findall(sentence.lower()):
                s = self.words.get(word) or self.symbol(word)
                if s[0] == OTHER:
                    quiet += 1
                    if quiet > REACH:
                        continue  # no state tells longer runs of such words apart
                else:
                    quiet = 0
                    telling = telling or s[0] == INSULT or s[0] == THREATS
                symbols.append(s)
            if telling:
                weight = min(MOST, self.table.best([*symbols, (BREAK, 0.0)]))
                if weight > 0:
                    total += weight
                    spans.append(sentence.strip())
        return total, spans

    def score(self, evidence: float) -> float:
        x = self.bias + self.slope * evidence
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def _stems(word: str) -> list[str]:
    """The starts of a word that may be learned, and the word itself."""
    return [word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1)] + [word[: LONGEST + 1] + "$"]


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, stems_kept: int = STEMS_KEPT) -> Grammar:
    """A grammar learned from ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic 0/1; null labels are left out).

    Fitted on about ``sample_docs`` labelled documents chosen by a hash of doc_id, at most twice as many; their labels are
    broadcast and their texts written once. Stems are counted by document within each task, then over all: in the toxic ones
    first, in the others only those that are candidates. At most ``CANDIDATES`` stems, and two numbers a row of the sample for
    the logistic fit, come to the driver.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", (F.col("toxic") > 0).alias("toxic"))
    n = known.count()
    share = 1.0 if n <= sample_docs else sample_docs / n
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int(share * (1 << 32))).limit(2 * sample_docs)
    sample = staged(docs.where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "labelled")
    size = {bool(r.toxic): r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = size.get(True, 0), size.get(False, 0)
    if not bad:
        drop_staged(sample)
        return Grammar({})
    spark = docs.sparkSession

    def counted(rows: DataFrame, only: frozenset[str] | None) -> DataFrame:
        sent = spark.sparkContext.broadcast(only)

        def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted = sent.value
            seen: dict[str, int] = {}
            parts: dict[str, list[str]] = {}
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    own: set[str] = set()
                    for word in set(WORD.findall(text.lower())):
                        stems = parts.get(word)
                        if stems is None:
                            if len(parts) > 200_000:
                                parts.clear()
                            stems = parts[word] = [x for x in _stems(word) if wanted is None or x in wanted]
                        own.update(stems)
                    for stem in own:
                        seen[stem] = seen.get(stem, 0) + 1
                    if len(seen) > 500_000:
                        yield _counts(seen)
                        seen = {}
            if seen:
                yield _counts(seen)

        return arrow_map(rows.select("text"), count, "stem string, n bigint").groupBy("stem").agg(F.sum("n").alias("n"))

    frequent = counted(sample.where("toxic"), None).where(F.col("n") >= LEAST_DOCS)
    in_bad = {r.stem: r.n for r in frequent.orderBy(F.desc("n"), "stem").limit(CANDIDATES).collect()}
    in_good = {r.stem: r.n for r in counted(sample.where("not toxic"), frozenset(in_bad)).collect()}
    sure = {}
    for stem, x in in_bad.items():
        x, y = x + 0.5, in_good.get(stem, 0) + 0.5
        w = math.log(x / (bad + 1.0)) - math.log(y / (good + 1.0)) - Z * math.sqrt(1 / x + 1 / y)
        if w >= math.log(LEAST_RATIO):
            sure[stem] = w
    best = dict(sorted(sure.items(), key=lambda x: (-x[1], x[0]))[:stems_kept])
    sent = spark.sparkContext.broadcast(frozenset(best))

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            found: set[tuple[str, int]] = set()
            for text in batch.column(0).to_pylist():
                before = ""
                for word in WORD.findall(text.lower()):
                    for stem in _stems(word):
                        if stem in sent.value:
                            found.add((stem, xxhash.xxh3_64_intdigest(before) >> 1))
                    before = word
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int64())], ["stem", "place"])

    # copies of one document put a word behind the same word; an insult stands behind many
    spread = arrow_map(sample.where("toxic").select("text"), places, "stem string, place bigint").groupBy("stem").agg(F.count_distinct("place").alias("n"))
    least = max(LEAST_DOCS, math.ceil(LEAST_SPREAD * bad))
    stems = {r.stem: min(6.0, best[r.stem]) for r in spread.where(F.col("n") >= least).collect()}
    for stem in [s for s in stems if not s.endswith("$")]:  # a longer stem that says no more than a shorter one goes
        if any(stems.get(stem[:n], -1.0) >= stems[stem] - 0.7 for n in range(SHORTEST, len(stem))):
            stems.pop(stem)
    for stem in [s for s in stems if s.endswith("$")]:
        if any(stems.get(stem[:n], -1.0) >= stems[stem] - 0.7 for n in range(SHORTEST, len(stem))):
            stems.pop(stem)
    grammar = Grammar(stems)
    seen = assess(sample, grammar, ["toxic"]).select("toxic", "toxic_evidence").collect()
    grammar.bias, grammar.slope = _fit(np.array([r.toxic_evidence for r in seen]), np.array([float(r.toxic) for r in seen]))
    drop_staged(sample)
    return grammar


def _counts(seen: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["stem", "n"])


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and a slope of at least 0.05 of a logistic fit, slightly damped."""
    b = np.array([-2.0, 0.5])
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -40, 40)))
        slope = design.T @ (y - p) - 0.01 * b
        curve = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(max(b[1], 0.05))


def assess(docs: DataFrame, grammar: Grammar, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all, if none are named) with toxic_score, toxic_evidence and toxic_clauses (array of the sentences matched).

    A projection over whole texts, very long ones included. Null and empty texts have no evidence and the score of such a text.
    Repeated rows and rows without doc_id are scored like any other. Columns that have the added names are replaced. Empty
    table: no rows.
    """
    added = ("toxic_score", "toxic_evidence", "toxic_clauses")
    names = [c for c in (keep or docs.columns) if c not in added]
    source = docs.select(*names, F.col("text").alias(unused(names, "text__")))
    sent = docs.sparkSession.sparkContext.broadcast((grammar.stems, grammar.bias, grammar.slope))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("toxicity", _READY.clear)
        own = _grammar(sent.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = [own.evidence(t) for t in batch.column(len(names)).to_pylist()]
                columns = [pa.array([own.score(e) for e, _ in found]), pa.array([e for e, _ in found]), pa.array([c for _, c in found], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *columns], [*names, *added])

    extra = [StructField("toxic_score", DoubleType()), StructField("toxic_evidence", DoubleType()), StructField("toxic_clauses", ArrayType(StringType()))]
    return arrow_map(source, run, StructType([*source.select(*names).schema.fields, *extra]))


_READY: dict[int, Grammar] = {}


def _grammar(sent: tuple[dict[str, float], float, float]) -> Grammar:
    key = hash((len(sent[0]), sent[1], sent[2], tuple(sorted(sent[0].items())[:50])))
    if key not in _READY:
        _READY.clear()
        _READY[key] = Grammar(*sent)
    return _READY[key]


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``assess`` of the whole texts of all documents, with what ``train`` learns from labels that are not held out; they tell what odd rows give."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    grammar = train(docs, labels.where(~held_out()))
    scored = assess(docs, grammar, ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.7).cast("int").alias("predicted"))
