"""Mixing sources to target weights by hash-threshold histograms; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import pinned, table

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
BITS = 12
LEVELS = 4
#: As many sources, some 100 bytes each, may be broadcast; more are joined by a shuffle.
SOURCES_SENT = 100_000


def sized() -> tuple[Column, Column]:
    """size (words of the whole text; null: 0) and spot, a 48-bit hash that orders the documents of a source.

    The hash depends on doc_id, size and text alone, so reruns agree; only rows equal in all of them share it.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    seeded = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), size.cast("string"), F.coalesce("text", F.lit("")))
    spot = F.conv(F.substring(F.md5(seeded.cast("binary")), 1, BITS * LEVELS // 4), 16, 10).cast("long")
    return size.alias("size"), spot.alias("spot")


def turn() -> Column:
    """A 48-bit hash of a row's place in its table: parts rows that are equal, of which any will do."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << (BITS * LEVELS))).alias("turn")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: source_size, target.

    Sources by code point, null last, weigh ``weights`` in turn and share the whole size. A target stops at ``most`` times
    its source's size and the excess is reshared by weight: the level L at which the sum of least(most * size, L * weight)
    meets the total, found from running sums over the sources in the order in which they fill up. The window holds one row
    per source, never documents.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    per = per.withColumn("fills", F.col("cap") / F.col("weight"))
    order = Window.orderBy("fills", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    per = per.withColumn("total", total)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    per = per.withColumn("level", level)
    found = F.min(F.when(F.col("level") <= F.col("fills"), F.struct("fills", "level"))).over(Window.partitionBy())["level"]
    target = F.least(F.col("cap"), F.coalesce(found, F.lit(0.0)) * F.col("weight"))
    return per.select("source", "source_size", F.round(target, 6).alias("target"))


def _with_source(docs: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    sources = sources.withColumnRenamed("source", "source_")
    return docs.join(F.broadcast(sources) if few else sources, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")


def _boundary(rows: DataFrame, edge: DataFrame, few: bool, by: str) -> DataFrame:
    """One row per source of ``edge`` (source, budget): the hash at which its budget ends, what is left of it there, and the
    words and rows of that hash.

    Sizes summed by source and the first ``BITS`` bits of the hash ``by`` tell in which bucket the budget ends; only that bucket
    is summed again by the next bits, ``LEVELS`` times.
    """
    edge = edge.select("source", "budget", F.lit(0).cast("long").alias("head"))  # head: the first hash bits of the boundary bucket
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        inside = _with_source(rows.select("source", "size", by), edge, few).where(F.shiftright(by, shift + BITS) == F.col("head"))
        bins = inside.groupBy("source", F.shiftright(by, shift).alias("bin"), "budget").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        bins = bins.withColumn("run", F.sum("words").over(Window.partitionBy("source").orderBy("bin")))
        ends = bins.where("run > budget").groupBy("source").agg(F.min(F.struct("bin", "run", "words", "budget", "rows")).alias("hit"))
        rest = F.col("hit.budget") - F.col("hit.run") + F.col("hit.words")
        edge = pinned(ends.select("source", rest.alias("budget"), F.col("hit.bin").alias("head"), F.col("hit.words").alias("words"), F.col("hit.rows").alias("rows")))
    return edge


def thresholds(slim: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> tuple[DataFrame, bool]:
    """One row per source of ``slim`` (source, size, spot, turn): source_size, target, whole, budget, cut and turn_cut; and if they are few.

    Every document of a source is taken ``whole`` = floor(target / source_size) times; what is left of the target is filled by
    the documents whose hash lies below ``cut``, found in nested histograms. A document that the budget ends in is taken if that
    comes nearer. Equal rows share a hash: where the budget ends among them, they are told apart by ``turn`` in histograms
    of their own, and those below ``turn_cut`` are taken. No sort of documents, no group in one task: the sums are
    aggregated before they are shuffled.
    """
    goal = targets(slim, weights, most)
    goal = goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0).cast("long")))
    goal = pinned(goal.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")))
    few = goal.count() <= SOURCES_SENT
    edge = _boundary(slim, goal, few, "spot")
    nearer = F.when(F.col("words") < 2 * F.col("budget"), 1).otherwise(0)
    many = edge.where("rows > 1")
    cut = edge.select("source", (F.col("head") + F.when(F.col("rows") > 1, 0).otherwise(nearer)).alias("cut"))
    if many.limit(1).count():
        same = _with_source(slim, many.select("source", F.col("head").alias("spot_")), few).where("spot = spot_").drop("spot_")
        turns = _boundary(same, many, few, "turn").select(F.col("source").alias("of_"), (F.col("head") + nearer).alias("turn_cut"))
        cut = cut.join(turns, F.col("source").eqNullSafe(F.col("of_")), "left").drop("of_")
    else:
        cut = cut.withColumn("turn_cut", F.lit(None).cast("long"))
    return goal.join(cut.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_"), few


def copies(end: str = "") -> Column:
    """How often a row with the columns of ``sized``, ``turn`` and ``thresholds``, their names ending in ``end``, is taken."""
    c = lambda name: F.col(f"{name}{end}")
    inside = (c("spot") < c("cut")) | ((c("spot") == c("cut")) & (c("turn") < c("turn_cut")))
    return (c("whole") + F.when((c("budget") > 0) & inside, 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """How often each document is taken: doc_id, source, size, source_size, target, copies.

    Null text: size 0. Null source: a source of its own, last. Sources without words: target 0, copies 0. Null doc_id: a row
    like any other. Repeated rows: as many of them are taken as the budget wants, which of them is left open. Very long texts:
    a document is taken whole or not, so a source misses its target by half its boundary document at most. Other columns
    are not read. Empty table: no rows.
    """
    # written once: words are counted a single time, all later passes read a few short columns
    slim = pinned(docs.select("doc_id", "source", *sized(), turn()))
    goal, few = thresholds(slim, weights, most)
    return _with_source(slim, goal, few).select("doc_id", "source", "size", "source_size", "target", copies().alias("copies"))


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of the mix, all columns of ``docs``, each as often as it is taken; odd rows as in ``mix``."""
    names = docs.columns
    end = "__"
    while any(c.lower().endswith(end) for c in names):
        end += "_"
    parts = zip(("size", "spot", "turn"), (*sized(), turn()))
    own = docs.select(*names, *[c.alias(f"{n}{end}") for n, c in parts])
    slim = pinned(own.select("source", *[F.col(f"{n}{end}").alias(n) for n in ("size", "spot", "turn")]))
    goal, few = thresholds(slim, weights, most)
    named = goal.select(*[F.col(c).alias(f"{c}{end}") for c in ("source", "whole", "budget", "cut", "turn_cut")])
    joined = own.join(F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col(f"source{end}")))
    often = joined.withColumn(f"often{end}", copies(end).cast("int")).where(F.col(f"often{end}") > 0)
    return often.withColumn(f"time{end}", F.explode(F.sequence(F.lit(1), F.col(f"often{end}")))).select(*names)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mix`` of all documents, which tells what odd rows give."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP8_SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), h AS (
  SELECT doc_id, source, size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|' || size::VARCHAR || '|' || text), 1, 12))::BIGINT AS spot FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM s
), f AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / weight AS fills, sum(source_size) OVER ()::DOUBLE AS total FROM w
), l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY fills, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY fills, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f
), t AS (
  SELECT source, source_size, round(least(cap, coalesce((SELECT min_by(level, fills) FROM l WHERE level <= fills), 0) * weight), 6) AS target FROM f
), g AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t
), b AS (
  SELECT *, target - whole * source_size AS budget FROM g
), r AS (
  SELECT h.doc_id, h.size, b.*, sum(h.size) OVER (PARTITION BY h.source ORDER BY h.spot ROWS UNBOUNDED PRECEDING) AS run
  FROM h JOIN b ON h.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN budget > 0 AND (run <= budget OR (run - size <= budget AND size < 2 * (budget - run + size))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
