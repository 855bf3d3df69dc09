"""Scalar and text rules over the sample tables, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import names as N
from tidemark.functions import scalars as S
from tidemark.plans import base as B


def normalize_enum(spark: SparkSession, d: str) -> DataFrame:
    p = B.table(spark, d, "orders").select("o_orderkey", S.enum(F.concat(F.lit(" Phase "), F.col("o_orderpriority"), F.lit(" Assignment"))).alias("norm"))
    return p.withColumn("design", S.design_enum(F.concat(F.col("norm"), F.lit("__"))))


def flag_parse(spark: SparkSession, d: str) -> DataFrame:
    words = F.array(*map(F.lit, ["t", " Yes", "F", "no ", "Accepts Healthy Volunteers", "maybe", "1", "0", ""]))
    c = B.table(spark, d, "customer").select("c_custkey", F.get(words, (F.col("c_custkey") % 10).cast("int")).alias("word"))
    return c.select("c_custkey", S.truth(F.col("word")).alias("flag"))


REASONS = ["Safety concerns", "Business decision; no safety concerns", "low enrollment", "lack of efficacy", "sponsor decision", "drug supply", "", "Unknown cause", "slow accrual, funding ended", "did not meet the endpoint"]


def stop_reason_text(spark: SparkSession, d: str) -> DataFrame:
    words = F.array(*map(F.lit, REASONS))
    o = B.table(spark, d, "orders").select("o_orderkey", F.get(words, (F.col("o_orderkey") % 11).cast("int")).alias("why"))
    return o.select("o_orderkey", S.stop_reason(F.col("why")).alias("stop_reason"))


def age_parse(spark: SparkSession, d: str) -> DataFrame:
    p = B.table(spark, d, "part")
    unit = F.get(F.array(*map(F.lit, ["Years", "Months", "Weeks", "Days", "N/A"])), (F.col("p_partkey") % 5).cast("int"))
    return p.select("p_partkey", S.years_of_age(F.concat_ws(" ", F.col("p_size").cast("string"), unit)).alias("age"))


def line_filter_count(spark: SparkSession, d: str) -> DataFrame:
    x = B.table(spark, d, "documents").select("doc_id", F.regexp_replace("text", "\n", "~").alias("criteria"))
    return x.select("doc_id", S.criteria_count(F.col("criteria")).alias("criteria_count"), S.criteria_chars(F.col("criteria")).alias("criteria_chars"))


def sentence_scrub(spark: SparkSession, d: str) -> DataFrame:
    """The scrub of every document, in any or no language."""
    kept = S.without_ending(F.col("text"), r"(?:^|[^a-z0-9_])(?:was|this)(?:$|[^a-z0-9_])")
    return B.table(spark, d, "documents").select("doc_id", F.length(kept).alias("chars"), F.md5(kept.cast("binary")).alias("digest"))


def text_blob(spark: SparkSession, d: str) -> DataFrame:
    c = B.table(spark, d, "conversations")
    blob = S.text_blob(F.when(F.col("turn") > 0, F.col("role")), F.col("role"), F.nullif(F.col("text"), F.lit("")), F.lit("a~b"), F.when(F.col("turn") > 1, F.lit("k")))
    return c.select("conv_id", "turn", F.length(blob).alias("chars"), F.md5(blob.cast("binary")).alias("digest"))


def name_normalize(spark: SparkSession, d: str) -> DataFrame:
    p = B.table(spark, d, "part")
    raw = F.concat_ws(" ", F.col("p_name"), F.col("p_size").cast("string"), F.lit("mg/m2 IV Hydrochloride il-2 s-malate"), F.col("p_type"))
    return p.select("p_partkey", N.normalize(raw).alias("name"), N.is_specific(N.normalize(raw)).alias("specific"))


PHRASES = ("that the", "that", "this", "with the", "with", "from", "the")


def phrase_match(spark: SparkSession, d: str) -> DataFrame:
    """Phrases of the vocabulary in all words of every document; two words win over the single ones they begin with."""
    x = B.table(spark, d, "documents").select("doc_id", F.trim(F.regexp_replace(S.ascii_lower(F.col("text")), "[^a-z]+", " ")).alias("name"))
    return N.match_phrases(x, spark.createDataFrame([(p,) for p in PHRASES], "substance string"), "doc_id", "name")


def json_extract(spark: SparkSession, d: str) -> DataFrame:
    e = B.table(spark, d, "events")
    return e.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


def id_normalize(spark: SparkSession, d: str) -> DataFrame:
    s = B.table(spark, d, "supplier")
    return s.select("s_suppkey", S.registry_id(F.concat(F.lit(" nct-"), F.col("s_suppkey").cast("string"), F.lit("x"))).alias("id"), S.registry_id(F.regexp_replace("s_name", "[0-9]", "")).alias("none"))


def date_formats(spark: SparkSession, d: str) -> DataFrame:
    o = B.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("day", "MMMM d, yyyy")).when(F.col("o_orderkey") % 3 == 1, F.date_format("day", "MMMM yyyy")).otherwise("soon")
    iso = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("day", "yyyy-MM-dd")).otherwise("")
    return o.select("o_orderkey", S.start_date(iso, text).alias("start_date"))


def valid_dates(spark: SparkSession, d: str) -> DataFrame:
    o = B.table(spark, d, "orders")
    raw = F.when(F.col("o_orderkey") % 5 == 0, "00010101").when(F.col("o_orderkey") % 5 == 1, "29991231").when(F.col("o_orderkey") % 5 == 2, "x").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return o.select("o_orderkey", S.valid_date(raw).alias("day"))


def masking_levels(spark: SparkSession, d: str) -> DataFrame:
    words = F.array(*map(F.lit, ["None (Open Label)", "Double Blind (Subject, Investigator)", "Participant, Investigator", "No masking", "Single Blind", "QUADRUPLE", "other way_"]))
    c = B.table(spark, d, "customer").select("c_custkey", F.get(words, (F.col("c_custkey") % 7).cast("int")).alias("w"), (F.col("c_custkey") % 5).cast("int").alias("n"))
    return c.select("c_custkey", S.masking_level(F.col("w")).alias("level"), S.masking_level(F.col("w"), F.col("n")).alias("by_parties"))


QUERIES = {f.__name__: f for f in (
    normalize_enum, flag_parse, stop_reason_text, age_parse, line_filter_count, sentence_scrub, text_blob, name_normalize, phrase_match, json_extract, id_normalize, date_formats, valid_dates, masking_levels,
)}


def _pick(values: list[str], index: str) -> str:
    return "CASE " + index + " " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + " END"


_NORM = "regexp_replace(regexp_replace(upper(trim({0})), 'PHASE\\s+', 'PHASE', 'g'), '[^A-Z0-9/]+', '_', 'g')"
_WHY = "regexp_replace(lower(coalesce(why, '')), '" + S.NEGATED.replace("'", "''") + "', ' ', 'g')"
_NAME = "lower(p_name || ' ' || p_size || ' mg/m2 IV Hydrochloride il-2 s-malate ' || p_type)"
for _p, _b in ((r"\b\d+(\.\d+)?\s*(mg|mcg|ug|g|kg|ml|l|iu|units|unit|%)(/(m2|kg|day|d|hr|h|min|ml|l|dose|wk|week))*", " "), (N.SOLVATE, " "), (r"\b[rs]-([a-z])", r"\1"), (r"([a-z])-(\d)", r"\1\2"), ("[^a-z0-9]+", " ")):
    _NAME = f"regexp_replace({_NAME}, '{_p}', '{_b}', 'g')"
_NOISE = ", ".join(f"'{w}'" for w in N.NOISE)
_VAGUE = ", ".join(f"'{w}'" for w in N.VAGUE)
_PLAIN = ", ".join(f"'{w}'" for w in N.NOT_A_DRUG)
SQL = {
    "normalize_enum": f"WITH n AS (SELECT o_orderkey, {_NORM.format(chr(39) + ' Phase ' + chr(39) + ' || o_orderpriority || ' + chr(39) + ' Assignment' + chr(39))} AS norm FROM orders) SELECT o_orderkey, norm, regexp_replace(regexp_replace({_NORM.format('norm')}, '_+$', ''), '_ASSIGNMENT$', '') AS design FROM n",
    "flag_parse": f"WITH w AS (SELECT c_custkey, lower(trim({_pick(['t', ' Yes', 'F', 'no ', 'Accepts Healthy Volunteers', 'maybe', '1', '0', ''], 'c_custkey % 10')})) AS w FROM customer) SELECT c_custkey, CASE WHEN w IN ('t', 'true', 'yes', 'y', '1') OR w LIKE 'accepts%' THEN true WHEN w IN ('f', 'false', 'no', 'n', '0') THEN false END AS flag FROM w",
    "stop_reason_text": f"WITH w AS (SELECT o_orderkey, {_pick(REASONS, 'o_orderkey % 11')} AS why FROM orders), t AS (SELECT o_orderkey, trim(lower(coalesce(why, ''))) AS raw, {_WHY} AS said FROM w) SELECT o_orderkey, CASE WHEN raw <> '' THEN CASE "
    + " ".join(f"WHEN regexp_matches(said, '{p}') THEN '{n}'" for n, p in S.STOP_REASONS.items())
    + " ELSE 'other' END END AS stop_reason FROM t",
    "age_parse": "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size::DOUBLE WHEN 1 THEN round(p_size / 12.0::DOUBLE, 2) WHEN 2 THEN round(p_size / 52.0::DOUBLE, 2) WHEN 3 THEN round(p_size / 365.0::DOUBLE, 2) END AS age FROM part",
    "line_filter_count": r"WITH x AS (SELECT doc_id, replace(text, chr(10), '~') AS c FROM documents) SELECT doc_id, len(list_filter(string_split(c, '~'), lambda x: trim(x, ' ') <> '' AND NOT regexp_matches(lower(trim(x, ' ')), 'criteria\s*:?$')))::INT AS criteria_count, length(c)::INT AS criteria_chars FROM x",
    "sentence_scrub": r"WITH x AS (SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '[^.~]*[.~]|[^.~]+$'), lambda s: CASE WHEN regexp_matches(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:^|[^a-z0-9_])(?:was|this)(?:$|[^a-z0-9_])') THEN ' ' ELSE s END), '') AS k FROM documents) SELECT doc_id, length(k)::INT AS chars, md5(k) AS digest FROM x",
    "text_blob": "WITH x AS (SELECT conv_id, turn, concat_ws(chr(10), role, nullif(text, ''), 'a b', CASE WHEN turn > 1 THEN 'k' END) AS b FROM conversations) SELECT conv_id, turn, length(b)::INT AS chars, md5(b) AS digest FROM x",
    "name_normalize": f"WITH x AS (SELECT p_partkey, array_to_string(list_filter(string_split({_NAME}, ' '), lambda w: w <> '' AND w NOT IN ({_NOISE}) AND NOT suffix(w, 'hydrate') AND NOT regexp_full_match(w, '[0-9]+')), ' ') AS name FROM part) SELECT p_partkey, name, name NOT IN ({_PLAIN}) AND NOT list_has_any(string_split(name, ' '), [{_VAGUE}]) AS specific FROM x",
    # no phrase of this vocabulary begins with the last word of another, so what a word matches depends on its neighbours alone
    "phrase_match": """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z]+'), lambda x: x <> '') AS w FROM documents),
      v(p) AS (VALUES ('that the'), ('that'), ('this'), ('with the'), ('with'), ('from'), ('the')),
      u AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM w),
      n AS (SELECT doc_id, w, lag(w) OVER o || ' ' || w AS into_it, w || ' ' || lead(w) OVER o AS from_it FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i))
      SELECT DISTINCT doc_id, CASE WHEN from_it IN (SELECT p FROM v) THEN from_it ELSE w END AS substance FROM n
      WHERE from_it IN (SELECT p FROM v) OR (length(w) >= 4 AND w IN (SELECT p FROM v) AND coalesce(into_it NOT IN (SELECT p FROM v), true))""",
    "json_extract": "SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events",
    "id_normalize": "SELECT s_suppkey, 'NCT' || lpad(s_suppkey::VARCHAR, greatest(8, length(s_suppkey::VARCHAR))::INT, '0') AS id, '' AS none FROM supplier",
    "date_formats": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate::DATE WHEN o_orderkey % 3 = 0 THEN o_orderdate::DATE WHEN o_orderkey % 3 = 1 THEN last_day(o_orderdate::DATE) END AS start_date FROM orders",
    "valid_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 2 THEN o_orderdate::DATE END AS day FROM orders",
    "masking_levels": """WITH x AS (SELECT c_custkey, c_custkey % 7 AS k, c_custkey % 5 AS n FROM customer), y AS (SELECT *, CASE k WHEN 0 THEN 'NONE' WHEN 1 THEN 'DOUBLE' WHEN 2 THEN 'DOUBLE' WHEN 3 THEN 'NONE' WHEN 4 THEN 'SINGLE' WHEN 5 THEN 'QUADRUPLE' ELSE 'OTHER_WAY' END AS level FROM x)
      SELECT c_custkey, level, CASE WHEN k IN (1, 4) AND n > 0 THEN CASE n WHEN 1 THEN 'SINGLE' WHEN 2 THEN 'DOUBLE' WHEN 3 THEN 'TRIPLE' ELSE 'QUADRUPLE' END ELSE level END AS by_parties FROM y""",
}
