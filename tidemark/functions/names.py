"""Normalizing substance names and finding vocabulary phrases in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a name sheds, and what names no drug.
DOSE = r"\b\d+(?:\.\d+)?\s*(?:mg|mcg|ug|g|kg|ml|l|iu|units?|%)(?:/(?:m2|kg|day|d|h|hr|min|ml|l|dose|wk|week))*(?![a-z])"
SOLVATE = r"\b(?:propylene glycol|acetone|ethanol) solvate\b"
NOISE = (
    "hydrochloride", "dihydrochloride", "hcl", "hydrobromide", "sodium", "disodium", "potassium", "calcium",
    "magnesium", "sulfate", "sulphate", "acetate", "maleate", "malate", "mesylate", "esylate", "tosylate", "ditosylate",
    "tartrate", "bitartrate", "citrate", "phosphate", "succinate", "besylate", "fumarate", "oxalate", "lactate",
    "nitrate", "bromide", "chloride", "olamine", "meglumine", "tromethamine", "anhydrous", "tablet", "tablets",
    "capsule", "capsules", "injection", "injectable", "infusion", "oral", "iv", "intravenous", "subcutaneous",
    "intramuscular", "topical", "cream", "gel", "ointment", "solution", "suspension", "patch", "spray", "inhaled",
    "inhalation", "extended", "release", "er", "xr", "sr", "dose", "dosing", "placebo", "saline", "vehicle", "sham",
    "normal",
)
VAGUE = (
    "nos", "unspecified", "unknown", "ingredient", "vitamins", "minerals", "cosmetics", "probiotics", "antacids",
)
NOT_A_DRUG = ["protein", "ethyl", "water", "lactose", "dextrose", "glucose", "sucrose", "oxygen", "nitrogen", "air", "alcohol", "honey", "stem cells", "lymphocytes"]
SHORTEST_WORD = 4
#: Words of the longest phrase that is looked for, unless ``longest`` says otherwise.
LONGEST_PHRASE = 4
#: As many phrases may be broadcast; more are joined by a shuffle.
PHRASES_SENT = 200_000


def tokens(name: Column) -> Column:
    """Words of a name that tell substances apart."""
    text = F.lower(F.coalesce(name, F.lit("")))
    for pattern, by in ((DOSE, " "), (SOLVATE, " "), (r"\b[rs]-(?=[a-z])", ""), (r"(?<=[a-z])-(?=\d)", ""), ("[^a-z0-9]+", " ")):
        text = F.regexp_replace(text, pattern, by)
    noise = F.array(*map(F.lit, NOISE))
    return F.filter(F.split(text, " "), lambda w: (w != "") & ~F.array_contains(noise, w) & ~w.endswith("hydrate") & ~w.rlike("^[0-9]+$"))


def normalize(name: Column) -> Column:
    return F.array_join(tokens(name), " ")


def is_specific(name: Column) -> Column:
    return ~name.isin(NOT_A_DRUG) & ~F.arrays_overlap(F.split(name, " "), F.array(*map(F.lit, VAGUE)))


def match_phrases(names: DataFrame, vocabulary: DataFrame, id: str, name: str, phrase: str = "substance", longest: int | None = LONGEST_PHRASE) -> DataFrame:
    """Distinct (id, phrase): vocabulary phrases in normalized names, longest first from the left, without overlap.

    Phrases of more than ``longest`` words are not looked for; None: phrases of any length are. The word n-grams of the distinct names
    that begin with the first word of a phrase meet the vocabulary in an equi-join, which is a broadcast up to ``PHRASES_SENT``
    phrases; a fold over each name's hits, ordered by place and length, keeps the leftmost
    longest. One-word phrases need ``SHORTEST_WORD`` characters. No Python, and each distinct name is matched once. A name may
    be a whole document: rows of n-grams carry a digest of it, so the work is linear in its words.
    """
    words = names.select(id, F.unhex(F.sha2(F.col(name), 256)).alias("key_"), F.col(name).alias("name_")).where(F.col("name_") != "")
    vocab = vocabulary.select(F.col(phrase).alias("phrase")).where(F.col("phrase").isNotNull()).distinct()
    many, most = vocab.agg(F.count("*"), F.max(F.size(F.split("phrase", " ")))).first()
    sent = many <= PHRASES_SENT
    if sent:
        vocab = F.broadcast(vocab)
    distinct = words.select("key_", "name_").distinct().select("key_", F.split("name_", " ").alias("w0"))
    reach = range(min(longest or most or 1, most or 1))
    row = F.arrays_zip("w0", *(F.slice("w0", k + 1, F.size("w0")).alias(f"w{k}") for k in reach[1:]))
    at = distinct.select("key_", F.posexplode(row).alias("i", "w")).select("key_", "i", "w.*")
    if sent:  # few words begin a phrase: the others go before n-grams are made
        at = at.join(F.broadcast(vocab.select(F.split("phrase", " ")[0].alias("w0")).distinct()), "w0", "left_semi")
    spans = [F.when(F.col(f"w{k}").isNotNull(), F.struct(F.lit(k + 1).alias("n"), F.concat_ws(" ", *(f"w{j}" for j in range(k + 1))).alias("phrase"))) for k in reach]
    grams = at.select("key_", "i", F.explode(F.array(*spans)).alias("s")).select("key_", "i", "s.*").where("n is not null")
    grams = grams.where((F.col("n") > 1) | (F.length("phrase") >= SHORTEST_WORD))
    hits = grams.join(vocab, "phrase").groupBy("key_").agg(F.array_sort(F.collect_list(F.struct("i", (-F.col("n")).alias("m"), "phrase"))).alias("hits"))
    fold = F.expr("aggregate(hits, named_struct('upto', 0, 'got', cast(array() as array<string>)), (s, h) -> if(h.i >= s.upto, named_struct('upto', h.i - h.m, 'got', array_union(s.got, array(h.phrase))), s), s -> s.got)")
    found = hits.select("key_", F.explode(fold).alias(phrase))
    return words.select(id, "key_").distinct().join(found, "key_").select(id, phrase).distinct()
