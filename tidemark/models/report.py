"""Texts about scores: reasons, lookup rows, cards and the dashboard document. Inputs are collected aggregates."""

from __future__ import annotations

import html
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import metrics as M

# What readers see for a feature, and how its value is shown.
AREA_LABELS = {
    "neoplasms": "cancer",
    "cardiovascular": "cardiovascular",
    "nervous_system": "neurology",
    "mental": "psychiatry",
    "infections": "infectious disease",
    "respiratory": "respiratory",
    "digestive": "digestive",
    "metabolic": "metabolic",
    "immune": "immunology",
    "skin": "dermatology",
    "musculoskeletal": "musculoskeletal",
    "urogenital": "urogenital",
    "blood": "hematology",
    "endocrine": "endocrine",
}
LABELS = {
    "phase": ("Phase", "phase"),
    "number_of_arms": ("Number of arms", "count"),
    "allocation": ("Allocation", "category"),
    "intervention_model": ("Design", "category"),
    "primary_purpose": ("Primary purpose", "category"),
    "masking": ("Blinding", "category"),
    "sponsor_class": ("Sponsor type", "sponsor"),
    "has_dmc": ("Has a data monitoring committee", "flag"),
    "min_age_years": ("Minimum age", "years"),
    "max_age_years": ("Maximum age", "years"),
    "healthy_volunteers": ("Accepts healthy volunteers", "flag"),
    "sex": ("Sex", "category"),
    "responsible_party": ("Responsible party", "category"),
    "n_collaborators": ("Collaborators", "count"),
    "n_keywords": ("Keywords listed", "count"),
    "sponsor_prior_trials": ("Sponsor's past trials", "count"),
    "sponsor_prior_termination_rate": ("Sponsor's past termination rate", "share"),
    "sponsor_trials_started_2y": ("Trials the sponsor started in the prior 2 years", "count"),
    "n_substances": ("Drugs with FDA adverse-event history", "count"),
    "faers_reports": ("Drug's FAERS reports before start", "count"),
    "faers_reports_12m": ("Drug's FAERS reports in the prior 12 months", "count"),
    "faers_serious_share": ("Drug's FAERS reports marked serious", "share"),
    "faers_death_share": ("Drug's FAERS reports with a death", "share"),
    "has_faers_history": ("Drug has FAERS history", "flag"),
    "n_countries": ("Countries", "count"),
    "us_only": ("US-only sites", "flag"),
    "criteria_count": ("Eligibility criteria", "count"),
    "criteria_chars": ("Length of eligibility criteria (characters)", "count"),
} | {f"area_{k}": (f"Disease area, {v}", "flag") for k, v in AREA_LABELS.items()}
WORDING = {"registration_text": "Wording of the registration (title, summary, criteria)"}
SPONSOR_LABELS = {"INDUSTRY": "industry", "OTHER": "academic or other", "GOVERNMENT": "government"}
EMPTY_LABELS = {"sponsor_prior_termination_rate": "no earlier finished trials", "faers_serious_share": "no FAERS history", "faers_death_share": "no FAERS history"}


def plain_number(x: Column) -> Column:
    """A number with six significant digits at most, without zeros at its end."""
    text = F.format_string("%.6g", x)
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+(e|$)", "$1$2"), r"\.(e|$)", "$1")


def shown(feature: Column, kind: Column, value: Column) -> Column:
    """``value``, a text, as readers see it."""
    gone = value.isNull() | (value == "missing")
    number = value.try_cast("double")
    percent = number * 100
    share = F.concat(F.when(percent == F.round(percent), F.format_string("%.0f", percent)).otherwise(F.format_string("%.1f", percent)), F.lit("%"))
    of = lambda known, key, other: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in known.items() for x in pair]), key), other)
    return (
        F.when(gone, of(EMPTY_LABELS, feature, F.lit("not given")))
        .when(kind == "flag", F.when(F.lower(value).isin("true", "yes", "1", "1.0"), "Yes").otherwise("No"))
        .when(kind == "phase", F.regexp_replace(value, "PHASE", ""))
        .when(kind == "sponsor", of(SPONSOR_LABELS, value, F.lower(value)))
        .when((kind == "share") & number.isNotNull(), share)
        .when(kind.isin("count", "years") & number.isNotNull(), plain_number(number))
        .otherwise(F.lower(F.regexp_replace(value, "_", " ")))
    )


def reason_texts(rows: DataFrame) -> DataFrame:
    """``rows`` (feature, value, contribution) with the reason's text; labels join as a small literal table."""
    spark = rows.sparkSession
    known = spark.createDataFrame([(k, label, kind) for k, (label, kind) in LABELS.items()], "feature string, label string, kind string")
    joined = rows.join(F.broadcast(known), "feature", "left")
    spoken = F.regexp_replace("feature", "_", " ")
    label = F.coalesce("label", F.concat(F.upper(F.substring(spoken, 1, 1)), F.lower(F.substring(spoken, 2, 1000))))
    told = F.concat_ws(": ", label, shown(F.col("feature"), F.coalesce("kind", F.lit("category")), F.col("value")))
    for feature, text in WORDING.items():
        told = F.when(F.col("feature") == feature, text).otherwise(told)
    way = F.when(F.col("contribution") > 0, "raises").otherwise("lowers")
    return joined.withColumn("text", F.concat(told, F.lit(" ("), way, F.lit(" risk)"))).drop("kind", "label")


def described(feature: Column, value: Column) -> Column:
    """feature=value, for reports: flags as Yes and No, numbers short, null as missing; ``value`` is a text."""
    plain = F.when(value.isNull(), "missing").when(value == "true", "Yes").when(value == "false", "No").otherwise(F.coalesce(plain_number(value.try_cast("double")), value))
    return F.when(feature == "registration_text", "registration_text (net of all text components)").otherwise(F.concat_ws("=", feature, plain))


def with_status(scores: DataFrame, trials: DataFrame, key: str = "nct_id") -> DataFrame:
    """``scores`` with the status that the registry has now; null for those it no longer has."""
    return scores.drop("status").join(trials.groupBy(key).agg(F.max("status").alias("status")), key, "left")


def lookup_rows(scores: DataFrame, reference: DataFrame, version: str, trials: DataFrame | None = None) -> DataFrame:
    """Published rows: percentile against ``reference``'s scores, years running and the next two years' risk where they apply.

    ``scores``: nct_id, risk_score, score_type, status, start_date, reasons (array), next_2y_risk, snapshot (date). With ``trials``
    (nct_id, status) the status is theirs.
    """
    scores = scores if trials is None else with_status(scores, trials)
    out = M.percentile_against(scores, reference.select(F.col("risk_score").alias("ref_")), "risk_score", "ref_").withColumnRenamed("percentile", "risk_percentile")
    years = F.when(F.col("status") == "NOT_YET_RECRUITING", 0.0).otherwise(F.greatest(F.datediff("snapshot", "start_date") / F.lit(365.25), F.lit(0.0)))
    out = out.withColumn("years_running", F.round(years, 1))
    fits = F.col("years_running") <= 6.0
    out = out.withColumn("next_2y_risk", F.when(fits, F.col("next_2y_risk")))
    shown_ = out.where("next_2y_risk is not null").select(F.col("next_2y_risk").alias("ref_"))
    out = M.percentile_against(out, shown_, "next_2y_risk", "ref_").withColumnRenamed("percentile", "next_2y_percentile")
    return out.withColumn("model_version", F.lit(version)).withColumn("reasons", F.to_json("reasons")).drop("snapshot")


def examples(lookup: DataFrame, groups: dict[str, list[str]]) -> dict[str, list[dict]]:
    """Curated ids that are there, by group; groups without any are left out."""
    wanted = [i for ids in groups.values() for i in ids]
    found = {r.nct_id: r.asDict() for r in lookup.where(F.col("nct_id").isin(wanted)).collect()}
    out = {g: [found[i] for i in ids if i in found] for g, ids in groups.items()}
    return {g: rows for g, rows in out.items() if rows}


def summary(metrics: dict, audit: dict | None = None) -> dict:
    base = metrics["base_rate"]
    out = {"auc": round(metrics["auc"], 3), "base_rate": round(base, 3), "lift": round(metrics["precision_top10"] / base, 2) if base else None}
    if audit:
        out["audit_drop"] = round(-audit["difference"], 4)
    return out


def table(header: list[str], rows: list[list]) -> str:
    lines = ["| " + " | ".join(header) + " |", "|" + "---|" * len(header)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v) for v in r) + " |" for r in rows])


def card(title: str, metrics: dict, calibration: list[dict], subgroups: list[dict], notes: list[str]) -> str:
    """A model card in Markdown."""
    parts = [f"# {title}", table(["metric", "value"], [[k, v] for k, v in metrics.items()])]
    if calibration:
        parts += ["## Calibration", table(list(calibration[0]), [list(r.values()) for r in calibration])]
    if subgroups:
        parts += ["## Subgroups", table(list(subgroups[0]), [list(r.values()) for r in subgroups])]
    return "\n\n".join([*parts, *[f"- {n}" for n in notes]]) + "\n"


def survival_card(title: str, curve: list[dict], calibration: list[dict], by_year: list[dict], notes: list[str]) -> str:
    """A card of the survival model in Markdown: incidence over time, predicted against observed by bin, observed against expected by year."""
    parts = [f"# {title}"]
    for head, rows in (("Incidence", curve), ("Calibration", calibration), ("Observed and expected by year", by_year)):
        if rows:
            parts += [f"## {head}", table(list(rows[0]), [list(r.values()) for r in rows])]
    return "\n\n".join([*parts, *[f"- {n}" for n in notes]]) + "\n"


def payload(active: DataFrame, areas: DataFrame, metrics: dict, top: int = 400) -> dict:
    """The dashboard's document: the riskiest open trials, areas, and figures."""
    first = active.orderBy(F.desc("risk_score"), "nct_id").limit(top).collect()
    return {"top": [r.asDict() for r in first], "areas": [r.asDict() for r in areas.orderBy("disease_area").collect()], "metrics": metrics}


def render(document: dict, title: str) -> str:
    """A page with its data inlined; a closing tag inside the data can't end the script."""
    data = json.dumps(document, default=str, sort_keys=True).replace("</", "<\\/")
    return f"<!doctype html><html><head><meta charset=utf-8><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1><script id=data type=application/json>{data}</script></body></html>"


def search(active: DataFrame, area: str | None = None, phase: str | None = None, sponsor: str | None = None, text: str = "", first: int = 50) -> DataFrame:
    """The dashboard's filter: equal area, phase and sponsor class, text in id or title, the riskiest first."""
    out = active
    for c, v in (("disease_area", area), ("phase", phase), ("sponsor_class", sponsor)):
        if v:
            out = out.where(F.col(c) == v)
    if text:
        out = out.where(F.lower(F.concat_ws(" ", "nct_id", "brief_title")).contains(text.lower()))
    return out.orderBy(F.desc("risk_score"), "nct_id").limit(first)


def estimate_usd(executors: int, minutes: float, rate: float = 0.06, cores: int = 4) -> float:
    """Upper bound of a batch's cost: cores of driver and executors for the time."""
    return cores * (1 + executors) * minutes / 60 * rate
