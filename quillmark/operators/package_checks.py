"""The nineteen checks of a package of sources and claims: one pass a table, two joins for references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import json_schema
from . import quality as Q

# ---- fixed values ----
LABELS = ("ulcerative_colitis", "ibd_general", "crohns_only", "unknown")
TRIALS = ("ongoing_trial", "completed_trial_record")
EVIDENCE = ("published_study", "clinical_guideline", *TRIALS)
IDENTIFIERS = ("doi", "pubmedId", "pmcId", "clinicalTrialsId")
DOI = r"^10\.\d{4,9}/\S+$"
SECRET = r"(?i)(aws_secret|api[_-]?key|bearer\s+[a-z0-9._-]{12,}|ghp_[A-Za-z0-9]{20,}|gho_[A-Za-z0-9]{20,}|-----BEGIN [A-Z ]*PRIVATE KEY-----|postgres(?:ql)?://[^\s\"']+)"
FORUM = r"(?i)reddit\.com|redd\.it|/u/[a-z0-9_-]+|/user/[a-z0-9_-]+"
PENDING = "pending_clinical_review"
#: Columns that a package must not have.
FILES = ("fullText", "pdfPath", "pdfUrl")


def _has(*columns: str) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return out


def audit(sources: DataFrame, claims: DataFrame, outputs: DataFrame, checkpoint: DataFrame, schema: dict, counters: dict[str, int], target: str = "NONE") -> DataFrame:
    """``check_id, passed, violations`` of QA-01 to QA-19 and ``ALL``; ``violations`` are rows (for QA-10, QA-14, QA-18: faults).

    ``outputs`` has a column ``text`` with what was written, ``checkpoint`` one with a JSON text; ``counters``
    are the run's own sums. A null value is an empty one, and an evidence type that is missing a published
    study; an empty table has nothing against it.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    title = F.lower(text("title"))
    of_sources = {
        "QA-04a": (~_has("doi") | F.col("doi").rlike(DOI)) & _has(*IDENTIFIERS),
        "QA-05": (text("ucApplicability") != LABELS[0]) | ~F.contains(title, F.lit("crohn")) | F.contains(title, F.lit("ulcerative colitis")),
        "QA-06a": text("ucApplicability").isin(*LABELS),
        "QA-07a": text("archivalStatus") == "link_only",
        "QA-08a": ~_has("humanReviewStatus", "clinicalReviewStatus"),
        "QA-17": F.coalesce("evidenceType", F.lit(EVIDENCE[0])).isin(*EVIDENCE),
        "QA-18a": ~F.lower(text("canonicalUrl")).rlike(r"\.pdf(\?|$)") & ~F.lower(text("alternateUrl")).rlike(r"\.pdf(\?|$)"),
    }
    of_claims = {
        "QA-02": _has("exactSupportingExcerpt") & _has("exactLocator"),
        "QA-03": F.coalesce("isMechanicallyExtractedCandidate", F.lit(False)) & (text("verificationBasis") == "abstract_only"),
        "QA-06b": text("conditionApplicability").isin(*LABELS),
        "QA-08b": ~_has("humanReviewStatus", "clinicalReviewStatus", "reviewerDecision") & (text("reviewStatus") == PENDING),
        "QA-19": F.coalesce("requiresFullTextVerification", F.lit(True)),
    }
    of_outputs = {"QA-13": ~text("text").rlike(SECRET), "QA-15": ~text("text").rlike(FORUM)}
    of_checkpoint = {
        "QA-11": F.size(json_schema.validate(F.col("text"), schema)) == 0,
        "QA-12": F.coalesce(F.get_json_object("text", "$.nextRecommendedOperation.description"), F.lit("")) != "",
    }
    found = Q.checks(sources, of_sources)
    for rows, tests in ((claims, of_claims), (outputs, of_outputs), (checkpoint, of_checkpoint)):
        found = found.unionByName(Q.checks(rows, tests))
    trials = sources.filter(F.col("evidenceType").isin(*TRIALS)).select("sourceId").distinct()
    on_trials = claims.join(trials, "sourceId", "left_semi").agg(F.count(F.lit(1)).alias("violations")).select(F.lit("QA-16").alias("check_id"), (F.col("violations") == 0).alias("passed"), "violations")
    sums = claims.agg(F.count(F.lit(1)).alias("n")).select(((F.col("n") != counters.get("claimsExtracted", 0)).cast("long") + F.lit(int(counters.get("sourcesAccepted", 0) < 0))).alias("violations"))
    plain = {"QA-07b": int(counters.get("pdfsDownloaded", 0) > 0), "QA-14": int("NONE" not in target), "QA-18b": sum(c in sources.columns for c in FILES)}
    spark = sources.sparkSession
    rest = spark.createDataFrame([(k, v == 0, v) for k, v in plain.items()], "check_id string, passed boolean, violations long")
    found = found.unionByName(rest).unionByName(on_trials).unionByName(Q.foreign_keys(claims, "sourceId", sources, "sourceId", "QA-01"))
    found = found.unionByName(sums.select(F.lit("QA-10").alias("check_id"), (F.col("violations") == 0).alias("passed"), "violations"))
    found = found.unionByName(Q.unique(sources, "sourceId", "QA-09a")).unionByName(Q.unique(claims, "claimId", "QA-09b"))
    whole = found.groupBy(F.left("check_id", F.lit(5)).alias("check_id")).agg(F.bool_and("passed").alias("passed"), F.sum("violations").alias("violations"))
    return Q.verdict(whole)
