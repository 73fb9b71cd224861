"""A sound package, and one fault for each check."""

import json

import pytest

from quillmark.operators import package_checks as P

SOURCE = "sourceId string, title string, doi string, pubmedId string, pmcId string, clinicalTrialsId string, ucApplicability string, archivalStatus string, humanReviewStatus string, clinicalReviewStatus string, evidenceType string, canonicalUrl string, alternateUrl string"
CLAIM = "claimId string, sourceId string, exactSupportingExcerpt string, exactLocator string, isMechanicallyExtractedCandidate boolean, verificationBasis string, conditionApplicability string, humanReviewStatus string, clinicalReviewStatus string, reviewerDecision string, reviewStatus string, requiresFullTextVerification boolean"
SOUND = dict(sourceId="S1", title="Fibre in ulcerative colitis and Crohn disease", doi="10.1234/x", pubmedId="1", pmcId="", clinicalTrialsId="", ucApplicability="ulcerative_colitis", archivalStatus="link_only", humanReviewStatus="", clinicalReviewStatus=None, evidenceType="published_study", canonicalUrl="https://a.org/x", alternateUrl="")
TRIAL = SOUND | dict(sourceId="T1", title="a trial", doi="", ucApplicability="unknown", evidenceType="ongoing_trial")
SAID = dict(claimId="C1", sourceId="S1", exactSupportingExcerpt="fibre", exactLocator="abstract", isMechanicallyExtractedCandidate=True, verificationBasis="abstract_only", conditionApplicability="ulcerative_colitis", humanReviewStatus="", clinicalReviewStatus="", reviewerDecision=None, reviewStatus="pending_clinical_review", requiresFullTextVerification=None)
SCHEMA = {"type": "object", "required": ["runId"], "properties": {"runId": {"type": "string"}}}
STEP = {"runId": "r", "nextRecommendedOperation": {"description": "go on"}}

FAULTS = {
    "QA-01": dict(claim={"sourceId": "S9"}), "QA-02": dict(claim={"exactLocator": ""}), "QA-03": dict(claim={"verificationBasis": "full_text"}), "QA-04": dict(source={"doi": "11.1/x"}), "QA-05": dict(source={"title": "Crohn only"}), "QA-06": dict(claim={"conditionApplicability": "maybe"}),
    "QA-07": dict(source={"archivalStatus": "archived"}), "QA-08": dict(claim={"reviewerDecision": "yes"}), "QA-09": dict(source={"sourceId": "T1"}, also={"QA-01", "QA-16"}), "QA-10": dict(counters={"claimsExtracted": 5}), "QA-11": dict(step={"runId": 3}), "QA-12": dict(step={"nextRecommendedOperation": {}}),
    "QA-13": dict(out="my API_KEY here"), "QA-14": dict(target="prod"), "QA-15": dict(out="see redd.it now"), "QA-16": dict(claim={"sourceId": "T1"}), "QA-17": dict(source={"evidenceType": "opinion"}), "QA-18": dict(source={"canonicalUrl": "https://a.org/X.PDF?y"}), "QA-19": dict(claim={"requiresFullTextVerification": False}),
}


def failing(spark, source=None, claim=None, counters=None, step=None, out="", target="NONE", also=()):
    make = lambda rows, schema: spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    claims = [SAID | (claim or {})]
    if source and "sourceId" in source:
        claims[0] = claims[0] | {"sourceId": "S1"}
    found = P.audit(make([SOUND | (source or {}), TRIAL], SOURCE), make(claims, CLAIM), spark.createDataFrame([(out,), (None,)], "text string"), spark.createDataFrame([(json.dumps(STEP | (step or {})),)], "text string"), SCHEMA, {"claimsExtracted": 1} | (counters or {}), target)
    rows = found.collect()
    assert len(rows) == 20
    return {r["check_id"] for r in rows if not r["passed"]} - {"ALL"}


def test_a_sound_package_passes(spark):
    assert failing(spark) == set()


@pytest.mark.parametrize("check", [*FAULTS])
def test_each_fault_fails_its_check(spark, check):
    assert failing(spark, **FAULTS[check]) - set(FAULTS[check].get("also", ())) == {check}
