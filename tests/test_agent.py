"""Model nodes that fail in workers, by row; critics that can only refuse; routes of every kind."""

import pytest
from pyspark.sql import functions as F

from quillmark.operators import agent as A

CLAIM = "array<struct<id:bigint,text:string,excerpt:string,ok:boolean>>"


@pytest.fixture(scope="module")
def questions(spark):
    claim = lambda i, t, e=None, ok=True: (i, t, e or t[:4], ok)
    rows = [
        (1, "what of fibre", [claim(1, "fibre helps"), claim(2, "fibre may help")]), (2, "Do I have UC?", [claim(1, "fibre helps")]), (3, "what of sleep", [claim(3, "x", ok=False)]), (4, "what of crp", [claim(1, "crp is one")]),
        (5, "what of milk", [claim(5, "you have uc")]), (6, "what of tea", [claim(6, "tea is one", "not there")]), (7, None, None), (8, "what of salt", [claim(8, "salt is one")]),
    ]
    return spark.createDataFrame(rows, f"id long, question string, claims {CLAIM}").repartition(3)


def by_id(frame):
    return {r["id"]: r for r in frame.collect()}


LONG = [*A.NODES[:2], *A.BEFORE]


def test_template_routes(questions):
    got = by_id(A.run(questions, template=True))
    assert {i: r["status"] for i, r in got.items()} == {1: "answered", 2: "refused", 3: "fallback", 4: "fallback", 5: "refused", 6: "refused", 7: "fallback", 8: "answered"}
    assert got[1]["route"] == [*LONG, *A.NODES[13:19]] and got[2]["route"] == ["receive_query", "check_safety_boundaries", "refuse"] and got[3]["route"] == [*LONG, "fallback_if_unsupported"]
    assert got[5]["route"] == [*LONG, *A.NODES[13:15], *A.NODES[13:15], "refuse"] and got[6]["route"] == [*LONG, *A.NODES[13:16], *A.NODES[13:16], "refuse"]
    assert got[1]["attempts"] == 1 and got[5]["attempts"] == 2 and [c["id"] for c in got[1]["citations"]] == [1, 2] and got[2]["citations"] is None
    assert got[1]["planner"]["status"] == "not_configured" and got[2]["planner"]["status"] == "skipped"
    assert {r["status"] for r in A.run(questions.filter("id in (1, 3)")).collect()} == {"llm_unavailable", "fallback"}
    assert A.run(questions.limit(0), template=True).count() == 0


def test_a_hook_that_raises_fails_for_its_row_only(questions):
    def write(row):
        if "salt" in row["question"]:
            raise TimeoutError("too slow")
        return {"text": f"text on {row['question']}"}

    got = by_id(A.run(questions, {"evidence_synthesizer": write}))
    assert got[1]["status"] == "answered" and got[1]["answer"] == "text on what of fibre" and got[1]["draft_1"]["status"] == "ok"
    assert got[8]["status"] == "llm_unavailable" and (got[8]["draft_1"]["status"], got[8]["draft_1"]["error"]) == ("error", "TimeoutError") and got[8]["route"] == [*LONG, "evidence_synthesizer", "llm_unavailable"]
    assert by_id(A.run(questions, {"evidence_synthesizer": write}, template=True))[8]["status"] == "answered"


@pytest.mark.parametrize("out, error", [(None, "keys"), ({"intent": "a", "more": 1}, "keys"), ({"intent": 3}, "types"), ({"intent": ["a"]}, "types")])
def test_outputs_of_another_form_give_way_to_the_rule(questions, out, error):
    r = by_id(A.run(questions, {"query_classifier": lambda row: out}, template=True))[1]
    assert (r["query_classifier"]["status"], r["query_classifier"]["error"], r["intent"], r["status"]) == ("invalid", error, "question", "answered")


def test_models_can_only_narrow(questions):
    got = by_id(A.run(questions, {"safety_critic": lambda row: {"passed": True}, "citation_reviewer": lambda row: {"passed": True}, "query_classifier": lambda row: {"intent": "x"}}, template=True))
    assert got[5]["status"] == "refused" and got[6]["status"] == "refused" and got[2]["status"] == "refused" and got[1]["intent"] == "x"
    got = by_id(A.run(questions, {"safety_critic": lambda row: {"passed": "salt" not in row["question"]}}, template=True))
    assert got[1]["status"] == "answered" and got[8]["status"] == "refused" and got[8]["attempts"] == 2
    got = by_id(A.run(questions, {"evidence_analyst": lambda row: {"ids": [2, 99]}}, template=True))
    assert [c["id"] for c in got[1]["citations"]] == [2] and got[8]["status"] == "fallback"


def test_second_drafts_are_asked_for_rows_that_need_one(spark, questions):
    calls = spark.sparkContext.accumulator(0)

    def write(row):
        calls.add(1)
        return {"text": "you will flare" if "fibre" in row["question"] else "fine"}

    got = by_id(A.run(questions.filter("id in (1, 8)"), {"evidence_synthesizer": write}))
    assert got[1]["status"] == "refused" and got[8]["status"] == "answered" and calls.value == 3
    with pytest.raises(ValueError):
        A.run(questions, {"refuse": write})
    assert A.ask(questions, "n", None, "a int", ["id"]).select(F.col("n.status")).distinct().count() == 1


DRAFTS = {
    "You have ulcerative colitis based on this evidence.": ["diagnosis_language"], "You will flare within the next two weeks.": ["flare_prediction"], "You should stop taking your medication now.": ["medication_change_language"], "Here is your personal diet plan for this week.": ["individualized_diet_prescription"],
    "This food causes ulcerative colitis flares.": ["causal_overstatement"], "Symptoms prove active inflammation is present.": ["symptom_inflammation_confusion"], "Based on the reviewed evidence, fibre intake was associated with symptom scores.": [],
}


def test_drafts_by_kind(spark):
    rows = spark.createDataFrame(list(enumerate(DRAFTS)), "i int, t string").select("i", A.unsafe_kinds(F.col("t")).alias("k")).collect()
    assert [r["k"] for r in sorted(rows)] == list(DRAFTS.values())
