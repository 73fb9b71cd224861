"""Rule tables of the field on sentences of their own kind, nested content, and conflicts by counting."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quillmark.functions import field
from quillmark.operators import aggregates, nested


def values(spark, rows, *columns):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [tuple(r)[1:] for r in sorted(frame.select("i", *columns).collect())]


QUESTIONS = {
    "Do I have UC?": "diagnosis_seeking", "Is this a flare": "diagnosis_seeking", "  What's wrong with me ": "diagnosis_seeking", "Will I have a flare next week?": "flare_prediction_seeking", "When will my flare come": "flare_prediction_seeking",
    "Should I stop taking my medication?": "medication_change_seeking", "increase my dose": "medication_change_seeking", "Give me a diet plan": "diet_plan_seeking", "Make me a meal plan for UC": "diet_plan_seeking",
    "Does my pain mean I am inflamed?": "symptom_inflammation_question", "Does symptom relief mean inflammation is gone": "symptom_inflammation_question", "Can Crohn's evidence be used: apply it to UC": "crohns_misapplication",
    "use crohns\nresults\nand extend them to ulcerative colitis": "crohns_misapplication", "What does the evidence say about fibre?": "question", "Is Crohn's like UC?": "question", "": "question", None: "question",
}


def test_questions_get_their_intents(spark):
    got = values(spark, list(QUESTIONS), field.intent(field.boundary(F.col("t"))))
    assert [x for x, in got] == list(QUESTIONS.values())


def test_unsupported_subjects_and_excluded_claims(spark):
    assert [x for x, in values(spark, ["Is CRP useful", "JAK inhibitor", "fibre", None], field.unsupported(F.col("t")))] == [True, True, False, False]
    rows = ["It cures all", "stop your medication", "predicts the next flare", "a meal that caused inflammation", "a detox tea", "fibre helped", None]
    assert [x for x, in values(spark, rows, field.excluded_by(F.col("t")))] == [1, 2, 3, 4, 5, 0, 0]


def test_topics_contexts_scores_openings_reasons(spark):
    t = F.col("t")
    many = "mediterranean fibre milk coffee alcohol sleep tobacco"
    assert values(spark, [many, "Active disease after surgery", "nothing", None], field.topics(t), field.contexts(t)) == [
        (["dietary_patterns", "fibre", "dairy_lactose", "coffee_caffeine", "alcohol", "sleep"], ["general_or_unspecified"]), (["post_surgery"], ["active_disease", "post_surgery"]), (["core_condition_knowledge"], ["general_or_unspecified"]), (["core_condition_knowledge"], ["general_or_unspecified"]),
    ]
    assert [x for x, in values(spark, ["Fibre reduced it", "The aim was sleep", "We searched a database", "The aims improved", ""], field.sentence_score(t))] == [8, 0, -5, 5, 0]
    assert [x for x, in values(spark, ["RESULTS: Alcohol  10 men", "Best practice advice 12: eat", "BACKGROUND & AIMS: 10 x", "Overall, x"], field.clean_opening(t))] == ["men", "eat", "x", "Overall, x"]
    why = [r[2] for r in field.REASONS]
    got = values(spark, ["Risk rose", "Therapy is preferred", "Pain fell", "We eat", "We eat"], field.revision_reason(t, F.when(F.col("i") == 2, "symptoms"), F.when(F.col("i") == 3, "expert")))
    assert [x for x, in got] == why


def test_content_not_kept_is_found_at_its_path(spark):
    kept = {"fine": "a diet of fibre", "n": 3, "deep": [[{"x": None, "y": True}]]}
    bad = {"a": ["ok", {"b": "You HAVE uc", "you will flare": 1}], "c": {"d": [["it is clinically approved; you should stop the drug"]]}, 'q"uote': 'say "guaranteed to work"'}
    rows = [(1, json.dumps(kept)), (2, json.dumps(bad)), (3, '"this cures the UC"'), (4, "no json: confirmed flare"), (5, None), (6, "[]"), (7, "{}"), (7, '["your UC is active"]')]
    got = {(r["id"], r["path"]): r["kinds"] for r in nested.denied(spark.createDataFrame(rows, "id long, json string")).collect()}
    assert got == {
        (2, "$.a[1].b"): ["diagnosis"], (2, "$.a[1].you will flare~"): ["flare"], (2, "$.c.d[0][0]"): ["treatment", "unsupported"], (2, '$.q"uote'): ["unsupported"], (3, "$"): ["unsupported"], (4, "$"): ["diagnosis"], (7, "$[0]"): ["diagnosis"],
    }
    assert nested.denied(spark.createDataFrame([], "id long, json string")).count() == 0


def brute_conflicts(claims):
    out = []
    for i, a in enumerate(claims):
        hits = []
        for j, b in enumerate(claims):
            if i != j and (a[1] or "") == (b[1] or ""):
                dc, dx, op = set(a[2] or []) != set(b[2] or []), set(a[3] or []) != set(b[3] or []), {a[4], b[4]} == {"symptoms", "inflammation"}
                hits.append((dc, dx, op, (dc or dx or op) and (a[5] or "") != (b[5] or ""), dc or dx or op, b[0]))
        n = lambda k, h=hits: sum(x[k] for x in h)
        out.append((a[0], a[1] or "", n(4), n(0), n(1), n(2), n(3), min((x[5] for x in hits if x[4]), default=None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_set_conflicts_equal_all_pairs(spark, seed):
    random.seed(seed)
    some = lambda xs: None if random.random() < 0.1 else random.choices(xs, k=random.randrange(3))
    claims = [(i, random.choice(["a", "a", "a", "b", "c", None]), some("xy"), some("pqr"), random.choice(["symptoms", "inflammation", "other", None]), random.choice(["high", "low", None])) for i in range(120)]
    claims += [(500, "alone", ["x"], [], "symptoms", "low"), (601, "pair", ["x", "y", "x"], ["p"], "symptoms", "low"), (602, "pair", ["y", "x"], ["p"], "inflammation", "high"), (603, "pair", ["y", "x"], ["p"], "other", "high")]
    frame = spark.createDataFrame(claims, "id long, topic string, conditions array<string>, contexts array<string>, outcome string, level string")
    got = sorted((tuple(r) for r in aggregates.set_conflicts(frame).collect()), key=str)
    assert got == brute_conflicts(claims)


def test_set_conflicts_read_their_claims_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    kinds = "id long, topic string, conditions array<string>, contexts array<string>, outcome string, level string"
    claims = spark.createDataFrame([(i, "a", ["x"], ["p"], "symptoms" if i % 2 else "inflammation", "low") for i in range(40)], kinds).mapInArrow(count, kinds)
    assert {r["n_conflicts"] for r in aggregates.set_conflicts(claims).collect()} == {20} and read.value == 40


def test_topics_lower_a_text_once(spark):
    frame = spark.createDataFrame([(1, "MILK and Red Meat in active disease"), (2, None)], "id long, text string").select("id", field.topics(F.col("text")).alias("t"), field.contexts(F.col("text")).alias("c"))
    assert frame._jdf.queryExecution().executedPlan().toString().count("lower(") == 2  # one for each column
    assert [(r["t"], r["c"]) for r in frame.orderBy("id").collect()] == [(["dairy_lactose", "red_processed_meat"], ["active_disease"]), ([field.NO_TOPIC], [field.NO_CONTEXT])]
