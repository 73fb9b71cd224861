"""The answer graph of 22 nodes over a frame of questions: model nodes that never raise, routers as states of each row.

A model node is a function from the inputs of one row to a dictionary. It runs in
tasks, row by row, for the rows that reach it; what it raises, or returns in another
form than asked, becomes the row's ``status`` and ``error`` (``ok``, ``error``,
``invalid``, ``skipped``, ``not_configured``), and the row goes on with the node's rule.
No model can widen what the rules allow: the gate comes first, claims that were not
retrieved and verified are dropped, a critic's pass counts only beside the rule's, and
citations are made from the claims and never read from a text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import field

#: Names of the nodes, as they stand in a row's route.
NODES = (
    "receive_query", "check_safety_boundaries", "planner", "query_classifier", "query_reformulator", "evidence_retriever", "vector_retriever", "fusion_reranker", "source_applicability_checker", "evidence_analyst", "conflict_detector", "conflict_resolver", "gap_detector",
    "evidence_synthesizer", "safety_critic", "citation_verifier", "citation_reviewer", "qa_agent", "attach_citations_final", "fallback_if_unsupported", "refuse", "llm_unavailable",
)
BEFORE = NODES[2:13]
ATTEMPTS = 2
#: What each model node is asked for.
ASKED = {
    "planner": "steps array<string>", "query_classifier": "intent string", "query_reformulator": "terms array<string>", "evidence_analyst": "ids array<bigint>", "conflict_resolver": "kind string",
    "evidence_synthesizer": "text string", "safety_critic": "passed boolean", "citation_reviewer": "passed boolean", "qa_agent": "passed boolean",
}

Hook = Callable[[dict], dict]
#: What a draft must not say, by kind.
UNSAFE = {
    "diagnosis_language": (r"\byou have (uc|ulcerative colitis)\b", r"\byou are diagnosed\b"),
    "flare_prediction": (r"\byou will flare\b", r"\byou('re| are) (going|about) to flare\b"),
    "medication_change_language": (r"\bshould (start|stop|take|increase|decrease)\b.*(medication|dose|drug)\b", r"\bstop taking\b"),
    "individualized_diet_prescription": (r"\byour (personal|individualized|specific) diet plan\b", r"\byou must eat\b"),
    "causal_overstatement": ("causes", "cause of", "proven to cause", "results in", "leads to"),
    "symptom_inflammation_confusion": (r"\bno symptoms means no inflammation\b", r"\bsymptoms prove (active )?inflammation\b", r"\bsymptoms confirm inflammation\b"),
}


def ask(rows: DataFrame, node: str, hook: Hook | None, fields: str, inputs: list[str], where: Column | None = None, into: str | None = None) -> DataFrame:
    """``rows`` with a struct column ``into`` (by default the node's name): ``status, error`` and ``fields``, null unless ``status`` is ``ok``.

    ``hook`` gets a dictionary of ``inputs``; only rows that fulfil ``where`` are given to it.
    """
    into = into or node
    asked = T.StructType.fromDDL(fields)
    kind = T.StructType([T.StructField("status", T.StringType()), T.StructField("error", T.StringType()), *asked.fields])
    due = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    if hook is None:
        status = F.when(due, "not_configured").otherwise("skipped")
        return rows.withColumn(into, F.struct(status.alias("status"), F.lit(None).cast("string").alias("error"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in asked.fields]))
    types = {f.name: to_arrow_type(f.dataType) for f in asked.fields}
    nothing = dict.fromkeys(types)

    def one(row: dict) -> dict:
        if not row.pop("_due"):
            return {"status": "skipped", "error": None, **nothing}
        try:
            out = hook(row)
        except Exception as e:  # noqa: BLE001 - whatever a model's client raises stays with this row
            return {"status": "error", "error": type(e).__name__, **nothing}
        if not isinstance(out, dict) or set(out) != set(types):
            return {"status": "invalid", "error": "keys", **nothing}
        try:
            for name, t in types.items():
                pa.array([out[name]], t)
        except (pa.ArrowInvalid, pa.ArrowTypeError, pa.ArrowNotImplementedError, OverflowError):
            return {"status": "invalid", "error": "types", **nothing}
        return {"status": "ok", "error": None, **out}

    held = rows.withColumn("_due", due)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.select([*inputs, "_due"]).to_pylist()
            answers = pa.array([one(r) for r in given], to_arrow_type(kind))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], answers], [*names, into])

    return held.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(into, kind)]))


def unsafe_kinds(text: Column) -> Column:
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*[F.when(t.rlike("(?d)" + "|".join(f"(?:{p})" for p in ps)), k) for k, ps in UNSAFE.items()]))


def _template(claims: Column) -> Column:
    return F.concat(F.lit("Evidence found:\n\n"), F.array_join(F.transform(claims, lambda c, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), c["text"])), "\n\n"))


def run(questions: DataFrame, hooks: dict[str, Hook] | None = None, template: bool = False) -> DataFrame:
    """``status, attempts, answer, citations, route`` and each node's struct, for ``question, claims`` rows with columns of their own.

    ``claims``: array of ``id, text, excerpt, ok`` that a retrieval found for the question (null: none). With
    ``template`` a draft is put together from claims where the synthesiser gives none; without it such a row ends at
    ``llm_unavailable``. A null question is empty.
    """
    hooks = hooks or {}
    unknown = set(hooks) - set(ASKED)
    if unknown:
        raise ValueError(f"no model nodes: {sorted(unknown)}")
    empty = F.array().cast(questions.schema["claims"].dataType)
    rows = questions.withColumn("claims", F.coalesce("claims", empty)).withColumn("boundary", field.boundary(F.col("question")))
    open_ = F.col("boundary") == "none"

    def model(df: DataFrame, node: str, inputs: list[str], where: Column, into: str | None = None) -> DataFrame:
        return ask(df, node, hooks.get(node), ASKED[node], inputs, where, into)

    rows = model(rows, "planner", ["question"], open_)
    rows = model(rows, "query_classifier", ["question"], open_).withColumn("intent", F.coalesce("query_classifier.intent", field.intent(F.col("boundary"))))
    rows = model(rows, "query_reformulator", ["question"], open_)
    rows = rows.withColumn("verified", F.filter("claims", lambda c: F.coalesce(c["ok"], F.lit(False))))
    rows = model(rows, "evidence_analyst", ["question", "verified"], open_)
    # an analyst may put claims in order or leave some out; what it makes up is not there
    rows = rows.withColumn("verified", F.when(F.col("evidence_analyst.status") == "ok", F.filter("verified", lambda c: F.array_contains("evidence_analyst.ids", c["id"]))).otherwise(F.col("verified")))
    rows = rows.withColumn("conflict", F.size(F.array_distinct(F.transform("verified", lambda c: c["text"]))) > 1)
    rows = model(rows, "conflict_resolver", ["question", "verified"], open_ & F.col("conflict"))
    gap = field.unsupported(F.col("question")) | (F.size("verified") == 0)
    rows = rows.withColumn("gap", gap)
    due = open_ & ~F.col("gap")
    sound = F.forall("verified", lambda c: F.contains(c["text"], c["excerpt"]))
    for i in range(1, ATTEMPTS + 1):
        rows = model(rows, "evidence_synthesizer", ["question", "verified"], due, f"draft_{i}")
        text = F.col(f"draft_{i}.text")
        rows = rows.withColumn(f"text_{i}", F.when(due, F.coalesce(text, _template(F.col("verified"))) if template else text))
        written = due & F.col(f"text_{i}").isNotNull()
        rows = model(rows, "safety_critic", ["question", f"text_{i}"], written, f"critic_{i}")
        safe = written & (F.size(unsafe_kinds(F.col(f"text_{i}"))) == 0) & F.coalesce(F.col(f"critic_{i}.passed"), F.lit(True))
        cited = safe & F.coalesce(sound, F.lit(False))
        rows = model(rows, "citation_reviewer", ["question", "verified", f"text_{i}"], cited, f"review_{i}")
        rows = rows.withColumn(f"safe_{i}", safe).withColumn(f"cited_{i}", cited).withColumn(f"done_{i}", cited & F.coalesce(F.col(f"review_{i}.passed"), F.lit(True))).withColumn(f"due_{i}", due).withColumn(f"written_{i}", written)
        due = F.col(f"written_{i}") & ~F.col(f"done_{i}")
    done = F.coalesce(*[F.when(F.col(f"done_{i}"), i) for i in range(1, ATTEMPTS + 1)])
    rows = rows.withColumn("done", done)
    rows = model(rows, "qa_agent", ["question", "verified"], F.col("done").isNotNull())
    step = lambda i: F.when(F.col(f"due_{i}"), F.array_compact(F.array(F.lit(NODES[13]), F.when(F.col(f"written_{i}"), NODES[14]), F.when(F.col(f"safe_{i}"), NODES[15]), F.when(F.col(f"cited_{i}"), NODES[16])))).otherwise(F.array().cast("array<string>"))
    unwritten = F.lit(False)
    for i in range(1, ATTEMPTS + 1):
        unwritten = unwritten | (F.col(f"due_{i}") & ~F.col(f"written_{i}"))
    status = F.when(~open_, "refused").when(F.col("gap"), "fallback").when(F.col("done").isNotNull(), "answered").when(unwritten, "llm_unavailable").otherwise("refused")
    rows = rows.withColumn("status", status)
    last = F.when(F.col("status") == "answered", F.array(F.lit(NODES[17]), F.lit(NODES[18]))).when(F.col("status") == "fallback", F.array(F.lit(NODES[19]))).when(F.col("status") == "refused", F.array(F.lit(NODES[20]))).otherwise(F.array(F.lit(NODES[21])))
    before = F.when(open_, F.array(*[F.lit(n) for n in BEFORE])).otherwise(F.array().cast("array<string>"))
    route = F.concat(F.array(F.lit(NODES[0]), F.lit(NODES[1])), before, *[step(i) for i in range(1, ATTEMPTS + 1)], last)
    attempts = sum((F.col(f"due_{i}").cast("int") for i in range(1, ATTEMPTS + 1)), F.lit(0))
    answer = F.when(F.col("status") == "answered", F.when(F.col("done") == 1, F.col("text_1")).otherwise(F.col("text_2")))
    cites = F.when(F.col("status") == "answered", F.transform("verified", lambda c, i: F.struct((i + 1).alias("number"), c["id"].alias("id"))))
    return rows.withColumn("attempts", attempts).withColumn("answer", answer).withColumn("citations", cites).withColumn("route", route)
