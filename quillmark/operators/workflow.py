"""Answer workflow over a frame of questions: each node adds columns, branches are conditions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import Corpus, contains_any

REFUSALS = {"emergency": "Seek urgent care.", "dose": "Doses are outside the scope.", "diagnosis": "No diagnosis is given here.", "stop": "Changes of treatment need a clinician."}
FALLBACK = "The collection holds no verified evidence on this."


def gate(questions: DataFrame, preset: Corpus) -> DataFrame:
    """``boundary`` and ``unsupported`` before anything else."""
    t = F.lower(F.trim("question"))
    return questions.withColumn("boundary", preset.boundaries.first(t)).withColumn("unsupported", contains_any(t, preset.gap_terms))


def retrieve(questions: DataFrame, claims: DataFrame, k: int) -> DataFrame:
    """The ``k`` claims of a question's topic with the smallest ids, verified or not, as an array of structs in id order.

    Claims are ranked within their topic once, so a question meets ``k`` rows.
    """
    best = _first(claims, k)
    return questions.join(best, "topic", "left").withColumn("claims", F.coalesce("claims", F.array().cast(best.schema["claims"].dataType)))


def _first(claims: DataFrame, k: int) -> DataFrame:
    from pyspark.sql.window import Window

    few = claims.withColumn("_r", F.row_number().over(Window.partitionBy("topic").orderBy("id"))).filter(F.col("_r") <= k)
    return few.groupBy("topic").agg(F.sort_array(F.collect_list(F.struct("id", "text", "excerpt", "ok"))).alias("claims"))


def compose(claims: Column, field: str) -> Column:
    """Numbered lines, a blank one between."""
    return F.concat(F.lit("Evidence found:\n\n"), F.array_join(F.transform(claims, lambda c, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), c[field])), "\n\n"))


def answer(questions: DataFrame, claims: DataFrame, preset: Corpus, k: int = 3, critic: Callable[[Column], Column] | None = None, hook: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``status, attempts, n_citations, answer, trace`` of each question.

    Two drafts are composed, from claim texts and from excerpts; the first that
    the critic passes and whose claims are verified is taken. ``hook`` may rewrite
    the frame before composing (a model-backed node); without it nothing changes.
    """
    critic = critic or (lambda text: F.size(preset.critic.all(F.lower(text))) == 0)
    rows = retrieve(gate(questions, preset), claims, k)
    rows = hook(rows) if hook else rows
    rows = rows.withColumn("verified", F.filter("claims", lambda c: c["ok"]))
    rows = rows.withColumn("first", compose(F.col("verified"), "text")).withColumn("second", compose(F.col("verified"), "excerpt"))
    rows = rows.withColumn("ok1", critic(F.col("first"))).withColumn("ok2", critic(F.col("second")))
    gap = F.col("unsupported") | (F.size("verified") == 0)
    status = F.when(F.col("boundary") != "none", "refused").when(gap, "fallback").when(F.col("ok1"), "answered").when(F.col("ok2"), "answered").otherwise("fallback")
    attempts = F.when((F.col("boundary") != "none") | gap, 0).when(F.col("ok1"), 1).otherwise(2)
    rows = rows.withColumn("status", status).withColumn("attempts", attempts)
    refusal = F.try_element_at(F.create_map(*[F.lit(x) for kv in REFUSALS.items() for x in kv]), F.col("boundary"))
    text = F.when(F.col("status") == "refused", refusal).when(F.col("status") == "fallback", FALLBACK).when(F.col("attempts") == 1, F.col("first")).otherwise(F.col("second"))
    trace = F.array_compact(F.array(F.lit("gate"), F.when(F.col("status") != "refused", "retrieve"), F.when(F.col("attempts") > 0, "compose"), F.when(F.col("attempts") > 1, "retry"), F.col("status")))
    n = F.when(F.col("status") == "answered", F.size("verified")).otherwise(0).cast("long")
    return rows.withColumn("answer", text).withColumn("n_citations", n).withColumn("trace", F.array_join(trace, ">"))


def citations(answers: DataFrame) -> DataFrame:
    """``number`` and claim id of each citation of answered questions."""
    rows = answers.filter("status = 'answered'").select("conv_id", "turn", F.posexplode("verified").alias("i", "c"))
    return rows.select("conv_id", "turn", (F.col("i") + 1).alias("number"), F.col("c.id").alias("claim_id"))


def verify_citations(cited: DataFrame, claims: DataFrame) -> DataFrame:
    """``mismatch``: unknown, excerpt, or nothing, for citations with ``claim_id, excerpt``."""
    rows = cited.join(claims.select(F.col("id").alias("claim_id"), F.col("excerpt").alias("_e")), "claim_id", "left")
    return rows.withColumn("mismatch", F.when(F.col("_e").isNull(), "unknown").when(F.col("_e") != F.col("excerpt"), "excerpt").otherwise("")).drop("_e")


# ---- the long graph: every node that a model may take has a rule to fall back on ----

#: Nodes in order, and those that a hook may take.
NODES = ("gate", "plan", "reformulate", "classify", "retrieve", "fuse", "analyse", "resolve", "verify", "synthesise", "critic", "review", "evaluate")
HOOKED = ("plan", "reformulate", "classify", "analyse", "resolve", "synthesise", "critic", "review", "evaluate")
UNAVAILABLE = "No answer can be written without a model at present."


def hooked(rows: DataFrame, node: str, hooks: dict[str, Callable[[DataFrame], DataFrame]], rule: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, str]:
    """The frame after a node and who took it; a hook that fails or changes the keys gives way to the rule."""
    hook = hooks.get(node)
    if hook is None:
        return rule(rows), "rule"
    try:
        out = hook(rows)
        if not set(rows.columns) <= set(out.columns):
            return rule(rows), "rule (hook lost columns)"
        return out, "model"
    except Exception as e:  # noqa: BLE001 - whatever a model's client raises, the rule answers
        return rule(rows), f"rule ({type(e).__name__})"


def graph(questions: DataFrame, claims: DataFrame, preset: Corpus, k: int = 3, hooks: dict[str, Callable[[DataFrame], DataFrame]] | None = None, template: bool = True, critic: Callable[[Column], Column] | None = None) -> DataFrame:
    """``status, route, sufficient, resolution`` beside the columns of ``answer``.

    The critic's rule always holds: a hook can only refuse more. Without a template
    and a ``synthesise`` hook an answer ends as ``llm_unavailable``. The analyst keeps
    claims that were retrieved; what a hook adds is dropped.
    """
    hooks = hooks or {}
    takers: dict[str, str] = {}
    same = lambda rows: rows
    for node in ("plan", "reformulate", "classify"):
        questions, takers[node] = hooked(questions, node, hooks, same)

    def analysed(rows: DataFrame) -> DataFrame:
        ids = F.transform("claims", lambda c: c["id"])
        out, takers["analyse"] = hooked(rows.withColumn("_ids", ids), "analyse", hooks, same)
        out = out.withColumn("claims", F.filter("claims", lambda c: F.array_contains("_ids", c["id"]))).drop("_ids")
        out, takers["resolve"] = hooked(out, "resolve", hooks, same)
        return out

    rows = answer(questions, claims, preset, k, critic=critic, hook=analysed)
    for node in ("synthesise", "critic", "review", "evaluate"):
        rows, takers[node] = hooked(rows, node, hooks, same)
    written = takers["synthesise"] == "model" or template
    status = F.col("status") if written else F.when(F.col("status") == "answered", "llm_unavailable").otherwise(F.col("status"))
    rows = rows.withColumn("status", status).withColumn("answer", F.when(F.col("status") == "llm_unavailable", UNAVAILABLE).otherwise(F.col("answer")))
    name = lambda n: f"{n}*" if takers.get(n, "").startswith("model") else n
    upto = {"refused": 1, "fallback": NODES.index("verify") + 1, "llm_unavailable": NODES.index("synthesise") + 1, "answered": len(NODES)}
    reached = F.lit(len(NODES))
    for s, n in upto.items():
        reached = F.when(F.col("status") == s, n).otherwise(reached)
    route = F.array_join(F.slice(F.array(*[F.lit(name(n)) for n in NODES]), F.lit(1), reached), ">")
    resolution = F.when(F.size("verified") > 1, "passed through").otherwise("nothing to resolve")
    return rows.withColumn("route", route).withColumn("sufficient", F.size("verified") > 0).withColumn("resolution", resolution)
