"""Screening: labels, dispositions, budgets, funnels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..functions.lexicon import Corpus, contains_any
from .storage import running, save


def applicability(t: Column, preset: Corpus) -> Column:
    """Of lower-case text: in focus, the neighbouring condition only, both or a general word, unknown."""
    focus, other, general = (contains_any(t, x) for x in (preset.focus, preset.other, preset.general))
    return F.when(focus & ~other, "focus").when(other & ~focus, "other_only").when(focus | general, "general").otherwise("unknown")


def study_class(t: Column) -> Column:
    def of(study: str, weight: int) -> Column:
        return F.struct(F.lit(study).alias("study"), F.lit(weight).alias("weight"))

    return F.when(contains_any(t, ("license", "licence")), of("guideline", 50)).when(t.rlike("[0-9]{4}"), of("report", 35)).otherwise(of("paper", 25))


def intent(boundary: Column) -> Column:
    return F.when(boundary == "none", "information").when(boundary == "emergency", "urgent").otherwise(F.concat(F.lit("refuse_"), boundary))


def lint(q: Column) -> dict[str, Column]:
    """Balanced parentheses and an even number of quotes."""
    without = lambda c: F.length(F.replace(q, F.lit(c), F.lit("")))
    return {"balanced": without("(") == without(")"), "even_quotes": (F.length(q) - without('"')) % 2 == 0}


def lint_faults(q: Column, forbidden: tuple[str, ...] = ("[ti]", "[au]", "[mesh:noexp]"), range_tag: str = "[edat]") -> Column:
    """Faults of a search term: brackets, quotes, tags that are not allowed, a date range without both ends, an empty clause."""
    low, flat = F.lower(q), lint(q)
    halves = F.size(F.regexp_extract_all(low, F.lit(range_tag.replace("[", "\\[").replace("]", "\\]")), F.lit(0)))
    return F.array_compact(
        F.array(
            F.when(~flat["balanced"], "unbalanced brackets"), F.when(~flat["even_quotes"], "odd quotes"), F.when(contains_any(low, forbidden), "forbidden tag"), F.when(halves % 2 != 0, "open range"), F.when(low.rlike(r"\(\s*\)|(?:and|or)\s*$"), "empty clause")
        )
    )


def trial_disposition(status: Column, kind: Column, abstract_length: Column) -> Column:
    """Rules for registry and guideline records: no results yet, withdrawn, no passage, accepted."""
    return (
        F.when((kind == "trial") & status.isin("WITHDRAWN", "UNKNOWN"), "rejected: registry status")
        .when((kind == "trial") & ~status.isin("COMPLETED", "TERMINATED"), "deferred: no results yet")
        .when((kind == "guideline") & (abstract_length < 40), "deferred: no public passage")
        .otherwise("accepted")
    )


def duplicate_keys(records: DataFrame, least_title: int = 25, **more: Column) -> DataFrame:
    """``doc_id``, content hash ``h``, long-enough title ``ti`` and ``more``, written: texts are read once and not shuffled."""
    title = X.norm_title(X.title_of(F.col("text")))
    keys = records.select("doc_id", X.content_hash(F.col("text")).alias("h"), title.alias("ti"), *[c.alias(k) for k, c in more.items()])
    return save(keys.withColumn("ti", F.when(F.length("ti") >= least_title, F.col("ti"))), "keys")


def with_reason(keys: DataFrame, name: str = "reason") -> DataFrame:
    """The keys with the reason why an earlier record (by ``doc_id``) makes this one a duplicate, if one does.

    One aggregate a key, joined back: the first holder of a key is the original.
    """
    first_h = keys.groupBy("h").agg(F.min("doc_id").alias("h0"))
    first_t = keys.filter("ti IS NOT NULL").groupBy("ti").agg(F.min("doc_id").alias("t0"))
    both = keys.join(first_h, "h").join(first_t, "ti", "left")
    reason = F.when(F.col("h0") < F.col("doc_id"), F.concat(F.lit("content:"), F.left("h", F.lit(12)))).when(F.col("t0") < F.col("doc_id"), F.concat(F.lit("title:"), F.left("ti", F.lit(60))))
    return both.withColumn(name, reason).drop("h", "ti", "h0", "t0")


def prior_duplicates(records: DataFrame, least_title: int = 25) -> DataFrame:
    """``doc_id, reason``: an earlier record (by ``doc_id``) has the same content, or the same title if long enough."""
    return with_reason(duplicate_keys(records, least_title)).select("doc_id", "reason")


def disposition(records: DataFrame, preset: Corpus) -> DataFrame:
    """``doc_id, source, status, reason`` in fixed precedence: duplicate, not relevant, other condition, metadata, short, accepted."""
    t = F.lower(F.col("text"))
    label = applicability(t, preset)
    missing = F.coalesce(X.strip(X.title_of(F.col("text"))), F.lit("")) == ""
    verdict = lambda status, reason: F.struct(F.lit(status).alias("status"), reason.alias("reason"))
    alone = (
        F.when(~preset.relevant.hits(t, "relevant"), verdict("rejected", F.lit("not relevant: no priority keyword")))
        .when(label == "other_only", verdict("rejected", F.lit("other condition; label")))
        .when(missing, verdict("deferred", F.lit("metadata: title missing")))
        .when(F.length("text") < 120, verdict("deferred", F.lit("abstract: too short")))
        .otherwise(verdict("accepted", F.concat(F.lit("accepted: "), label)))
    )
    rows = with_reason(duplicate_keys(records, source=F.col("source"), alone=alone), "dup")
    out = F.when(F.col("dup").isNotNull(), F.struct(F.lit("duplicate").alias("status"), F.col("dup").alias("reason"))).otherwise(F.col("alone"))
    return rows.select("doc_id", "source", out.alias("o")).select("doc_id", "source", "o.status", "o.reason")


def funnel(dispositions: DataFrame) -> DataFrame:
    """Counters for each source and in total (``ALL``), and whether they reconcile."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    out = dispositions.rollup("source").agg(F.count(F.lit(1)).alias("screened"), *[count(s) for s in ("accepted", "deferred", "rejected", "duplicate")])
    return out.withColumn("source", F.coalesce("source", F.lit("ALL"))).withColumn("reconciled", F.expr("accepted + deferred + rejected + duplicate = screened"))


def interleaved(records: DataFrame, day_of_year: int) -> DataFrame:
    """Round robin over the sources, whose order is turned by the day: ``doc_id, source, turn, slot``.

    Position follows from (turn, slot) alone, so no global sort is needed.
    """
    names = records.select("source").distinct().withColumn("i", F.row_number().over(Window.orderBy("source")) - 1)
    n = names.count()
    slots = names.select("source", F.pmod(F.col("i") - day_of_year, F.lit(n)).cast("long").alias("slot"))
    turns = running(records.select("doc_id", "source"), {"turn": F.lit(1)}, "doc_id", by=("source",))
    return turns.join(slots, "source").select("doc_id", "source", "turn", "slot")


def budget(records: DataFrame, most: int, most_accepted: int) -> DataFrame:
    """Sticky stop: rows in order of ``doc_id`` with ``free`` and ``accepted`` flags; costly rows count until a limit is met."""
    rows = running(records.select("doc_id", "free", "accepted"), {"spent": ~F.col("free"), "taken": F.col("accepted")}, "doc_id", include=False)
    return rows.select("doc_id", (F.col("free") | ((F.col("spent") < most) & (F.col("taken") < most_accepted))).alias("screened"))
