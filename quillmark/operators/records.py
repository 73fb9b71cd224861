"""Derived records: staged sources and claims, notes, decisions, replays of edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..functions.lexicon import contains_any
from .storage import running, save

#: Abbreviations that plain language spells out, in order.
PLAIN = (("tion", "tion (process)"), ("keit", "keit (state)"))
REGIONS = {"en": "Anglophone sources", "fr": "Francophone sources", "de": "German-language sources"}


def locator(title: Column, identifier: Column, section: Column) -> Column:
    """``title; identifier; section`` without what is empty, or a fixed text."""
    parts = F.concat_ws("; ", *[X.empty_to_null(c) for c in (title, identifier, section)])
    return F.coalesce(F.nullif(parts, F.lit("")), F.lit("location not stated"))


def region_note(labels: Column) -> Column:
    note = F.lit("Region not stated")
    for key in reversed(REGIONS):
        note = F.when(F.contains(labels, F.lit(key)), REGIONS[key]).otherwise(note)
    return note


def plain_language(x: Column, observational: Column) -> Column:
    for short, long in PLAIN:
        x = F.replace(x, F.lit(short), F.lit(long))
    return F.concat(F.when(observational, "Observed: ").otherwise(""), X.clip_sentence(x))


def archival(open_access: Column, license_: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(open_access & contains_any(F.lower(license_), tokens), "archive").otherwise("metadata only")


def source_records(docs: DataFrame, run_id: str) -> DataFrame:
    """Staged source rows with nested provenance."""
    title, t = X.title_of(F.col("text")), F.lower("text")
    # the first line with the word; a pattern over the whole text would try each start of a long line
    license_ = F.coalesce(F.get(F.filter(F.split("text", "\n"), lambda x: F.lower(x).rlike("licen[sc]e")), F.lit(0)), F.lit(""))
    return docs.select(
        "doc_id", X.strip(title).alias("title"), F.col("source").alias("provider"), F.nullif(license_, F.lit("")).alias("license"), archival(license_ != "", license_, ("apache", "mit", "cc by")).alias("archival"),
        region_note(F.col("lang")).alias("region"), (F.length("text") < 500).alias("needs_full_text"), F.struct(F.lit(run_id).alias("run_id"), X.content_hash(F.col("text")).alias("checksum"), F.contains(t, F.lit("license")).alias("licensed")).alias("provenance"),
    )


def claims(docs: DataFrame, score, unsupported: dict[str, str], per_source: int, most: int) -> DataFrame:
    """Best sentences of each document as claims: patterns reject with a reason, the first ``per_source`` stay, ``most`` within a source.

    Sentences never leave their row before they are chosen.
    """
    scored = F.transform(X.sentences(F.col("text")), lambda s, i: F.struct((-score(s)).alias("m"), i.alias("no"), s.alias("s")))
    rows = docs.select("doc_id", "source", F.explode(F.slice(F.sort_array(scored), 1, per_source)).alias("x")).select("doc_id", "source", F.col("x.no").alias("sentence_no"), F.col("x.s").alias("claim"))
    reason = F.lit("")
    for why, pattern in reversed(unsupported.items()):
        reason = F.when(F.col("claim").rlike(pattern), why).otherwise(reason)
    rows = rows.withColumn("rejected", reason)
    rows = save(rows, "claims")
    kept = running(rows.filter("rejected = ''"), {"_n": F.lit(1)}, "doc_id", "sentence_no", by=("source",)).filter(F.col("_n") <= most).drop("_n")
    return kept.unionByName(rows.filter("rejected <> ''"))


def accounting(rows: DataFrame) -> DataFrame:
    """Claims by remediation category, and whether the categories add up to all."""
    category = F.when(F.col("duplicate"), "removed_duplicate").when(F.col("quality") == 0, "replaced").when(F.col("toxic") == 1, "revised").when(F.col("quality").isNull(), "unreviewed").otherwise("kept")
    out = rows.groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("total", F.sum("n").over(Window.partitionBy()))


def in_window(listing: DataFrame, baseline: DataFrame, start: Column, end: Column, floor: Column) -> DataFrame:
    """Listing rows not older than the floor that are unseen or dated within the window."""
    seen = listing.join(baseline.select("url").distinct().withColumn("_seen", F.lit(True)), "url", "left")
    return seen.filter((F.col("day") >= floor) & (F.col("_seen").isNull() | F.col("day").between(start, end))).drop("_seen")


def replay(base: DataFrame, edits: DataFrame, key: str) -> DataFrame:
    """Rows of ``base``, those with edits replaced by them (one row may become several)."""
    touched = edits.select(key).distinct()
    return base.join(touched, key, "left_anti").withColumn("part", F.lit(0)).unionByName(edits, allowMissingColumns=True)


def translation_check(rows: DataFrame, errors: Column, warnings: Column, benign: str, translation: Column, expected: tuple[str, ...]) -> DataFrame:
    """A query stands if it has no error, no warning but the benign one, and its translation holds all parts."""
    ok = (F.size(errors) == 0) & F.forall(warnings, lambda w: w == benign)
    for part in expected:
        ok = ok & F.contains(translation, F.lit(part))
    return rows.withColumn("translated", ok)


def sanitised(rows: DataFrame, allowed: list[str], text: str, most: int = 300) -> DataFrame:
    """Allow-listed columns only; outputs with addresses or handles, or over long, are flagged."""
    bad = F.col(text).rlike(r"https?://|www\.|(?:^|\s)@[A-Za-z0-9_]+|[A-Za-z0-9.]+@[A-Za-z0-9.-]+") | (F.length(text) > most) | (F.col(text) == "")
    return rows.select(*allowed).withColumn("violation", bad)
