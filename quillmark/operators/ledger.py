"""What earlier runs know: identifier index, rejected keys, baselines; lookups by id, caps, audits, first-wins unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .retrieval import top
from .storage import running, save, small

#: Kinds of identity keys in order of precedence, and whether a key of the kind is enough to tell two records apart.
KINDS = (("doi", True), ("pmid", True), ("pmcid", True), ("trial_id", True), ("canonical_url", False), ("content_hash", False), ("normalized_title", False))
#: Kinds that count only for records without a strong identifier.
WEAK = ("content_hash", "normalized_title")
#: Characters of a key that a reason shows.
SHOWN = {"content_hash": 12, "normalized_title": 60}


def identity_index(*sources: DataFrame) -> DataFrame:
    """``kind, value``: distinct keys of all known records (``KINDS`` as columns); empty ones are dropped."""
    rows = [s.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k, _ in KINDS])).alias("x")) for s in sources]
    return reduce(DataFrame.unionByName, rows).select("x.kind", "x.value").filter(F.coalesce("value", F.lit("")) != "").distinct()


def duplicate_reasons(records: DataFrame, index: DataFrame) -> DataFrame:
    """``doc_id, reason``: the first kind, in order of precedence, whose key is known.

    Keys are joined as rows (kind, value), one join for all kinds.
    """
    strong = reduce(lambda a, b: a | b, [F.coalesce(F.col(k), F.lit("")) != "" for k, s in KINDS if s])
    use = [F.when((F.coalesce(F.col(k), F.lit("")) != "") & (~strong if k in WEAK else F.lit(True)), F.struct(F.lit(i).alias("at"), F.lit(k).alias("kind"), F.col(k).alias("value"))) for i, (k, _) in enumerate(KINDS)]
    keys = records.select("doc_id", F.explode(F.array_compact(F.array(*use))).alias("x")).select("doc_id", "x.*")
    first = keys.join(index, ["kind", "value"], "left_semi").groupBy("doc_id").agg(F.min(F.struct("at", "kind", "value")).alias("m"))
    shown = reduce(lambda out, kv: F.when(F.col("m.kind") == kv[0], F.left("m.value", F.lit(kv[1]))).otherwise(out), SHOWN.items(), F.col("m.value"))
    reason = F.concat(F.lit("duplicate_"), F.col("m.kind"), F.lit(":"), shown)
    return records.select("doc_id").join(first.select("doc_id", reason.alias("reason")), "doc_id", "left")


def remember(rejections: DataFrame, least: int = 120, last: int = 4000) -> DataFrame:
    """``provider, identity`` of rejections judged on enough text: the latest ``last`` of each provider."""
    judged = rejections.filter((F.length("abstract") >= least) & (F.col("identity") != ""))
    newest = judged.groupBy("provider", "identity").agg(F.max("seen").alias("seen"))
    ranked = running(newest, {"_n": F.lit(1)}, F.desc("seen"), "identity", by=("provider",))
    return ranked.filter(F.col("_n") <= last).select("provider", "identity")


def recalled(candidates: DataFrame, memory: DataFrame) -> DataFrame:
    """Candidates with ``remembered``."""
    return candidates.join(memory.withColumn("remembered", F.lit(True)), ["provider", "identity"], "left").withColumn("remembered", F.coalesce("remembered", F.lit(False)))


def baseline(old: DataFrame, new: DataFrame, by: str, value: str, most: int = 500) -> DataFrame:
    """The union of two listings: of each ``by`` the first ``most`` values in order."""
    every = old.select(by, value).unionByName(new.select(by, value)).distinct()
    return running(every, {"_n": F.lit(1)}, value, by=(by,)).filter(F.col("_n") <= most).drop("_n")


def first_wins(*lists: DataFrame, key: list[str]) -> DataFrame:
    """Bag union: of rows with one key the one of the earliest list stays, with its ``list`` number."""
    rows = reduce(DataFrame.unionByName, [x.withColumn("list", F.lit(i)) for i, x in enumerate(lists)])
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.min(F.struct("list", *[c for c in rest if c != "list"])).alias("r"))
    return best.select(*key, "r.*")


def resolve(ids: DataFrame, ranked: DataFrame, package: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Fused ids with the ranked list's row, else the package's; ids that neither has are dropped."""
    a = ranked.select(key, F.struct(*columns).alias("_a"))
    b = package.select(key, F.struct(*columns).alias("_b"))
    rows = ids.join(a, key, "left").join(b, key, "left").withColumn("_r", F.coalesce("_a", "_b")).filter(F.col("_r").isNotNull())
    return rows.select(*ids.columns, F.when(F.col("_a").isNotNull(), "ranked").otherwise("package").alias("origin"), *[F.col(f"_r.{c}").alias(c) for c in columns])


def lookup(requests: DataFrame, claims: DataFrame, excluded: DataFrame) -> DataFrame:
    """Asked claims with ``found`` and the reason, in fixed order: excluded, unknown, other condition only, not eligible."""
    rows = requests.join(excluded.select("claim_id").distinct().withColumn("_x", F.lit(True)), "claim_id", "left").join(claims.select("claim_id", "label").withColumn("_k", F.lit(True)), "claim_id", "left")
    reason = F.when(F.col("_x"), "excluded_claim").when(F.col("_k").isNull(), "unknown_claim_id").when(F.col("label") == "other_only", "other_condition_only").when(F.col("label") == "unknown", "not_eligible").otherwise("eligible")
    return rows.select(*requests.columns, (reason == "eligible").alias("found"), reason.alias("reason"))


def search(ranked: DataFrame, claims: DataFrame, excluded: DataFrame, columns: list[str]) -> DataFrame:
    """The search tool: ranked claims that are known, eligible, current and not excluded, with their payload in ranked order."""
    rows = ranked.join(claims, "claim_id").join(excluded.select("claim_id"), "claim_id", "left_anti")
    return rows.filter(F.col("label").isin("focus", "general") & ~F.col("superseded")).select("query", "rank", "claim_id", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])


def source_of(requests: DataFrame, sources: DataFrame) -> DataFrame:
    """Asked sources with ``found`` and ``status``."""
    rows = requests.join(sources.select("source_id", F.col("status").alias("_s")), "source_id", "left")
    return rows.select(*requests.columns, F.col("_s").isNotNull().alias("found"), F.coalesce("_s", F.lit("unknown_source_id")).alias("status"))


def citation_mismatches(cited: DataFrame, claims: DataFrame) -> DataFrame:
    """``reason``: the first of unknown id, url, excerpt and locator that does not agree, or nothing."""
    own = claims.select("claim_id", F.struct("url", "excerpt", "locator").alias("_o"))
    rows = cited.join(own, "claim_id", "left")
    reason = F.when(F.col("_o").isNull(), "unknown_claim_id")
    for c in ("url", "excerpt", "locator"):
        reason = reason.when(~F.col(c).eqNullSafe(F.col(f"_o.{c}")), f"{c}_mismatch")
    return rows.select(*cited.columns, reason.otherwise("").alias("reason"))


def limitations_kept(cited: DataFrame, claims: DataFrame) -> DataFrame:
    """``faults``: 1 for an unknown claim or a blank limitation, else one for each of two fields that differ."""
    own = claims.select("claim_id", F.struct("limitations", "applicability").alias("_o"))
    rows = cited.join(own, "claim_id", "left")
    blank = (F.trim(F.coalesce("limitations", F.lit(""))) == "") | (F.trim(F.coalesce("applicability", F.lit(""))) == "")
    differ = sum(((~F.col(c).eqNullSafe(F.col(f"_o.{c}"))).cast("int") for c in ("limitations", "applicability")), F.lit(0))
    return rows.select(*cited.columns, F.when(F.col("_o").isNull() | blank, 1).otherwise(differ).alias("faults"))


def selection(records: DataFrame, roster: list, guidelines: int, most: int) -> DataFrame:
    """``doc_id, decision, reason`` of one greedy run: the roster in its order, then all others, which can only be refused.

    Refused rows use up no cap. Only roster rows can be chosen, so they alone are put
    in order; the others need no more than the two final counts.
    """
    place = F.array_position(F.array(*[F.lit(x) for x in roster]), F.col("doc_id"))
    rows = records.withColumn("_p", F.when(place > 0, place))
    known = rows.filter("_p IS NOT NULL")
    line = Window.partitionBy().orderBy("_p")  # at most the roster's rows
    usable = ~F.col("no_abstract")
    known = known.withColumn("_g", F.sum((usable & F.col("guideline")).cast("int")).over(line))
    known = known.withColumn("_ok", usable & (~F.col("guideline") | (F.col("_g") <= guidelines)))
    known = known.withColumn("_run", F.sum(F.col("_ok").cast("int")).over(line)).withColumn("_in", F.col("_ok") & (F.col("_run") <= most))
    known = save(known.withColumn("_used", F.coalesce(F.sum((F.col("_in") & F.col("guideline")).cast("int")).over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "roster")
    ends = known.agg(F.coalesce(F.sum((F.col("_in") & F.col("guideline")).cast("int")), F.lit(0)).alias("_eg"), F.coalesce(F.sum(F.col("_in").cast("int")), F.lit(0)).alias("_en"))
    why = F.when(F.col("_in"), "").when(F.col("no_abstract"), "no abstract").when(F.col("guideline") & (F.col("_used") >= guidelines), "guideline cap").otherwise("total cap")
    chosen = known.select("doc_id", F.when(F.col("_in"), "selected").otherwise("rejected").alias("decision"), why.alias("reason"))
    others = rows.filter("_p IS NULL").crossJoin(F.broadcast(ends))  # one row
    why = F.when(F.col("no_abstract"), "no abstract").when(F.col("guideline") & (F.col("_eg") >= guidelines), "guideline cap").when(F.col("_en") >= most, "total cap").otherwise("not in roster")
    return chosen.unionByName(others.select("doc_id", F.lit("rejected").alias("decision"), why.alias("reason")))


def claim_caps(claims: DataFrame, per_source: int, most: int) -> DataFrame:
    """``claim_id, kept``: the first ``per_source`` of each source (by ``place``), then the first ``most`` of all, in order of source and place."""
    own = running(claims.select("claim_id", "source_id", "place"), {"_n": F.lit(1)}, "place", "claim_id", by=("source_id",))
    ranked = running(own, {"_all": F.col("_n") <= per_source}, "source_id", "place", "claim_id")
    return ranked.select("claim_id", ((F.col("_n") <= per_source) & (F.col("_all") <= most)).alias("kept"))


def conflict_details(links: DataFrame, claims: DataFrame) -> DataFrame:
    """Each flagged pair with source and text of both claims."""
    side = lambda s: claims.select(F.col("claim_id").alias(s), F.col("source_id").alias(f"source_{s}"), F.col("text").alias(f"text_{s}"))
    return links.join(side("a"), "a").join(side("b"), "b")


def identifier_audit(corrections: DataFrame, sources: DataFrame) -> DataFrame:
    """Corrections (``source_id, old, corrected``) beside what the sources hold."""
    rows = sources.join(small(corrections), "source_id")
    state = F.when(F.col("identifier") == F.col("corrected"), "corrected").when(F.col("identifier") == F.col("old"), "still old").otherwise("neither")
    return rows.select("source_id", "old", "corrected", state.alias("state"))


def remediation(claims: DataFrame, overrides: DataFrame) -> DataFrame:
    """``status`` (an override, else by what the claim lacks), ``issues`` joined, and the ``action`` asked of a reviewer."""
    rows = claims.join(overrides.select("claim_id", F.col("status").alias("_s")), "claim_id", "left")
    issues = F.array_compact(F.array(F.when(~F.col("has_locator"), "locator missing"), F.when(F.col("abstract_only"), "abstract only"), F.when(F.col("superseded"), "source superseded")))
    status = F.coalesce("_s", F.when(F.col("superseded"), "replace").when(~F.col("has_locator"), "revise").otherwise("keep"))
    action = F.when(status == "keep", F.when(F.size(issues) == 0, "approve or edit").otherwise("check the source")).when(status == "replace", "choose another source").otherwise("confirm the wording")
    return rows.select("claim_id", status.alias("status"), F.array_join(issues, "; ").alias("issues"), action.alias("action"))


def run_summary(rows: DataFrame, breakdowns: list[str], flags: dict[str, Column], limits: dict[str, tuple[Column, int]]) -> DataFrame:
    """``part, key, n``: counts by value of each breakdown, rows with each flag, and limits that were reached."""
    pairs = F.array(*[F.struct(F.lit(c).alias("part"), F.coalesce(F.col(c).cast("string"), F.lit("not stated")).alias("key"), F.lit(1).cast("long").alias("n")) for c in breakdowns], *[F.struct(F.lit("flag").alias("part"), F.lit(k).alias("key"), v.cast("long").alias("n")) for k, v in flags.items()])
    counts = rows.select(F.explode(pairs).alias("p")).groupBy("p.part", "p.key").agg(F.sum("p.n").alias("n"))
    ends = rows.agg(*[F.sum(v.cast("long")).alias(k) for k, (v, _) in limits.items()])
    reached = ends.select(F.explode(F.array(*[F.struct(F.lit("limit").alias("part"), F.lit(k).alias("key"), F.greatest(F.col(k) - most, F.lit(-1)).alias("n")) for k, (_, most) in limits.items()])).alias("p")).select("p.*").filter("n >= 0")
    return counts.unionByName(reached)


def sheet_metrics(rows: DataFrame, filled: list[str], equal: dict[str, tuple[str, str]]) -> DataFrame:
    """``metric, n``: cells that are filled, and cells that equal a value."""
    counts = rows.agg(*[F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) != "").alias(f"filled_{c}") for c in filled], *[F.count_if(F.col(c).cast("string") == v).alias(k) for k, (c, v) in equal.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("n")) for c in counts.columns])).alias("m")).select("m.*")


def pair_sets_differ(a: Column, b: Column) -> Column:
    """Whether two arrays hold different sets."""
    return F.sort_array(F.array_distinct(a)) != F.sort_array(F.array_distinct(b))


def sheets(sources: DataFrame, claims: DataFrame, review: tuple[str, ...] = ("decision", "edited_claim", "notes")) -> dict[str, DataFrame]:
    """Frames of a reviewer's workbook; review columns are blank."""
    blank = [F.lit("").alias(c) for c in review]
    return {
        "sources": sources.select("*", *blank),
        "claims": claims.select("*", *blank),
        "by_source": claims.groupBy("source_id").agg(F.count(F.lit(1)).alias("claims")),
        "without_claims": sources.join(claims.select("source_id").distinct(), "source_id", "left_anti"),
        "metrics": sheet_metrics(claims, claims.columns, {}),
    }


def latest(history: DataFrame, by: str, at: str, n: int) -> DataFrame:
    """The last ``n`` events of each ``by``."""
    return top(history, [by], [F.desc(at)], n).drop("rank")
