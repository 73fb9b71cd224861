"""Screening results, aggregates, joins and set operations over the check tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lexicon import CORPUS
from ..operators import aggregates as A
from ..operators import screening as S
from ..operators.storage import running
from .catalog import query, table
from .text_queries import APPLICABILITY_SQL, NORM_TITLE, STRIP, TITLE, sql_any, sql_first

PRIOR = f"""k AS (SELECT *, lower(text) AS t, sha256(lower({STRIP.format('text')}) || chr(31)) AS h, {NORM_TITLE.format(TITLE)} AS ti FROM documents),
p AS (SELECT *, CASE WHEN min(doc_id) OVER (PARTITION BY h) < doc_id THEN 'content:' || left(h, 12)
  WHEN length(ti) >= 25 AND min(doc_id) OVER (PARTITION BY ti) < doc_id THEN 'title:' || left(ti, 60) END AS dup FROM k)"""
DISPOSED = PRIOR + f""", o AS (SELECT doc_id, source, CASE WHEN dup IS NOT NULL THEN ['duplicate', dup]
  WHEN NOT {sql_any(CORPUS.relevant.groups['relevant'])} THEN ['rejected', 'not relevant: no priority keyword']
  WHEN {APPLICABILITY_SQL} = 'other_only' THEN ['rejected', 'other condition; label']
  WHEN {STRIP.format(TITLE)} = '' THEN ['deferred', 'metadata: title missing']
  WHEN length(text) < 120 THEN ['deferred', 'abstract: too short']
  ELSE ['accepted', 'accepted: ' || {APPLICABILITY_SQL}] END AS r FROM p), s AS (SELECT doc_id, source, r[1] AS status, r[2] AS reason FROM o)"""


def disposed(spark, d):
    return S.disposition(table(spark, d, "documents"), CORPUS)


def rated(spark, d):
    """Documents with their labels, where there are any."""
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")


@query("prior_duplicates", f"WITH {PRIOR} SELECT doc_id, dup AS reason FROM p")
def prior_duplicates(spark, d):
    return S.prior_duplicates(table(spark, d, "documents"))


@query("screening_disposition", f"WITH {DISPOSED} SELECT * FROM s")
def screening_disposition(spark, d):
    return disposed(spark, d)


@query("reason_category_counts", f"WITH {DISPOSED} SELECT status, split_part(split_part(reason, ':', 1), ';', 1) AS category, count(*) AS n FROM s GROUP BY ALL")
def reason_category_counts(spark, d):
    return disposed(spark, d).groupBy("status", X.reason_category(F.col("reason")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("funnel_by_provider", f"""WITH {DISPOSED} SELECT coalesce(source, 'ALL') AS source, count(*) AS screened, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'deferred') AS deferred,
count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'duplicate') AS duplicate, true AS reconciled FROM s GROUP BY ROLLUP (source)""")
def funnel_by_provider(spark, d):
    return S.funnel(disposed(spark, d))


@query("run_status", f"WITH {DISPOSED} SELECT CASE WHEN count(*) FILTER (status = 'accepted') = 0 THEN 'no-op' WHEN count(*) FILTER (status = 'deferred') > 0 THEN 'partial' ELSE 'completed' END AS run_status, count(*) AS screened FROM s")
def run_status(spark, d):
    n = lambda s: F.count_if(F.col("status") == s)
    return disposed(spark, d).agg(F.when(n("accepted") == 0, "no-op").when(n("deferred") > 0, "partial").otherwise("completed").alias("run_status"), F.count(F.lit(1)).alias("screened"))


@query("coverage_matrix", """WITH r AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)), c AS (
SELECT 'lang' AS category, lang AS dimension, count(*) AS n FROM r GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM r GROUP BY 2
UNION ALL SELECT 'quality', quality::VARCHAR, count(*) FROM r WHERE quality IS NOT NULL GROUP BY 2 UNION ALL SELECT 'toxic', toxic::VARCHAR, count(*) FROM r WHERE toxic IS NOT NULL GROUP BY 2)
SELECT *, CASE WHEN n < 3 THEN 'under-covered' ELSE 'covered' END AS status FROM c""")
def coverage_matrix(spark, d):
    return A.coverage(rated(spark, d), ["lang", "source", "quality", "toxic"])


@query("conditional_coverage", """WITH r AS (SELECT d.*, l.quality FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT unnest(['long', 'english', 'licensed', 'first_source']) AS dimension, unnest([count(*) FILTER (length(text) > 2000), count(*) FILTER (lang = 'en'), count(*) FILTER (contains(lower(text), 'license')), count(*) FILTER (source = 'src0')]) AS total,
unnest([count(*) FILTER (length(text) > 2000 AND quality = 1), count(*) FILTER (lang = 'en' AND quality = 1), count(*) FILTER (contains(lower(text), 'license') AND quality = 1), count(*) FILTER (source = 'src0' AND quality = 1)]) AS usable FROM r""")
def conditional_coverage(spark, d):
    tests = {"long": F.length("text") > 2000, "english": F.col("lang") == "en", "licensed": F.contains(F.lower("text"), F.lit("license")), "first_source": F.col("source") == "src0"}
    return A.conditional_coverage(rated(spark, d), tests, F.col("quality") == 1)


@query("conflict_by_topic", """SELECT source AS topic, count(*) AS n, array_to_string(list_sort(list(DISTINCT quality::VARCHAR) FILTER (quality IS NOT NULL)), ',') AS quality, array_to_string(list_sort(list(DISTINCT toxic::VARCHAR) FILTER (toxic IS NOT NULL)), ',') AS toxic
FROM documents JOIN labels USING (doc_id) GROUP BY source HAVING count(*) >= 2 AND (count(DISTINCT quality) > 1 OR count(DISTINCT toxic) > 1)""")
def conflict_by_topic(spark, d):
    return A.conflicts(table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id"), "source", ["quality", "toxic"])


@query("conflict_pairs", """WITH r AS (SELECT doc_id AS id, source, quality FROM documents JOIN labels USING (doc_id))
SELECT a.id, a.source, a.quality, min(b.id) AS partner, count(*) AS n_conflicts FROM r a JOIN r b ON a.source = b.source AND a.quality <> b.quality GROUP BY ALL""")
def conflict_pairs(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select(F.col("doc_id").alias("id"), "source", "quality")
    return A.conflict_links(rows, "source", "quality")


@query("excluded_anti", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)")
def excluded_anti(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels").filter("quality = 0").select("doc_id"), "doc_id", "left_anti").select("doc_id", "lang")


@query("referenced_semi", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def referenced_semi(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").select("doc_id", "source")


@query("fk_violations", "SELECT o_orderkey AS id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def fk_violations(spark, d):
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select(F.col("o_orderkey").alias("id"))
    return orders.unionByName(table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left_anti").select(F.col("doc_id").alias("id")))


@query("override_lookup", """SELECT doc_id, coalesce(CASE WHEN quality = 0 THEN 'rewrite' END, CASE WHEN toxic = 1 THEN 'review' END, 'as is') AS action FROM documents LEFT JOIN labels USING (doc_id)""")
def override_lookup(spark, d):
    fix = table(spark, d, "labels").filter("quality = 0").select("doc_id", F.lit("rewrite").alias("fix"))
    qa = table(spark, d, "labels").filter("toxic = 1").select("doc_id", F.lit("review").alias("qa"))
    return table(spark, d, "documents").join(fix, "doc_id", "left").join(qa, "doc_id", "left").select("doc_id", F.coalesce("fix", "qa", F.lit("as is")).alias("action"))


@query("claim_applicability", f"""SELECT doc_id, CASE WHEN l.quality = 0 THEN 'excluded' WHEN lab = 'unknown' THEN 'unknown' WHEN lab = 'other_only' THEN 'other_only' WHEN lab = 'focus' THEN 'eligible' ELSE 'not_eligible' END AS reason
FROM (SELECT doc_id, {APPLICABILITY_SQL} AS lab FROM (SELECT *, lower(text) AS t FROM documents)) LEFT JOIN labels l USING (doc_id)""")
def claim_applicability(spark, d):
    lab = S.applicability(F.lower("text"), CORPUS)
    rows = rated(spark, d).select("doc_id", "quality", lab.alias("lab"))
    return rows.select("doc_id", F.when(F.col("quality") == 0, "excluded").when(F.col("lab").isin("unknown", "other_only"), F.col("lab")).when(F.col("lab") == "focus", "eligible").otherwise("not_eligible").alias("reason"))


@query("distinctness_check", "SELECT 'documents' AS check_id, count(doc_id) = count(DISTINCT doc_id) AS passed FROM documents UNION ALL SELECT 'texts', count(text) = count(DISTINCT text) FROM documents UNION ALL SELECT 'events', count(event_id) = count(DISTINCT event_id) FROM events")
def distinctness_check(spark, d):
    docs = table(spark, d, "documents")
    return A.distinctness({"documents": (docs, "doc_id"), "texts": (docs, "text"), "events": (table(spark, d, "events"), "event_id")})


@query("set_reconciliation", """WITH a AS (SELECT doc_id FROM documents), x AS (SELECT doc_id FROM labels WHERE quality = 0), f AS (SELECT doc_id FROM labels WHERE toxic = 1)
SELECT 'included' AS part, count(*) AS n FROM (SELECT * FROM a EXCEPT (SELECT * FROM x EXCEPT SELECT * FROM f)) UNION ALL SELECT 'excluded', count(*) FROM (SELECT * FROM x EXCEPT SELECT * FROM f) UNION ALL SELECT 'leak', count(*) FROM (SELECT * FROM x INTERSECT SELECT * FROM f)""")
def set_reconciliation(spark, d):
    every, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels")
    defect, fixed = labels.filter("quality = 0").select("doc_id"), labels.filter("toxic = 1").select("doc_id")
    out = defect.subtract(fixed)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
    return count(every.subtract(out), "included").unionByName(count(out, "excluded")).unionByName(count(defect.intersect(fixed), "leak"))


@query("report_counters", f"WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) AS most, row_number() OVER (PARTITION BY lang ORDER BY n, source) AS least FROM c) SELECT lang, source, n, most <= 6 AS among_most, least <= 8 AS among_least FROM r WHERE most <= 6 OR least <= 8")
def report_counters(spark, d):
    from pyspark.sql.window import Window

    counts = table(spark, d, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("lang")
    ranked = counts.withColumn("most", F.row_number().over(w.orderBy(F.desc("n"), "source"))).withColumn("least", F.row_number().over(w.orderBy("n", "source")))
    return ranked.filter("most <= 6 OR least <= 8").select("lang", "source", "n", (F.col("most") <= 6).alias("among_most"), (F.col("least") <= 8).alias("among_least"))


@query("round_robin_interleave", """WITH s AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM documents))
SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS turn, ((i - 17) % n + n) % n AS slot FROM documents JOIN s USING (source)""")
def round_robin_interleave(spark, d):
    return S.interleaved(table(spark, d, "documents"), 17)


@query("screening_budget", f"""WITH {PRIOR}, f AS (SELECT doc_id, dup IS NOT NULL AS free, dup IS NULL AND length(text) > 2000 AS acc FROM p),
g AS (SELECT *, coalesce(sum((NOT free)::INT) OVER w, 0) AS spent, coalesce(sum(acc::INT) OVER w, 0) AS taken FROM f WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT doc_id, free OR (spent < 200 AND taken < 40) AS screened FROM g""")
def screening_budget(spark, d):
    keys = S.with_reason(S.duplicate_keys(table(spark, d, "documents"), long=F.length("text") > 2000))
    rows = keys.select("doc_id", F.col("reason").isNotNull().alias("free"), (F.col("reason").isNull() & F.col("long")).alias("accepted"))
    return S.budget(rows, 200, 40)


@query("candidate_score_rank", f"""WITH x AS (SELECT doc_id, source, CASE WHEN contains(t, 'license') OR contains(t, 'licence') THEN 50 WHEN regexp_matches(t, '[0-9]{{4}}') THEN 35 ELSE 25 END
 + 3 * least(5, {' + '.join(f"(contains(t, '{k}'))::INT" for v in CORPUS.topics.groups.values() for k in v)}) + CASE WHEN length(t) > 2000 THEN 4 ELSE 0 END AS score FROM (SELECT *, lower(text) AS t FROM documents))
SELECT doc_id, score, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rank FROM x""")
def candidate_score_rank(spark, d):
    t = F.lower("text")
    score = S.study_class(t)["weight"] + 3 * F.least(F.lit(5), F.size(CORPUS.topics.matched(t))) + F.when(F.length("text") > 2000, 4).otherwise(0)
    rows = table(spark, d, "documents").select("doc_id", "source", score.alias("score"))
    return running(rows, {"rank": F.lit(1)}, F.desc("score"), "doc_id", by=("source",)).select("doc_id", "score", "rank")


@query("capped_selection", """WITH RECURSIVE r AS (SELECT source, doc_id, length(text) < 120 AS bare, contains(lower(text), 'license') AS guide, row_number() OVER (PARTITION BY source ORDER BY length(text) DESC, doc_id) AS n FROM documents),
w AS (SELECT source, NULL::BIGINT AS doc_id, 0::BIGINT AS n, 0 AS g, 0 AS k, '' AS reason FROM (SELECT DISTINCT source FROM documents) UNION ALL SELECT r.source, r.doc_id, r.n, w.g + (why = '' AND guide)::INT, w.k + (why = '')::INT, why FROM w JOIN r ON r.source = w.source AND r.n = w.n + 1,
LATERAL (SELECT CASE WHEN bare THEN 'no abstract' WHEN w.k >= 20 THEN 'total cap' WHEN guide AND w.g >= 2 THEN 'guideline cap' ELSE '' END AS why) x) SELECT doc_id, source, CASE WHEN reason = '' THEN 'selected' ELSE 'rejected' END AS decision, reason FROM w WHERE n > 0""")
def capped_selection(spark, d):
    from ..operators.folds import capped_selection as fold

    rows = table(spark, d, "documents").select("source", "doc_id", (F.length("text") < 120).alias("no_abstract"), F.contains(F.lower("text"), F.lit("license")).alias("guideline"), F.length("text").alias("score"))
    return fold(rows, guideline_cap=2, total_cap=20)
