"""Answers, citations and quality checks over the check tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lexicon import CORPUS
from ..operators import agent as A
from ..operators import json_schema
from ..operators import package_checks as P
from ..operators import quality as Q
from ..operators import screening as S
from ..operators import workflow as G
from .catalog import query, table
from .rule_queries import ASKED, FAMILY, UNSUPPORTED, asked
from .text_queries import APPLICABILITY_SQL, COLLAPSE, sql_all, sql_any, sql_first

# claims: labelled documents; topic = source; verified if of good quality; excerpt = first 80 characters
CLAIMS = f"c AS (SELECT doc_id AS id, source AS topic, {COLLAPSE.format('text')} AS text, left({COLLAPSE.format('text')}, 80) AS excerpt, quality = 1 AS ok FROM documents JOIN labels USING (doc_id)), b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY topic ORDER BY id) <= 3)"
QUESTIONS = "q AS (SELECT conv_id, turn, text AS question, 'src' || (conv_id % 25)::VARCHAR AS topic, lower(trim(text)) AS t FROM conversations WHERE role = 'user')"
ANSWERS = f"""{CLAIMS}, {QUESTIONS}, g AS (SELECT *, {sql_first(CORPUS.boundaries.groups, 'none', patterns=True)} AS boundary, {sql_any(CORPUS.gap_terms)} AS unsupported FROM q),
v AS (SELECT topic, list(id ORDER BY id) AS ids, list(text ORDER BY id) AS texts, list(excerpt ORDER BY id) AS excerpts FROM b WHERE ok GROUP BY topic),
d AS (SELECT topic, ids, 'Evidence found:' || chr(10) || chr(10) || array_to_string(list_transform(texts, lambda x, i: '[' || i || '] ' || x), chr(10) || chr(10)) AS first, 'Evidence found:' || chr(10) || chr(10) || array_to_string(list_transform(excerpts, lambda x, i: '[' || i || '] ' || x), chr(10) || chr(10)) AS second FROM v),
k AS (SELECT topic, ids, len({sql_all({**CORPUS.critic.groups}, 'lower(first)', True)}) = 0 AS ok1, len({sql_all({**CORPUS.critic.groups}, 'lower(second)', True)}) = 0 AS ok2 FROM d),
a AS (SELECT conv_id, turn, ids, CASE WHEN boundary <> 'none' THEN 'refused' WHEN unsupported OR ids IS NULL THEN 'fallback' WHEN ok1 OR ok2 THEN 'answered' ELSE 'fallback' END AS status,
 CASE WHEN boundary <> 'none' OR unsupported OR ids IS NULL THEN 0 WHEN ok1 THEN 1 ELSE 2 END AS attempts FROM g LEFT JOIN k USING (topic))"""


def claims(spark, d):
    t = X.collapse(F.col("text"))
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select(F.col("doc_id").alias("id"), F.col("source").alias("topic"), t.alias("text"), F.left(t, F.lit(80)).alias("excerpt"), (F.col("quality") == 1).alias("ok"))


def answers(spark, d):
    q = table(spark, d, "conversations").filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"), F.concat(F.lit("src"), (F.col("conv_id") % 25).cast("string")).alias("topic"))
    # the corpus preset would refuse all drafts for their numbering, so length and address rules judge here
    return G.answer(q, claims(spark, d), CORPUS, critic=None)


@query("answer_status", f"WITH {ANSWERS} SELECT conv_id, turn, status, CASE WHEN status = 'answered' THEN len(ids) ELSE 0 END AS n_citations FROM a")
def answer_status(spark, d):
    return answers(spark, d).select("conv_id", "turn", "status", "n_citations")


@query("answer_retry_path", f"WITH {ANSWERS} SELECT conv_id, turn, attempts, array_to_string(list_filter(['gate', CASE WHEN status <> 'refused' THEN 'retrieve' END, CASE WHEN attempts > 0 THEN 'compose' END, CASE WHEN attempts > 1 THEN 'retry' END, status], lambda x: x IS NOT NULL), '>') AS trace FROM a")
def answer_retry_path(spark, d):
    return answers(spark, d).select("conv_id", "turn", "attempts", "trace")


@query("citation_rows", f"WITH {CLAIMS}, {QUESTIONS}, v AS (SELECT topic, list(id ORDER BY id) AS ids FROM b WHERE ok GROUP BY topic) SELECT conv_id, turn, unnest(range(1, len(ids) + 1))::INT AS number, unnest(ids) AS claim_id FROM q JOIN v USING (topic)")
def citation_rows(spark, d):
    q = table(spark, d, "conversations").filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"), F.concat(F.lit("src"), (F.col("conv_id") % 25).cast("string")).alias("topic"))
    rows = G.retrieve(q, claims(spark, d), 3).withColumn("verified", F.filter("claims", lambda c: c["ok"])).withColumn("status", F.lit("answered"))
    return G.citations(rows)


@query("citation_verification", f"WITH {CLAIMS}, x AS (SELECT id + (CASE WHEN id % 7 = 0 THEN 10000000 ELSE 0 END) AS claim_id, CASE WHEN id % 5 = 0 THEN upper(excerpt) ELSE excerpt END AS excerpt FROM c) SELECT claim_id, CASE WHEN c.id IS NULL THEN 'unknown' WHEN c.excerpt <> x.excerpt THEN 'excerpt' ELSE '' END AS mismatch FROM x LEFT JOIN c ON c.id = claim_id")
def citation_verification(spark, d):
    c = claims(spark, d)
    cited = c.select((F.col("id") + F.when(F.col("id") % 7 == 0, 10_000_000).otherwise(0)).alias("claim_id"), F.when(F.col("id") % 5 == 0, F.upper("excerpt")).otherwise(F.col("excerpt")).alias("excerpt"))
    return G.verify_citations(cited, c).select("claim_id", "mismatch")


@query("qa_checks", f"""WITH {CLAIMS}, t AS (SELECT 'has_text' AS check_id, count(*) FILTER (NOT (text <> '')) AS v FROM c UNION ALL SELECT 'has_topic', count(*) FILTER (NOT (topic <> '')) FROM c UNION ALL SELECT 'excerpt_verbatim', count(*) FILTER (NOT contains(text, excerpt)) FROM c
UNION ALL SELECT 'no_address', count(*) FILTER (regexp_matches(text, '[a-z0-9.]+@[a-z0-9.-]+')) FROM c UNION ALL SELECT 'no_secret', count(*) FILTER (regexp_matches(text, 'password=|AKIA[0-9A-Z]{{16}}')) FROM c UNION ALL SELECT 'unique_id', count(id) - count(DISTINCT id) FROM c UNION ALL SELECT 'source_exists', count(*) FILTER (id NOT IN (SELECT doc_id FROM documents)) FROM c),
r AS (SELECT check_id, v = 0 AS passed, v AS violations FROM t) SELECT * FROM r UNION ALL SELECT 'ALL', bool_and(passed), sum(violations)::BIGINT FROM r""")
def qa_checks(spark, d):
    c = claims(spark, d)
    t = F.col("text")
    tests = {"has_text": t != "", "has_topic": F.col("topic") != "", "excerpt_verbatim": F.contains(t, F.col("excerpt")), "no_address": ~t.rlike("[a-z0-9.]+@[a-z0-9.-]+"), "no_secret": ~t.rlike("password=|AKIA[0-9A-Z]{16}")}
    docs = table(spark, d, "documents")
    return Q.verdict(Q.checks(c, tests).unionByName(Q.unique(c, "id", "unique_id")).unionByName(Q.foreign_keys(c, "id", docs, "doc_id", "source_exists")))


@query("package_checks", """WITH t AS (SELECT 'lang_domain' AS check_id, count(*) FILTER (NOT coalesce(lang IN ('en', 'fr', 'de', 'es'), false)) AS v FROM documents UNION ALL SELECT 'n_chars', count(*) FILTER (NOT coalesce(n_chars = length(text), false)) FROM documents
UNION ALL SELECT 'source_form', count(*) FILTER (NOT coalesce(regexp_matches(source, '^src[0-9]+$'), false)) FROM documents UNION ALL SELECT 'unique_text', count(text) - count(DISTINCT text) FROM documents UNION ALL SELECT 'labels_known', count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM documents)) FROM labels)
SELECT check_id, v = 0 AS passed, v AS violations FROM t""")
def package_checks(spark, d):
    docs = table(spark, d, "documents")
    tests = {"lang_domain": F.col("lang").isin("en", "fr", "de", "es"), "n_chars": F.col("n_chars") == F.length("text"), "source_form": F.col("source").rlike("^src[0-9]+$")}
    return Q.checks(docs, tests).unionByName(Q.unique(docs, "text", "unique_text")).unionByName(Q.foreign_keys(table(spark, d, "labels"), "doc_id", docs, "doc_id", "labels_known"))


@query("causal_upgrade", f"WITH x AS (SELECT conv_id, list(lower(text) ORDER BY turn) FILTER (role = 'user') AS s, string_agg(lower(text), ' ' ORDER BY turn) FILTER (role = 'assistant') AS t FROM conversations GROUP BY conv_id) SELECT conv_id, coalesce(contains(t, 'tion') AND (len(list_filter(s, lambda z: contains(z, 'whe'))) > 0 OR len(list_filter(s, lambda z: contains(z, 'tion'))) = 0), false) AS upgraded FROM x")
def causal_upgrade(spark, d):
    turns = table(spark, d, "conversations")
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(F.col("role") == "user", F.struct("turn", "text")))).alias("s"), F.sort_array(F.collect_list(F.when(F.col("role") == "assistant", F.struct("turn", "text")))).alias("a"))
    text = F.array_join(F.transform("a", lambda x: x["text"]), " ")
    return rows.select("conv_id", F.coalesce(Q.causal_upgrade(text, F.transform("s", lambda x: x["text"])), F.lit(False)).alias("upgraded"))


@query("json_validation", "SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'malformed; missing k' WHEN event_id % 13 = 0 THEN 'missing k' ELSE '' END AS errors FROM events")
def json_validation(spark, d):
    raw = F.when(F.col("event_id") % 11 == 0, F.lit("{bad")).when(F.col("event_id") % 13 == 0, F.lit('{"j": 1}')).otherwise(F.col("props"))
    return Q.validate_json(table(spark, d, "events").select("event_id", raw.alias("props")), "props", "k long", ["k"]).select("event_id", "errors")


#: Output rules of an answer, by group.
SAFETY = {"no_directive": "the the|and and", "no_address": "[a-z0-9.]+@[a-z0-9.-]+", "no_secret": "password=|akia[0-9a-z]{16}", "not_overlong": "^(?s:.{1000})"}
_COUNT = lambda name, where, source: f"SELECT '{name}' AS check_id, count(*) FILTER (NOT ({where})) AS v FROM {source}"


@query("answer_checks", f"""WITH {ANSWERS}, z AS (SELECT g.conv_id, g.turn, unsupported, t, CASE WHEN status = 'answered' THEN CASE WHEN ok1 THEN first ELSE second END WHEN status = 'fallback' THEN '{G.FALLBACK}' ELSE 'refusal' END AS text, status FROM g JOIN a USING (conv_id, turn) LEFT JOIN k USING (topic) LEFT JOIN d USING (topic)),
u AS (SELECT conv_id, contains(tx, 'tion') AND (len(list_filter(s, lambda z: contains(z, 'whe'))) > 0 OR len(list_filter(s, lambda z: contains(z, 'tion'))) = 0) AS up FROM (SELECT conv_id, list(lower(text) ORDER BY turn) FILTER (role = 'user') AS s, string_agg(lower(text), ' ' ORDER BY turn) FILTER (role = 'assistant') AS tx FROM conversations GROUP BY conv_id)),
y AS (SELECT c.*, {APPLICABILITY_SQL} AS label FROM (SELECT *, lower(text) AS t FROM c) c),
n AS ({_COUNT('in_focus', "label IN ('focus', 'general')", 'y')} UNION ALL {_COUNT('no_other_condition', "label <> 'other_only'", 'y')} UNION ALL {_COUNT('not_superseded', 'id % 17 <> 0', 'y')} UNION ALL SELECT 'unique_ids', count(id) - count(DISTINCT id) FROM y UNION ALL {_COUNT('source_exists', 'id IN (SELECT doc_id FROM documents)', 'y')}
UNION ALL {_COUNT('locator_present', "regexp_matches(text, '[0-9]{4,}')", 'y')} UNION ALL {_COUNT('excerpt_verbatim', 'contains(text, excerpt)', 'y')} UNION ALL {_COUNT('limitation_kept', 'id % 8 <> 1', 'y')} UNION ALL {_COUNT('fallback_exact', f"status <> 'fallback' OR text = '{G.FALLBACK}'", 'z')} UNION ALL {_COUNT('gap_term_named', f"NOT unsupported OR {sql_any(CORPUS.gap_terms)}", 'z')}
UNION ALL {' UNION ALL '.join(_COUNT(name, f"NOT regexp_matches(lower(text), '{p}')", 'z') for name, p in SAFETY.items())} UNION ALL SELECT 'no_causal_upgrade', count(*) FILTER (coalesce(up, false)) FROM u), r AS (SELECT check_id, v = 0 AS passed, v AS violations FROM n)
SELECT * FROM r UNION ALL SELECT 'ALL', bool_and(passed), sum(violations)::BIGINT FROM r""")
def answer_checks(spark, d):
    c = claims(spark, d).withColumn("label", S.applicability(F.lower("text"), CORPUS))
    out = answers(spark, d)
    docs = table(spark, d, "documents")
    of_claims = {
        "in_focus": F.col("label").isin("focus", "general"), "no_other_condition": F.col("label") != "other_only", "not_superseded": F.col("id") % 17 != 0, "locator_present": F.col("text").rlike("[0-9]{4,}"),
        "excerpt_verbatim": F.contains("text", F.col("excerpt")), "limitation_kept": F.col("id") % 8 != 1,
    }
    named = F.exists(F.array(*[F.lit(t) for t in CORPUS.gap_terms]), lambda t: F.contains(F.lower(F.trim("question")), t))
    of_answers = {"fallback_exact": (F.col("status") != "fallback") | (F.col("answer") == G.FALLBACK), "gap_term_named": ~F.col("unsupported") | named}
    of_answers |= {name: ~F.lower("answer").rlike(p) for name, p in SAFETY.items()}
    upgraded = Q.checks(causal_upgrade(spark, d), {"no_causal_upgrade": ~F.col("upgraded")})
    every = Q.checks(c, of_claims).unionByName(Q.checks(out, of_answers)).unionByName(upgraded)
    return Q.verdict(every.unionByName(Q.unique(c, "id", "unique_ids")).unionByName(Q.foreign_keys(c, "id", docs, "doc_id", "source_exists")))


CHECKPOINT = {"type": "object", "required": ["runId", "sources"], "properties": {"runId": {"type": "string", "pattern": "^run-"}, "sources": {"type": "integer", "minimum": 1}, "nextRecommendedOperation": {"type": "object"}}}
_CONDITION = lambda t: f"CASE WHEN contains({t}, 'ulcerative colitis') THEN 'ulcerative_colitis' WHEN contains({t}, 'crohn') THEN 'crohns_only' WHEN contains({t}, 'ibd') THEN 'ibd_general' ELSE coalesce(lang, 'unknown') END"
_BAD = lambda n, where, source: f"SELECT 'QA-{n:02d}' AS check_id, count(*) FILTER (NOT coalesce({where}, false)) AS v FROM {source}"
_FINE = lambda n: f"SELECT 'QA-{n:02d}', 0"


def _condition(t: Column) -> Column:
    return F.when(F.contains(t, F.lit("ulcerative colitis")), "ulcerative_colitis").when(F.contains(t, F.lit("crohn")), "crohns_only").when(F.contains(t, F.lit("ibd")), "ibd_general")


@query("package_audit", f"""WITH s AS (SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages), c AS (SELECT *, {_CONDITION("lower(coalesce(text, ''))")} AS label FROM documents), o AS (SELECT text FROM documents UNION ALL SELECT url FROM pages),
n AS ({_BAD(1, 'doc_id IN (SELECT page_id FROM pages)', 'documents')} UNION ALL {_BAD(2, "text <> '' AND source <> ''", 'documents')} UNION ALL {_FINE(3)} UNION ALL {_BAD(4, "page_id IS NOT NULL", 's')} UNION ALL {_FINE(5)} UNION ALL {_BAD(6, "label IN ('ulcerative_colitis', 'ibd_general', 'crohns_only', 'unknown')", 'c')} UNION ALL {_FINE(7)} UNION ALL {_FINE(8)}
UNION ALL SELECT 'QA-09', (SELECT count(page_id) - count(DISTINCT page_id) FROM pages) + (SELECT count(doc_id) - count(DISTINCT doc_id) FROM documents) UNION ALL SELECT 'QA-10', ((SELECT count(*) FROM documents) <> (SELECT count(*) FROM labels))::BIGINT UNION ALL SELECT 'QA-11', (SELECT count(*) = 0 FROM pages)::BIGINT UNION ALL {_FINE(12)}
UNION ALL {_BAD(13, f"NOT regexp_matches(coalesce(text, ''), '{P.SECRET.replace(chr(39), chr(39) * 2)}')", 'o')} UNION ALL {_FINE(14)} UNION ALL {_BAD(15, f"NOT regexp_matches(coalesce(text, ''), '{P.FORUM}')", 'o')} UNION ALL SELECT 'QA-16', count(*) FILTER (doc_id IN (SELECT page_id FROM s WHERE contains(title, 'ing'))) FROM documents UNION ALL {_FINE(17)}
UNION ALL {_BAD(18, "NOT regexp_matches(lower(url), '\\.pdf(\\?|$)')", 's')} UNION ALL {_BAD(19, "n_chars > 400", 'documents')}), r AS (SELECT check_id, v = 0 AS passed, v::BIGINT AS violations FROM n) SELECT * FROM r UNION ALL SELECT 'ALL', bool_and(passed), sum(violations)::BIGINT FROM r""")
def package_audit(spark, d):
    """Pages as sources (trials by a word of their title), documents as claims on the page of their number."""
    docs, pages = table(spark, d, "documents"), table(spark, d, "pages")
    none = F.lit("")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    sources = pages.select(
        F.col("page_id").alias("sourceId"), title.alias("title"), none.alias("doi"), F.col("page_id").cast("string").alias("pubmedId"), none.alias("pmcId"), none.alias("clinicalTrialsId"), F.lit("unknown").alias("ucApplicability"), F.lit("link_only").alias("archivalStatus"),
        none.alias("humanReviewStatus"), none.alias("clinicalReviewStatus"), F.when(F.contains(title, F.lit("ing")), "ongoing_trial").alias("evidenceType"), F.col("url").alias("canonicalUrl"), none.alias("alternateUrl"),
    )
    label = F.coalesce(_condition(F.lower(F.coalesce("text", none))), "lang", F.lit("unknown"))
    said = docs.select(
        F.col("doc_id").alias("claimId"), F.col("doc_id").alias("sourceId"), F.col("text").alias("exactSupportingExcerpt"), F.col("source").alias("exactLocator"), F.lit(True).alias("isMechanicallyExtractedCandidate"), F.lit("abstract_only").alias("verificationBasis"), label.alias("conditionApplicability"),
        none.alias("humanReviewStatus"), none.alias("clinicalReviewStatus"), none.alias("reviewerDecision"), F.lit(P.PENDING).alias("reviewStatus"), F.coalesce(F.col("n_chars") > 400, F.lit(False)).alias("requiresFullTextVerification"),
    )
    outputs = docs.select("text").unionByName(pages.select(F.col("url").alias("text")))
    step = F.to_json(F.struct(F.lit("run-1").alias("runId"), F.count(F.lit(1)).alias("sources"), F.struct(F.lit("go on").alias("description")).alias("nextRecommendedOperation")))
    counters = {"claimsExtracted": table(spark, d, "labels").count()}
    return P.audit(sources, said, outputs, pages.agg(step.alias("text")), CHECKPOINT, counters)


_ROUTE = "array_to_string(" + str(list(G.NODES)) + "[1:CASE status WHEN 'refused' THEN 1 WHEN 'fallback' THEN 9 WHEN 'llm_unavailable' THEN 10 ELSE 13 END], '>')"


@query("answer_graph", f"""WITH {ANSWERS}, o AS (SELECT conv_id, turn, ids, status, true AS template FROM a UNION ALL SELECT conv_id, turn, ids, CASE WHEN status = 'answered' THEN 'llm_unavailable' ELSE status END, false FROM a)
SELECT conv_id, turn, template, status, {_ROUTE} AS route, ids IS NOT NULL AS sufficient, CASE WHEN len(ids) > 1 THEN 'passed through' ELSE 'nothing to resolve' END AS resolution FROM o""")
def answer_graph(spark, d):
    q = table(spark, d, "conversations").filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"), F.concat(F.lit("src"), (F.col("conv_id") % 25).cast("string")).alias("topic"))
    c = claims(spark, d)
    both = [G.graph(q, c, CORPUS, template=t).withColumn("template", F.lit(t)).select("conv_id", "turn", "template", "status", "route", "sufficient", "resolution") for t in (True, False)]
    return both[0].unionByName(both[1])


def _sql_kinds(groups, column: str) -> str:
    return " OR ".join(f"regexp_matches({column}, '{p.replace(chr(39), chr(39) * 2)}')" for ps in groups.values() for p in ps)


def _reviewer(row: dict) -> dict:
    """Stands for a model: fails on questions of a length, passes drafts of an even number of claims."""
    if len(row["question"]) % 7 == 0:
        raise TimeoutError
    return {"passed": len(row["verified"]) % 2 == 0}


@query("agent_routes", f"""WITH {CLAIMS}, {ASKED}, n AS (SELECT topic, list({{'id': id, 'text': text, 'excerpt': excerpt}} ORDER BY id) AS v FROM b WHERE ok GROUP BY topic),
g AS (SELECT l.conv_id, l.turn, q, {FAMILY} AS family, {UNSUPPORTED} AS unsupported, coalesce(v, []) AS v FROM l LEFT JOIN n ON n.topic = 'src' || (l.conv_id % 25)::VARCHAR),
h AS (SELECT *, 'Evidence found:' || chr(10) || chr(10) || array_to_string(list_transform(v, lambda c, i: '[' || i || '] ' || c.text), chr(10) || chr(10)) AS draft FROM g),
k AS (SELECT *, {_sql_kinds(A.UNSAFE, 'lower(draft)')} AS unsafe, len(list_filter(v, lambda c: NOT contains(c.text, c.excerpt))) > 0 AS unsound, len(q) % 7 <> 0 AND len(v) % 2 <> 0 AS refused FROM h),
s AS (SELECT *, CASE WHEN family <> 'none' THEN 'refused' WHEN unsupported OR len(v) = 0 THEN 'fallback' WHEN unsafe OR unsound OR refused THEN 'refused' ELSE 'answered' END AS status, CASE WHEN unsafe THEN 'evidence_synthesizer>safety_critic' WHEN unsound THEN 'evidence_synthesizer>safety_critic>citation_verifier' ELSE 'evidence_synthesizer>safety_critic>citation_verifier>citation_reviewer' END AS step FROM k)
SELECT conv_id, turn, status, CASE WHEN family <> 'none' OR status = 'fallback' THEN 0 WHEN status = 'answered' THEN 1 ELSE 2 END AS attempts, CASE WHEN status = 'answered' THEN len(v) ELSE 0 END AS n_citations,
CASE WHEN family <> 'none' THEN 'receive_query>check_safety_boundaries>refuse' ELSE '{">".join([*A.NODES[:2], *A.BEFORE])}>' || CASE status WHEN 'fallback' THEN 'fallback_if_unsupported' WHEN 'answered' THEN step || '>qa_agent>attach_citations_final' ELSE step || '>' || step || '>refuse' END END AS route FROM s""")
def agent_routes(spark, d):
    """Templates as drafts, and a reviewer that fails for some rows."""
    q = asked(spark, d).select("conv_id", "turn", F.col("q").alias("question"), F.concat(F.lit("src"), (F.col("conv_id") % 25).cast("string")).alias("topic"))
    out = A.run(G.retrieve(q, claims(spark, d), 3).drop("topic"), {"citation_reviewer": _reviewer}, template=True)
    return out.select("conv_id", "turn", "status", "attempts", F.coalesce(F.size("citations"), F.lit(0)).cast("long").alias("n_citations"), F.array_join("route", ">").alias("route"))


RECORD = {
    "type": "object", "required": ["id", "lang"], "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 3}, "lang": {"enum": ["en", "fr", "de"]}, "source": {"type": "string", "pattern": "^src[0-9]$"}, "size": {"type": ["integer", "null"], "maximum": 5000},
        "lines": {"type": "array", "minItems": 2, "items": {"type": "string", "minLength": 4}},
    },
}


@query("schema_errors", """WITH x AS (SELECT *, CASE WHEN text IS NULL THEN NULL ELSE string_split(text, chr(10)) END AS l FROM documents), y AS (SELECT doc_id, list_concat([CASE WHEN doc_id < 3 THEN 'id: is beyond its minimum' END, CASE WHEN lang IS NULL THEN '<root>: lacks lang' WHEN lang NOT IN ('en', 'fr', 'de') THEN 'lang: is none of the values' END, CASE WHEN NOT regexp_matches(source, '^src[0-9]$') THEN 'source: does not match' END,
CASE WHEN n_chars > 5000 THEN 'size: is beyond its maximum' END, CASE WHEN len(l) < 2 THEN 'lines: has too few items' END, CASE WHEN doc_id % 2 = 1 THEN '<root>: has also odd' END], coalesce(list_transform(l, lambda v, i: CASE WHEN length(v) < 4 THEN 'lines/' || (i - 1) || ': is too short' END), [])) AS e FROM x)
SELECT doc_id, coalesce(array_to_string(list_sort(list_filter(e, lambda v: v IS NOT NULL)), '; '), '') AS errors FROM y""")
def schema_errors(spark, d):
    made = F.to_json(F.struct(F.col("doc_id").alias("id"), "lang", "source", F.col("n_chars").alias("size"), F.split("text", "\n", -1).alias("lines"), F.when(F.col("doc_id") % 2 == 1, True).alias("odd")))
    return table(spark, d, "documents").select("doc_id", F.array_join(json_schema.validate(made, RECORD), "; ").alias("errors"))
