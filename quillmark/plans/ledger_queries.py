"""Identifier index, memories, lookups, caps, audits and unions over the check tables.

Identifiers are made from document numbers, so that later documents repeat some of
earlier ones: the first half is known, the second half are candidates.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lexicon import CORPUS
from ..operators import ledger as L
from ..operators import resolution as R
from ..operators import screening as S
from ..operators.storage import save
from .catalog import query, table
from .text_queries import APPLICABILITY_SQL, COLLAPSE, NORM_TITLE, STRIP, TITLE

HASH = f"sha256(lower({STRIP.format('text')}) || chr(31))"
KEYED = f"""h AS (SELECT (max(doc_id) + 1) // 2 AS half FROM documents), y AS (SELECT doc_id, doc_id < half AS known, CASE WHEN doc_id % 3 = 0 THEN '10.1000/' || (doc_id % 90) ELSE '' END AS doi, CASE WHEN doc_id % 5 = 1 THEN (doc_id % 170)::VARCHAR ELSE '' END AS pmid, CASE WHEN doc_id % 31 = 0 THEN 'PMC' || (doc_id % 62) ELSE '' END AS pmcid,
CASE WHEN doc_id % 37 = 0 THEN 'NCT' || lpad((doc_id % 74)::VARCHAR, 8, '0') ELSE '' END AS trial_id, CASE WHEN doc_id % 7 = 2 THEN source || '.org/' || (doc_id % 40) ELSE '' END AS canonical_url, {HASH} AS content_hash, {NORM_TITLE.format(TITLE)} AS normalized_title FROM documents, h)"""


def keyed(spark, d):
    """Documents with identity keys, and whether they are known."""
    docs = table(spark, d, "documents")
    half = F.floor((docs.agg(F.max("doc_id")).first()[0] + 1) / F.lit(2))
    n = F.col("doc_id")
    text = lambda c: c.cast("string")
    return docs.select(
        "doc_id", (n < half).alias("known"), F.when(n % 3 == 0, F.concat(F.lit("10.1000/"), text(n % 90))).otherwise("").alias("doi"), F.when(n % 5 == 1, text(n % 170)).otherwise("").alias("pmid"), F.when(n % 31 == 0, F.concat(F.lit("PMC"), text(n % 62))).otherwise("").alias("pmcid"),
        F.when(n % 37 == 0, F.concat(F.lit("NCT"), F.lpad(text(n % 74), 8, "0"))).otherwise("").alias("trial_id"), F.when(n % 7 == 2, F.concat("source", F.lit(".org/"), text(n % 40))).otherwise("").alias("canonical_url"),
        X.content_hash(F.col("text")).alias("content_hash"), X.norm_title(X.title_of(F.col("text"))).alias("normalized_title"),
    )


_EACH = [k for k, _ in L.KINDS]
INDEX = f"{KEYED}, i AS (" + " UNION ".join(f"SELECT '{k}' AS kind, {k} AS value FROM y WHERE known AND {k} <> ''" for k in _EACH) + ")"
_STRONG = "(doi <> '' OR pmid <> '' OR pmcid <> '' OR trial_id <> '')"


@query("identity_index", f"WITH {INDEX} SELECT kind, count(*) AS n FROM i GROUP BY kind")
def identity_index(spark, d):
    return L.identity_index(keyed(spark, d).filter("known")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def _reason_sql() -> str:
    cases = []
    for k in _EACH:
        shown = f"left({k}, {L.SHOWN[k]})" if k in L.SHOWN else k
        alone = f" AND NOT {_STRONG}" if k in L.WEAK else ""
        cases.append(f"WHEN {k} <> ''{alone} AND {k} IN (SELECT value FROM i WHERE kind = '{k}') THEN 'duplicate_{k}:' || {shown}")
    return "CASE " + " ".join(cases) + " END"


@query("identifier_duplicates", f"WITH {INDEX} SELECT doc_id, {_reason_sql()} AS reason FROM y WHERE NOT known")
def identifier_duplicates(spark, d):
    rows = keyed(spark, d)
    return L.duplicate_reasons(rows.filter("NOT known"), L.identity_index(rows.filter("known")))


MEMORY = f"""j AS (SELECT doc_id, source AS provider, text AS abstract, 'id-' || (doc_id % 400) AS identity, doc_id AS seen FROM documents), n AS (SELECT provider, identity, max(seen) AS seen FROM j WHERE length(abstract) >= 120 AND doc_id % 2 = 0 GROUP BY ALL), m AS (SELECT provider, identity FROM n QUALIFY row_number() OVER (PARTITION BY provider ORDER BY seen DESC, identity) <= 9)"""


@query("rejected_memory", f"WITH {MEMORY} SELECT doc_id, m.identity IS NOT NULL AS remembered FROM j LEFT JOIN m USING (provider, identity)")
def rejected_memory(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.col("source").alias("provider"), F.col("text").alias("abstract"), F.concat(F.lit("id-"), (F.col("doc_id") % 400).cast("string")).alias("identity"), F.col("doc_id").alias("seen"))
    return L.recalled(rows, L.remember(rows.filter("doc_id % 2 = 0"), last=9)).select("doc_id", "remembered")


@query("listing_baseline", "WITH v AS (SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, url FROM pages), b AS (SELECT DISTINCT host, url FROM v) SELECT host, url FROM b QUALIFY row_number() OVER (PARTITION BY host ORDER BY url) <= 3")
def listing_baseline(spark, d):
    rows = table(spark, d, "pages").select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), "url")
    return L.baseline(rows.filter("page_id % 2 = 0"), rows.filter("page_id % 2 = 1"), "host", "url", 3)


LISTS = "a AS (SELECT doc_id, 0 AS list, n_chars AS score FROM documents WHERE doc_id % 2 = 0), b AS (SELECT doc_id, 1 AS list, n_chars * 2 AS score FROM documents WHERE doc_id % 3 = 0), c AS (SELECT doc_id, 2 AS list, -n_chars AS score FROM documents WHERE doc_id % 5 = 0)"


@query("union_first_wins", f"WITH {LISTS} SELECT doc_id, list, score FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY list) = 1")
def union_first_wins(spark, d):
    docs = table(spark, d, "documents")
    part = lambda n, score: docs.filter(F.col("doc_id") % n == 0).select("doc_id", score.alias("score"))
    n = F.col("n_chars")
    return L.first_wins(part(2, n), part(3, n * 2), part(5, -n), key=["doc_id"]).select("doc_id", "list", "score")


@query("fused_resolution", "WITH r AS (SELECT doc_id, lang, source FROM documents WHERE doc_id % 2 = 0), p AS (SELECT doc_id, lang, 'package' AS source FROM documents WHERE doc_id % 3 = 0) SELECT doc_id, CASE WHEN r.doc_id IS NOT NULL THEN 'ranked' ELSE 'package' END AS origin, coalesce(r.source, p.source) AS source FROM documents d LEFT JOIN r USING (doc_id) LEFT JOIN p USING (doc_id) WHERE r.doc_id IS NOT NULL OR p.doc_id IS NOT NULL")
def fused_resolution(spark, d):
    docs = table(spark, d, "documents")
    return L.resolve(docs.select("doc_id"), docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 3 = 0").withColumn("source", F.lit("package")), "doc_id", ["lang", "source"]).select("doc_id", "origin", "source")


CLAIMS = f"c AS (SELECT doc_id AS claim_id, source AS source_id, {APPLICABILITY_SQL} AS label, 'https://' || source || '.org/' || doc_id AS url, left({COLLAPSE.format('text')}, 60) AS excerpt, nullif(regexp_extract(text, '[0-9]{{4,}}'), '') AS locator, lang || ' only' AS limitations, 'see ' || source AS applicability, doc_id % 6 AS place, {COLLAPSE.format('text')} AS text FROM (SELECT *, lower(text) AS t FROM documents))"


def claims(spark, d):
    body, n = X.collapse(F.col("text")), F.col("doc_id")
    return table(spark, d, "documents").select(
        n.alias("claim_id"), F.col("source").alias("source_id"), S.applicability(F.lower("text"), CORPUS).alias("label"), F.concat(F.lit("https://"), "source", F.lit(".org/"), n.cast("string")).alias("url"), F.left(body, F.lit(60)).alias("excerpt"),
        F.nullif(F.regexp_extract("text", "[0-9]{4,}", 0), F.lit("")).alias("locator"), F.concat("lang", F.lit(" only")).alias("limitations"), F.concat(F.lit("see "), "source").alias("applicability"), (n % 6).alias("place"), body.alias("text"),
    )


@query("claim_lookup", f"WITH {CLAIMS}, q AS (SELECT claim_id + CASE WHEN claim_id % 13 = 0 THEN 10000000 ELSE 0 END AS claim_id FROM c), x AS (SELECT DISTINCT doc_id AS claim_id FROM labels WHERE toxic = 1), r AS (SELECT q.claim_id, CASE WHEN x.claim_id IS NOT NULL THEN 'excluded_claim' WHEN c.claim_id IS NULL THEN 'unknown_claim_id' WHEN label = 'other_only' THEN 'other_condition_only' WHEN label = 'unknown' THEN 'not_eligible' ELSE 'eligible' END AS reason FROM q LEFT JOIN x USING (claim_id) LEFT JOIN c USING (claim_id)) SELECT claim_id, reason = 'eligible' AS found, reason FROM r")
def claim_lookup(spark, d):
    c = claims(spark, d)
    asked = c.select((F.col("claim_id") + F.when(F.col("claim_id") % 13 == 0, 10_000_000).otherwise(0)).alias("claim_id"))
    return L.lookup(asked, c, table(spark, d, "labels").filter("toxic = 1").select(F.col("doc_id").alias("claim_id")))


CITED = "q AS (SELECT claim_id + CASE WHEN claim_id % 19 = 0 THEN 10000000 ELSE 0 END AS claim_id, CASE WHEN claim_id % 7 = 0 THEN url || '/x' ELSE url END AS url, CASE WHEN claim_id % 5 = 0 THEN upper(excerpt) ELSE excerpt END AS excerpt, CASE WHEN claim_id % 3 = 0 THEN 'p. 1' ELSE locator END AS locator, CASE WHEN claim_id % 4 = 0 THEN ' ' WHEN claim_id % 4 = 1 THEN 'other' ELSE limitations END AS limitations, CASE WHEN claim_id % 8 = 1 THEN 'other' ELSE applicability END AS applicability FROM c)"


def cited(spark, d):
    n = F.col("claim_id")
    odd = lambda m, r, value, c: F.when(n % m == r, value).otherwise(F.col(c)).alias(c)
    limits = F.when(n % 4 == 0, " ").when(n % 4 == 1, "other").otherwise(F.col("limitations")).alias("limitations")
    return claims(spark, d).select((n + F.when(n % 19 == 0, 10_000_000).otherwise(0)).alias("claim_id"), odd(7, 0, F.concat("url", F.lit("/x")), "url"), odd(5, 0, F.upper("excerpt"), "excerpt"), odd(3, 0, F.lit("p. 1"), "locator"), limits, odd(8, 1, F.lit("other"), "applicability"))


@query("citation_mismatches", f"WITH {CLAIMS}, {CITED} SELECT q.claim_id, CASE WHEN c.claim_id IS NULL THEN 'unknown_claim_id' WHEN q.url IS DISTINCT FROM c.url THEN 'url_mismatch' WHEN q.excerpt IS DISTINCT FROM c.excerpt THEN 'excerpt_mismatch' WHEN q.locator IS DISTINCT FROM c.locator THEN 'locator_mismatch' ELSE '' END AS reason FROM q LEFT JOIN c USING (claim_id)")
def citation_mismatches(spark, d):
    return L.citation_mismatches(cited(spark, d), claims(spark, d)).select("claim_id", "reason")


@query("limitation_preservation", f"WITH {CLAIMS}, {CITED} SELECT q.claim_id, CASE WHEN c.claim_id IS NULL OR trim(q.limitations) = '' OR trim(q.applicability) = '' THEN 1 ELSE (q.limitations <> c.limitations)::INT + (q.applicability <> c.applicability)::INT END AS faults FROM q LEFT JOIN c USING (claim_id)")
def limitation_preservation(spark, d):
    return L.limitations_kept(cited(spark, d), claims(spark, d)).select("claim_id", "faults")


ROSTER = [97, 3, 50, 12, 400, 7, 8, 9, 60, 61, 62, 150, 151, 152, 200, 201, 202, 203, 300, 301, 302, 303, 304, 305, 306, 307, 308, 309, 310, 311, 312, 313, 314, 500, 501, 502]
_PLACES = ", ".join(f"({x}, {i})" for i, x in enumerate(ROSTER))


@query("greedy_selection", f"""WITH RECURSIVE p(doc_id, i) AS (VALUES {_PLACES}), r AS (SELECT doc_id, length(text) < 300 AS bare, contains(lower(text), 'the ') AS guide, i FROM documents LEFT JOIN p USING (doc_id)),
o AS (SELECT *, row_number() OVER (ORDER BY i) AS n FROM r WHERE i IS NOT NULL),
w AS (SELECT 0::BIGINT AS n, 0::BIGINT AS doc_id, 0 AS g, 0 AS k, '' AS reason UNION ALL SELECT o.n, o.doc_id, w.g + (CASE WHEN x.why = '' AND guide THEN 1 ELSE 0 END), w.k + (CASE WHEN x.why = '' THEN 1 ELSE 0 END), x.why FROM w JOIN o ON o.n = w.n + 1, LATERAL (SELECT CASE WHEN bare THEN 'no abstract' WHEN guide AND w.g >= 5 THEN 'guideline cap' WHEN w.k >= 12 THEN 'total cap' ELSE '' END AS why) x),
e AS (SELECT max(g) AS g, max(k) AS k FROM w)
SELECT doc_id, CASE WHEN reason = '' THEN 'selected' ELSE 'rejected' END AS decision, reason FROM w WHERE n > 0 UNION ALL SELECT doc_id, 'rejected', CASE WHEN bare THEN 'no abstract' WHEN guide AND e.g >= 5 THEN 'guideline cap' WHEN e.k >= 12 THEN 'total cap' ELSE 'not in roster' END FROM r, e WHERE i IS NULL""")
def greedy_selection(spark, d):
    rows = table(spark, d, "documents").select("doc_id", (F.length("text") < 300).alias("no_abstract"), F.contains(F.lower("text"), F.lit("the ")).alias("guideline"))
    return L.selection(rows, ROSTER, guidelines=5, most=12)


@query("claim_caps", f"WITH {CLAIMS}, n AS (SELECT claim_id, source_id, place, row_number() OVER (PARTITION BY source_id ORDER BY place, claim_id) AS n FROM c), a AS (SELECT *, sum((n <= 4)::INT) OVER (ORDER BY source_id, place, claim_id) AS k FROM n) SELECT claim_id, n <= 4 AND k <= 60 AS kept FROM a")
def claim_caps(spark, d):
    return L.claim_caps(claims(spark, d), 4, 60)


@query("conflict_details", f"WITH {CLAIMS}, l AS (SELECT claim_id AS a, claim_id + 7 AS b FROM c WHERE claim_id % 10 = 0) SELECT a, b, x.source_id AS source_a, y.source_id AS source_b, md5(x.text) AS text_a, md5(y.text) AS text_b FROM l JOIN c x ON x.claim_id = a JOIN c y ON y.claim_id = b")
def conflict_details(spark, d):
    c = claims(spark, d)
    links = c.filter("claim_id % 10 = 0").select(F.col("claim_id").alias("a"), (F.col("claim_id") + 7).alias("b"))
    return L.conflict_details(links, c).select("a", "b", "source_a", "source_b", F.md5(F.col("text_a").cast("binary")).alias("text_a"), F.md5(F.col("text_b").cast("binary")).alias("text_b"))


@query("identifier_audit", "WITH k AS (SELECT 'src' || i AS source_id, i::VARCHAR AS old, (i + 1)::VARCHAR AS corrected FROM range(20) t(i)), s AS (SELECT source AS source_id, (doc_id % 9)::VARCHAR AS identifier FROM documents) SELECT source_id, old, corrected, CASE WHEN identifier = corrected THEN 'corrected' WHEN identifier = old THEN 'still old' ELSE 'neither' END AS state, count(*) AS n FROM s JOIN k USING (source_id) GROUP BY ALL")
def identifier_audit(spark, d):
    known = spark.range(20).select(F.concat(F.lit("src"), F.col("id").cast("string")).alias("source_id"), F.col("id").cast("string").alias("old"), (F.col("id") + 1).cast("string").alias("corrected"))
    rows = table(spark, d, "documents").select(F.col("source").alias("source_id"), (F.col("doc_id") % 9).cast("string").alias("identifier"))
    return L.identifier_audit(known, rows).groupBy("source_id", "old", "corrected", "state").agg(F.count(F.lit(1)).alias("n"))


@query("claim_remediation", f"""WITH {CLAIMS}, f AS (SELECT claim_id, locator IS NOT NULL AS loc, length(text) < 500 AS abs, claim_id % 17 = 0 AS sup, CASE WHEN claim_id % 11 = 0 THEN 'revise' END AS o FROM c), s AS (SELECT *, coalesce(o, CASE WHEN sup THEN 'replace' WHEN NOT loc THEN 'revise' ELSE 'keep' END) AS status, concat_ws('; ', CASE WHEN NOT loc THEN 'locator missing' END, CASE WHEN abs THEN 'abstract only' END, CASE WHEN sup THEN 'source superseded' END) AS issues FROM f)
SELECT claim_id, status, issues, CASE WHEN status = 'keep' THEN CASE WHEN issues = '' THEN 'approve or edit' ELSE 'check the source' END WHEN status = 'replace' THEN 'choose another source' ELSE 'confirm the wording' END AS action FROM s""")
def claim_remediation(spark, d):
    c = claims(spark, d).select("claim_id", F.col("locator").isNotNull().alias("has_locator"), (F.length("text") < 500).alias("abstract_only"), (F.col("claim_id") % 17 == 0).alias("superseded"))
    return L.remediation(c, c.filter("claim_id % 11 = 0").select("claim_id", F.lit("revise").alias("status")))


@query("run_summary", """WITH r AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)) SELECT 'lang' AS part, coalesce(lang, 'not stated') AS key, count(*) AS n FROM r GROUP BY ALL UNION ALL SELECT 'source', coalesce(source, 'not stated'), count(*) FROM r GROUP BY ALL UNION ALL SELECT 'quality', coalesce(quality::VARCHAR, 'not stated'), count(*) FROM r GROUP BY ALL
UNION ALL SELECT 'flag', 'toxic', count(*) FILTER (toxic = 1) FROM r UNION ALL SELECT 'flag', 'short', count(*) FILTER (n_chars < 500) FROM r UNION ALL SELECT * FROM (SELECT 'limit', 'long', count(*) FILTER (n_chars > 2000) - 40 AS n FROM r) WHERE n >= 0 UNION ALL SELECT * FROM (SELECT 'limit', 'every', count(*) - 100000000 AS n FROM r) WHERE n >= 0""")
def run_summary(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    flags = {"toxic": F.coalesce(F.col("toxic") == 1, F.lit(False)), "short": F.col("n_chars") < 500}
    return L.run_summary(rows, ["lang", "source", "quality"], flags, {"long": (F.col("n_chars") > 2000, 40), "every": (F.lit(True), 100_000_000)})


@query("sheet_metrics", "SELECT unnest(['filled_text', 'filled_lang', 'filled_quality', 'english', 'toxic']) AS metric, unnest([count(*) FILTER (coalesce(text, '') <> ''), count(*) FILTER (coalesce(lang, '') <> ''), count(quality), count(*) FILTER (lang = 'en'), count(*) FILTER (toxic = 1)]) AS n FROM documents LEFT JOIN labels USING (doc_id)")
def sheet_metrics(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return L.sheet_metrics(rows, ["text", "lang", "quality"], {"english": ("lang", "en"), "toxic": ("toxic", "1")})


@query("rating_sets_differ", "WITH a AS (SELECT source, list(DISTINCT lang) AS x FROM documents WHERE (doc_id // 50) % 2 = 0 GROUP BY 1), b AS (SELECT source, list(DISTINCT lang) AS y FROM documents WHERE (doc_id // 50) % 2 = 1 GROUP BY 1) SELECT source, list_sort(x) <> list_sort(y) AS differ FROM a JOIN b USING (source)")
def rating_sets_differ(spark, d):
    langs = lambda m, name: table(spark, d, "documents").filter(F.floor(F.col("doc_id") / 50) % 2 == m).groupBy("source").agg(F.collect_set("lang").alias(name))
    return langs(0, "x").join(langs(1, "y"), "source").select("source", L.pair_sets_differ(F.col("x"), F.col("y")).alias("differ"))


@query("sheet_rows", "SELECT 'sources' AS sheet, count(DISTINCT source) AS n FROM documents UNION ALL SELECT 'claims', count(*) FROM documents UNION ALL SELECT 'by_source', count(DISTINCT source) FROM documents UNION ALL SELECT 'without_claims', 0")
def sheet_rows(spark, d):
    docs = table(spark, d, "documents")
    frames = L.sheets(docs.select(F.col("source").alias("source_id")).distinct(), docs.select(F.col("doc_id").alias("claim_id"), F.col("source").alias("source_id")))
    out = None
    for name in ("sources", "claims", "by_source", "without_claims"):
        one = frames[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("sheet"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("search_tool", f"""WITH {CLAIMS}, r AS (SELECT claim_id, row_number() OVER (ORDER BY length(text) DESC, claim_id) AS rank FROM c QUALIFY rank <= 400), x AS (SELECT DISTINCT doc_id AS claim_id FROM labels WHERE toxic = 1)
SELECT 'q' AS query, rank, claim_id, excerpt, coalesce(locator, '') AS locator FROM r JOIN c USING (claim_id) WHERE label IN ('focus', 'general') AND claim_id % 17 <> 0 AND claim_id NOT IN (SELECT claim_id FROM x)""")
def search_tool(spark, d):
    from ..operators.retrieval import top

    c = claims(spark, d).withColumn("superseded", F.col("claim_id") % 17 == 0)
    ranked = top(c.select(F.lit("q").alias("query"), "claim_id", F.length("text").alias("n")), ["query"], [F.desc("n"), F.col("claim_id")], 400).select("query", "rank", "claim_id")
    return L.search(ranked, c, table(spark, d, "labels").filter("toxic = 1").select(F.col("doc_id").alias("claim_id")), ["excerpt", "locator"])


@query("source_lookup", "WITH s AS (SELECT DISTINCT source FROM documents), q AS (SELECT DISTINCT CASE WHEN doc_id % 40 = 0 THEN source || '-x' ELSE source END AS source_id FROM documents) SELECT source_id, s.source IS NOT NULL AS found, CASE WHEN s.source IS NULL THEN 'unknown_source_id' WHEN source_id LIKE '%1' THEN 'superseded' ELSE 'current' END AS status FROM q LEFT JOIN s ON s.source = source_id")
def source_lookup(spark, d):
    docs = table(spark, d, "documents")
    asked = docs.select(F.when(F.col("doc_id") % 40 == 0, F.concat("source", F.lit("-x"))).otherwise(F.col("source")).alias("source_id")).distinct()
    known = docs.select(F.col("source").alias("source_id")).distinct().withColumn("status", F.when(F.col("source_id").endswith("1"), "superseded").otherwise("current"))
    return L.source_of(asked, known)


@query("candidate_key", f"""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'https://doi.org/10.1/A' || doc_id END AS doi, CASE WHEN doc_id % 3 = 0 THEN (doc_id + 100)::VARCHAR END AS pubmed, CASE WHEN doc_id % 5 = 0 THEN 'PMC' || (doc_id + 1000) END AS pmc, {TITLE} AS title, text FROM documents)
SELECT doc_id, coalesce(lower(regexp_replace(doi, 'https://doi.org/', '')), '') AS doi, coalesce(pubmed, '') AS pmid, coalesce(pmc, '') AS pmcid, 'h.org/' || doc_id AS canonical_url, sha256(lower({STRIP.format('title')}) || chr(31) || lower({STRIP.format('text')}) || chr(31)) AS content_hash, {NORM_TITLE.format('title')} AS normalized_title FROM r""")
def candidate_key(spark, d):
    n = F.col("doc_id")
    record = {
        "doi": F.when(n % 2 == 0, F.concat(F.lit("https://doi.org/10.1/A"), n.cast("string"))), "pubmedId": F.when(n % 3 == 0, (n + 100).cast("string")), "pmcId": F.when(n % 5 == 0, F.concat(F.lit("PMC"), (n + 1000).cast("string"))),
        "url": F.concat(F.lit("https://www.h.org/"), n.cast("string"), F.lit("/")), "title": X.title_of(F.col("text")), "abstractText": F.col("text"), "abstract": F.lit(""),
    }
    return table(spark, d, "documents").select("doc_id", *[c.alias(k) for k, c in X.candidate_key(record).items() if k != "trial_id"])


_IDS = ["doi", "pmid", "pmcid", "trial_id"]
_WEAK = ["canonical_url", "normalized_title"]
EDGES = f"""{KEYED}, v AS (SELECT doc_id AS id, doc_id % 4 = 0 AS trial, doi, pmid, pmcid, trial_id, canonical_url, CASE WHEN length(normalized_title) >= 25 THEN normalized_title ELSE '' END AS normalized_title FROM y),
k AS ({' UNION ALL '.join(f"SELECT id, trial, '{k}' AS kind, {k} AS value FROM v WHERE {k} <> ''" for k in _IDS + _WEAK)}), f AS (SELECT trial, kind, value, min(id) AS dst FROM k GROUP BY ALL),
e AS (SELECT DISTINCT k.id AS src, dst, kind FROM k JOIN f USING (trial, kind, value) JOIN v a ON a.id = k.id JOIN v b ON b.id = dst WHERE k.id > dst AND (kind IN ('doi', 'pmid', 'pmcid', 'trial_id') OR NOT ({' OR '.join(f"(a.{k} <> '' AND b.{k} <> '' AND a.{k} <> b.{k})" for k in _IDS)})))"""


def _edges(spark, d):
    title = F.when(F.length("normalized_title") >= 25, F.col("normalized_title"))
    rows = save(keyed(spark, d).select(F.col("doc_id").alias("id"), (F.col("doc_id") % 4 == 0).alias("trial"), *_IDS, "canonical_url", title.alias("normalized_title")), "identities")
    return rows, R.identity_edges(rows, _IDS, _WEAK)


@query("identity_edges", f"WITH {EDGES} SELECT * FROM e")
def identity_edges(spark, d):
    return _edges(spark, d)[1]


@query("identity_components", f"WITH RECURSIVE {EDGES}, b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e), w(id, node) AS (SELECT id, id FROM v UNION SELECT w.id, b.dst FROM w JOIN b ON b.src = w.node) SELECT id, min(node) AS root FROM w GROUP BY id")
def identity_components(spark, d):
    rows, edges = _edges(spark, d)
    return R.components(rows.select("id"), edges)
