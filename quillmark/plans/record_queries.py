"""Staged records, claims, accounting and listings over the check tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import records as R
from ..operators import screening as S
from .aggregate_queries import PRIOR, rated
from .catalog import query, table
from .extraction_queries import SENTENCES
from .text_queries import STRIP, TITLE, sql_any

LICENSE = r"regexp_extract(text, '(?i)([^\n]*licen[sc]e[^\n]*)', 1)"
REGION = "CASE WHEN contains(lang, 'en') THEN 'Anglophone sources' WHEN contains(lang, 'fr') THEN 'Francophone sources' WHEN contains(lang, 'de') THEN 'German-language sources' ELSE 'Region not stated' END"


@query("source_record", f"""SELECT doc_id, {STRIP.format(TITLE)} AS title, source AS provider, nullif({LICENSE}, '') AS license, CASE WHEN {LICENSE} <> '' AND {sql_any(('apache', 'mit', 'cc by'), f'lower({LICENSE})')} THEN 'archive' ELSE 'metadata only' END AS archival,
{REGION} AS region, length(text) < 500 AS needs_full_text, sha256(lower({STRIP.format('text')}) || chr(31)) AS checksum FROM documents""")
def source_record(spark, d):
    return R.source_records(table(spark, d, "documents"), "run-1").select("doc_id", "title", "provider", "license", "archival", "region", "needs_full_text", F.col("provenance.checksum").alias("checksum"))


@query("locator_text", f"SELECT doc_id, coalesce(nullif(concat_ws('; ', nullif({STRIP.format(TITLE)}, ''), nullif(regexp_extract(text, '[0-9]{{4,}}'), ''), nullif(source, '')), ''), 'location not stated') AS locator FROM documents")
def locator_text(spark, d):
    return table(spark, d, "documents").select("doc_id", R.locator(X.title_of(F.col("text")), F.regexp_extract("text", "[0-9]{4,}", 0), F.col("source")).alias("locator"))


@query("plain_language", rf"""WITH x AS (SELECT doc_id, toxic, replace(replace({TITLE}, 'tion', 'tion (process)'), 'keit', 'keit (state)') AS s FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, CASE WHEN toxic = 1 THEN 'Observed: ' ELSE '' END || CASE WHEN length(s) > 420 THEN regexp_replace(left(s, 417), '\s\S*$', '') || '...' ELSE s END AS plain FROM x""")
def plain_language(spark, d):
    return rated(spark, d).select("doc_id", R.plain_language(X.title_of(F.col("text")), F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("plain"))


@query("claim_construction", f"""WITH d AS (SELECT doc_id, source, {SENTENCES} AS l FROM documents), x AS (SELECT doc_id, source, unnest(range(len(l)))::INT AS sentence_no, unnest(l) AS claim FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN contains(claim, 'ation') THEN 5 ELSE 0 END DESC, sentence_no) AS n FROM x QUALIFY n <= 4),
v AS (SELECT doc_id, source, sentence_no, claim, CASE WHEN regexp_matches(claim, '[0-9]{{4}}') THEN 'numbers' WHEN regexp_matches(claim, '@') THEN 'address' ELSE '' END AS rejected FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY source, rejected = '' ORDER BY doc_id, sentence_no) AS m FROM v) SELECT doc_id, source, sentence_no, claim, rejected FROM k WHERE rejected <> '' OR m <= 100""")
def claim_construction(spark, d):
    return R.claims(table(spark, d, "documents"), lambda s: F.when(F.contains(s, F.lit("ation")), 5).otherwise(0), {"numbers": "[0-9]{4}", "address": "@"}, 4, 100)


@query("claim_accounting", f"WITH {PRIOR}, a AS (SELECT CASE WHEN dup IS NOT NULL THEN 'removed_duplicate' WHEN quality = 0 THEN 'replaced' WHEN toxic = 1 THEN 'revised' WHEN quality IS NULL THEN 'unreviewed' ELSE 'kept' END AS category FROM p LEFT JOIN labels USING (doc_id)) SELECT category, count(*) AS n, (SELECT count(*) FROM a) AS total FROM a GROUP BY category")
def claim_accounting(spark, d):
    docs = table(spark, d, "documents")
    rows = docs.join(S.prior_duplicates(docs), "doc_id").join(table(spark, d, "labels"), "doc_id", "left").withColumn("duplicate", F.col("reason").isNotNull())
    return R.accounting(rows)


@query("listing_in_window", "WITH l AS (SELECT page_id, url, DATE '2024-01-01' + (page_id % 60)::INT AS day FROM pages), b AS (SELECT DISTINCT url FROM pages WHERE page_id % 2 = 0) SELECT page_id, day FROM l LEFT JOIN b USING (url) WHERE day >= DATE '2024-01-05' AND (b.url IS NULL OR day BETWEEN DATE '2024-01-20' AND DATE '2024-01-31')")
def listing_in_window(spark, d):
    pages = table(spark, d, "pages")
    listing = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 60).cast("int")).alias("day"))
    day = lambda x: F.lit(x).cast("date")
    return R.in_window(listing, pages.filter("page_id % 2 = 0"), day("2024-01-20"), day("2024-01-31"), day("2024-01-05")).select("page_id", "day")


@query("edit_replay", "WITH e AS (SELECT doc_id, unnest([1, 2]) AS part FROM labels WHERE quality = 0) SELECT doc_id, 0 AS part FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM e) UNION ALL SELECT doc_id, part FROM e")
def edit_replay(spark, d):
    edits = table(spark, d, "labels").filter("quality = 0").select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("part"))
    return R.replay(table(spark, d, "documents").select("doc_id"), edits, "doc_id")


@query("translation_check", "SELECT event_id, event_id % 7 <> 0 AND event_id % 5 <> 1 AND contains(props, '\"k\"') AS translated FROM events")
def translation_check(spark, d):
    events = table(spark, d, "events")
    errors = F.when(F.col("event_id") % 7 == 0, F.array(F.lit("bad"))).otherwise(F.array().cast("array<string>"))
    warnings = F.when(F.col("event_id") % 5 == 1, F.array(F.lit("odd"))).when(F.col("event_id") % 5 == 2, F.array(F.lit("benign"))).otherwise(F.array().cast("array<string>"))
    return R.translation_check(events, errors, warnings, "benign", F.col("props"), ('"k"',)).select("event_id", "translated")


@query("sanitised_projection", r"SELECT doc_id, source, split_part(text, chr(10), 1) AS title, regexp_matches(split_part(text, chr(10), 1), 'https?://|www\.|(?:^|\s)@[A-Za-z0-9_]+|[A-Za-z0-9.]+@[A-Za-z0-9.-]+') OR length(split_part(text, chr(10), 1)) > 300 OR split_part(text, chr(10), 1) = '' AS violation FROM documents")
def sanitised_projection(spark, d):
    rows = table(spark, d, "documents").withColumn("title", X.title_of(F.col("text")))
    return R.sanitised(rows, ["doc_id", "source", "title"], "title")


@query("alert_order", "WITH c AS (SELECT event_type AS provider, count(*) AS n FROM events GROUP BY 1), a AS (SELECT provider, n, CASE WHEN n > 3000 THEN 'error' WHEN n > 1500 THEN 'warn' ELSE 'info' END AS level FROM c) SELECT provider, n, level, row_number() OVER (ORDER BY CASE level WHEN 'error' THEN 0 WHEN 'warn' THEN 1 ELSE 2 END, provider) AS pos FROM a")
def alert_order(spark, d):
    from pyspark.sql.window import Window

    counts = table(spark, d, "events").groupBy(F.col("event_type").alias("provider")).agg(F.count(F.lit(1)).alias("n"))
    level = F.when(F.col("n") > 3000, "error").when(F.col("n") > 1500, "warn").otherwise("info")
    rank = F.when(F.col("level") == "error", 0).when(F.col("level") == "warn", 1).otherwise(2)
    return counts.withColumn("level", level).withColumn("pos", F.row_number().over(Window.orderBy(rank, "provider")).cast("long"))
