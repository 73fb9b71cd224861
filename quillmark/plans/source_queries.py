"""Source payloads over the check tables: answers are built from table columns and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..sources import literature as L
from ..sources import packages as K
from ..sources import web as W
from .catalog import query, table
from .text_queries import _HTML, COLLAPSE, STRIP, TITLE, TITLE_SQL

SLOT = "doc_id // 20 AS page"


@query("search_payload", f"WITH p AS (SELECT {SLOT}, list(doc_id::VARCHAR ORDER BY doc_id) AS ids, count(*) AS n FROM documents GROUP BY 1) SELECT page, array_to_string(CASE WHEN page % 5 = 4 THEN [] ELSE ids END, ',') AS ids, CASE WHEN page % 5 = 4 THEN 0 ELSE n END AS count, CASE WHEN page % 3 = 0 THEN 0 ELSE page * 20 END AS retstart, 'term ' || page AS translation, CASE WHEN page % 4 = 0 THEN 'bad phrase' ELSE '' END AS errors FROM p")
def search_payload(spark, d):
    pages = table(spark, d, "documents").groupBy(F.floor(F.col("doc_id") / 20).alias("page")).agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))  # 20 ids a page
    page, empty = F.col("page"), F.col("page") % 5 == 4
    result = F.struct(
        F.when(~empty, F.size("ids").cast("string")).alias("count"), F.when(page % 3 != 0, (page * 20).cast("string")).alias("retstart"), F.when(~empty, F.transform("ids", lambda i: i.cast("string"))).alias("idlist"),
        F.concat(F.lit("term "), page.cast("string")).alias("querytranslation"), F.when(page % 4 == 0, F.struct(F.array(F.lit("bad phrase")).alias("phrasesnotfound"))).alias("errorlist"),
    )
    found = L.search_pages(pages.select("page", F.to_json(F.struct(result.alias("esearchresult"))).alias("payload")))
    return found.select("page", F.array_join("ids", ",").alias("ids"), "count", "retstart", "translation", F.array_join("errors", ",").alias("errors"))


@query("summary_payload", f"""WITH s AS (SELECT doc_id::VARCHAR AS pmid, regexp_replace({STRIP.format(TITLE)}, '[.]+$', '') AS title, source || ', ' || lang AS authors, CASE WHEN doc_id % 2 = 0 THEN 'Journal of ' || lang ELSE source END AS journal, CASE WHEN doc_id % 3 = 0 THEN '10.1/' || doc_id ELSE '' END AS doi FROM documents)
SELECT pmid, md5(title) AS title, authors, journal, '2024' AS year, doi, CASE WHEN doi <> '' THEN 'https://doi.org/' || doi ELSE 'https://pubmed.ncbi.nlm.nih.gov/' || pmid || '/' END AS url FROM s""")
def summary_payload(spark, d):
    n = F.col("doc_id")
    name = lambda c: F.struct(F.col(c).alias("name"))
    ids = F.array_compact(F.array(F.struct(F.lit("pubmed").alias("idtype"), n.cast("string").alias("value")), F.when(n % 3 == 0, F.struct(F.lit("doi").alias("idtype"), F.concat(F.lit("10.1/"), n.cast("string")).alias("value")))))
    item = F.to_json(F.struct(X.title_of(F.col("text")).alias("title"), F.array(name("source"), name("lang")).alias("authors"), F.when(n % 2 == 0, F.concat(F.lit("Journal of "), "lang")).otherwise("").alias("fulljournalname"), "source", F.lit("2024 Mar").alias("pubdate"), ids.alias("articleids")))
    one = F.concat(F.lit('{"result":{"uids":["'), n.cast("string"), F.lit('"],"'), n.cast("string"), F.lit('":'), item, F.lit("}}"))
    return L.summaries(table(spark, d, "documents").select(one.alias("payload"))).select("pmid", F.md5(F.col("title").cast("binary")).alias("title"), "authors", "journal", "year", "doi", "url")


@query("full_text_fallback", f"""WITH p AS (SELECT page_id, {COLLAPSE.format(_HTML)} AS t, string_split({TITLE_SQL}, '|') AS parts FROM pages), x AS (SELECT *, {STRIP.format('CASE WHEN len(parts) >= 3 THEN parts[2] ELSE parts[1] END')} AS title FROM p)
SELECT page_id, CASE WHEN length(t) >= 500 THEN 'full text' ELSE 'fallback' END AS origin, CASE WHEN length(t) >= 500 THEN length(t) ELSE length(title) END AS n_chars FROM x""")
def full_text_fallback(spark, d):
    return table(spark, d, "pages").select("page_id", L.full_text(F.col("html"), X.html_title(F.col("html"))).alias("x")).select("page_id", F.col("x.origin").alias("origin"), F.length("x.text").cast("long").alias("n_chars"))


@query("page_dates", "SELECT page_id, DATE '2024-01-01' + greatest((page_id % 28)::INT, (page_id * 7 % 28)::INT) AS latest FROM pages")
def page_dates(spark, d):
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int")).cast("string")
    html = F.concat(F.lit('<time datetime="'), day(F.col("page_id") % 28), F.lit('T00:00">a</time><time datetime="'), day(F.col("page_id") * 7 % 28), F.lit('">b</time><time datetime="2024-99-99">'), "html")
    return table(spark, d, "pages").select("page_id", L.latest_date(html).alias("latest"))


@query("sitemap_section", "WITH e AS (SELECT page_id, 'https://h.org/' || CASE WHEN page_id % 2 = 0 THEN 'guidance/ng' ELSE 'news/ng' END || page_id || '-ibd-care' AS loc FROM pages) SELECT page_id, loc, 'Ng' || page_id || ' IBD Care' AS title FROM e WHERE page_id % 2 = 0")
def sitemap_section(spark, d):
    where = F.when(F.col("page_id") % 2 == 0, "guidance/ng").otherwise("news/ng")
    loc = F.concat(F.lit("https://h.org/"), where, F.col("page_id").cast("string"), F.lit("-ibd-care"))
    xml = F.concat(F.lit("<urlset><url><loc>"), loc, F.lit("</loc><lastmod>2024-01-01</lastmod></url><url><loc>https://h.org/guidance/other</loc></url></urlset>"))
    rows = table(spark, d, "pages").select("page_id", F.explode(W.in_section(W.sitemap(xml), "/guidance/", "^ng[0-9]+")).alias("e"))
    return rows.select("page_id", "e.loc", W.slug_title(F.col("e.loc"), ("ibd",)).alias("title"))


@query("package_merge", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'run-1' ELSE 'run-2' END AS run_id FROM documents")
def package_merge(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return K.append_package(docs.filter("doc_id % 2 = 0").withColumn("run_id", F.lit("run-1")), docs.filter("doc_id % 2 = 1"), "run-2").select("doc_id", "run_id")



@query("literature_records", f"""SELECT doc_id::VARCHAR AS pmid, md5(regexp_replace({STRIP.format(TITLE)}, '\\.+$', '')) AS title, CASE WHEN doc_id % 2 = 0 THEN '10.1/a' || doc_id ELSE '' END AS doi, doc_id % 3 = 0 AS open, CASE WHEN doc_id % 2 = 0 THEN 'https://doi.org/10.1/a' || doc_id ELSE 'urn:record:' || doc_id END AS url FROM documents""")
def literature_records(spark, d):
    n = F.col("doc_id")
    one = F.struct(n.cast("string").alias("id"), X.title_of(F.col("text")).alias("title"), F.when(n % 2 == 0, F.concat(F.lit("10.1/A"), n.cast("string"))).alias("doi"), n.cast("string").alias("pmid"), F.when(n % 3 == 0, "Y").otherwise("N").alias("isOpenAccess"))
    raw = table(spark, d, "documents").select(F.to_json(F.struct(F.lit(1).alias("hitCount"), F.struct(F.array(one).alias("result")).alias("resultList"))).alias("json"))
    return K.literature(raw).select("pmid", F.md5(F.col("title").cast("binary")).alias("title"), "doi", "open", "url")


@query("registry_records", "SELECT 'NCT' || lpad(doc_id::VARCHAR, 8, '0') AS trial_id, CASE WHEN doc_id % 4 = 0 THEN 'completed' ELSE 'ongoing' END AS evidence_type, lang || '; ' || source AS conditions FROM documents")
def registry_records(spark, d):
    n = F.col("doc_id")
    protocol = F.struct(
        F.struct(F.concat(F.lit("nct"), F.lpad(n.cast("string"), 8, "0")).alias("nctId")).alias("identificationModule"), F.struct(F.when(n % 4 == 0, "Completed").otherwise("Recruiting").alias("overallStatus")).alias("statusModule"),
        F.struct(F.array("lang", "source").alias("conditions")).alias("conditionsModule"),
    )
    raw = table(spark, d, "documents").select(F.to_json(F.struct(F.array(F.struct(protocol.alias("protocolSection"))).alias("studies"))).alias("json"))
    return K.registry(raw).select("trial_id", "evidence_type", "conditions")


@query("article_xml", "SELECT doc_id::VARCHAR AS pmid, 'On ' || lang AS title, 'Part one Part two' AS abstract, CASE WHEN doc_id % 2 = 0 THEN '2024' ELSE '2019' END AS year, '10.1/' || doc_id AS doi FROM documents")
def article_xml(spark, d):
    n = F.col("doc_id").cast("string")
    date = F.when(F.col("doc_id") % 2 == 0, "<Year>2024</Year>").otherwise("<MedlineDate>2019 Spring</MedlineDate>")
    xml = F.concat(
        F.lit("<Set><PubmedArticle><MedlineCitation><PMID>"), n, F.lit("</PMID><Article><Journal><JournalIssue><PubDate>"), date, F.lit("</PubDate></JournalIssue><Title>J</Title></Journal><ArticleTitle>On  "), F.col("lang"),
        F.lit("</ArticleTitle><Abstract><AbstractText>Part one</AbstractText><AbstractText>Part two</AbstractText></Abstract></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType='doi'>10.1/"), n,
        F.lit("</ArticleId></ArticleIdList><ReferenceList><Reference><ArticleIdList><ArticleId IdType='doi'>10.9/x</ArticleId></ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle></Set>"),
    )
    return W.articles(table(spark, d, "documents").select(xml.alias("xml"))).select("pmid", "title", "abstract", "year", "doi")


@query("listing_card_rows", "SELECT page_id, 0 AS card_no, DATE '2024-01-01' + (page_id % 30)::INT AS day, 'Card ' || page_id AS name, '/p/' || page_id AS link FROM pages")
def listing_card_rows(spark, d):
    n = F.col("page_id").cast("string")
    ms = ((F.unix_date(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 30).cast("int"))).cast("long")) * 86_400_000).cast("string")
    html = F.concat(F.lit('<div class="c" data-date-created="'), ms, F.lit('"><a href="/x.pdf">f</a><a href="/p/'), n, F.lit('"><span class="name">Card <b>'), n, F.lit("</b></span></a></div>"))
    return W.listing_cards(table(spark, d, "pages").select("page_id", html.alias("html"))).select("page_id", "card_no", "day", "name", "link")


@query("robots_decisions", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN true ELSE false END AS allowed FROM pages")
def robots_decisions(spark, d):
    body = "User-agent: *\nDisallow: /private\nAllow: /private/open\nDisallow: /*.cgi$\n\nUser-agent: other\nDisallow: /"
    pages = table(spark, d, "pages").select("page_id", F.concat(F.lit("https://h"), F.pmod("page_id", F.lit(9)).cast("string"), F.lit(".org/"), F.get(F.array(*[F.lit(x) for x in ("private/", "private/open/", "news/", "run/")]), (F.col("page_id") % 4).cast("int")), F.col("page_id").cast("string"), F.when(F.col("page_id") % 4 == 3, ".cgi").otherwise("")).alias("url"))
    files = spark.range(9).select(F.concat(F.lit("h"), F.col("id").cast("string"), F.lit(".org")).alias("host"), F.lit(body).alias("body"))
    return pages.join(W.robots_allowed(pages.select("url"), W.robots_rules(files), "reader"), "url").select("page_id", "allowed")


@query("cache_keys", "SELECT doc_id, sha256('https://h.org/' || source || '?a=' || lang || '&b=' || doc_id) AS key FROM documents")
def cache_keys(spark, d):
    from ..sources.landing import cache_key

    params = F.create_map(F.lit("b"), F.col("doc_id").cast("string"), F.lit("a"), F.col("lang"))
    return table(spark, d, "documents").select("doc_id", cache_key(F.concat(F.lit("https://h.org/"), "source"), params).alias("key"))


@query("host_rules", "SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) IN ('thther.example.org', 'm.ththth.example.net') AND NOT contains(url, '/fr/') AS allowed FROM pages")
def host_rules(spark, d):
    return table(spark, d, "pages").select("page_id", W.host_allowed(F.col("url"), ("thther.example.org", "m.ththth.example.net"), ("/fr/",)).alias("allowed"))


@query("package_scan", "SELECT source AS claimId, n FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1) WHERE source NOT LIKE '%1'")
def package_scan(spark, d):
    import uuid

    from ..operators.storage import shared_folder

    path = f"{shared_folder(spark)}/package-{uuid.uuid4().hex}"
    by = table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    rows = by.agg(F.collect_list(F.struct(F.col("source").alias("claimId"), "n")).alias("claims"), F.collect_list(F.struct(F.col("source").alias("sourceId"))).alias("sources"), F.collect_list(F.when(F.col("source").endswith("1"), F.col("source"))).alias("excludedClaimIds"))  # a row for each source
    rows.coalesce(1).write.json(path)
    return K.read_package(spark, path)[0].select("claimId", "n")


@query("report_lines", "WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1) SELECT '# Run' || chr(10) || chr(10) || '| lang | n |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || coalesce(lang, '') || ' | ' || n || ' |', chr(10) ORDER BY '| ' || coalesce(lang, '') || ' | ' || n || ' |') AS report FROM c")
def report_lines(spark, d):
    return K.report(table(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "Run")
