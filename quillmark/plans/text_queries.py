"""Normalisers, keys, mark-up and classifiers over the check tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.lexicon import CORPUS, contains_any
from ..operators import screening
from .catalog import query, table

STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
COLLAPSE = r"regexp_replace(regexp_replace({}, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')"
TITLE = "split_part(text, chr(10), 1)"
NORM_TITLE = COLLAPSE.format(r"regexp_replace(lower({}), '[^\pL\pN_\s]', ' ', 'g')")
NORM_URL = r"regexp_replace(regexp_replace(regexp_replace(lower(" + STRIP.format("url") + r"), '^https?://', ''), '^www\.', ''), '/+$', '')"


def sql_first(groups, default, text="t", patterns=False) -> str:
    hit = (lambda v: "(" + " OR ".join(f"regexp_matches({text}, '{p}')" for p in v) + ")") if patterns else (lambda v: "(" + " OR ".join(f"contains({text}, '{p}')" for p in v) + ")")
    return "CASE " + " ".join(f"WHEN {hit(v)} THEN '{k}'" for k, v in groups.items()) + f" ELSE '{default}' END"


def sql_all(groups, text="t", patterns=False) -> str:
    hit = (lambda v: "(" + " OR ".join(f"regexp_matches({text}, '{p}')" for p in v) + ")") if patterns else (lambda v: "(" + " OR ".join(f"contains({text}, '{p}')" for p in v) + ")")
    return "list_filter([" + ", ".join(f"CASE WHEN {hit(v)} THEN '{k}' END" for k, v in groups.items()) + "], lambda x: x IS NOT NULL)"


def sql_any(terms, text="t") -> str:
    return "(" + " OR ".join(f"contains({text}, '{p}')" for p in terms) + ")"


@query("norm_title", f"SELECT doc_id, {NORM_TITLE.format(TITLE)} AS title FROM documents")
def norm_title(spark, d):
    return table(spark, d, "documents").select("doc_id", X.norm_title(X.title_of(F.col("text"))).alias("title"))


@query("norm_url", f"SELECT page_id, {NORM_URL} AS url_key FROM pages")
def norm_url(spark, d):
    return table(spark, d, "pages").select("page_id", X.norm_url(F.col("url")).alias("url_key"))


@query("canonical_url", r"SELECT page_id, regexp_replace(replace(url, '&amp;', '&'), '[?#].*$', '') AS canonical FROM pages")
def canonical_url(spark, d):
    return table(spark, d, "pages").select("page_id", X.canonical_url(F.col("url")).alias("canonical"))


IDENTIFIERS = ("https://doi.org/10.1000/AbC", " doi: 10.5/X ", "http://dx.doi.org/10.2/y", "PMID: 123456", "pmc998877", "trial nct01234567 x", "", "no id")


_RAW = "[" + ", ".join(f"'{x}'" for x in IDENTIFIERS) + f"][doc_id % {len(IDENTIFIERS)} + 1] || doc_id"


@query("norm_identifiers", rf"""WITH r AS (SELECT doc_id, {_RAW} AS raw FROM documents)
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(lower(trim(raw)), '^https?://(dx\.)?doi\.org/', ''), '^doi:\s*', ''), '^\s+|\s+$', '', 'g') AS doi,
  regexp_extract(raw, '[0-9]+') AS pmid,
  CASE WHEN regexp_extract(upper(raw), '(?:PMC)?([0-9]+)', 1) <> '' THEN 'PMC' || regexp_extract(upper(raw), '(?:PMC)?([0-9]+)', 1) ELSE '' END AS pmcid,
  regexp_extract(upper(raw), 'NCT[0-9]{{8}}') AS trial FROM r""")
def norm_identifiers(spark, d):
    """Every document's number behind one of the forms in which identifiers come."""
    form = F.get(F.array(*[F.lit(x) for x in IDENTIFIERS]), (F.col("doc_id") % len(IDENTIFIERS)).cast("int"))
    raw = table(spark, d, "documents").select("doc_id", F.concat(form, F.col("doc_id").cast("string")).alias("raw"))
    return raw.select("doc_id", X.norm_doi(F.col("raw")).alias("doi"), X.norm_pmid(F.col("raw")).alias("pmid"), X.norm_pmcid(F.col("raw")).alias("pmcid"), X.norm_trial_id(F.col("raw")).alias("trial"))


@query("content_hash", f"SELECT doc_id, sha256(lower({STRIP.format(TITLE)}) || chr(31) || lower({STRIP.format('text')}) || chr(31)) AS sha FROM documents")
def content_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", X.content_hash(X.title_of(F.col("text")), F.col("text")).alias("sha"))


@query("identity_key", f"""SELECT 'doc' AS kind, doc_id AS id, left('title:' || nullif({NORM_TITLE.format(TITLE)}, ''), 200) AS identity FROM documents
UNION ALL SELECT 'page', page_id, left('url:' || nullif({NORM_URL}, ''), 200) FROM pages""")
def identity_key(spark, d):
    docs = table(spark, d, "documents").select(F.lit("doc").alias("kind"), F.col("doc_id").alias("id"), X.identity(title=X.norm_title(X.title_of(F.col("text")))).alias("identity"))
    pages = table(spark, d, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), X.identity(doi=F.lit(""), url=X.norm_url(F.col("url"))).alias("identity"))
    return docs.unionByName(pages)


TITLE_SQL = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"


@query("html_title", f"WITH p AS (SELECT page_id, string_split({TITLE_SQL}, '|') AS parts FROM pages) SELECT page_id, {STRIP.format('CASE WHEN len(parts) >= 3 THEN parts[2] ELSE parts[1] END')} AS title FROM p")
def html_title(spark, d):
    return table(spark, d, "pages").select("page_id", X.html_title(F.col("html")).alias("title"))


_HTML = "html"
for _t in ("script", "style", "nav", "footer", "header"):
    _HTML = rf"regexp_replace({_HTML}, '(?is)<{_t}\b.*?</{_t}>', ' ', 'g')"
_HTML = f"regexp_replace({_HTML}, '(?s)<[^>]*>', ' ', 'g')"
for _a, _b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    _HTML = f"replace({_HTML}, '{_a}', '{_b}')"


@query("html_text", f"WITH p AS (SELECT page_id, {COLLAPSE.format(_HTML)} AS t FROM pages) SELECT page_id, length(t) AS n_chars, length(t) < 500 AS fallback, md5(t) AS digest FROM p")
def html_text(spark, d):
    pages = table(spark, d, "pages").select("page_id", X.html_text(F.col("html")).alias("t"))
    return pages.select("page_id", F.length("t").cast("long").alias("n_chars"), (F.length("t") < 500).alias("fallback"), F.md5(F.col("t").cast("binary")).alias("digest"))


@query("html_links", """WITH p AS (SELECT page_id, regexp_extract_all(html, '(?i)href=["'']([^"'']+)["'']', 1) AS l FROM pages)
SELECT page_id, unnest(range(len(l)))::INT AS pos, unnest(l) AS href FROM p""")
def html_links(spark, d):
    return table(spark, d, "pages").select("page_id", F.posexplode(X.html_links(F.col("html"))).alias("pos", "href"))


@query("link_crawl", """WITH p AS (SELECT page_id, regexp_extract_all(html, '(?i)href=["'']([^"'']+)["'']', 1) AS l FROM pages), x AS (SELECT page_id, unnest(range(len(l))) AS pos, unnest(l) AS href FROM p),
f AS (SELECT page_id, href, min(pos) AS pos FROM x GROUP BY ALL) SELECT page_id, href, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS step FROM f QUALIFY step <= 6""")
def link_crawl(spark, d):
    from ..sources.web import crawl_frontier

    return crawl_frontier(table(spark, d, "pages"), 6)


@query("json_props", "SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS sum_k FROM events GROUP BY event_type")
def json_props(spark, d):
    k = F.from_json("props", "k long")["k"]
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("sum_k"))


@query("redacted_projection", r"""SELECT doc_id, source, regexp_replace(text, '(?i)(?:password|token|secret|api[_-]?key)\s*=\s*\S+|AKIA[0-9A-Z]{16}', '[redacted]', 'g') AS text,
array_to_string(regexp_extract_all(split_part(text, chr(10), 1), '[A-Za-z][A-Za-z-]{3,}')[1:6], ' ') AS label FROM documents""")
def redacted_projection(spark, d):
    label = F.array_join(F.slice(F.regexp_extract_all(X.title_of(F.col("text")), F.lit("[A-Za-z][A-Za-z-]{3,}"), F.lit(0)), 1, 6), " ")
    return table(spark, d, "documents").select("doc_id", "source", X.redact_secrets(F.col("text")).alias("text"), label.alias("label"))


# ---- classifiers ----

LOW = "(SELECT *, lower(text) AS t FROM {})"


def _low(spark, d, name="documents"):
    return table(spark, d, name).withColumn("t", F.lower("text"))


@query("relevance_match", f"WITH x AS (SELECT doc_id, list_filter([{', '.join(repr(t) for t in CORPUS.relevant.groups['relevant'])}], lambda k: contains(t, k)) AS m FROM {LOW.format('documents')}) SELECT doc_id, array_to_string(m, '; ') AS matched, len(m) > 0 AS relevant FROM x")
def relevance_match(spark, d):
    found = CORPUS.relevant.matched(F.col("t"))
    return _low(spark, d).select("doc_id", F.array_join(found, "; ").alias("matched"), (F.size(found) > 0).alias("relevant"))


APPLICABILITY_SQL = f"CASE WHEN {sql_any(CORPUS.focus)} AND NOT {sql_any(CORPUS.other)} THEN 'focus' WHEN {sql_any(CORPUS.other)} AND NOT {sql_any(CORPUS.focus)} THEN 'other_only' WHEN {sql_any(CORPUS.focus)} OR {sql_any(CORPUS.general)} THEN 'general' ELSE 'unknown' END"


@query("applicability_label", f"SELECT doc_id, {APPLICABILITY_SQL} AS label FROM {LOW.format('documents')}")
def applicability_label(spark, d):
    return _low(spark, d).select("doc_id", screening.applicability(F.col("t"), CORPUS).alias("label"))


@query("classify_topics", f"WITH x AS (SELECT doc_id, {sql_all(CORPUS.topics.groups)}[1:6] AS l FROM {LOW.format('documents')}) SELECT doc_id, CASE WHEN len(l) = 0 THEN 'core' ELSE array_to_string(l, '; ') END AS topics, coalesce(l[1], 'core') AS first_topic FROM x")
def classify_topics(spark, d):
    found = CORPUS.topics.all(F.col("t"), 6)
    return _low(spark, d).select("doc_id", F.array_join(found, "; ").alias("topics"), F.get(found, F.lit(0)).alias("first_topic"))


@query("multi_label_context", f"WITH x AS (SELECT doc_id, {sql_all(CORPUS.contexts.groups, patterns=True)} AS l FROM {LOW.format('documents')}) SELECT doc_id, CASE WHEN len(l) = 0 THEN 'general' ELSE array_to_string(l, ', ') END AS labels FROM x")
def multi_label_context(spark, d):
    return _low(spark, d).select("doc_id", F.array_join(CORPUS.contexts.all(F.col("t")), ", ").alias("labels"))


@query("sample_size_extract", r"SELECT doc_id, coalesce(nullif(regexp_extract(text, '([0-9]+)\s+[a-z]+', 1), ''), nullif(regexp_extract(text, '[a-z]+\s+([0-9]{3,})', 1), ''), '') AS size FROM documents")
def sample_size_extract(spark, d):
    t = F.col("text")
    first = [F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in (r"([0-9]+)\s+[a-z]+", r"[a-z]+\s+([0-9]{3,})")]
    return table(spark, d, "documents").select("doc_id", F.coalesce(*first, F.lit("")).alias("size"))


@query("publication_class", f"""SELECT doc_id, CASE WHEN contains(t, 'license') OR contains(t, 'licence') THEN 'guideline' WHEN regexp_matches(t, '[0-9]{{4}}') THEN 'report' ELSE 'paper' END AS study,
CASE WHEN contains(t, 'license') OR contains(t, 'licence') THEN 50 WHEN regexp_matches(t, '[0-9]{{4}}') THEN 35 ELSE 25 END AS weight FROM {LOW.format('documents')}""")
def publication_class(spark, d):
    return _low(spark, d).select("doc_id", screening.study_class(F.col("t")).alias("c")).select("doc_id", "c.study", "c.weight")


@query("safety_boundary", f"SELECT conv_id, turn, boundary, CASE boundary WHEN 'none' THEN 'information' WHEN 'emergency' THEN 'urgent' ELSE 'refuse_' || boundary END AS intent FROM (SELECT conv_id, turn, {sql_first(CORPUS.boundaries.groups, 'none', patterns=True)} AS boundary FROM {LOW.format('conversations')} WHERE role = 'user')")
def safety_boundary(spark, d):
    rows = _low(spark, d, "conversations").filter("role = 'user'")
    return rows.select("conv_id", "turn", CORPUS.boundaries.first(F.col("t")).alias("boundary")).withColumn("intent", screening.intent(F.col("boundary")))


@query("draft_critic", f"SELECT conv_id, turn, array_to_string({sql_all(CORPUS.critic.groups, patterns=True)}, '; ') AS failures FROM {LOW.format('conversations')} WHERE role = 'assistant'")
def draft_critic(spark, d):
    return _low(spark, d, "conversations").filter("role = 'assistant'").select("conv_id", "turn", F.array_join(CORPUS.critic.all(F.col("t")), "; ").alias("failures"))


@query("denylist_guard", f"SELECT doc_id, {sql_first(CORPUS.denied.groups, '', patterns=True)} AS reason FROM {LOW.format('documents')}")
def denylist_guard(spark, d):
    return _low(spark, d).select("doc_id", CORPUS.denied.first(F.col("t")).alias("reason"))


@query("unsupported_keywords", f"SELECT conv_id, turn, {sql_any(CORPUS.gap_terms)} AS unsupported, {sql_any(('tion', 'ung'))} AS mentions FROM {LOW.format('conversations')}")
def unsupported_keywords(spark, d):
    return _low(spark, d, "conversations").select("conv_id", "turn", contains_any(F.col("t"), CORPUS.gap_terms).alias("unsupported"), contains_any(F.col("t"), ("tion", "ung")).alias("mentions"))


@query("query_lint", r"SELECT conv_id, turn, length(replace(text, '(', '')) = length(replace(text, ')', '')) AS balanced, (length(text) - length(replace(text, '""', ''))) % 2 = 0 AS even_quotes FROM conversations".replace('""', '"'))
def query_lint(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", *[c.alias(n) for n, c in screening.lint(F.col("text")).items()])
