"""Sentences, claims, chunks and excerpts over the check tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lexicon import contains_any
from ..operators import extraction as E
from .catalog import query, table
from .text_queries import COLLAPSE, sql_any

SPLIT = r"string_split(regexp_replace(" + COLLAPSE.format("{0}") + r", '([.!?])\s+([A-Z0-9(])', '\1' || chr(1) || '\2', 'g'), chr(1))"
SENTENCES = f"list_filter({SPLIT.format('text')}, lambda x: length(x) >= 40)"
RESULT, TOPIC, METHOD = ("ation", "chung"), ("tion ",), ("whe", "querl")


@query("sentence_split", f"WITH d AS (SELECT doc_id, {SENTENCES} AS s FROM documents) SELECT doc_id, unnest(range(len(s)))::INT AS sentence_no, unnest(s) AS sentence FROM d")
def sentence_split(spark, d):
    return E.sentence_rows(table(spark, d, "documents"))


@query("best_sentences", f"""WITH d AS (SELECT doc_id, {SENTENCES} AS l FROM documents), x AS (SELECT doc_id, unnest(range(len(l)))::INT AS sentence_no, lower(unnest(l)) AS t FROM d),
y AS (SELECT doc_id, sentence_no, CASE WHEN {sql_any(RESULT)} THEN 5 ELSE 0 END + CASE WHEN {sql_any(TOPIC)} THEN 3 ELSE 0 END - CASE WHEN {sql_any(METHOD)} THEN 5 ELSE 0 END AS score FROM x)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, sentence_no) AS rank, sentence_no, score FROM y QUALIFY rank <= 4""")
def best_sentences(spark, d):
    return E.best_sentences(table(spark, d, "documents"), lambda s: E.sentence_score(s, RESULT, TOPIC, METHOD), 4)


@query("candidate_extraction", f"""WITH d AS (SELECT doc_id, {SENTENCES} AS l FROM documents), x AS (SELECT doc_id, unnest(range(len(l)))::INT AS sentence_no, unnest(l) AS sentence FROM d),
y AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sentence_no) AS n FROM (SELECT *, lower(sentence) AS t FROM x) WHERE {sql_any(RESULT)}) SELECT doc_id, sentence_no, sentence FROM y WHERE n <= 4""")
def candidate_extraction(spark, d):
    return E.extract_candidates(table(spark, d, "documents"), lambda s: contains_any(s, RESULT), 4)


@query("id_allocation", "SELECT doc_id, 'SRC-' || CASE WHEN n < 1000 THEN lpad(n::VARCHAR, 3, '0') ELSE n::VARCHAR END AS code FROM (SELECT doc_id, 41 + row_number() OVER (ORDER BY doc_id) AS n FROM documents)")
def id_allocation(spark, d):
    return E.allocate_ids(table(spark, d, "documents"), "SRC-", 41)


@query("chunk_overlap", f"""WITH RECURSIVE d AS (SELECT doc_id, list_filter({SPLIT.format('text')}, lambda x: length(x) >= 1) AS l FROM documents), s AS (SELECT doc_id, unnest(range(len(l))) AS i, string_split(unnest(l), ' ') AS w FROM d),
q AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n, w FROM s WHERE len(w) <= 900),
f AS (SELECT doc_id, 0::BIGINT AS n, []::VARCHAR[] AS now, 0::BIGINT AS fresh, NULL::VARCHAR[] AS done, 0 AS c FROM d UNION ALL
SELECT q.doc_id, q.n, CASE WHEN full_ THEN list_concat(f.now[-100:], q.w) ELSE list_concat(f.now, q.w) END, CASE WHEN full_ THEN 0 ELSE f.fresh END + len(q.w), CASE WHEN full_ THEN f.now END, f.c + full_::INT FROM f JOIN q ON q.doc_id = f.doc_id AND q.n = f.n + 1, LATERAL (SELECT f.fresh > 0 AND len(f.now) + len(q.w) > 600 AS full_) x),
o AS (SELECT doc_id, c AS chunk_no, done AS w FROM f WHERE done IS NOT NULL UNION ALL SELECT doc_id, c + 1, now FROM f WHERE fresh > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC) = 1)
SELECT doc_id, chunk_no, len(w)::INT AS n_words, md5(array_to_string(w, ' ')) AS digest FROM o WHERE chunk_no <= 60""")
def chunk_overlap(spark, d):
    return E.chunk(table(spark, d, "documents")).select("doc_id", "chunk_no", "n_words", F.md5(F.col("text").cast("binary")).alias("digest"))


HITS = f"i AS (SELECT item_id, {COLLAPSE.format('text')} AS e FROM benchmark), t AS (SELECT doc_id, {COLLAPSE.format('text')} AS t, text FROM documents), h AS (SELECT item_id, doc_id, e, text FROM i JOIN t ON contains(t, e))"


@query("verbatim_containment", f"WITH {HITS} SELECT item_id, doc_id FROM h")
def verbatim_containment(spark, d):
    return E.contained(table(spark, d, "benchmark"), table(spark, d, "documents"))


@query("sentence_locator", f"""WITH {HITS}, s AS (SELECT item_id, doc_id, e, list_filter({SPLIT.format('text')}, lambda x: length(x) >= 1) AS l FROM h), x AS (SELECT item_id, doc_id, e, unnest(range(len(l)))::INT AS i, unnest(l) AS s FROM s),
y AS (SELECT *, CASE WHEN contains(s, e) OR contains(e, s) THEN 1000000 ELSE len(list_intersect(list_distinct(string_split_regex(lower(s), '[^\\pL\\pN_]+')), list_distinct(string_split_regex(lower(e), '[^\\pL\\pN_]+')))) END AS v FROM x)
SELECT item_id, doc_id, arg_min(i, {{'m': -v, 'i': i}}) AS sentence_no FROM y GROUP BY ALL""")
def sentence_locator(spark, d):
    items, docs = table(spark, d, "benchmark"), table(spark, d, "documents")
    return E.locate(E.contained(items, docs), items, docs)
