"""Ranking, fusion, decomposition and gaps over the check tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lexicon import CORPUS
from ..operators import retrieval as R
from ..operators import vectors as V
from ..operators.word_index import WordIndex
from .catalog import query, table

TERMS = {"q1": ("the", "ndtion", "estion", "esing"), "q2": ("and", "ation", "thing")}
TOPIC_TERMS = {"en": TERMS["q1"], "fr": ("de", "eaux", "mentre"), "de": ("und", "chung", "lich"), "es": ("el", "ciónte", "mente")}
VOCABULARY = ["aion", "lich", "ment", "the_", "tion"]


def _bm25_sql(groups: dict, k: int, by_lang: bool) -> str:
    g = "lang, " if by_lang else ""
    wanted = ", ".join(f"('{q}', '{t}')" if not by_lang else f"('{q}', '{q}', '{t}')" for q, ts in groups.items() for t in ts)
    cols = "lang, query, term" if by_lang else "query, term"
    on = lambda a, b: f"{a}.lang = {b}.lang AND " if by_lang else ""
    grp = "GROUP BY lang" if by_lang else ""
    src = "documents" if by_lang else "documents WHERE lang = 'en'"
    return f"""WITH w({cols}) AS (VALUES {wanted}), b AS (SELECT lang, doc_id, list_filter(string_split_regex(lower(text), '[^\\pL\\pN_]+'), lambda t: t <> '') AS w FROM {src}),
s AS (SELECT {g}count(*) AS n, avg(len(w)) AS avgdl FROM b {grp}), t AS (SELECT {g}doc_id, len(w) AS dl, unnest(w) AS term FROM b),
tf AS (SELECT {g}doc_id, dl, term, count(*) AS tf FROM t GROUP BY ALL), df AS (SELECT {g}term, count(*) AS df FROM tf GROUP BY ALL),
i AS (SELECT df.*, avgdl, ln((n - df + 0.5) / (df + 0.5)) AS idf FROM df JOIN s ON {on('df', 's')} true), m AS (SELECT {g}avg(idf) AS mean FROM i {grp}),
x AS (SELECT {'tf.lang, ' if by_lang else ''}query, tf.doc_id, round(sum(CASE WHEN idf < 0 THEN 0.25 * mean ELSE idf END * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
 FROM tf JOIN w ON {on('tf', 'w')} tf.term = w.term JOIN i ON {on('tf', 'i')} tf.term = i.term JOIN m ON {on('tf', 'm')} true GROUP BY ALL)
SELECT {g}query, row_number() OVER (PARTITION BY {g}query ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM x QUALIFY rank <= {k}"""


def _queries(spark, groups: dict, by_lang: bool = False):
    rows = [f"struct('{q}' AS query, array({', '.join(repr(t) for t in ts)}) AS terms{f', {q!r} AS lang' if by_lang else ''})" for q, ts in groups.items()]
    return spark.sql(f"SELECT inline(array({', '.join(rows)}))")


@query("hybrid_search", _bm25_sql(TERMS, 10, False))
def hybrid_search(spark, d):
    docs = table(spark, d, "documents").filter("lang = 'en'").select("doc_id", "text")
    return R.bm25(docs, _queries(spark, TERMS), 10)


@query("bm25_per_topic", _bm25_sql(TOPIC_TERMS, 5, True))
def bm25_per_topic(spark, d):
    return R.bm25(table(spark, d, "documents").select("lang", "doc_id", "text"), _queries(spark, TOPIC_TERMS, True), 5, by="lang")


#: One question planned for three topics, and in other words.
PLANNED, AGAIN = {k: ("the", "de", "und", "eaux") for k in ("en", "fr", "de")}, {"plan": ("ation", "chung", "mente", "the")}


@query("planned_retrieval", f"""WITH a AS ({_bm25_sql(PLANNED, 6, True)}), b AS ({_bm25_sql(AGAIN, 6, False).replace("documents WHERE lang = 'en'", 'documents')}), u AS (SELECT doc_id, 0 AS n, 'topic:' || lang AS origin FROM a UNION ALL SELECT doc_id, 1, 'reformulated' FROM b)
SELECT 'plan' AS query, doc_id, arg_min(origin, n) AS origin FROM u GROUP BY doc_id""")
def planned_retrieval(spark, d):
    asked = _queries(spark, PLANNED, True).withColumn("query", F.lit("plan"))
    return R.planned(table(spark, d, "documents").select("lang", "doc_id", "text"), asked, _queries(spark, AGAIN), 6, "lang")


@query("browse_by_topic", "SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rank FROM documents QUALIFY rank <= 10")
def browse_by_topic(spark, d):
    return R.top(table(spark, d, "documents").select("lang", "doc_id"), ["lang"], [F.col("doc_id")], 10)


@query("vector_topk", "WITH p AS (SELECT vec_id AS probe, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id % 20 = 0), x AS (SELECT probe, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 6) AS cos FROM embeddings, p) SELECT probe, row_number() OVER (PARTITION BY probe ORDER BY cos DESC, vec_id) AS rank, vec_id, cos FROM x QUALIFY rank <= 5")
def vector_topk(spark, d):
    vectors = table(spark, d, "embeddings")
    return R.vector_top(V.build(vectors), vectors.filter("vec_id % 20 = 0"), 5)


@query("vector_index_topk")
def vector_index_topk(spark, d):
    """By visited lists only; a test measures the recall."""
    vectors = table(spark, d, "embeddings")
    return V.search(V.build(vectors), vectors.filter("vec_id % 20 = 0"), 10)


RANKED_SQL = """p AS (SELECT vec_id AS probe, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id % 20 = 0), x AS (SELECT probe, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 6) AS cos FROM embeddings, p),
r AS (SELECT probe // 40 AS pair, CASE probe % 40 WHEN 0 THEN 'bm25' ELSE 'vector' END AS list, vec_id AS id, row_number() OVER (PARTITION BY probe ORDER BY cos DESC, vec_id) AS rank FROM x QUALIFY rank <= 30)"""


def _ranked(spark, d):
    """Neighbouring probes in pairs; the list of the first stands for a word ranking."""
    vectors = table(spark, d, "embeddings")
    ranked = R.vector_top(V.build(vectors), vectors.filter("vec_id % 20 = 0"), 30)
    return ranked.select(F.floor(F.col("probe") / 40).alias("pair"), F.when(F.col("probe") % 40 == 0, "bm25").otherwise("vector").alias("list"), F.col("vec_id").alias("id"), "rank")


@query("rrf_fusion", f"WITH {RANKED_SQL}, f AS (SELECT pair, id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS rrf, min({{'l': list, 'r': rank}}) AS seen FROM r GROUP BY ALL) SELECT pair, id, rrf, row_number() OVER (PARTITION BY pair ORDER BY rrf DESC, seen) AS pos FROM f")
def rrf_fusion(spark, d):
    return R.fuse(_ranked(spark, d), ["pair"])


@query("fuse_candidates_edge", f"""WITH {RANKED_SQL}, c AS (SELECT 'both' AS kind, * FROM r UNION ALL SELECT 'vector only', * FROM r WHERE list = 'vector' UNION ALL SELECT 'words only', * FROM r WHERE list = 'bm25'),
f AS (SELECT pair, kind, id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS rrf, min({{'l': list, 'r': rank}}) AS seen FROM c GROUP BY ALL), w AS (SELECT pair, kind FROM c GROUP BY ALL HAVING min(list) = 'vector'), g AS (SELECT 'lenient' AS mode, * FROM f UNION ALL SELECT 'strict', * FROM f ANTI JOIN w USING (pair, kind))
SELECT mode, pair, kind, id, rrf, row_number() OVER (PARTITION BY mode, pair, kind ORDER BY rrf DESC, seen) AS pos FROM g""")
def fuse_candidates_edge(spark, d):
    r = _ranked(spark, d)
    cases = r.withColumn("kind", F.explode(F.array(F.lit("both"), F.when(F.col("list") == "vector", "vector only").otherwise("words only"))))
    lenient, strict = (R.fuse_candidates(cases, ["pair", "kind"], s).withColumn("mode", F.lit(m)) for m, s in (("lenient", False), ("strict", True)))
    return lenient.unionByName(strict).select("mode", "pair", "kind", "id", "rrf", "pos")


PROBES_SQL = """v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), p AS (SELECT vec_id AS probe, label, e FROM v WHERE vec_id % 20 = 0),
o AS (SELECT probe, min(vec_id) AS other FROM p JOIN v ON v.label = p.label AND vec_id <> probe GROUP BY probe), q AS (SELECT probe, 'vector' AS list, e AS q FROM p UNION ALL SELECT probe, 'topic', e FROM o JOIN v ON vec_id = other),
x AS (SELECT probe, list, vec_id AS id, round(list_cosine_similarity(e, q), 6) AS cos FROM v, q), r AS (SELECT probe, list, id, row_number() OVER (PARTITION BY probe, list ORDER BY cos DESC, id) AS rank FROM x QUALIFY rank <= 30)"""


def _ranked_probes(spark, d):
    """``probe, list, id, rank``: every 20th vector ranks by itself and by the first other vector of its topic."""
    vectors = table(spark, d, "embeddings")
    probes = vectors.filter("vec_id % 20 = 0")
    first = R.top(vectors.select("label", "vec_id"), ["label"], [F.col("vec_id")], 2).select("label", F.col("vec_id").alias("other"))
    topic = probes.select("label", F.col("vec_id").alias("for")).join(first, "label").filter("other <> for").groupBy("for").agg(F.min("other").alias("probe"))
    others = vectors.join(topic.select(F.col("probe").alias("vec_id")).distinct(), "vec_id", "left_semi")
    index = V.build(vectors)
    own = R.vector_top(index, probes, 30).select("probe", F.lit("vector").alias("list"), F.col("vec_id").alias("id"), "rank")
    second = R.vector_top(index, others, 30).join(topic, "probe").select(F.col("for").alias("probe"), F.lit("topic").alias("list"), F.col("vec_id").alias("id"), "rank")
    return own.unionByName(second)


@query("rrf_fusion_probes", f"WITH {PROBES_SQL}, f AS (SELECT probe, id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS rrf, min({{'l': list, 'r': rank}}) AS seen FROM r GROUP BY ALL) SELECT probe, id, rrf, row_number() OVER (PARTITION BY probe ORDER BY rrf DESC, seen) AS pos FROM f")
def rrf_fusion_probes(spark, d):
    return R.fuse(_ranked_probes(spark, d), ["probe"])


@query("fuse_candidates_probes", f"""WITH {PROBES_SQL}, c AS (SELECT 'both' AS kind, * FROM r UNION ALL SELECT list || ' only', * FROM r),
f AS (SELECT probe, kind, id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS rrf, min({{'l': list, 'r': rank}}) AS seen FROM c GROUP BY ALL), s AS (SELECT probe, kind FROM c GROUP BY ALL HAVING min(list) = 'vector'),
g AS (SELECT 'lenient' AS mode, * FROM f UNION ALL SELECT 'strict', * FROM f ANTI JOIN s USING (probe, kind))
SELECT mode, probe, kind, id, rrf, row_number() OVER (PARTITION BY mode, probe, kind ORDER BY rrf DESC, seen) AS pos FROM g""")
def fuse_candidates_probes(spark, d):
    cases = _ranked_probes(spark, d).withColumn("kind", F.explode(F.array(F.lit("both"), F.concat("list", F.lit(" only")))))
    lenient, strict = (R.fuse_candidates(cases, ["probe", "kind"], s).withColumn("mode", F.lit(m)) for m, s in (("lenient", False), ("strict", True)))
    return lenient.unionByName(strict).select("mode", "probe", "kind", "id", "rrf", "pos")


def _indexed(spark, d):
    """All documents in two appends, with their language to filter on."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    index = WordIndex(spark)
    early = F.coalesce(F.col("lang") < "es", F.lit(False))
    index.append(docs.filter(early), by="lang")
    index.append(docs.filter(~early), by="lang")
    return index


@query("word_index_search", f"""WITH a AS ({_bm25_sql(TERMS, 10, False).replace("documents WHERE lang = 'en'", 'documents')}), b AS ({_bm25_sql(TOPIC_TERMS, 5, True)})
SELECT '' AS lang, * FROM a UNION ALL SELECT lang, query, rank, doc_id, score FROM b""")
def word_index_search(spark, d):
    index = _indexed(spark, d)
    every = index.search(_queries(spark, TERMS), 10).select(F.lit("").alias("lang"), "query", "rank", "doc_id", "score")
    return every.unionByName(index.search(_queries(spark, TOPIC_TERMS, True).withColumnRenamed("lang", "grp"), 5, by=True).withColumn("lang", F.col("query")))


#: Words of a question: the rarest ones of the probe's document that another document has as well.
QUESTION_WORDS = 3


@query("hybrid_fusion", f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), p AS (SELECT vec_id AS probe, e AS q FROM v WHERE vec_id % 20 = 0),
b AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\pL\\pN_]+'), lambda t: t <> '') AS w FROM documents), s AS (SELECT count(*) AS n, avg(len(w)) AS avgdl FROM b),
tf AS (SELECT doc_id, dl, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS dl, unnest(w) AS term FROM b) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
i AS (SELECT term, df, avgdl, ln((n - df + 0.5) / (df + 0.5)) AS idf FROM df, s), m AS (SELECT avg(idf) AS mean FROM i),
asked AS (SELECT probe, term FROM p JOIN tf ON tf.doc_id = probe JOIN df USING (term) WHERE df > 1 QUALIFY row_number() OVER (PARTITION BY probe ORDER BY df, term) <= {QUESTION_WORDS}),
x AS (SELECT probe, doc_id AS id, round(sum(CASE WHEN idf < 0 THEN 0.25 * mean ELSE idf END * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM asked JOIN tf USING (term) JOIN i USING (term), m GROUP BY ALL),
y AS (SELECT probe, vec_id AS id, round(list_cosine_similarity(e, q), 6) AS score FROM v, p),
z AS (SELECT probe, doc_id AS id, 0.0 AS score FROM (SELECT DISTINCT probe, doc_id FROM asked, (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 60)) AS u ANTI JOIN x ON x.probe = u.probe AND x.id = u.doc_id),
r AS (SELECT 'words' AS list, probe, id, row_number() OVER (PARTITION BY probe ORDER BY score DESC, id) AS rank FROM (SELECT * FROM x UNION ALL SELECT * FROM z) QUALIFY rank <= 30 UNION ALL SELECT 'vector', probe, id, row_number() OVER (PARTITION BY probe ORDER BY score DESC, id) AS rank FROM y QUALIFY rank <= 30),
f AS (SELECT probe, id, count(*) AS lists, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS rrf, min({{'l': CASE list WHEN 'words' THEN 0 ELSE 1 END, 'r': rank}}) AS seen FROM r GROUP BY ALL)
SELECT probe, id, rrf, row_number() OVER (PARTITION BY probe ORDER BY rrf DESC, seen) AS pos FROM f""")
def hybrid_fusion(spark, d):
    """One question, two rankings: every 20th vector, and the rarest shared words of the document with its number."""
    vectors = table(spark, d, "embeddings")
    probes = vectors.filter("vec_id % 20 = 0")
    index = _indexed(spark, d)
    df = index.vocabulary().groupBy("term").agg(F.sum("df").alias("df")).filter("df > 1")
    words = table(spark, d, "documents").join(probes.select(F.col("vec_id").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("query"), F.explode(F.array_distinct(R.tokens(F.col("text")))).alias("term"))
    rare = R.top(words.join(df, "term"), ["query"], [F.col("df"), F.col("term")], QUESTION_WORDS)
    by_words = index.search(rare.groupBy("query").agg(F.collect_list("term").alias("terms")), 30).select(F.col("query").alias("probe"), F.lit(0).alias("list"), F.col("doc_id").alias("id"), "rank")
    by_vector = R.vector_top(V.build(vectors), probes, 30).select("probe", F.lit(1).alias("list"), F.col("vec_id").alias("id"), "rank")
    return R.fuse_candidates(by_words.unionByName(by_vector), ["probe"])


SEGMENTS = r"list_filter(list_transform(string_split_regex({0}, '(?i)\band\b|\bor\b|[,;]|\?'), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"


@query("query_decompose", f"WITH q AS (SELECT conv_id, turn, CASE WHEN len({SEGMENTS.format('text')}) = 0 THEN [text] ELSE {SEGMENTS.format('text')} END AS s FROM conversations WHERE role = 'user') SELECT conv_id, turn, unnest(range(len(s)))::INT AS seg_no, unnest(s) AS segment FROM q")
def query_decompose(spark, d):
    return table(spark, d, "conversations").filter("role = 'user'").select("conv_id", "turn", F.posexplode(R.segments(F.col("text"))).alias("seg_no", "segment"))


TOPICS_SQL = f"""q AS (SELECT conv_id, turn, CASE WHEN len({SEGMENTS.format('lower(text)')}) = 0 THEN [lower(text)] ELSE {SEGMENTS.format('lower(text)')} END AS s FROM conversations WHERE role = 'user'),
z AS (SELECT conv_id, turn, flatten(list_transform(s, lambda x: list_filter({VOCABULARY}, lambda t: contains(x, replace(t, '_', ' '))))) AS l FROM q),
y AS (SELECT conv_id, turn, list_filter(l, lambda x, i: list_position(l, x) = i) AS topics FROM z)"""


@query("topic_identify", f"WITH {TOPICS_SQL} SELECT conv_id, turn, array_to_string(topics, '; ') AS topics FROM y")
def topic_identify(spark, d):
    return table(spark, d, "conversations").filter("role = 'user'").select("conv_id", "turn", F.array_join(R.topics_of(F.col("text"), VOCABULARY), "; ").alias("topics"))


@query("query_plan_steps", f"WITH {TOPICS_SQL} SELECT conv_id, turn, 6 + (len(topics) > 1)::INT AS n_steps, 'safety_gate,classify,retrieve,' || CASE WHEN len(topics) > 1 THEN 'merge_topics,' ELSE '' END || 'verify,analyse,compose' AS steps FROM y")
def query_plan_steps(spark, d):
    steps = table(spark, d, "conversations").filter("role = 'user'").select("conv_id", "turn", R.plan(R.topics_of(F.col("text"), VOCABULARY)).alias("s"))
    return steps.select("conv_id", "turn", F.size("s").alias("n_steps"), F.array_join("s", ",").alias("steps"))


@query("evidence_gaps", f"SELECT source AS topic FROM documents EXCEPT SELECT source FROM documents JOIN labels USING (doc_id) WHERE quality = 0 AND toxic = 0 UNION SELECT unnest({list(CORPUS.gap_terms)})")
def evidence_gaps(spark, d):
    every = table(spark, d, "documents").select(F.col("source").alias("topic")).distinct()
    eligible = table(spark, d, "documents").join(table(spark, d, "labels").filter("quality = 0 AND toxic = 0"), "doc_id").select("source").distinct()
    return every.subtract(eligible).unionByName(spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in CORPUS.gap_terms])).alias("topic"))).distinct()


@query("topic_vocabulary", "SELECT lang, array_to_string(list_sort(list(DISTINCT source)), ',') AS topics FROM documents WHERE source <> '' GROUP BY lang")
def topic_vocabulary(spark, d):
    return table(spark, d, "documents").filter("source <> ''").groupBy("lang").agg(F.array_join(F.sort_array(F.collect_set("source")), ",").alias("topics"))
