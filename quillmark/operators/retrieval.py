"""Retrieval: BM25, vectors, reciprocal-rank fusion, decomposition, plans, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import FEW, save
from .vectors import Index, search

#: Constants of the Okapi form: saturation, length weight, share of the mean idf that replaces negative ones.
K1, B, EPSILON = 1.5, 0.75, 0.25
RRF = 60


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda t: t != "")


def bm25(docs: DataFrame, queries: DataFrame, k: int, by: str | None = None) -> DataFrame:
    """``query, rank, doc_id, score`` of the best ``k`` documents of each query.

    ``docs``: ``doc_id, text`` and, with ``by``, a group whose queries (``by``,
    ``query``, ``terms``) see its documents' statistics only. Statistics are taken
    below any ranking: a filter on ``docs`` changes them, as it should. A pass over
    the texts counts the vocabulary, another one the query terms (sent to the texts
    where they are few); only those two kinds of counts are shuffled.
    """
    g = [by] if by else []
    wanted = queries.select(*g, "query", F.explode("terms").alias("term"))
    terms = wanted.select("term").distinct()
    body = docs.select(*g, "doc_id", tokens(F.col("text")).alias("w"))
    words = body.select(*g, "doc_id", F.size("w").alias("dl"), F.explode_outer("w").alias("term"))
    # rows without a term carry the lengths of all texts
    hit = F.broadcast(terms.withColumn("_q", F.lit(True))) if terms.count() <= FEW else terms.withColumn("_q", F.lit(True))
    tf = save(words.join(hit, "term", "left").select(*g, "doc_id", "dl", F.when(F.col("_q"), F.col("term")).alias("term")).groupBy(*g, "doc_id", "dl", "term").agg(F.count(F.lit(1)).alias("tf")), "terms")
    lengths = tf.select(*g, "doc_id", "dl").distinct()
    total = lengths.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.avg(F.greatest("dl", F.lit(0))).alias("avgdl"))
    df = body.select(*g, F.explode(F.array_distinct("w")).alias("term")).groupBy(*g, "term").agg(F.count(F.lit(1)).alias("df"))
    joined = df.join(total, g) if g else df.crossJoin(F.broadcast(total))  # one row a group
    raw = joined.withColumn("idf", F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    rare = raw.groupBy(*g).agg(F.avg("idf").alias("mean_idf"))
    stats = raw.join(terms, "term")
    stats = stats.join(rare, g) if g else stats.crossJoin(F.broadcast(rare))
    stats = stats.select(*g, "term", "avgdl", F.when(F.col("idf") < 0, EPSILON * F.col("mean_idf")).otherwise(F.col("idf")).alias("idf"))
    scored = tf.filter("term IS NOT NULL").join(stats, [*g, "term"]).join(wanted, [*g, "term"])
    part = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    scores = scored.groupBy(*g, "query", "doc_id").agg(F.round(F.sum(part), 6).alias("score"))
    return top(scores, [*g, "query"], [F.desc("score"), F.col("doc_id")], k).select(*g, "query", "rank", "doc_id", "score")


def planned(docs: DataFrame, by_topic: DataFrame, reformulated: DataFrame | None, k: int, by: str) -> DataFrame:
    """``query, doc_id, origin``: candidates of each topic's search, then those that a search without a topic adds.

    ``by_topic``: queries for each value of the column ``by``, which the ranking sees
    one at a time; ``reformulated``: the same questions in other words. A candidate
    keeps the first origin.
    """
    first = bm25(docs, by_topic, k, by=by).select("query", "doc_id", F.struct(F.lit(0).alias("n"), F.concat(F.lit("topic:"), F.col(by)).alias("name")).alias("o"))
    rows = first
    if reformulated is not None:
        rows = rows.unionByName(bm25(docs.drop(by), reformulated, k).select("query", "doc_id", F.struct(F.lit(1).alias("n"), F.lit("reformulated").alias("name")).alias("o")))
    return rows.groupBy("query", "doc_id").agg(F.min("o")["name"].alias("origin"))


def top(rows: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each group with their ``rank``; Spark cuts each task's groups before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).filter(F.col("rank") <= k)


def cosine(a: Column, b: Column) -> Column:
    """Of one pair, over the shorter length; 0 where a norm is 0. Tables of vectors are searched by ``vector_top``."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x.cast("double") * y.cast("double"), F.lit(0.0))), F.lit(0.0), lambda s, v: s + v)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when((norm(a) == 0) | (norm(b) == 0), 0.0).otherwise(dot / (norm(a) * norm(b)))


def vector_top(index: Index, probes: DataFrame, k: int) -> DataFrame:
    """``probe, rank, vec_id, cos``: the true ``k`` nearest of each probe that has a direction."""
    return search(index, probes, k, exact=True).filter("status = 'ok'").drop("status")


def fuse(ranked: DataFrame, by: list[str]) -> DataFrame:
    """Reciprocal-rank fusion of ``list, rank, id`` rows: ties go to the first seen (list, then rank)."""
    out = ranked.groupBy(*by, "id").agg(F.round(F.sum(1.0 / (RRF + F.col("rank"))), 9).alias("rrf"), F.min(F.struct("list", "rank")).alias("_seen"))
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return out.withColumn("pos", F.row_number().over(w.orderBy(F.desc("rrf"), "_seen")).cast("long")).drop("_seen")


def fuse_candidates(ranked: DataFrame, by: list[str], strict: bool = False) -> DataFrame:
    """Fusion where two or more lists have rows, else the one list as it is.

    ``strict``: a vector list alone gives nothing.
    """
    ranked = save(ranked, "ranked")  # read twice, and its partitioning is not taken for granted
    lists = ranked.groupBy(*by).agg(F.count_distinct("list").alias("_n"), F.max("list").alias("_only"))
    rows = ranked.join(lists, by)
    if strict:
        rows = rows.filter(~((F.col("_n") == 1) & (F.col("_only") == "vector")))
    return fuse(rows.drop("_n", "_only"), by)


def segments(q: Column) -> Column:
    parts = F.filter(F.transform(F.split(q, r"(?i)\band\b|\bor\b|[,;]|\?"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")), lambda s: s != "")
    return F.when(F.size(parts) == 0, F.array(q)).otherwise(parts)


def topics_of(q: Column, vocabulary: list[str]) -> Column:
    """Topics of the vocabulary named in any segment, distinct, in order of first sight."""
    words = F.array(*[F.lit(t) for t in vocabulary])
    return F.array_distinct(F.flatten(F.transform(segments(F.lower(q)), lambda s: F.filter(words, lambda t: F.contains(s, F.replace(t, F.lit("_"), F.lit(" ")))))))


def plan(topics: Column) -> Column:
    """Step names; several topics add one."""
    steps = ["safety_gate", "classify", "retrieve", "verify", "analyse", "compose"]
    extra = F.when(F.size(topics) > 1, F.array(F.lit("merge_topics"))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.array(*[F.lit(s) for s in steps[:3]]), extra, F.array(*[F.lit(s) for s in steps[3:]]))
