"""Sentences, claims, chunks, identifiers and excerpts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .storage import running, small

#: Words of a chunk: aimed at, at most, and carried over; a sentence above the most is skipped.
TARGET, MOST, OVERLAP, CHUNKS = 600, 900, 100, 60


def sentence_rows(docs: DataFrame, least: int = 40, most: int | None = None) -> DataFrame:
    """``doc_id, sentence_no, sentence`` (from 0)."""
    return docs.select("doc_id", F.posexplode(X.sentences(F.col("text"), least, most)).alias("sentence_no", "sentence"))


def sentence_score(s: Column, plus: tuple[str, ...], topic: tuple[str, ...], minus: tuple[str, ...]) -> Column:
    s = F.lower(s)
    hit = lambda words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(s, w))
    return F.when(hit(plus), 5).otherwise(0) + F.when(hit(topic), 3).otherwise(0) - F.when(hit(minus), 5).otherwise(0)


def best_sentences(docs: DataFrame, score, n: int) -> DataFrame:
    """The best ``n`` sentences of each document: score, then place. Stays within the row."""
    scored = F.transform(X.sentences(F.col("text")), lambda s, i: F.struct((-score(s)).alias("m"), i.alias("sentence_no"), s.alias("sentence")))
    best = docs.select("doc_id", F.posexplode(F.slice(F.sort_array(scored), 1, n)).alias("rank", "b"))
    return best.select("doc_id", (F.col("rank") + 1).cast("long").alias("rank"), F.col("b.sentence_no").alias("sentence_no"), (-F.col("b.m")).alias("score"))


def extract_candidates(docs: DataFrame, keyword, per_source: int) -> DataFrame:
    """Keyword sentences that occur verbatim in the collapsed text, the first ``per_source`` of each document."""
    found = F.filter(F.transform(X.sentences(F.col("text")), lambda s, i: F.struct(i.alias("n"), s.alias("s"))), lambda x: keyword(F.lower(x["s"])))
    rows = docs.select("doc_id", F.explode(F.slice(found, 1, per_source)).alias("x"))
    return rows.select("doc_id", F.col("x.n").alias("sentence_no"), F.col("x.s").alias("sentence"))


def allocate_ids(records: DataFrame, prefix: str, start: int) -> DataFrame:
    """``doc_id, code``: consecutive numbers in order of ``doc_id`` after ``start``."""
    n = F.col("n") + start
    code = F.concat(F.lit(prefix), F.when(n < 1000, F.lpad(n.cast("string"), 3, "0")).otherwise(n.cast("string")))
    return running(records.select("doc_id"), {"n": F.lit(1)}, "doc_id").select("doc_id", code.alias("code"))


def chunk(docs: DataFrame, target: int = TARGET, most: int = MOST, overlap: int = OVERLAP, chunks: int = CHUNKS) -> DataFrame:
    """``doc_id, chunk_no, n_words, text``: sentences packed to about ``target`` words, the last ``overlap`` words carried over.

    A fold along each text whose state is one chunk; done a batch at a time in Arrow.
    """

    def pack(sentences: list[str]) -> Iterator[list[str]]:
        now: list[str] = []
        fresh = 0
        for s in sentences:
            w = s.split(" ")
            if len(w) > most:
                continue
            if fresh and len(now) + len(w) > target:
                yield now
                now, fresh = (now[-overlap:] if overlap else []), 0
            now = now + w
            fresh += len(w)
        if fresh:
            yield now

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, sentences in zip(batch.column("doc_id").to_pylist(), batch.column("s").to_pylist(), strict=True):
                for i, words in enumerate(pack(sentences or [])):
                    if i >= chunks:
                        break
                    out.append((doc, i + 1, len(words), " ".join(words)))
            yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.string()))], ["doc_id", "chunk_no", "n_words", "text"])

    return docs.select("doc_id", X.sentences(F.col("text"), 1).alias("s")).mapInArrow(run, "doc_id long, chunk_no int, n_words int, text string")


def contained(excerpts: DataFrame, docs: DataFrame, gram: int = 8) -> DataFrame:
    """``item_id, doc_id`` where the collapsed excerpt occurs in the collapsed text.

    Blocked by n-grams of words: the excerpt's first full n-gram must be one of
    the text's. Texts meet an excerpt by that key only: few keys (counted) are sent to
    the texts, so that no n-gram is shuffled. Shorter excerpts are compared with all
    texts, being the stated query set.
    """
    items = excerpts.select("item_id", X.collapse(F.col("text")).alias("e")).withColumn("w", F.split("e", " "))
    body = docs.select("doc_id", X.collapse(F.col("text")).alias("t"))
    # inner words of an excerpt are whole words of the text; its first and last may be cut
    keyed = items.filter(F.size("w") >= gram + 2).select("item_id", "e", F.xxhash64(F.slice("w", 2, gram)).alias("k"))
    grams = body.withColumn("w", F.split("t", " ")).filter(F.size("w") >= gram).select("doc_id", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - gram + 1), lambda i: F.xxhash64(F.slice("w", i, gram))))).alias("k"))
    met = grams.join(small(keyed.select("item_id", "k")), "k").select("item_id", "doc_id").distinct()
    sure = met.join(small(keyed.select("item_id", "e")), "item_id").join(body, "doc_id").filter(F.contains("t", F.col("e"))).select("item_id", "doc_id")
    short = items.filter((F.size("w") < gram + 2) & (F.col("e") != "")).select("item_id", "e")
    return sure.unionByName(body.join(small(short), F.contains("t", F.col("e"))).select("item_id", "doc_id"))


def locate(hits: DataFrame, excerpts: DataFrame, docs: DataFrame) -> DataFrame:
    """``item_id, doc_id, sentence_no``: the first sentence that equals, holds or is held by the excerpt, else the one that shares most words."""
    rows = hits.join(excerpts.select("item_id", X.collapse(F.col("text")).alias("e")), "item_id").join(docs.select("doc_id", X.sentences(F.col("text"), 1).alias("s")), "doc_id")
    words = lambda x: F.array_distinct(F.split(F.lower(x), r"[^\p{L}\p{N}_]+"))
    scored = F.transform("s", lambda s, i: F.struct((-F.when(F.contains(s, F.col("e")) | F.contains(F.col("e"), s), 1_000_000).otherwise(F.size(F.array_intersect(words(s), words(F.col("e")))))).alias("m"), i.alias("i")))
    return rows.select("item_id", "doc_id", F.array_min(scored)["i"].alias("sentence_no"))
