"""A stored BM25 index: postings by term in blocks of document numbers, appended batch by batch.

A block holds the postings of one term (and filter value) for ``RANGE`` neighbouring
document numbers, with its highest count and shortest length; the blocks of the empty
term list all documents. Blocks lie in ``BUCKETS`` folders by term, so a search reads the
folders of its terms only, and a common term is many blocks. Words are counted inside
their text, so an append shuffles its postings once and no text. It writes the blocks of
new documents, and a new
vocabulary (document counts by term and filter value), a histogram of these counts
and totals; the number of the append is then noted as good. What a crash leaves
behind is not noted, and the next append overwrites it.

A search bounds each cell (filter value and range of documents) by the sum of the
best that its blocks could give, scores the ``k`` highest-bounded cells of each query,
and after that only cells whose bound reaches the ``k``-th score so far: block-maximum
skipping, with the same result as scoring everything.

Defined results: scores are those of ``retrieval.bm25`` over all documents appended so
far (or those of the query's filter value); a document without any of the terms has
score 0 and fills the list up to ``k`` by number; a null text has no words; a
``doc_id`` that is null is not indexed, and one that is indexed already, or comes
again in a batch, is left out.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .retrieval import EPSILON, K1, B, tokens, top
from .storage import free, save, shared_folder, small

RANGE, BUCKETS = 1024, 16
DIGITS = 6
#: Columns of the tables in the folder; an append without a word has no file to tell them.
TABLES = {
    "postings": "grp string, term string, rng bigint, max_tf bigint, min_dl bigint, places array<bigint>, lengths array<bigint>, bucket int",
    "vocabulary": "grp string, term string, df bigint", "totals": "grp string, n bigint, words bigint", "histogram": "grp string, df bigint, terms bigint",
}


class WordIndex:
    """The index in ``folder`` (by default a new one in the shared folder)."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_folder(spark)}/words-{uuid.uuid4().hex}"

    def _good(self) -> list[int]:
        try:
            return sorted(r["version"] for r in self.spark.read.schema("version long").json(f"{self.folder}/good").collect())  # a row an append
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return []
            raise

    def _read(self, part: str, versions: list[int]) -> DataFrame:
        return self.spark.read.schema(f"{TABLES[part]}, version int").option("basePath", f"{self.folder}/{part}").parquet(*[f"{self.folder}/{part}/version={v}" for v in versions])

    def append(self, docs: DataFrame, by: str | None = None) -> None:
        """Adds ``doc_id, text`` and, with ``by``, the value that searches may filter on."""
        good = self._good()
        version = max(good, default=0) + 1
        grp = F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), grp.alias("grp"), F.coalesce("text", F.lit("")).alias("text")).filter("doc_id IS NOT NULL")
        many, ids = rows.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
        rows = rows if many == ids else rows.dropDuplicates(["doc_id"])
        if good:
            again = save(rows.select("doc_id").join(self._lengths(good).select("doc_id"), "doc_id", "left_semi"), "again")  # numbers only
            rows = rows if again.isEmpty() else rows.join(small(again), "doc_id", "left_anti")
        # at most RANGE documents a group; a posting is its place in the range and its count in one number, and its length
        place = F.pmod("doc_id", F.lit(RANGE)) + F.col("tf") * RANGE
        blocks = _counted(rows).withColumn("rng", F.floor(F.col("doc_id") / RANGE).cast("long")).groupBy("grp", "term", "rng")
        blocks = blocks.agg(F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl"), F.collect_list(place).alias("places"), F.collect_list("dl").alias("lengths"))
        # each task writes its blocks to the folders of their terms: the grouping's shuffle is the only one
        blocks = blocks.withColumn("bucket", _bucket(F.col("term"))).sortWithinPartitions("bucket", "term", "rng")
        blocks.write.mode("overwrite").partitionBy("bucket").option("compression", "zstd").parquet(f"{self.folder}/postings/version={version}")
        del blocks
        free(self.spark)
        put = lambda df, part: df.write.mode("overwrite").parquet(f"{self.folder}/{part}/version={version}")
        found = self._read("postings", [version]).filter("term <> ''")
        counts = found.groupBy("grp", "term").agg(F.sum(F.size("places").cast("long")).alias("df"))
        lengths = self._lengths([version]).groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("dl").alias("words"))
        if good:
            counts = counts.unionByName(self._read("vocabulary", good[-1:]).select("grp", "term", "df")).groupBy("grp", "term").agg(F.sum("df").alias("df"))
            lengths = lengths.unionByName(self._read("totals", good[-1:]).select("grp", "n", "words")).groupBy("grp").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
        put(counts.repartition("term").sortWithinPartitions("term"), "vocabulary")
        put(lengths, "totals")
        every = self._read("vocabulary", [version])
        whole = every.groupBy("term").agg(F.sum("df").alias("df")).groupBy("df").agg(F.count(F.lit(1)).alias("terms")).withColumn("grp", F.lit(None).cast("string"))
        put(every.groupBy("grp", "df").agg(F.count(F.lit(1)).alias("terms")).unionByName(whole), "histogram")
        self.spark.range(1).select(F.lit(version).cast("long").alias("version")).coalesce(1).write.mode("append").json(f"{self.folder}/good")

    def _lengths(self, versions: list[int]) -> DataFrame:
        """``grp, doc_id, dl`` of all documents."""
        return _opened(self._read("postings", versions).filter((F.col("bucket") == _bucket(F.lit(""))) & (F.col("term") == "")), "grp").select("grp", "doc_id", "dl")

    def vocabulary(self) -> DataFrame:
        """``grp, term, df``: in how many documents of each filter value a term is."""
        return self._read("vocabulary", self._good()[-1:]).select("grp", "term", "df")

    def search(self, queries: DataFrame, k: int, by: bool = False) -> DataFrame:
        """``query, rank, doc_id, score`` of the best ``k`` documents for ``query, terms`` rows.

        With ``by``, each query has a value ``grp`` and sees documents and statistics of that value only.
        """
        good = self._good()
        if not good:
            raise FileNotFoundError(f"nothing is indexed in {self.folder}")
        asked = queries.select("query", (F.col("grp") if by else F.lit("")).alias("scope"), "terms")
        wanted = save(asked.select("query", "scope", F.explode("terms").alias("term")).groupBy("query", "scope", "term").agg(F.count(F.lit(1)).alias("times")), "wanted")
        weights = save(self._weights(wanted, good, by), "weights")
        blocks = self._blocks(weights, good, by)

        gain = lambda tf, dl: F.col("weight") * tf / (tf + K1 * (1 - B + B * dl / F.col("avgdl")))
        cells = save(blocks.groupBy("query", "grp", "rng").agg(F.sum(F.greatest(F.lit(0.0), gain(F.col("max_tf"), F.col("min_dl")))).alias("bound")), "cells")

        def scored(some: DataFrame) -> DataFrame:
            hits = _opened(blocks.join(small(some), ["query", "grp", "rng"]), "query", "weight", "avgdl")
            return hits.groupBy("query", "doc_id").agg(F.round(F.sum(gain(F.col("tf"), F.col("dl"))), DIGITS).alias("score"))

        first = save(top(cells, ["query"], [F.desc("bound"), F.col("grp"), F.col("rng")], k).select("query", "grp", "rng"), "first")
        found = save(scored(first), "scored")
        last = top(found, ["query"], [F.desc("score"), F.col("doc_id")], k).filter(f"rank = {k} AND score > 0").select("query", F.col("score").alias("last"))
        rest = cells.join(first, ["query", "grp", "rng"], "left_anti").join(last, "query", "left").filter(F.col("last").isNull() | (F.col("bound") >= F.col("last") - 10.0**-DIGITS))
        scores = save(found.unionByName(scored(save(rest.select("query", "grp", "rng"), "rest"))), "scores")
        return self._filled(asked, scores, good, k, by)

    def _weights(self, wanted: DataFrame, good: list[int], by: bool) -> DataFrame:
        """``query, scope, term, weight, avgdl`` of the query terms that any document has."""
        scope = F.col("grp") if by else F.lit("")
        terms = small(wanted.select("scope", "term").distinct())
        df = self._read("vocabulary", good[-1:]).select(scope.alias("scope"), "term", "df").join(terms, ["scope", "term"]).groupBy("scope", "term").agg(F.sum("df").alias("df"))
        total = self._read("totals", good[-1:]).groupBy(scope.alias("scope")).agg(F.sum("n").alias("n"), (F.sum("words") / F.sum("n")).alias("avgdl"))
        idf = F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        histogram = self._read("histogram", good[-1:]).filter("grp IS NOT NULL" if by else "grp IS NULL").select(scope.alias("scope"), "df", "terms")
        mean = histogram.join(total, "scope").groupBy("scope").agg((F.sum(idf * F.col("terms")) / F.sum("terms")).alias("mean"))
        stats = df.join(small(total), "scope").join(small(mean), "scope").withColumn("idf", F.when(idf < 0, EPSILON * F.col("mean")).otherwise(idf))
        return wanted.join(stats, ["scope", "term"]).select("query", "scope", "term", (F.col("idf") * (K1 + 1) * F.col("times")).alias("weight"), "avgdl")

    def _blocks(self, weights: DataFrame, good: list[int], by: bool) -> DataFrame:
        """Blocks of the query terms, from the folders that may have them, with each query's weight."""
        folders = [r["b"] for r in weights.select(_bucket(F.col("term")).alias("b")).distinct().collect()]  # at most BUCKETS
        blocks = self._read("postings", good).filter(F.col("bucket").isin(folders))
        on = weights.withColumnRenamed("scope", "grp") if by else weights.drop("scope")
        return blocks.join(small(on), ["grp", "term"] if by else ["term"])

    def _filled(self, asked: DataFrame, scores: DataFrame, good: list[int], k: int, by: bool) -> DataFrame:
        """The best ``k``; where fewer have a score above 0, documents without any term follow at 0."""
        met = scores.groupBy("query").agg(F.count(F.lit(1)).alias("met"), F.count_if(F.col("score") > 0).alias("above"))
        short = save(asked.select("query", "scope").distinct().join(met, "query", "left").filter(f"above IS NULL OR above < {k}").select("query", "scope", F.coalesce("met", F.lit(0)).alias("met")), "short")
        most = short.agg(F.max("met")).first()[0]
        if most is None:
            return top(scores, ["query"], [F.desc("score"), F.col("doc_id")], k).select("query", "rank", "doc_id", "score")
        lengths = self._lengths(good).select((F.col("grp") if by else F.lit("")).alias("scope"), "doc_id")
        early = top(lengths, ["scope"], [F.col("doc_id")], k + most).select("scope", "doc_id")
        zero = short.select("query", "scope").join(early, "scope").join(scores.select("query", "doc_id"), ["query", "doc_id"], "left_anti").select("query", "doc_id", F.lit(0.0).alias("score"))
        return top(scores.unionByName(zero), ["query"], [F.desc("score"), F.col("doc_id")], k).select("query", "rank", "doc_id", "score")


def _counted(rows: DataFrame) -> DataFrame:
    """``grp, doc_id, dl, term, tf`` of each distinct word of a text, and of the empty term for every text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                terms, counts, sizes, lengths = [], [], [], []
                for text in part.column("words").to_pylist():
                    words = text.split(" ") if text else []
                    seen = Counter(words)
                    terms += ["", *seen]
                    counts += [0, *seen.values()]
                    sizes.append(1 + len(seen))
                    lengths.append(len(words))
                row = pa.array([i for i, n in enumerate(sizes) for _ in range(n)], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("grp").take(row), part.column("doc_id").take(row), pa.array(lengths, pa.int64()).take(row), pa.array(terms, pa.string()), pa.array(counts, pa.int64())], ["grp", "doc_id", "dl", "term", "tf"])

    return rows.select("grp", "doc_id", F.array_join(tokens(F.col("text")), " ").alias("words")).mapInArrow(count, "grp string, doc_id long, dl long, term string, tf long")


def _opened(blocks: DataFrame, *columns: str) -> DataFrame:
    """``doc_id, tf, dl`` of each posting beside ``columns``."""
    posting = blocks.select(*columns, "rng", F.explode(F.arrays_zip("places", "lengths")).alias("p"))
    return posting.select(*columns, (F.col("rng") * RANGE + F.pmod("p.places", F.lit(RANGE))).alias("doc_id"), F.floor(F.col("p.places") / RANGE).cast("long").alias("tf"), F.col("p.lengths").alias("dl"))


def _bucket(term):
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")
