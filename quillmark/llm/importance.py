"""Importance resampling towards a target distribution.

Each text is an array of feature buckets (runs of one and two words, hashed by
their checksum). One pass counts the buckets of all texts, task by task; the
counts of both sides give every bucket a gain, and the table of gains (one number
for each of the ``buckets``, whatever the input's size) goes to the tasks of a second
pass, which scores whole arrays at once: a text's weight is the mean gain of its
features. Gumbel noise drawn from a hash of the seed and the document's number
turns the highest scores into a sample without replacement.

Scores are whole numbers, and their range follows from 64-bit counts and 32-bit
noise (``SCORES`` values at most), so an exact histogram of them is small at any
input size. Its sums from the top give each score the rank at which it begins and
the cutoff, the score of the last document drawn. Only documents from the cutoff on
are numbered, by number within each score; noise spreads even equal texts over the
scores, so no score holds more than a few hundredths of a percent of them.

Defined results: a null text has no words, no features and weight 0; a null
``doc_id`` has the noise of an empty number and comes after the others of its
score; rows with one ``doc_id`` are documents of their own and, scored alike, take
neighbouring ranks (the row with more features first); extra columns are ignored,
whatever their names; an empty table gives an empty result, and an empty target
gains that only reflect the source.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import materialise
from .textblocks import blocks, lower_ascii, utf8

BUCKETS = 10_000
#: Bound of the histogram: gains of 64-bit counts lie within 1000 * ln(2**64) on both sides, noise within -4,000 and 23,000.
SCORES = 2 * 44_400 + 27_000
#: Longer words have their checksum taken one by one.
LONG = 48


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_TABLE = _crc_table()


def crc32_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray | None = None) -> np.ndarray:
    """Checksum of each span of bytes, carried on from ``state``; all spans advance together, byte by byte."""
    crc = np.zeros(len(start), np.uint32) if state is None else state.astype(np.uint32)
    size = end - start
    text = None
    for i in np.flatnonzero(size > LONG).tolist():
        text = memoryview(data.tobytes()) if text is None else text
        crc[i] = zlib.crc32(text[start[i] : end[i]], int(crc[i]))
    order = np.argsort(-np.where(size > LONG, 0, size), kind="stable")
    live = np.searchsorted(-np.where(size > LONG, 0, size)[order], np.arange(0, -LONG - 1, -1), "left")  # spans longer than k
    now, at = ~crc[order], start[order]
    for k in range(LONG):
        n = int(live[k])
        if not n:
            break
        c = now[:n]
        now[:n] = _TABLE[(c ^ data[at[:n] + k]) & np.uint32(255)] ^ (c >> np.uint32(8))
    crc[order] = ~now
    return crc


def _feature_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of digits, small letters and bytes beyond ASCII, and each document's first one."""
    solid = (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.concatenate([[False], solid]), np.concatenate([solid, [False]])
    start = np.flatnonzero(after & (~before | edge))
    return start, np.flatnonzero(before & (~after | edge)), np.searchsorted(start, offsets)


def text_buckets(column: pa.Array, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block of documents: first, last, buckets of all features, each document's first feature, its number of words."""
    data, offsets = utf8(column)
    space = np.zeros(1, np.uint8) + np.uint8(32)
    for first, last in blocks(offsets):
        part = np.concatenate([lower_ascii(data[offsets[first] : offsets[last]]), space])
        start, end, top = _feature_words(part[:-1], offsets[first : last + 1] - offsets[first])
        one = crc32_words(part, start, end)
        pair = np.ones(len(start), bool)  # whether a word has another behind it in its document
        pair[top[1:][top[1:] > top[:-1]] - 1] = False
        left = np.flatnonzero(pair)
        blank = len(part) - 1
        joint = crc32_words(part, np.full(len(left), blank), np.full(len(left), blank + 1), one[left])
        two = crc32_words(part, start[left + 1], end[left + 1], joint)
        words = np.diff(top)
        features = 2 * words - (words > 0)
        ends = np.concatenate([[0], np.cumsum(features)])
        # single words of a document, then its pairs
        place = np.arange(len(start)) + np.repeat(ends[:-1] - top[:-1], words)
        out = np.empty(ends[-1], np.int64)
        out[place] = one % np.uint32(buckets)
        pairs = np.maximum(words - 1, 0)
        behind = np.concatenate([[0], np.cumsum(pairs)])[:-1]
        out[np.arange(len(left)) + np.repeat(ends[:-1] + words - behind, pairs)] = two % np.uint32(buckets)
        yield first, last, out, ends, words


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all features of all texts; a task sends one row for each bucket it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, found, _, _ in text_buckets(batch.column(0), buckets):
                total += np.bincount(found, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    return texts.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, gain`` for every bucket: how much likelier the target holds it, in thousandths of a natural logarithm."""
    sides = bucket_counts(source, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionByName(bucket_counts(target, buckets).select("bucket", F.lit(0).alias("s"), F.col("n").alias("t")))
    every = sides.unionByName(source.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t")))
    each = every.groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
    whole = each.agg(F.sum("s").alias("_s"), F.sum("t").alias("_t"))
    ratio = (F.col("t") + 1) * (F.col("_s") + buckets) / ((F.col("s") + 1) * (F.col("_t") + buckets))
    return each.join(F.broadcast(whole)).select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def weights(docs: DataFrame, gains: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each text; ``gains`` has one row for each bucket."""
    table = np.zeros(buckets, np.int64)
    for r in gains.collect():  # as many rows as buckets
        table[r["bucket"]] = r["gain"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, found, ends, words in text_buckets(batch.column("text"), buckets):
                total = np.concatenate([[0], np.cumsum(table[found])])
                features = np.diff(ends)
                weight = (total[ends[1:]] - total[ends[:-1]]) // np.maximum(features, 1)
                ids = batch.column("doc_id").slice(first, last - first)
                yield pa.RecordBatch.from_arrays([ids, pa.array(words, pa.int64()), pa.array(features, pa.int64()), pa.array(weight, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(score, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def draw(scored: DataFrame, eligible, percent: int) -> DataFrame:
    """``scored`` with ``rank`` 1, 2, 3 ... by falling score, then ``doc_id``, for the first ``percent`` of the eligible rows, null for others.

    ``scored`` is read twice and should be a written table.
    """
    spark = scored.sparkSession
    counts = {r["score"]: r["n"] for r in scored.filter(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most SCORES rows
    wanted = sum(counts.values()) * percent // 100
    starts, above = [], 0
    for value in sorted(counts, reverse=True):
        if above >= wanted:
            break
        starts.append((value, above))
        above += counts[value]
    none = F.lit(None).cast("long")
    if not starts:
        return scored.withColumn("rank", none)
    far = eligible & (F.col("score") >= starts[-1][0])
    table = F.broadcast(spark.createDataFrame(starts, "score bigint, _above bigint"))  # at most SCORES rows
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), F.col("n_features").desc())
    near = scored.filter(far).join(table, "score").withColumn("rank", F.col("_above") + F.row_number().over(order))
    near = near.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = scored.filter(~F.coalesce(far, F.lit(False))).withColumn("rank", none)
    return near.select(*scored.columns, "rank").unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, percent: int, least_words: int, seed: int, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``: ``percent`` of the documents with ``least_words`` words, drawn to resemble ``target``."""
    found = weights(docs, bucket_gains(docs, target, buckets), buckets)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = materialise(found.withColumn("score", F.col("weight") + noise), "scored")
    return draw(scored, F.col("n_words") >= least_words, percent)
