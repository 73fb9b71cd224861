"""Exact de-duplication by content sort, with DataFrame functions only.

White-space runs become one space. Rows are range-partitioned by sampled
splitters over a bounded prefix of the normalised text (so that the splitter
sample stays small whatever the texts' length) with a 64-bit hash behind it,
sorted externally within each partition, and neighbours are compared in full.

Groups that hold more than ``1 / (2 * partitions)`` of all rows are dealt over
several salted ranges; their few leaders are then compared in full again. There
are fewer such groups than twice the partitions, which bounds what is broadcast.

Defined results: a null text counts as empty; empty texts are equal; a null
``doc_id`` sorts last and is ``keep_id`` only if its whole group has none; of
repeated rows (same id, same text) exactly one is kept; further columns pass
through, unless they bear the name of a result column, which then replaces them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .shared import SPACE, shuffle_partitions

PREFIX_CHARS = 48
OUT = ("keep_id", "group_size", "kept", "text_sha256")


def _leader(by: list[str]):
    return Window.partitionBy(*by), Window.partitionBy(*by).orderBy(F.col("doc_id").asc_nulls_last())


def exact_dedup(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with ``keep_id, group_size, kept, text_sha256``.

    ``carry`` names the columns to pass through besides ``doc_id`` (all by default).
    """
    spark = docs.sparkSession
    carry = [c for c in (docs.columns if carry is None else carry) if c != "doc_id" and c not in OUT]
    parts = shuffle_partitions(spark)
    rows = docs.select("doc_id", *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " ").alias("_norm"))
    rows = rows.withColumn("_hash", F.xxhash64("_norm"))

    total = docs.count()
    least = max(64, total // (2 * parts))
    sizes = docs.select(F.xxhash64(F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " ")).alias("_hash")).groupBy("_hash").count()
    hot = {r["_hash"]: r["count"] for r in sizes.filter(F.col("count") > least).collect()}  # at most total / least rows
    # one small salt table as a literal map: fewer than 2 * parts entries
    ways = F.lit(1)
    if hot:
        pairs = [F.lit(x) for h, n in hot.items() for x in (h, -(-n // least))]
        ways = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("_hash")), F.lit(1))
    rows = rows.withColumn("_ways", ways.cast("int"))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("_ways")).cast("int"))

    key = ["_prefix", "_hash", "_salt"]
    ranged = rows.withColumn("_prefix", F.substring("_norm", 1, PREFIX_CHARS)).repartitionByRange(parts, *key)
    group, order = _leader([*key, "_norm"])
    near = (
        ranged.withColumn("_row", F.row_number().over(order))
        .withColumn("_min", F.first("doc_id", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("_n", F.count(F.lit(1)).over(group))
        .withColumn("text_sha256", F.sha2(F.encode("_norm", "UTF-8"), 256))
    )
    sha = near.select("doc_id", *[f"_c{i}" for i in range(len(carry))], "_ways", "_row", "_min", "_n", "text_sha256")
    keep, size = F.col("_min"), F.col("_n")
    if hot:
        # the leaders of salted groups, few for each, are compared in full once more
        few = near.filter((F.col("_ways") > 1) & (F.col("_row") == 1)).groupBy("_norm", "text_sha256").agg(F.min("_min").alias("_hot_min"), F.sum("_n").alias("_hot_n"))
        sha = sha.join(F.broadcast(few.select("text_sha256", "_hot_min", "_hot_n")), "text_sha256", "left")
        keep = F.when(F.col("_ways") > 1, F.col("_hot_min")).otherwise(keep)
        size = F.when(F.col("_ways") > 1, F.col("_hot_n")).otherwise(size)
    kept = (F.col("_row") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return (
        sha.withColumn("keep_id", keep)
        .withColumn("group_size", size.cast(T.LongType()))
        .withColumn("kept", kept)
        .select("doc_id", *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], *OUT)
    )
