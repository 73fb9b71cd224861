"""Quality checks as constraint queries: ``check_id, passed, violations``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAUSAL, HEDGED = ("tion",), ("whe",)


def checks(rows: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Rows for which each test does not hold, in one pass."""
    sums = rows.agg(*[F.count_if(~F.coalesce(t, F.lit(False))).alias(k) for k, t in tests.items()])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check_id"), (F.col(k) == 0).alias("passed"), F.col(k).alias("violations")) for k in tests])).alias("c")).select("c.*")


def verdict(results: DataFrame) -> DataFrame:
    """The checks with a last row for all of them."""
    return results.unionByName(results.agg(F.lit("ALL").alias("check_id"), F.bool_and("passed").alias("passed"), F.sum("violations").alias("violations")))


def foreign_keys(rows: DataFrame, key: str, parents: DataFrame, parent_key: str, check_id: str) -> DataFrame:
    missing = rows.join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(check_id).alias("check_id"), (F.col("violations") == 0).alias("passed"), "violations")


def unique(rows: DataFrame, key: str, check_id: str) -> DataFrame:
    out = rows.agg((F.count(key) - F.count_distinct(key)).alias("violations"))
    return out.select(F.lit(check_id).alias("check_id"), (F.col("violations") == 0).alias("passed"), "violations")


def causal_upgrade(answer: Column, sources: Column, causal: tuple[str, ...] = CAUSAL, hedged: tuple[str, ...] = HEDGED) -> Column:
    """A causal word in the answer while a source hedges, or no source has that word."""
    has = lambda x, words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.lower(x), w))
    return has(answer, causal) & (F.exists(sources, lambda s: has(s, hedged)) | ~F.exists(sources, lambda s: has(s, causal)))


def validate_json(raw: DataFrame, column: str, schema: str, required: list[str]) -> DataFrame:
    """``errors`` of each JSON text: malformed, or required fields missing, sorted."""
    parsed = F.from_json(column, f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = raw.withColumn("_j", parsed)
    errors = F.array_compact(F.array(F.when(F.col("_j._corrupt").isNotNull(), "malformed"), *[F.when(F.col(f"_j.{c}").isNull(), f"missing {c}") for c in required]))
    return rows.withColumn("errors", F.array_join(F.array_sort(errors), "; ")).drop("_j")
