"""Coverage, conflicts and distinctness as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import save, small


def coverage(records: DataFrame, dimensions: list[str], least: int = 3) -> DataFrame:
    """Counts of each value of each dimension: one unpivot and one aggregate."""
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("dimension")) for c in dimensions])
    out = records.select(F.explode(pairs).alias("p")).filter("p.dimension IS NOT NULL").groupBy("p.category", "p.dimension").agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("status", F.when(F.col("n") < least, "under-covered").otherwise("covered"))


def conditional_coverage(records: DataFrame, predicates: dict, usable) -> DataFrame:
    """``dimension, total, usable`` of named predicates, in one pass."""
    sums = records.agg(*[c for name, p in predicates.items() for c in (F.count_if(p).alias(f"{name}_t"), F.count_if(p & usable).alias(f"{name}_u"))])
    rows = F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(f"{n}_t").alias("total"), F.col(f"{n}_u").alias("usable")) for n in predicates])
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def conflicts(records: DataFrame, topic: str, ratings: list[str]) -> DataFrame:
    """Topics with two or more records whose ratings differ: distinct values are listed, members counted."""
    values = [F.sort_array(F.collect_set(F.col(c).cast("string"))).alias(c) for c in ratings]
    out = records.groupBy(F.coalesce(F.nullif(F.col(topic), F.lit("")), F.lit("unspecified")).alias("topic")).agg(F.count(F.lit(1)).alias("n"), *values)
    differ = F.lit(False)
    for c in ratings:
        differ = differ | (F.size(c) > 1)
    return out.filter((F.col("n") >= 2) & differ).select("topic", "n", *[F.array_join(c, ",").alias(c) for c in ratings])


def conflict_links(records: DataFrame, topic: str, rating: str) -> DataFrame:
    """Each record with the smallest-id record of its topic that has another rating, and how many such there are.

    Counts by (topic, rating) replace the pairs, whose number grows with the square of a topic.
    """
    by = records.groupBy(topic, rating).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    other = by.alias("a").join(by.alias("b"), (F.col(f"a.{topic}") == F.col(f"b.{topic}")) & (F.col(f"a.{rating}") != F.col(f"b.{rating}")))
    other = other.groupBy(F.col(f"a.{topic}").alias(topic), F.col(f"a.{rating}").alias(rating)).agg(F.min("b.first").alias("partner"), F.sum("b.n").alias("n_conflicts"))
    return records.join(other, [topic, rating]).select("id", topic, rating, "partner", "n_conflicts")


#: Outcome types of a topic that are not to be compared with each other.
OPPOSED = ("symptoms", "inflammation")


def set_conflicts(claims: DataFrame) -> DataFrame:
    """How many claims of its topic each claim of ``id, topic, conditions, contexts, outcome, level`` conflicts with, and the first of them.

    Two claims of a topic conflict if their sets of conditions or of contexts differ, or if
    their outcomes are the opposed ones. No pair is made: claims are counted by (topic,
    conditions, contexts, outcome, level), and each count of pairs follows from counts of
    these groups by inclusion and exclusion. ``n_conflicts`` counts any difference,
    ``n_condition``, ``n_context``, ``n_opposed`` each kind, ``n_level`` conflicts between
    different levels; ``partner`` is the smallest id in conflict, null without one.

    Sets ignore order and repeats; a null set is empty, other nulls are the empty string;
    repeated ids are claims of their own.
    """
    joined = lambda c: F.to_json(F.coalesce(F.array_sort(F.array_distinct(c)), F.array().cast("array<string>")))
    key = ["topic", "conditions", "contexts", "outcome", "level"]
    plain = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("topic", "outcome", "level")]
    # written: what makes claims of texts would run again for the last join
    rows = save(claims.select("id", *plain, joined("conditions").alias("conditions"), joined("contexts").alias("contexts")), "claims")
    # dealt by topic once: every window below has the topic among its keys
    kinds = save(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")), "kinds").repartition("topic")
    a, b = (F.col("outcome") == x for x in OPPOSED)
    same = ("topic", "conditions", "contexts")

    def agreeing(*by: str) -> Column:
        """How many claims agree in these columns."""
        return F.sum("n").over(Window.partitionBy(*by))

    def opposed(*by: str, value: str = "n", how=F.sum) -> Column:
        """The same over claims with the opposed outcome; null where there is none."""
        of = lambda x: how(F.when(x, F.col(value))).over(Window.partitionBy(*by))
        return F.when(a, of(b)).when(b, of(a))

    none = lambda c: F.coalesce(c, F.lit(0))
    begin = F.struct(F.min("first").over(Window.partitionBy(*same)).alias("first"), "conditions", "contexts")
    kinds = kinds.withColumns({
        "n_conflicts": agreeing("topic") - agreeing(*same) + none(opposed(*same)), "n_condition": agreeing("topic") - agreeing("topic", "conditions"), "n_context": agreeing("topic") - agreeing("topic", "contexts"), "n_opposed": none(opposed("topic")),
        "alike": agreeing("topic", "level") - agreeing(*same, "level") + none(opposed(*same, "level")), "facing": opposed(*same, value="first", how=F.min), "begin": begin,
    }).withColumn("e1", F.min("begin").over(Window.partitionBy("topic")))
    # the two groups of a topic that begin first: one of them differs from any other group
    kinds = kinds.withColumn("e2", F.min(F.when(F.col("begin") != F.col("e1"), F.col("begin"))).over(Window.partitionBy("topic")))
    other = F.when(F.col("begin") == F.col("e1"), F.col("e2.first")).otherwise(F.col("e1.first"))
    result = kinds.select(*key, "n_conflicts", "n_condition", "n_context", "n_opposed", (F.col("n_conflicts") - F.col("alike")).alias("n_level"), F.least(other, "facing").alias("partner"))
    return rows.join(small(save(result, "conflicts")), key).select("id", "topic", "n_conflicts", "n_condition", "n_context", "n_opposed", "n_level", "partner")


def distinctness(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``check, passed``: exact, as an approximate count proves nothing."""
    out = None
    for name, (df, column) in frames.items():
        one = df.agg((F.count(column) == F.count_distinct(column)).alias("passed")).select(F.lit(name).alias("check_id"), "passed")
        out = one if out is None else out.unionByName(one)
    return out
