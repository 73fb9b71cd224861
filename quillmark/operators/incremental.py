"""Incremental collection: windows, cutoffs, streaks, missed days, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def window_plan(providers: DataFrame, today: Column, floor: Column, longest: int = 14) -> DataFrame:
    """Inclusive window of each ``provider, last_day, overlap``: first run from the floor, else from the overlap; long gaps are sliced."""
    start = F.when(F.col("last_day").isNull(), floor).otherwise(F.greatest(floor, F.date_sub(F.col("last_day"), F.col("overlap"))))
    missed = F.when(F.col("last_day").isNull(), 0).otherwise(F.greatest(F.lit(0), F.datediff(today, F.col("last_day")) - 1))
    out = providers.select("provider", start.alias("start"), today.alias("today"), missed.alias("missed"))
    end = F.when(F.datediff("today", "start") + 1 > longest, F.date_add("start", longest - 1)).otherwise(F.col("today"))
    empty = F.col("today") < floor
    return out.select("provider", "start", end.alias("end"), F.col("missed").cast("int").alias("missed"), (end < F.col("today")).alias("sliced"), empty.alias("empty"))


def covered_through(days: DataFrame, most: int) -> DataFrame:
    """Of ``provider, day, n``: the last complete day before the first day with ``most`` hits or more (null: none), and whether one was cut."""
    cut = days.groupBy("provider").agg(F.min(F.when(F.col("n") >= most, F.col("day"))).alias("cut"))
    return days.join(cut, "provider").groupBy("provider").agg(F.max(F.when(F.col("cut").isNull() | (F.col("day") < F.col("cut")), F.col("day"))).alias("covered"), F.max(F.col("cut").isNotNull()).alias("truncated"))


def advance(cutoffs: DataFrame) -> DataFrame:
    """``provider, cutoff``: moves on only if healthy, all screened, and covered or complete; never back."""
    ok = F.col("healthy") & (F.col("unscreened") == 0) & (F.col("covered").isNotNull() | ~F.col("truncated"))
    return cutoffs.select("provider", F.when(ok, F.greatest("old", F.coalesce("covered", "today"))).otherwise(F.col("old")).alias("cutoff"))


def canary(events: DataFrame, provider: str, narrow: Column, wide: Column) -> DataFrame:
    """A wide window must hit at least as often as a narrow one; nothing in it is suspect."""
    out = events.groupBy(F.col(provider).alias("provider")).agg(F.count_if(narrow).alias("narrow"), F.count_if(wide).alias("wide"))
    return out.withColumn("status", F.when(F.col("wide") == 0, "invalid").when(F.col("wide") < F.col("narrow"), "filter ignored").otherwise("healthy"))


def calendar(events: DataFrame, key: str, day: Column) -> DataFrame:
    """``key, day, n`` for every key and every day of the whole span: zero days included."""
    counts = events.groupBy(key, day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    span = counts.agg(F.min("day").alias("a"), F.max("day").alias("b"))  # one row
    days = counts.select(key).distinct().crossJoin(F.broadcast(span)).select(key, F.explode(F.sequence("a", "b")).alias("day"))
    return days.join(counts, [key, "day"], "left").select(key, "day", F.coalesce("n", F.lit(0)).alias("n"))


def zero_streaks(days: DataFrame, key: str) -> DataFrame:
    """Days without hits, with the length of the streak so far: 2 warns, 3 and more are errors."""
    w = Window.partitionBy(key).orderBy("day")
    island = F.sum((F.col("n") > 0).cast("int")).over(w)
    rows = days.withColumn("_i", island).filter("n = 0")
    streak = F.row_number().over(Window.partitionBy(key, "_i").orderBy("day"))
    return rows.select(key, "day", streak.alias("streak")).withColumn("level", F.when(F.col("streak") >= 3, "error").when(F.col("streak") == 2, "warn").otherwise("info"))


def last_n(rows: DataFrame, key: str, order: list, n: int) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")


def listing_changes(listing: DataFrame, baseline: DataFrame, on: str) -> DataFrame:
    """Rows whose key the baseline lacks."""
    return listing.join(baseline.select(on).distinct(), on, "left_anti")


def state_streaks(days: DataFrame, by: str, state: Column, quiet: str) -> DataFrame:
    """``day, state, streak, level`` of days in a state other than ``quiet``: how many days in a row, warn at 2, error at 3.

    A ``by`` has a row a day, so its window holds a calendar's days.
    """
    rows = days.select(by, "day", state.alias("state"))
    line = Window.partitionBy(by).orderBy("day")
    own = Window.partitionBy(by, "state").orderBy("day")
    rows = rows.withColumn("_i", F.row_number().over(line) - F.row_number().over(own))
    streak = F.row_number().over(Window.partitionBy(by, "state", "_i").orderBy("day"))
    level = F.when(F.col("streak") >= 3, "error").when(F.col("streak") == 2, "warn").otherwise("info")
    return rows.filter(F.col("state") != quiet).withColumn("streak", streak).select(by, "day", "state", "streak", level.alias("level"))


def zero_explanation(canary: Column, streak: Column) -> Column:
    """Why a window had no result: the canary's count is unknown, 0, or shows that the source answers; with the streak's level."""
    why = F.when(canary.isNull(), "unexplained").when(canary == 0, "invalid: the canary finds nothing").otherwise("healthy: nothing new")
    return F.concat(why, F.when(streak >= 3, " [error]").when(streak == 2, " [warn]").otherwise(""))
