"""Windows, streaks, limits and streams over the check tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import folds
from ..operators import incremental as I
from ..streaming import windows as W
from .catalog import query, table


def day():
    return F.to_date("ts")


TODAY, FLOOR = "2024-02-05", "2024-01-10"


def _last(spark, d):
    last = table(spark, d, "events").filter("value > 50").groupBy(F.col("event_type").alias("provider")).agg(F.max(day()).alias("last_day"))
    return last.select("provider", F.when(F.col("provider") == "error", F.lit(None).cast("date")).otherwise(F.date_sub("last_day", F.when(F.col("provider") == "click", 12).otherwise(0))).alias("last_day"), F.when(F.col("provider") == "view", 7).otherwise(1).alias("overlap"))


LAST = "l AS (SELECT event_type AS provider, CASE WHEN event_type = 'error' THEN NULL ELSE max(ts::DATE) - CASE WHEN event_type = 'click' THEN 12 ELSE 0 END END AS last_day, CASE WHEN event_type = 'view' THEN 7 ELSE 1 END AS overlap FROM events WHERE value > 50 GROUP BY event_type)"


@query("window_plan", f"""WITH {LAST}, p AS (SELECT provider, CASE WHEN last_day IS NULL THEN DATE '{FLOOR}' ELSE greatest(DATE '{FLOOR}', last_day - overlap) END AS start, last_day FROM l),
e AS (SELECT *, CASE WHEN DATE '{TODAY}' - start + 1 > 14 THEN start + 13 ELSE DATE '{TODAY}' END AS stop FROM p)
SELECT provider, start, stop AS "end", coalesce(greatest(0, DATE '{TODAY}' - last_day - 1), 0)::INT AS missed, stop < DATE '{TODAY}' AS sliced, DATE '{TODAY}' < DATE '{FLOOR}' AS empty FROM e""")
def window_plan(spark, d):
    return I.window_plan(_last(spark, d), F.lit(TODAY).cast("date"), F.lit(FLOOR).cast("date"))


DAYS = "d AS (SELECT event_type AS provider, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL)"


def _days(spark, d):
    return table(spark, d, "events").groupBy(F.col("event_type").alias("provider"), day().alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("covered_through", f"WITH {DAYS}, c AS (SELECT provider, min(day) FILTER (n >= 90) AS cut FROM d GROUP BY provider) SELECT provider, max(day) FILTER (cut IS NULL OR day < cut) AS covered, max(cut IS NOT NULL) AS truncated FROM d JOIN c USING (provider) GROUP BY provider")
def covered_through(spark, d):
    return I.covered_through(_days(spark, d), 90)


@query("cutoff_advance", f"""WITH {DAYS}, c AS (SELECT provider, min(day) FILTER (n >= 90) AS cut FROM d GROUP BY provider), v AS (SELECT provider, max(day) FILTER (cut IS NULL OR day < cut) AS covered, max(cut IS NOT NULL) AS truncated FROM d JOIN c USING (provider) GROUP BY provider)
SELECT provider, CASE WHEN provider <> 'error' AND (covered IS NOT NULL OR NOT truncated) THEN greatest(DATE '2024-01-15', coalesce(covered, DATE '{TODAY}')) ELSE DATE '2024-01-15' END AS cutoff FROM v""")
def cutoff_advance(spark, d):
    rows = I.covered_through(_days(spark, d), 90).select("*", F.lit("2024-01-15").cast("date").alias("old"), F.lit(TODAY).cast("date").alias("today"), (F.col("provider") != "error").alias("healthy"), F.lit(0).alias("unscreened"))
    return I.advance(rows)


@query("canary_check", "WITH c AS (SELECT event_type AS provider, count(*) FILTER (ts::DATE = DATE '2024-01-20') AS narrow, count(*) FILTER (ts::DATE >= DATE '2024-01-01') AS wide FROM events GROUP BY 1) SELECT *, CASE WHEN wide = 0 THEN 'invalid' WHEN wide < narrow THEN 'filter ignored' ELSE 'healthy' END AS status FROM c")
def canary_check(spark, d):
    return I.canary(table(spark, d, "events"), "event_type", day() == F.lit("2024-01-20").cast("date"), day() >= F.lit("2024-01-01").cast("date"))


CALENDAR = "c AS (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL), s AS (SELECT min(day) AS a, max(day) AS b FROM c), k AS (SELECT user_id, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM (SELECT DISTINCT user_id FROM c), s), z AS (SELECT user_id, day, coalesce(n, 0) AS n FROM k LEFT JOIN c USING (user_id, day))"


@query("zero_streaks", f"WITH {CALENDAR}, i AS (SELECT *, sum((n > 0)::INT) OVER (PARTITION BY user_id ORDER BY day) AS g FROM z), r AS (SELECT user_id, day, row_number() OVER (PARTITION BY user_id, g ORDER BY day)::INT AS streak FROM i WHERE n = 0) SELECT *, CASE WHEN streak >= 3 THEN 'error' WHEN streak = 2 THEN 'warn' ELSE 'info' END AS level FROM r")
def zero_streaks(spark, d):
    return I.zero_streaks(I.calendar(table(spark, d, "events"), "user_id", day()), "user_id")


@query("missed_days", f"WITH {CALENDAR} SELECT user_id, day FROM z WHERE n = 0")
def missed_days(spark, d):
    return I.calendar(table(spark, d, "events"), "user_id", day()).filter("n = 0").select("user_id", "day")


@query("rate_limit_decisions", """WITH RECURSIVE e AS (SELECT user_id, event_id, epoch(ts) AS at, row_number() OVER (PARTITION BY user_id ORDER BY epoch(ts), event_id) AS n FROM events),
w AS (SELECT user_id, NULL::BIGINT AS event_id, 0::BIGINT AS n, false AS allowed, 0.0::DOUBLE AS retry_after, []::DOUBLE[] AS times FROM (SELECT DISTINCT user_id FROM events)
UNION ALL SELECT e.user_id, e.event_id, e.n, len(k) < 3, CASE WHEN len(k) < 3 THEN 0.0 ELSE round(greatest(86400 - (e.at - k[1]), 1.0), 6) END, CASE WHEN len(k) < 3 THEN list_append(k, e.at) ELSE k END FROM w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1, LATERAL (SELECT list_filter(w.times, lambda t: t > e.at - 86400) AS k) x)
SELECT user_id, event_id, allowed, retry_after FROM w WHERE n > 0""")
def rate_limit_decisions(spark, d):
    return folds.rate_limit(table(spark, d, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").cast("double").alias("at")), 3, 86400.0)


@query("rate_window_counts", "SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch(ts) RANGE BETWEEN 86399 PRECEDING AND CURRENT ROW) AS n FROM events")
def rate_window_counts(spark, d):
    from pyspark.sql.window import Window

    rows = table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").cast("double").alias("at"))
    return rows.select("event_id", "user_id", F.count(F.lit(1)).over(Window.partitionBy("user_id").orderBy("at").rangeBetween(-86399, 0)).alias("n"))


@query("token_budget", """WITH RECURSIVE t AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, length(text) // 4 AS tokens FROM conversations),
r AS (SELECT conv_id, turn, i, CASE WHEN tokens <= 120 THEN tokens ELSE 0 END AS used, tokens <= 120 AS allowed FROM t WHERE i = 1
UNION ALL SELECT t.conv_id, t.turn, t.i, r.used + CASE WHEN r.used + t.tokens <= 120 THEN t.tokens ELSE 0 END, r.used + t.tokens <= 120 FROM r JOIN t ON t.conv_id = r.conv_id AND t.i = r.i + 1)
SELECT conv_id, turn, used, allowed FROM r""")
def token_budget(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", F.floor(F.length("text") / 4).alias("tokens"))
    return folds.token_budget(turns, 120)


@query("retention_last_n", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 14")
def retention_last_n(spark, d):
    return I.last_n(table(spark, d, "events").select("user_id", "event_id", "ts"), "user_id", [F.desc("ts"), F.desc("event_id")], 14).select("user_id", "event_id")


@query("listing_changes", "SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def listing_changes(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    return I.listing_changes(pages, pages.filter("page_id % 3 = 0"), "url").select("page_id", "url")


@query("stream_tumbling", "WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT start::TIMESTAMPTZ AS start, event_type, n FROM w WHERE start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)")
def stream_tumbling(spark, d):
    return W.run_once(W.tumbling(W.event_stream(spark, d), "1 day", "1 hour"), "tumbling")


@query("stream_session", """WITH o AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS b FROM events), g AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM o),
w AS (SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS stop, count(*) AS n FROM g GROUP BY user_id, s) SELECT user_id, start::TIMESTAMPTZ AS start, stop::TIMESTAMPTZ AS "end", n FROM w WHERE stop <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_session(spark, d):
    return W.run_once(W.sessions(W.event_stream(spark, d), "6 hours", "1 hour"), "sessions")


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, d):
    return W.run_once(W.first_seen(W.event_stream(spark, d), ["user_id", "event_type"], "60 days").select("user_id", "event_type"), "first")


@query("state_streaks", f"""WITH {CALENDAR}, g AS (SELECT user_id, day, CASE WHEN n = 0 THEN 'zero' WHEN n = 1 THEN 'incomplete' WHEN n > 6 THEN 'failed' ELSE 'fine' END AS state FROM z), i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) - row_number() OVER (PARTITION BY user_id, state ORDER BY day) AS i FROM g),
r AS (SELECT user_id, day, state, row_number() OVER (PARTITION BY user_id, state, i ORDER BY day)::INT AS streak FROM i WHERE state <> 'fine') SELECT *, CASE WHEN streak >= 3 THEN 'error' WHEN streak = 2 THEN 'warn' ELSE 'info' END AS level,
CASE WHEN user_id % 3 = 0 THEN 'unexplained' WHEN user_id % 3 = 1 THEN 'invalid: the canary finds nothing' ELSE 'healthy: nothing new' END || CASE WHEN streak >= 3 THEN ' [error]' WHEN streak = 2 THEN ' [warn]' ELSE '' END AS explanation FROM r""")
def state_streaks(spark, d):
    days = I.calendar(table(spark, d, "events"), "user_id", day())
    n = F.col("n")
    state = F.when(n == 0, "zero").when(n == 1, "incomplete").when(n > 6, "failed").otherwise("fine")
    canary = F.when(F.col("user_id") % 3 == 1, 0).when(F.col("user_id") % 3 == 2, 5)
    return I.state_streaks(days, "user_id", state, "fine").withColumn("explanation", I.zero_explanation(canary, F.col("streak")))
