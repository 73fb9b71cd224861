"""State by key across runs: known keys, retried batches, late rows, expiry; and the rate limit as a stream."""

import datetime as dt
import os

import pytest

from quillmark.streaming import windows as W

SCHEMA = "user_id long, event_id long, ts timestamp"
START = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)


class Drop:
    """A folder that gets one file a time, read as a stream of one file a batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, str(path), 0

    def add(self, rows):
        self.n += 1
        made = [(u, e, START + dt.timedelta(seconds=s)) for u, e, s in rows]
        self.spark.createDataFrame(made, SCHEMA).coalesce(1).write.parquet(f"{self.path}/in={self.n}")
        name = next(x for x in os.listdir(f"{self.path}/in={self.n}") if x.endswith(".parquet"))
        os.makedirs(f"{self.path}/all", exist_ok=True)
        os.rename(f"{self.path}/in={self.n}/{name}", f"{self.path}/all/{self.n:04d}.parquet")
        os.utime(f"{self.path}/all/{self.n:04d}.parquet", (1_700_000_000 + self.n, 1_700_000_000 + self.n))

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.path}/all")


@pytest.fixture
def drop(spark, tmp_path):
    return Drop(spark, tmp_path)


def held(spark, table):
    return sorted(((r["user_id"], r["event_id"]) for r in spark.read.parquet(f"{table}/batch=*").collect()), key=str)


def test_keys_of_earlier_runs_are_known(spark, drop, tmp_path):
    table = str(tmp_path / "table")
    drop.add([(1, 1, 0), (2, 2, 0), (None, 3, 0)])
    W.daily_run(spark, drop.stream(), table, "user_id")
    drop.add([(2, 4, 9), (3, 5, 9), (None, 6, 9)])
    drop.add([(3, 7, 9), (4, 8, 9)])
    W.daily_run(spark, drop.stream(), table, "user_id")
    assert [k for k, _ in sorted(held(spark, table), key=str)] == [1, 2, 3, 4, None]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != W.ROCKS


def test_a_retried_batch_gives_the_same_rows(spark, drop, tmp_path):
    """A run that stopped after a batch was written and before it was noted does that batch again."""
    table = str(tmp_path / "table")
    drop.add([(1, 1, 0), (2, 2, 0)])
    W.daily_run(spark, drop.stream(), table, "user_id")
    drop.add([(2, 3, 1), (5, 4, 1)])
    W.daily_run(spark, drop.stream(), table, "user_id")
    want = held(spark, table)
    commits = sorted((x for x in os.listdir(f"{table}-state/commits") if not x.startswith((".", "_"))), key=int)
    os.remove(f"{table}-state/commits/{commits[-1]}")
    crc = f"{table}-state/commits/.{commits[-1]}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    W.daily_run(spark, drop.stream(), table, "user_id")
    assert held(spark, table) == want and [k for k, _ in want] == [1, 2, 5]


def test_keys_go_after_their_time_and_late_rows_are_dropped(spark, drop, tmp_path):
    table = str(tmp_path / "table")
    ttl = ("ts", "10 seconds")
    for rows in ([(1, 1, 0)], [(1, 2, 5)], [(2, 3, 100)], [(3, 4, 200), (1, 5, 1)], [(1, 6, 201)]):
        drop.add(rows)
        W.daily_run(spark, drop.stream(), table, "user_id", ttl)
    # the second comes within the time of the first, the fifth is later than the watermark, the sixth is new again
    assert [e for _, e in sorted(held(spark, table), key=lambda r: r[1])] == [1, 3, 4, 6]


def test_rate_limit_as_a_stream(spark, drop, tmp_path):
    """Two in ten seconds, over batches; the state of users that are gone is let go."""
    batches = [[(1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 4, 2)], [(1, 5, 8), (1, 6, 10.5), (1, 7, 10.6)], [(2, 8, 300)], [(2, 9, 400), (1, 10, 20)], [(1, 11, 401)]]
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    for rows in batches:
        drop.add(rows)
        with W.keyed_state(spark):
            query = W.limited(drop.stream(), 2, 10.0).writeStream.format("parquet").option("checkpointLocation", state).option("path", out).outputMode("append").trigger(availableNow=True).start()
            query.awaitTermination()
            kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    got = {r["event_id"]: r["allowed"] for r in spark.read.parquet(out).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True, 5: False, 6: True, 7: False, 8: True, 9: True, 11: True}  # 10 was too late
    assert kept <= 8  # a value and its timers for each of the two users
