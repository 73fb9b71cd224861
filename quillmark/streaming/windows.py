"""Structured Streaming forms: watermarked windows, sessions, de-duplication, rate limits, daily runs."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import shared_folder as shared


def event_stream(spark: SparkSession, sf_dir: str, files_a_trigger: int = 1) -> DataFrame:
    """The events table as a file stream; ``ts`` becomes a timestamp, which watermarks need."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger)
    stream = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def run_once(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run what there is (``availableNow``) into a Parquet table of the shared folder and read it."""
    spark = stream.sparkSession
    base = f"{shared(spark)}/{name}-{uuid.uuid4().hex}"
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/state").outputMode(mode).trigger(availableNow=True).start(f"{base}/out")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def tumbling(events: DataFrame, width: str, late: str) -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str, late: str) -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def first_seen(events: DataFrame, keys: list[str], late: str) -> DataFrame:
    """Rows whose key has not come before within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB for queries that start inside: looked up by key on local disk behind Bloom filters, changes saved to the checkpoint."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def daily_run(spark: SparkSession, stream: DataFrame, table: str, key: str, ttl: tuple[str, str] | None = None) -> None:
    """Adds rows whose key has not come in any run before, and ends when the input is read up.

    Keys are state: a micro-batch looks up its own keys in its partitions of the state store
    and reads nothing of the table. The batch number names the output folder, so that a
    retried batch overwrites itself. ``ttl`` (event-time column, how long) lets keys go:
    what comes later than that is dropped, and so never taken for new. A null key is a key.
    """
    rows = stream.withWatermark(*ttl).dropDuplicatesWithinWatermark([key]) if ttl else stream.dropDuplicates([key])

    def add(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    with keyed_state(spark):
        rows.writeStream.foreachBatch(add).option("checkpointLocation", f"{table}-state").trigger(availableNow=True).start().awaitTermination()


def limited(events: DataFrame, most: int, seconds: float, late: str = "1 minute") -> DataFrame:
    """``user_id, event_id, allowed``: at most ``most`` requests of a user within ``seconds``, as a stateful stream.

    Requests of a user in a batch are held together and come by time, then number; refused ones leave no trace. A
    user's state holds at most ``most`` times and is let go by an event-time timer once the
    watermark has passed the last of them by ``seconds``; requests later than the watermark
    are dropped. Start the query inside ``keyed_state``.
    """
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class Limit(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.times = handle.getValueState("times", "at array<double>")

        def _held(self) -> list[float]:
            return list(self.times.get()[0]) if self.times.exists() else []

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
            times = self._held()
            came = pd.concat(list(rows)).sort_values(["at", "event_id"])
            out = []
            for r in came.itertuples():
                times = [t for t in times if t > r.at - seconds]
                ok = len(times) < most
                if ok:
                    times.append(r.at)
                out.append((key[0], r.event_id, ok))
            self.times.update((times,))
            if times:
                self.handle.registerTimer(int((max(times) + seconds) * 1000) + 1)
            yield pd.DataFrame(out, columns=["user_id", "event_id", "allowed"])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
            # a timer of an older request finds younger ones, whose own timers follow
            now = expiredTimerInfo.getExpiryTimeInMs() / 1000
            times = [t for t in self._held() if t > now - seconds]
            self.times.update((times,)) if times else self.times.clear()
            yield pd.DataFrame({"user_id": pd.Series(dtype="int64"), "event_id": pd.Series(dtype="int64"), "allowed": pd.Series(dtype="bool")})

        def close(self) -> None:
            pass

    rows = events.withWatermark("ts", late).select("user_id", "event_id", "ts", F.col("ts").cast("double").alias("at"))
    return rows.groupBy("user_id").transformWithStateInPandas(Limit(), "user_id long, event_id long, allowed boolean", "Append", "EventTime")
