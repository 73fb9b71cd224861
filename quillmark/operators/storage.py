"""Written intermediates and rows in order, for steps that cut lineage or need running numbers."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows up to which a side whose size was counted is broadcast.
FEW = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in a single-process session without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def save(df: DataFrame, name: str) -> DataFrame:
    """A written table in the shared folder; it outlives lost executors and is not computed again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small(df: DataFrame, most: int = FEW) -> DataFrame:
    """Marked for broadcast if it has no more than ``most`` rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def in_order(rows: DataFrame, *order: Column | str) -> DataFrame:
    """The rows dealt to ranges of ``order`` and written, each with the number ``_b`` of its range.

    Running sums then need a window within a range, and the short list of ranges
    (one for each task) to carry over.
    """
    return save(rows.repartitionByRange(*order).withColumn("_b", F.spark_partition_id()), "ordered")


def running(rows: DataFrame, sums: dict[str, Column], *order: Column | str, by: tuple[str, ...] = (), include: bool = True) -> DataFrame:
    """Running totals of ``sums`` in ``order``, within each ``by``, with (or without) the row itself.

    No range is larger than a task's share, whatever the size of a group.
    """
    cols = {f"_{k}": v.cast("long") for k, v in sums.items()}
    keys = [F.coalesce(F.col(b).cast("string"), F.lit("")).alias(f"_g{i}") for i, b in enumerate(by)]
    groups = [f"_g{i}" for i in range(len(by))]
    held = in_order(rows.select("*", *keys).withColumns(cols), *groups, *order)
    parts = held.groupBy("_b", *groups).agg(*[F.sum(c).alias(f"{c}p") for c in cols])
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("_b", *groups, *[F.coalesce(F.sum(f"{c}p").over(before), F.lit(0)).alias(f"{c}c") for c in cols])
    within = Window.partitionBy("_b", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if include else -1)
    totals = [(F.col(f"{c}c") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(k) for k, c in zip(sums, cols, strict=True)]
    return held.join(carried, ["_b", *groups]).select(*rows.columns, *totals)
