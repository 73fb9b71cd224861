"""Session helpers of the subpackage: shared folder, materialised tables, sizes."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it: space and 0x09 to 0x0D.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in a single-process session without one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: what follows survives a lost executor without running the
    steps before it again, and their shuffle files can be freed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    schema = df.schema
    del df
    free(spark)
    return spark.read.schema(schema).parquet(path)


def keyed(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``key, doc_id, text`` and the ``carry`` columns as ``_c0, _c1`` ...; keys are distinct.

    The key is ``doc_id`` where that tells all rows apart, else a row's place in a
    copy that is written for it.
    """
    rest = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry or [])]
    doc_id, text = F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    rows, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if rows == ids:
        return docs.select(doc_id.alias("key"), doc_id, text, *rest)
    return materialise(docs.select(F.monotonically_increasing_id().alias("key"), doc_id, text, *rest), "rows")


def free(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
