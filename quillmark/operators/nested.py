"""Values nested in JSON: every string and key with its path, and what among them is not to be kept.

One level a round: ``variant_explode`` opens objects and arrays in the rows that still
hold one, and the rest are leaves. Each round is written, so the plan does not grow
with the depth, and only rows with something to open go on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import field
from .storage import save


def leaves(rows: DataFrame) -> DataFrame:
    """``id, path, value``: all strings and keys in the JSON text of ``id, json`` rows; a key's path ends in ``~``.

    A text that is no JSON is one leaf at ``$``; a null has none. Numbers, booleans and nulls are no strings.
    """
    spark = rows.sparkSession
    parsed = rows.select("id", "json", F.try_parse_json("json").alias("v"))
    found = [parsed.filter("json IS NOT NULL AND v IS NULL").select("id", F.lit("$").alias("path"), F.col("json").alias("value"))]
    front = parsed.filter("v IS NOT NULL").select("id", F.lit("$").alias("path"), "v")
    while True:
        kind = F.schema_of_variant("v")
        found.append(save(front.filter(kind == "STRING").select("id", "path", F.variant_get("v", "$", "string").alias("value")), "leaves"))
        opened = front.filter(F.startswith(kind, F.lit("OBJECT")) | F.startswith(kind, F.lit("ARRAY"))).select("id", "path", F.col("v").alias("held"))
        inner = opened.lateralJoin(spark.tvf.variant_explode(F.col("held").outer()))
        step = F.when(F.col("key").isNotNull(), F.concat(F.lit("."), "key")).otherwise(F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        written = save(inner.select("id", F.concat("path", step).alias("path"), "key", F.to_json("value").alias("json")), "opened")
        if written.isEmpty():
            break
        found.append(written.filter("key IS NOT NULL").select("id", F.concat("path", F.lit("~")).alias("path"), F.col("key").alias("value")))
        front = written.select("id", "path", F.parse_json("json").alias("v"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def denied(rows: DataFrame) -> DataFrame:
    """``id, path, kinds`` of every string or key that holds content which is not to be kept; rows without any may be stored."""
    return leaves(rows).select("id", "path", field.denied_kinds(F.col("value")).alias("kinds")).filter(F.size("kinds") > 0)
