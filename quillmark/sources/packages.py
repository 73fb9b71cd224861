"""Evidence packages, literature and registry payloads, state and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..functions import text as X


def read_package(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Claims (without excluded ones), sources and excluded ids of a package JSON."""
    raw = spark.read.json(path, multiLine=True)
    claims = raw.select(F.explode("claims").alias("c")).select("c.*")
    sources = raw.select(F.explode("sources").alias("s")).select("s.*")
    excluded = raw.select(F.explode("excludedClaimIds").alias("claimId"))
    return claims.join(excluded, "claimId", "left_anti"), sources, excluded


LITERATURE = "struct<hitCount:int,nextCursorMark:string,resultList:struct<result:array<struct<id:string,title:string,authorString:string,journalTitle:string,pubYear:string,doi:string,pmid:string,pmcid:string,abstractText:string,isOpenAccess:string,license:string>>>>"
REGISTRY = "struct<totalCount:int,studies:array<struct<protocolSection:struct<identificationModule:struct<nctId:string,briefTitle:string>,statusModule:struct<overallStatus:string,lastUpdatePostDateStruct:struct<date:string>>,descriptionModule:struct<briefSummary:string>,conditionsModule:struct<conditions:array<string>>,designModule:struct<phases:array<string>>>>>>"


def literature(payloads: DataFrame, column: str = "json") -> DataFrame:
    """Records of literature search pages: trimmed titles without a final dot, and a URL by the first id there is."""
    rows = payloads.select(F.explode(F.from_json(column, LITERATURE)["resultList"]["result"]).alias("r")).select("r.*")
    doi, pmid = X.norm_doi(F.col("doi")), X.norm_pmid(F.col("pmid"))
    url = F.when(doi != "", F.concat(F.lit("https://doi.org/"), doi)).otherwise(F.concat(F.lit("urn:record:"), F.coalesce(F.nullif(pmid, F.lit("")), F.col("id"))))
    return rows.select(F.regexp_replace(X.strip(F.col("title")), r"\.+$", "").alias("title"), doi.alias("doi"), pmid.alias("pmid"), X.norm_pmcid(F.col("pmcid")).alias("pmcid"), F.col("journalTitle").alias("journal"), "pubYear", F.coalesce("abstractText", F.lit("")).alias("abstract"), (F.col("isOpenAccess") == "Y").alias("open"), F.coalesce("license", F.lit("")).alias("license"), url.alias("url"))


def registry(payloads: DataFrame, column: str = "json") -> DataFrame:
    """Trial records of registry pages, with their evidence type."""
    p = payloads.select(F.explode(F.from_json(column, REGISTRY)["studies"]).alias("s")).select("s.protocolSection.*")
    status = F.upper(F.col("statusModule.overallStatus"))
    kind = F.when(status.isin("COMPLETED", "TERMINATED", "WITHDRAWN"), "completed").otherwise("ongoing")
    return p.select(X.norm_trial_id(F.col("identificationModule.nctId")).alias("trial_id"), F.col("identificationModule.briefTitle").alias("title"), kind.alias("evidence_type"), F.col("statusModule.lastUpdatePostDateStruct.date").alias("updated"), F.coalesce(F.col("descriptionModule.briefSummary"), F.lit("")).alias("abstract"), F.array_join("conditionsModule.conditions", "; ").alias("conditions"), F.array_join("designModule.phases", "; ").alias("phases"))


def archivable(open_access, license_, tokens: tuple[str, ...] = ("cc by", "cc-by", "cc0", "public domain")):
    return open_access & F.exists(F.array(*[F.lit(t) for t in tokens]), lambda t: F.contains(F.lower(license_), t))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that were found good, the newest first: a row for each save."""
    try:
        return [r["version"] for r in spark.read.schema("version long").json(f"{path}/good").orderBy(F.desc("version")).collect()]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise


def save_validated(df: DataFrame, path: str, problems) -> None:
    """Write a new version, read it again, and name it as good only if no row has a problem.

    No earlier version is touched, so that a crash at any point leaves the last good one.
    """
    spark = df.sparkSession
    version = max(_versions(spark, path), default=0) + 1
    folder = f"{path}/version={version}"
    df.write.mode("overwrite").parquet(folder)
    if not spark.read.parquet(folder).filter(problems).isEmpty():
        raise ValueError("the rows do not pass; the last good version stays")
    spark.range(1).select(F.lit(version).alias("version")).coalesce(1).write.mode("append").json(f"{path}/good")


def load_good(spark: SparkSession, path: str, problems) -> DataFrame:
    """The newest good version that can be read and still passes."""
    for version in _versions(spark, path):
        try:
            now = spark.read.parquet(f"{path}/version={version}")
            if now.filter(problems).isEmpty():
                return now
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
    raise FileNotFoundError(f"no good version in {path}")


def append_history(rows: DataFrame, path: str, run_id: str) -> None:
    """Coverage of a run behind that of earlier runs."""
    rows.withColumn("run_id", F.lit(run_id)).withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)


def append_journal(spark: SparkSession, path: str, run_id: str, event: str, detail: str) -> None:
    spark.range(1).select(F.current_timestamp().alias("ts"), F.lit(run_id).alias("runId"), F.lit(event).alias("event"), F.lit(detail).alias("detail")).write.mode("append").json(path)


def append_package(base: DataFrame, new: DataFrame, run_id: str) -> DataFrame:
    """New records behind the old, stamped with the run; columns may differ."""
    return base.unionByName(new.withColumn("run_id", F.lit(run_id)), allowMissingColumns=True)


def report(counts: DataFrame, title: str) -> DataFrame:
    """A Markdown table of all columns as one row ``report``."""
    columns = counts.columns
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), F.lit(" |"))
    head = f"# {title}\n\n| {' | '.join(columns)} |\n|{'---|' * len(columns)}\n"
    return counts.select(line.alias("l")).agg(F.concat(F.lit(head), F.array_join(F.sort_array(F.collect_list("l")), "\n")).alias("report"))
