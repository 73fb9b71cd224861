"""Search payloads of a literature service and full texts with fallbacks, as frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

_SEARCH = "struct<esearchresult:struct<count:string,retstart:string,idlist:array<string>,querytranslation:string,errorlist:struct<phrasesnotfound:array<string>,fieldsnotfound:array<string>>,warninglist:struct<outputmessages:array<string>>>>"
_AUTHOR, _ID = "struct<name:string>", "struct<idtype:string,value:string>"
_SUMMARY = f"struct<title:string,authors:array<{_AUTHOR}>,fulljournalname:string,source:string,pubdate:string,articleids:array<{_ID}>>"


def search_pages(raw: DataFrame, column: str = "payload") -> DataFrame:
    """``ids, count, retstart, translation, errors, warnings`` of each search answer; what is missing is empty or 0."""
    found = F.from_json(column, f"r {_SEARCH}".removeprefix("r "))["esearchresult"]
    number = lambda c: F.coalesce(F.try_to_number(F.nullif(c, F.lit("")), F.lit("999999999999")).cast("long"), F.lit(0))
    none = F.array().cast("array<string>")
    errors = F.concat(F.coalesce(found["errorlist"]["phrasesnotfound"], none), F.coalesce(found["errorlist"]["fieldsnotfound"], none))
    return raw.select(
        *[c for c in raw.columns if c != column], F.coalesce(found["idlist"], none).alias("ids"), number(found["count"]).alias("count"), number(found["retstart"]).alias("retstart"), F.coalesce(found["querytranslation"], F.lit("")).alias("translation"),
        errors.alias("errors"), F.coalesce(found["warninglist"]["outputmessages"], none).alias("warnings"),
    )


def dated(term: Column, first: Column, last: Column) -> Column:
    """A search term confined to a window of entry dates."""
    day = lambda c: F.date_format(c, "yyyy/MM/dd")
    return F.concat(F.lit("("), term, F.lit(") AND ("), day(first), F.lit("[EDAT] : "), day(last), F.lit("[EDAT])"))


def summaries(raw: DataFrame, column: str = "payload") -> DataFrame:
    """A row for each id of a summary answer, in the answer's order."""
    ids = F.from_json(F.get_json_object(column, "$.result.uids"), "array<string>")
    rows = raw.select(F.posexplode(ids).alias("place", "pmid"), column)
    item = F.from_json(F.from_json(F.get_json_object(column, "$.result"), "map<string,string>")[F.col("pmid")], _SUMMARY)
    rows = rows.select("place", "pmid", item.alias("i"))
    doi = F.coalesce(F.try_element_at(F.filter("i.articleids", lambda a: a["idtype"] == "doi"), F.lit(-1))["value"], F.lit(""))
    blank = lambda c: F.coalesce(c, F.lit(""))
    home = F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), "pmid", F.lit("/"))
    return rows.select(
        "place", "pmid", F.regexp_replace(X.strip(blank(F.col("i.title"))), r"[.]+$", "").alias("title"), blank(F.array_join(F.transform("i.authors", lambda a: blank(a["name"])), ", ")).alias("authors"),
        blank(F.coalesce(F.nullif(F.col("i.fulljournalname"), F.lit("")), F.col("i.source"))).alias("journal"), F.left(blank(F.col("i.pubdate")), F.lit(4)).alias("year"), doi.alias("doi"), F.when(doi != "", F.concat(F.lit("https://doi.org/"), doi)).otherwise(home).alias("url"),
    )


def full_text(markup: Column, fallback: Column, least: int = 500, most: int = 200_000) -> Column:
    """``text`` and ``origin``: the plain text of mark-up, or the fallback where that is too short."""
    plain = F.left(X.html_text(markup), F.lit(most))
    whole = F.length(plain) >= least
    return F.struct(F.when(whole, plain).otherwise(F.coalesce(fallback, F.lit(""))).alias("text"), F.when(whole, "full text").otherwise("fallback").alias("origin"))


def latest_date(html: Column) -> Column:
    """The last of the dates in ``datetime`` attributes; null without one."""
    return F.array_max(F.transform(F.regexp_extract_all(html, F.lit(r"""datetime=["']?([0-9]{4}-[0-9]{2}-[0-9]{2})"""), F.lit(1)), lambda x: F.try_to_date(x)))
