"""Column functions: normalisers, keys, mark-up and sentences. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(x: Column) -> Column:
    """Without white space at either end (``trim`` takes spaces only)."""
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def empty_to_null(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))


def collapse(x: Column) -> Column:
    return strip(F.regexp_replace(x, r"\s+", " "))


def title_of(text: Column) -> Column:
    """The first line."""
    return F.substring_index(text, "\n", 1)


def norm_doi(x: Column) -> Column:
    x = F.lower(strip(F.coalesce(x, F.lit(""))))
    return strip(F.regexp_replace(F.regexp_replace(x, r"^https?://(dx\.)?doi\.org/", ""), r"^doi:\s*", ""))


def norm_pmid(x: Column) -> Column:
    return F.regexp_extract(F.coalesce(x, F.lit("")), r"[0-9]+", 0)


def norm_pmcid(x: Column) -> Column:
    digits = F.regexp_extract(F.upper(F.coalesce(x, F.lit(""))), r"(?:PMC)?([0-9]+)", 1)
    return F.when(digits != "", F.concat(F.lit("PMC"), digits)).otherwise("")


def norm_trial_id(x: Column) -> Column:
    return F.regexp_extract(F.upper(F.coalesce(x, F.lit(""))), r"NCT[0-9]{8}", 0)


def norm_url(x: Column) -> Column:
    """Lower case without scheme, ``www.`` and trailing slashes; query and fragment stay."""
    x = F.regexp_replace(F.lower(strip(F.coalesce(x, F.lit("")))), r"^https?://", "")
    return F.regexp_replace(F.regexp_replace(x, r"^www\.", ""), "/+$", "")


def canonical_url(x: Column) -> Column:
    """Scheme, host and path."""
    x = F.replace(F.replace(x, F.lit("&amp;"), F.lit("&")), F.lit("\\"), F.lit("/"))
    return F.concat(F.try_parse_url(x, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(x, F.lit("HOST")), F.coalesce(F.try_parse_url(x, F.lit("PATH")), F.lit("")))


def norm_title(x: Column) -> Column:
    return collapse(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}_\s]", " "))


def content_hash(*parts: Column) -> Column:
    """SHA-256 over the stripped lower-case parts, each closed by 0x1F."""
    return F.sha2(F.concat(*[F.concat(F.lower(strip(F.coalesce(p, F.lit("")))), F.lit("\x1f")) for p in parts]), 256)


def identity(**tagged: Column) -> Column:
    """``tag:value`` of the first value that is not empty, 200 characters at most."""
    return F.left(F.coalesce(*[F.concat(F.lit(f"{tag}:"), F.nullif(v, F.lit(""))) for tag, v in tagged.items()]), F.lit(200))


def reason_category(x: Column) -> Column:
    return F.substring_index(F.substring_index(x, ":", 1), ";", 1)


def sanitise(x: Column, most: int = 300) -> Column:
    return F.left(strip(F.replace(F.regexp_replace(x, r"[\x00-\x1f\x7f]", " "), F.lit("::"), F.lit(": :"))), F.lit(most))


def clip_sentence(x: Column, most: int = 420) -> Column:
    """Texts above ``most`` characters end at a word, with dots."""
    return F.when(F.length(x) > most, F.concat(F.regexp_replace(F.left(x, F.lit(most - 3)), r"\s\S*$", ""), F.lit("..."))).otherwise(x)


def html_title(html: Column) -> Column:
    """Second of three or more parts between bars, else the first."""
    parts = F.split(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), r"\|")
    return strip(F.when(F.size(parts) >= 3, F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(0))))


def unescape(x: Column) -> Column:
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(sign))
    return x


def html_text(html: Column, most: int | None = None) -> Column:
    """Visible text: no scripts, styles, navigation, header or footer; tags to spaces."""
    for tag in ("script", "style", "nav", "footer", "header"):
        html = F.regexp_replace(html, rf"(?is)<{tag}\b.*?</{tag}>", " ")
    x = collapse(unescape(F.regexp_replace(html, "(?s)<[^>]*>", " ")))
    return F.left(x, F.lit(most)) if most else x


def html_links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""(?i)href=["']([^"']+)["']"""), F.lit(1))


MARK = "\x01"


def sentences(text: Column, least: int = 40, most: int | None = None, openers: str = "A-Z0-9(") -> Column:
    """Sentences of the collapsed text: split after ``.!?`` before an opener, kept by length."""
    parts = F.split(F.regexp_replace(collapse(text), rf"([.!?])\s+([{openers}])", f"$1{MARK}$2"), MARK)
    return F.filter(parts, lambda s: (F.length(s) >= least) & (F.length(s) <= most if most else F.lit(True)))


def drop_label(text: Column) -> Column:
    """Without a leading ``ALLCAPS:`` label."""
    return F.regexp_replace(text, r"^[A-Z][A-Z /&-]{2,}:\s*", "")


def redact_secrets(x: Column) -> Column:
    return F.regexp_replace(x, r"(?i)(?:password|token|secret|api[_-]?key)\s*=\s*\S+|AKIA[0-9A-Z]{16}", "[redacted]")


def render_cell(x: Column) -> Column:
    return F.coalesce(F.array_join(x, "; "), F.lit(""))


def candidate_key(record: dict[str, Column]) -> dict[str, Column]:
    """Identity keys of a record whose fields go by several names: the first name that holds something counts.

    ``record``: the columns there are, by name.
    """

    def first(*names: str) -> Column:
        held = [F.nullif(record[n], F.lit("")) for n in names if n in record]
        return F.coalesce(*held, F.lit("")) if held else F.lit("")

    title, abstract = first("title"), first("abstract", "abstractText")
    return {
        "doi": norm_doi(first("doi")), "pmid": norm_pmid(first("pmid", "pubmedId")), "pmcid": norm_pmcid(first("pmcid", "pmcId")), "trial_id": norm_trial_id(first("nctId", "trialId")), "canonical_url": norm_url(first("canonicalUrl", "url")),
        "content_hash": content_hash(title, abstract), "normalized_title": norm_title(title),
    }
