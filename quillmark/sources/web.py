"""Pages, listings, sitemaps, robots rules and literature XML as frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..operators.storage import save


def crawl_frontier(pages: DataFrame, most: int) -> DataFrame:
    """``page_id, href, step``: distinct links of each page in order of first sight, ``most`` of them."""
    links = pages.select("page_id", F.posexplode(X.html_links(F.col("html"))).alias("pos", "href")).groupBy("page_id", "href").agg(F.min("pos").alias("pos"))
    ranked = links.withColumn("step", F.row_number().over(Window.partitionBy("page_id").orderBy("pos")).cast("long"))
    return ranked.filter(F.col("step") <= most).select("page_id", "href", "step")


def crawl(seeds: DataFrame, links: DataFrame, most: int = 6) -> DataFrame:
    """``seed, url, step``: the first ``most`` pages reached from each seed, breadth first, links of a page in their order.

    ``links``: ``url, href`` of pages that can be read. One join a level, with what
    was visited left out; a crawl of ``most`` pages has fewer levels than that.
    """
    every = links.select("url", "href").distinct()
    visited = save(seeds.select("seed", F.col("url"), F.lit(1).cast("long").alias("step")), "visited")
    front = visited
    for _ in range(most - 1):
        seen = visited.groupBy("seed").agg(F.max("step").alias("n"))
        found = front.join(every, "url").select("seed", F.col("href").alias("url"), "step").groupBy("seed", "url").agg(F.min("step").alias("parent"))
        new = found.join(visited.select("seed", "url"), ["seed", "url"], "left_anti").join(seen, "seed").filter(F.col("n") < most)
        place = F.row_number().over(Window.partitionBy("seed").orderBy("parent", "url"))  # at most the links of ``most`` pages
        front = save(new.withColumn("step", F.col("n") + place).filter(F.col("step") <= most).select("seed", "url", "step"), "front")
        if front.isEmpty():
            break
        visited = save(visited.unionByName(front), "visited")
    return visited


def in_section(entries: Column, path: str, slug: str) -> Column:
    """Sitemap entries whose path matches ``path`` and whose last part matches ``slug``."""
    return F.filter(entries, lambda e: e["loc"].rlike(path) & F.regexp_extract(e["loc"], r"([^/]+)/*$", 1).rlike(slug))


def listing_cards(pages: DataFrame, html: str = "html") -> DataFrame:
    """``page_id, card_no, day, name, link`` of cards with an epoch-millisecond date; document files are no links."""
    cards = F.regexp_extract_all(F.col(html), F.lit(r"""(?is)<div[^>]*data-date-created=["'][0-9]+["'].*?</div>"""), F.lit(0))
    rows = pages.select("page_id", F.posexplode(cards).alias("card_no", "c"))
    ms = F.try_to_number(F.regexp_extract("c", r"""data-date-created=["']([0-9]+)""", 1), F.lit("9999999999999")).cast("long")
    links = F.filter(X.html_links(F.col("c")), lambda u: ~F.lower(u).rlike(r"\.pdf|/media/"))
    name = X.collapse(X.unescape(F.regexp_replace(F.regexp_extract("c", r"""(?is)<span[^>]*class=["']name["'][^>]*>(.*?)</span>""", 1), "<[^>]*>", " ")))
    return rows.select("page_id", "card_no", F.to_date(F.timestamp_millis(ms)).alias("day"), name.alias("name"), F.get(links, F.lit(0)).alias("link"))


def sitemap(xml: Column) -> Column:
    """Array of ``loc, lastmod`` of a sitemap text."""
    entries = F.regexp_extract_all(xml, F.lit(r"(?is)<url>(.*?)</url>"), F.lit(1))
    return F.transform(entries, lambda e: F.struct(X.strip(F.regexp_extract(e, r"(?is)<loc>(.*?)</loc>", 1)).alias("loc"), F.regexp_extract(e, r"(?is)<lastmod>(.*?)</lastmod>", 1).alias("lastmod")))


def slug_title(url: Column, acronyms: tuple[str, ...] = ()) -> Column:
    """Title from the last part of a path: words capitalised, acronyms in capitals."""
    words = F.split(F.regexp_replace(F.regexp_extract(url, r"([^/]+)/*$", 1), r"\.html?$", ""), "[-_]+")
    return F.array_join(F.transform(words, lambda w: F.when(F.array_contains(F.array(*[F.lit(a) for a in acronyms] or [F.lit("")]), F.lower(w)), F.upper(w)).otherwise(F.initcap(w))), " ")


def robots_rules(files: DataFrame) -> DataFrame:
    """``host, agent, allow, pattern`` rows of ``host, body`` robots texts; consecutive agents share their rules."""
    lines = files.select("host", F.posexplode(F.split("body", r"\r?\n")).alias("n", "l")).withColumn("l", X.strip(F.regexp_replace("l", "#.*$", "")))
    kind, value = F.lower(X.strip(F.regexp_extract("l", r"^([^:]+):", 1))), X.strip(F.regexp_extract("l", r"^[^:]+:(.*)$", 1))
    rows = lines.select("host", "n", kind.alias("kind"), value.alias("value")).filter(F.col("kind").isin("user-agent", "allow", "disallow"))
    w = Window.partitionBy("host").orderBy("n")
    starts = (F.col("kind") == "user-agent") & (F.coalesce(F.lag("kind").over(w), F.lit("")) != "user-agent")
    rows = rows.withColumn("g", F.sum(starts.cast("int")).over(w))
    agents = rows.filter("kind = 'user-agent'").select("host", "g", F.lower("value").alias("agent"))
    rules = rows.filter("kind <> 'user-agent' AND value <> ''").select("host", "g", (F.col("kind") == "allow").alias("allow"), F.col("value").alias("pattern"))
    return agents.join(rules, ["host", "g"]).select("host", "agent", "allow", "pattern")


def robots_regex(pattern: Column) -> Column:
    """Rule to anchored pattern: ``*`` any run, final ``$`` the end. Overlong or star-heavy rules never match."""
    quoted = F.regexp_replace(F.regexp_replace(pattern, r"\$$", "\x02"), r"([.+?^$(){}\[\]|\\])", r"\\$1")
    regex = F.concat(F.lit("^"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("\x02"), F.lit("$")))
    hostile = (F.length(pattern) > 200) | (F.length(pattern) - F.length(F.replace(pattern, F.lit("*"), F.lit(""))) > 10)
    return F.when(hostile, r"^\b\B").otherwise(regex)


def robots_allowed(urls: DataFrame, rules: DataFrame, agent: str) -> DataFrame:
    """``url, allowed``: the named agent's rules beat ``*``; the longest match wins, allow on ties; no match allows."""
    mine = rules.filter(F.col("agent").isin(agent.lower(), "*"))
    named = mine.groupBy("host").agg(F.max(F.col("agent") != "*").alias("named"))
    mine = mine.join(named, "host").filter(F.col("named") == (F.col("agent") != "*")).select("host", "allow", "pattern", robots_regex(F.col("pattern")).alias("rx"))
    parts = urls.select("url", F.lower(F.try_parse_url("url", F.lit("HOST"))).alias("host"), F.coalesce(F.nullif(F.regexp_extract("url", r"^[a-zA-Z]+://[^/]+(/.*)$", 1), F.lit("")), F.lit("/")).alias("path"))
    met = parts.join(mine, "host", "left").withColumn("hit", F.expr("path rlike rx"))
    best = met.groupBy("url").agg(F.max_by("allow", F.when(F.col("hit"), F.struct(F.length("pattern"), F.col("allow")))).alias("a"))
    return best.select("url", F.coalesce("a", F.lit(True)).alias("allowed"))


def host_allowed(url: Column, hosts: tuple[str, ...], denied: tuple[str, ...]) -> Column:
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    bad = F.exists(F.array(*[F.lit(x) for x in denied]), lambda x: F.contains(F.lower(url), x)) if denied else F.lit(False)
    return F.coalesce(host.isin(*hosts), F.lit(False)) & ~bad & ~F.lower(url).rlike(r"\.pdf($|\?)")


def articles(xml: DataFrame, column: str = "xml") -> DataFrame:
    """Literature records of XML documents; identifiers come from the record's own list only, not from its references."""
    rows = xml.select(F.explode(F.regexp_extract_all(column, F.lit(r"(?s)<PubmedArticle>.*?</PubmedArticle>"), F.lit(0))).alias("a"))
    own = "/PubmedArticle/PubmedData/ArticleIdList/ArticleId"
    get = lambda p: F.expr(f"xpath_string(a, \"{p}\")")
    year = F.coalesce(F.nullif(get("//JournalIssue/PubDate/Year"), F.lit("")), F.left(get("//JournalIssue/PubDate/MedlineDate"), F.lit(4)))
    doi = F.coalesce(F.nullif(get(f"{own}[@IdType='doi']"), F.lit("")), get("//Article/ELocationID[@EIdType='doi']"))
    abstract = F.expr("array_join(xpath(a, '//Abstract/AbstractText//text()'), ' ')")
    return rows.select(get("//MedlineCitation/PMID").alias("pmid"), X.collapse(get("//ArticleTitle")).alias("title"), X.collapse(abstract).alias("abstract"), get("//Journal/Title").alias("journal"), year.alias("year"), X.norm_doi(doi).alias("doi"), X.norm_pmcid(get(f"{own}[@IdType='pmc']")).alias("pmcid"))
