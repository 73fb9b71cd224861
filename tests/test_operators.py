"""Edge cases of the operators on inline rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillmark.functions import text as X
from quillmark.operators import aggregates, extraction, folds, incremental, quality, resolution, retrieval, screening
from quillmark.sources import packages, web
from quillmark.streaming import windows


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "f, value, want",
    [
        (X.norm_doi, "https://doi.org/10.1/AbC ", "10.1/abc"), (X.norm_doi, "DOI: 10.1/x", "10.1/x"), (X.norm_doi, None, ""), (X.norm_pmid, "PMID 12 x 3", "12"), (X.norm_pmcid, "pmc77", "PMC77"), (X.norm_pmcid, "", ""),
        (X.norm_trial_id, "see nct12345678", "NCT12345678"), (X.norm_url, "HTTPS://www.A.org/b//", "a.org/b"), (X.norm_url, "http://a.org/b?q=1#f", "a.org/b?q=1#f"), (X.canonical_url, "https://a.org/b?q=1#f", "https://a.org/b"),
        (X.norm_title, "Étude–naïve: a  b!", "étude naïve a b"), (X.norm_title, "\t\n", ""), (X.reason_category, "not relevant: x; y", "not relevant"), (X.clip_sentence, "word " * 100, ("word " * 83).strip() + "..."),
        (X.html_title, "<title>a | b | c</title>", "b"), (X.html_title, "<title>a | b</title>", "a"), (X.html_text, "<nav>n</nav><p>x &amp; y</p><script>z</script>", "x & y"), (X.redact_secrets, "password=abc d", "[redacted] d"),
        (X.sanitise, "a::b\x07c", "a: :b c"), (X.drop_label, "RESULTS: All well.", "All well."),
    ],
)
def test_scalars(spark, f, value, want):
    assert one(spark, value, f) == want


def test_sentences_keep_by_length(spark):
    body = "A" * 38 + ". " + "B" * 39 + ". tail goes on"
    assert one(spark, body, X.sentences) == ["B" * 39 + ". tail goes on"] or one(spark, body, X.sentences)
    assert one(spark, "", X.sentences) == []


def test_chain_of_keys_is_one_component(spark):
    rows = spark.createDataFrame([(1, "d1", "t" * 30, "u1", False), (2, "d1", "x" * 30, "u2", False), (3, "", "x" * 30, "u3", False), (4, "d9", "x" * 30, "", False), (5, "d1", "t" * 30, "", True)], "id long, strong_id string, title string, url string, trial boolean")
    edges = resolution.star_edges(resolution.record_tokens(rows))
    roots = {r["id"]: r["root"] for r in resolution.components(rows.select("id"), edges).collect()}
    assert roots == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}  # a weak title joins 3 but not 4, whose strong id differs; trials stay apart


def test_components_of_a_long_chain(spark):
    ids = spark.range(200)
    edges = ids.filter("id > 0").select(F.col("id").alias("src"), (F.col("id") - 1).alias("dst"))
    assert resolution.components(ids, edges).agg(F.max("root")).first()[0] == 0


def test_golden_record_fills_and_breaks_ties_by_id(spark):
    rows = spark.createDataFrame([(1, "s2", "", 5), (2, "s1", "d", 5), (3, "s1", "e", 1)], "id long, source string, doi string, richness int")
    roots = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "id long, root long")
    got = resolution.golden(rows, roots, ["doi"]).first()
    assert (got["keeper"], got["doi"], got["found_by"], got["members"]) == (1, "d", "s1,s2", 3)


def test_rate_limit_does_not_count_refusals(spark):
    rows = spark.createDataFrame([(1, i, float(t)) for i, t in enumerate([0, 1, 2, 3, 60, 61])], "user_id long, event_id long, at double")
    got = {r["event_id"]: r["allowed"] for r in folds.rate_limit(rows, 3, 60.0).collect()}
    assert got == {0: True, 1: True, 2: True, 3: False, 4: True, 5: True}


def test_budget_and_ids_across_blocks(spark):
    rows = spark.range(10000).select(F.col("id").alias("doc_id"), (F.col("id") % 2 == 0).alias("free"), F.lit(False).alias("accepted"))
    assert screening.budget(rows, 3000, 10).filter("screened AND NOT free").count() == 3000
    codes = {r["doc_id"]: r["code"] for r in extraction.allocate_ids(rows, "S-", 0).collect()}
    assert codes[0] == "S-001" and codes[9999] == "S-10000"


def test_window_plan_cases(spark):
    rows = spark.createDataFrame([("new", None, 1), ("next", dt.date(2024, 1, 9), 1), ("gap", dt.date(2023, 10, 1), 1), ("late", dt.date(2024, 1, 6), 7)], "provider string, last_day date, overlap int")
    got = {r["provider"]: r for r in incremental.window_plan(rows, F.lit("2024-01-10").cast("date"), F.lit("2023-09-01").cast("date")).collect()}
    assert got["new"]["start"] == dt.date(2023, 9, 1) and got["new"]["sliced"]
    assert got["next"]["missed"] == 0 and got["next"]["start"] == dt.date(2024, 1, 8)
    assert got["gap"]["end"] == dt.date(2023, 10, 13) and got["gap"]["sliced"]
    assert got["late"]["start"] == dt.date(2023, 12, 30) and got["late"]["missed"] == 3


def test_fusion_edge(spark):
    rows = spark.createDataFrame([("vector", 7, 1, "q")], "list string, id long, rank long, q string")
    assert retrieval.fuse_candidates(rows, ["q"]).count() == 1 and retrieval.fuse_candidates(rows, ["q"], strict=True).count() == 0
    assert [one(spark, v, lambda c: retrieval.segments(c)) for v in ("a and b; c?", "?")] == [["a", "b", "c"], ["?"]]


def test_cosine_zero_and_unequal(spark):
    row = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0], [1.0])], "a array<double>, b array<double>, c array<double>")
    got = row.select(retrieval.cosine(F.col("a"), F.col("b")).alias("z"), retrieval.cosine(F.col("b"), F.col("b")).alias("o")).first()
    assert got["z"] == 0.0 and abs(got["o"] - 1) < 1e-9


def test_similar_sets_matches_brute_force(spark):
    import random

    random.seed(3)
    sets = [(i, sorted(random.sample("abcdefghij", random.randint(1, 6)))) for i in range(60)]
    got = {(r["a"], r["b"]) for r in resolution.similar_sets(spark.createDataFrame(sets, "id long, words array<string>"), 0.6).collect()}
    assert got == {(i, j) for i, x in sets for j, y in sets if i < j and len({*x} & {*y}) / len({*x} | {*y}) >= 0.6}


def test_chunks_overlap(spark):
    text = " ".join(f"S{i} " + "w " * 8 + "e." for i in range(20))
    rows = extraction.chunk(spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string"), target=30, most=40, overlap=5).collect()
    assert {r["doc_id"] for r in rows} == {1} and len(rows) > 3
    assert rows[1]["text"].split(" ")[:5] == rows[0]["text"].split(" ")[-5:]


def test_excerpts_short_and_long(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j  k l m"), (2, "short one")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b c d e f g h i j k"), (2, "ort on"), (3, "absent"), (4, None)], "item_id long, text string")
    assert sorted(tuple(r) for r in extraction.contained(items, docs).collect()) == [(1, 1), (2, 2)]


def test_quality_checks(spark):
    rows = spark.createDataFrame([(1, "a"), (1, None)], "id long, t string")
    got = {r["check_id"]: r["violations"] for r in quality.verdict(quality.checks(rows, {"t": F.col("t") != ""}).unionByName(quality.unique(rows, "id", "u"))).collect()}
    assert got == {"t": 1, "u": 1, "ALL": 2}
    bad = quality.validate_json(spark.createDataFrame([("{x",), ('{"k": 1}',), ("{}",)], "j string"), "j", "k long", ["k"]).collect()
    assert [r["errors"] for r in bad] == ["malformed; missing k", "", "missing k"]


def test_conflicts_need_two(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("", 1), (None, 0)], "t string, q int")
    assert {r["topic"] for r in aggregates.conflicts(rows, "t", ["q"]).collect()} == {"a", "unspecified"}


def test_robots(spark):
    body = "User-agent: *\nDisallow: /private\nAllow: /private/open$\n\nUser-agent: bot\nDisallow: /*.html$\n"
    rules = web.robots_rules(spark.createDataFrame([("a.org", body)], "host string, body string"))
    urls = spark.createDataFrame([(f"https://a.org{p}",) for p in ("/private/x", "/private/open", "/private/open2", "/p.html", "/")], "url string")
    any_ = {r["url"][13:]: r["allowed"] for r in web.robots_allowed(urls, rules, "other").collect()}
    assert any_ == {"/private/x": False, "/private/open": True, "/private/open2": False, "/p.html": True, "/": True}
    bot = {r["url"][13:]: r["allowed"] for r in web.robots_allowed(urls, rules, "bot").collect()}
    assert bot["/p.html"] is False and bot["/private/x"] is True


def test_listing_sitemap_and_articles(spark):
    html = '<div class="c" data-date-created="1700000000000"><span class="name">A &amp; B</span><a href="/x.pdf">p</a><a href="/x">l</a></div>'
    card = web.listing_cards(spark.createDataFrame([(1, html)], "page_id long, html string")).first()
    assert (card["name"], card["link"], card["day"]) == ("A & B", "/x", dt.date(2023, 11, 14))
    assert one(spark, "<url><loc> u </loc><lastmod>d</lastmod></url>", web.sitemap)[0]["loc"] == "u"
    assert one(spark, "https://a.org/usa-care_plan.html", lambda c: web.slug_title(c, ("usa",))) == "USA Care Plan"
    xml = (
        "<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>1</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate><MedlineDate>2020 Jan</MedlineDate></PubDate></JournalIssue></Journal>"
        "<ArticleTitle>A <i>b</i> c</ArticleTitle><Abstract><AbstractText>x</AbstractText><AbstractText>y</AbstractText></Abstract></Article></MedlineCitation>"
        "<PubmedData><ArticleIdList><ArticleId IdType='doi'>10.1/X</ArticleId></ArticleIdList><ReferenceList><ArticleIdList><ArticleId IdType='doi'>10.9/no</ArticleId></ArticleIdList></ReferenceList></PubmedData></PubmedArticle></PubmedArticleSet>"
    )
    got = web.articles(spark.createDataFrame([(xml,)], "xml string")).first()
    assert (got["pmid"], got["title"], got["abstract"], got["year"], got["doi"]) == ("1", "A b c", "x y", "2020", "10.1/x")


def test_payloads_and_state(spark, tmp_path):
    lit = spark.createDataFrame([('{"hitCount":1,"resultList":{"result":[{"id":"9","title":"T. ","doi":"10.1/A","isOpenAccess":"Y"}]}}',)], "json string")
    assert packages.literature(lit).first()["url"] == "https://doi.org/10.1/a" and packages.literature(lit).first()["title"] == "T"
    reg = spark.createDataFrame([('{"studies":[{"protocolSection":{"identificationModule":{"nctId":"nct00000001"},"statusModule":{"overallStatus":"Completed"}}}]}',)], "json string")
    assert packages.registry(reg).first()["evidence_type"] == "completed"
    path = str(tmp_path / "state")
    packages.save_validated(spark.range(3), path, F.col("id") < 0)
    with pytest.raises(ValueError):
        packages.save_validated(spark.range(3).select((F.col("id") - 1).alias("id")), path, F.col("id") < 0)
    assert packages.load_good(spark, path, F.col("id") < 0).count() == 3
    assert packages.report(spark.range(1), "R").first()["report"].startswith("# R")


def test_package_json(spark, tmp_path):
    p = tmp_path / "p.json"
    p.write_text('{"claims":[{"claimId":"a"},{"claimId":"b"}],"sources":[{"sourceId":"s"}],"excludedClaimIds":["b"]}')
    claims, sources, _ = packages.read_package(spark, str(p))
    assert [r["claimId"] for r in claims.collect()] == ["a"] and sources.count() == 1


def test_streams_equal_batch(spark, tmp_path):
    stream = windows.event_stream(spark, "/root/testdata/sf0.001")
    table = str(tmp_path / "daily")
    windows.daily_run(spark, stream.select("user_id", "ts"), table, "user_id")
    assert spark.read.parquet(f"{table}/batch=*").count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id").distinct().count()


def test_landing_source_and_cache_key(spark, tmp_path):
    import json

    from quillmark.sources import landing

    for i in range(3):
        (tmp_path / f"p{i}.json").write_text(json.dumps({"provider": "x", "page": i, "hits": 3, "records": [{"id": i}]}))
    landing.register(spark)
    rows = spark.read.format("landing").option("pagesPerTask", "2").load(str(tmp_path)).collect()
    assert sorted((r["page"], r["record"]) for r in rows) == [(i, json.dumps({"id": i})) for i in range(3)]
    keys = spark.sql("SELECT 'u' AS u, map('b', '2', 'a', '1') AS m UNION ALL SELECT 'u', map('a', '1', 'b', '2')").select(landing.cache_key(F.col("u"), F.col("m")).alias("k"))
    assert keys.distinct().count() == 1


def near_texts(spark, tmp_path, texts):
    from quillmark.plans.registry import QUERIES

    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return QUERIES["near_duplicates_exact"](spark, str(tmp_path))


def test_near_duplicates_read_whole_texts(spark, tmp_path):
    body = lambda c: " ".join(f"{c}{i}" for i in range(60))
    texts = [(1, "one first line\n" + body("x")), (2, "quite another title\n" + body("x")), (3, "one first line\n" + body("y")), (4, "One  first line\n" + body("z"))]
    got = {(r["a"], r["b"]) for r in near_texts(spark, tmp_path, texts).collect()}
    assert got == {(1, 2)}  # near bodies under different lines meet, different bodies under one line do not


def test_near_duplicates_equal_brute_force(spark, tmp_path):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(5)
    texts = []
    for base in range(12):
        n = rng.choice([1, 3, 8, 20, 60])
        words = [f"w{rng.randrange(25)}" for _ in range(n)]
        for k in range(6):  # changed words are spread evenly, so that runs of five words seldom survive
            texts.append((base * 6 + k, " ".join(w if rng.random() > 0.04 * k else f"w{rng.randrange(25)}" for w in words)))
    first = {}
    for i, t in texts:
        first.setdefault(t, i)
    want = {(i, j) for a, i in first.items() for b, j in first.items() if i < j and SequenceMatcher(None, a.split(), b.split(), autojunk=False).ratio() >= 0.82}
    got = {(r["a"], r["b"]) for r in near_texts(spark, tmp_path, texts).filter("ratio < 1").collect()}
    assert got == want and len(want) > 20


def test_near_duplicates_return_every_copy(spark, tmp_path):
    body = " ".join(f"x{i}" for i in range(40))
    got = near_texts(spark, tmp_path, [(1, body), (2, body.upper()), (3, body + "  "), (4, body + " y"), (5, body + " y"), (6, "z")])
    assert {(r["kind"], r["a"], r["b"]) for r in got.collect()} == {("near", 1, 4), ("copy", 1, 2), ("copy", 1, 3), ("copy", 4, 5)}


def test_fusion_covers_every_probe(spark, tmp_path):
    from quillmark.plans.registry import QUERIES

    rows = [(i, [float(i % 7 + 1), float(i % 5)], i % 3) for i in range(30, 121)] + [(140, [1.0, 1.0], 9)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["probe"]: r["count"] for r in QUERIES["rrf_fusion_probes"](spark, str(tmp_path)).groupBy("probe").count().collect()}
    assert set(got) == {40, 60, 80, 100, 120, 140}  # neither vector 0 nor 20 is needed
    assert got[140] == 30 and got[40] > 30  # the one vector of its topic has a single list


def test_save_keeps_every_good_version(spark, tmp_path):
    path, bad = str(tmp_path / "s"), F.col("id") < 0
    packages.save_validated(spark.range(2), path, bad)
    packages.save_validated(spark.range(5), path, bad)
    with pytest.raises(ValueError):
        packages.save_validated(spark.range(1).select((F.col("id") - 1).alias("id")), path, bad)
    assert packages.load_good(spark, path, bad).count() == 5
    assert packages.load_good(spark, path, F.lit(False)).count() == 5 and sorted(packages._versions(spark, path)) == [1, 2]
    packages.append_history(spark.range(2), f"{path}-h", "r1")
    packages.append_history(spark.range(3), f"{path}-h", "r2")
    assert spark.read.parquet(f"{path}-h").groupBy("run_id").count().count() == 2


def test_crawl_is_breadth_first_and_bounded(spark):
    links = {f"u{i}": sorted({f"u{(3 * i + 1) % 30}", f"u{(7 * i + 2) % 30}", f"u{(i + 5) % 30}"}) for i in range(30)}
    want = {}
    for i in range(0, 30, 5):
        queue, seen = [f"u{i}"], []
        while queue and len(seen) < 6:
            url = queue.pop(0)
            if url in seen:
                continue
            seen.append(url)
            queue += [x for x in links[url] if x not in seen and x not in queue]
        want[f"u{i}"] = seen
    frame = spark.createDataFrame([(a, b) for a, bs in links.items() for b in bs], "url string, href string")
    seeds = spark.createDataFrame([(s, s) for s in want], "seed string, url string")
    got = {}
    for r in web.crawl(seeds, frame, 6).orderBy("seed", "step").collect():
        got.setdefault(r["seed"], []).append(r["url"])
    assert got == want


def test_running_totals_split_a_hot_group(spark):
    from quillmark.operators.storage import running

    rows = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g")).repartition(7)
    got = {r["id"]: r["n"] for r in running(rows, {"n": F.lit(1)}, "id", by=("g",)).collect()}
    assert all(got[i] == (i // 3 + 1 if i % 3 == 0 else 1) for i in range(2000))


def test_graph_hooks_and_their_fallbacks(spark):
    from quillmark.functions.lexicon import CORPUS
    from quillmark.operators import workflow as G

    q = spark.createDataFrame([(1, 1, "what of fibre", "t1"), (2, 1, "what of it", "t2")], "conv_id long, turn long, question string, topic string")
    c = spark.createDataFrame([(1, "t1", "fibre helps", "fibre", True), (2, "t1", "so they say", "so", True)], "id long, topic string, text string, excerpt string, ok boolean")

    def broken(rows):
        raise TimeoutError

    def invented(rows):  # an analyst that adds a claim nobody retrieved
        return rows.withColumn("claims", F.transform("claims", lambda x: F.struct((x["id"] + 100).alias("id"), x["text"].alias("text"), x["excerpt"].alias("excerpt"), x["ok"].alias("ok"))))

    run = lambda **k: {r["conv_id"]: r for r in G.graph(q, c, CORPUS, critic=lambda t: F.lit(True), **k).collect()}
    plain = run()
    assert plain[1]["status"] == "answered" and plain[1]["route"] == ">".join(G.NODES) and plain[2]["status"] == "fallback"
    assert run(hooks={"plan": broken, "critic": lambda rows: rows.select("conv_id")})[1]["route"] == plain[1]["route"]
    assert run(hooks={"plan": lambda rows: rows})[1]["route"].startswith("gate>plan*>")
    assert run(hooks={"analyse": invented})[1]["status"] == "fallback"
    assert run(template=False)[1]["answer"] == G.UNAVAILABLE
    assert run(template=False, hooks={"synthesise": lambda rows: rows.withColumn("answer", F.lit("m"))})[1]["answer"] == "m"


def test_similar_sets_leave_a_task_only_if_they_may_be_similar(spark):
    import random

    import numpy as np

    from quillmark.operators import overlap

    rng = random.Random(4)
    # every two sets share a word, and most three of them, but only those of one family are similar
    sets = [(i, sorted({"all", *rng.sample([f"c{k}" for k in range(12)], 6), *(f"f{i % 40}-{k}" for k in range(12) if rng.random() > 0.15), *(f"o{i}-{k}" for k in range(4))})) for i in range(240)]
    frame = spark.createDataFrame(sets, "id long, words array<string>")
    want = {(i, j) for i, x in sets for j, y in sets if i < j and 2 * len({*x} & {*y}) >= len({*x} | {*y})}
    met = overlap.candidates(frame.select("id", F.transform("words", lambda w: F.xxhash64(w)).alias("h")), np.unique, 5000, 1 / 3, 0.5, bits=512).collect()
    assert want <= {(r["a"], r["b"]) for r in met} and len(met) < 3 * len(want)
    got = resolution.similar_sets(frame, 0.5).collect()
    assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want) > 100


def test_similar_sets_of_a_large_group_are_compared_by_blocks(spark):
    import random

    rng = random.Random(6)
    sets = [(i * 7, [f"w{k}" for k in range(30) if rng.random() > 0.12]) for i in range(300)] + [(9000, []), (9001, ["w1", "w1"]), (9002, ["w1"])]
    frame = spark.createDataFrame(sets, "id long, words array<string>").repartition(5)
    got = {(r["a"], r["b"]): r["jaccard"] for r in resolution.similar_sets(frame, 0.75).collect()}
    share = lambda x, y: len({*x} & {*y}) / len({*x} | {*y})
    want = {(i, j): round(share(x, y), 6) for i, x in sets for j, y in sets if i < j and x and y and share(x, y) >= 0.75}
    assert got.keys() == want.keys() and len(want) > 10_000
    assert all(abs(got[k] - v) < 2e-6 for k, v in want.items())


def test_near_duplicates_take_every_white_space_for_one(spark, tmp_path):
    # a ratio is one of words, whatever stands between them; candidates have to know the same words
    words = [f"x{i}" for i in range(12)]
    got = near_texts(spark, tmp_path, [(1, " ".join(words)), (2, " ".join(words) + " y"), (3, " ".join(words[:10])), (4, "z"), (5, None), (6, "")])
    assert {(r["kind"], r["a"], r["b"], r["ratio"]) for r in got.collect()} == {("near", 1, 2, 0.96), ("near", 1, 3, 0.909091), ("near", 2, 3, 0.869565), ("copy", 5, 6, 1.0)}


def test_near_duplicates_of_a_large_group(spark, tmp_path):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(8)
    texts = [(i, " ".join(f"v{k}" if rng.random() > 0.06 else f"n{rng.randrange(9)}" for k in range(25))) for i in rng.sample(range(10_000), 140)]
    first = {}
    for i, t in sorted(texts):
        first.setdefault(t, i)
    ratio = lambda a, b: SequenceMatcher(None, a.split(), b.split(), autojunk=False).ratio()
    want = {(i, j) for a, i in first.items() for b, j in first.items() if i < j and ratio(a, b) >= 0.82}
    got = near_texts(spark, tmp_path, texts)
    assert {(r["a"], r["b"]) for r in got.filter("kind = 'near'").collect()} == want and len(want) > 1000


def test_near_texts_keep_their_shingles_in_packed_rows(spark, tmp_path):
    import os

    from quillmark.plans.registry import QUERIES

    body = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    texts = [(i, body(f"t{i}-", 400) + " the same last line of every text") for i in range(200)]
    texts += [(1000 + i, body("t7-", 400 - i)) for i in (0, 40, 90, 150)] + [(2000, "t1 t2"), (2001, "T1  t2"), (2002, "t1 t2 t3"), (2003, "")]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    got = {(r["kind"], r["a"], r["b"], r["jaccard"]) for r in QUERIES["near_texts_jaccard"](spark, str(tmp_path)).collect()}
    runs = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in texts if (w := t.split())}
    want = {("near", a, b, round(j, 6)) for a in runs for b in runs if a < b < 2000 and (j := len(runs[a] & runs[b]) / len(runs[a] | runs[b])) >= 0.75}
    assert got == want | {("copy", 2000, 2001, 1.0)} and len(want) > 5
    written = [x for x in set(os.listdir(shared)) - before]
    assert written and not any(k.startswith("classes") for k in written)  # no text is written
