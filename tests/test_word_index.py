"""The stored BM25 index against scoring by hand, after appends, under filters and with lists to fill."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillmark.operators import retrieval
from quillmark.operators import word_index as W

SCHEMA = "doc_id long, text string, grp string"


def brute(docs, terms, k, grp=None):
    """Okapi scores with the mean-idf floor; documents without a term have 0; ties by number."""
    held = {i: [t for t in re.split(r"[^\w]+", (x or "").lower()) if t] for i, x, g in docs if grp is None or g == grp}
    n, mean_length = len(held), sum(map(len, held.values())) / len(held)
    df = Counter(t for w in held.values() for t in set(w))
    idf = {t: math.log((n - c + 0.5) / (c + 0.5)) for t, c in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {t: 0.25 * mean if v < 0 else v for t, v in idf.items()}
    out = []
    for i, w in held.items():
        c = Counter(w)
        out.append((i, round(sum(idf[t] * c[t] * 2.5 / (c[t] + 1.5 * (0.25 + 0.75 * len(w) / mean_length)) for t in terms if c[t]), 6)))
    return sorted(out, key=lambda r: (-r[1], r[0]))[:k]


def results(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query"], r["rank"])):
        out.setdefault(r["query"], []).append((r["doc_id"], r["score"]))
        assert r["rank"] == len(out[r["query"]])
    return out


def close(a, b):
    return a.keys() == b.keys() and all([i for i, _ in a[q]] == [i for i, _ in b[q]] and all(abs(x - y) < 2e-6 for (_, x), (_, y) in zip(a[q], b[q], strict=True)) for q in a)


@pytest.fixture(scope="module")
def docs():
    random.seed(8)
    words = [f"w{i}" for i in range(60)]
    weight = [1 / (i + 1) for i in range(60)]
    rows = [(i * 7, " ".join(random.choices(words, weight, k=random.randrange(1, 40))), random.choice("abc")) for i in range(900)]
    return [*rows, (9000, None, "a"), (9001, "", "b"), (9002, "Rare rare, RARE w1", "a"), (9003, "rare é中", "c")]


QUERIES = [("common", ["w0", "w1"]), ("mixed", ["w0", "w7", "w50"]), ("few", ["rare"]), ("none", ["absent"]), ("twice", ["w50", "w50", "w3"])]


def test_three_appends_and_filters_equal_scores_by_hand(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "RANGE", 64)
    index = W.WordIndex(spark, str(tmp_path / "index"))
    for part in (docs[::3], docs[1::3], docs[2::3]):
        index.append(spark.createDataFrame(part, SCHEMA), by="grp")
    index.append(spark.createDataFrame(docs[:5], SCHEMA), by="grp")  # known already
    asked = spark.createDataFrame(QUERIES, "query string, terms array<string>")
    assert close(results(index.search(asked, 10)), {q: brute(docs, t, 10) for q, t in QUERIES})
    by = spark.createDataFrame([(q, t, g) for (q, t), g in zip(QUERIES, "abcab", strict=True)], "query string, terms array<string>, grp string")
    assert close(results(index.search(by, 7, by=True)), {q: brute(docs, t, 7, g) for (q, t), g in zip(QUERIES, "abcab", strict=True)})


def test_equals_the_scan_where_no_list_is_filled(spark, docs, tmp_path):
    frame = spark.createDataFrame(docs, SCHEMA)
    index = W.WordIndex(spark, str(tmp_path / "index"))
    index.append(frame)
    asked = spark.createDataFrame(QUERIES[:2], "query string, terms array<string>")
    assert close(results(index.search(asked, 10)), results(retrieval.bm25(frame, asked, 10)))


def test_what_a_crash_leaves_is_not_seen(spark, docs, tmp_path):
    index = W.WordIndex(spark, str(tmp_path / "index"))
    asked = spark.createDataFrame(QUERIES[:1], "query string, terms array<string>")
    with pytest.raises(FileNotFoundError):
        index.search(asked, 3)
    index.append(spark.createDataFrame(docs[:300], SCHEMA))
    want = results(index.search(asked, 5))
    for part in ("postings", "vocabulary", "totals"):  # an append that stopped before its last step
        index._read(part, [1]).limit(3).drop("version", "bucket").write.parquet(f"{index.folder}/{part}/version=2")
    assert results(index.search(asked, 5)) == want
    index.append(spark.createDataFrame(docs[300:], SCHEMA))
    assert close(results(index.search(asked, 5)), {"common": brute(docs, QUERIES[0][1], 5)})


def test_blocks_below_the_last_score_are_not_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "RANGE", 10)
    rows = [(i, "key " * 9 if i < 20 else "key " + "pad " * 50, "") for i in range(400)] + [(500 + i, "pad", "") for i in range(900)]
    index = W.WordIndex(spark, str(tmp_path / "index"))
    index.append(spark.createDataFrame(rows, SCHEMA))
    read = []
    keep = W.save
    monkeypatch.setattr(W, "save", lambda df, name: read.append((name, out := keep(df, name))) or out)
    found = results(index.search(spark.createDataFrame([("q", ["key"])], "query string, terms array<string>"), 5))
    assert [i for i, _ in found["q"]] == [0, 1, 2, 3, 4]
    sizes = {name: df.count() for name, df in read}
    assert sizes["cells"] == 40 and sizes["rest"] == 0


def test_empty_table(spark, tmp_path):
    index = W.WordIndex(spark, str(tmp_path / "index"))
    index.append(spark.createDataFrame([], SCHEMA))
    assert index.search(spark.createDataFrame([("q", ["a"])], "query string, terms array<string>"), 5).count() == 0
