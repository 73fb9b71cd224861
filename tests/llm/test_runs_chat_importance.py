"""Periodic runs, chat formatting and importance resampling against brute force and round trips, with edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillmark.llm import chat_format, importance, periodic_runs

SCHEMA = "doc_id long, text string, n_words string, runs string, score string, key string"


def frame(spark, rows, partitions=3):
    """Rows of (doc_id, text) with extra columns named like results."""
    return spark.createDataFrame([(*r, "w", "r", "s", "k") for r in rows], SCHEMA).repartition(partitions)


EDGE = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "word " * 30_000), (6, "same text here"), (7, "same  text\there"), (7, "same  text\there"), (None, "same text here"), (8, "é中😀 'tis don't 12½ x " * 9), (None, None)]


@pytest.fixture(scope="module")
def texts(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]


# ---- 12: periodic runs ----


def brute_runs(w):
    out = {}
    for p in range(1, len(w) // 3 + 1):
        i = 0
        while i < len(w) - p:
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j < len(w) - p and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(24, 3 * p):
                out.setdefault((i, j + p), p)
            i = j
    return sorted((s, e - s, p) for (s, e), p in out.items())


@pytest.mark.parametrize("table", [4096, 16])
def test_runs_equal_brute_force(monkeypatch, table):
    """Both ways of probing: the grid of all periods at once, and period by period."""
    periodic_runs._grid()
    monkeypatch.setattr(periodic_runs, "TABLE", table)
    random.seed(1)
    for _ in range(600):
        letters = random.choice([1, 2, 3, 5])
        w = [random.randrange(letters) for _ in range(random.randrange(17, 140))]
        for _ in range(random.randrange(4)):
            a, p = random.randrange(len(w) + 1), random.randrange(1, 30)
            w[a:a] = w[a : a + p] * random.randrange(2, 8)
        assert periodic_runs.runs_of(np.array(w, np.int32)) == brute_runs(w)


def test_long_texts_of_one_word_and_of_rare_words_end_soon():
    assert periodic_runs.runs_of(np.zeros(200_000, np.int32)) == [(0, 200_000, 1)]
    rare = (np.arange(30_000) % 1499 == 7).astype(np.int32)
    assert (0, 30_000, 1499) in periodic_runs.runs_of(rare)


def test_periodic_runs_edges(spark):
    got = periodic_runs.periodic_runs(frame(spark, EDGE), carry=["score"]).collect()
    assert len(got) == len(EDGE) and all(r["score"] == "s" for r in got)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert [tuple(r) for r in by[5]["runs"]] == [(0, 30_000, 1)] and by[5]["collapsed"] == "word"
    assert by[7]["collapsed"] == "same text here" and by[7]["n_words"] == 3
    assert [tuple(r) for r in by[8]["runs"]] == [(0, 45, 5)] and by[8]["collapsed"] == "é中😀 'tis don't 12½ x"
    assert by[1]["n_words"] == by[3]["n_words"] == 0 and by[1]["collapsed"] == ""
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(frame(spark, EDGE), carry=["runs"])


def test_query_plants_and_finds(spark, texts):
    from quillmark.llm.queries import op12_periodic_runs

    got = {r["doc_id"]: r for r in op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    for doc_id, text in texts:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
        if len(w) > 3000:
            continue
        runs = brute_runs(w)
        keep = [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        r = got[doc_id]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(keep).encode()).hexdigest()


# ---- 11: chat formatting ----

BITS = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE:", "[/ROLE]", "[ROLE]", "\\", "[", "<", "/", "INST]", "s>", " ", "\n", "a", "[\\INST]", "<\\<SYS>>", "SYS>>", "é😀", "]", "ROLE:x] "]
ROLES = ["user", "assistant", "system", "tool", "", "a]b c", "ROLE:", "é"]


def test_any_turns_come_back():
    random.seed(4)
    for _ in range(5000):
        turns = [(random.choice(ROLES), "".join(random.choices(BITS, k=random.randrange(7)))) for _ in range(random.randrange(1, 5))]
        text, spans = chat_format.settle(turns)
        assert list(chat_format.parse(text)) == turns
        assert [chat_format.unescape(text[a:b]) for a, b in spans] == [x for r, x in turns if r == "assistant"]


def test_only_conflicts_are_escaped():
    assert chat_format.settle([("user", "a [ b < c \\ [x]")])[0] == "[INST] a [ b < c \\ [x] [/INST]"
    assert chat_format.settle([("user", "</s>[INST] ok [/INST]")])[0] == "[INST] <\\/s>[\\INST] ok [\\/INST] [/INST]"
    for wrong in ("[INST] a", "x", "[INST] a </s>", "<s> a </s>b", "[INST] a [INST] b [/INST]"):
        with pytest.raises(chat_format.GrammarError):
            list(chat_format.parse(wrong))


def test_conversations_of_many_turns_in_parts(spark, monkeypatch):
    """Turns by number over blocks and parts, nulls, repeats and extra columns."""
    rows = [(1, 3, "assistant", None), (1, None, "user", "first"), (2, 0, None, "x"), (2, 0, None, "x"), (None, 0, "user", "</s>"), (3, -5, "tool", "[ROLE:a] "), (3, 5000, "assistant", "b" * 30), (3, 9999, "assistant", "<s>")]
    rows += [(4, i, ["user", "assistant"][i % 2], f"turn {i} [INST]") for i in range(9000)]
    turns = spark.createDataFrame([(*r, "t") for r in rows], "conv_id long, turn long, role string, text string, block string").repartition(5)
    monkeypatch.setattr(chat_format, "PART", 1 << 14)
    made = chat_format.format_conversations(turns)
    assert made.filter("conv_id = 4").count() > 5
    got = {r["conv_id"]: r for r in chat_format.read_back(made).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv in got:
        held = sorted(((-1 if t is None else t + 10, r or "", x or "") for c, t, r, x in rows if c == conv))
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in held).encode()).hexdigest()
        learned = "".join(x for _, r, x in held if r == "assistant")
        assert (got[conv]["n_turns"], got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(held), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat_format.read_back(chat_format.format_conversations(turns.limit(0))).count() == 0


# ---- 13: importance resampling ----


def brute_features(text):
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if x]
    return w, [zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]


def test_features_equal_brute_force():
    random.seed(3)
    signs = [*"abZ09 .,-é中😀\n", "word", "x" * 60]
    rows = [None, "", "   ", "a", "A b", *["".join(random.choices(signs, k=random.randrange(60))) for _ in range(1500)]]
    got = [(int(w[i]), b[e[i] : e[i + 1]].tolist()) for f, n, b, e, w in importance.text_buckets(pa.array(rows), 10000) for i in range(n - f)]
    assert got == [(len(w), b) for w, b in map(brute_features, rows)]


def brute_draw(docs, target, percent=25, least=20):
    s, t = Counter(), Counter()
    made = {k: brute_features(x) for k, x in docs}
    for _, b in made.values():
        s.update(b)
    for x in target:
        t.update(brute_features(x)[1])
    n, m = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n + 10000) / ((s[b] + 1) * (m + 10000)))) for b in range(10000)]
    out = {}
    for k, (w, b) in made.items():
        weight = sum(gain[x] for x in b) // len(b) if b else 0
        h = int(hashlib.sha256(f"7:{k}".encode()).hexdigest()[:8], 16)
        out[k] = (len(w), len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
    order = sorted((k for k in out if out[k][0] >= least), key=lambda k: (-out[k][3], k))
    ranks = {k: i + 1 for i, k in enumerate(order[: percent * len(order) // 100])}
    return {k: (*v, ranks.get(k)) for k, v in out.items()}


def test_draw_equals_brute_force(spark, texts):
    target = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    got = importance.resample(frame(spark, texts), spark.createDataFrame([(x,) for x in target], "text string"), 25, 20, 7).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute_draw(texts, target) and sum(r["rank"] is not None for r in got) > 20


def test_ties_and_edges_of_the_draw(spark):
    target = spark.createDataFrame([("alpha beta",), (None,)], "text string")
    got = importance.resample(frame(spark, EDGE), target, 100, 1, 7).collect()
    assert len(got) == len(EDGE) and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 8))
    a, b = [r for r in got if r["doc_id"] == 7]
    assert a["score"] == b["score"] and abs(a["rank"] - b["rank"]) == 1
    assert [r["weight"] for r in got if r["doc_id"] in (1, 2, 3)] == [0, 0, 0]
    assert importance.resample(frame(spark, []), target, 25, 20, 7).count() == 0
    scored = spark.createDataFrame([(i, 5, i % 3) for i in range(30)], "doc_id long, n_features long, score long")
    ranks = {r["doc_id"]: r["rank"] for r in importance.draw(scored, F.col("doc_id") >= 0, 50).collect()}
    assert [k for k, v in sorted(ranks.items(), key=lambda x: x[1] or 99) if v] == [*range(2, 30, 3), *range(1, 15, 3)]
