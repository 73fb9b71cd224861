"""The training-data operators against brute force, libraries and round trips, with edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillmark.llm import bpe, exact_dedup, language_id, license_scan, long_repeats, mixing, near_dedup, personal_data, quality_rules, textblocks, token_files

SF = "/root/testdata/sf0.001"
RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, partitions=3):
    """Rows of (doc_id, text[, lang]) as documents."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows], SCHEMA).repartition(partitions)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


EDGE = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "word " * 30_000), (6, "same text here"), (7, "same  text\there"), (7, "same  text\there"), (None, "same text here"), (8, "é中😀 'tis don't 12½ x"), (None, None)]


@pytest.fixture(scope="module")
def edge(spark):
    return frame(spark, EDGE)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def thue_morse(n, letters):
    return "".join(letters[i.bit_count() & 1] for i in range(n))


#: Different words of one length whose polynomial hashes modulo a power of two agree.
THUE_MORSE = [thue_morse(n, x) for n in (1024, 2048, 4096) for x in ("ab", "ba")]

# ---- shared text helpers ----


def test_hashes_tell_thue_morse_words_apart():
    for a, b in zip(THUE_MORSE[::2], THUE_MORSE[1::2], strict=True):
        points = np.frombuffer((a + b).encode(), np.uint8)
        prefix = textblocks.prefix_hash(points)
        x, y = textblocks.span_hash(prefix, np.array([0, len(a)]), np.array([len(a), len(a + b)]))
        assert x != y


def test_special_strings_are_pretokens():
    text = "a <|e|> b<|e|><|e|><|" + "e|>"
    at = np.array([0, len(text) - 3, len(text)])
    _, starts, tops = textblocks.pretokens(text, at, ("<|e|>",))
    assert [text[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)] == ["a", " ", "<|e|>", " b", "<|e|>", "<|e|>", "<|", "e", "|>"] and tops.tolist() == [0, 7, 9]


def test_pretokens_equal_the_pattern():
    import regex

    random.seed(5)
    signs = ["'", "s", "t", "re", "ve", "ll", "d", " ", "  ", "\n", "\t", "1", "²", "½", "é", "!", "..", " ", "　", "中", "x", "😀", "m"]
    rows = ["".join(random.choices(signs, k=random.randrange(14))) for _ in range(3000)]
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    text = "".join(rows)
    _, starts, tops = textblocks.pretokens(text, at)
    for i, r in enumerate(rows):
        s = starts[tops[i] : tops[i + 1] + 1]
        assert [text[a:b] for a, b in zip(s[:-1], s[1:], strict=True)] == regex.findall(public_tokenizers.PATTERN, r)


def test_words_and_blocks():
    data, offsets = textblocks.utf8(pa.array(["a b", None, " ", "c\n\x0bd"]))
    start, end, top = textblocks.words(data, offsets)
    assert [bytes(data[a:b]) for a, b in zip(start, end, strict=True)] == [b"a", b"b", b"c", b"d"] and top.tolist() == [0, 2, 2, 2, 4]
    assert list(textblocks.blocks(np.array([0, 5, 5, 100, 101]), 10)) == [(0, 2), (2, 3), (3, 4)]


# ---- 1: language ----


def test_codewords_are_far_apart():
    for k in (2, 4, 6, 12):
        m = language_id.codewords(k)
        assert min((m[i] != m[j]).sum() for i in range(k) for j in range(i)) >= (1 if k == 2 else 2 ** (k - 2) if k <= 7 else 5)


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs, language_id.train(docs), carry=["lang"])
    right = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97 and got.count() == docs.count()


def test_language_decoding_by_hand(docs):
    """Features, losses and the nearest codeword, one text and one bit at a time."""
    model = language_id.train(docs)
    rows = [r["text"] for r in docs.filter("text is not null").orderBy("doc_id").limit(40).collect()]
    x = np.concatenate(list(language_id.features(pa.array([t.lower() for t in rows]))))
    best, score, lead = model.decode(x)
    for i in range(len(rows)):
        one = np.concatenate(list(language_id.features(pa.array([rows[i].lower()]))))[0]
        assert np.array_equal(one, x[i])
        losses = []
        for k in range(len(model.langs)):
            margins = [model.words[k][j] * (float(one @ model.weights[:, j]) + float(model.bias[j])) for j in range(model.words.shape[1])]
            losses.append(sum(model.trust[k][j] * math.log1p(math.exp(-m)) for j, m in enumerate(margins)) / sum(model.trust[k]))
        order = sorted(losses)
        assert best[i] == losses.index(order[0]) and lead[i] == pytest.approx(order[1] - order[0], abs=1e-4)
        assert score[i] == pytest.approx(1 / sum(math.exp(-4 * (v - order[0])) for v in losses), abs=1e-3)


def test_language_edges(spark, edge, empty):
    assert language_id.train(empty) is None
    got = language_id.identify(edge, language_id.train(edge), carry=["doc_id", "score", "lang"]).collect()
    assert len(got) == len(EDGE) and all(r["lang_pred"] == ("en" if r["score"] else "und") for r in got)
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {1, 2, 3, None}
    assert language_id.identify(empty, None).count() == 0


# ---- 2: mixing ----


def test_rates_reach_the_targets(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    table = spark.createDataFrame([(i, int(rng.integers(1, 100)), [float(x) for x in q]) for i, q in enumerate(p)], "doc_id long, n_tokens long, posterior array<double>")
    steps, totals = mixing.fit_rates(table, ["a", "b", "c"], {"a": 0.5, "b": 0.3, "c": 0.2})
    assert all(abs(after - target) < 2e-3 * sum(t for _, t, _ in totals.values()) for _, target, after in totals.values())
    rates = mixing.rated(table, ["a", "b", "c"], steps).collect()
    assert min(r["rate"] for r in rates) >= 0 and len({r["rate"] for r in rates}) > 10
    steps, _ = mixing.fit_rates(table, ["a", "b", "c"], {"a": 0.9, "b": 0.05, "c": 0.05}, keep=("a",))
    assert all(r["copies"] >= 1 for r in mixing.rated(table, ["a", "b", "c"], steps).collect() if np.argmax(r["posterior"]) == 0)


def by_hand(p, t, target, least, steps=40_000):
    """Plain projected gradient steps on all rates at once."""
    a = p * t[:, None]
    r = np.maximum(least, np.ones(len(t)))
    size = 1 / np.linalg.eigvalsh(a.T @ a).max()
    for _ in range(steps):
        r = np.maximum(least, r - size * (a @ (a.T @ r - target)))
    return a.T @ r


@pytest.mark.parametrize("weights", [{"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 0.98, "b": 0.01, "c": 0.01}])
def test_rates_equal_brute_force(spark, weights):
    rng = np.random.default_rng(3)
    p, t = rng.dirichlet([1.0, 1.0, 1.0], 150), rng.integers(1, 20, 150)
    table = spark.createDataFrame([(i, int(n), [float(x) for x in q]) for i, (q, n) in enumerate(zip(p, t, strict=True))], "doc_id long, n_tokens long, posterior array<double>")
    steps, totals = mixing.fit_rates(table, ["a", "b", "c"], weights)
    want = by_hand(p, t.astype(float), np.array([totals[x][1] for x in "abc"]), 0.0)
    assert [totals[x][2] for x in "abc"] == pytest.approx(want, abs=0.02 * t.sum())


def test_mixing_edges(spark, edge, empty, docs):
    labels = docs.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").select("doc_id", F.when(F.col("quality") == 0, "low").otherwise("clean").alias("domain"))
    none = labels.filter("false")
    assert {r["rate"] for r in mixing.mix(edge, none, {"clean": 1.0}).collect()} == {1.0}
    assert mixing.mix(empty, labels, {"clean": 1.0}).count() == 0
    both = labels.unionByName(spark.createDataFrame([(None, "low"), (3, None)], "doc_id long, domain string"))
    assert mixing.mix(docs, both, {"clean": 0.9, "low": 0.1}).count() == docs.count()


# ---- 3: personal data ----

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def strict_spans(text):
    def passes(kind, m):
        digits = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits or "1"), "phone": 9 <= len(digits) <= 15}[kind]

    spans = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(FORMS.items()) for m in re.finditer(p, text) if passes(k, m[0]))
    return [f"{k}:{s}:{e}" for s, _, e, k in spans]


PII = [
    "a@b.c.d%x@y.z q@w", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.255", "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (555) 555-0100. +12", "é😀 x@y.zz", "a" * 5000 + "@b.co", "1" * 3000, "call 555-123-4567 or (212) 555-0199",
    "bob [at] mail [dot] com", "", None, "10.0.0.1 10.0.0.1", "+1+2 (33) 444 555 666)", "a@@b.c a.b@c-d.e-f", "12 34 56 78 90 12 34 5",
]


def test_personal_data_equals_brute_force(spark, docs, texts):
    rows = frame(spark, list(enumerate(PII)) + [(1000 + i, t) for i, t in texts.items()])
    got = {r["doc_id"]: r for r in personal_data.find(rows).collect()}
    for i, t in list(enumerate(PII)) + [(1000 + i, t) for i, t in texts.items()]:
        want = strict_spans(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), t[:80]
        assert set(want) <= set(got[i]["spans"].split(",")) | ({""} if not want else set())
        assert [got[i][f"n_{k}"] for k in FORMS] == [sum(w.startswith(k) for w in want) for k in FORMS]


@pytest.fixture(scope="module")
def pii_model(docs):
    return personal_data.learn(personal_data.proposals(docs))


def test_personal_data_edges_and_redaction(spark, edge, empty, pii_model):
    assert personal_data.find(empty, pii_model).count() == 0 and personal_data.find(edge.withColumn("spans", F.lit(1)).withColumn("s_ip", F.lit(2)), pii_model).count() == len(EDGE)
    rows = frame(spark, [(1, "é mail a@b.cc now"), (2, None), (3, "call 555-123-4567 or bob [at] mail [dot] com."), (3, "+1+2 (33) 444 555 666) x")])
    got = personal_data.redact(rows, pii_model).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, "é mail [email] now"), (2, ""), (3, "+1[phone]) x"), (3, "call [phone] or [email].")]


def test_method_adds_disguised_spans_and_no_broken_ones(spark, pii_model):
    want = {
        "bob [at] mail [dot] com": "email:0:23", "call 555-123-4567 or (212) 555-0199": "phone:5:17,phone:21:35", "host 10[.]0[.]0[.]1 up": "ip:5:19", "4111.1111.1111.1111": "card:0:19",
        "4111 1111 1111 1112": "", "order 555-123-4567": "", "look at page dot here": "", "10[.]0[.]0[.]300": "", "4111.1111.1111.1112": "",
    }
    texts = list(want)
    got = personal_data.find(frame(spark, list(enumerate(texts))), pii_model).collect()
    assert {texts[r["doc_id"]]: r["spans"] for r in got} == want


def test_precision_and_recall_of_added_spans(spark, pii_model):
    rng = random.Random(12)
    card = lambda: next(c for base in [f"4{rng.randrange(10**14):014d}"] for c in (f"{base}{d}" for d in range(10)) if luhn(c))
    rows, truth = [], {}
    for i in range(300):
        kind = i % 4
        c = card()
        good = [f"u{i}(at)host{i}(dot)org", f"{i % 256}[.]{i * 7 % 256}[.]3[.]4", "/".join(c[k : k + 4] for k in range(0, 16, 4)), f"{200 + i}-555-{1000 + i}"][kind]
        broken = [f"u{i}(at)host{i}(dot)nowhere", f"{300 + i}[.]{i % 256}[.]3[.]4", "/".join((c[:15] + str((int(c[15]) + 1) % 10))[k : k + 4] for k in range(0, 16, 4)), f"{200 + i}-555-{1000 + i}-{10**6 + i}"][kind]
        true = rng.random() < 0.5
        rows.append((i, f"so it was {rng.choice(['there', 'and then', 'that'])} {good if true else broken} as {rng.choice(['said', 'before'])}"))
        truth[i] = true
    got = {r["doc_id"]: r["n_added"] > 0 for r in personal_data.find(frame(spark, rows), pii_model).collect()}
    hits = sum(got[i] and truth[i] for i in got)
    assert hits >= 0.95 * sum(truth.values()) and hits >= 0.95 * sum(got.values())


PROSE = [
    "we met at home dot com and left", "he is at work.it was late", "she was at school.in the end", "they arrive at noon.at last", "stay at home.be safe", "ratio 100-200-3000 ok", "look at page dot here", "we looked at it. Then dot the i", "at 10.30 at the station.de rest",
    "sections 1.2.3 and 4.5", "sat at table dot net worth rose", "scores 123-456-7890 and 100 200 3000", "born at sea.co workers came", "one at a time.us too",
]


def test_prose_is_left_alone(spark, pii_model):
    got = personal_data.find(frame(spark, list(enumerate(PROSE))), pii_model).collect()
    assert {PROSE[r["doc_id"]]: r["spans"] for r in got} == dict.fromkeys(PROSE, "")


def test_precision_and_recall_on_forms_of_other_spellings(spark, pii_model):
    """Spellings that no training example has, among prose that resembles them."""
    rng = random.Random(3)
    card = lambda: next(c for base in [f"5{rng.randrange(10**14):014d}"] for c in (f"{base}{d}" for d in range(10)) if luhn(c))
    rows, truth = [], {}
    for i in range(400):
        c = card()
        made = [f"u{i} {{AT}} host{i}.org", f"u{i}(@)h-{i} (DOT) co (DOT) uk", f"{i % 256}(dot){i * 7 % 256}(dot)3(dot)4", "\u00b7".join(c[k : k + 4] for k in range(0, 16, 4)), "\u2013".join(c[k : k + 4] for k in range(0, 16, 4)), f"({200 + i}){300 + i}.{1000 + i}"][i % 6]
        true = i % 2 == 0 or i % 5 == 0
        rows.append((i, f"and so {made} was there" if true else f"and {rng.choice(PROSE)} was there"))
        truth[i] = true
    got = {r["doc_id"]: r["n_added"] > 0 for r in personal_data.find(frame(spark, rows), pii_model).collect()}
    hits = sum(got[i] and truth[i] for i in got)
    assert hits >= 0.95 * sum(truth.values()) and hits >= 0.97 * sum(got.values()), (hits, sum(truth.values()), sum(got.values()))


def test_many_matches_in_one_text(spark, pii_model):
    n = 1500
    text = " ".join(f"u{i}@h{i}.org" if i % 2 else f"u{i} [at] h{i} [dot] org" for i in range(n))
    r = personal_data.find(frame(spark, [(1, text)], 1), pii_model).first()
    spans = [tuple(map(int, x.split(":")[1:])) for x in r["spans"].split(",")]
    assert r["n_email"] == r["n_added"] == n // 2 and "".join(text[a:b] for a, b in spans) == text.replace(" u", "u")


def test_calibration_pools_falling_shares():
    scored = [(4.0, 9.0, 1.0), (3.0, 10.0, 0.0), (2.0, 5.0, 5.0), (1.0, 0.0, 9.0)]
    assert personal_data.calibrate(scored, 0.9) == pytest.approx(3.0, abs=1e-5) and personal_data.calibrate(scored, 0.96) is None


def test_boosting_separates_and_trees_agree():
    bit = personal_data.FEATURES.index("checksum")
    cells = {(k, f): (10.0, 0.1) if f >> bit & 1 else (0.1, 10.0) for k in range(4) for f in range(16)}
    trees = personal_data.boost(cells)
    score = {c: personal_data._score_of(trees, c[1] | 1 << (len(personal_data.FEATURES) + c[0])) for c in cells}
    assert min(s for (k, f), s in score.items() if f >> bit & 1) > max(s for (k, f), s in score.items() if not f >> bit & 1)


# ---- 4: long repeats ----


def cut_by_hand(rows, length, keep="none"):
    seen = {}
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            seen.setdefault(b[s : s + length], []).append((i, s))
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            places = seen[b[s : s + length]]
            if len(places) > 1 and (keep == "none" or min(places) != (i, s)):
                gone[s : s + length] = True
        a = np.frombuffer(b, np.uint8)
        out[i] = (len(b), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0, hashlib.sha256(a[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group", [4096, 2])
def test_long_repeats_equal_brute_force(spark, keep, group):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcé", k=rng.randint(1, 6)))
    passage = [" ".join(word() for _ in range(60)) for _ in range(4)]
    rows = [(i, " ".join([word(), *[rng.choice([*passage, word(), word()]) for _ in range(rng.randint(1, 6))]])) for i in range(40)] + [(50, "ab" * 400), (51, "x" * 300), (52, None), (53, ""), (54, passage[0][:199]), (55, passage[1])]
    got = {r["doc_id"]: tuple(r)[1:] for r in long_repeats.remove_repeats(frame(spark, rows), 60, keep, gram=16, group=group).collect()}
    assert got == cut_by_hand(rows, 60, keep)


def test_long_repeats_edges(spark, edge, empty):
    assert long_repeats.remove_repeats(empty).count() == 0
    got = long_repeats.remove_repeats(edge).collect()
    assert len(got) == len(EDGE)
    twice = long_repeats.remove_repeats(frame(spark, [(1, "q" * 10 + "".join(map(str, range(100)))), (1, "q" * 10 + "".join(map(str, range(100))))])).collect()
    assert [r["n_removed"] for r in twice] == [200, 200]
    once = long_repeats.remove_repeats(frame(spark, [(1, "q" * 10 + "".join(map(str, range(100))))] * 3), keep="first").collect()
    assert sorted(r["n_removed"] for r in once) == [0, 200, 200]
    other = frame(spark, [(4, "z" * 300)]).withColumn("key", F.lit(1)).withColumn("spans", F.lit(2)).withColumn("n_bytes", F.lit("x"))
    assert [tuple(r)[:4] for r in long_repeats.remove_repeats(other).collect()] == [(4, 300, 300, 1)]


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(long_repeats, "BLOCK", 500)
    rng = random.Random(3)
    base = "".join(rng.choices("abcdef", k=4000))
    rows = [(1, base), (2, "x" + base[700:2900] + "y"), (3, "".join(rng.choices("abcdef", k=3000)))]
    found = []
    for _, t in rows:
        data = np.frombuffer(t.encode(), np.uint8)
        owned = np.zeros(len(data), int)
        for _, place, at in long_repeats._pieces(np.array([0, len(data)]), 60):
            _, _, p, lo, hi = long_repeats.anchors(data[at[0] : at[-1]], at - at[0], 60, 16)
            for x, y in zip(lo, hi, strict=True):
                owned[x + place : y + place + 1] += 1
        found.append(owned[: len(data) - 59].tolist() == [1] * (len(data) - 59))
    assert all(found)
    got = {r["doc_id"]: tuple(r)[1:] for r in long_repeats.remove_repeats(frame(spark, rows), 60, gram=16).collect()}
    assert got == cut_by_hand(rows, 60)


def test_long_repeats_shuffle_texts_apart_from_members(spark, tmp_path):
    rng = random.Random(5)
    often, twice = ("".join(rng.choices("abcdef", k=150)) for _ in range(2))
    rows = [(i, "".join(rng.choices("ghij", k=80)) + often + (twice if i < 2 else "")) for i in range(6)]
    frame(spark, rows).write.parquet(str(tmp_path / "texts"))
    docs = spark.read.parquet(str(tmp_path / "texts"))
    spans = long_repeats.repeated_spans(long_repeats.keyed(docs), 60, gram=16, group=2)  # ``often`` makes large groups, ``twice`` small ones
    assert {r["key"] for r in spans.collect()} == set(range(6))
    # the job that deals members out reads written tables only: no text is read, and none shuffled, beside it
    assert spans.inputFiles() and not [f for f in spans.inputFiles() if str(tmp_path) in f]
    got = {r["doc_id"]: tuple(r)[1:] for r in long_repeats.remove_repeats(docs, 60, gram=16, group=2).collect()}
    assert got == cut_by_hand(rows, 60)


def test_previous_factors():
    rng = random.Random(2)
    for text in ("abababab" * 4, "aaaaaaaaaaaaaaaaaaaaaaaa", "".join(rng.choices("ab", k=200)), "".join(rng.choices("abc\0", k=120))):
        raw, length = text.encode(), 10
        data, starts = np.frombuffer(raw, np.uint8), np.arange(len(raw) - length + 1)
        shuffled = np.random.default_rng(1).permutation(len(starts))  # places need not follow the order of the bytes
        for position in (starts, shuffled):
            before, after = long_repeats.previous_factors(data, starts, position, length)
            shared = lambda i, j: next((k for k in range(length) if raw[i + k] != raw[j + k]), length)
            for i in starts:
                assert before[i] == max([shared(i, j) for j in starts if position[j] < position[i]], default=0)
                assert after[i] == max([shared(i, j) for j in starts if position[j] > position[i]], default=0)


# ---- 5: BPE ----


def test_bpe_equals_the_library(texts):
    import tiktoken

    vocab = bpe.Vocabulary(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ids, special_tokens={})
    random.seed(6)
    rows = [t for t in list(texts.values())[:60]] + ["".join(random.choices("abcdefgh ABC'sé中😀\n\t  123!?..", k=random.randrange(60))) for _ in range(1500)] + ["a" * 3000, "ab" * 1500, "", None, "<|endoftext|>", *THUE_MORSE]
    for first, last, ids, tops in bpe.encode_batch(pa.array(rows), vocab.encode_words, {}):
        for i in range(last - first):
            own = ids[tops[i] : tops[i + 1]]
            assert own.tolist() == library.encode_ordinary(rows[first + i] or "")
            assert vocab.decode(own).tobytes() == (rows[first + i] or "").encode()


def test_bpe_edges(spark, edge, empty):
    assert bpe.bpe_round_trip(empty, RANKS).count() == 0
    for r in bpe.bpe_round_trip(edge, RANKS).collect():
        if r["doc_id"] is not None and r["doc_id"] != 7:
            assert r["decoded_sha256"] == hashlib.sha256((dict(e[:2] for e in EDGE)[r["doc_id"]] or "").encode()).hexdigest()


# ---- 6: quality ----


def test_statistics_equal_brute_force(spark, docs, texts):
    words = re.compile(r"[^\x20\x09-\x0D]+")
    extra = {10_000: None, 10_001: "", 10_002: "a b c d e f g h " * 5, 10_003: "x\n x\n\nx\n", 10_004: "#$ a|b", 10_005: "w " * 8}
    rows = texts | extra
    got = {r["doc_id"]: r for r in quality_rules.statistics(frame(spark, list(rows.items()))).collect()}
    for i, t in rows.items():
        t = t or ""
        w = words.findall(t)
        seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in t.split("\n") if words.search(x)]
        want = (len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want


def test_decision_list_learns_and_keeps(spark, edge, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.quality(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k"))
    share = {r["quality"]: r["k"] for r in got.collect()}
    assert share[1] > 0.95 and share[0] < 0.1
    none = labels.filter("false")
    assert quality_rules.quality(empty, none).count() == 0
    assert {r["doc_id"]: r["kept"] for r in quality_rules.quality(edge, none).collect()}[1] is False
    assert quality_rules.learn(edge, none) == []


def test_covering_finds_ordered_rules():
    rng = np.random.default_rng(4)
    x = rng.random((3000, len(quality_rules.FEATURES)))
    low = (x[:, 2] > 0.9) | (x[:, 0] < 0.2) & (x[:, 5] < 0.3)
    rules = quality_rules.cover(x, low)
    hit = np.zeros(len(x), bool)
    for rule in rules:
        hit |= quality_rules._all(rule, x)
    assert len(rules) >= 2 and {len(r) for r in rules} >= {1, 2} and (hit == low).mean() > 0.98
    assert quality_rules.cover(x[:0], low[:0]) == [] and quality_rules.cover(x, np.zeros(len(x), bool)) == []


def test_verdict_equals_the_list_by_hand(spark, docs):
    c = quality_rules.Condition
    rules = [(c("symbol_share", True, 0.05),), (c("n_words", False, 60.0), c("distinct_share", True, 0.5))]
    rows = quality_rules.statistics(docs).select("*", quality_rules.verdict(rules).alias("rule"), *[v.alias(f"f_{k}") for k, v in quality_rules.features().items()]).collect()
    for r in rows:
        want = 1 if r["f_symbol_share"] > 0.05 else 2 if r["f_n_words"] <= 60 and r["f_distinct_share"] > 0.5 else 0
        assert r["rule"] == want


# ---- 7: token files ----


def test_token_files_round_trip(spark, docs, texts, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    path = str(tmp_path / "ids")
    texts = texts | {900_000 + i: t for i, t in enumerate(["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>", " <|endoftext|", *THUE_MORSE])}
    docs = frame(spark, list(texts.items()))
    token_files.write_token_files(docs, path, JSON, 2)
    start = 0
    for r in token_files.read_token_files(spark, path).orderBy("doc_id").collect():
        ids = [*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    some = token_files.read_token_ids(spark, path, [3, 5]).collect()
    assert {r["doc_id"]: r["ids"][-1] for r in some} == {3: 2, 5: 2}


def test_token_files_edges(spark, edge, empty, tmp_path):
    token_files.write_token_files(edge, str(tmp_path / "a"), JSON, 2)
    got = token_files.read_token_files(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert len(got) == len(EDGE) and got[0]["doc_id"] is None and got[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:], strict=False))
    token_files.write_token_files(empty, str(tmp_path / "b"), JSON, 2)
    assert token_files.read_token_files(spark, str(tmp_path / "b")).count() == 0


# ---- 8: licences ----


@pytest.fixture(scope="module")
def scanner(docs):
    return license_scan.train_scanner(docs)


def test_license_scan(spark, edge, empty, docs, texts, scanner):
    mit = "Permission is hereby granted, free of\ncharge, to any person obtaining\na copy of this software and\nassociated documentation files"
    rows = frame(spark, [(1, "intro\nLicensed under the Apache License, Version 2.0.\nbody"), (2, "Released under the MIT License."), (3, "we released the license of the work under way"), (4, "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3."), (5, "nothing"), (6, f"x y\n\n{mit}\n\nz")])
    got = {r["doc_id"]: r for r in license_scan.scan(rows.withColumn("families", F.lit(1)), scanner).collect()}
    assert got[1]["lines"] == "1:apache" and got[2]["families"] == "mit" and got[4]["lines"] == "0:cc-by-nc,1:gpl" and got[5]["n_licenses"] == 0
    assert got[3]["families"] in ("", "unknown") and got[6]["families"] == "mit" and got[6]["lines"].startswith("2")
    assert license_scan.scan(empty, scanner).count() == 0 and license_scan.scan(edge, scanner).count() == len(EDGE)
    planted = {"Licensed under the Apache License, Version 2.0.": "apache", "Released under the MIT License.": "mit", "This work is licensed under the GNU General Public License, version 3.": "gpl", "All rights reserved.": "proprietary", "Licensed under CC BY-NC 4.0.": "cc-by-nc"}
    odd = 0
    for r in license_scan.scan(docs, scanner).collect():
        want = {f for x, f in planted.items() if x in texts[r["doc_id"]].split("\n")}
        found = set(filter(None, r["families"].split(",")))
        assert want == found - {"unknown"}
        odd += "unknown" in found
    assert odd <= 0.02 * len(texts)


def test_unseen_licences_are_unknown(spark, docs, scanner):
    rows = frame(spark, [(1, "This program is licensed under the Eclipse Public License, version 2.0."), (2, "This work is licensed under the European Union Public License, version 1.2.")])
    assert {r["families"] for r in license_scan.scan(rows, scanner).collect()} == {"unknown"}
    fewer = license_scan.train_scanner(docs, known={k: v for k, v in license_scan.TEMPLATES.items() if k not in ("gpl", "lgpl")})
    got = license_scan.scan(frame(spark, [(1, license_scan.TEMPLATES["gpl"][0])]), fewer).collect()
    assert {r["families"] for r in got} == {"unknown"}


NOTICES = {
    "Licensed under the BSD 2-Clause License.": "bsd", "SPDX-License-Identifier: BSD-2-Clause": "bsd", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.": "isc",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.': "mit",
    "This is free and unencumbered software released into the public domain.": "unlicense", "GNU Affero General Public License v3": "agpl", "Licensed under the Eclipse Public License 2.0": "unknown", "Mozilla Public License 2.0": "mpl", "License: Apache 2.0": "apache", "GPLv3": "gpl",
    "Permission is hereby granted,\nfree of charge,\nto any person obtaining\na copy of this software\nand associated\ndocumentation files\n(the Software), to deal\nin the Software\nwithout restriction,\nincluding without limitation\nthe rights to use, copy,\nmodify, merge, publish": "mit",
}
PLAIN = ["mit", "mit\nder", "erst\nmit\nund", "er ging mit der Frau und mit\nmit dem Kind", "Apache", "the license of the hall", "all rights", "a copy of the text of this work is there", "License"]


def test_notices_of_many_forms_and_lines_that_are_none(spark, scanner):
    got = {r["doc_id"]: r["families"] for r in license_scan.scan(frame(spark, list(enumerate(NOTICES))), scanner).collect()}
    assert {x: got[i] for i, x in enumerate(NOTICES)} == NOTICES
    assert {r["families"] for r in license_scan.scan(frame(spark, list(enumerate(PLAIN))), scanner).collect()} == {""}
    whole = license_scan.scan(frame(spark, [(1, list(NOTICES)[-1])]), scanner).first()
    assert (whole["n_licenses"], whole["lines"]) == (1, "0-11:mit")


def test_license_scores_by_hand(scanner, texts):
    """Running totals and the choice of runs against sums over each run on its own."""
    from quillmark.llm.linear import softmax

    some = sorted(texts)[:60]
    body = ["\n".join([texts[i] or "", *list(NOTICES)[i % 11].split("\n"), "", "the end"]) for i in some]
    for text in body:
        raw = np.frombuffer(text.encode(), np.uint8)
        rows = [x.encode() for x in text.split("\n")]
        found = []
        for a in range(len(rows)):
            for b in range(a + 1, len(rows) + 1):
                if any(not r.split() for r in rows[a:b]):
                    break
                whole = (a == 0 or not rows[a - 1].split()) and (b == len(rows) or not rows[b].split())
                if b - a > license_scan.RUNS and not whole:
                    continue
                g = license_scan._grams(b"\n".join(rows[a:b]).decode())
                slots = (g % np.uint64(license_scan.WIDTH)).astype(int)
                odds = sum(float(scanner.notice[k]) for k in slots) / np.sqrt(max(1, len(g))) + scanner.notice_bias
                if odds < scanner.least_notice:
                    continue
                p = softmax((sum(scanner.family[k].astype(float) for k in slots) / np.sqrt(max(1, len(g))) + scanner.family_bias)[None])[0]
                sure = p.max() >= scanner.least_family and scanner.agrees(g, int(p.argmax()))
                if sure or (odds >= scanner.least_notice + license_scan.MARGIN and len(b" ".join(rows[a:b]).split()) >= license_scan.WORDS):
                    found.append((not sure, b - a, a, scanner.names[int(p.argmax())] if sure else "unknown"))
        taken = {}
        for _, n, i, name in sorted(found):
            if not any(j in taken for j in range(i, i + n)):
                taken |= dict.fromkeys(range(i, i + n), name)
        for unsure, n, i, name in sorted(found):
            if not unsure and {taken[j] for j in range(i, i + n) if j in taken} == {name}:
                held = {int(c) for t in scanner.templates[scanner.names.index(name)] for c in t}
                for j in range(i, i + n):
                    g = [int(c) in held for c in license_scan._grams(rows[j].decode())]
                    if j not in taken and g and sum(g) >= license_scan.AGREE * len(g):
                        taken[j] = name
        got = {j: f for _, a, b, f in scanner.classify(license_scan.read_lines(raw, np.array([0, len(raw)]))) for j in range(a, b + 1)}
        assert got == taken


def test_long_text_of_licences(spark, scanner):
    text = "\n".join(["some words of the body here"] * 40 + ["Released under the MIT License."]) + "\n"
    r = license_scan.scan(frame(spark, [(1, text * 300)], 1), scanner).first()
    assert r["n_licenses"] == 300 and r["families"] == "mit"


# ---- 9: near-duplicates ----


def near_by_hand(rows):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_near_dedup_equals_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 5)))
    base = [[word() for _ in range(rng.randint(6, 120))] for _ in range(12)]
    rows = []
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w).upper() if i % 7 == 0 else "  ".join(w)))
    rows += [(200, None), (201, ""), (202, "one two"), (203, "one  TWO"), (204, "one")]
    got = {r["doc_id"]: tuple(r)[1:] for r in near_dedup.near_dedup(frame(spark, rows)).collect()}
    assert got == near_by_hand(rows)


def test_near_dedup_edges(spark, edge, empty):
    assert near_dedup.near_dedup(empty).count() == 0
    got = near_dedup.near_dedup(edge.withColumn("key", F.lit(1)).withColumn("kept", F.lit("x")).withColumn("component_id", F.lit(0))).collect()
    assert len(got) == len(EDGE)
    assert {r["component_id"] for r in got if r["doc_id"] in (6, 7)} == {6}
    assert all(r["kept"] for r in got if r["doc_id"] in (1, 2, 3, 4, 5, 8))


def _pair(rng, n, changed):
    """Texts of ``n`` distinct words whose shingles differ where one word in so many places is another."""
    words = [f"w{rng.randrange(1 << 40)}" for _ in range(n)]
    other = list(words)
    for at in changed:
        other[at] = f"v{rng.randrange(1 << 40)}"
    return " ".join(words), " ".join(other)


def test_rows_of_one_id_are_linked_by_their_own_texts(spark):
    rng = random.Random(9)
    a, a2 = _pair(rng, 80, [40])
    b = " ".join(f"b{i}" for i in range(60))
    rows = [(1, "a short text of six words"), (1, a), (5, a2), (5, b), (None, a), (None, "alone without an id here"), (7, b)]
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in near_dedup.near_dedup(frame(spark, rows)).collect())
    assert got == sorted([(1, 1, True), (1, 1, True), (5, 1, False), (5, 5, True), (0, 1, False), (0, 0, True), (7, 5, False)])


def test_pipeline_keeps_one_row_of_each_group(spark):
    import corpus_pipeline as P

    rng = random.Random(9)
    a, a2 = _pair(rng, 80, [40])
    b = " ".join(f"b{i}" for i in range(60))
    rows = frame(spark, [(3, a), (5, a2), (5, b), (6, "x y"), (6, "x y"), (None, None)]).withColumn("kept", F.lit(1)).withColumn("first", F.lit("z"))
    left = P.near(spark, rows, SF)
    assert left.columns == rows.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect()) == sorted([(3, a), (5, b), (6, "x y"), (0, "")])


def test_recall_at_the_threshold(spark):
    rng = random.Random(10)
    rows, linked = [], 0
    for k in range(400):
        n = rng.randrange(150, 400)
        # c changed words, far apart, leave n - 4 - 5c of n - 4 + 5c shingles
        most = int((n - 4) / 35)
        at = [10 * i + 4 for i in range(most)]
        a, b = _pair(rng, n, at)
        share = (n - 4 - 5 * most) / (n - 4 + 5 * most)
        assert 0.75 <= share < 0.8
        linked += 1
        rows += [(2 * k, a), (2 * k + 1, b)]
    got = near_dedup.near_dedup(frame(spark, rows)).filter("not kept").count()
    assert got == linked


def test_components_of_a_chain(spark):
    links = spark.range(1, 100).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert near_dedup.components(links).agg(F.max("component")).first()[0] == 0


def roots_by_hand(links):
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def test_components_on_many_partitions_take_few_tasks(spark):
    """With partitions that stay as many as they are, steps over few links cost their tasks: check_h ran out of time."""
    rng = random.Random(11)
    ids = rng.sample(range(1 << 40), 3000)
    links = [(ids[0], x) for x in ids[1:1000]] + list(zip(ids[1000:1200], ids[1001:1200], strict=False)) + [tuple(rng.sample(ids[1200:], 2)) for _ in range(900)]
    table, sc = spark.createDataFrame(links, "a long, b long"), spark.sparkContext
    held = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        sc.setJobGroup("components", "")
        got = {r["id"]: r["component"] for r in near_dedup.components(table).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(j).stageIds}
    assert sum(x.numTasks for x in map(tracker.getStageInfo, stages) if x) < 1500
    assert got == roots_by_hand(links)


@pytest.mark.parametrize("few", [near_dedup.FEW, 10])
def test_labels_go_on_from_the_components_so_far(spark, monkeypatch, few):
    monkeypatch.setattr(near_dedup, "FEW", few)
    rng = random.Random(12)
    steps, labels, links = [[(rng.randrange(400), rng.randrange(400)) for _ in range(n)] for n in (120, 60, 0, 40)], None, []
    for step in steps:
        step = [(a, b) for a, b in step if a != b]
        links += step
        labels = near_dedup._labels(spark.createDataFrame(step, "a long, b long"), labels)
    rows = [tuple(r) for r in labels.select("id", "component").collect()]
    assert len(rows) == len(dict(rows)) and dict(rows) == roots_by_hand(links)


# ---- 10: exact duplicates ----


def test_exact_dedup_equals_brute_force(spark, edge, empty):
    rows = [(i, f"t{i % 7}") for i in range(60)] + [(100 + i, "hot  text" if i % 2 else "hot\ttext") for i in range(400)]
    got = {r["doc_id"]: r for r in exact_dedup.exact_dedup(frame(spark, rows)).collect()}
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), []).append(i)
    for t, members in groups.items():
        for i in members:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (min(members), len(members), i == min(members), hashlib.sha256(t.encode()).hexdigest())
    assert exact_dedup.exact_dedup(empty).count() == 0
    rows = exact_dedup.exact_dedup(edge.withColumn("kept", F.lit("clash"))).collect()
    assert len(rows) == len(EDGE) and sum(r["kept"] for r in rows) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in EDGE})


# ---- queries and pipeline ----


def test_queries_have_operators_and_sql(spark):
    from quillmark.llm.queries import ORACLES, QUERIES

    assert [n for n in range(1, 11) if not any(k.startswith(f"op{n}_") for k in QUERIES)] == [] and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["op9_minhash_near_dedup", "op10_exact_dedup"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from quillmark.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = con.execute(ORACLES[name])
    names = [c[0] for c in got.description]
    want = sorted(tuple(r) for r in got.fetchall())
    assert sorted(tuple(r) for r in QUERIES[name](spark, SF).select(*names).collect()) == want


def test_pipeline_stages_on_odd_tables(spark, edge, empty):
    import corpus_pipeline as P

    odd = edge.withColumn("kept", F.lit("k")).withColumn("rate", F.lit(1)).withColumn("key", F.lit(2)).withColumn("lang_pred", F.lit("x"))
    for k, (_, stage) in enumerate(P.STAGES):
        assert stage(spark, empty, SF).count() == 0
        got = stage(spark, odd, SF)
        assert got.columns == odd.columns if k < 4 else set(bpe.OUT) < set(got.columns)
        n = got.count()
        assert n == len(EDGE) if k == 4 else 0 < n <= len(EDGE) if k < 3 else n >= 1


def test_pipeline_stages_return_columns_with_their_values(spark, texts):
    """Columns named like results, like private names of the stages, and with a dot."""
    import corpus_pipeline as P

    names = ["kept", "keep_id", "group_size", "text_sha256", "lang_pred", "score", "held_out", "ambiguous", "_copies", "_copy", "copies", "copy", "a.b", "domain", "rate", "key", "_c0", "_p0", "_norm", "n_tokens", "first"]
    odd = frame(spark, list(texts.items())).withColumns({n: F.concat(F.lit(n), F.lit("="), F.col("doc_id").cast("string")) for n in names})
    for k in range(4):
        got = P.STAGES[k][1](spark, odd, SF)
        assert got.columns == odd.columns
        rows = got.collect()
        assert rows and all(r[n] == f"{n}={r['doc_id']}" and r["text"] == texts[r["doc_id"]] and r["source"] == "s" for r in rows for n in names), P.STAGES[k][0]


def test_pipeline_stage_by_stage(spark, docs):
    import corpus_pipeline as P

    now = docs
    for k, (name, stage) in enumerate(P.STAGES):
        before = now.count()
        now = stage(spark, now, SF)
        if k < len(P.STAGES) - 1:
            assert now.columns == docs.columns
        if k < 3:
            assert 0 < now.count() <= before
    assert set(now.columns) == {"doc_id", *bpe.OUT}
    lang = P.language(spark, frame(spark, [(1, "..."), (2, None), (3, "the and of")]), SF)
    assert [r["doc_id"] for r in lang.collect()] == [3]
