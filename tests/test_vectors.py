"""The vector index against full comparison: recall, exact completion, hot vectors, unusable rows."""

import numpy as np
import pytest

from quillmark.operators import vectors as V

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, probes, k):
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows], np.float32).astype(np.float64)
    norm = np.linalg.norm(m, axis=1)
    out = {}
    for p, v in probes:
        q = np.array(v, np.float32).astype(np.float64)
        cos = np.round(m @ q / norm / np.linalg.norm(q), 6)
        out[p] = [(int(ids[i]), float(cos[i])) for i in np.lexsort((ids, -cos))[:k]]
    return out


def table(n=6000, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dim)) + 2 * rng.normal(size=(12, dim))[rng.integers(0, 12, n)]
    rows[n // 2 : n // 2 + n // 3] = rows[0]  # one vector makes up a third
    return [(i, r.tolist()) for i, r in enumerate(rows.astype(np.float32))]


def got(found):
    out = {}
    for r in sorted(found.filter("status = 'ok'").collect(), key=lambda r: (r["probe"], r["rank"])):
        out.setdefault(r["probe"], []).append((r["vec_id"], r["cos"]))
        assert r["rank"] == len(out[r["probe"]])
    return out


@pytest.fixture(scope="module")
def rows():
    return table()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_recall_and_exact_completion(frame, rows, monkeypatch):
    monkeypatch.setattr(V, "PIECE", 256)
    index = V.build(frame, lists=24)
    assert index.visits < len(index.centers) and sum(r["n"] for r in index.pieces.selectExpr("length(ids) / 8 as n").collect()) == len(rows)
    want = brute(rows, rows[::20], 10)
    probes = frame.filter("vec_id % 20 = 0")
    near = got(V.search(index, probes, 10))
    hits = sum(len({i for i, _ in near[p]} & {i for i, _ in want[p]}) for p in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert got(V.search(index, probes, 10, exact=True)) == want
    monkeypatch.setattr(V, "SENT", 0)  # probes meet pieces by shuffle
    assert got(V.search(index, probes, 10, exact=True)) == want


def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    held = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    want = brute(held, [x for x in held if x[0] % 20 == 0], 10)
    near = got(V.search(V.build(vectors, lists=16), vectors.filter("vec_id % 20 = 0"), 10))
    assert sum(len({i for i, _ in near[p]} & {i for i, _ in want[p]}) for p in want) >= 0.9 * 10 * len(want)


def test_unusable_rows_and_empty_tables(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0]), (6, [None, 1.0]), (7, [3.0, 0.0]), (7, [3.0, 0.0])]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = V.search(V.build(frame), frame, 2).collect()
    assert {r["probe"] for r in found if r["status"] == "unavailable"} == {3, 4, 5, 6}
    assert [(r["rank"], r["vec_id"], r["cos"]) for r in sorted(found, key=lambda r: r["rank"] or 0) if r["probe"] == 7] == [(1, 1, 1.0), (2, 7, 1.0)]
    none = frame.limit(0)
    assert V.search(V.build(none), none, 2).count() == 0
    assert {r["status"] for r in V.search(V.build(frame), none, 2).collect()} == set()
    assert got(V.search(V.build(none), frame, 2)) == {}
