"""Nearest vectors by cosine: an inverted-file index with packed pieces, block products in tasks, exact completion.

Vectors of a list are packed into pieces of up to ``PIECE`` rows, one row of the
index each, so that a task multiplies whole matrices. Probes are packed by the lists
they visit, up to ``BLOCK`` in a row; pieces and probes meet by list and by group of
pieces, so a list of any size (one vector may make up a third of the table) is spread
over as many keys as it has groups. Scores are sums in doubles of the vectors as they
are; nothing is re-ranked later.

Centroids come from at most ``SAMPLE`` vectors, picked by a hash of their number.
How many lists a probe visits is measured on the same sample: as many as give it
``recall`` of its own nearest ones. Lists are visited in rounds, the nearest one first and
``STEP`` times as many in each round; a round returns only vectors that reach the
probe's last score so far, so that what is returned grows with the probes and not with
the lists. ``exact`` adds a round over all lists that may still hold a better vector:
those whose nearest possible cosine (from the angle to the centroid and the widest angle
of the list) reaches the last score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import save

SAMPLE, MOST_LISTS, LIST_ROWS = 20_000, 4096, 1024
PIECE, BLOCK, GROUP, STEP = 4096, 1024, 8, 16
#: Bytes of packed probes up to which they are broadcast.
SENT = 8 << 20
DIGITS = 6
#: Below any cosine.
NONE = -2.0


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def usable(vectors: DataFrame, dim: int) -> DataFrame:
    """With ``ok``: a vector of ``dim`` numbers, none of them null, that is not all zeros."""
    e = F.col("embedding")
    return vectors.withColumn("ok", F.coalesce((F.size(e) == dim) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x)) & F.exists(e, lambda x: x != 0), F.lit(False)))


def _centroids(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(17)
    centers = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        near = np.argmax(sample @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, sample)
        filled = np.linalg.norm(sums, axis=1) > 0
        centers[filled] = _unit(sums[filled])
    return centers


def _visits(sample: np.ndarray, centers: np.ndarray, recall: float, k: int) -> int:
    """Lists that a sampled vector must visit, nearest first, to meet ``recall`` of its ``k`` nearest ones in the sample."""
    near = np.argmax(sample @ centers.T, axis=1)
    some = sample[:: max(1, len(sample) // 400)]
    order = np.argsort(-(some @ centers.T), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centers))[None, :], axis=1)
    best = np.argsort(-(some @ sample.T), axis=1, kind="stable")[:, 1 : k + 1]
    needed = np.sort(np.take_along_axis(place, near[best], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1 if len(needed) else len(centers)


@dataclass
class Index:
    """``pieces``: ``list, piece, grp, ids, rows`` (packed numbers and vectors); the rest has one entry for each list."""

    pieces: DataFrame
    dim: int
    centers: np.ndarray
    widest: np.ndarray
    groups: np.ndarray
    visits: int


def _packed(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Rows of ``keys, id, least, embedding`` packed by key, up to ``most`` in a row: ``keys, ids, least, rows``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[tuple, np.ndarray, np.ndarray, np.ndarray]] = []

        def full() -> pa.RecordBatch:
            key, (ids, least, rows) = held[0][0], (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
            held.clear()
            values = [pa.array([x.astype(t).tobytes()]) for x, t in ((ids, "<i8"), (least, "<f8"), (rows, "<f8"))]
            return pa.RecordBatch.from_arrays([*[pa.array([x], pa.int64()) for x in key], *values], [*keys, "ids", "least", "rows"])

        for batch in batches:
            if not batch.num_rows:
                continue
            by = list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True))
            ids, least = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "least"))
            matrix, at = _matrix(batch.column("embedding")), 0
            for key, group in groupby(by):
                n = len(list(group))
                while n:
                    if held and (held[0][0] != key or sum(len(h[1]) for h in held) >= most):
                        yield full()
                    take = min(n, most - sum(len(h[1]) for h in held))
                    held.append((key, *(x[at : at + take] for x in (ids, least, matrix))))
                    at, n = at + take, n - take
        if held:
            yield full()

    return rows.select(*[F.col(k).cast("long").alias(k) for k in keys], "id", "least", "embedding").repartition(*keys).sortWithinPartitions(*keys, "id").mapInArrow(pack, ", ".join([*[f"{k} long" for k in keys], "ids binary, least binary, rows binary"]))


def build(vectors: DataFrame, recall: float = 0.95, k: int = 10, lists: int | None = None) -> Index:
    """An index of all usable rows of ``vec_id, embedding``; the rest has no direction and is near nothing.

    ``k`` is the number of neighbours that ``recall`` is measured for.
    """
    sizes = vectors.filter("embedding IS NOT NULL").groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    dim, n = (sizes[0]["dim"], sizes[0]["n"]) if sizes else (1, 0)
    good = usable(vectors.select("vec_id", "embedding"), dim).filter("ok").drop("ok")
    share = F.pmod(F.xxhash64(F.col("vec_id"), F.lit(11)), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(1, n)) * (1 << 30))
    held = good.filter(share).limit(2 * SAMPLE).select("embedding").toArrow()
    sample = _unit(_matrix(held.column(0))) if held.num_rows else np.zeros((1, dim))
    want = min(lists or max(1, n // LIST_ROWS), MOST_LISTS, len(sample))
    centers = _centroids(sample, want)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column("embedding"))
                cos = _unit(rows) @ centers.T
                near = np.argmax(cos, axis=1)
                angle = np.arccos(np.clip(cos[np.arange(len(near)), near], -1, 1))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("embedding"), pa.array(near, pa.int64()), pa.array(angle)], ["id", "embedding", "list", "angle"])

    placed = save(good.select(F.col("vec_id").cast("long").alias("id"), "embedding").mapInArrow(assign, f"id long, embedding {vectors.schema['embedding'].dataType.simpleString()}, list long, angle double"), "assigned")
    count, widest = np.zeros(len(centers), np.int64), np.zeros(len(centers))
    for r in placed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("a")).collect():  # one row a list
        count[r["list"]], widest[r["list"]] = r["n"], r["a"]
    ways = -(-count // (PIECE // 2))  # pieces by hash, half full so that few spill over
    piece = F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), F.get(F.lit(ways.tolist()), F.col("list").cast("int")))).cast("long")
    pieces = save(_packed(placed.withColumns({"piece": piece, "least": F.lit(0.0)}), ["list", "piece"], PIECE).drop("least").withColumn("grp", F.floor(F.col("piece") / GROUP).cast("long")), "pieces")
    return Index(pieces, dim, centers, widest, np.maximum(1, -(-ways // GROUP)), min(len(centers), _visits(sample, centers, recall, k)))


def _meet(index: Index, visits: DataFrame, n: int, k: int) -> DataFrame:
    """``probe, vec_id, cos``: of each visited piece the best ``k`` with ``least`` or more, for ``id, embedding, least, list`` rows of ``n`` probes."""
    blocks = -(-n // BLOCK)
    packed = _packed(visits.withColumn("blk", F.pmod(F.xxhash64("id"), F.lit(blocks))), ["list", "blk"], BLOCK).select("list", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), "least")
    dim = index.dim
    if n * len(index.centers) * dim * 8 <= SENT:
        met = index.pieces.join(F.broadcast(packed), "list")
    else:
        spread = packed.withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.get(F.lit((index.groups - 1).tolist()), F.col("list").cast("int")).cast("long"))))
        met = index.pieces.join(spread, ["list", "grp"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, q_ids = (np.frombuffer(batch.column(c)[i].as_py(), "<i8") for c in ("ids", "q_ids"))
                rows, q = (np.frombuffer(batch.column(c)[i].as_py(), "<f8").reshape(-1, dim) for c in ("rows", "q_rows"))
                least = np.frombuffer(batch.column("least")[i].as_py(), "<f8")
                cos = np.round((q @ rows.T) / np.linalg.norm(q, axis=1)[:, None] / np.linalg.norm(rows, axis=1)[None, :], DIGITS)
                if len(ids) > k:
                    least = np.maximum(least, np.partition(cos, len(ids) - k, axis=1)[:, len(ids) - k])
                a, b = np.nonzero(cos >= least[:, None])
                order = np.lexsort((b, -cos[a, b], a))  # ids ascend, so of equal scores the smaller ones come first
                a, b = a[order], b[order]
                keep = np.arange(len(a)) - np.searchsorted(a, a) < k
                a, b = a[keep], b[keep]
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[a]), pa.array(ids[b]), pa.array(cos[a, b])], ["probe", "vec_id", "cos"])

    return met.select("ids", "rows", "q_ids", "q_rows", "least").mapInArrow(score, "probe long, vec_id long, cos double")


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("probe").orderBy(F.desc("cos"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= k).select("probe", "rank", "vec_id", "cos")


def search(index: Index, probes: DataFrame, k: int, exact: bool = False) -> DataFrame:
    """``probe, status, rank, vec_id, cos``: the ``k`` nearest of each ``vec_id, embedding`` row of ``probes``.

    ``status`` is ``ok``, or ``unavailable`` with nulls behind it for a probe that has no
    direction or another length than the index. With ``exact`` every list is visited that
    may hold one of the nearest; repeated probes are searched once.
    """
    held = save(usable(probes.select(F.col("vec_id").cast("long").alias("id"), "embedding"), index.dim).dropDuplicates(["id"]), "probes")
    good = held.filter("ok").drop("ok")
    n = good.count()
    none = held.filter("NOT ok").select(F.col("id").alias("probe"), F.lit("unavailable").alias("status"), *[F.lit(None).cast(t).alias(c) for c, t in (("rank", "long"), ("vec_id", "long"), ("cos", "double"))])
    if not n:
        return none
    rounds, at = [], 0
    while at < index.visits:
        rounds.append((at, min(index.visits, max(1, at * STEP))))
        at = rounds[-1][1]
    if exact and at < len(index.centers):
        rounds.append((at, None))
    found = None
    for first, last in rounds:
        least = good.withColumn("least", F.lit(NONE))
        if found is not None:
            have = found.groupBy("probe").agg(F.min("cos").alias("c"), F.count(F.lit(1)).alias("n")).filter(f"n = {k}")
            least = good.join(have, F.col("id") == F.col("probe"), "left").select("id", "embedding", F.coalesce("c", F.lit(NONE)).alias("least"))
        more = _meet(index, _visited(index, least, first, last), n, k)
        found = save(_best(more if found is None else more.unionByName(found), k).drop("rank"), "nearest")
    return _best(found, k).select("probe", F.lit("ok").alias("status"), "rank", "vec_id", "cos").unionByName(none)


def _visited(index: Index, probes: DataFrame, first: int, last: int | None) -> DataFrame:
    """``id, embedding, least, list``: the lists of each probe from the ``first`` nearest to before the ``last``, or (None) all others that may reach its ``least``."""
    centers, widest = index.centers, index.widest

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cos = _unit(_matrix(batch.column("embedding"))) @ centers.T
            order = np.argsort(-cos, axis=1, kind="stable")
            if last is None:
                seen = np.zeros(cos.shape, bool)
                np.put_along_axis(seen, order[:, :first], True, axis=1)
                bound = np.cos(np.maximum(0, np.arccos(np.clip(cos, -1, 1)) - widest[None, :]))
                probe, lists = np.nonzero(~seen & (bound + 2 * 10.0**-DIGITS >= batch.column("least").to_numpy()[:, None]))
            else:
                lists = order[:, first:last]
                probe, lists = np.repeat(np.arange(len(cos)), lists.shape[1]), lists.ravel()
            row = pa.array(probe)
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(row) for c in ("id", "embedding", "least")], pa.array(lists, pa.int64())], ["id", "embedding", "least", "list"])

    kind = probes.schema["embedding"].dataType.simpleString()
    return probes.select("id", "embedding", "least").mapInArrow(near, f"id long, embedding {kind}, least double, list long")
