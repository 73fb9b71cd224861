"""Mixing to target weights with soft memberships.

A softmax classifier on hashed words, trained on a labelled table, gives each
document a posterior over domains. Nonnegative document rates are then fitted so
that the expected tokens of each domain (rate x tokens x posterior, summed) match
the targets: least squares by accelerated projected gradient steps. A step needs
one number for each domain from a pass over all documents; a document's rate
follows from its posterior and the short list of residuals so far, so nothing is
kept for each document between steps.

Steps go on until every domain's expected total is within ``CLOSE`` of its target,
or until ``STALL`` steps together have brought the residual down by less than a
hundredth: then the targets are out of reach of nonnegative rates, and the rates are
the nearest there are. The result says by how much each domain misses its target.

Training reads about ``SAMPLE`` labelled documents (expected, by a hash of
``doc_id``), at most ``WIDTH`` slots each.

Defined results: a text that is null or has no word has 0 tokens, the prior of
the bias as posterior, and a rate that does not move any total; labels that are
null or of unknown documents are ignored and of several of one document the least
counts; without labels there is one domain ``all`` and every rate is 1; repeated
rows are documents of their own; a null ``doc_id`` passes through; of equal posteriors
the domain that comes first in the alphabet counts as the likeliest; extra columns
are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import fit_softmax, row_sums, softmax
from .shared import materialise
from .textblocks import blocks, lower_ascii, prefix_hash, span_hash, utf8, words

SAMPLE, WIDTH = 6000, 1 << 15
STALL, CLOSE = 12, 2e-4


def word_slots(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each block of whole texts: distinct hashed words, where each text's begin, and word counts."""
    data, offsets = utf8(column)
    for first, last in blocks(offsets):
        part, at = lower_ascii(data[offsets[first] : offsets[last]]), offsets[first : last + 1] - offsets[first]
        start, end, top = words(part, at)
        n = np.diff(top)
        slot = (span_hash(prefix_hash(part), start, end) % np.uint64(WIDTH)).astype(np.int64)
        key = np.unique(np.repeat(np.arange(last - first), n) * WIDTH + slot)
        yield key % WIDTH, np.searchsorted(key, np.arange(last - first + 1) * WIDTH), n


@dataclass
class Domains:
    """Learned classifier of ``WIDTH`` x domains weights."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, slots: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = np.maximum(1, np.diff(ends))
        return softmax(row_sums(self.weights[slots], ends) / np.sqrt(size)[:, None] + self.bias)


def learn_domains(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Domains:
    """``labels``: ``doc_id, domain``."""
    known = labels.filter(F.col("domain").isNotNull())
    share = min(1.0, sample / max(1, known.count()))
    # a hash-threshold sample of ids: ``sample`` short rows expected, so small enough to broadcast
    some = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1_000_000)) < int(share * 1_000_000)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("domain").alias("domain"))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(some), "doc_id").select("doc_id", "domain", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [slots[a:b].astype("<u2").tobytes() for slots, ends, _ in word_slots(batch.column("text")) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("domain"), pa.array(found, pa.binary())], ["doc_id", "domain", "slots"])

    got = sorted(rows.mapInArrow(run, "doc_id long, domain string, slots binary").collect(), key=lambda r: (r["doc_id"], r["slots"]))
    names = sorted({r["domain"] for r in got}) or ["all"]
    if len(names) == 1:
        return Domains(names, np.zeros((WIDTH, 1), np.float32), np.zeros(1))
    parts = [np.frombuffer(r["slots"], "<u2").astype(np.int64) for r in got]
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    w, b = fit_softmax(np.concatenate(parts), ends, np.array([names.index(r["domain"]) for r in got]), len(names), WIDTH)
    return Domains(names, w.astype(np.float32), b)


def posteriors(docs: DataFrame, model: Domains) -> DataFrame:
    """``doc_id, n_tokens, posterior`` (an array in the order of ``model.names``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, p = [np.zeros(0, np.int64)], [np.zeros((0, len(model.names)))]
            for slots, ends, count in word_slots(batch.column("text")):
                n.append(count)
                p.append(model.posteriors(slots, ends))
            n, p = np.concatenate(n), np.concatenate(p)
            at = pa.array(np.arange(0, p.size + 1, len(model.names), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.ListArray.from_arrays(at, pa.array(p.ravel()))], ["doc_id", "n_tokens", "posterior"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, posterior array<double>")


@dataclass
class Steps:
    """Residuals so far; rates follow from them."""

    size: float
    keep: list[int]
    residuals: list[np.ndarray]

    def at(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rates, and the point where the next gradient is taken."""
        rate = ahead = np.ones(len(p))
        least = np.isin(p.argmax(1), self.keep).astype(float)
        momentum = 1.0
        for res in self.residuals:
            new = np.maximum(least, ahead - self.size * (p @ res))
            next_ = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
            ahead = new + (momentum - 1) / next_ * (new - rate)
            rate, momentum = new, next_
        return rate, ahead


def _matrix(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("n_tokens").to_numpy(zero_copy_only=False).astype(float), np.asarray(batch.column("posterior").flatten()).reshape(-1, k)


def _sums(table: DataFrame, k: int, of) -> np.ndarray:
    """Sum over all documents of the vectors that ``of(tokens, posteriors)`` gives; a row a task comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            v = of(*_matrix(batch, k))
            total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "v"])

    rows = table.select("n_tokens", "posterior").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    return np.array([v for _, v in sorted((r["i"], r["v"]) for r in rows)])


def fit_rates(table: DataFrame, names: list[str], weights: dict[str, float], keep: tuple[str, ...] = ()) -> tuple[Steps, dict[str, tuple[float, float, float]]]:
    """Steps, and for each domain its tokens before, target and tokens after.

    ``weights``: target share of each domain (others: none asked, they keep their
    share). The budget is the corpus size, or more where a domain in ``keep``
    would else get fewer tokens than it has. Documents whose likeliest
    domain is in ``keep`` have rates of 1 at least, others of 0.
    """
    k = len(names)
    both = _sums(table, k, lambda t, p: np.concatenate([[t.sum()], p.T @ t, ((p * t[:, None]).T @ p).ravel()]))
    if not len(both) or both[0] <= 0 or k == 1:
        return Steps(0.0, [], []), {}
    total, have = both[0], both[1 : k + 1]
    share = np.array([weights.get(x, have[i] / total) for i, x in enumerate(names)])
    share = share / share.sum()
    budget = max([total, *[have[i] / share[i] for i, x in enumerate(names) if x in keep and share[i] > 0]])
    target = share * budget
    steps = Steps(1 / np.linalg.eigvalsh(both[k + 1 :].reshape(k, k) / total).max(), [i for i, x in enumerate(names) if x in keep], [])
    norms: list[float] = []
    while True:
        now = _sums(table, k, lambda t, p, s=steps: p.T @ (t * s.at(p)[1]))
        res = (now - target) / total
        norms.append(float(np.abs(res).max()))
        if norms[-1] < CLOSE or len(norms) > STALL and min(norms[-STALL:]) > 0.99 * min(norms[:-STALL]):
            break
        steps = Steps(steps.size, steps.keep, [*steps.residuals, res])
    after = _sums(table, k, lambda t, p: p.T @ (t * steps.at(p)[0]))
    return steps, {x: (have[i], target[i], after[i]) for i, x in enumerate(names)}


def rated(table: DataFrame, names: list[str], steps: Steps) -> DataFrame:
    """The table with ``rate`` and ``copies``: the rate's whole part, and one more with its fraction as probability."""
    k = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate = steps.at(_matrix(batch, k)[1])[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], [*batch.schema.names, "rate"])

    out = table.mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in table.schema.fields)}, rate double")
    chance = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / (1 << 30)
    return out.withColumn("copies", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("long"))


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float], keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_tokens, domain`` (the likeliest), ``posterior, rate, copies`` of each document.

    ``missed``: by what share of all tokens the domain's expected total differs
    from its target (0 where none was asked).
    """
    model = learn_domains(docs, labels)
    table = materialise(posteriors(docs, model), "posteriors")
    steps, totals = fit_rates(table, model.names, weights, keep)
    every = sum(have for have, _, _ in totals.values()) or 1.0
    missed = F.coalesce(*[F.when(F.col("domain") == x, F.lit(float(after - target) / every)) for x, (_, target, after) in totals.items()], F.lit(0.0))
    names = F.array(*[F.lit(x) for x in model.names])
    domain = F.get(names, (F.array_position("posterior", F.array_max("posterior")) - 1).cast("int"))
    return rated(table, model.names, steps).select("doc_id", "n_tokens", domain.alias("domain"), "posterior", "rate", "copies").withColumn("missed", missed)
