"""Periodic runs of words by harmonic grid probing, and texts with each run cut to its first period.

A run of period ``p`` and three periods or more holds ``w[i] == w[i + p]`` over a
stretch of at least ``2 * p`` places, so two neighbouring grid points ``j * p`` and
``(j + 1) * p`` lie in it. For each ``p`` only grid points are probed; over all ``p``
that is a harmonic sum, ``n * ln(n)`` probes for ``n`` words. Probes that hit at two
neighbouring points survive; a hash of the words between both points sifts them
(equal words have equal hashes, so nothing is lost), and what is left is extended
to both sides by comparing arrays in chunks, which alone decides. Grid points
within a stretch found for this ``p``, or within a run whose period divides ``p``,
are skipped: they would give the same run again, with a multiple of its period.

Runs longer than the hash asks add up to ``n * ln(n)`` places, so the work stays
near that bound for any text. A text is worked on whole, in memory of a few
numbers a word.

Defined results: a null or empty text has no words and no runs; ``doc_id`` may be
null; rows are independent, so repeated rows give repeated results; of the extra
columns those named in ``carry`` come along under their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblocks import blocks, expand, prefix_hash, span_hash, utf8, words

#: A run has at least ``PERIODS`` periods and ``WORDS`` words.
PERIODS, WORDS = 3, 24
#: Up to so many words the grid of all periods is probed at once.
TABLE = 4096
CHUNK = 64
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


@lru_cache(maxsize=1)
def _grid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grid points and periods for up to ``TABLE`` words by the last place probed, and how many need fewer than n words."""
    periods = np.arange(1, TABLE // PERIODS + 1)
    counts = (TABLE - 1) // periods - 1
    p = np.repeat(periods, counts)
    at = expand(np.zeros(len(periods), np.int64), counts) * p
    order = np.argsort(at + 2 * p, kind="stable")
    at, p = at[order].astype(np.int32), p[order].astype(np.int32)
    return at, p, np.searchsorted(at + 2 * p, np.arange(TABLE + 1))


def _survivors(word: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each period with the grid points whose words equal those one and two periods on, ascending."""
    n = len(word)
    if n <= TABLE:
        at, p, needs = _grid()
        at, p = at[: needs[n]], p[: needs[n]]
        hit = np.flatnonzero(word[at] == word[at + p])
        hit = hit[word[at[hit]] == word[at[hit] + 2 * p[hit]]]
        at, p = at[hit], p[hit]
        order = np.lexsort((at, p))
        at, p = at[order], p[order]
        edges = np.flatnonzero(np.diff(p, prepend=0, append=0))
        yield from ((int(p[a]), at[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True))
        return
    for p in range(1, n // PERIODS + 1):
        same = word[p::p] == word[: n - p : p]
        at = np.flatnonzero(same[:-1] & same[1:]) * p
        if len(at):
            yield p, at


def _forward(word: np.ndarray, at: int, p: int) -> int:
    """First place from ``at`` on that differs from the one ``p`` later."""
    n, size = len(word) - p, CHUNK
    while at < n:
        end = min(n, at + size)
        same = word[at:end] == word[at + p : end + p]
        if not same.all():
            return at + int(np.argmin(same))
        at, size = end, 2 * size
    return n


def _backward(word: np.ndarray, at: int, p: int) -> int:
    """First place of the stretch that ends before ``at``."""
    size = CHUNK
    while at > 0:
        begin = max(0, at - size)
        same = word[begin:at] == word[begin + p : at + p]
        if not same.all():
            return at - int(np.argmin(same[::-1]))
        at, size = begin, 2 * size
    return 0


def runs_of(word: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs in an array of word numbers, by start, then period."""
    if len(word) < WORDS:
        return []
    found: list[tuple[int, int, int]] = []
    inside: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by period: runs of a divisor
    prefix = None
    for p, at in _survivors(word):
        for a, b in inside.pop(p, ()):
            at = at[(at < a) | (at + p >= b)]
        if not len(at):
            continue
        prefix = prefix_hash(word) if prefix is None else prefix
        at = at.astype(np.int64)
        at = at[span_hash(prefix, at, at + p) == span_hash(prefix, at + p, at + 2 * p)]
        done = 0
        for i in at.tolist():
            if i < done:
                continue
            done = _forward(word, i, p)
            if done <= i + p and done + p < i + WORDS:
                continue
            start = _backward(word, i, p)
            length = done + p - start
            if length >= max(WORDS, PERIODS * p):
                found.append((start, length, p))
                for m in range(2 * p, min(length, len(word) // PERIODS + 1), p):
                    inside[m].append((start, start + length))
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words are in no run beyond its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, p in runs:
        edge[start + p] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def _numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word: equal ones for equal bytes."""
    text = data.tobytes()
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(text[a:b], len(seen)) for a, b in zip(start.tolist(), end.tolist(), strict=True)), np.int32, len(start))


def _document(data: np.ndarray, start: np.ndarray, end: np.ndarray, word: np.ndarray) -> tuple[list[tuple[int, int, int]], bytes]:
    runs = runs_of(word)
    if runs:
        keep = kept_words(len(word), runs)
        start, end = start[keep], end[keep]
    if not len(start):
        return runs, b""
    size = end - start + 1
    out = data[expand(start, size) if end[-1] < len(data) else np.minimum(expand(start, size), len(data) - 1)]
    out[np.cumsum(size) - 1] = 32
    return runs, out[:-1].tobytes()


def periodic_runs(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and ``collapsed`` (words outside repeats of a run, joined by one space) of each text.

    ``carry`` names further columns to pass through; clashing ones are refused.
    """
    carry = carry or []
    own = ["doc_id", "n_words", "runs", "collapsed"]
    if clash := sorted(set(carry) & set(own)):
        raise ValueError(f"columns of the result cannot be carried: {clash}")
    kept = [f"_c{i}" for i in range(len(carry))]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *[F.col(f"`{c}`").alias(k) for c, k in zip(carry, kept, strict=True)])
    run = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for first, last in blocks(offsets):
                part = data[offsets[first] : offsets[last]]
                start, end, top = words(part, offsets[first : last + 1] - offsets[first])
                word = _numbers(part, start, end)
                found = [_document(part, start[a:b], end[a:b], word[a:b]) for a, b in zip(top[:-1].tolist(), top[1:].tolist(), strict=True)]
                some = batch.slice(first, last - first)
                runs = pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r, _ in found], run)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(np.diff(top), pa.int64()), runs, pa.array([t for _, t in found], pa.binary()).cast(pa.string()), *[some.column(k) for k in kept]], [*own, *kept]
                )

    kinds = "".join(f", {k} {t.dataType.simpleString()}" for k, t in ((k, rows.schema[k]) for k in kept))
    found = rows.mapInArrow(find, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string{kinds}")
    return found.select(*own, *[F.col(k).alias(c) for c, k in zip(carry, kept, strict=True)])
