"""Vectorised text helpers for tasks: whole Arrow batches as byte or code-point arrays.

Everything works on blocks of whole documents (a document is never cut), so
that memory is bounded by the block size or the longest document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

#: Polynomial hashes modulo a prime, by two bases at once (powers of two as moduli collide on Thue-Morse words).
PRIME, BASES = (1 << 31) - 1, (0x3C6EF372, 0x5BD1E995)
#: Odd multiplier that chains hashes of neighbours, each step mixed.
CHAIN = 0x9E3779B97F4A7C15
BLOCK = 1 << 18


@lru_cache(maxsize=1)
def _powers(size: int) -> np.ndarray:
    """For each base, its powers and those of its inverse."""
    out = np.ones((len(BASES), 2, size), np.uint32)
    for rows, base in zip(out, BASES, strict=True):
        for row, x in zip(rows, (base, pow(base, -1, PRIME)), strict=True):
            n = 1
            while n < size:
                row[n : 2 * n] = row[: min(n, size - n)].astype(np.uint64) * np.uint64(pow(x, n, PRIME)) % np.uint64(PRIME)
                n *= 2
    return out


def powers(n: int) -> np.ndarray:
    return _powers(1 << max(19, int(n).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """For each base, ``p[i]``: the sum of ``(values[j] + 1) * base**j`` for j < i, each term below 2**32."""
    n = len(values)
    out = np.zeros((len(BASES), n + 1), np.uint64)
    plus = values.astype(np.uint64) + np.uint64(1)
    for row, (up, _) in zip(out, powers(n), strict=True):
        x = plus * up[:n]
        np.cumsum((x & np.uint64(PRIME)) + (x >> np.uint64(31)), out=row[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of ``values[start:end]``, the same wherever these values lie."""
    out = (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for row, (_, down) in zip(prefix, powers(prefix.shape[1]), strict=True):
        out = mix(out ^ ((row[end] - row[start]) % np.uint64(PRIME) * down[start] % np.uint64(PRIME)))
    return out


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all items of the spans, one span after the other."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1], dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``size`` items, or one longer document."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def is_space(data: np.ndarray) -> np.ndarray:
    """Space and 0x09 to 0x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of a block, and each document's first word (one more at the end)."""
    solid = ~is_space(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], solid])
    after = np.concatenate([solid, [False]])
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    return start, end, np.searchsorted(start, offsets)


# ---- pre-tokens: the matches of the public pattern, found on code points ----

_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            table[ord(m[0][0]) : ord(m[0][-1]) + 1] = kind
    table[0xD800:0xE000] = _OTHER
    return table


def pretokens(text: str, offsets: np.ndarray, special: tuple[str, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of ``text``, starts of its pre-tokens (with the end), each document's first one.

    ``offsets``: where the joined documents begin, in code points. The pattern:
    contractions, then letters, numbers or other signs with at most one space
    before them, then white space, whose last character stays for what follows.
    Strings in ``special`` within a document end what is before them and are one
    pre-token each.
    """
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = len(points)
    if not n:
        return points, np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    documents, whole = offsets, _places(text, offsets, special)
    if len(whole):
        offsets = np.union1d(offsets, whole)
    kind = _classes()[points]
    begin = np.empty(n + 1, bool)
    begin[0] = begin[n] = True
    np.not_equal(kind[1:], kind[:-1], out=begin[1:n])
    begin[offsets] = True
    doc = np.zeros(n + 1, bool)
    doc[offsets] = True
    after = np.flatnonzero((kind[1:] != _SPACE) & (kind[:-1] == _SPACE) & ~doc[1:n]) + 1
    begin[after - 1] = True
    begin[after[points[after - 1] == 32]] = False
    quote = np.flatnonzero((points == 39) & begin[:n])
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == _LETTER) & ~doc[quote + 1]]
    one = quote[np.isin(points[quote + 1], [ord(x) for x in "stmd"])]
    begin[one + 1] = False
    begin[one + 2] = True
    two = quote[quote + 2 < n]
    two = two[~doc[two + 2]]
    pair = points[two + 1].astype(np.int64) << 32 | points[two + 2]
    two = two[np.isin(pair, [ord(x[0]) << 32 | ord(x[1]) for x in ("re", "ve", "ll")])]
    begin[two + 1] = False
    begin[two + 3] = True
    if len(whole):
        begin[expand(whole[:, 0] + 1, whole[:, 1] - whole[:, 0] - 1)] = False
    starts = np.flatnonzero(begin)
    return points, starts, np.searchsorted(starts, documents)


def _places(text: str, offsets: np.ndarray, strings: tuple[str, ...]) -> np.ndarray:
    """Start and end of each occurrence within a document, leftmost first and the longest of several that start together."""
    if not any(s in text for s in strings):
        return np.zeros((0, 2), np.int64)
    pattern = regex.compile("|".join(regex.escape(s) for s in sorted(strings, key=len, reverse=True)))
    found = [m.span() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) for m in pattern.finditer(text, a, b)]
    return np.array(found, np.int64).reshape(-1, 2)
