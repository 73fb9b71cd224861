"""Byte-level BPE encoding and decoding.

Token bytes map one to one to Latin-1 characters for an Aho-Corasick automaton,
which lists the tokens that start at each byte of a pre-token. The encoder walks
from longest matches on and steps back where no token fits any more; each listed
match is tried once, so the time is linear in the matches.

Two tokens fit beside each other if merging their joined bytes by rank would
leave exactly these two. Merging one token on its own has a timetable: the pieces
that touch its right (left) end, and the rank of the merge that makes each. Two
timetables are played forward together; the tokens fit unless a merge across the
seam comes due while its two pieces are there. Answers are memoised. A chain of
tokens that fit pairwise is the outcome of the exact merge order.

Defined results: a null text counts as empty (no ids); a null ``doc_id`` passes
through; rows are independent, so repeated rows give repeated results; extra
columns are ignored, whatever their names; a text of any length is encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import os
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblocks import blocks, expand, prefix_hash, pretokens, span_hash, utf8

#: Entries that a worker keeps of each memo; beyond that it starts anew.
MEMO = 300_000
BLOCK = 1 << 19
OUT = ("n_tokens", "ids_sha256", "decoded_sha256")
_NEVER = 1 << 62

#: (bytes of the piece, rank of the merge that makes it), from the single byte to the whole token.
Timetable = list[tuple[bytes, int]]


class Vocabulary:
    """Token bytes by id (which is the rank), and the encoder's memos."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.ids.values()) + 1
        self.bytes = [b""] * size
        for token, i in self.ids.items():
            self.bytes[i] = token
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        self._ends: dict[int, tuple[Timetable, Timetable] | None] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self.sizes = [len(t) for t in self.bytes]
        self.lengths = np.array(self.sizes, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)

    def timetables(self, token: int) -> tuple[Timetable, Timetable] | None:
        """Pieces at the right and at the left end while the token's bytes are merged; None if they never make one token."""
        if token not in self._ends:
            parts = [self.bytes[token][i : i + 1] for i in range(len(self.bytes[token]))]
            right, left = [(parts[-1], -1)], [(parts[0], -1)]
            while len(parts) > 1:
                rank, at = min((self.ids.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts[:-1], parts[1:], strict=True)))
                if rank == _NEVER:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                if at == len(parts) - 1:
                    right.append((parts[-1], rank))
                if at == 0:
                    left.append((parts[0], rank))
            self._ends[token] = (right, left) if len(parts) == 1 else None
        return self._ends[token]

    def _stay_apart(self, left: int, right: int) -> bool:
        ends, starts = self.timetables(left), self.timetables(right)
        if ends is None or starts is None:
            return False
        ends, starts = ends[0], starts[1]
        i = j = 0
        while True:
            next_left = ends[i + 1][1] if i + 1 < len(ends) else _NEVER
            next_right = starts[j + 1][1] if j + 1 < len(starts) else _NEVER
            seam = self.ids.get(ends[i][0] + starts[j][0], _NEVER)
            # of equal ranks the leftmost merge comes first: the left token's own, then the seam's
            if seam < next_left and seam <= next_right and seam < _NEVER:
                return False
            if next_left == next_right == _NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens may stand side by side."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= MEMO:
                self._fits.clear()
            known = self._fits[left, right] = self._stay_apart(left, right)
        return known

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ids.get(piece)
        if whole is not None:
            return [whole]
        n, sizes, known, fits = len(piece), self.sizes, self._fits, self.fits
        untried: list[list[int]] = [[] for _ in piece]
        for last, (token, size) in self.automaton.iter(piece.decode("latin-1")):
            untried[last - size + 1].append(token)  # ends ascend: the longest is popped first
        reached, chain, at, before = bytearray(n + 1), [], 0, -1
        while at < n:
            here = untried[at]
            while here:
                token = here.pop()
                end = at + sizes[token]
                # a place is reached by one chain only, so a second arrival would fail again
                if not reached[end] and (before < 0 or (known[before, token] if (before, token) in known else fits(before, token))):
                    reached[end] = 1
                    chain.append(token)
                    at, before = end, token
                    break
            else:
                if not chain:
                    raise ValueError("the vocabulary lacks a byte of the text")
                at -= sizes[chain.pop()]
                before = chain[-1] if chain else -1
        return chain

    def encode_words(self, words: list[str]) -> list[bytes]:
        return [array("I", self.encode(w.encode("utf-8"))).tobytes() for w in words]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of all ids in one array."""
        return self.flat[expand(self.starts[ids], self.lengths[ids])]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _distinct(points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A representative of each kind of pre-token and the kind of each; equal hashes count only if the characters agree."""
    keys, one, each = np.unique(span_hash(prefix_hash(points), begin, end), return_index=True, return_inverse=True)
    like = one[each]
    same = end - begin == end[like] - begin[like]
    if same.all():
        same = np.logical_and.reduceat(points[: end[-1]] == points[expand(begin[like], end - begin)], begin)
    odd = np.flatnonzero(~same)
    each[odd] = len(one) + np.arange(len(odd))
    return np.concatenate([one, odd]), each


def encode_batch(column: pa.Array, encode_words: Callable[[list[str]], list[bytes]], memo: dict[str, bytes], special: tuple[str, ...] = ()) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each block of documents: first, last, ids, and where each document's ids begin.

    Distinct pre-tokens of a block are encoded once; ``memo`` keeps them by their
    characters. Strings in ``special`` are pre-tokens of their own.
    """
    data, offsets = utf8(column)
    for first, last in blocks(offsets, BLOCK):
        part = data[offsets[first] : offsets[last]]
        text = part.tobytes().decode("utf-8")
        at = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])[offsets[first : last + 1] - offsets[first]]
        points, starts, tops = pretokens(text, at, special)
        begin, end = starts[:-1], starts[1:]
        if not len(begin):
            yield first, last, np.zeros(0, "<u4"), np.zeros(len(tops), np.int64)
            continue
        one, each = _distinct(points, begin, end)
        words = [text[b:e] for b, e in zip(begin[one].tolist(), end[one].tolist(), strict=True)]
        if len(memo) > MEMO:
            memo.clear()
        known = list(map(memo.get, words))
        new = [i for i, v in enumerate(known) if v is None]
        for i, v in zip(new, encode_words([words[i] for i in new]), strict=True):
            known[i] = memo[words[i]] = v
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat = np.frombuffer(b"".join(known), "<u4")
        counts = size[each]
        ids = flat[expand((np.cumsum(size) - size)[each], counts)]
        yield first, last, ids, np.concatenate([[0], np.cumsum(counts)])[tops]


def tokenizer_file(path: str) -> str:
    """The same path on an executor, or the copy that ``SparkContext.addFile`` sent there."""
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def bpe_round_trip(docs: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id``, number of ids, digests of the ids (little-endian uint32) and of the decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, memo = vocabulary(tokenizer_file(ranks_path)), _MEMO.setdefault(ranks_path, {})
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for first, last, ids, tops in encode_batch(batch.column("text"), vocab.encode_words, memo):
                raw, decoded = ids.astype("<u4"), vocab.decode(ids)
                ends = np.concatenate([[0], np.cumsum(vocab.lengths[ids])])[tops]
                for i in range(last - first):
                    a, b = tops[i], tops[i + 1]
                    n.append(int(b - a))
                    ids_sha.append(hashlib.sha256(raw[a:b]).hexdigest())
                    text_sha.append(hashlib.sha256(decoded[ends[i] : ends[i + 1]]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", *OUT])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


#: Memos of a Python worker, by vocabulary.
_MEMO: dict[str, dict[str, bytes]] = {}
