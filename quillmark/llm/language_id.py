"""Language identification by error-correcting output codes.

Every language gets a codeword of +1 and -1; one binary logistic classifier on
hashed byte n-grams of the lower-cased text predicts each bit. Decoding weighs
the logistic loss of each bit by how well that bit's classifier did on held-back
sample rows of the language, and takes the nearest codeword. A small lead over
the second nearest marks a text as ambiguous.

Training reads about ``SAMPLE`` labelled documents, or ``EACH`` for every language
where there are many, dealt evenly to the languages by a hash of ``doc_id`` and
text; every language with a label is learned, and prediction reads whole texts.

Defined results: ``und`` with score 0 for a text that is null or has no letter,
or where no language could be learned; with one learned language every other
text gets it with score 1; of equal losses the language that comes first in the
alphabet wins; a null ``doc_id`` is never learned from and not held out; rows are
independent, so repeated rows give repeated results; extra columns are ignored
unless carried, and carried ones named like a result give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textblocks import blocks, mix, utf8

#: Expected labelled rows to learn from: in all, and at least so many for each language.
SAMPLE, EACH = 3000, 40
FEATURES = 1 << 12
#: Texts whose features are held at once.
ROWS = 512
ORDERS = (1, 2, 3, 4)
#: A lead in weighted loss below this marks a text as ambiguous.
LEAD = 0.05
OUT = ("held_out", "lang_pred", "score", "ambiguous")


def fold(doc_id: str | Column) -> Column:
    """crc32 of the id's decimal text, modulo 5; fold 0 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 if isinstance(doc_id, str) else F.crc32(doc_id.cast("string").cast("binary")) % 5


def codewords(k: int) -> np.ndarray:
    """A row of +1/-1 for each of ``k`` classes: exhaustive up to 7, else random with a large least distance."""
    if k <= 7:
        bits = [(1, *b) for b in product((1, -1), repeat=k - 1) if -1 in b]
        return np.array(bits or [(1,)], np.float32).T
    rng, best, far = np.random.default_rng(k), None, -1
    for _ in range(200):
        m = rng.choice(np.array([-1, 1], np.float32), (k, 10 * int(np.ceil(np.log2(k)))))
        d = (m.shape[1] - m @ m.T)[~np.eye(k, dtype=bool)].min()
        used = np.abs(m.sum(0)) < k
        if d > far and used.all():
            best, far = m, d
    return best


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """Rows of hashed n-gram weights (square roots of counts, unit length) of whole texts, block by block."""
    data, offsets = utf8(column)
    few = ((a, min(a + ROWS, last)) for first, last in blocks(offsets) for a in range(first, last, ROWS))
    for first, last in few:
        part, at = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        signs = (part < 128) & ~((part >= 97) & (part <= 122))
        part = np.where(signs, np.uint8(32), part).astype(np.uint32)
        n, docs = len(part), last - first
        doc = np.repeat(np.arange(docs, dtype=np.int64), np.diff(at))
        x = np.zeros(docs * FEATURES, np.float32)
        code = np.zeros(n, np.uint64)
        for k in ORDERS:
            if n < k:
                break
            code = code[: n - k + 1] * np.uint64(257) + part[k - 1 :] + np.uint64(1)
            same = doc[: n - k + 1] == doc[k - 1 :]
            slot = (mix(code + np.uint64(k << 56)) % np.uint64(FEATURES)).astype(np.int64)
            np.add.at(x, (doc[: n - k + 1] * FEATURES + slot)[same], np.float32(1))
        x = np.sqrt(x).reshape(docs, FEATURES)
        yield x / np.maximum(1e-6, np.linalg.norm(x, axis=1, keepdims=True))


@dataclass
class Codes:
    """Learned model: ``FEATURES`` weights for each bit, about 10 bits for a doubling of the languages."""

    langs: list[str]
    words: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        margin = np.clip(x @ self.weights + self.bias, -30, 30)
        loss = np.log1p(np.exp(-margin[:, None, :] * self.words[None]))
        return (loss * self.trust[None]).sum(2) / self.trust.sum(1)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, score and lead of each row."""
        loss = self.losses(x)
        if loss.shape[1] == 1:
            return np.zeros(len(x), int), np.ones(len(x)), np.full(len(x), np.inf)
        order = np.sort(loss, axis=1)
        p = np.exp(-4 * (loss - order[:, :1]))
        return loss.argmin(1), 1 / p.sum(1), order[:, 1] - order[:, 0]


def _fit(x: np.ndarray, y: np.ndarray, steps: int = 150, rate: float = 20.0, ridge: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regressions of all bits at once, by accelerated gradient steps."""
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    vw, vb = w.copy(), b.copy()
    for _ in range(steps):
        g = -y / (1 + np.exp(np.clip(y * (x @ (w + 0.9 * vw) + b + 0.9 * vb), -30, 30)))
        vw = 0.9 * vw - rate * (x.T @ g / len(x) + ridge * w).astype(np.float32) * 0.1
        vb = 0.9 * vb - rate * g.mean(0) * 0.1
        w, b = w + vw, b + vb
    return w, b


def train(docs: DataFrame, sample: int = SAMPLE) -> Codes | None:
    """Learn from text and lang of rows outside fold 0; None without a language."""
    known = docs.filter(F.col("lang").isNotNull() & (fold("doc_id") != 0) & F.col("text").rlike(r"\p{L}"))
    # a count for each language: one row a language
    counts = {r["lang"]: r["count"] for r in docs.filter(F.col("lang").isNotNull() & (fold("doc_id") != 0)).groupBy("lang").count().collect()}
    if not counts:
        return None
    each = max(EACH, sample / len(counts))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, each / n))])
    drawn = F.pmod(F.xxhash64("doc_id", F.octet_length("text"), F.lit(11)), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000
    some = known.filter(drawn).select(F.col("doc_id").cast("long"), "lang", F.lower("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r.astype(np.float16).tobytes() for x in features(batch.column("text")) for r in x]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(rows, pa.binary())], ["doc_id", "lang", "x"])

    rows = sorted(some.mapInArrow(run, "doc_id long, lang string, x binary").collect(), key=lambda r: (r["doc_id"], r["x"]))
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return None
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    t = np.array([langs.index(r["lang"]) for r in rows])
    words = codewords(len(langs))
    trust = np.ones_like(words)
    if len(langs) > 1:
        held = np.arange(len(rows)) % 5 == 0
        w, b = _fit(x[~held], words[t[~held]])
        right = (np.sign(x[held] @ w + b) == words[t[held]]).astype(np.float32)
        for k in range(len(langs)):
            if (t[held] == k).any():
                trust[k] = right[t[held] == k].mean(0)
        trust = np.maximum(trust, 0.05)
        w, b = _fit(x, words[t])
    else:
        w, b = np.zeros((FEATURES, 1), np.float32), np.zeros(1, np.float32)
    return Codes(langs, words, w, b, trust)


def identify(docs: DataFrame, model: Codes | None, carry: list[str] | None = None) -> DataFrame:
    """``doc_id``, the ``carry`` columns and ``held_out, lang_pred, score, ambiguous``."""
    carry = [c for c in carry or [] if c not in ("doc_id", *OUT)]
    kept = [F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)]
    rows = docs.select(F.col("doc_id").cast("long"), *kept, F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"), F.lower(F.coalesce("text", F.lit(""))).alias("_text"))
    fields = [f for f in rows.schema.fields if f.name not in ("_letters", "_text")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", lang_pred string, score double, ambiguous boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = np.asarray(batch.column("_letters").to_pylist(), bool)
            lang, score, doubt = np.full(len(letters), "und", object), np.zeros(len(letters)), np.zeros(len(letters), bool)
            if model is not None and len(letters):
                found = [model.decode(x) for x in features(batch.column("_text"))]
                best, p, lead = (np.concatenate(v) for v in zip(*found, strict=True))
                lang = np.where(letters, np.array(model.langs, object)[best], "und")
                score, doubt = np.where(letters, p, 0.0), letters & (lead < LEAD)
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in fields], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(doubt, pa.bool_())], [*[f.name for f in fields], *OUT[1:]])

    out = rows.mapInArrow(run, schema)
    return out.select("doc_id", *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], *OUT)
