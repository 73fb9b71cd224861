"""Removal of long repeats by longest-previous-factor arrays.

Bytes covered by a string of ``length`` bytes that also starts elsewhere are
removed: all copies (``keep="none"``) or all but the first (``keep="first"``).

Suffixes of a whole corpus cannot be sorted in one place, so windows of
``length`` bytes are dealt out by content. Each window belongs to its minimiser,
the k-gram of the least hash inside it; equal windows have equal minimisers at
equal offsets, so they meet in one group.

1. One pass finds the minimisers ("anchors") of all whole texts, each with the run
   of windows that it owns; k-grams that occur once are dropped.
2. The bytes around the remaining anchors ("members") are cut out of the texts and
   written, text by text: neighbours overlap, so that the table is small, and the
   shuffle of the texts is over before members are grouped by k-gram. Of each group a
   task builds the suffix order, the common prefixes of neighbours, and from the
   previous and next smaller positions in that order each suffix's longest previous
   factor (``previous_factors``). A window whose factor has ``length`` bytes is a
   later copy. With larger positions in place of smaller ones the same gives longest
   next factors, so that first copies are found as well. Members that are equal byte
   for byte stand for each other and enter the arrays once.
3. A group of more than ``GROUP`` members is not sent to one task: Spark counts its
   equal members first (grouped by their bytes, partly before the shuffle). One of
   each kind goes on; if still too many, each is cut in two by where its windows lie,
   with a longer gram (the k-gram and what is next to it) as the new group. A gram
   reaches ``length`` after eight cuts at most, and then the group is one kind.

Defined results: a null text is empty; matches never cross rows; texts shorter
than ``length`` bytes keep all; repeated rows are copies of each other like any
others; where ids repeat or are null, rows are told apart by their place in a
written copy of the table, and ``keep="first"`` keeps the copy that comes first
there (else that of the smallest ``doc_id``); extra columns are ignored, whatever
their names; an empty table gives an empty result. Long texts are read in pieces
that overlap by ``length`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import keyed, materialise
from .textblocks import BLOCK, CHAIN, blocks, expand, mix, utf8

LENGTH, GRAM = 200, 32
#: Members of a group that one task sorts; bytes of groups held at once; members that are cut out of texts at once.
GROUP, HELD, MEMBERS = 1024, 1 << 20, 1 << 13
OUT = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_ITEM = "g long, key long, lo int, off int, gram int, bytes binary, large boolean"
_SPANS = "key long, a int, b int"


# ---- anchors ----


def _slide(a: np.ndarray, width: int, f) -> np.ndarray:
    """``f`` over each run of ``width`` items, by doubling."""
    n = 1
    while n * 2 <= width:
        a = f(a[:-n], a[n:])
        n *= 2
    return f(a[: len(a) - (width - n)], a[width - n :]) if n < width else a


def _gram_codes(data: np.ndarray, gram: int) -> np.ndarray:
    """A code of each k-gram; it only deals windows out, so that codes need not be unique."""
    return mix(_slide((data.astype(np.uint64) + np.uint64(1)) * np.uint64(CHAIN), gram, lambda x, y: x * np.uint64(0xD6E8FEB86659FD93) + (y ^ (y >> np.uint64(29)))))


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of a block of texts: text number, k-gram code and position, first and last owned window."""
    n, width = len(data), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none, none, none
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    g = _gram_codes(data, gram)
    g[g == _TOP] = 1
    g[doc[: n - gram + 1] != doc[gram - 1 :]] = _TOP
    m = _slide(g, width, np.minimum)
    m[doc[: n - length + 1] != doc[length - 1 :]] = 0
    pad = np.zeros(width - 1, np.uint64)
    p = np.flatnonzero((_slide(np.concatenate([pad, m, pad]), width, np.maximum) == g) & (g != _TOP))
    h = g[p]
    begin, end = offsets[doc[p]], offsets[doc[p] + 1]
    lo, hi = np.maximum(p - width + 1, begin), np.minimum(p, end - length)
    left, step = np.arange(len(p)), 1  # the nearest anchor before that is no larger takes the windows that hold both
    while len(left):
        left = left[left >= step]
        left = left[p[left - step] >= lo[left]]
        taken = h[left - step] <= h[left]
        lo[left[taken]] = p[left[taken] - step] + 1
        left, step = left[~taken], step + 1
    left, step = np.arange(len(p)), 1  # and the nearest smaller one after
    while len(left):
        left = left[left + step < len(p)]
        left = left[p[left + step] - width + 1 <= hi[left]]
        taken = h[left + step] < h[left]
        hi[left[taken]] = np.minimum(hi[left[taken]], p[left[taken] + step] - width)
        left, step = left[~taken], step + 1
    ok = hi >= lo
    p, lo, hi, h, begin = p[ok], lo[ok], hi[ok], h[ok], begin[ok]
    return doc[p].astype(np.int64), h, p - begin, lo - begin, hi - begin


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """First text, place of its part within it, and bounds in the data; long texts in parts of whole windows."""
    for first, last in blocks(offsets, BLOCK):
        a, b = int(offsets[first]), int(offsets[last])
        if last - first > 1 or b - a <= 2 * BLOCK:
            yield first, 0, offsets[first : last + 1]
        else:
            for s in range(a, b - length + 1, BLOCK):
                yield first, s - a, np.array([s, min(s + BLOCK + length - 1, b)])


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            keys = np.asarray(batch.column("key").to_numpy(zero_copy_only=False), np.int64)
            for first, place, at in _pieces(offsets, length):
                doc, h, p, lo, hi = anchors(data[at[0] : at[-1]], at - at[0], length, gram)
                at = lo + place << 32 | (p - lo) << 16 | (hi - lo)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(keys[first + doc]), pa.array(at)], ["h", "key", "at"])

    return run


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])


def _members(length: int, gram: int):
    """Of each text, the bytes around its open anchors, from its start to its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            keys = np.asarray(batch.column("key").to_numpy(zero_copy_only=False), np.int64)
            lists = batch.column("open")
            flat = lists.flatten()
            h, at, large = (flat.field(c).to_numpy(zero_copy_only=False) for c in range(3))
            owner = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
            order = np.lexsort((at, owner))  # ``at`` begins with the first window
            h, at, large, owner = h[order], at[order], large[order], owner[order]
            for k in range(0, len(h), MEMBERS):
                own, x = owner[k : k + MEMBERS], at[k : k + MEMBERS]
                lo, size = x >> 32, (x & 0xFFFF) + length
                bytes_ = _binary(data[expand(offsets[own] + lo, size)], size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[k : k + MEMBERS]), pa.array(keys[own]), pa.array(lo.astype(np.int32)), pa.array((x >> 16 & 0xFFFF).astype(np.int32)), pa.array(np.full(len(x), gram, np.int32)), bytes_, pa.array(large[k : k + MEMBERS])],
                    ["g", "key", "lo", "off", "gram", "bytes", "large"],
                )

    return run


# ---- factor arrays ----


def _suffix_levels(data: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of all substrings of 8, 16, 32 ... bytes, up to ``length``, by doubling."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data),), ">u8", padded, strides=(1,)).astype(np.uint64)
    levels = [(8, np.unique(eight, return_inverse=True)[1])]
    while levels[-1][0] * 2 <= length and len(levels[-1][1]) > levels[-1][0]:
        w, r = levels[-1]
        levels.append((2 * w, np.unique(r[:-w] * (len(data) + 1) + r[w:], return_inverse=True)[1]))
    return levels


def _common(data: np.ndarray, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, to ``length`` bytes."""
    out = np.zeros(len(a), np.int64)
    for w, r in reversed(levels):
        live = np.flatnonzero(out + w <= length)
        live = live[r[a[live] + out[live]] == r[b[live] + out[live]]]
        out[live] += w
    live = np.flatnonzero(out < length)
    while len(live):
        live = live[data[a[live] + out[live]] == data[b[live] + out[live]]]
        out[live] += 1
        live = live[out[live] < length]
    return out


def _towards_smaller(position: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """Of each suffix, in suffix order, the prefix it shares with the nearest one before it that has a smaller position.

    ``common[i]``: prefix shared with the one before. Candidates are skipped by
    jumping along their own candidates; a shared prefix below ``least`` ends the
    search and counts as 0.
    """
    at, shared = np.arange(len(position)) - 1, common.copy()
    shared[:1] = 0
    live = np.flatnonzero((at >= 0) & (shared >= least))
    while len(live):
        live = live[position[at[live]] > position[live]]
        over = at[live]
        shared[live], at[live] = np.minimum(shared[live], shared[over]), at[over]
        live = live[(at[live] >= 0) & (shared[live] >= least)]
    return np.where(shared >= least, shared, 0)


def previous_factors(data: np.ndarray, starts: np.ndarray, position: np.ndarray, length: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factors of the suffixes at ``starts``, to ``length`` bytes.

    ``position``: their distinct places in the text. Each suffix has ``length``
    bytes of its own text. Factors shorter than ``least`` count as 0.
    """
    levels = _suffix_levels(data, length)
    w, r = levels[-1]
    order = np.lexsort((position, r[starts + length - w], r[starts]))
    placed = position[order]
    common = np.concatenate([[0], _common(data, levels, starts[order[:-1]], starts[order[1:]], length)])
    back = np.concatenate([common[1:], [0]])[::-1]  # the same order read from its end
    out = []
    for sign in (1, -1):
        factor = np.empty(len(starts), np.int64)
        factor[order] = np.maximum(_towards_smaller(sign * placed, common, least), _towards_smaller(sign * placed[::-1], back, least)[::-1])
        out.append(factor)
    return out[0], out[1]


def _runs(flags: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true flags; runs end at ``edges``."""
    edge = np.zeros(len(flags) + 1, bool)
    edge[edges] = True
    before, after = np.concatenate([[False], flags]), np.concatenate([flags, [False]])
    return np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge)) - 1


def _factors_of_groups(length: int, keep: str):
    """Spans to remove from items sorted by group and position."""

    def settle(rows: pa.Table) -> pa.RecordBatch:
        g, key, lo = (rows.column(c).to_numpy().astype(np.int64) for c in ("g", "key", "lo"))
        kinds: dict[tuple[int, bytes], int] = {}
        kind = np.array([kinds.setdefault(x, len(kinds)) for x in zip(g.tolist(), rows.column("bytes").to_pylist(), strict=True)])
        one = np.unique(kind, return_index=True)[1]  # rows come in the order of positions, so the first is the earliest
        data, offsets = utf8(rows.column("bytes"))
        copy = np.ones(len(kind), bool)
        if keep == "first":
            copy[one] = False
        else:
            copy = (np.bincount(kind) > 1)[kind]
        spans = [(key[copy], lo[copy], lo[copy] + np.diff(offsets)[copy])]
        _, at, mates = np.unique(g[one], return_inverse=True, return_counts=True)
        several = one[mates[at] > 1]
        if len(several):
            sizes = (offsets[several + 1] - offsets[several]).astype(np.int64)
            own = data[expand(offsets[several], sizes)]
            ends = np.cumsum(sizes)
            counts = sizes - length + 1
            starts = expand(ends - sizes, counts)
            owner = np.repeat(np.arange(len(several)), counts)
            base = lo[several] - (ends - sizes)
            place = np.empty(len(starts), np.int64)
            place[np.lexsort((starts + base[owner], key[several][owner]))] = np.arange(len(starts))
            before, after = previous_factors(own, starts, place, length, length)
            windows = np.concatenate([[0], np.cumsum(counts)])
            first, last = _runs((before if keep == "first" else np.maximum(before, after)) >= length, windows)
            who = owner[first]
            spans.append((key[several][who], starts[first] + base[who], starts[last] + base[who] + length))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(t)) for x, t in zip(zip(*spans, strict=True), (np.int64, np.int32, np.int32), strict=True)], ["key", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            for k in range(0, batch.num_rows, MEMBERS):
                rest.append(batch.slice(k, MEMBERS))
                held += MEMBERS * length
                if held >= HELD:
                    # groups are whole: the last one of what is held stays until the next begins
                    rows = pa.Table.from_batches(rest)
                    g = rows.column("g").to_numpy()
                    cut = int(np.flatnonzero(g == g[-1])[0])
                    yield from map(settle, _portions(rows.slice(0, cut), g[:cut]))
                    rest = rows.slice(cut).to_batches()
                    held = (rows.num_rows - cut) * length
        if rest:
            rows = pa.Table.from_batches(rest)
            yield from map(settle, _portions(rows, rows.column("g").to_numpy()))

    return run


def _portions(rows: pa.Table, g: np.ndarray) -> Iterator[pa.Table]:
    """Whole groups of about ``GROUP`` members in all."""
    if len(g):
        starts = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]])
        for i, j in blocks(starts, GROUP):
            yield rows.slice(int(starts[i]), int(starts[j] - starts[i])).combine_chunks()


# ---- plan ----


def _halves(items: DataFrame, length: int) -> DataFrame:
    """Each item as two, by whether its windows reach far enough right of the gram; grams grow to that side."""
    need = F.ceil((length - F.col("gram")) / 2).cast("int")
    far = F.col("off") + F.col("gram") + need - length  # the first window with ``need`` bytes right of the gram
    last = F.octet_length("bytes") - length
    skip = F.greatest(far, F.lit(0))
    more = length - F.col("gram") - need + 1
    right = F.struct((F.col("lo") + skip).alias("lo"), (F.col("off") - skip).alias("off"), (F.col("gram") + need).alias("gram"), F.substring("bytes", skip + 1, F.octet_length("bytes")).alias("bytes"), F.lit(1).alias("side"))
    left = F.struct(F.col("lo"), (F.col("off") - more).alias("off"), (F.col("gram") + more).alias("gram"), F.substring("bytes", F.lit(1), F.least(far - 1, last) + length).alias("bytes"), F.lit(0).alias("side"))
    halves = F.array_compact(F.array(F.when(last >= far, right), F.when(far > 0, left)))
    x = items.select("g", "key", F.explode(halves).alias("x"))
    group = F.xxhash64("g", "x.side", F.substring(F.col("x.bytes"), F.col("x.off") + 1, F.col("x.gram")))
    return x.select(group.alias("g"), "key", "x.lo", "x.off", "x.gram", "x.bytes")


def _sorted_spans(items: DataFrame, length: int, keep: str) -> DataFrame:
    return items.select("g", "key", "lo", "bytes").repartition("g").sortWithinPartitions("g", "key", "lo").mapInArrow(_factors_of_groups(length, keep), _SPANS)


def _large_spans(items: DataFrame, length: int, keep: str, group: int) -> list[DataFrame]:
    """Spans from the (written) members of large groups."""
    out = []
    while True:
        same = ["g", "off", "gram", "bytes"]
        kinds = materialise(items.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "lo")).alias("one")), "kinds")
        copies = items.join(kinds.filter("n > 1"), same)
        if keep == "first":
            copies = copies.filter((F.col("key") != F.col("one.key")) | (F.col("lo") != F.col("one.lo")))
        out.append(materialise(copies.select("key", F.col("lo").alias("a"), (F.col("lo") + F.octet_length("bytes")).alias("b")), "copies"))
        many = materialise(kinds.groupBy("g").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "many")
        left = kinds.join(many, "g").select("g", F.col("one.key").alias("key"), F.col("one.lo").alias("lo"), "off", "gram", "bytes", "m")
        out.append(_sorted_spans(left.filter(F.col("m") <= group), length, keep))
        if many.filter(F.col("m") > group).isEmpty():
            return out
        items = materialise(_halves(left.filter(F.col("m") > group), length), "halves")


def repeated_spans(rows: DataFrame, length: int = LENGTH, keep: str = "none", gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """Spans ``key, a, b`` (bytes, end exclusive; they may overlap) to remove from ``key, doc_id, text``."""
    long_ = rows.filter(F.octet_length("text") >= length)
    # written once: counted first, then joined, with a shuffle of its own that can be split where a k-gram is very common
    found = materialise(long_.select("key", "text").mapInArrow(_anchor_rows(length, gram), "h long, key long, at long"), "anchors")
    grams = materialise(found.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "grams")
    shared = materialise(found.join(grams.select("h", (F.col("c") > group).alias("large")), "h"), "shared")
    open_ = shared.groupBy("key").agg(F.collect_list(F.struct("h", "at", "large")).alias("open"))  # no more than the text has anchors
    # written once for small and large groups, so that no shuffle of texts lies on disk while members are dealt out
    members = materialise(long_.join(open_, "key").select("key", "text", "open").mapInArrow(_members(length, gram), _ITEM), "members", compression="zstd")
    spans = [_sorted_spans(members.filter("not large"), length, keep)]
    if not grams.filter(F.col("c") > group).isEmpty():
        spans += _large_spans(members.filter("large"), length, keep, group)
    return reduce(DataFrame.unionByName, spans)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        lists = batch.column("spans")
        at = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))])
        flat = lists.flatten()
        a, b = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
        removed, runs, sha = [], [], []
        for first, last in blocks(offsets):
            part, ends = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            own = slice(at[first], at[last])
            base = np.repeat(ends[:-1], np.diff(at[first : last + 1]))
            step = np.bincount(base + a[own], minlength=len(part) + 1) - np.bincount(base + b[own], minlength=len(part) + 1)
            gone = np.cumsum(step)[:-1] > 0
            kept = part[~gone]
            upto = np.concatenate([[0], np.cumsum(gone)])[ends]
            removed += np.diff(upto).tolist()
            runs += np.diff(np.searchsorted(_runs(gone, ends)[0], ends)).tolist()
            left = (ends - upto).tolist()
            sha += [hashlib.sha256(kept[x:y]).hexdigest() for x, y in zip(left[:-1], left[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string())], ["doc_id", *OUT])


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none", **more) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row of ``docs``."""
    rows = keyed(docs)
    spans = materialise(repeated_spans(rows, length, keep, **more).groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans")
    return rows.join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
