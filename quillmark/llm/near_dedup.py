"""MinHash near-de-duplication by an inverted join on signature coordinates.

1. Each document's five-word shingles are hashed; equal sets form one class.
2. Each class has ``COORDINATES`` MinHash values. A (coordinate, value) pair is a
   posting key. Keys of one class alone are skipped. A pair of classes counts as
   a candidate with ``MATCHES`` or more collisions, so it must collide within the
   ``PREFIX`` rarest keys of both: only those are posted (prefix and skip).
   At the threshold itself a pair has 36 collisions on average, and fewer than
   22 with a probability of about 3e-6.
3. Star rounds: every posting list has a pivot, drawn anew for each list and
   round; each class is tried against the pivot it collides with most often,
   unless both are connected already. This joins large groups of copies with one
   row a class and round instead of all pairs.
4. What star rounds leave is covered in full: members of a posting list outside
   its largest component meet all members of other components. Lists of up to
   ``SMALL`` members do so in a skew-splitting join whose condition holds the
   length bound and the collision count. Longer lists are cut into blocks of about
   ``BLOCK`` members: a task takes the signatures of two blocks and returns the
   members that have candidates; only the texts of these are then sent, and a task
   confirms them, skipping pairs that its own links connect already.
5. Links are confirmed on the full shingle sets. Components follow by contraction of
   the links; those of each step are taken between the components so far.

Nothing is capped: a list of any length is covered by steps 3 and 4.

Defined results: rows are the nodes, each by a key of its own, so that rows with
one ``doc_id`` and different texts are linked (or not) by their own texts, and
repeated rows give repeated result rows. ``component_id`` is the smallest
``doc_id`` of the rows reachable, null if none of them has one. ``kept``: that is
the row's own (rows without an id are kept where no reachable row has one);
``first`` marks one row of each component, also among repeated rows. A text that
is null or has no word has an empty set, is linked with nothing and kept. Extra
columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import keyed, materialise
from .textblocks import CHAIN, blocks, lower_ascii, mix, prefix_hash, span_hash, utf8, words

SHINGLE, COORDINATES, MATCHES = 5, 48, 22
PREFIX = COORDINATES - MATCHES + 1
#: Links have 100 * intersection >= 75 * union.
THRESHOLD = 75
STAR_ROUNDS = 3
#: Members of a posting list up to which its pairs meet in a join; members of a block of longer lists.
SMALL, BLOCK = 48, 256
#: Links, or rows of a written table, up to which a join with them is a broadcast; beyond it the same join shuffles.
FEW = 100_000
OUT = ("n_shingles", "component_id", "kept")

_rng = np.random.default_rng(20_240_611)
_MULTIPLY = (_rng.integers(1, 1 << 31, COORDINATES, np.int64) * 2 + 1).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, COORDINATES, np.int64).astype(np.uint32)
#: Shingles whose coordinates are computed at once.
_CHUNK = 1 << 16


def shingle_sets(column: pa.Array, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text of a column."""
    data, offsets = utf8(column)
    for first, last in blocks(offsets):
        part, at = lower_ascii(data[offsets[first] : offsets[last]]), offsets[first : last + 1] - offsets[first]
        start, end, top = words(part, at)
        word = span_hash(prefix_hash(part), start, end)
        n = max(0, len(word) - shingle + 1)
        rolled = np.zeros(n, np.uint64)
        for k in range(shingle):
            rolled = mix(rolled * np.uint64(CHAIN) + word[k : k + n])
        for i in range(last - first):
            a, b = int(top[i]), int(top[i + 1])
            if b - a >= shingle:
                yield np.unique(rolled[a : b - shingle + 1])
            elif b > a:
                whole = np.zeros(1, np.uint64)
                for k in range(a, b):
                    whole = mix(whole * np.uint64(CHAIN) + word[k])
                yield mix(whole + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, a row for each (non-empty) set."""
    out = np.empty((len(sets), COORDINATES), np.uint32)
    sizes = np.array([len(s) for s in sets])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    for first, last in blocks(ends, _CHUNK):
        x = np.concatenate(sets[first:last])
        low = (x ^ (x >> np.uint64(32))).astype(np.uint32)
        at = ends[first:last] - ends[first]
        for c in range(COORDINATES):
            v = low * _MULTIPLY[c] + _ADD[c]
            v ^= v >> np.uint32(15)
            v *= np.uint32(0x2C1B3C6D)
            out[first:last, c] = np.minimum.reduceat(v, at)
    return out


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(batch.column("text")))
        full = [s for s in sets if len(s)]
        low, high = [0] * len(sets), [0] * len(sets)
        for i, s in enumerate(sets):
            if len(s):
                low[i] = int((np.bitwise_xor.reduce(mix(s)) ^ np.uint64(len(s))).view(np.int64))
                high[i] = int(np.sum(mix(s ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64).view(np.int64))
        values = signatures(full).view(np.int32) if full else np.zeros((0, COORDINATES), np.int32)
        has = np.array([len(s) > 0 for s in sets], bool)
        offsets = np.concatenate([[0], np.cumsum(has * COORDINATES)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), pa.int32()))],
            ["key", "doc_id", "n_shingles", "hi", "lo", "sig"],
        )


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two full sets are linked."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= THRESHOLD * (len(x) + len(y) - both)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = list(shingle_sets(batch.column("text_a"))), list(shingle_sets(batch.column("text_b")))
        mask = pa.array([similar(x, y) for x, y in zip(a, b, strict=True)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])


def confirm_links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose whole texts are at least as similar as the threshold."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of all ends of ``links`` (``a, b``).

    Contraction: a node takes the smallest name within two steps of it, and links go on
    between these names, until none is left. No neighbour list is gathered. Names are
    hashed in each round (``xxhash64`` maps single longs one to one), so that stars and
    chains shrink by a factor whatever their ids are.
    """
    now = materialise(links.select("a", "b").filter("a <> b"), "links")
    named = None
    while rows := now.count():
        side = lambda t, c: (F.broadcast(t) if rows <= FEW else t).withColumnsRenamed({"a": c, "m": f"m{c}"})  # noqa: B023, E731
        least = _ends(now, "b", "a").groupBy("a").agg(F.least(F.col("a"), F.min("x")).alias("m"))
        near = now.join(side(least, "a"), "a").join(side(least, "b"), "b")
        # a node's own least is no smaller than the least of its neighbours' leasts
        new = materialise(_ends(near, "mb", "ma").groupBy("a").agg(F.xxhash64(F.min("x")).alias("m")), "names")
        now = materialise(now.join(side(new, "a"), "a").join(side(new, "b"), "b").select(F.col("ma").alias("a"), F.col("mb").alias("b")).filter("a <> b"), "links")
        if named is None:
            named = new.select(F.col("a").alias("id"), F.col("m").alias("name"))
        else:
            named = named.join(side(new, "name"), "name", "left").select("id", F.coalesce("mname", F.xxhash64("name")).alias("name"))
    if named is None:
        return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    named = materialise(named, "named")
    return named.join(_small(named.groupBy("name").agg(F.min("id").alias("component")), named), "name").select("id", "component")


def _ends(links: DataFrame, of_a: str, of_b: str) -> DataFrame:
    """``a, x``: either end of each link with a value for it."""
    end = lambda c, x: F.struct(F.col(c).alias("a"), F.col(x).alias("x"))
    return links.select(F.inline(F.array(end("a", of_a), end("b", of_b))))


def _small(df: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Marked for broadcast if the written table ``counted`` (itself, if not given) has no more than ``FEW`` rows."""
    return F.broadcast(df) if (df if counted is None else counted).count() <= FEW else df


def _labels(links: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``labels`` (``id, component``) after further ``links``: these are taken between the components so far."""
    if labels is None:
        return materialise(components(links), "labels")
    at = _small(labels)
    for c in ("a", "b"):
        links = links.join(at.select(F.col("id").alias(c), F.col("component").alias(f"c{c}")), c, "left")
    new = materialise(components(links.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))), "joined")
    moved = labels.join(_small(new).select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return materialise(moved.unionByName(new.join(at, "id", "left_anti")), "labels")


def _labelled(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return postings.withColumn("comp", F.col("id"))
    return postings.join(_small(labels).withColumnRenamed("component", "_c"), "id", "left").withColumn("comp", F.coalesce("_c", "id")).drop("_c")


def blocked_links(member: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a, b`` between components within long posting lists, a spanning set for each pair of blocks."""
    wide = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    rows = member.select("key", "id", "comp", "main", "n", "sig", F.transform("keys", lambda k: F.shiftright(k, 32).cast("int")).alias("pos"), wide("minor").alias("na"), wide("total").alias("nb"))
    block = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = ["key", "id", "comp", "main", "n", "sig", "pos"]
    a = rows.filter("comp <> main").select(*kept, F.lit(0).alias("side"), block(1, "na").alias("i"), every("nb").alias("j"))
    b = rows.select(*kept, F.lit(1).alias("side"), every("na").alias("i"), block(2, "nb").alias("j"))
    deal = ["key", "i", "j"]
    signed = a.unionByName(b).repartition(*deal).sortWithinPartitions(*deal, "side", "id")
    found = materialise(signed.mapInArrow(_by_block(_candidates), f"{_DEAL}, id long, comp long, partners array<long>"), "candidates")
    whole = found.join(texts, "id").select(*deal, "id", "comp", "partners", "text").repartition(*deal).sortWithinPartitions(*deal, "id")
    return whole.mapInArrow(_by_block(_spanning), "a long, b long")


_DEAL = "key long, i int, j int"


def _by_block(work):
    """Calls ``work`` with the rows of each (key, i, j), which come sorted; yields what it returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")], 1)
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1).tolist(), len(at)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                now = tuple(at[x].tolist())
                if rest and now != last:
                    yield from work(pa.Table.from_batches(rest).combine_chunks())
                    rest = []
                rest.append(batch.slice(x, y - x))
                last = now
        if rest:
            yield from work(pa.Table.from_batches(rest).combine_chunks())

    return run


def _candidates(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Members with candidates in the other block: ``partners`` of those of side 0, most collisions first."""
    column = lambda c: rows.column(c).to_numpy().astype(np.int64)
    side, ids, comp, main, size = (column(c) for c in ("side", "id", "comp", "main", "n"))
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(a) or not len(b):
        return
    here = int(rows.column("key")[0].as_py()) >> 32
    sig = np.asarray(rows.column("sig").combine_chunks().flatten()).reshape(-1, COORDINATES)
    lists = rows.column("pos").combine_chunks()
    posted = np.zeros((len(ids), COORDINATES), bool)
    posted[np.repeat(np.arange(len(ids)), np.asarray(lists.value_lengths())), np.asarray(lists.flatten())] = True
    partners: dict[int, list[int]] = {}
    for i in a:
        js = b[(comp[b] != comp[i]) & ((comp[b] == main[i]) | (ids[b] > ids[i])) & (100 * np.minimum(size[b], size[i]) >= THRESHOLD * np.maximum(size[b], size[i]))]
        same = sig[js] == sig[i]
        hits = same.sum(1)
        # each pair belongs to the first key that both have posted
        good = ((same & posted[js] & posted[i]).argmax(1) == here) & (hits >= MATCHES)
        if good.any():
            js = js[good][np.lexsort((ids[js[good]], -hits[good]))]
            partners[int(i)] = js.tolist()
    if not partners:
        return
    out = sorted({j for js in partners.values() for j in js}) + list(partners)
    deal = [rows.column(c).combine_chunks().slice(0, 1).take(pa.array([0] * len(out))) for c in ("key", "i", "j")]
    yield pa.RecordBatch.from_arrays(
        [*deal, pa.array(ids[out]), pa.array(comp[out]), pa.array([ids[partners[x]].tolist() if side[x] == 0 else [] for x in out], pa.list_(pa.int64()))], ["key", "i", "j", "id", "comp", "partners"]
    )


def _spanning(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Confirmed links among the candidates of two blocks, without those that earlier ones make needless."""
    ids = rows.column("id").to_pylist()
    comp = dict(zip(ids, rows.column("comp").to_pylist(), strict=True))
    at = {x: k for k, x in enumerate(ids)}
    sets = list(shingle_sets(rows.column("text").combine_chunks()))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    found = []
    for x, partners in zip(ids, rows.column("partners").to_pylist(), strict=True):
        for y in partners:
            rx, ry = find(comp[x]), find(comp[y])
            if rx != ry and similar(sets[at[x]], sets[at[y]]):
                root[max(rx, ry)] = min(rx, ry)
                found.append((x, y))
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])


def near_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``docs``."""
    return near_classes(keyed(docs)).select("doc_id", *OUT)


def near_classes(rows: DataFrame) -> DataFrame:
    """``key, doc_id, n_shingles, component_id, kept, first`` of rows ``key, doc_id, text`` with distinct keys."""
    profile = materialise(rows.mapInArrow(_profile, "key long, doc_id long, n_shingles long, hi long, lo long, sig array<int>"), "profiles")
    # a class goes by the key of one of its rows, whose text is the class's
    klass = profile.filter("n_shingles > 0").groupBy("hi", "lo").agg(F.min("key").alias("id"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("least"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    klass = materialise(klass, "classes")  # written, so that the join back to all rows has a shuffle of its own that can be split where a class is large
    reps = klass.select("id", "n", "sig")

    key = F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("col").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    keys = reps.select("id", "n", F.posexplode("sig")).select("id", "n", key.alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    known = keys.join(shared, "key")
    by_doc = Window.partitionBy("id")
    rank = F.row_number().over(by_doc.orderBy("df", "key")) + COORDINATES - F.count(F.lit(1)).over(by_doc)
    postings = materialise(known.withColumn("rank", rank).filter(F.col("rank") <= PREFIX).select("key", "id", "n"), "postings")
    texts = materialise(rows.select(F.col("key").alias("id"), "text").join(postings.select("id").distinct(), "id", "left_semi"), "texts")

    labels = None
    for turn in range(STAR_ROUNDS):
        now = _labelled(postings, labels)
        pivot = now.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "id", F.lit(turn)).alias("h"), F.col("id").alias("p"), F.col("comp").alias("pc"), F.col("n").alias("pn"))).alias("s")).select("key", "s.p", "s.pc", "s.pn")
        near = (F.col("comp") != F.col("pc")) & (100 * F.least("n", "pn") >= THRESHOLD * F.greatest("n", "pn"))
        tries = now.join(pivot, "key").filter(near).groupBy("id", "p").agg(F.count(F.lit(1)).alias("c"))
        best = tries.groupBy("id").agg(F.max(F.struct("c", "p")).alias("s")).select(F.col("id").alias("a"), F.col("s.p").alias("b"))
        found = materialise(confirm_links(best, texts), "stars")
        if found.isEmpty():
            break
        labels = _labels(found, labels)

    now = _labelled(postings, labels)
    size = now.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    main = size.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("s"), F.count(F.lit(1)).alias("k"), F.sum("c").alias("total")).filter("k > 1").select("key", F.col("s.comp").alias("main"), "total", (F.col("total") - F.col("s.c")).alias("minor"))
    own = now.groupBy("id").agg(F.collect_list("key").alias("keys"))  # at most PREFIX keys each
    member = materialise(now.join(main, "key").join(own, "id").join(reps.select("id", "sig"), "id"), "members")
    small = member.filter(F.col("total") <= SMALL)
    a = small.filter("comp <> main").select(F.col("key").alias("key_a"), *[F.col(c).alias(f"{c}_a") for c in ("id", "comp", "n", "keys", "sig")])
    b = small.select("key", "main", *[F.col(c).alias(f"{c}_b") for c in ("id", "comp", "n", "keys", "sig")])
    hits = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v)
    once = F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("key")
    # of two members outside the largest component each pair is met from one side only
    on = (F.col("key_a") == F.col("key")) & (F.col("comp_a") != F.col("comp_b")) & ((F.col("comp_b") == F.col("main")) | (F.col("id_a") < F.col("id_b")))
    on = on & (100 * F.least("n_a", "n_b") >= THRESHOLD * F.greatest("n_a", "n_b")) & (hits >= MATCHES) & once
    rest = a.join(b, on).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    blocked = materialise(blocked_links(member.filter(F.col("total") > SMALL), texts), "blocks")
    labels = _labels(blocked.unionByName(materialise(confirm_links(rest, texts), "rest")), labels)

    named = klass.join(_small(labels), "id", "left").select("hi", "lo", "least", F.coalesce("component", "id").alias("component"))
    heads = named.groupBy("component").agg(F.min("least").alias("head"))
    named = materialise(named.join(heads, "component").select("hi", "lo", "head"), "heads")
    out = profile.select("key", "doc_id", "n_shingles", "hi", "lo").join(named, ["hi", "lo"], "left")
    comp = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("head.doc_id"))
    return out.select("key", "doc_id", "n_shingles", comp.alias("component_id"), F.coalesce(F.col("doc_id") == comp, comp.isNull()).alias("kept"), F.coalesce(F.col("head.key") == F.col("key"), F.lit(True)).alias("first"))
