"""Quality rules as a learned decision list, with DataFrame functions only.

Statistics of whole texts come from built-in functions, one scan and no shuffle.
Sequential covering then learns ordered conjunctions of thresholds that mark low
quality: each is grown on two thirds of the labelled statistics by information
gain over all cuts of all features, pruned on the rest, and taken if precise enough
on what is left; what it covers is set aside. A rule that is not precise enough is
put by and another first condition tried, until none is left. The list becomes one
conditional expression. Texts that no rule marks are kept.

Learning reads the statistics of about ``SAMPLE`` labelled documents (expected;
chosen by a hash of ``doc_id``), a few numbers each.

Defined results: a null text has no words and fails the base rule; labels that
are null or of unknown documents are ignored, and of several labels of one
document the lowest counts; without labels the list is empty; of equal gains the
feature listed first wins, then the lower cut, then ``above``; repeated rows give
repeated results; extra columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE

SAMPLE = 20_000
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW, LEAST_WORDS, REPEAT_PERCENT = 8, 20, 30
#: Of the covering: conditions in a rule, low rows and precision that a rule needs.
CONDITIONS, COVER, PRECISION = 3, 8, 0.97
CAPITALS, SHOUTS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "!?"
FEATURES = ("n_words", "mean_word_chars", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "capital_share", "shout_share", "words_per_line")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(hashes: Column) -> Column:
    """Positions covered by windows whose hash occurs twice or more."""
    none = F.lit(None)

    def positions(s: Column) -> Column:
        twice = lambda k: F.coalesce((F.get(s, k)["h"] == F.get(s, k - 1)["h"]) | (F.get(s, k)["h"] == F.get(s, k + 1)["h"]), F.coalesce(F.get(s, k)["h"] == F.get(s, k - 1)["h"], none.cast("boolean")), F.get(s, k)["h"] == F.get(s, k + 1)["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), F.size(s) - 1), twice), lambda k: F.get(s, k)["i"]))

    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    total = lambda p: F.aggregate(F.sequence(F.lit(1), F.size(p) - 1), F.lit(WINDOW), lambda a, j: a + F.least(F.lit(WINDOW), F.get(p, j) - F.get(p, j - 1)))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(ranked, lambda s: let(positions(s), total)))


def _word_facts(words: Column) -> Column:
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    repeat = F.when(F.size(words) <= WINDOW, 0).otherwise(let(windows, _covered))
    return F.struct(F.size(words).cast("long").alias("n_words"), repeat.cast("long").alias("n_repeat_words"), F.size(F.array_distinct(words)).cast("long").alias("n_distinct"))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of each text."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    cut = lambda signs: F.length(F.translate(text, signs, ""))
    facts = docs.select(
        F.col("doc_id").cast("long"),
        let(words, _word_facts).alias("_w"),
        cut(BLANKS).cast("long").alias("word_chars"),
        (F.length(text) - cut(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length(text) - cut(CAPITALS)).cast("long").alias("n_capitals"),
        (F.length(text) - cut(SHOUTS)).cast("long").alias("n_shouts"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("_l"),
    )
    return facts.select("doc_id", F.col("_w.n_words"), "word_chars", "n_symbols", F.col("_l.n_dup_lines"), F.col("_w.n_repeat_words"), F.col("_w.n_distinct"), F.col("_l.n_lines"), "n_capitals", "n_shouts")


def features() -> dict[str, Column]:
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)).cast("double")
    return dict(zip(FEATURES, (F.col("n_words").cast("double"), share("word_chars", "n_words"), share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"), share("n_distinct", "n_words"), share("n_capitals", "word_chars"), share("n_shouts", "word_chars"), share("n_words", "n_lines")), strict=True))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    value: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        values = x[:, FEATURES.index(self.feature)]
        return values > self.value if self.above else values <= self.value

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] > self.value if self.above else of[self.feature] <= self.value


def _all(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _best(x: np.ndarray, low: np.ndarray, tried: set[tuple[str, bool]]) -> Condition | None:
    """The condition of the greatest information gain; running counts over sorted values give all cuts at once."""
    p, n = int(low.sum()), int((~low).sum())
    top: tuple[float, Condition | None] = (1e-9, None)
    for j, feature in enumerate(FEATURES):
        order = np.argsort(x[:, j], kind="stable")
        v = x[order, j]
        at = np.flatnonzero(v[1:] > v[:-1])
        if not len(at):
            continue
        p_below, n_below = np.cumsum(low[order])[at], np.cumsum(~low[order])[at]
        for above, p1, n1 in ((True, p - p_below, n - n_below), (False, p_below, n_below)):
            if (feature, above) in tried:
                continue
            gain = np.where(p1 > 0, p1 * (np.log2(np.maximum(p1, 1) / np.maximum(p1 + n1, 1)) - np.log2(p / (p + n))), -1.0)
            i = int(gain.argmax())
            if gain[i] > top[0]:
                top = float(gain[i]), Condition(feature, above, float((v[at[i]] + v[at[i] + 1]) / 2))
    return top[1]


def _grow(x: np.ndarray, low: np.ndarray, tried: set[tuple[str, bool]]) -> tuple[Condition, ...]:
    """A rule whose first condition is on none of the features and sides in ``tried``."""
    rule: tuple[Condition, ...] = ()
    while len(rule) < CONDITIONS and low.any() and not low.all():
        best = _best(x, low, set() if rule else tried)
        if best is None:
            break
        rule += (best,)
        held = best.holds(x)
        x, low = x[held], low[held]
    return rule


def _prune(x: np.ndarray, low: np.ndarray, rule: tuple[Condition, ...]) -> tuple[Condition, ...]:
    def worth(r: tuple[Condition, ...]) -> float:
        hit = low[_all(r, x)]
        return (2 * hit.sum() - len(hit)) / len(hit) if len(hit) else -1.0

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def cover(x: np.ndarray, low: np.ndarray) -> list[tuple[Condition, ...]]:
    """Ordered rules for low quality, from rows of features."""
    rules: list[tuple[Condition, ...]] = []
    tried: set[tuple[str, bool]] = set()
    while low.any():
        part = np.arange(len(x)) % 3 > 0
        grown = _grow(x[part], low[part], tried)
        if not grown:
            break
        rule = _prune(x[~part], low[~part], grown)
        hit = _all(rule, x)
        if low[hit].sum() < COVER or low[hit].sum() < PRECISION * hit.sum():
            tried.add((grown[0].feature, grown[0].above))
            continue
        rules.append(rule)
        x, low, tried = x[~hit], low[~hit], set()
    return rules


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[Condition, ...]]:
    share = min(1.0, sample / max(1, labels.count()))
    # a hash-threshold sample of ids: `sample` rows of 12 bytes expected, so small enough to broadcast
    some = labels.filter(F.col("quality").isNotNull() & (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < int(share * 1_000_000))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    stats = statistics(docs.join(F.broadcast(some.select("doc_id")), "doc_id", "left_semi"))
    # a filter on the base rule would be pushed below the semi join and compute the statistics of all texts
    rows = stats.join(F.broadcast(some), "doc_id").select("doc_id", (F.col("quality") == 0).alias("low"), *[c.alias(k) for k, c in features().items()], base_failed().alias("failed")).collect()
    rows = sorted(tuple(r) for r in rows if not r["failed"])
    return cover(np.array([r[2:-1] for r in rows], float).reshape(-1, len(FEATURES)), np.array([r[1] for r in rows], bool))


def verdict(rules: list[tuple[Condition, ...]]) -> Column:
    """Number of the first rule that holds, from 1; 0 for none."""
    of, out = features(), F.lit(0)
    for i, rule in reversed(list(enumerate(rules, 1))):
        held = F.lit(True)
        for c in rule:
            held = held & c.column(of)
        out = F.when(held, i).otherwise(out)
    return out


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and the number of the ``rule`` that marked the text (0: none)."""
    rules = learn(docs, labels)
    out = statistics(docs).withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
