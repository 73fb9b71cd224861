"""Personal data by boosted trees over span candidates, with DataFrame functions only.

Generators propose spans of four kinds: strict forms, strict forms that fail
their check, and looser forms (spelt-out addresses, defanged hosts, national phone
numbers, other separators). Proposals may overlap. Each gets yes/no features of
its form and context. Boosted two-level trees score them, a threshold calibrated
for each kind selects, and of selected spans that overlap the one with the higher
score stays. Strict spans that pass their check always stay.

No table labels personal data, so the labels come from what is done to a span, not
from its features. Every strict span of the corpus that passes its check is taken
in its own context: as it is and disguised (yes), and broken (no: a changed check
digit, an octet above 255, a domain that is none, too many digits); ``MADE`` made-up
spans add contexts that the corpus may lack, and true forms in contexts that speak
against them (no). All documents count. Half of the examples (by a hash) trains the
trees, the other half calibrates: shares of right examples, made to rise with the
score, give each kind's threshold, the least score with a share of ``PRECISION``. Only counts of feature combinations reach the driver:
fewer than 2 ** len(FEATURES) times the kinds, whatever the corpus. Trees become
one SQL expression. Ties of equal gain go to the feature listed first.

Positions are code points, end exclusive. Spans come from the gaps between
matches, so that texts are scanned once a pattern; patterns never try a start
inside a run that has failed, so long runs cost linear time. Running positions and
overlaps are folded in pieces (``scan``), n ** 1.5 steps for n matches of a text.

Defined results: a null text is empty and has no spans; repeated rows give
repeated results; a null ``doc_id`` passes through; extra columns are ignored,
whatever their names; an empty table gives an empty result; ties of equal scores
go to the span that starts first, then to the longer one, then to the kind listed
first.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import materialise

KINDS = ("email", "ip", "card", "phone")
#: Made-up examples; rounds and rate of the boosting; share of right ones that a threshold must reach; weight of all made-up examples beside one corpus example each.
MADE, ROUNDS, RATE, PRECISION = 8000, 32, 0.4, 0.9

_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Strict forms of the contract. A run that cannot start a match is not tried again from inside.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a strict form to be worth a search.
SEEN = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"(?:[0-9][\x20-]?){11}[0-9]", "phone": r"\+[0-9]"}
#: Usual domain ends.
ENDS = "com|org|net|edu|gov|io|info|biz|dev|app|co|de|fr|es|it|nl|eu|uk|us|ca|ch|at|be|pl|se|br|mx|jp|cn|in|au"
_USER, _HOST = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+", "[A-Za-z0-9-]{2,63}+"
_AT, _DOT = r" ?[\[({](?:at|AT|@)[\])}] ?", r" ?[\[({](?:dot|DOT|\.)[\])}] ?"
#: Loose forms. "at" as a plain word is prose nearly always: it counts before bracketed dots, and before spelt ones if a usual end closes the phrase; never before a full stop.
LOOSE = {
    "email": rf"{_USER}(?:{_AT}{_HOST}(?:(?:{_DOT}| (?:dot|DOT) |\.){_HOST}){{1,4}}+| (?:at|AT) {_HOST}(?:{_DOT}{_HOST}){{1,4}}+| (?:at|AT) {_HOST}(?: (?:dot|DOT) {_HOST}){{1,4}}+(?<= (?:{ENDS}))(?=\s*(?:$|[.,;:!?)\]>\"'])))",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?: ?[\[(](?:\.|dot)[\])] ?[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[./_\u2013\u00b7][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+.-])(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-]*[0-9])",
}
#: Words just before a span that speak for its kind, and words that speak against any.
CUES = {
    "email": "mail|e-mail|contact|write|reach|address|reply",
    "ip": "ip|host|server|address|ping|connect|dns|gateway",
    "card": "card|visa|mastercard|amex|credit|debit|payment|pay",
    "phone": "call|phone|tel|fax|mobile|cell|dial|contact|text|reach",
}
AGAINST = "version|isbn|order|invoice|part|model|serial|sku|page|section|chapter|figure|item|ref|number|ticket|lot"
FEATURES = ("strict", "checksum", "octets", "digits_fit", "one_separator", "clear_left", "clear_right", "cue", "against", "domain", "marked", "plain_digits")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scan(items: Column, zero: Column, none: Column, step: Callable[[Column, Column], Column], show: Callable[[Column, Column], Column]) -> Column:
    """``show(state, item)`` of each item, with the state that ``step`` has reached before it.

    Arrays cannot grow in place, so that one fold would copy its result for every
    item; folds over pieces of about the root of the size copy far less.
    """
    piece = F.ceil(F.sqrt(F.size(items).cast("double"))).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / piece).cast("int")), lambda i: F.slice(items, i * piece + 1, piece))

    def inner(a: Column, part: Column) -> Column:
        start = F.struct(a["v"].alias("v"), none.alias("o"))
        return F.aggregate(part, start, lambda b, x: F.struct(step(b["v"], x).alias("v"), F.concat(b["o"], F.array(show(b["v"], x))).alias("o")), lambda b: F.struct(b["v"].alias("v"), F.concat(a["o"], b["o"]).alias("o")))

    return F.when(F.size(items) == 0, none).otherwise(F.aggregate(pieces, F.struct(zero.alias("v"), none.alias("o")), inner, lambda a: a["o"]))


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def _passes(kind: str, t: Column) -> Column:
    """The check of a strict match."""
    if kind == "ip":
        return t.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(t)).between(12, 19) & F.call_function("luhn_check", _digits(t))
    if kind == "phone":
        return F.length(_digits(t)).between(9, 15)
    return F.lit(True)


def _passing(spans: str, kind: str, yes: bool = True) -> Column:
    return F.filter(spans, lambda x: _passes(kind, x["t"]) if yes else ~_passes(kind, x["t"]))


def _candidate(kind: str, t: Column) -> Column:
    """Whether a strict match that fails its check is still worth scoring."""
    return F.length(_digits(t)).between(12, 19) if kind == "card" else F.lit(True)


_SPAN = "struct<s:int,e:int,t:string,l:string,r:string>"
_ITEM = "struct<s:int,k:int,e:int,f:int,c:double>"


def _none(of: str) -> Column:
    return F.array().cast(f"array<{of}>")


def _spans(text: Column, pattern: str, keep: Callable[[Column], Column]) -> Column:
    """Start, end, string and neighbouring context of the matches that ``keep``."""

    def found(gaps: Column) -> Column:
        zipped = F.arrays_zip(F.slice(gaps, 1, F.size(gaps) - 1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.slice(gaps, 2, F.size(gaps)).alias("n"))
        one = lambda p, x: F.struct((p + F.length(x["g"])).alias("s"), (p + F.length(x["g"]) + F.length(x["m"])).alias("e"), x["m"].alias("t"), F.right(x["g"], F.lit(24)).alias("l"), F.left(x["n"], F.lit(8)).alias("r")).cast(_SPAN)
        return scan(zipped, F.lit(0), _none(_SPAN), lambda p, x: p + F.length(x["g"]) + F.length(x["m"]), one)

    return F.filter(let(F.split(text, pattern, -1), found), lambda x: keep(x["t"]))


def _of_kind(kind: Column, of: Callable[[str], Column]) -> Column:
    out = F.when(kind == 0, of(KINDS[0]))
    for i, k in enumerate(KINDS[1:], 1):
        out = out.when(kind == i, of(k))
    return out


def _features(kind: Column, strict: Column, x: Column) -> dict[str, Column]:
    t, digits, left = x["t"], _digits(x["t"]), F.lower(x["l"])
    separators = F.array_remove(F.array_distinct(F.split(F.regexp_replace(t, "[0-9A-Za-z]", ""), "")), "")
    near = lambda words: left.rlike(rf"(?:^|[^a-z])(?:{words})s?(?:[^a-z]{{1,3}}[a-z]{{0,4}}){{0,2}}[^a-z]{{0,3}}$")
    return dict(
        strict=strict,
        checksum=F.call_function("luhn_check", F.when(digits == "", "1").otherwise(digits)) & F.length(digits).between(12, 19),
        octets=F.regexp_replace(t, r"[^0-9]+", ".").rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        digits_fit=F.when(kind == 2, F.length(digits).between(12, 19)).when(kind == 3, F.length(digits).between(9, 15)).otherwise(F.lit(True)),
        one_separator=F.size(separators) <= 1,
        clear_left=(x["l"] == "") | x["l"].rlike(r"[\s(\[<\"':;,]$"),
        clear_right=F.coalesce(x["r"], F.lit("")).rlike(r"^(?:$|[\s)\]>\"',;:?!]|\.(?:\s|$))"),
        cue=_of_kind(kind, lambda k: near(CUES[k])),
        against=near(AGAINST),
        domain=F.lower(t).rlike(rf"(?:[.\])}}]|dot) ?(?:{ENDS})$"),
        marked=t.rlike(r"[\[({](?:at|AT|@|dot|DOT|\.)[\])}]"),
        plain_digits=t.rlike("^[0-9]+$"),
    )


def _bits(kind: Column, strict: Column, x: Column) -> Column:
    out = F.lit(0)
    for j, c in enumerate(_features(kind, strict, x).values()):
        out = out + F.when(c, 1 << j).otherwise(0)
    return out


def proposals(docs: DataFrame, *carry: Column) -> DataFrame:
    """``doc_id``, ``carry``, and for each kind its strict (``s_``) and loose (``l_``) spans, which may overlap."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *carry)
    text, columns = F.col("text"), []
    for k in KINDS:
        seen = text.contains("@") if k == "email" else text.rlike(SEEN[k])
        columns.append(F.when(seen, _spans(text, STRICT[k], lambda t, k=k: _candidate(k, t))).otherwise(_none(_SPAN)).alias(f"s_{k}"))
        columns.append(F.when(text.rlike(LOOSE[k]), _spans(text, LOOSE[k], lambda t: F.lit(True))).otherwise(_none(_SPAN)).alias(f"l_{k}"))
    return rows.select("doc_id", *rows.columns[2:], *columns)


# ---- examples ----


def _pick(seed: Column, values: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(seed, F.lit(len(values))).cast("int"))


def _disguised(kind: Column, t: Column, h: Column) -> Column:
    """The span in another spelling."""
    at, dot = _pick(h, (" [at] ", "(at)", " at ", "[@]")), _pick(h, (" [dot] ", "(dot)", " dot ", "[.]"))
    d, sep = _digits(t), _pick(h, (".", "/", "_"))
    return (
        F.when(kind == 0, F.replace(F.replace(t, F.lit("."), dot), F.lit("@"), at))
        .when(kind == 1, F.replace(t, F.lit("."), _pick(h, ("[.]", "(.)", " [.] ", "[dot]"))))
        .when(kind == 2, F.concat(F.substring(d, 1, 4), sep, F.substring(d, 5, 4), sep, F.substring(d, 9, 4), sep, F.substring(d, 13, 19)))
        .otherwise(F.concat(_pick(h, ("(", "")), F.substring(d, -10, 3), F.when(h % 2 == 0, ") ").otherwise(_pick(h, ("-", ".", " "))), F.substring(d, -7, 3), _pick(h, ("-", ".", "-")), F.substring(d, -4, 4)))
    )


def _broken(kind: Column, t: Column, h: Column) -> Column:
    """A span like it that is none."""
    turned = F.pmod(F.substring(_digits(t), -1, 1).cast("int") + 1 + F.pmod(h, F.lit(8)).cast("int"), F.lit(10)).cast("string")
    return (
        F.when(kind == 0, F.regexp_replace(t, "[A-Za-z0-9-]+$", "thing"))
        .when(kind == 1, F.concat((F.pmod(h, F.lit(600)) + 300).cast("string"), F.regexp_replace(t, "^[0-9]+", "")))
        .when(kind == 2, F.concat(F.substring(t, F.lit(1), F.length(t) - 1), turned))
        .otherwise(F.concat(t, F.lit("00"), _digits(t)))
    )


def _examples(rows: DataFrame) -> DataFrame:
    """Counts of ``half, k, f, y`` from true spans ``k, x, h, against``: as they are, disguised and broken."""
    k, h, x = F.col("k"), F.col("h"), F.col("x")
    span = lambda t: F.struct(t.alias("t"), x["l"].alias("l"), x["r"].alias("r"))
    other = _disguised(k, x["t"], h)
    wrong = _broken(k, x["t"], h)
    cases = F.array(
        F.struct(span(x["t"]).alias("x"), F.lit(True).alias("strict"), (~F.col("against")).alias("y")),
        F.struct(span(other).alias("x"), F.lit(False).alias("strict"), (~F.col("against")).alias("y")),
        F.struct(span(wrong).alias("x"), F.lit(True).alias("strict"), F.lit(False).alias("y")),
        F.struct(span(F.when(k == 3, wrong).otherwise(_disguised(k, wrong, h))).alias("x"), F.lit(False).alias("strict"), F.lit(False).alias("y")),
    )
    every = rows.select("k", F.pmod(F.xxhash64("h"), F.lit(2)).alias("half"), F.explode(cases).alias("c"))
    return every.select("half", "k", _bits(F.col("k"), F.col("c.strict"), F.col("c.x")).alias("f"), F.col("c.y").alias("y")).groupBy("half", "k", "f", "y").count()


def _made(spark: SparkSession, n: int = MADE) -> DataFrame:
    """Made-up true spans of every kind, in contexts for, without and against them."""
    h = lambda seed: F.abs(F.xxhash64("id", F.lit(seed)))
    k = F.pmod(F.col("id"), F.lit(len(KINDS))).cast("int")
    octet = lambda seed: F.pmod(h(seed), F.lit(256)).cast("string")
    body = F.lpad(F.pmod(h(5), F.lit(10**15)).cast("string"), 15, "4")
    card = F.concat(body, F.element_at(F.filter(F.array(*[F.lit(str(d)) for d in range(10)]), lambda d: F.call_function("luhn_check", F.concat(body, d))), 1))
    tens = lambda seed, n: F.lpad(F.pmod(h(seed), F.lit(10**n)).cast("string"), n, "5")
    t = (
        F.when(k == 0, F.concat(_pick(h(1), ("ann", "j.doe", "info", "sales_2", "bob")), F.pmod(h(2), F.lit(90)).cast("string"), F.lit("@"), _pick(h(3), ("mail", "example", "post-box", "web7")), F.lit("."), _pick(h(4), tuple(ENDS.split("|")))))
        .when(k == 1, F.concat_ws(".", octet(1), octet(2), octet(3), octet(4)))
        .when(k == 2, F.when(h(6) % 2 == 0, card).otherwise(F.concat_ws("-", F.substring(card, 1, 4), F.substring(card, 5, 4), F.substring(card, 9, 4), F.substring(card, 13, 4))))
        .otherwise(F.concat(F.lit("+1 ("), tens(1, 3), F.lit(") "), tens(2, 3), F.lit("-"), tens(3, 4)))
    )
    # a true form is taken as none only where the form says little: national numbers and dotted quads after an opposing word
    against = (F.pmod(h(7), F.lit(6)) == 0) & k.isin(1, 3)
    cue = _of_kind(k, lambda name: _pick(h(8), tuple(CUES[name].split("|"))))
    left = F.when(against, F.concat(_pick(h(8), tuple(AGAINST.split("|"))), _pick(h(9), (" ", ": ", " no. ")))).when(h(10) % 3 == 0, F.concat(cue, _pick(h(9), (" ", ": ", " me at ", " is ")))).otherwise(_pick(h(9), ("", "and the ", "there (", "so, ")))
    return spark.range(n).select(k.alias("k"), F.struct(t.alias("t"), left.alias("l"), _pick(h(11), ("", " and", ". The", ", or", ")")).alias("r")).alias("x"), h(12).alias("h"), against.alias("against"))


# ---- boosting over counts of feature combinations ----


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def boost(cells: dict[tuple[int, int], tuple[float, float]]) -> list[tuple]:
    """Two-level trees ``(first, second if no, second if yes, four leaves)`` from true and false weight by (kind, bits)."""
    wide = len(FEATURES) + len(KINDS)
    x = {(k, f): f | 1 << (len(FEATURES) + k) for k, f in cells}
    score = dict.fromkeys(cells, 0.0)
    trees = []
    for _ in range(ROUNDS):
        grad = {c: (p - (p + n) * _sigmoid(score[c]), (p + n) * max(1e-6, _sigmoid(score[c]) * (1 - _sigmoid(score[c])))) for c, (p, n) in cells.items()}

        def side(cs: list) -> tuple[float, float]:
            return sum(grad[c][0] for c in cs), sum(grad[c][1] for c in cs)

        def best(cs: list) -> tuple[float, int]:
            top = (-1.0, 0)
            for j in range(wide):
                (ga, ha), (gb, hb) = side([c for c in cs if not x[c] >> j & 1]), side([c for c in cs if x[c] >> j & 1])
                top = max(top, (ga * ga / (ha + 1) + gb * gb / (hb + 1), -j))
            return top[0], -top[1]

        _, root = best(list(cells))
        parts = [[c for c in cells if (x[c] >> root & 1) == v] for v in (0, 1)]
        seconds = [best(p)[1] for p in parts]
        leaves = []
        for p, j in zip(parts, seconds, strict=True):
            for v in (0, 1):
                own = [c for c in p if (x[c] >> j & 1) == v]
                g, h = side(own)
                leaves.append(RATE * g / (h + 1))
                for c in own:
                    score[c] += leaves[-1]
        trees.append((root, *seconds, leaves))
    return trees


def _score_of(trees: list[tuple], bits: int) -> float:
    return sum(leaves[(bits >> root & 1) * 2 + (bits >> (hi if bits >> root & 1 else lo) & 1)] for root, lo, hi, leaves in trees)


def _score(trees: list[tuple], kind: int, bits: Column) -> Column:
    """The trees as one expression: a fold over a constant array."""
    table = F.array(*[F.struct(F.lit(root).alias("r"), F.lit(lo).alias("a"), F.lit(hi).alias("b"), F.array(*[F.lit(float(v)) for v in leaves]).alias("v")) for root, lo, hi, leaves in trees])
    own = bits.bitwiseOR(F.lit(1 << (len(FEATURES) + kind)))
    bit = lambda j: F.call_function("shiftright", own, j).bitwiseAND(F.lit(1))
    return F.aggregate(table, F.lit(0.0), lambda a, t: a + F.get(t["v"], bit(t["r"]) * 2 + bit(F.when(bit(t["r"]) == 1, t["b"]).otherwise(t["a"]))))


def calibrate(scored: list[tuple[float, float, float]], precision: float = PRECISION) -> float | None:
    """The least score whose calibrated share of right examples is enough; None if none is.

    ``scored``: score, right and wrong weight. Shares are made to rise with the
    score by pooling neighbours that fall (a millionth lower, as sums may round differently).
    """
    pools: list[list[float]] = []  # least score, right, wrong
    for s, right, wrong in sorted(scored):
        pools.append([s, right, wrong])
        while len(pools) > 1 and pools[-2][1] * (pools[-1][1] + pools[-1][2]) >= pools[-1][1] * (pools[-2][1] + pools[-2][2]):
            _, right, wrong = pools.pop()
            pools[-1][1] += right
            pools[-1][2] += wrong
    return next((s - 1e-6 for s, right, wrong in pools if right > 0 and right >= precision * (right + wrong)), None)


def learn(found: DataFrame) -> tuple[list[tuple], dict[int, float]]:
    """Trees, and for each kind the least score whose examples of the held-back half are right often enough.

    ``found``: proposals of the corpus.
    """
    def tagged(i: int, kind: str) -> Column:
        return F.transform(_passing(f"s_{kind}", kind), lambda x: F.struct(F.lit(i).alias("k"), x.alias("x")))

    passing = [tagged(i, k) for i, k in enumerate(KINDS)]
    true = found.select("doc_id", F.explode(F.concat(*passing)).alias("p")).select("p.k", "p.x", F.abs(F.xxhash64("doc_id", "p.x.s")).alias("h"), F.lit(False).alias("against"))
    sides: list[dict] = [defaultdict(lambda: [0.0, 0.0]) for _ in range(2)]
    for rows in (_examples(_made(found.sparkSession)), _examples(true)):
        counts = rows.collect()
        total = sum(r["count"] for r in counts)
        for r in counts:  # both sources weigh the same, so that a large corpus does not drown the made-up contexts
            sides[r["half"]][r["k"], r["f"]][0 if r["y"] else 1] += r["count"] * MADE / total
    trees = boost({c: (p, n) for c, (p, n) in sorted(sides[0].items())})
    least = {}
    for k in range(len(KINDS)):
        least[k] = calibrate([(_score_of(trees, f | 1 << (len(FEATURES) + k)), p, n) for (kind, f), (p, n) in sides[1].items() if kind == k])
    least = {k: v for k, v in least.items() if v is not None}
    return trees, least


def _settled(found: DataFrame, model: tuple[list[tuple], dict[int, float]]) -> DataFrame:
    """``base`` and ``more`` beside the columns of ``found``: strict spans that pass, and those that the trees add."""
    trees, least = model

    def items(spans: Column, i: int, bits: Callable[[Column], Column]) -> Column:
        score = lambda f: _score(trees, i, f) if bits is not plain else F.lit(0.0)
        return F.transform(spans, lambda x: let(bits(x), lambda f: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e"), f.alias("f"), score(f).cast("double").alias("c")).cast(_ITEM)))

    def chosen(spans: Column, i: int, strict: bool) -> Column:
        return F.filter(items(spans, i, lambda x: _bits(F.lit(i), F.lit(strict), x)), lambda y: y["c"] >= least[i])

    plain = lambda x: F.lit(0)
    base = [items(_passing(f"s_{k}", k), i, plain) for i, k in enumerate(KINDS)]
    more = [chosen(spans, i, strict) for i, k in enumerate(KINDS) if i in least for spans, strict in ((_passing(f"s_{k}", k, False), True), (F.col(f"l_{k}"), False))]
    rows = found.withColumn("base", F.sort_array(F.concat(*base))).withColumn("_more", F.concat(*more) if more else _none(_ITEM))
    return rows.withColumn("more", F.when(F.size("_more") == 0, _none(_ITEM)).otherwise(_apart(_clear(F.col("base"), F.col("_more"))))).drop("_more")


def _clear(base: Column, more: Column) -> Column:
    """Items of ``more`` that overlap none of ``base``, by start."""
    marked = F.sort_array(F.concat(F.transform(base, lambda x: F.struct(x.alias("x"), F.lit(True).alias("b"))), F.transform(more, lambda x: F.struct(x.alias("x"), F.lit(False).alias("b")))))
    of = f"struct<x:{_ITEM},b:boolean,ok:boolean>"
    show = lambda ok: lambda v, y: F.struct(y["x"].alias("x"), y["b"].alias("b"), ok(v, y).alias("ok")).cast(of)
    none = _none(of)
    # the furthest end of base spans so far; read from the end, the nearest start of base spans after it
    fore = scan(marked, F.lit(0), none, lambda v, y: F.when(y["b"], F.greatest(v, y["x"]["e"])).otherwise(v), show(lambda v, y: v <= y["x"]["s"]))
    back = let(fore, lambda a: scan(F.reverse(a), F.lit(2**31 - 1), none, lambda v, y: F.when(y["b"], y["x"]["s"]).otherwise(v), show(lambda v, y: y["ok"] & (v >= y["x"]["e"]))))
    return F.transform(F.filter(F.reverse(back), lambda y: y["ok"] & ~y["b"]), lambda y: y["x"])


def _apart(spans: Column) -> Column:
    """From left to right, of overlapping items the one with the higher score."""
    order = lambda x, y: F.when(x["s"] != y["s"], x["s"] - y["s"]).when(x["e"] != y["e"], y["e"] - x["e"]).otherwise(x["k"] - y["k"])
    nothing = F.lit(None).cast(_ITEM)
    step = lambda v, x: F.when(v.isNull() | (x["s"] >= v["e"]) | (x["c"] > v["c"]), x).otherwise(v)
    # an item is shown once the next one starts after it; a last empty one shows the last
    ended = F.concat(F.array_sort(spans, order), F.array(F.struct(F.lit(2**31 - 1).alias("s"), F.lit(0).alias("k"), F.lit(2**31 - 1).alias("e"), F.lit(0).alias("f"), F.lit(0.0).alias("c")).cast(_ITEM)))
    return F.array_compact(let(ended, lambda a: scan(a, nothing, _none(_ITEM), step, lambda v, x: F.when(v.isNotNull() & (x["s"] >= v["e"]), v))))


def _is(kind: int) -> Callable[[Column], Column]:
    return lambda x: x["k"] == kind


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find(docs: DataFrame, model: tuple[list[tuple], dict[int, float]] | None = None) -> DataFrame:
    """Counts and digest of the strict spans, and ``spans``: those and the selected ones."""
    found = materialise(proposals(docs), "proposals")
    rows = _settled(found, model or learn(found))
    count = [F.size(F.filter("base", _is(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return rows.select("doc_id", *count, F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(F.sort_array(F.concat("base", "more"))).alias("spans"), F.size("more").cast("long").alias("n_added"))


def redact(docs: DataFrame, model: tuple[list[tuple], dict[int, float]] | None = None) -> DataFrame:
    """``doc_id, text`` with each found span replaced by its kind in brackets; overlapping spans as one, by the first."""
    found = materialise(proposals(docs, F.coalesce("text", F.lit("")).alias("_whole")), "proposals")
    rows = _settled(found, model or learn(found)).select("doc_id", "_whole", F.sort_array(F.concat("base", "more")).alias("_all"))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    whole = F.col("_whole")
    piece = lambda p, x: F.when(x["s"] < p, "").otherwise(F.concat(F.substr(whole, p + 1, x["s"] - p), F.get(names, x["k"])))
    parts = scan(F.col("_all"), F.lit(0), _none("string"), lambda p, x: F.greatest(p, x["e"]), piece)
    tail = F.substr(whole, F.coalesce(F.array_max(F.transform("_all", lambda x: x["e"])), F.lit(0)) + 1)
    return rows.select("doc_id", F.concat(F.array_join(parts, ""), tail).alias("text"))
