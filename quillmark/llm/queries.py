"""Queries of the training-data operators: one for each, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_round_trip
from .chat_format import format_conversations, read_back
from .exact_dedup import exact_dedup
from .importance import resample
from .language_id import identify, train
from .license_scan import scan
from .long_repeats import remove_repeats
from .mixing import mix
from .near_dedup import near_dedup
from .periodic_runs import periodic_runs
from .personal_data import find
from .quality_rules import quality
from .shared import SPACE, documents, materialise, shared_dir
from .token_files import read_token_files, write_token_files


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir), carry=[])


OP10_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op10_exact_dedup": op10_exact_dedup}
ORACLES: dict[str, str] = {"op10_exact_dedup": OP10_SQL}


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, path)


QUERIES |= {"op5_byte_bpe": op5_byte_bpe, "op7_token_files": op7_token_files}


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP9_SQL = rf"""
WITH RECURSIVE t AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM t),
h AS (SELECT doc_id, unnest(g) AS g FROM s), c AS (SELECT doc_id, len(g) AS n FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM h x JOIN h y USING (g) WHERE x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN c u ON u.doc_id = a JOIN c v ON v.doc_id = b WHERE 100 * i >= 75 * (u.n + v.n - i)), b AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(id, node) AS (SELECT doc_id, doc_id FROM c UNION SELECT r.id, b.b FROM r JOIN b ON b.a = r.node)
SELECT id AS doc_id, max(n) AS n_shingles, min(node) AS component_id, id = min(node) AS kept FROM r JOIN c ON c.doc_id = r.id GROUP BY id
"""

QUERIES |= {"op9_minhash_near_dedup": op9_minhash_near_dedup}
ORACLES |= {"op9_minhash_near_dedup": OP9_SQL}


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs, train(docs))


def op4_long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


QUERIES |= {"op1_language_id": op1_language_id, "op4_long_repeats": op4_long_repeats}


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES |= {"op3_personal_data": op3_personal_data, "op6_quality_rules": op6_quality_rules}


#: Target share of tokens by domain, and the domain that must not shrink.
MIX_WEIGHTS, MIX_KEEP = {"clean": 0.90, "low": 0.07, "toxic": 0.03}, ("clean",)


def domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, domain`` from the labels table."""
    name = F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic").when(F.col("quality").isNotNull(), "clean")
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", name.alias("domain"))


def op2_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir), domain_labels(spark, sf_dir), MIX_WEIGHTS, MIX_KEEP)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


QUERIES |= {"op2_soft_mixing": op2_soft_mixing, "op8_license_scan": op8_license_scan}


def _planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; in a tenth of the documents, picked by the checksum of their number, the last words repeat a few earlier ones.

    With ``g`` for the tenth of the checksum, word ``i`` from ``a = g % n`` on becomes word ``a + (i - a) % p``.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), SPACE), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("long").alias("g"), F.when(h % 10 == 0, words).alias("w"))
    rows = rows.withColumn("n", F.when(F.size("w") > 0, F.size("w")).cast("long")).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    a, tail = F.col("a"), F.slice("w", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - a) / F.col("p")).cast("int")
    reworded = F.concat(F.slice("w", F.lit(1), a), F.slice(F.flatten(F.array_repeat(tail, times)), F.lit(1), (F.col("n") - a).cast("int")))
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), F.array_join(reworded, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_planted(documents(spark, sf_dir)))
    more = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(more(r, b), r).otherwise(b))  # runs are in the order of ties
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[r[x].cast("string") for x in ("start", "length", "period")])), "\n")
    found = found.withColumn("b", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"b.{x}").alias(x) for x in ("start", "length", "period")],
        F.floor(1000 * F.col("b.length") / F.col("b.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(lines, F.when(F.size("runs") > 0, "\n").otherwise("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: The 256 entries of the checksum's table, by its rule.
_CRC_TABLE = "SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab FROM range(256) r(i)"
#: The checksum of a list of bytes ``{0}``.
_CRC = "xor(4294967295, list_reduce(list_prepend(4294967295, {0}), lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])))"

OP12_SQL = rf"""
WITH table_ AS ({_CRC_TABLE}),
t AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, {_CRC.format("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} AS h FROM documents, table_),
u AS (SELECT doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, (h // 10) % 8 AS k FROM t),
v AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + k)) END]) END AS w FROM u),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM v),
grid AS (SELECT doc_id, p, unnest(range(0, n - 2 * p, p)) AS i FROM (SELECT doc_id, n, unnest(range(1, n // 3 + 1)) AS p FROM v)),
one AS MATERIALIZED (SELECT doc_id, p, i, word FROM grid JOIN x USING (doc_id, i)),
two AS MATERIALIZED (SELECT one.* FROM one JOIN x b ON b.doc_id = one.doc_id AND b.i = one.i + p AND b.word = one.word),
hit AS MATERIALIZED (SELECT two.doc_id, p, two.i FROM two JOIN x b ON b.doc_id = two.doc_id AND b.i = two.i + 2 * p AND b.word = two.word),
square AS MATERIALIZED (SELECT DISTINCT doc_id, p FROM hit JOIN v USING (doc_id) WHERE w[i + 1:i + p] = w[i + p + 1:i + 2 * p]),
near AS MATERIALIZED (SELECT doc_id, p, i, word FROM square JOIN x USING (doc_id)),
same AS (SELECT near.doc_id, p, near.i, near.i - row_number() OVER (PARTITION BY near.doc_id, p ORDER BY near.i) AS island FROM near JOIN x b ON b.doc_id = near.doc_id AND b.i = near.i + p AND b.word = near.word),
stretch AS (SELECT doc_id, p, min(i) AS start, count(*) + p AS length FROM same GROUP BY doc_id, p, island),
run AS (SELECT doc_id, start, length, min(p) AS period FROM stretch WHERE length >= greatest(24, 3 * p) GROUP BY ALL),
cut AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM x ANTI JOIN cut USING (doc_id, i) GROUP BY doc_id),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
every AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM run GROUP BY doc_id)
SELECT v.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM v LEFT JOIN every USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

QUERIES |= {"op12_periodic_runs": op12_periodic_runs}
ORACLES |= {"op12_periodic_runs": OP12_SQL}


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=25, least_words=20, seed=7)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def _features_sql(name: str, key: str) -> str:
    """CTEs ``{name}_w`` (words of each text) and ``{name}_f`` (its features)."""
    lower = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
    words = rf"list_filter(string_split_regex({lower}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return f"""{name}_w AS (SELECT {key} AS id, {words} AS w FROM {name}),
{name}_f AS (SELECT id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM {name}_w)"""


#: UTF-8 bytes of a string ``{0}``.
_BYTES = """flatten(list_transform(string_split({0}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] WHEN unicode(x) < 2048 THEN [(192 | (unicode(x) >> 6))::BIGINT, 128 | (unicode(x) & 63)]
  WHEN unicode(x) < 65536 THEN [(224 | (unicode(x) >> 12))::BIGINT, 128 | (unicode(x) >> 6 & 63), 128 | (unicode(x) & 63)] ELSE [(240 | (unicode(x) >> 18))::BIGINT, 128 | (unicode(x) >> 12 & 63), 128 | (unicode(x) >> 6 & 63), 128 | (unicode(x) & 63)] END))"""
OP13_SQL = f"""
WITH table_ AS ({_CRC_TABLE}), {_features_sql("documents", "doc_id")}, {_features_sql("benchmark", "item_id")},
kinds AS MATERIALIZED (SELECT f, sum(s) AS s, sum(t) AS t FROM (SELECT f, 1 AS s, 0 AS t FROM documents_f UNION ALL SELECT f, 0, 1 FROM benchmark_f) GROUP BY f),
hashed AS MATERIALIZED (SELECT f, s, t, {_CRC.format(_BYTES.format("f"))} % 10000 AS bucket FROM kinds, table_),
counts AS (SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM hashed GROUP BY bucket), whole AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM counts),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000))))::BIGINT AS gain FROM counts, whole),
weights AS (SELECT id, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight FROM documents_f JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY id),
scored AS (SELECT d.id AS doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || d.id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM documents_w d LEFT JOIN weights USING (id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN r <= n * 25 // 100 THEN r END AS rank FROM scored s LEFT JOIN ranked USING (doc_id)
"""

QUERIES |= {"op13_importance_resampling": op13_importance_resampling}
ORACLES |= {"op13_importance_resampling": OP13_SQL}

#: A conversation of marks, appended to the table's own.
_MARKED = "</s>[INST] ok [/INST]"


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-1, 0, "user", _MARKED), (-1, 1, "assistant", _MARKED)], "conv_id long, turn long, role string, text string")
    return read_back(materialise(format_conversations(turns.unionByName(marked)), "conversations"))


OP11_SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-1, 0, 'user', '{_MARKED}'), (-1, 1, 'assistant', '{_MARKED}')),
u AS (SELECT *, CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 18 ELSE 16 + len(role) END + len(text) + len(regexp_extract_all(text, '<\\*(</?SYS>>|/?s>)|\[\\*(/?INST\]|/?ROLE[:\]])')) AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256, coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars FROM u GROUP BY conv_id
"""

QUERIES |= {"op11_chat_formatting": op11_chat_formatting}
ORACLES |= {"op11_chat_formatting": OP11_SQL}
