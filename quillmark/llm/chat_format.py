r"""Chat formatting with a grammar round trip.

A formatted conversation is a row of turns, each between an opening and a closing mark:

    [INST] user text [/INST]      <s> assistant text </s>
    <<SYS>>\nsystem text\n<</SYS>>\n      [ROLE:name] text of any other role [/ROLE]

The parser is deterministic: the mark at hand tells the role, the turn ends with
the next mark, which must be the closing one, and a backslash behind the bracket of
a mark is taken off (``[\INST]`` reads as ``[INST]``). Each turn is first rendered as
it is and parsed again; where what comes back is not the turn that went in, its
text is escaped (one backslash more in each string that looks like a mark, with
backslashes or without) and parsed once more. Then whole parts are parsed and
compared in the same way. A part that would not come back raises an error; escaping
changes every such string reversibly, so none does. Texts without conflicts keep
every character.

Turns are self-contained, so conversations are rendered by blocks of ``TURNS`` turn
numbers, each in parts of about ``PART`` characters: no conversation has to fit in
one task. Reading back streams the parts in order through a parser and running
digests, with the memory of one part.

Defined results: a null text counts as empty and a null role as a role without a
name; turns come by number (null first), then role and text, so repeated rows are
turns of their own; rows without ``conv_id`` form one conversation without a number;
a text of any length is formatted whole; extra columns are ignored; an empty table
gives no conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shuffle_partitions

TURNS, PART = 4096, 1 << 20
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n")}
#: Strings that look like a mark, with any number of backslashes behind the bracket.
LOOKALIKE = re.compile(r"(<)(\\*)(</?SYS>>|/?s>)|(\[)(\\*)(/?INST\]|/?ROLE[:\]])")
_MARK = re.compile(r"<<(/?)SYS>>|<(/?)s>|\[(/?)INST\]|\[(/?)ROLE[:\]]")
_NAMED = re.compile(r"\[ROLE:([A-Za-z0-9_.~%-]*)\] ")
#: Role whose text carries the loss.
LEARNED = "assistant"

Turn = tuple[str, str]


class GrammarError(ValueError):
    """A text that the grammar does not derive."""


def marks(role: str) -> Turn:
    return MARKS.get(role) or (f"[ROLE:{quote(role, safe='')}] ", " [/ROLE]")


def escape(text: str) -> str:
    return LOOKALIKE.sub(lambda m: f"{m[1] or m[4]}\\{m[2] or m[5] or ''}{m[3] or m[6]}", text)


def unescape(text: str) -> str:
    return LOOKALIKE.sub(lambda m: f"{m[1] or m[4]}{(m[2] or m[5] or '')[1:]}{m[3] or m[6]}", text)


def render(turns: list[Turn], escaped: set[int]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and where the texts of the learned role lie in it."""
    out, spans, at = [], [], 0
    for i, (role, text) in enumerate(turns):
        (opening, closing), body = marks(role), escape(text) if i in escaped else text
        if role == LEARNED:
            spans.append((at + len(opening), at + len(opening) + len(body)))
        out += [opening, body, closing]
        at += len(opening) + len(body) + len(closing)
    return "".join(out), spans


def parse(text: str) -> Iterator[Turn]:
    """The turns of a formatted text; raises ``GrammarError`` where it leaves the grammar."""
    at = 0
    while at < len(text):
        if named := _NAMED.match(text, at):
            role, opening = unquote(named[1]), named[0]
        else:
            role, opening = next(((r, m[0]) for r, m in MARKS.items() if text.startswith(m[0], at)), (None, ""))
            if role is None:
                raise GrammarError(f"no turn begins at {at}")
        closing, begin = marks(role)[1], at + len(opening)
        mark = _MARK.search(text, begin)
        end = mark.start() - (len(closing) - len(closing.lstrip())) if mark else -1
        if end < begin or not text.startswith(closing, end):
            raise GrammarError(f"the turn at {at} does not end")
        yield role, unescape(text[begin:end])
        at = end + len(closing)


def _first_difference(turns: list[Turn], text: str) -> int | None:
    """Number of the first turn that does not come back."""
    i = 0
    try:
        for got in parse(text):
            if i >= len(turns) or got != turns[i]:
                return min(i, len(turns) - 1)
            i += 1
    except GrammarError:
        return min(i, len(turns) - 1)
    return None if i == len(turns) else i


def settle(turns: list[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """Rendered turns that parse to the same turns, and the spans of the learned role."""
    escaped = {i for i, turn in enumerate(turns) if _first_difference([turn], render([turn], set())[0]) is not None}
    while True:
        text, spans = render(turns, escaped)
        wrong = _first_difference(turns, text)
        if wrong is None:
            return text, spans
        if wrong in escaped:
            raise GrammarError(f"turn {wrong} does not come back")
        escaped.add(wrong)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for some in range(0, batch.num_rows, 1024):
            yield from batch.slice(some, 1024).to_pylist()


FORMATTED = "conv_id bigint, block bigint, part bigint, n_turns bigint, text string, loss array<struct<start:bigint,end:bigint>>"


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, block, part, n_turns, text, loss`` of ``conv_id, turn, role, text``: parts in order of block and part make a conversation.

    ``loss`` are the spans of ``text`` (code points, end exclusive) that hold the learned role's words, escaped as they stand.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    names = ["conv_id", "block", "part", "n_turns", "text", "loss"]

    def record(key: tuple, part: int, held: list[Turn]) -> pa.RecordBatch:
        text, spans = settle(held)
        values = [key[0]], [key[1]], [part], [len(held)], [text], [[{"start": a, "end": b} for a, b in spans]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, [*[pa.int64()] * 4, pa.string(), kind], strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, size = [], 0
        for key, rows in groupby(_rows(batches), lambda r: (r["conv_id"], r["block"])):
            held, n, part = [], 0, 0
            for r in rows:
                held.append((r["role"], r["text"]))
                n += len(r["text"])
                if n >= PART:
                    yield record(key, part, held)
                    held, n, part = [], 0, part + 1
            if held:
                done.append(record(key, part, held))
                size += n
            if size >= PART:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
                done, size = [], 0
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-(1 << 62))).cast("long"))
    parts = shuffle_partitions(turns.sparkSession)
    ordered = rows.repartition(parts, "conv_id", "block").sortWithinPartitions("conv_id", "block", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("conv_id", "block", "role", "text").mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """A row for each conversation, from its formatted parts alone: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    Digests are over role and text of each parsed turn, and over what the loss spans cover, unescaped.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done, strict=True), kinds, strict=True)], names)
            done.clear()
            return out

        for conv_id, parts in groupby(_rows(batches), lambda r: r["conv_id"]):
            n = chars = learned = 0
            turns, loss = hashlib.sha256(), hashlib.sha256()
            for r in parts:
                for role, text in parse(r["text"]):
                    turns.update(f"{role}\n{text}\n".encode())
                    n += 1
                for span in r["loss"]:
                    words = unescape(r["text"][span["start"] : span["end"]])
                    loss.update(words.encode())
                    learned += len(words)
                chars += len(r["text"])
            done.append((conv_id, n, turns.hexdigest(), learned, loss.hexdigest(), chars))
            if len(done) >= 4096:
                yield flush()
        if done:
            yield flush()

    parts = shuffle_partitions(formatted.sparkSession)
    ordered = formatted.select("conv_id", "block", "part", "text", "loss").repartition(parts, "conv_id").sortWithinPartitions("conv_id", "block", "part")
    return ordered.select("conv_id", "text", "loss").mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
