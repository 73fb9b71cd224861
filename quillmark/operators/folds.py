"""Sequential folds: rules where a refused row leaves no trace, so that no window frame expresses them.

Rows are dealt by key and sorted within partitions; a task streams through its
keys with a few counters, so no group is gathered whole.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold(rows: DataFrame, key: str, order: list, columns: list[str], start: Callable, step: Callable, out: str) -> DataFrame:
    """``step(state, row)`` gives the output row; ``start()`` a key's first state."""
    schema = out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = object(), None
        for batch in batches:
            result = []
            for row in batch.to_pylist():
                if row[key] != now:
                    now, state = row[key], start()
                result.append(step(state, row))
            if result:
                yield pa.RecordBatch.from_pylist(result)

    return rows.select(key, *columns).repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def rate_limit(events: DataFrame, most: int, seconds: float) -> DataFrame:
    """``user_id, event_id, allowed, retry_after``: trailing window in which refused requests do not count."""

    def step(times: deque, row: dict) -> dict:
        now = row["at"]
        while times and times[0] <= now - seconds:
            times.popleft()
        ok = len(times) < most
        retry = 0.0 if ok else max(seconds - (now - times[0]), 1.0)
        if ok:
            times.append(now)
        return {"user_id": row["user_id"], "event_id": row["event_id"], "allowed": ok, "retry_after": round(retry, 6)}

    return fold(events, "user_id", ["at", "event_id"], ["at", "event_id"], deque, step, "user_id long, event_id long, allowed boolean, retry_after double")


def capped_selection(records: DataFrame, guideline_cap: int, total_cap: int) -> DataFrame:
    """``doc_id, source, decision, reason``: best first within a source; refused rows use up no cap."""

    def step(used: dict, row: dict) -> dict:
        if row["no_abstract"]:
            decision, reason = "rejected", "no abstract"
        elif used["all"] >= total_cap:
            decision, reason = "rejected", "total cap"
        elif row["guideline"] and used["guideline"] >= guideline_cap:
            decision, reason = "rejected", "guideline cap"
        else:
            decision, reason = "selected", ""
            used["all"] += 1
            used["guideline"] += row["guideline"]
        return {"doc_id": row["doc_id"], "source": row["source"], "decision": decision, "reason": reason}

    return fold(records, "source", [F.desc("score"), "doc_id"], ["doc_id", "no_abstract", "guideline", "score"], lambda: {"all": 0, "guideline": 0}, step, "doc_id long, source string, decision string, reason string")


def token_budget(turns: DataFrame, most: int) -> DataFrame:
    """``conv_id, turn, used, allowed``: a turn that would exceed the budget is refused and uses nothing."""

    def step(state: dict, row: dict) -> dict:
        ok = state["used"] + row["tokens"] <= most
        state["used"] += row["tokens"] if ok else 0
        return {"conv_id": row["conv_id"], "turn": row["turn"], "used": state["used"], "allowed": ok}

    return fold(turns, "conv_id", ["turn"], ["turn", "tokens"], lambda: {"used": 0}, step, "conv_id long, turn long, used long, allowed boolean")
