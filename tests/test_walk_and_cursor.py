"""Collection day by day and pages behind a cursor: failures, deadlines, restarts."""

import datetime as dt
import json

import pytest

from quillmark.sources import cursor as C
from quillmark.streaming import walk as W

DAY = dt.date(2024, 5, 10)
FIRST = dt.date(2024, 5, 1)


def provider(spark, counts, asked=None, broken=()):
    def ask(day):
        if asked is not None:
            asked.append(day)
        if day in broken:
            raise TimeoutError("no answer")
        return spark.range(counts.get(day.day, 0)).withColumnRenamed("id", "record")

    return ask


def rows(frame):
    return {r["provider"]: r for r in frame.collect()}


def test_first_run_asks_for_today_and_the_next_catches_up(spark, tmp_path):
    asked, folder = [], str(tmp_path)
    ask = {"a": provider(spark, {10: 2, 11: 1, 13: 4}, asked)}
    assert rows(W.walk(spark, ask, folder, DAY, FIRST))["a"]["covered_through"] == DAY
    r = rows(W.walk(spark, ask, folder, DAY + dt.timedelta(days=3), FIRST))["a"]
    assert asked == [DAY + dt.timedelta(days=i) for i in range(4)] and (r["status"], r["days"], r["records"]) == ("completed", 3, 5)
    assert spark.read.parquet(f"{folder}/records").count() == 7 and W.missed(spark, folder, DAY + dt.timedelta(days=4)) == [DAY + dt.timedelta(days=1), DAY + dt.timedelta(days=2)]
    again = rows(W.walk(spark, ask, folder, DAY + dt.timedelta(days=3), FIRST))["a"]
    assert (again["status"], again["days"]) == ("completed", 0)


def test_a_failing_provider_keeps_its_days_and_others_go_on(spark, tmp_path):
    folder = str(tmp_path)
    W.walk(spark, {"a": provider(spark, {10: 1}), "b": provider(spark, {10: 1})}, folder, DAY, FIRST)
    bad = DAY + dt.timedelta(days=2)
    got = rows(W.walk(spark, {"a": provider(spark, {11: 5, 12: 5, 13: 5}, broken=[bad]), "b": provider(spark, {12: 3})}, folder, DAY + dt.timedelta(days=3), FIRST))
    assert (got["a"]["status"], got["a"]["error"], got["a"]["covered_through"], got["a"]["records"]) == ("failed", "TimeoutError", DAY + dt.timedelta(days=1), 5)
    assert got["b"]["status"] == "completed" and got["b"]["covered_through"] == DAY + dt.timedelta(days=3)
    asked = []
    W.walk(spark, {"a": provider(spark, {12: 7}, asked)}, folder, DAY + dt.timedelta(days=3), FIRST)
    assert asked == [bad, bad + dt.timedelta(days=1)] and W.covered(spark, folder)["a"] == DAY + dt.timedelta(days=3)


def test_the_walk_stops_at_the_deadline_and_keeps_the_days_done(spark, tmp_path):
    folder, now = str(tmp_path), [0.0]
    W.walk(spark, {"a": provider(spark, {10: 1}), "b": provider(spark, {10: 1})}, folder, DAY, FIRST)

    def slow(day):
        now[0] += 200
        return spark.range(2)

    got = rows(W.walk(spark, {"a": slow, "b": slow}, folder, DAY + dt.timedelta(days=9), FIRST, W.Deadline(clock=lambda: now[0])))
    assert (got["a"]["status"], got["a"]["days"], got["a"]["covered_through"]) == ("deadline", 3, DAY + dt.timedelta(days=3)) and (got["b"]["status"], got["b"]["covered_through"]) == ("skipped", DAY)
    d = W.Deadline(clock=lambda: now[0])
    now[0] += W.SOFT
    assert not d.may_start() and not d.over() and d.left() == 0.0


def test_empty_windows_and_busy_days(spark, tmp_path):
    folder = str(tmp_path)
    ask = {k: provider(spark, {}) for k in "abc"}
    got = rows(W.walk(spark, ask, folder, DAY, FIRST, canaries={"a": lambda: 9, "b": lambda: 0}))
    assert [got[k]["status"] for k in "abc"] == ["zero", "zero_unexplained", "completed"] and W.covered(spark, folder) == {"a": DAY, "c": DAY}
    got = rows(W.walk(spark, {"a": provider(spark, {11: 3, 12: 50})}, folder, DAY + dt.timedelta(days=3), FIRST, most=10))
    assert (got["a"]["status"], got["a"]["covered_through"]) == ("limit", DAY + dt.timedelta(days=1))
    asked = []
    W.walk(spark, {"n": provider(spark, {}, asked)}, folder, FIRST - dt.timedelta(days=1), FIRST)
    assert asked == []


@pytest.fixture
def pages(tmp_path):
    """Pages as files, so that the reader's process sees what is added."""

    def put(cursor, records, following=None, **more):
        (tmp_path / f"{cursor.replace('*', 'star')}.json").write_text(json.dumps({"records": records, "nextCursor": following, **more}))

    folder = str(tmp_path)

    def fetch(cursor):
        with open(f"{folder}/{cursor.replace('*', 'star')}.json") as f:
            return json.load(f)

    return put, fetch


def read_up(spark, name, state, out):
    query = spark.readStream.format(name).load().writeStream.format("parquet").option("checkpointLocation", state).option("path", out).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return sorted(json.loads(r["record"])["id"] for r in spark.read.parquet(out).collect())


def test_a_restart_goes_on_with_the_next_page(spark, pages, tmp_path):
    put, fetch = pages
    put("*", [{"id": 1}, {"id": 2}], "c1")
    put("c1", [{"id": 3}], "c2")
    put("c2", [{"id": 4}])
    spark.dataSource.register(C.cursor_source("paged_a", fetch, pages=2))
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    assert read_up(spark, "paged_a", state, out) == [1, 2, 3, 4]
    put("c2", [{"id": 4}, {"id": 5}], "c3")  # the last page has grown and has a successor
    put("c3", [{"id": 6}], "c3")
    assert read_up(spark, "paged_a", state, out) == [1, 2, 3, 4, 5, 6]
    assert read_up(spark, "paged_a", state, out) == [1, 2, 3, 4, 5, 6]


def test_a_page_with_a_fault_stops_the_stream_and_a_mended_one_goes_on(spark, pages, tmp_path):
    put, fetch = pages
    put("*", [{"id": 1}], "c1")
    put("c1", [], None, error="bad query")
    spark.dataSource.register(C.cursor_source("paged_b", fetch))
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    with pytest.raises(Exception, match="bad query"):
        read_up(spark, "paged_b", state, out)
    put("c1", [{"id": 2}], None)
    assert read_up(spark, "paged_b", state, out) == [1, 2]


def test_a_batch_that_is_done_again_has_the_same_rows():
    held = {"*": {"records": [1, 2], "nextCursor": "a"}, "a": {"records": [3], "nextCursor": "b"}, "b": {"records": [4, 5]}}
    reader = C.cursor_source("paged_c", lambda c: held[c], pages=2)({}).simpleStreamReader(None)
    one, middle = reader.read(reader.initialOffset())
    two, end = reader.read(middle)
    assert list(reader.readBetweenOffsets(reader.initialOffset(), middle)) == list(one) and list(reader.readBetweenOffsets(middle, end)) == list(two)
    held["b"] = {"records": [4, 5, 6], "nextCursor": "c"}
    assert [r[2] for r in reader.readBetweenOffsets(middle, end)] == ["4", "5"]
    held["c"] = {"records": []}
    assert [r[2] for r in reader.read(end)[0]] == ["6"]
