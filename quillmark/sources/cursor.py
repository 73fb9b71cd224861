"""Pages behind a cursor as a streaming source: the offset is the cursor, so that a restarted query goes on with the next page.

The cursor of a page is known only from the page before it, so one reader follows it;
what is done with the records is spread over tasks as with any stream.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

#: Of the page that ``fetch`` returns: its records, the cursor of the next page, and keys that report a fault.
RECORDS, NEXT, FAULTS = "records", "nextCursor", ("error", "errors", "warnings")
SCHEMA = "cursor string, place int, record string"


class PageError(ValueError):
    """A page that reports a fault."""


def cursor_source(name: str, fetch: Callable[[str], dict], start: str = "*", pages: int = 1) -> type[DataSource]:
    """A data source ``name`` for ``spark.dataSource.register`` and ``spark.readStream.format(name)``.

    ``fetch(cursor)`` returns a page; a micro-batch takes up to ``pages`` of them. The end
    is a page without a next cursor, with its own cursor as the next one, or without
    records; a stream that is at the end asks again, so that later pages come. Records
    have ``cursor`` (of their page), ``place`` in it, and their JSON text.
    """

    def page_of(cursor: str) -> dict:
        page = fetch(cursor)
        faults = {k: page[k] for k in FAULTS if page.get(k)}
        if faults:
            raise PageError(f"{name} at {cursor}: {faults}")
        return page

    def rows_of(cursor: str, page: dict) -> list[tuple]:
        return [(cursor, i, json.dumps(r, sort_keys=True)) for i, r in enumerate(page.get(RECORDS) or [])]

    class Reader(SimpleDataSourceStreamReader):
        def initialOffset(self) -> dict:  # noqa: N802
            return {"cursor": start, "page": 0, "seen": 0}

        def _follow(self, offset: dict, last: int | None) -> tuple[list[tuple], dict]:
            """Rows and offset after up to ``pages`` pages, or up to page number ``last``; ``seen`` counts rows taken of an unfinished page."""
            out: list[tuple] = []
            cursor, page_no, seen = offset["cursor"], offset["page"], offset["seen"]
            for _ in range(pages if last is None else last - page_no + 1):
                page = page_of(cursor)
                rows = rows_of(cursor, page)
                out += rows[seen:]
                following = page.get(NEXT)
                if not following or following == cursor or not rows:
                    seen = len(rows)  # the last page for now: it may grow or get a successor
                    break
                cursor, page_no, seen = following, page_no + 1, 0
            return out, {"cursor": cursor, "page": page_no, "seen": seen}

        def read(self, begin: dict) -> tuple[Iterator[tuple], dict]:
            out, end = self._follow(begin, None)
            return iter(out), end

        def readBetweenOffsets(self, begin: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
            """The rows of a batch that is done again: those before ``end`` and no others."""
            cursor, page_no, seen = begin["cursor"], begin["page"], begin["seen"]
            while page_no < end["page"]:
                page = page_of(cursor)
                yield from rows_of(cursor, page)[seen:]
                cursor, page_no, seen = page[NEXT], page_no + 1, 0
            if end["seen"] > seen:
                yield from rows_of(cursor, page_of(cursor))[seen : end["seen"]]

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def simpleStreamReader(self, schema) -> Reader:  # noqa: N802
            return Reader()

    return Source
