"""A paged search API as a data source. Pages are read through a fetch function, here from a folder of saved
pages; one partition a query, so that the pages of a query keep their pace and global rank."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class SavedPages(DataSource):
    """Format 'saved_pages': option path, with files <query>/<page>.json, each {"total": n, "entries": [...]}."""

    @classmethod
    def name(cls):
        return "saved_pages"

    def schema(self):
        return "query string, rank int, source_id string, title string, published string"

    def reader(self, schema):
        return _Reader(self.options)


class _Query(InputPartition):
    def __init__(self, query):
        self.query = query


class _Reader(DataSourceReader):
    TRIES, WAIT = 3, 0.1

    def __init__(self, options):
        self.path = options["path"]

    def partitions(self):
        return [_Query(q) for q in sorted(os.listdir(self.path))]

    def fetch(self, file):
        for k in range(self.TRIES):
            try:
                with open(file, encoding="utf-8") as f:
                    return json.load(f)
            except OSError:
                time.sleep(self.WAIT * (k + 1))
        raise OSError(f"{file} can't be read")

    def read(self, partition):
        folder, rank = f"{self.path}/{partition.query}", 0
        for page in sorted(os.listdir(folder)):
            for e in self.fetch(f"{folder}/{page}").get("entries", []):
                rank += 1
                yield (partition.query, rank, str(e.get("id") or ""), " ".join(str(e.get("title") or "").split()), e.get("published"))


class Refused(Exception):
    """A server's answer that isn't a page: its status, and the seconds it asks to wait."""

    def __init__(self, status: int, after: float | None = None):
        super().__init__(f"status {status}")
        self.status, self.after = status, after


def politely(fetch, waits: tuple = (0, 20, 40), spacing: float = 3.0, sleep=time.sleep, clock=time.monotonic):
    """fetch with a wait before each try (what the server asks for, if that is longer), and spacing between any two calls. Busy
    and broken servers (429, 5xx) and lost connections are tried again, other refusals aren't."""
    last = [-float("inf")]

    def call(*args):
        asked = 0.0
        for k, wait in enumerate(waits):
            sleep(max(wait, asked, spacing - (clock() - last[0]), 0))
            last[0] = clock()
            try:
                return fetch(*args)
            except Refused as e:
                if e.status != 429 and e.status < 500 or k == len(waits) - 1:
                    raise
                asked = e.after or 0.0
            except OSError:
                if k == len(waits) - 1:
                    raise
        raise AssertionError("no wait, no try")

    return call


def in_rounds(fetch, queries: list[str], size: int, pool: int):
    """(query, start, entries): the first page of every query, then the second of every query, and so on, until pool different
    ids are found or every query is exhausted."""
    seen: set[str] = set()
    open_ = list(queries)
    start = 0
    while open_ and len(seen) < pool:
        for q in list(open_):
            entries = fetch(q, start, size)
            if len(entries) < size:
                open_.remove(q)
            if entries:
                seen.update(str(e["id"]) for e in entries)
                yield q, start, entries
            if len(seen) >= pool:
                return
        start += size
