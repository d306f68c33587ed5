"""Numbered pages of records as a data source: spark.read.format("pages").

Options: ``url`` with {page} in it (http, https, or a folder or file that all executors see), ``first`` (0) and ``last`` page,
``resume`` (the first page that hasn't been read yet), ``per_task`` (pages of a partition, 8), ``tries`` (5) and ``pause``
(seconds before the second try, doubled each time). Each page has a JSON record a line, or is one JSON array.
Rows: page, place (from 0 in the page) and record (JSON text). A missing page is an error, never left out.
"""

from __future__ import annotations

import json
import re
import time
import urllib.request
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "page long, place int, record string"


def fetch(url: str) -> list[str]:
    """The bodies behind an address: one from the web, or those of a folder's files in order of their names."""
    if re.match(r"https?://", url):
        with urllib.request.urlopen(url, timeout=60) as answer:
            return [answer.read().decode()]
    import pyarrow.fs as pafs

    fs, at = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", url))
    info = fs.get_file_info(at)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(url)
    files = [info] if info.type == pafs.FileType.File else sorted(fs.get_file_info(pafs.FileSelector(at)), key=lambda f: f.path)
    bodies = []
    for f in files:
        if not f.base_name.startswith(("_", ".")):
            with fs.open_input_stream(f.path) as stream:
                bodies.append(stream.read().decode())
    return bodies


def with_retries(url: str, tries: int, pause: float) -> list[str]:
    """fetch(url), tried again when the connection or the server fails; a page that isn't there is asked for once."""
    for left in range(tries - 1, -1, -1):
        try:
            return fetch(url)
        except FileNotFoundError:
            raise
        except OSError as e:  # refused, reset, timed out; answers of 4xx but 429 won't get better
            if not left or (400 <= getattr(e, "code", 500) < 500 and e.code != 429):
                raise
        time.sleep(pause)
        pause *= 2
    raise ValueError("tries must be positive")


def records(body: str) -> Iterator[str]:
    """The records of a page, as JSON texts."""
    if body.lstrip().startswith("["):
        yield from (json.dumps(r, ensure_ascii=False) for r in json.loads(body))
    else:
        yield from (line for line in body.split("\n") if line.strip())


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class PagesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.tries, self.pause = options["url"], int(options.get("tries", 5)), float(options.get("pause", 1))
        self.first = max(int(options.get("first", 0)), int(options.get("resume", 0)))
        self.last, self.per_task = int(options["last"]), max(1, int(options.get("per_task", 8)))
        if "{page}" not in self.url and self.first < self.last:
            raise ValueError("url must hold {page}")

    def partitions(self) -> list[PageRange]:
        return [PageRange(p, min(p + self.per_task - 1, self.last)) for p in range(self.first, self.last + 1, self.per_task)] or [PageRange(0, -1)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        for page in range(partition.first, partition.last + 1):
            place = 0
            for body in with_retries(self.url.replace("{page}", str(page)), self.tries, self.pause):
                for record in records(body):
                    yield page, place, record
                    place += 1


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PagesReader:
        return PagesReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Pages)
