"""A defect tracker as a Spark data source, over a transport that can be exchanged: HTTP, or recorded responses."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RETRY = frozenset({408, 429, 500, 502, 503, 504})


def http_transport(base_url: str, agent: str, timeout: float = 60.0) -> Callable[[str], tuple[int, dict[str, str], str]]:
    def get(query: str) -> tuple[int, dict[str, str], str]:
        request = urllib.request.Request(f"{base_url.rstrip('/')}/{query}", headers={"User-Agent": agent, "Accept": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return answer.status, dict(answer.headers), answer.read().decode("utf-8", "replace")
        except urllib.error.HTTPError as error:
            return error.code, dict(error.headers or {}), ""

    return get


def recorded_transport(folder: str) -> Callable[[str], tuple[int, dict[str, str], str]]:
    """Answers from files named by the quoted query; a missing one is a 404."""

    def get(query: str) -> tuple[int, dict[str, str], str]:
        from pyarrow import fs

        path = f"{folder.rstrip('/')}/{urllib.parse.quote(query, safe='')}.json"
        files, local = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        if files.get_file_info(local).type == fs.FileType.NotFound:
            return 404, {}, ""
        with files.open_input_stream(local) as stream:
            return 200, {}, stream.read().decode("utf-8", "replace")

    return get


def fetch(get, query: str, retries: int = 4, most_delay: float = 60.0, sleep=time.sleep) -> str:
    """The answer's text; tries again on overload and server errors, waiting as told or twice as long each time."""
    for attempt in range(retries + 1):
        status, headers, text = get(query)
        if status == 200:
            return text
        if status not in RETRY or attempt == retries:
            raise OSError(f"{query}: status {status}")
        told = headers.get("Retry-After", "")
        sleep(min(most_delay, float(told) if told.replace(".", "", 1).isdigit() else 2.0**attempt))
    raise AssertionError


class TrackerSource(DataSource):
    """``spark.read.format("tracker")`` with options ``queries`` (JSON list), and ``folder`` or ``url`` and ``agent``.

    Rows are (query, body). ``delay`` is the pause before each request of a task.
    """

    @classmethod
    def name(cls) -> str:
        return "tracker"

    def schema(self) -> str:
        return "query string, body string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        queries = json.loads(self.options["queries"])
        tasks = max(1, int(self.options.get("tasks", "1")))
        return [InputPartition(queries[i::tasks]) for i in range(tasks)]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        o = self.options
        get = recorded_transport(o["folder"]) if "folder" in o else http_transport(o["url"], o.get("agent", "quernflow"))
        for query in partition.value:
            if float(o.get("delay", "0")):
                time.sleep(float(o["delay"]))
            yield query, fetch(get, query)


def unnest_comments(payloads: DataFrame) -> DataFrame:
    """(bug_id, count, text, creation_time, attachment_id) from comment payloads (bug_id, body)."""
    one = "struct<comments: array<struct<count: long, text: string, creation_time: string, attachment_id: long>>>"
    bugs = F.from_json("body", f"bugs map<string, {one}>")["bugs"]
    rows = payloads.select("bug_id", F.explode(bugs[F.col("bug_id").cast("string")]["comments"]).alias("c"))
    return rows.select("bug_id", "c.*")


def unnest_attachments(payloads: DataFrame) -> DataFrame:
    """(bug_id, id, file_name, content_type, summary, is_patch, data) from attachment payloads (bug_id, body)."""
    one = "struct<id: long, file_name: string, content_type: string, summary: string, is_patch: int, data: string>"
    bugs = F.from_json("body", f"bugs map<string, array<{one}>>")["bugs"]
    rows = payloads.select("bug_id", F.explode(bugs[F.col("bug_id").cast("string")]).alias("a"))
    return rows.select("bug_id", "a.*")
