"""Rows of a paged HTTP API, a partition a page, as a Spark data source named ``paged_rows``.

Options: url (of the rows; offset and length are added), total (rows to read, or none to ask the API),
length (rows a page), tries. A page is JSON {"rows": [{"row": {...}}], "num_rows_total": n}. Every
read of a page is independent, so a lost task only asks for its own page again.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quillmesh.functions import text


def fetch(url: str, tries: int = 3, pause: float = 1.0) -> dict:
    """A JSON document; a refusal waits as long as its Retry-After says, other failures a little longer each time."""
    for n in range(tries):
        try:
            with urllib.request.urlopen(url, timeout=60) as r:
                return json.load(r)
        except urllib.error.HTTPError as e:
            if n == tries - 1 or e.code not in (403, 429, 500, 502, 503, 504):
                raise
            time.sleep(float(e.headers.get("Retry-After") or pause * (n + 1)))
        except (urllib.error.URLError, TimeoutError):
            if n == tries - 1:
                raise
            time.sleep(pause * (n + 1))
    raise ValueError("tries must be at least 1")


class Page(InputPartition):
    def __init__(self, offset: int, length: int):
        self.offset, self.length = offset, length


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.length, self.tries = options["url"], int(options.get("length", 100)), int(options.get("tries", 3))
        self.total = int(options["total"]) if "total" in options else None

    def page(self, offset: int, length: int) -> dict:
        return fetch(f"{self.url}{'&' if '?' in self.url else '?'}offset={offset}&length={length}", self.tries)

    def partitions(self) -> list[Page]:
        total = self.page(0, 1)["num_rows_total"] if self.total is None else self.total
        return [Page(k, min(self.length, total - k)) for k in range(0, total, self.length)] or [Page(0, 0)]

    def read(self, part: Page) -> Iterator[tuple]:
        if part.length:
            for k, r in enumerate(self.page(part.offset, part.length)["rows"][: part.length]):
                yield part.offset + k, json.dumps(r["row"])


class PagedRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_rows"

    def schema(self) -> str:
        return "pos long, row string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


def paged_rows(spark: SparkSession, url: str, **options: str | int) -> DataFrame:
    spark.dataSource.register(PagedRows)
    return spark.read.format("paged_rows").options(url=url, **options).load()


def tool_rows(rows: DataFrame) -> DataFrame:
    """pos, category, tool_name, endpoint_name, description, raw_method, api: rows whose ``text`` is an API's JSON; bad JSON gives none.

    The tool's name, where none is given, is what stands before the first underscore of the API's name if anything follows it.
    """
    api = F.get_json_object("row", "$.text")
    get = lambda p: F.nullif(F.trim(F.get_json_object("api", p)), F.lit(""))
    parts = F.filter(F.split(F.col("endpoint_name"), "_"), lambda x: x != "")
    out = rows.withColumn("api", api).withColumn("endpoint_name", get("$.name")).where("endpoint_name is not null")
    tool = F.coalesce(get("$.tool_name"), F.when(F.size(parts) >= 2, F.element_at(parts, 1)).otherwise(F.col("endpoint_name")))
    return out.select("pos", F.coalesce(get("$.category"), F.lit("Uncategorized")).alias("category"), text.safe_name(tool).alias("tool_name"), "endpoint_name", F.coalesce(get("$.description"), F.lit("")).alias("description"), get("$.method").alias("raw_method"), "api")
