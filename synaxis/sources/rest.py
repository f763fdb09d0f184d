"""A paged REST register as a Spark data source, with a uniform request rate and bounded retries.

The transport is a plain callable, so tests and offline runs read recorded pages.
"""

from __future__ import annotations

import datetime as dt
import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from synaxis.functions.months import month_bounds

Page = dict
Fetch = Callable[[str, dict], tuple[int, dict, dict]]


class IncompletePages(RuntimeError):
    """Fewer records came than the register announced; nothing of such a month may be written."""


@dataclass
class Spacing:
    """Requests at even distances, ``per_minute`` in all; clock and sleep can be replaced."""

    per_minute: float
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    _next: float = field(default=0.0)

    def wait(self) -> None:
        now = self.clock()
        if now < self._next:
            self.sleep(self._next - now)
            now = self._next
        self._next = now + 60.0 / self.per_minute


def request(fetch: Fetch, url: str, body: dict, spacing: Spacing, retries: int = 6, sleep: Callable[[float], None] = time.sleep) -> tuple[int, dict]:
    """One answer, waiting as told or ever longer after 429 and 5xx; the last failure is raised."""
    for attempt in range(retries + 1):
        spacing.wait()
        try:
            status, headers, answer = fetch(url, body)
        except OSError:
            if attempt == retries:
                raise
            status, headers, answer = 599, {}, {}
        if status < 500 and status != 429:
            return status, answer
        if attempt < retries:
            told = headers.get("Retry-After")
            sleep(float(told) if told else min(2.0**attempt, 60.0) + random.random())
    raise RuntimeError(f"{url}: status {status} after {retries + 1} attempts")


def pages(fetch: Fetch, entity: str, body: dict, spacing: Spacing) -> Iterator[dict]:
    """All records of a search; 404 on the first page means none, later it is an error, as are missing records."""
    page, n, announced = 0, 0, None
    while True:
        status, answer = request(fetch, f"/{entity}?page={page}", body, spacing)
        if status == 404:
            if page == 0:
                return
            raise RuntimeError(f"{entity}: page {page} is gone")
        if status >= 400:
            raise RuntimeError(f"{entity}: status {status}")
        announced = answer.get("totalElements", announced)
        content = answer.get("content") or []
        n += len(content)
        yield from content
        if answer.get("last", True) or not content:
            break
        page += 1
    if announced is not None and n < announced:
        raise IncompletePages(f"{entity}: {n} of {announced} records")


# What a search for requests must state.
REQUEST_DEFAULTS = {"isInitial": True, "isApproved": False, "isApproval": False}


def http_fetch(base_url: str, headers: dict[str, str] | None = None, timeout: float = 60.0) -> Fetch:
    """A transport over HTTP: POST of a body as JSON, GET where the body is None; error statuses are answers."""

    def fetch(url: str, body: dict | None) -> tuple[int, dict, dict]:
        data = None if body is None else json.dumps(body).encode()
        head = {"Accept": "application/json", "Content-Type": "application/json"} | (headers or {})
        try:
            with urllib.request.urlopen(urllib.request.Request(base_url.rstrip("/") + url, data, head), timeout=timeout) as answer:
                content = answer.read()
                kind = answer.headers.get("Content-Type", "")
                return answer.status, dict(answer.headers), (json.loads(content) if content else {}) if "json" in kind else {"bytes": content}
        except urllib.error.HTTPError as error:
            return error.code, dict(error.headers), {}

    return fetch


def date_range(fetch: Fetch, entity: str, first: dt.date, last: dt.date, spacing: Spacing, criteria: dict | None = None, days: int = 180) -> Iterator[dict]:
    """All records of a range of days, in inclusive windows of at most ``days``."""
    if first > last:
        raise ValueError("the range ends before it begins")
    while first <= last:
        end = min(first + dt.timedelta(days=days - 1), last)
        base = REQUEST_DEFAULTS if entity == "request" else {}
        yield from pages(fetch, entity, base | (criteria or {}) | {"dateFrom": first.isoformat(), "dateTo": end.isoformat()}, spacing)
        first = end + dt.timedelta(days=1)


# Paths of the look-ups of single records.
LOOK_UPS = {"chain": "/adamChain/{key}", "pde": "/pde?pdeNumber={key}", "attachment": "/{entity}/attachment/{key}", "company": "/companies/{key}", "companies_of": "/companies?afm={key}&resultsOffset=0&resultsSize=10"}


def look_up(fetch: Fetch, what: str, key: str, spacing: Spacing, entity: str = "auction") -> dict | None:
    """One record's chain, numbers, attachment (``bytes``) or company; None where it is not known, an error for other refusals."""
    status, answer = request(fetch, LOOK_UPS[what].format(key=urllib.parse.quote(key, safe=""), entity=entity), None, spacing)
    if status == 404:
        return None
    if status >= 400:
        raise RuntimeError(f"{what} {key}: status {status}")
    return answer


def look_up_each(keys: DataFrame, column: str, what: str, transport: Callable[[], Fetch], per_minute: float, tasks: int = 4) -> DataFrame:
    """(key, found, payload): a look-up of every distinct key, in ``tasks`` tasks that share the rate.

    ``transport`` makes a task's own transport. Null keys are left out.
    """
    distinct = keys.select(F.col(column).cast("string").alias("key")).filter("key is not null").distinct().repartition(tasks, "key")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch, spacing = transport(), Spacing(per_minute / tasks)
        for batch in batches:
            answers = [look_up(fetch, what, k, spacing) for k in batch["key"]]
            yield pd.DataFrame({"key": batch["key"], "found": [a is not None for a in answers], "payload": [None if a is None else json.dumps(a, ensure_ascii=False) for a in answers]})

    return distinct.mapInPandas(run, "key string, found boolean, payload string")


class MonthPartition(InputPartition):
    def __init__(self, entity: str, month: str):
        super().__init__(month)
        self.entity, self.month = entity, month


class MonthReader(DataSourceReader):
    """Reads months over HTTP from ``url``, or recorded pages ``<path>/<entity>_<YYYY-MM>_<page>.json``.

    One partition per month; the rate is divided among them.
    """

    def __init__(self, options: dict):
        self.url, self.path, self.entity = options.get("url"), options.get("path"), options["entity"]
        if (self.url is None) == (self.path is None):
            raise ValueError("give either url or path")
        self.months = [m for m in options["months"].split(",") if m]
        self.per_minute = float(options.get("per_minute", 300)) / max(1, len(self.months))

    def partitions(self):
        return [MonthPartition(self.entity, m) for m in self.months]

    def read(self, partition: MonthPartition):
        def fetch(url: str, body: dict) -> tuple[int, dict, dict]:
            page = url.rsplit("=", 1)[1]
            try:
                with open(f"{self.path}/{partition.entity}_{partition.month}_{page}.json", encoding="utf-8") as f:
                    return 200, {}, json.load(f)
            except FileNotFoundError:
                return 404, {}, {}

        spacing = Spacing(self.per_minute)
        if self.url is not None:
            year, month = map(int, partition.month.split("-"))
            records = date_range(http_fetch(self.url), partition.entity, *month_bounds(year, month), spacing)
        else:
            records = pages(fetch, partition.entity, {"month": partition.month}, spacing)
        for record in records:
            yield (partition.entity, partition.month, json.dumps(record, ensure_ascii=False))


class RegisterSource(DataSource):
    """``spark.read.format("register")`` with options url or path, entity, months (comma-separated)."""

    @classmethod
    def name(cls) -> str:
        return "register"

    def schema(self) -> str:
        return "entity string, month string, payload string"

    def reader(self, schema) -> MonthReader:
        return MonthReader(self.options)
