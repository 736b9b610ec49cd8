"""A cursor-paged source as a Spark data source: each window is a partition, read page by page with guards.

The transport is a callable (window, cursor, rows) -> page; one reads a folder of page files, one asks an HTTP API.
Clock and sleep are arguments, so that pacing and retries can be tested without waiting.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime, timedelta
from email.utils import parsedate_to_datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, SimpleDataSourceStreamReader

from ..schema import ITEM, PAGE, PAGE_CAP, PAGE_SIZE

ATTEMPTS, MOST_WAIT, LEAST_GAP, REPEATS, IDLE = 3, 60.0, 0.4, 3, 3


class Retryable(Exception):
    """Asked to come again, after so many seconds if the source says so."""

    def __init__(self, why: str, after: float | None = None):
        super().__init__(why)
        self.after = after


class CollectError(Exception):
    """The window can't be collected."""


@dataclass
class Progress:
    """How far a window has been read: what goes on from here needs no more than this."""

    cursor: str = "*"
    pages: int = 0
    advanced: int = 0
    taken: int = 0
    total: int = 0
    repeats: int = 0
    idle: int = 0
    last: str = ""
    done: bool = False


@dataclass
class Window:
    """Half-open range, its most items (None: all), how many rows are stored already from its beginning, and ranges of later ones.

    stored holds pairs (first, last) of places, from 1, beyond the frontier; a page that brings only such rows is idle.
    progress is where reading goes on, and most_pages how many pages are read from there (None: all).
    """

    window_id: int
    start: str
    end: str
    max_items: int | None = None
    frontier: int = 0
    stored: list[tuple[int, int]] = field(default_factory=list)
    progress: Progress = field(default_factory=Progress)
    most_pages: int | None = None

    def __post_init__(self):
        if isinstance(self.progress, dict):
            self.progress = Progress(**self.progress)

    def new_rows(self, before: int, after: int) -> int:
        """How many of the places after `before` up to `after` aren't stored."""
        first = max(before, self.frontier) + 1
        return max(0, after - first + 1) - sum(max(0, min(b, after) - max(a, first) + 1) for a, b in self.stored)


def retry_after(header: str | None, now: float) -> float | None:
    """Seconds of a Retry-After header, a number or a date."""
    if not header:
        return None
    if header.strip().isdigit():
        return float(header)
    return max(0.0, parsedate_to_datetime(header).timestamp() - now)


def with_retries(call: Callable[[], dict], sleep: Callable[[float], None] = time.sleep, attempts: int = ATTEMPTS) -> dict:
    """Tries again after as many seconds as attempts made, or as the source says; a longer wait than MOST_WAIT fails."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except Retryable as again:
            wait = float(attempt) if again.after is None else again.after
            if attempt == attempts or wait > MOST_WAIT:
                raise CollectError(f"gave up after {attempt} attempts: {again}") from again
            sleep(wait)
    raise AssertionError


class Pacer:
    """Keeps a least gap between calls, or interval / limit where the source names them."""

    def __init__(self, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, gap: float = LEAST_GAP):
        self.clock, self.sleep, self.gap, self.least, self.next = clock, sleep, gap, gap, float("-inf")

    def wait(self) -> None:
        if (left := self.next - self.clock()) > 0:
            self.sleep(left)
        self.next = self.clock() + self.gap

    def told(self, limit: int | None, interval: float | None) -> None:
        if limit and interval:
            self.gap = max(self.least, interval / limit)


def valid(page: dict) -> bool:
    message = page.get("message")
    return page.get("status") == "ok" and isinstance(message, dict) and message.get("items") is not None and (message.get("total-results") or 0) >= 0


def page_bound(remaining: int | None, total: int, size: int) -> int:
    return -(-remaining // size) if remaining is not None and remaining <= total else total // size + 1


def crawl(fetch: Callable[[Window, str, int], dict], window: Window, size: int = PAGE_SIZE, cap: int = PAGE_CAP, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple[int, int, dict]]:
    """Yields (page number, rows taken from it, page) until a short page, the window's limit or most_pages.

    Fails on an invalid page, a full page without a next cursor (before it is yielded), more pages than the bound or
    the cap, the same full page over and over, pages beyond the frontier that bring nothing, and an end before it. The
    window's progress is brought on before each page is yielded.
    """
    now, left = window.progress, window.most_pages
    while not now.done and left != 0 and (window.max_items is None or now.taken < window.max_items):
        if now.pages >= cap:
            raise CollectError(f"page cap of {cap} reached")
        page = with_retries(lambda: fetch(window, now.cursor, size), sleep)
        now.pages += 1
        if not valid(page):
            raise CollectError("invalid page")
        message = page["message"]
        items = message["items"]
        if now.pages == 1:
            now.total = message.get("total-results") or 0
        bound, full = page_bound(window.max_items, now.total, size), len(items) >= size
        if full and not (message.get("next-cursor") or "").strip():
            raise CollectError("full page without a next cursor")
        mark = hashlib.sha256(json.dumps(items, sort_keys=True).encode()).hexdigest() if full else ""
        if full and mark == now.last:
            now.repeats += 1
            if now.repeats >= REPEATS:
                raise CollectError("the same page again and again")
            continue
        now.repeats, now.last = 0, mark
        if now.advanced >= bound and items:
            raise CollectError(f"more pages than the bound of {bound}")
        now.advanced += 1
        accepted = len(items) if window.max_items is None else min(len(items), window.max_items - now.taken)
        now.taken += accepted
        now.idle = now.idle + 1 if now.taken > window.frontier and window.new_rows(now.taken - accepted, now.taken) == 0 else 0
        if now.idle >= IDLE:
            raise CollectError("pages without new rows")
        now.done = not full or now.taken == window.max_items
        if full:
            now.cursor = message["next-cursor"]
        if now.done and now.taken < window.frontier:
            raise CollectError(f"ended at {now.taken}, before the {window.frontier} rows that are stored")
        left = None if left is None else left - 1
        yield now.pages, accepted, page


class FolderFetch:
    """Pages of a window from <folder>/<window_id>/<n>.json; the cursor is the number of the next file."""

    def __init__(self, folder: str):
        self.folder = folder

    def __call__(self, window: Window, cursor: str, rows: int) -> dict:
        path = Path(self.folder, str(window.window_id), f"{0 if cursor == '*' else int(cursor)}.json")
        return json.loads(path.read_text()) if path.exists() else {"status": "ok", "message": {"items": [], "total-results": 0}}


class HttpFetch:
    """Pages from an HTTP API with cursor and rows parameters; filters go in the request."""

    def __init__(self, base: str, field: str = "index-date", readers: int = 1):
        """readers: how many tasks may ask at the same time; each waits so much longer, so that together they keep the pace."""
        self.base, self.field, self.readers, self.pacer = base, field, readers, Pacer(gap=LEAST_GAP * readers)

    def url(self, window: Window, cursor: str, rows: int) -> str:
        query = {"filter": f"from-{self.field}:{window.start},until-{self.field}:{window.end}", "cursor": cursor, "rows": rows}
        return f"{self.base}?{urllib.parse.urlencode(query)}"

    def __call__(self, window: Window, cursor: str, rows: int) -> dict:
        self.pacer.wait()
        try:
            with urllib.request.urlopen(self.url(window, cursor, rows), timeout=60) as answer:
                limit, interval = answer.headers.get("X-Rate-Limit-Limit"), answer.headers.get("X-Rate-Limit-Interval")
                self.pacer.told(int(limit) if limit and limit.isdigit() else None, self.readers * float(interval.rstrip("s")) if interval and interval.endswith("s") and interval[:-1].isdigit() else None)
                return json.loads(answer.read())
        except urllib.error.HTTPError as error:
            if error.code in (404, 410):
                raise CollectError("cursor expired") from error
            if error.code in (408, 429) or error.code >= 500:
                raise Retryable(f"status {error.code}", retry_after(error.headers.get("Retry-After"), time.time())) from error
            raise CollectError(f"status {error.code}") from error
        except (urllib.error.URLError, TimeoutError) as error:
            raise Retryable(str(error)) from error


@dataclass
class _Part(InputPartition):
    window: Window | None
    field: str = ""
    readers: int = 1


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.windows = [Window(**w) for w in json.loads(options["windows"])]
        unknown = set(options) - {"windows", "folder", "url", "field", "rows", "cap", "path", "limit"}
        if unknown:
            raise ValueError(f"unknown options: {sorted(unknown)}")

    def partitions(self):
        return [_Part(w) for w in self.windows]

    def read(self, part: _Part):
        yield from page_rows(part.window, self.options, len(self.windows))


def fetcher(options: dict, readers: int = 1) -> Callable[[Window, str, int], dict]:
    return FolderFetch(options["folder"]) if "folder" in options else HttpFetch(options["url"], options.get("field", "index-date"), readers)


def page_rows(window: Window, options: dict, readers: int = 1, fetch: Callable | None = None) -> Iterator[tuple]:
    """Rows of PAGES for the pages of a window, from where its progress stands."""
    for number, accepted, page in crawl(fetch or fetcher(options, readers), window, int(options.get("rows", PAGE_SIZE)), int(options.get("cap", PAGE_CAP))):
        yield window.window_id, number, accepted, json.dumps(page, ensure_ascii=False), window.progress.taken - accepted, window.frontier, json.dumps(asdict(window.progress))


#: before: rows of the window before the page; known: how many of its first rows were stored when it was read; progress: after it.
PAGES = "window_id bigint, page_no bigint, accepted bigint, page string, before bigint, known bigint, progress string"


class _Stream(SimpleDataSourceStreamReader):
    """Window after window, a page at a time; the offset is the window's number, its progress and the rows of those before."""

    def __init__(self, options: dict):
        self.windows = [Window(**w) for w in json.loads(options["windows"])]
        self.options, self.limit = options, int(options["limit"]) if options.get("limit") else None
        self.fetch = fetcher(options)

    def initialOffset(self) -> dict:
        return {"window": 0, "rows": 0, "progress": json.dumps(asdict(Progress()))}

    def _next(self, at: dict) -> tuple[list[tuple], dict]:
        k, rows, now = at["window"], at["rows"], Progress(**json.loads(at["progress"]))
        while k < len(self.windows) and (self.limit is None or rows + now.taken < self.limit):
            if not now.done:
                window = Window(**{**vars(self.windows[k]), "progress": now, "most_pages": 1, "max_items": None if self.limit is None else self.limit - rows})
                return list(page_rows(window, self.options, fetch=self.fetch)), {"window": k, "rows": rows, "progress": json.dumps(asdict(now))}
            k, rows, now = k + 1, rows + now.taken, Progress()
        return [], at

    def read(self, start: dict):
        found, end = self._next(start)
        return iter(found), end

    def readBetweenOffsets(self, start: dict, end: dict):
        while start != end:
            found, start = self._next(start)
            if not found:
                raise CollectError("the source ends before the pages that were read of it")
            yield from found


class PagedRecords(DataSource):
    """Format `paged_records`: one row for each page of each window; a batch reads windows as partitions, a stream one after another."""

    @classmethod
    def name(cls) -> str:
        return "paged_records"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Stream(dict(self.options))


class _ItemReader(DataSourceReader):
    """Turns a range of one of the two times into day windows and the request's field; Spark still looks at each row."""

    #: The request's field for each column.
    FIELDS = {"indexed_at": "index-date", "created_at": "created-date"}

    def __init__(self, options: dict):
        self.options, self.bounds = options, {}

    def pushFilters(self, filters):
        for f in filters:
            column = getattr(f, "attribute", ("",))[0]
            if column in self.FIELDS and isinstance(getattr(f, "value", None), datetime):
                low, high = self.bounds.get(column, (None, None))
                at = f.value.astimezone(UTC).replace(tzinfo=None) if f.value.tzinfo else f.value
                if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                    low = at if low is None else max(low, at)
                if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                    end = at if isinstance(f, LessThan) else at + timedelta(microseconds=1)
                    high = end if high is None else min(high, end)
                self.bounds[column] = (low, high)
            yield f

    def partitions(self):
        whole = [c for c in self.FIELDS if None not in self.bounds.get(c, (None, None))]
        if not whole:
            raise ValueError("a read needs a range of indexed_at or created_at, with both ends")
        at, end = self.bounds[whole[0]]
        days, text = [], lambda t: t.strftime("%Y-%m-%dT%H:%M:%SZ")
        while at < end:
            day = min(datetime(at.year, at.month, at.day) + timedelta(days=1), end)
            days.append((text(at), text(day)))
            at = day
        return [_Part(Window(k, *day), self.FIELDS[whole[0]], len(days)) for k, day in enumerate(days)] or [_Part(None)]

    def read(self, part: _Part):
        if part.window is None:
            return
        stamp = lambda item, name: (t := (item.get(name) or {}).get("date-time")) and datetime.fromisoformat(t)
        options = {**self.options, "field": part.field}
        for number, accepted, page in crawl(fetcher(options, part.readers), part.window, int(options.get("rows", PAGE_SIZE)), int(options.get("cap", PAGE_CAP))):
            for k, item in enumerate(page["message"]["items"][:accepted]):
                yield part.window.window_id, number, k, stamp(item, "indexed"), stamp(item, "created"), json.dumps(item, ensure_ascii=False)


class PagedItems(DataSource):
    """Format `paged_items`: a row for each record. What is asked for follows from the filters on indexed_at or created_at.

    Needs spark.sql.python.filterPushdown.enabled; a read without a range is an error. Days are asked for whole where a
    source knows only days, so the filters stay in the plan.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_items"

    def schema(self) -> str:
        return "window_id bigint, page_no bigint, position int, indexed_at timestamp, created_at timestamp, item string"

    def reader(self, schema) -> DataSourceReader:
        return _ItemReader(dict(self.options))


def _windows(windows: list[Window]) -> str:
    return json.dumps([asdict(w) for w in windows])


def raw_pages(spark: SparkSession, windows: list[Window], **options: str) -> DataFrame:
    """Rows of PAGES of windows, their pages as text."""
    spark.dataSource.register(PagedRecords)
    return spark.read.format("paged_records").options(windows=_windows(windows), **options).load()


def pages(spark: SparkSession, windows: list[Window], **options: str) -> DataFrame:
    """The pages of windows, decoded; unknown fields are dropped."""
    return raw_pages(spark, windows, **options).withColumn("page", F.from_json("page", PAGE))


def page_stream(spark: SparkSession, windows: list[Window], limit: int | None = None, **options: str) -> DataFrame:
    """The pages of windows as a stream that ends asking once `limit` rows are read, over all windows. It reads in one process, a page a batch."""
    spark.dataSource.register(PagedRecords)
    return spark.readStream.format("paged_records").options(windows=_windows(windows), **({"limit": str(limit)} if limit is not None else {}), **options).load()


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """Pages that lie in files already, one JSON document each."""
    return spark.read.schema(PAGE).option("multiLine", True).json(path)


def numbered_files(spark: SparkSession, path: str) -> DataFrame:
    """Page files of one window as pages(window_id, page_no, accepted, page), by the last number in their names.

    A file that isn't a page, by its status, items or total, fails the reading; so does a name without a number.
    """
    read = page_files(spark, path).withColumn("page_no", F.nullif(F.regexp_extract(F.input_file_name(), r"(\d+)\D*$", 1), F.lit("")).cast("bigint"))
    good = (F.col("status") == "ok") & F.col("message.items").isNotNull() & (F.coalesce("message.total-results", F.lit(0)) >= 0) & F.col("page_no").isNotNull()
    page = F.struct(*[f.name for f in PAGE])
    return read.where(F.assert_true(F.coalesce(good, F.lit(False)), F.concat(F.lit("not a page: "), F.input_file_name())).isNull()).select(F.lit(0).cast("bigint").alias("window_id"), "page_no", F.size("message.items").cast("bigint").alias("accepted"), page.alias("page"))


def page_log(paged: DataFrame) -> DataFrame:
    """window_id, page_no, items, new_rows and total_results of pages; rows that were stored when a page was read again aren't new."""
    new = F.least(F.col("accepted"), F.greatest(F.col("before") + F.col("accepted") - F.col("known"), F.lit(0))) if "known" in paged.columns else F.col("accepted")
    return paged.select("window_id", "page_no", F.col("accepted").alias("items"), new.alias("new_rows"), F.coalesce("page.message.total-results", F.lit(0)).alias("total_results"))


def planned(plan: list[tuple[str, str]], limit: int | None = None) -> list[Window]:
    """Windows of planned ranges, each of which may read up to the run's limit; see collect.limited for the run's own."""
    return [Window(k, start, end, limit) for k, (start, end) in enumerate(plan)]


def items(paged: DataFrame) -> DataFrame:
    """One row for each accepted record that wasn't stored before, with its window, page and place."""
    out = paged.select("window_id", "page_no", "accepted", *(c for c in ("before", "known") if c in paged.columns), F.posexplode("page.message.items").alias("position", "item")).where(F.col("position") < F.col("accepted"))
    if "known" in out.columns:
        out = out.where(F.col("before") + F.col("position") >= F.col("known"))
    return out.drop("accepted", "before", "known")


__all__ = ["ITEM", "CollectError", "FolderFetch", "HttpFetch", "Pacer", "PagedRecords", "Retryable", "Window", "crawl", "items", "page_files", "pages", "retry_after", "with_retries"]
