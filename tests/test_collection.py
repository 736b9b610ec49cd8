"""Collection from a paged source that is asked over HTTP: fields, retries, restart, limits, streams and filters."""

import json
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.plans import cli, jobs
from tidemark.plans.store import Store
from tidemark.sources import crawl as C


class Source:
    """A server of records by window start; keeps what it was asked, and can be told to answer otherwise."""

    def __init__(self, windows):
        self.windows, self.asked, self.answers, self.lock = windows, [], [], threading.Lock()
        owner = self

        class Handler(BaseHTTPRequestHandler):
            def log_message(self, *_):
                pass

            def do_GET(self):
                query = dict(urllib.parse.parse_qsl(urllib.parse.urlparse(self.path).query))
                with owner.lock:
                    owner.asked.append(query)
                    special = owner.answers.pop(0) if owner.answers else None
                if special:
                    self.send_response(special[0])
                    for k, v in special[1].items():
                        self.send_header(k, v)
                    self.end_headers()
                    return
                start = query["filter"].split(",")[0].split(":", 1)[1]
                items, rows = owner.windows[start], int(query["rows"])
                at = 0 if query["cursor"] == "*" else int(query["cursor"])
                body = json.dumps({"status": "ok", "message": {"total-results": len(items), "next-cursor": str(at + rows), "items": items[at : at + rows]}}).encode()
                self.send_response(200)
                self.end_headers()
                self.wfile.write(body)

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_address[1]}/works"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def cursors(self, start):
        return [q["cursor"] for q in self.asked if f":{start}," in q["filter"]]


def records(n, prefix, day="2026-08-08"):
    return [{"DOI": f"10.7/{prefix}{k}", "title": ["t"], "indexed": {"date-time": f"{day}T00:00:{k % 60:02d}Z"}, "created": {"date-time": f"{day}T01:00:{k % 60:02d}Z"}} for k in range(n)]


DAYS = ["2026-08-08T00:00:00Z", "2026-08-09T00:00:00Z", "2026-08-10T00:00:00Z"]
PLAN = list(zip(DAYS, DAYS[1:], strict=False))


@pytest.fixture
def source():
    s = Source({DAYS[0]: records(7, "a"), DAYS[1]: records(5, "b", "2026-08-09")})
    yield s
    s.server.shutdown()


def test_modes_ask_by_their_own_time(spark, tmp_path, source):
    common = ["--store", f"{tmp_path}/s", "--url", source.url, "--since", DAYS[0], "--until", DAYS[2]]
    assert cli.main(["BACKFILL", "--request", "b", *common]) == 0
    assert [q["filter"] for q in source.asked] == [f"from-created-date:{DAYS[0]},until-created-date:{DAYS[2]}"]
    source.asked.clear()
    assert cli.main(["INCREMENTAL", "--request", "i", *common]) == 0
    assert sorted(q["filter"] for q in source.asked) == [f"from-index-date:{a},until-index-date:{b}" for a, b in PLAN]
    store = Store(spark, f"{tmp_path}/s")
    assert store.read("target").count() == 12 and store.manifest()["facts"]["mark:default"] == DAYS[2]
    with pytest.raises(ValueError, match="the mark is at"):
        cli.main(["INCREMENTAL", "--request", "j", "--store", f"{tmp_path}/s", "--url", source.url, "--since", DAYS[1], "--until", "2026-08-11T00:00:00Z"])


def killed_after(monkeypatch, n):
    real, seen = Store._replace, []

    def fails(self, text):
        if len(seen) == n:
            raise OSError("killed")
        seen.append(text)
        real(self, text)

    monkeypatch.setattr(Store, "_replace", fails)
    return real


def test_a_killed_run_goes_on_from_its_frontier(spark, tmp_path, source, monkeypatch):
    store, request = Store(spark, f"{tmp_path}/s"), jobs.Request("r", "BACKFILL")
    plan = {"plan": PLAN, "url": source.url, "rows": "3", "pages_a_round": 1}
    real = killed_after(monkeypatch, 3)  # the request, then a page of each window twice; the third round is lost
    with pytest.raises(OSError):
        jobs.run(store, request, plan=plan)
    monkeypatch.setattr(Store, "_replace", real)
    run = jobs.Run(store, request)
    assert [w["rows"] for w in run.state()["windows"]] == [6, 5] and [w["done"] for w in run.state()["windows"]] == [False, True]
    assert run.state()["status"] == "COLLECTING" and "staging" not in store.manifest()["tables"]
    source.asked.clear()
    with pytest.raises(ValueError, match="not those that the run began with"):
        jobs.run(store, request, plan={**plan, "plan": PLAN[::-1]})
    assert jobs.run(store, request, plan=plan) == 0
    assert source.cursors(DAYS[0]) == ["*", "3", "6"] and source.cursors(DAYS[1]) == []  # begun anew, as cursors don't last
    rows = store.read("staging").orderBy("execution_sequence").collect()
    assert [r.doi for r in rows] == [x["DOI"] for x in records(7, "a") + records(5, "b")]
    facts = run.state()
    assert facts["stopped"] == "end" and facts["collected"]["new_rows"] == 12 and facts["collected"]["reported_total"] == 12


def test_a_source_that_ends_before_the_frontier_fails(spark, tmp_path, source, monkeypatch):
    store, request = Store(spark, f"{tmp_path}/s"), jobs.Request("r", "BACKFILL")
    plan = {"plan": PLAN[:1], "url": source.url, "rows": "3", "pages_a_round": 1}
    real = killed_after(monkeypatch, 3)
    with pytest.raises(OSError):
        jobs.run(store, request, plan=plan)
    monkeypatch.setattr(Store, "_replace", real)
    source.windows[DAYS[0]] = records(4, "a")
    with pytest.raises(Exception, match="before the 6 rows that are stored"):
        jobs.run(store, request, plan=plan)
    facts = jobs.Run(store, request).state()
    assert facts["stopped"] == "failed: before the" and [w["rows"] for w in facts["windows"]] == [6]


def test_one_limit_over_all_windows_stops_asking(spark, tmp_path, source):
    store, request = Store(spark, f"{tmp_path}/s"), jobs.Request("r", "BACKFILL")
    assert jobs.run(store, request, plan={"plan": PLAN, "limit": 5, "url": source.url, "rows": "3"}) == 0
    assert source.cursors(DAYS[0]) == ["*", "3"] and source.cursors(DAYS[1]) == []
    facts = jobs.Run(store, request).state()
    assert store.read("staging").count() == 5 and (facts["stopped"], facts["cap"], facts["page_bound"]) == ("limit", C.PAGE_CAP, 2)
    assert (facts["collected"]["rows"], facts["collected"]["new_rows"]) == (5, 5)


def test_a_cap_ends_a_run_with_its_reason(spark, tmp_path, source):
    store, request = Store(spark, f"{tmp_path}/s"), jobs.Request("r", "BACKFILL")
    with pytest.raises(Exception, match="page cap of 2"):
        jobs.run(store, request, plan={"plan": PLAN[:1], "url": source.url, "rows": "3", "cap": 2, "pages_a_round": 2})
    assert jobs.Run(store, request).state()["stopped"] == "failed: page cap"


def test_answers_that_are_not_pages(source):
    fetch, window = C.HttpFetch(source.url), C.Window(0, *PLAN[0])
    fetch.pacer = C.Pacer(gap=0)
    read = lambda waits: [a for _, a, _ in C.crawl(fetch, C.Window(0, *PLAN[0]), 10, sleep=waits.append)]
    for status in (404, 410):
        source.answers = [(status, {})]
        with pytest.raises(C.CollectError, match="cursor expired"):
            fetch(window, "*", 10)
    source.answers = [(400, {})]
    with pytest.raises(C.CollectError, match="status 400"):
        fetch(window, "*", 10)
    waits: list = []
    source.answers = [(429, {"Retry-After": "7"}), (503, {})]
    assert read(waits) == [7] and waits == [7.0, 2.0]
    source.answers = [(500, {})] * 3
    with pytest.raises(C.CollectError, match="gave up after 3"):
        read([])
    source.answers = [(429, {"Retry-After": "61"})]
    with pytest.raises(C.CollectError, match="gave up after 1"):
        read([])
    source.server.shutdown()
    source.server.server_close()
    with pytest.raises(C.Retryable):
        fetch(window, "*", 10)


def test_progress_goes_on_in_pieces(source):
    window, pages = C.Window(0, *PLAN[0]), []
    fetch = C.HttpFetch(source.url)
    fetch.pacer = C.Pacer(gap=0)
    whole = [(n, a) for n, a, _ in C.crawl(fetch, C.Window(0, *PLAN[0]), 3)]
    for _ in range(5):
        part = C.Window(0, *PLAN[0], progress=json.loads(json.dumps(vars(window.progress))), most_pages=1)
        pages += [(n, a) for n, a, _ in C.crawl(fetch, part, 3)]
        window = part
    assert pages == whole == [(1, 3), (2, 3), (3, 1)] and window.progress.done


def test_a_stream_asks_for_no_page_beyond_its_limit(spark, tmp_path, source):
    def read(limit, name):
        stream = C.page_stream(spark, [C.Window(k, a, b) for k, (a, b) in enumerate(PLAN)], limit, url=source.url, rows="3")
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/{name}").option("checkpointLocation", f"{tmp_path}/cp-{name}").start()
        query.processAllAvailable()
        query.stop()
        return sorted((r.window_id, r.page_no, r.accepted) for r in spark.read.parquet(f"{tmp_path}/{name}").collect())

    assert read(8, "a") == [(0, 1, 3), (0, 2, 3), (0, 3, 1), (1, 1, 1)]
    assert source.cursors(DAYS[0]) == ["*", "3", "6"] and source.cursors(DAYS[1]) == ["*"]
    source.asked.clear()
    assert read(8, "a") == [(0, 1, 3), (0, 2, 3), (0, 3, 1), (1, 1, 1)] and not [q for q in source.asked if q["cursor"] != "*" and f":{DAYS[1]}," in q["filter"]]
    assert sum(a for *_, a in read(None, "b")) == 12


def test_a_range_in_a_filter_becomes_windows_and_a_field(spark, source):
    spark.dataSource.register(C.PagedItems)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    load = lambda: spark.read.format("paged_items").options(url=source.url).load()
    got = load().where("indexed_at >= timestamp'2026-08-08 00:00:00' and indexed_at < timestamp'2026-08-10 00:00:00'")
    assert got.count() == 12
    assert {q["filter"] for q in source.asked} == {f"from-index-date:{a},until-index-date:{b}" for a, b in PLAN}
    source.asked.clear()
    got = load().where("created_at between timestamp'2026-08-08 00:00:00' and timestamp'2026-08-08 01:00:03'").select("item", "created_at")
    assert sorted(json.loads(r["item"])["DOI"] for r in got.collect()) == [f"10.7/a{k}" for k in range(4)]
    assert {q["filter"] for q in source.asked} == {f"from-created-date:{DAYS[0]},until-created-date:2026-08-08T01:00:03Z"}
    with pytest.raises(Exception, match="needs a range"):
        load().where("indexed_at >= timestamp'2026-08-08 00:00:00'").count()


def test_an_instant_ends_with_its_text(spark):
    rows = spark.createDataFrame([("2026-08-08T00:00:00Z",), ("2026-08-08T00:00:00Z\n",), ("x2026-08-08T00:00:00Z",)], "t string")
    assert [r[0] is not None for r in rows.select(T.instant(F.col("t"))).collect()] == [True, False, False]
