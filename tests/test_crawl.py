import json

import pytest

from tidemark.sources import crawl as C


def page(n, start=0, cursor="next", total=10_000):
    return {"status": "ok", "message": {"total-results": total, "next-cursor": cursor, "items": [{"DOI": f"10.1/{start + i}"} for i in range(n)]}}


def scripted(*pages):
    todo = list(pages)

    def fetch(window, cursor, rows):
        p = todo.pop(0)
        if isinstance(p, Exception):
            raise p
        return p

    return fetch


def run(*pages, **more):
    window = C.Window(0, "a", "b", more.pop("most", None), more.pop("frontier", 0))
    return [(n, a) for n, a, _ in C.crawl(scripted(*pages), window, more.pop("size", 10), sleep=lambda s: None, **more)]


def test_stops():
    assert run(page(10), page(3, 10)) == [(1, 10), (2, 3)]
    assert run(page(0)) == [(1, 0)]
    assert run(page(10), page(10, 10), most=13) == [(1, 10), (2, 3)]
    assert run(page(10), page(10, 10), most=20) == [(1, 10), (2, 10)]


@pytest.mark.parametrize(
    ("pages", "more", "why"),
    [
        ([page(10)] * 5, {}, "again and again"), ([page(10, cursor=" ")], {}, "without a next cursor"), ([{"status": "ok"}], {}, "invalid"), ([page(10, k * 10) for k in range(9)], {"cap": 4}, "cap"),
        ([page(10, k * 10, total=15) for k in range(9)], {}, "bound"), ([page(3)], {"frontier": 5}, "before the 5"), ([C.Retryable("x")] * 3, {}, "gave up"), ([C.Retryable("x", 61)], {}, "gave up"),
    ],
)
def test_faults(pages, more, why):
    with pytest.raises(C.CollectError, match=why):
        run(*pages, **more)


def test_retries_and_pacing():
    waits = []
    assert C.with_retries(scripted_call(C.Retryable("a"), C.Retryable("b", 7.0), {"ok": 1}), waits.append) == {"ok": 1}
    assert waits == [1.0, 7.0]
    now, slept = [0.0], []
    pacer = C.Pacer(lambda: now[0], slept.append)
    pacer.wait()
    pacer.wait()
    pacer.told(2, 5.0)
    assert slept == [0.4] and pacer.gap == 2.5
    assert C.retry_after("12", 0) == 12 and C.retry_after(None, 0) is None


def scripted_call(*results):
    todo = list(results)

    def call():
        r = todo.pop(0)
        if isinstance(r, Exception):
            raise r
        return r

    return call


def test_windows_are_partitions_of_a_data_source(spark, tmp_path):
    for w, sizes in ((0, [10, 4]), (1, [2])):
        (tmp_path / str(w)).mkdir()
        for k, n in enumerate(sizes):
            (tmp_path / str(w) / f"{k}.json").write_text(json.dumps(page(n, w * 100 + k * 10, str(k + 1))))
    paged = C.pages(spark, [C.Window(0, "a", "b", 12), C.Window(1, "b", "c")], folder=str(tmp_path), rows="10")
    got = [(r.window_id, r.page_no, r.position, r["item"]["DOI"]) for r in C.items(paged).orderBy("window_id", "page_no", "position").collect()]
    assert len(got) == 14 and got[0] == (0, 1, 0, "10.1/0") and got[11] == (0, 2, 1, "10.1/11") and got[-1] == (1, 1, 1, "10.1/101")


def test_pages_that_bring_only_stored_rows_are_idle():
    window = lambda *stored: C.Window(0, "a", "b", None, 10, list(stored))
    pages = [page(10, 10 * k) for k in range(6)] + [page(2, 60)]
    read = lambda w: [n for n, _, _ in C.crawl(scripted(*pages), w, 10, sleep=lambda s: None)]
    assert read(window((11, 30))) == [1, 2, 3, 4, 5, 6, 7]
    with pytest.raises(C.CollectError, match="without new rows"):
        read(window((11, 40)))
    w = C.Window(0, "a", "b", None, 4, [(6, 7), (9, 20)])
    have = {1, 2, 3, 4, 6, 7, *range(9, 21)}
    for a in range(25):
        for b in range(a, 25):
            assert w.new_rows(a, b) == len(set(range(a + 1, b + 1)) - have)


def test_readers_share_the_pace():
    assert C.HttpFetch("http://x", readers=5).pacer.gap == 5 * C.LEAST_GAP
    p = C.Pacer(gap=2.0)
    p.told(10, 1.0)
    assert p.gap == 2.0
    p.told(1, 8.0)
    assert p.gap == 8.0
