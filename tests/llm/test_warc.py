import random

import pytest

from riskwindow.llm import warc

SCHEMA = (
    "record_id long, url string, ts long, kind string, headers map<string,string>, body string, page string, outcome string"
)


@pytest.fixture
def records(spark):
    return lambda rows: spark.createDataFrame([(*r, "p", "o") for r in rows], SCHEMA)


def resolved(frame):
    return {(r.record_id, r.ts): r for r in warc.resolve(frame).collect()}


def test_canonical_urls(spark):
    urls = {
        "HTTP://www.Example.COM:80/a/b/?b=2&utm_source=x&a=1#top": "example.com/a/b?a=1&b=2",
        "https://example.com/a/b?a=1&b=2": "example.com/a/b?a=1&b=2",
        "example.com/": "example.com",
        "https://user:pw@m.example.com:8080/X?ref=q": "m.example.com:8080/X",
        "": "",
    }
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url: r.page for r in frame.selectExpr("url", f"{warc._CANONICAL} AS page").collect()} == urls


def test_outcomes_and_merged_headers(records):
    page, other = "http://www.a.org/x/", "https://a.org/x#here"
    full = {"ETag": '"1"', "Content-Length": "4", "Date": "old", "Last-Modified": "m1"}
    rows = [
        (1, page, 10, "response", full, "body"),
        (2, other, 20, "response", {"ETag": '"2"', "Last-Modified": "m2"}, "newer"),
        (3, other, 15, "revisit", {"etag": 'W/"1"', "date": "now", "content-length": "0", "Server": "s"}, None),
        (4, page, 20, "revisit", {"last-modified": "m1"}, None),
        (5, page, 25, "revisit", {"ETAG": '"1"'}, None),
        (6, page, 25, "revisit", {}, None),
        (7, page, 10, "revisit", {"etag": '"1"'}, None),
        (8, "http://b.org", 99, "revisit", {"etag": '"1"'}, None),
        (9, None, 30, "revisit", None, None),
        (10, page, None, "revisit", {"etag": '"2"'}, None),
        (11, page, None, "response", full, "when"),
        (12, page, 30, "request", None, None),
    ]
    found = resolved(records(rows))
    assert {k[0]: r.outcome for k, r in found.items()} == {
        3: "resolved", 4: "resolved", 5: "changed", 6: "unverified", 7: "no response", 8: "no response",
        9: "no response", 10: "no response",
    }
    assert (found[3, 15].response_id, found[3, 15].body) == (1, "body")
    assert found[3, 15].headers == {"etag": 'W/"1"', "content-length": "4", "date": "now", "last-modified": "m1"}
    assert found[5, 25].body is None and found[5, 25].headers is None


def test_ties_and_repeated_rows(records):
    tag = {"ETag": '"t"'}
    rows = [
        (1, "a.org", 5, "response", tag, "one"), (2, "a.org", 5, "response", tag, "two"), (2, "a.org", 5, "response", tag, "two"),
        (3, "a.org", 9, "revisit", tag, None), (3, "a.org", 9, "revisit", tag, None),
    ]
    found = warc.resolve(records(rows)).collect()
    assert [(r.response_id, r.body) for r in found] == [(2, "two")] * 2


def test_equals_brute_force_over_many_slices(records, monkeypatch):
    monkeypatch.setattr(warc, "SLICE", 7)
    draw = random.Random(4)
    rows = []
    for i in range(400):
        url = "hot.org" if i % 3 else f"u{draw.randrange(5)}.org"
        kind = draw.choice(["response", "revisit"])
        rows.append((i, url, draw.randrange(120), kind, {"ETag": f'"{draw.randrange(2)}"'}, f"b{i}" if kind == "response" else None))
    expected = {}
    for i, url, ts, kind, headers, _ in rows:
        if kind == "revisit":
            before = [r for r in rows if r[3] == "response" and r[1] == url and r[2] < ts]
            best = max(before, key=lambda r: (r[2], r[0]), default=None)
            same = best and best[4]["ETag"] == headers["ETag"]
            expected[i] = ("no response", None) if not best else ("resolved", best[0]) if same else ("changed", None)
    found = warc.resolve(records(rows)).collect()
    assert {r.record_id: (r.outcome, r.response_id) for r in found} == expected


def test_no_rows(records):
    assert warc.resolve(records([])).count() == 0


def test_slices_hold_few_records_beside_stray_times(spark, monkeypatch):
    monkeypatch.setattr(warc, "SLICE", 100)
    times = [0, 10**15, *range(1_700_000_000, 1_700_002_000)]
    events = spark.createDataFrame([("p", t, t % 3 == 0) for t in times], "page string, ts long, is_response boolean")
    sliced = warc._sliced(events).collect()
    sizes = {}
    for r in sliced:
        sizes[r.slice] = sizes.get(r.slice, 0) + 1
    assert max(sizes.values()) <= 150
    by_time = [r.slice for r in sorted(sliced, key=lambda r: r.ts)]
    assert by_time == sorted(by_time)
    found = {r.ts: r.found for r in warc._latest(events).collect()}
    responses = [t for t in sorted(times) if t % 3 == 0]
    assert found == {t: max((x for x in responses if x < t), default=None) for t in times if t % 3}


def test_slices_of_large_tables_are_cut_again(spark, monkeypatch):
    monkeypatch.setattr(warc, "SLICE", 100)
    monkeypatch.setattr(warc, "MOST", 4)
    draw = random.Random(9)
    times = [0, 0, 10**15, *[draw.randrange(10**6) for _ in range(1400)]]
    events = spark.createDataFrame([("p", t, i % 3 == 0) for i, t in enumerate(times)], "page string, ts long, is_response boolean")
    sizes = {}
    for r in (sliced := warc._sliced(events).collect()):
        sizes[r.slice] = sizes.get(r.slice, 0) + 1
    assert len(sizes) >= 14 and max(sizes.values()) <= 180 and sum(sizes.values()) == len(times)
    by_time = [r.slice for r in sorted(sliced, key=lambda r: r.ts)]
    assert by_time == sorted(by_time)
    responses = {t for i, t in enumerate(times) if i % 3 == 0}
    found = {r.ts: r.found for r in warc._latest(events.distinct()).collect()}
    assert found == {
        t: max((x for x in responses if x < t), default=None) for t in {t for i, t in enumerate(times) if i % 3}
    }
