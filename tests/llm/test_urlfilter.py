import random
from datetime import datetime, timedelta

from eventlake.llm import urlfilter

DAY0 = datetime(2024, 1, 1)
ENTRIES = "list string, kind string, pattern string, action string, at timestamp"
CAPTURES = "page_id bigint, url string, fetched_at timestamp"


def t(days, hours=0, micros=0):
    return DAY0 + timedelta(days=days, hours=hours, microseconds=micros)


def matches(entry, host, path, query):
    _, kind, pattern, _, _ = entry
    if kind == "host":
        return host == pattern
    if kind == "domain":
        return host == pattern or host.endswith("." + pattern)
    if kind == "prefix":
        return pattern.endswith("/") and (host + path).startswith(pattern)
    return kind == "url" and host + path + query == pattern


def active(entries, host, path, query, when):
    lists = {}
    for e in entries:
        if None in e or e[3] not in ("add", "remove") or e[4] > when or not matches(e, host, path, query):
            continue
        key = e[:3]
        lists[key] = max(lists.get(key, (DAY0 - timedelta(days=999), 0)), (e[4], e[3] == "remove"))
    return sorted({k[0] for k, v in lists.items() if not v[1]})


def test_against_brute_force(spark):
    rng = random.Random(8)
    hosts = ["a.example.com", "b.example.com", "example.com", "x.y.example.org"]
    paths = ["/", "/en/", "/en/page", "/en/sub/page", ""]
    entries = []
    for _ in range(150):
        host = rng.choice(hosts)
        kind = rng.choice(["host", "domain", "prefix", "url"])
        pattern = {"host": host, "domain": rng.choice([host, host.split(".", 1)[1]]), "prefix": host + rng.choice(["/", "/en/", "/en/sub/"]), "url": host + rng.choice(paths)}[kind]
        entries.append((rng.choice(["spam", "trusted"]), kind, pattern, rng.choice(["add", "add", "remove"]), t(rng.randrange(20), rng.choice([0, 0, 6]))))
    entries += [("spam", "regex", "a", "add", t(0)), ("spam", "host", None, "add", t(0)), (None, "host", "example.com", "add", t(0)), ("spam", "host", "example.com", "add", None)]
    captures, parts = [], []
    for i in range(300):
        host, path, query = rng.choice(hosts), rng.choice(paths), rng.choice(["", "", "?q=1"])
        captures.append((i, f"https://user@{host.upper()}.:8080{path}{query}#top" if i % 7 == 0 else f"http://{host}{path}{query}", t(rng.randrange(22), rng.choice([0, 3, 6, 12]))))
        parts.append((host, path, query))
    out = urlfilter.judge(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)).collect()
    got = {r.capture.page_id: (r.lists, r.blocked) for r in out}
    for (i, _, when), own in zip(captures, parts):
        lists = active(entries, *own, when)
        assert got[i] == (lists, bool(lists) and "trusted" not in lists), (captures[i], lists)


def test_borders_and_hard_rows(spark):
    entries = [("spam", "host", "h.com", "add", t(1, 5)), ("spam", "host", "h.com", "remove", t(3)), ("spam", "host", "h.com", "add", t(3)), ("spam", "host", "h.com", "add", t(4, 0, 1))]
    times = [t(1, 5, -1), t(1, 5), t(2), t(2, 23), t(3, 0, -1), t(3), t(4), t(4, 0, 1), t(400), None]
    captures = [(i, "http://h.com/x", w) for i, w in enumerate(times)] + [(20, None, t(2)), (21, "no url", t(2)), (22, "http://", t(2)), (2, "http://h.com/x", t(2))]
    frame = spark.createDataFrame(captures, CAPTURES).selectExpr("*", "'mine' AS lists", "'mine' AS blocked")
    out = urlfilter.judge(frame, spark.createDataFrame(entries, ENTRIES)).collect()
    assert len(out) == len(captures) and all(r.capture.lists == "mine" for r in out)
    assert {r.capture.page_id for r in out if r.blocked} == {1, 2, 3, 4, 7, 8}


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], ENTRIES), spark.createDataFrame([(1, "http://h.com/", t(1))], CAPTURES)
    assert [r.blocked for r in urlfilter.judge(some, none).collect()] == [False]
    assert urlfilter.judge(spark.createDataFrame([], CAPTURES), none).count() == 0


def test_entries_are_normalised(spark):
    entries = [
        ("l", "host", "Example.COM", "add", t(0)), ("l", "domain", "other.com.", "add", t(0)), ("l", "prefix", "Third.com/en", "add", t(0)),
        ("l", "url", "https://user@Fourth.com:8080/A?b=1", "add", t(0)), ("l", "host", "", "add", t(0)), ("l", "prefix", "/en/", "add", t(0)),
    ]
    urls = {
        "http://example.com/x": True, "http://www.example.com/": False, "http://a.other.com/": True, "http://third.com/en/page": True,
        "http://third.com/english": False, "http://fourth.com/A?b=1": True, "http://fourth.com/a?b=1": False, "http:///en/": False,
        "http://long.com/" + "a/" * 3_000: False,
    }
    captures = spark.createDataFrame([(i, u, t(1)) for i, u in enumerate(urls)], CAPTURES)
    rows = urlfilter.judge(captures, spark.createDataFrame(entries, ENTRIES)).collect()
    assert {r.capture.url: r.blocked for r in rows} == urls
