"""URL filters against a walk over all events."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from shelfwise.llm.url_filter import filter_urls, validity_intervals

START = datetime(2024, 1, 1)


def day(n):
    return START + timedelta(days=n)


def active(events, name, pattern, t):
    """Time since which the entry stands at t, or None."""
    per = {}
    for l, p, a, at in events:
        if None not in (l, p, at) and (l, p) == (name, pattern) and a in ("add", "remove") and at <= t:
            per[at] = min(a, per.get(at, a))
    since = None
    for at in sorted(per):
        since = (since or at) if per[at] == "add" else None
    return since


@pytest.mark.parametrize("slot_days", [1, 30, 400])
def test_filter(spark, slot_days):
    rng = random.Random(slot_days)
    patterns = ["a.org", "b.a.org", "org", "c.net", "c.net/x", "c.net/x/y", "a.org/en"]
    events = [(rng.choice(["l1", "l2"]), rng.choice(patterns), rng.choice(["add", "add", "remove"]), day(rng.randint(0, 60)))
              for _ in range(80)]
    events += [(None, "a.org", "add", day(1)), ("l1", None, "add", day(1)), ("l1", "a.org", "add", None),
               ("l1", "a.org", "other", day(2)), events[0], events[0]]
    urls = ["http://a.org/", "https://B.A.org:8080/en/1?q=1", "http://u:p@c.net/x/y/z", "http://c.net", "http://c.net/xy",
            "ftp://nota.org/x", "http://a.org./en", "no url", "", None, "http://c.net/X//y#f", "http://ba.org/" + "s/" * 500]
    rows = [(i, rng.choice(urls), rng.choice([day(rng.randint(0, 80)) + timedelta(hours=rng.randint(0, 23)), None if i % 9 else day(3)]))
            for i in range(300)]
    rows += [(None, "http://a.org", day(9)), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, fetched_at timestamp")
    ev = spark.createDataFrame(events, "list string, pattern string, action string, at timestamp")
    want = Counter()
    for i, u, t in set(rows):
        host, path = "", []
        if u and "://" in u:
            rest = u.split("://", 1)[1].split("#")[0].split("?")[0]
            authority, _, p = rest.partition("/")
            host = authority.rpartition("@")[2].split(":")[0].lower().rstrip(".")
            path = [s for s in p.split("/") if s]
        keys = {".".join(host.split(".")[k:]) for k in range(len(host.split(".")))}
        keys |= {(host + "/" + "/".join(path[:k])).lower() for k in range(1, len(path) + 1)}
        hits = [(l, p, s) for l in ("l1", "l2") for p in patterns if p in keys and t is not None
                for s in [active(events, l, p, t)] if s]
        best = min(((-len(p), p, s) for _, p, s in hits), default=(0, None, None))
        want[(i, u, t, host, len(hits), bool(hits), ",".join(sorted({h[0] for h in hits})), best[1], best[2])] += 1
    got = Counter(tuple(r) for r in filter_urls(df, ev, slot_days=slot_days).collect())
    assert got == want and sum(k[5] for k in want) > 40


def test_empty(spark):
    df = spark.createDataFrame([(1, "http://a.org", day(1))], "page_id long, url string, fetched_at timestamp")
    ev = spark.createDataFrame([], "list string, pattern string, action string, at timestamp")
    assert [(r["blocked"], r["lists"]) for r in filter_urls(df, ev).collect()] == [(False, "")]
    some = spark.createDataFrame([("l", "a.org", "add", day(0)), ("l", "a.org", "remove", day(1))], ev.schema)
    assert filter_urls(df.limit(0), some).count() == 0
    assert [(r["valid_from"], r["valid_to"]) for r in validity_intervals(some).collect()] == [(day(0), day(1))]
    assert not filter_urls(df, some).first()["blocked"]  # the end is not part of the interval
