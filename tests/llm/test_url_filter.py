"""The temporal list join against a scan over all entries."""

import datetime as dt
import random
from collections import Counter

from trackloom.llm.url_filter import filter_urls, list_entries


def keys(url):
    import re

    m = re.match(r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*[^/?#:@.])", url or "")
    if not m:
        return set()
    host = m[1].lower()
    parts = host.split(".")
    out = {".".join(parts[i:]) for i in range(max(1, len(parts) - 1))}
    p = re.match(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)", url)
    return out | ({f"{host}/{p[1]}"} if p else set())


def test_against_a_scan(spark):
    r = random.Random(3)
    hosts = ["a.example.com", "b.example.com", "HOT.example.net", "x.y.z.org", "localhost"]
    urls = [f"https://{r.choice(hosts)}/{r.choice(['p', 'Q', ''])}" for _ in range(150)] + ["http://hot.example.net/p"] * 100 + ["", None, "no url", "http://user@a.example.com:80/p#f", "http:///x", "http://" + "s." * 300 + "com/"]
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    caps = [(i, u, day(r.randrange(-40, 500)) if i % 40 else None, "x", True) for i, u in enumerate(urls)]
    caps.append(caps[3])
    patterns = ["example.com", "a.example.com", "hot.example.net", "hot.example.net/p", "z.org", "localhost", "unused.org"]
    entries = [(r.choice(["l1", "l2"]), r.choice(patterns), day(r.randrange(-60, 520)), r.choice(["block", "allow"])) for _ in range(80)] + [("l1", None, day(0), "block"), ("l1", "z.org", None, "block")]
    c = spark.createDataFrame(caps, "page_id long, url string, fetched date, host string, blocked boolean")
    e = spark.createDataFrame(entries, "list_name string, pattern string, day date, action string")
    want = Counter()
    for i, u, at, *_ in caps:
        active = []
        for name in ("l1", "l2"):
            for k in keys(u):
                own = [(d, a) for n, p, d, a in entries if n == name and p == k and d is not None and at is not None and d <= at]
                if own:
                    active.append((f"{name}:{k}", max(own)[1]))
        blocking = sorted(k for k, a in active if a == "block")
        want[(i, len(active), bool(blocking), ",".join(blocking))] += 1
    for days in (30, 7, 1000):
        got = filter_urls(c.repartition(3), e, period_days=days).collect()
        have = Counter((g.page_id, g.n_active, g.blocked, g.blocking) for g in got)
        assert not (have - want) and not (want - have)
    assert filter_urls(c, e.limit(0)).where("n_active > 0").count() == 0
    assert filter_urls(c.limit(0), e).count() == 0
    assert list_entries(c).where("day is null").count() == 0
