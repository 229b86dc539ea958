import random
import tracemalloc

import numpy as np
import pytest

from brinefold.llm import url_filter
from brinefold.llm.queries import URL_RULES


def brute(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n]), rest[n:]
        m = next((i for i, c in enumerate(tail) if c in "?#"), len(tail))
        path = tail[:m]
    fit = [(len((h + p).encode()), len(h.encode()), a == "block", h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[3], max(fit)[4]) if fit else (host, path, None, default)


URLS = [
    None, "", "x", "://", "http://", "http://net", "http://net/", "http://NET/", "http://a.net/x?y#z", "http://anet/", "http://example.net/en/1", "http://www.Example.NET/en/", "http://example.net/en", "http://example.net/EN/",
    "http://example.com/de/", "http://m.example.com/de/1", "http://example.com/den", "https://org/fr/", "https://a.b.org/fr/x?fr", "https://org?x/fr/", "https://org#/fr/", "http://u@x.net:80/", "http://x.net:80/", "a://b://net/", "http://ÉX.net/é", "http://.net/",
    "http://net\n/x", "http://x.net/" + "a" * 100_000,
]


def filter_file(tmp_path, content, **more):
    path = tmp_path / "rules.bin"
    path.write_bytes(content)
    return url_filter.DigestArray(str(path), **more)


def test_fixed_rules(tmp_path):
    known = filter_file(tmp_path, url_filter.build(URL_RULES))
    assert isinstance(known.digests.base, np.memmap) or isinstance(known.digests, np.memmap)
    assert known.judge(URLS) == [brute(u, URL_RULES) for u in URLS]


@pytest.mark.parametrize("bits", [64, 3, 0])
def test_many_rules_also_with_colliding_digests(tmp_path, bits):
    rng = random.Random(bits)
    hosts = [".".join(rng.choice(["a", "bb", "c", "net", "org"]) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    paths = ["", "/", "/x", "/x/", "/x/yy", "/é"]
    rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h, p in ((rng.choice(hosts), rng.choice(paths)) for _ in range(200))}.values())
    import xxhash

    digest = lambda k: xxhash.xxh64_intdigest(k) & ((1 << bits) - 1)
    known = filter_file(tmp_path, url_filter.build(rules, "block", digest), digest=digest)
    urls = [f"http://{rng.choice(['', 'w.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'z', '?q'])}" for _ in range(500)]
    assert known.judge(urls) == [brute(u, rules, "block") for u in urls]


def test_no_rules_and_twice_the_same(tmp_path):
    assert filter_file(tmp_path, url_filter.build([])).judge(["http://a/b", None]) == [("a", "/b", None, "allow"), ("", "", None, "allow")]
    twice = url_filter.build([("allow", "A", "/"), ("block", "a", "/")])
    assert filter_file(tmp_path, twice).judge(["http://a/"]) == [("a", "/", "a/", "block")]


def test_frames(spark):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(URLS)] + [(None, "http://net/", "", ""), (1, "http://net/", "", ""), (1, "http://net/", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, id string")
    got = sorted(((r.id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, URL_RULES).collect()), key=repr)
    assert got == sorted(((r[0], *brute(r[1], URL_RULES)) for r in rows), key=repr)
    assert url_filter.judge(pages.limit(0), URL_RULES).count() == 0


def test_long_hosts_cost_no_more_than_rules(tmp_path, monkeypatch):
    hosts = ["a." * 50_000 + "net", "." * 50_000 + "net", "a" * 100_000 + ".example.net", "b." * 100_000]
    urls = [f"http://{h}/en/{'x' * n}" for h in hosts for n in (0, 50_000)]
    known = filter_file(tmp_path, url_filter.build(URL_RULES))
    whole = known.judge(urls)
    assert whole == [brute(u, URL_RULES) for u in urls]
    tracemalloc.start()
    known.judge(urls)
    assert tracemalloc.get_traced_memory()[1] < 20 * sum(map(len, urls))
    tracemalloc.stop()
    monkeypatch.setattr(url_filter, "SLICE_BYTES", 100)
    assert known.judge(urls + URLS) == whole + [brute(u, URL_RULES) for u in URLS]
