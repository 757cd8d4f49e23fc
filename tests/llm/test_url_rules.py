from __future__ import annotations

import itertools
import random
import re
import time

from skyledger.llm import queries, url_rules
from tests.conftest import SMALL

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def listed(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def token_set(url):
    host, path = split(url)
    number = lambda x: re.sub("[0-9]+", "0", x)
    query = re.search(r"(?s)\?([^#]*)", url or "")
    found = [f"host{i}={number(x)}" for i, x in enumerate(reversed(host.split(".")))]
    found += [f"path={number(x)}" for x in path.split("/")]
    found += [f"query={number(x.split('=')[0])}" for x in (query[1] if query else "").split("&")]
    return frozenset(x for x in found if not x.endswith("="))


def brute(pages, labels, support=url_rules.MIN_SUPPORT, confidence=url_rules.MIN_CONFIDENCE):
    bad = {}
    for d, quality, toxic in labels:
        if d is not None and (quality, toxic) != (None, None):
            bad[d] = bad.get(d, False) or quality == 0 or toxic == 1
    known = [(token_set(u), bad[p]) for p, u in pages if p in bad]
    rules = {}
    least = support * len(known)
    for size in range(1, 12):
        seen = {}
        for tokens, is_bad in known:
            for some in itertools.combinations(sorted(tokens), size):
                n, b = seen.get(some, (0, 0))
                seen[some] = n + 1, b + is_bad
        rules |= {s: b / n for s, (n, b) in seen.items() if b and b >= least and b / n >= confidence}
    found = []
    for p, u in pages:
        host, path = split(u)
        rule, verdict = listed(host, path)
        mined = "block" if any(set(s) <= token_set(u) for s in rules) else "allow"
        found.append((p, host, path, rule, verdict or mined))
    return sorted(found, key=str)


def test_whole_table(spark):
    pages = [(r.page_id, r.url) for r in queries.table(spark, SMALL, "pages").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in queries.table(spark, SMALL, "labels").collect()]
    found = sorted((tuple(r) for r in queries.op3_url_rules(spark, SMALL).collect()), key=str)
    assert found == brute(pages, labels)


def test_mined_rules(spark):
    pages = [(i, f"https://{h}.example.org/{p}/{i}?{q}=1")
             for i, (h, p, q) in enumerate(itertools.product(["bets", "news", "blog"], ["a", "b"], ["x", "y"] * 5))]
    labels = [(i, 1, int("bets" in u and "/a/" in u or "news" in u and i % 10 < 2)) for i, u in pages[::2]]
    labels += [(i, 0 if "/b/" in u and "x=" in u else None, None) for i, u in pages[1::2]]
    frame = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, path int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = sorted((tuple(r) for r in url_rules.judge(frame, marks).collect()), key=str)
    assert found == brute(pages, labels)
    assert {r[-1] for r in found} == {"allow", "block"}
    rules = url_rules.mine(url_rules.parsed(frame), marks)
    sets = [(frozenset(r.antecedent), r.confidence) for r in rules.collect()]
    assert sets and not any(a < b and x >= y for a, x in sets for b, y in sets)


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://COM", "http://Com/", "x://a.com?q=/en/", "http://example.com/en/x#y",
            "https://WWW.example.com/en/", "https://m.www.example.com/en/é?a=b", "https://myexample.com/en/", "a://net/fr/",
            "a://x.NET/es/1", "a://x.net/ES/", "b://x://y.com/", "http://com:80/", "http://İ.com/", "http://a\nb.com/c\nd?e",
            "http://example.com/en", "http://x.example.com.org/en/"]
    pages = list(enumerate(urls)) + [(None, "http://a.net/fr/"), (3, "http://a.com/"), (3, "http://a.com/")]
    frame = spark.createDataFrame([(*p, "r") for p in pages], "page_id long, url string, rule string")
    labels = spark.createDataFrame([(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    found = sorted((tuple(r) for r in url_rules.judge(frame, labels).collect()), key=str)
    assert found == brute(pages, [(None, 0, 1)])
    assert url_rules.judge(frame.limit(0), labels).count() == 0


def test_tokens_that_always_occur_together(spark):
    """Thirty equal query names on a hundred pages: as rules of the single names, in seconds."""
    query = "&".join(f"{chr(97 + i % 26)}x{'y' * (i // 26)}={i}" for i in range(30))
    pages = [(i, f"https://h{i % 7}.org/{'pqr'[i % 3]}/?{query if i < 100 else 'z=1'}") for i in range(1000)]
    pages += [(2000, "https://other.org/?bx=1"), (2001, "https://other.org/?z=1")]
    labels = [(i, None, int(i < 100 and i % 10 > 0)) for i in range(1000)]
    frame = spark.createDataFrame(pages, "page_id long, url string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    begin = time.perf_counter()
    verdicts = {r.page_id: r.verdict for r in url_rules.judge(frame, marks).collect()}
    assert time.perf_counter() - begin < 60
    # Any of the names alone makes a confident rule; no rule fires without one of them.
    assert {p for p, v in verdicts.items() if v == "block"} == {*range(100), 2000}


def test_classes_against_brute_force(spark):
    """Names that occur together on some pages and apart on others, several classes to a rule."""
    rng = random.Random(9)
    groups = [["a", "b"], ["c", "d", "e"], ["f"], ["g"]]
    pages, labels = [], []
    for i in range(120):
        some = [n for g in groups if rng.random() < 0.5 for n in g]
        pages.append((i, "https://x.org/?" + "&".join(f"{n}=1" for n in some)))
        labels.append((i, None, int(("a" in some and "c" in some) or rng.random() < 0.1)))
    pages += [(500 + i, f"https://y.org/?{n}=2&{m}=3") for i, (n, m) in enumerate(itertools.combinations("abcdefg", 2))]
    frame = spark.createDataFrame(pages, "page_id long, url string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = sorted((tuple(r) for r in url_rules.judge(frame, marks).collect()), key=str)
    assert found == brute(pages, labels)
    assert {r[-1] for r in found} == {"allow", "block"}
