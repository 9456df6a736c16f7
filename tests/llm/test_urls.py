"""The URL filter against the same models in plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.brute import LOWER, in_order
from wayfare.llm import queries, urls

RULES = [(r.text, r.verdict) for r in queries.URL_RULES]
KINDS = ("allow", "block")


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):])[0]


def rule_of(host, path):
    fits = []
    for text, verdict in RULES:
        own, prefix = text.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + prefix):
            fits.append((len(text), text, verdict))
    return max(fits)[1:] if fits else (None, None)


def grams(text, order):
    padded = "\2" * order + text + "\3"
    return [padded[j - order : j + 1] for j in range(order, len(padded))]


def judged(rows, order=urls.ORDER):
    pages = [(page, *parts(url)) for page, url in rows]
    pages = [(page, host, path, *rule_of(host, path)) for page, host, path in pages]
    marked = Counter((host + path, kind) for _, host, path, _, kind in pages if kind)
    held = {t: ord(hashlib.md5(t.encode()).hexdigest()[31]) % 5 == 0 for t, _ in marked}
    both = all(any(held[t] == side and k == kind for t, k in marked) for side in (True, False) for kind in KINDS)
    training = {x: n for x, n in marked.items() if not (both and held[x[0]])}
    unseen = {x: n for x, n in marked.items() if not both or held[x[0]]}
    counts = {k: Counter() for k in KINDS}
    for (text, kind), n in training.items():
        for g in grams(text, order):
            counts[kind].update({g[order - length:]: n for length in range(order + 1)})
    letters = {g for k in KINDS for g in counts[k] if len(g) == 1}
    after = {k: defaultdict(lambda: [0, 0]) for k in KINDS}
    for k in KINDS:
        for g, n in counts[k].items():
            after[k][g[:-1]][0] += n
            after[k][g[:-1]][1] += 1

    def ratio(g):
        logs = []
        for k in KINDS:
            p = 1 / (len(letters) + 1)
            for length in range(order + 1):
                tail = g[order - length:]
                n, kinds = after[k].get(tail[:-1], (0, 0))
                p = (counts[k][tail] + kinds * p) / (n + kinds) if n else p
            logs.append(math.log(p))
        return round((logs[0] - logs[1]) * 1e9)

    scores = {t: sum(map(ratio, grams(t, order))) / (len(t) + 1) / 1e9 for t in {h + p for _, h, p, _, _ in pages}}
    bins, limit = defaultdict(Counter), None
    for (text, kind), n in unseen.items():
        bins[max(-2000, min(2000, math.floor(scores[text] * 100)))][kind] += n
    total = {k: sum(b[k] for b in bins.values()) for k in KINDS}
    if all(total.values()):
        errors = {p: sum(bins[q]["allow"] for q in bins if q < p) / total["allow"]
                  - sum(bins[q]["block"] for q in bins if q < p) / total["block"] for p in sorted(bins)}
        limit = min(errors, key=lambda p: (errors[p], p)) / 100
    guess = {t: "block" if limit is not None and s < limit else "allow" for t, s in scores.items()}
    return [(page, host, path, rule, kind or guess[host + path]) for page, host, path, rule, kind in pages]


ODD = [
    (1, None), (2, ""), (2, "nope"), (None, "HTTP://A.Example.ORG/es/"), (3, "http://x.org?q"), (3, "http://x.org/"),
    (4, "x://com/fr/a#b"), (5, "x://a.com/de/"), (6, "x://net/fr/a#b"), (7, "http://exampleorg/es/"), (8, "a://b://c.org/"),
    (9, "http://example.org/es/"), (9, "http://example.org/es/"), (10, "http://é.org/ü\nx?y"), (11, "http://org"),
]


@pytest.mark.parametrize("rows", [ODD, ODD[:3], ODD[5:7]])
def test_odd_urls(spark, rows):
    df = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, host string")
    got = urls.judge(df, queries.URL_RULES).select("page_id", "host", "path", "rule", "verdict").collect()
    assert in_order(got) == in_order(judged(rows))


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(empty, queries.URL_RULES).count() == 0


def test_url_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()]
    got = queries.op8_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", "verdict").collect()
    assert in_order(got) == in_order(judged(rows))
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}
