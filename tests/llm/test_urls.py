import random

from conftest import values
from pyspark.sql import functions as F

from tablesync.llm.urls import build_cascade, judge_urls, key_hashes, member

RULES = [("net", "/", "block"), ("Example.net", "/en/", "allow"), ("a.org", "", "block"), ("a.org", "/x", "allow"), (None, "/", "block")]


def judge(rows, urls, rules=RULES, **options):
    pages = rows([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id int, url string, host string, rule string")
    got = judge_urls(pages, rows(rules, "host string, path string, verdict string"), **options)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}


def test_verdicts(rows):
    got = judge(rows, [
        "http://x.example.NET/en/1?q#f", "https://example.net/EN/1", "ftp://net", "net/en/", None, "", "http://net/", "http://xnet/",
        "a://b://net/", "https://q.a.org", "https://a.org/xyz", "https://a.org/y#/x", "http://É.Net/é?/", "http://?net/", "http://a..net/",
    ])
    assert got == {
        0: ("x.example.net", "/en/1", "example.net/en/", "allow"), 1: ("example.net", "/EN/1", "net/", "block"), 2: ("net", "", None, "allow"),
        3: ("", "", None, "allow"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("net", "/", "net/", "block"),
        7: ("xnet", "/", None, "allow"), 8: ("b:", "//net/", None, "allow"), 9: ("q.a.org", "", "a.org", "block"), 10: ("a.org", "/xyz", "a.org/x", "allow"),
        11: ("a.org", "/y", "a.org", "block"), 12: ("É.net", "/é", "net/", "block"), 13: ("", "", None, "allow"), 14: ("a..net", "/", "net/", "block"),
    }


def test_equal_rules_block_and_unlisted_can_be_blocked(rows):
    got = judge(rows, ["http://a.b/", "http://c/"], [("b", "/", "allow"), ("b", "/", "block")], unlisted="block")
    assert [got[k][2:] for k in (0, 1)] == [("b/", "block"), (None, "block")]


def test_no_rules_no_pages_and_repeated_pages(rows):
    assert judge(rows, ["http://a/"], []) == {0: ("a", "/", None, "allow")}
    assert judge(rows, []) == {}
    pages = rows([(1, "http://net/")] * 3 + [(None, "http://net/")], "page_id int, url string")
    assert values(judge_urls(pages, rows(RULES, "host string, path string, verdict string")).select("page_id", "verdict")) == [
        (None, "block"), (1, "block"), (1, "block"), (1, "block"),
    ]


def test_a_cascade_answers_exactly_for_its_universe(spark):
    rng = random.Random(1)
    keys = [f"{rng.randrange(10**9)}.example/{k}" for k in range(6000)]
    frame = spark.createDataFrame([(k,) for k in keys] + [(None,)], "key string")
    levels = build_cascade(spark.createDataFrame([(k,) for k in keys[:700]] + [("elsewhere",)], "key string"), frame, rate=0.3)
    assert len(levels) > 2
    hashed = frame.where("key is not null").select("key", *key_hashes(F.col("key"))).toPandas()
    found = member(levels, hashed.h1.to_numpy().view("uint64"), hashed.h2.to_numpy().view("uint64"))
    assert set(hashed.key[found]) == set(keys[:700])


def test_a_cascade_that_is_too_large_is_refused(spark):
    frame = spark.range(1000).select(F.col("id").cast("string").alias("key"))
    try:
        build_cascade(frame, frame, max_bytes=100)
    except ValueError as e:
        assert "max_bytes" in str(e)
    else:
        raise AssertionError


def brute(url, rules, unlisted="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, unlisted
    best = max(fits, key=lambda f: (f[0], f[1], f[2], f[3] == "block"))
    return host, path, best[2], best[3]


def test_many_rules_with_many_path_lengths_and_a_very_long_url(rows, spark):
    rng = random.Random(7)
    rules = [(f"h{k % 50}.example", "/" + "ab"[k % 2] * n, "block" if k % 3 else "allow") for n in range(400) for k in range(25)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    urls = [f"http://x.y.h{rng.randrange(60)}.example/{'ab'[rng.randrange(2)] * rng.randrange(500)}?q" for _ in range(150)]
    urls.append("https://h1.example/" + "a" * 200_000)
    got = judge(rows, urls, rules)
    for i, url in enumerate(urls):
        assert got[i] == brute(url, rules), url[:60]


def test_keys_are_one_expression_for_any_rules(spark):
    from tablesync.llm.urls import candidate_keys

    pages = spark.createDataFrame([("a.b.c", "/x/y")], "host string, path string")
    sizes = []
    for labels, lengths in ((2, [1, 2]), (9, list(range(5000)))):
        keys = pages.select(candidate_keys(F.col("host"), F.col("path"), labels, lengths).alias("k"))
        sizes.append(keys._jdf.queryExecution().analyzed().toString().count("lambdafunction"))
    assert sizes[0] == sizes[1] and set(keys.first().k) == {s + "/x/y"[:m] for s in ("c", "b.c", "a.b.c") for m in range(5)}
