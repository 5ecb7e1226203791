import zlib
from collections import Counter

import pytest

from foretell.llm import sharding, url_filters

URLS = [
    (0, "http://a.example.net/en/x?q=1"), (1, "https://EXAMPLE.NET/de"), (2, "ftp://x.org/fr/"), (3, "http://x.org/fr"), (4, None),
    (5, "no scheme/net/"), (6, "http://net"), (7, "http://net/"), (8, "http://badexample.net/en/"), (9, "http://example.com/de/#t"),
    (10, "http://a.b.c.example.com/de/y"), (11, "http:///path"), (12, "x://net?/en"), (13, ""), (14, "http://a.example.net/en/x?q=1"),
    (15, "see http://one.net/ and http://two.org/fr/"), (16, "http://example.net./en/"), (17, "http://İ.NET/a"),
]
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("net", "/de", "allow"), ("net", "/den", "block"), ("net", "/de/x", "block"), ("net", "/de", "allow"), ("a.b.c.example.com", "", "allow")]


def judged(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


@pytest.mark.parametrize("rules", [list(url_filters.RULES), RULES, []])
def test_rules_as_by_brute_force(spark, rules):
    urls = spark.createDataFrame(URLS, "page_id long, url string")
    got = url_filters.judge(urls, url_filters.rules_frame(spark, rules)).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == [(i, *judged(u, rules)) for i, u in URLS]


def test_nested_paths_and_hosts(spark):
    urls = [(i, f"http://{h}{p}") for i, (h, p) in enumerate(
        (h, p) for h in ("net", "x.net", "y.x.net") for p in ("", "/", "/d", "/de", "/den", "/de/x", "/de/y", "/df"))]
    frame = spark.createDataFrame(urls, "page_id long, url string")
    got = url_filters.judge(frame, url_filters.rules_frame(spark, RULES), salts=3).collect()
    assert sorted((r.page_id, r.rule, r.verdict) for r in got) == [(i, *judged(u, RULES)[2:]) for i, u in urls]


def test_clashing_columns_are_replaced_and_others_stay(spark):
    urls = spark.createDataFrame([("h", "http://a.net/", 5, "kept", 1)], "host string, url string, rule int, _key string, _salt int")
    got = url_filters.judge(urls, url_filters.rules_frame(spark)).collect()
    assert [r.asDict() for r in got] == [{"url": "http://a.net/", "_key": "kept", "_salt": 1, "host": "a.net", "path": "/", "rule": "net/", "verdict": "block"}]


def test_no_urls(spark):
    assert url_filters.judge(spark.createDataFrame([], "url string"), url_filters.rules_frame(spark)).count() == 0


def test_conflicting_rules_block(spark):
    rules = url_filters.rules_frame(spark, [("a.b", "/", "allow"), ("a.b", "/", "block")])
    assert url_filters.judge(spark.createDataFrame([("http://a.b/",)], "url string"), rules).first().verdict == "block"


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 24, 100])
def test_jump_is_the_published_function(spark, shards):
    keys = list(range(200)) + [-1, -5, 2**63 - 1, -(2**63), None]
    got = spark.createDataFrame([(k,) for k in keys], "k long").withColumn("s", sharding.jump(sharding.F.col("k"), shards)).collect()
    assert [r.s for r in got] == [jump(k or 0, shards) for k in keys]


def test_shards_of_odd_documents(odd_docs, no_docs):
    got = sharding.sharded(odd_docs).collect()
    rows = odd_docs.collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()), jump(r.doc_id or 0, 24), jump(r.doc_id or 0, 25)) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    assert {r.law for r in got} == {"key"}
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.sharded(no_docs).count() == 0


def test_one_row_that_makes_up_most_of_the_table(spark):
    docs = spark.range(2000).selectExpr("CASE WHEN id < 1500 THEN 7 ELSE id END AS doc_id", "'same' AS text")
    got = sharding.sharded(docs, 3).collect()
    for shard in range(3):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 3) for r in got)


def test_hot_urls_are_many_groups(spark):
    from pyspark.sql import functions as F

    urls = spark.range(20_000).select(F.col("id").alias("page_id"), F.lit(None).cast("string").alias("url"))
    row = F.struct("page_id", "url")
    salts = urls.select(F.pmod(F.xxhash64(row, F.spark_partition_id()), F.lit(url_filters.SALTS)).alias("s")).distinct().count()
    assert salts == url_filters.SALTS >= 50
    assert {r.verdict for r in url_filters.judge(urls, url_filters.rules_frame(spark)).collect()} == {"allow"}
