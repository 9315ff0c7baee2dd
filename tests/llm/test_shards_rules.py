from __future__ import annotations

import re
from collections import defaultdict

import pytest
from brute import corner_rows, frame, rows_of
from pyspark.sql import functions as F

from sparkpact.llm import shards, url_rules
from sparkpact.llm.queries import URL_RULES


def shard_sizes(found):
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in found:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_equal_bytes(spark):
    rows = [(i, "x" * (i * 37 % 200)) for i in range(5000)]
    found = shards.histogram_shards(frame(spark, rows), 12).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(5000))
    assert all(r["size"] == len(r["text"].encode()) + 16 for r in found)
    sizes = shard_sizes(found)
    assert set(sizes) == set(range(12))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 216 + 0.004 * sum(sizes.values()) / 12


def test_a_heavy_key_is_spread(spark):
    """A third of all rows are one row repeated: its shards share it."""
    rows = [(i, "y" * 50) for i in range(4000)] + [(7, "the same row")] * 2000
    found = shards.histogram_shards(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), 10).collect()
    sizes = shard_sizes(found)
    assert len(found) == 6000
    assert max(sizes.values()) < 1.35 * min(sizes.values())


def test_corner_rows(spark):
    rows = corner_rows()
    docs = frame(spark, rows)
    found = shards.histogram_shards(docs, 5)
    assert found.columns == ["shard", "slot", "size", *[c for c in docs.columns if c not in ("shard", "slot", "size")]]
    got = found.collect()
    assert sorted(((r["doc_id"], r["size"]) for r in got), key=repr) == sorted(((r[0], len((r[1] or "").encode()) + 16) for r in rows), key=repr)
    shard_sizes(got)


@pytest.mark.parametrize("run_bytes", [100, 3000])
def test_slots_over_many_runs(spark, monkeypatch, run_bytes):
    """A shard is numbered in many tasks, also where a heavy key is shared; names used while dealing are the input's own."""
    monkeypatch.setattr(shards, "RUN_BYTES", run_bytes)
    rows = [(i, "y" * (i % 60), f"k{i}", -i) for i in range(1500)]
    for own in (rows, rows + [(7, "the same row", "k", 1)] * 800):
        docs = spark.createDataFrame(own, "doc_id bigint, text string, key string, draw int").repartition(3)
        found = shards.histogram_shards(docs, 6)
        assert found.columns == ["shard", "slot", "size", "doc_id", "text", "key", "draw"]
        got = found.collect()
        shard_sizes(got)
        assert sorted((r["doc_id"], r["text"], r["key"], r["draw"]) for r in got) == sorted(own)


def test_bytes_below_each_boundary(spark):
    """Boundaries against sorted keys: what lies below each is within the tolerance of its share."""
    rows = spark.range(20_000).select(shards.row_key(F.col("id")).alias("__key"), (F.col("id") % 50 + 16).alias("size"))
    plain = sorted((r["__key"], r["size"]) for r in rows.collect())
    cuts, total = shards.splitters(rows, 9)
    assert total == sum(size for _, size in plain)
    for i, (first, share) in enumerate(cuts, 1):
        below = sum(size for key, size in plain if key < first)
        assert share == 1.0 and abs(below - total * i / 9) <= max(66, shards.TOLERANCE * total / 9)


def test_the_same_twice(spark):
    docs = frame(spark, [(i, "z" * (i % 31)) for i in range(500)])
    first, second = (rows_of(shards.histogram_shards(docs.repartition(n), 7), "doc_id", "shard", "slot") for n in (1, 5))
    assert first == second


def test_plan_is_native(spark):
    plan = shards.histogram_shards(frame(spark, corner_rows()), 5)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_no_documents(spark):
    assert shards.histogram_shards(frame(spark, []), 5).count() == 0


# -- rules ---------------------------------------------------------------------


def plain_verdict(url, rules):
    """Host, path, rule and verdict, trying every rule."""
    host = path = ""
    if url is not None and "://" in url:
        m = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith("/" + r.pattern.split("/", 1)[1])]
    best = max(fits, key=lambda r: len(r.pattern), default=None)
    return host, path, best and best.pattern, best.verdict if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://example.com", "http://example.com/", "HTTP://WWW.Example.COM/en/x?y#z", "https://www.example.com/EN/1",
    "http://notexample.com/en/1", "http://sub.www.example.com/en/1", "http://a.b.example.com/en/1", "http://x.net/es/1", "http://x.net/fr", "http://net/fr/1",
    "ftp://com/1", "http://com", "http://x.com?/en/", "http://x.com#://y.net/es/", "a://b://c.net/es/", "http://x.net:80/es/", "http://ÉX.net/es/\n1", "http://.net/es/1",
]


def given(spark, rules, way, monkeypatch):
    """The rules as a list, as a list too long for the tasks, or as a table with other columns, repeats and gaps."""
    if way == "list":
        return rules
    if way == "long list":
        monkeypatch.setattr(url_rules, "LISTED", 1)
        return rules
    rows = [(r.verdict, "note", r.pattern) for r in rules] * 2 + [(None, "note", "com/"), ("block", "note", None)]
    return spark.createDataFrame(rows, "verdict string, token string, pattern string")


WAYS = pytest.mark.parametrize("way", ["list", "long list", "table"])


@WAYS
def test_verdicts(spark, way, monkeypatch):
    rows = [(i, u, "<html>", "clash") for i, u in enumerate(URLS + URLS[:3])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    found = url_rules.judge_urls(pages, given(spark, URL_RULES, way, monkeypatch))
    assert found.columns == ["page_id", "url", "html", "host", "path", "rule", "verdict"]
    assert rows_of(found, "page_id", "host", "path", "rule", "verdict") == sorted(((i, *plain_verdict(u, URL_RULES)) for i, u, *_ in rows), key=repr)


@WAYS
def test_verdicts_of_many_rules(spark, sf_dir, way, monkeypatch):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    urls = [r["url"] for r in pages.collect()]
    hosts = sorted({url_rules.split_url(u)[0] for u in urls})
    rules = [url_rules.Rule("block" if i % 2 else "allow", f"{h.split('.', i % 2)[-1]}/{'en/' * (i % 3)}") for i, h in enumerate(hosts)] + list(URL_RULES)
    found = url_rules.judge_urls(pages, given(spark, rules, way, monkeypatch))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"] and len(r["rule"])) for r in found.collect()}
    for r in pages.collect():
        host, path, rule, _ = plain_verdict(r["url"], rules)
        assert got[r["page_id"]] == (host, path, rule and len(rule))


def test_rarest_token():
    rules = list(URL_RULES)
    index = url_rules.rule_index(rules, {"hcom": 90, "hexample": 50, "pen": 10, "hwww": 20, "hnet": 30, "pes": 5, "pfr": 5})
    assert index == {"hcom": [0], "pen": [1, 2], "pes": [3], "pfr": [4]}


def test_no_pages_and_no_rules(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert url_rules.judge_urls(empty, URL_RULES).count() == 0
    pages = spark.createDataFrame([(1, "http://x.net/es/")], "page_id bigint, url string")
    assert url_rules.judge_urls(pages, []).first()["verdict"] == "allow"
    none = spark.createDataFrame([], "pattern string, verdict string")
    assert url_rules.judge_urls(pages, none).first()["verdict"] == "allow"
    some = spark.createDataFrame([("net/es/", "block")], "pattern string, verdict string")
    assert url_rules.judge_urls(empty, some).count() == 0


def test_ways_agree_on_ties_and_on_rules_without_tokens(spark, monkeypatch):
    rules = [url_rules.Rule("block", p) for p in ("/a", "b.com/", "a.b.com/", "b.com/xy", "/xyz.htm")] + [url_rules.Rule("allow", p) for p in ("b.com/xy", "/a", "b.com/xyzz")]
    urls = ["http://a.b.com/xyzz", "http://a.b.com/xyz.htm", "http://b.com/a", "x://a", "http:///a", "http://c.d/a", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    names = ("page_id", "host", "path", "rule", "verdict")
    by_list = rows_of(url_rules.judge_urls(pages, rules), *names)
    monkeypatch.setattr(url_rules, "LISTED", 2)
    assert rows_of(url_rules.judge_urls(pages, rules), *names) == by_list
    only_url = url_rules.judge_urls(pages.select(F.col("url").alias("path")), rules, "path")
    assert only_url.columns == ["host", "path", "rule", "verdict"] and only_url.count() == len(urls)
