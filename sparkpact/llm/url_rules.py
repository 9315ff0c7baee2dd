"""URL verdicts by pattern rules that are indexed by their rarest literal token.

A rule is a host and the beginning of a path, written ``example.com/en/``. It fits URLs of its host and of all
subdomains whose path begins with its path; of all that fit, the longest rule decides. Each rule is a regular
expression over host and path, but few are run: labels of the host and whole segments of the path that a
matching URL must contain are the rule's literal tokens, and the rule is filed under the one that the fewest
URLs of the table contain. The tokens of a URL fetch the rules filed under them; only those are matched.

How often the tokens of the rules occur is counted over all URLs. A list of up to ``LISTED`` rules goes to the tasks with
the program, and the driver sees one number per token of a rule. Longer lists, and rules given as a table, stay tables of
any size: tokens are counted in an exchange, each rule is filed under its rarest one by a join, and the distinct hosts and
paths fetch their candidates by a join on the token. Only those candidates are matched, and of the rules that fit a host
and path the longest is kept by an aggregate that is partial in each task. Both ways give the same rows.

Of rules that fit and are equally long the first of a list decides, and of a table the least pattern, then verdict.
Repeated rules count once; rules of a table that lack pattern or verdict fit nothing.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or
the end. Null or without ``://``: both are empty. Without a fitting rule: the default verdict, no rule. An empty
table gives an empty result; all columns of the input stay, those named like the new ones excepted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpact.llm.base import ROW, bounded, written

#: Rules that go to the tasks with the program; more are a table.
LISTED = 20_000
NEW = ("host", "path", "rule", "verdict")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_END_OF_HOST, _END_OF_PATH = re.compile(r"[/?#]"), re.compile(r"[?#]")


@dataclass(frozen=True)
class Rule:
    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0].translate(_LOWER)

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2] if "/" in self.pattern else ""

    @property
    def expression(self) -> str:
        """Matches host and path written together; a host holds no slash and a path begins with one."""
        return rf"(?s)(?:[^/]*\.)?{re.escape(self.host)}" + (re.escape(self.path) if self.path else r"(?:/|\Z)")

    def tokens(self) -> set[str]:
        """What every URL that fits must contain: host labels, and path segments that end in the rule."""
        whole = self.path.split("/")[1:-1]
        return {f"h{x}" for x in self.host.split(".") if x} | {f"p{x}" for x in whole if x}


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = _END_OF_HOST.search(rest)
    at = end.start() if end else len(rest)
    tail = _END_OF_PATH.split(rest[at:], maxsplit=1)[0]
    return rest[:at].translate(_LOWER), tail


def url_tokens(host: str, path: str) -> set[str]:
    return {f"h{x}" for x in host.split(".") if x} | {f"p{x}" for x in path.split("/") if x}


def token_counts(urls: DataFrame, url_col: str, wanted: set[str]) -> dict[str, int]:
    """In how many URLs each wanted token occurs: one row per token and task reaches the exchange."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = dict.fromkeys(wanted, 0)
        for batch in batches:
            for url in batch.column(0).to_pylist():
                for token in url_tokens(*split_url(url)) & wanted:
                    found[token] += 1
        yield pa.record_batch([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["token", "n"])

    rows = urls.select(F.col(f"`{url_col}`").alias("url")).mapInArrow(counted, "token string, n bigint")
    return {r["token"]: r["n"] for r in rows.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def rule_index(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Numbers of the rules under their rarest token; under the empty one those without any."""
    index: dict[str, list[int]] = {}
    for i, rule in enumerate(rules):
        rarest = min(rule.tokens(), key=lambda t: (counts.get(t, 0), t), default="")
        index.setdefault(rarest, []).append(i)
    return index


def judge_urls(pages: DataFrame, rules: Sequence[Rule] | DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``; rules are a list, or a table with ``pattern, verdict``."""
    if isinstance(rules, DataFrame):
        return _judged_by_table(pages, rules.select("pattern", "verdict", F.lit(0).cast("bigint").alias("number")), url_col, default)
    rules = list(rules)
    if len(rules) > LISTED:
        rows = pages.sparkSession.createDataFrame([(r.pattern, r.verdict, i) for i, r in enumerate(rules)], "pattern string, verdict string, number bigint")
        return _judged_by_table(pages, rows, url_col, default)
    return _judged_by_list(pages, rules, url_col, default)


def _kept(pages: DataFrame) -> list[str]:
    """The columns of the input that stay."""
    return [c for c in pages.columns if c.lower() not in NEW]


def _judged_by_list(pages: DataFrame, rules: list[Rule], url_col: str, default: str) -> DataFrame:
    index = rule_index(rules, token_counts(pages, url_col, set().union(*(r.tokens() for r in rules))) if rules else {})
    names = _kept(pages)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: dict[int, re.Pattern] = {}
        # Longest first, then in the order given.
        rank = {i: (-len(r.pattern), i) for i, r in enumerate(rules)}
        for batch in batches:
            hosts, paths, fits, verdicts = [], [], [], []
            for url in batch.column(batch.num_columns - 1).to_pylist():
                host, path = split_url(url)
                candidates = set(index.get("", ()))
                for token in url_tokens(host, path):
                    candidates.update(index.get(token, ()))
                fit = None
                for i in sorted(candidates, key=rank.__getitem__):
                    if i not in compiled:
                        compiled[i] = re.compile(rules[i].expression)
                    if compiled[i].match(host + path):
                        fit = rules[i]
                        break
                hosts.append(host)
                paths.append(path)
                fits.append(fit.pattern if fit else None)
                verdicts.append(fit.verdict if fit else default)
            columns = [batch.column(i) for i in range(len(names))] + [pa.array(x, pa.string()) for x in (hosts, paths, fits, verdicts)]
            yield pa.record_batch(columns, [*names, *NEW])

    rows = pages.select(*(F.col(f"`{c}`") for c in names), F.col(f"`{url_col}`").alias("__url"))
    types = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields[:-1]]
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in [*types, *((c, "string") for c in NEW)])
    return rows.mapInArrow(judged, ddl)


def _url_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host and path in place of the URL, the first column."""
    for batch in batches:
        both = [split_url(url) for url in batch.column(0).to_pylist()]
        places = [pa.array([x[i] for x in both], pa.string()) for i in (0, 1)]
        yield pa.record_batch([*places, *batch.columns[1:]], ["host", "path", *batch.schema.names[1:]])


def _place_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``host, path, n, token``; every URL has the empty token, under which the rules without any are filed."""
    for batch in batches:
        rows = [(i, t) for i, (h, p) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())) for t in ("", *url_tokens(h, p))]
        owner = pa.array([i for i, _ in rows], pa.int64())
        yield pa.record_batch([*(batch.column(i).take(owner) for i in range(3)), pa.array([t for _, t in rows], pa.string())], ["host", "path", "n", "token"])


def _rule_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``pattern, verdict, number, token``: the empty token for rules that have no other."""
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(3)]
        rows = [(p, v, n, t) for p, v, n in zip(*columns) for t in (Rule(v, p).tokens() or {""})]
        yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64() if i == 2 else pa.string()) for i in range(4)], ["pattern", "verdict", "number", "token"])


def _fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates whose regular expression matches."""
    matcher = lru_cache(maxsize=10_000)(lambda pattern: re.compile(Rule("", pattern).expression).match)
    for batch in batches:
        fits = [matcher(pattern)(host + path) is not None for host, path, pattern in zip(*(batch.column(i).to_pylist() for i in range(3)))]
        yield batch.filter(pa.array(fits, pa.bool_()))


def _judged_by_table(pages: DataFrame, rules: DataFrame, url_col: str, default: str) -> DataFrame:
    names = _kept(pages)
    # The first of equal rules.
    rules = rules.where("pattern is not null and verdict is not null").groupBy("pattern", "verdict").agg(F.min("number").alias("number"))
    url = F.col(f"`{url_col}`").alias("url")
    seen = bounded(pages).select(url).mapInArrow(_url_places, "host string, path string")
    places = written(seen.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")), "url-places")
    tokens = places.mapInArrow(_place_tokens, "host string, path string, n bigint, token string")
    common = tokens.groupBy("token").agg(F.sum("n").alias("n"))
    filed = written(rules.mapInArrow(_rule_tokens, "pattern string, verdict string, number bigint, token string"), "rule-tokens")
    ranked = filed.join(common, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    index = ranked.groupBy("pattern", "verdict", "number").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    candidates = tokens.join(index, "token").select("host", "path", "pattern", "verdict", "number")
    fits = candidates.mapInArrow(_fitting, "host string, path string, pattern string, verdict string, number bigint")
    # The least by this order is the longest rule, and of equally long ones the first.
    order = F.struct((-F.length("pattern")).alias("size"), "number", "pattern", "verdict")
    best = written(fits.groupBy("host", "path").agg(F.min(order).alias("best")), "url-verdicts")
    # A struct of no columns cannot go to a task, so the URL stands in for it.
    rows = pages.select(url, F.struct(*(F.col(f"`{c}`") for c in names or [url_col])).alias(ROW))
    rows = rows.mapInArrow(_url_places, f"host string, path string, `{ROW}` {rows.schema[ROW].dataType.simpleString()}")
    told = rows.join(best, ["host", "path"], "left")
    return told.select(
        *(F.col(ROW).getField(c).alias(c) for c in names),
        "host", "path", F.col("best.pattern").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
