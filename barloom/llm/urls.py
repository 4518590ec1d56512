"""Allow and block rules for urls, matched by a trie of reversed host labels and path segments.

A rule names a host and the beginning of a path. It fits the host and its subdomains if
the url's path starts with the rule's. The trie branches by the host's labels from the
last one on, then by the path's segments; a rule's last segment is a prefix of the url's.
Of all rules that fit the longest one decides, host and path counted together; of equally
long ones that with the longer host, then block before allow.

The trie is broadcast if the rules are within `MAX_RULES` and `MAX_RULE_BYTES`. A larger
rule table is joined on host suffixes instead; both ways give the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import shipped

MAX_RULES = 500_000
MAX_RULE_BYTES = 32 << 20
RULES = "host string, path string, verdict string"
MATCH = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])


def host_of(url: str) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.col(url), r"(?s)\A.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: str) -> Column:
    """After the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Nodes are dicts of their children; `ends` has the rules that end there by last segment."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.nodes = {}
        for host, path, verdict in rules:
            self.add(host, path, verdict)

    def add(self, host: str, path: str, verdict: str) -> None:
        node = self.nodes
        for label in reversed(host.split(".")):
            node = node.setdefault(("h", label), {})
        *whole, last = path.split("/")
        for segment in whole:
            node = node.setdefault(("p", segment), {})
        found = ((len(host) + len(path), len(host), verdict == "block"), host + path, verdict)
        ends = node.setdefault("ends", {})
        ends[last] = max(ends.get(last, found), found)

    def match(self, host: str, path: str) -> tuple | None:
        best, node, segments = None, self.nodes, path.split("/")
        for label in reversed(host.split(".")):
            node = node.get(("h", label))
            if node is None:
                break
            below = node
            for segment in segments:
                for end, found in below.get("ends", {}).items():
                    if segment.startswith(end) and (best is None or found > best):
                        best = found
                below = below.get(("p", segment))
                if below is None:
                    break
        return best


def _by_trie(pages: DataFrame, rules: list[tuple[str, str, str]], default: str) -> DataFrame:
    packed = shipped(pages.sparkSession, json.dumps(rules).encode(), "the rule set")

    @F.arrow_udf(MATCH)
    def match(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        trie = Trie(json.loads(packed.value))
        for hosts, paths in batches:
            found = [trie.match(h, p) for h, p in zip(hosts.to_pylist(), paths.to_pylist())]
            rule = [f and f[1] for f in found]
            verdict = [f[2] if f else default for f in found]
            yield pa.StructArray.from_arrays([pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["rule", "verdict"])

    made = pages.withColumn("rule", match("host", "path"))
    return made.withColumns({"rule": F.col("rule.rule"), "verdict": F.col("rule.verdict")})


def _by_join(pages: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """Every distinct (host, path) with the rules of its host's suffixes, joined on the suffix."""
    targets = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    rule = rules.select(F.col("host").alias("at"), F.col("path").alias("begin"), F.col("verdict").alias("says"))
    rank = F.struct(F.length("at") + F.length("begin"), F.length("at"), F.col("says") == "block", F.concat("at", "begin"))
    best = (
        targets.withColumn("at", F.explode(suffixes))
        .join(rule, "at")
        .where(F.expr("startswith(path, begin)"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(F.concat("at", "begin").alias("rule"), F.col("says").alias("verdict")), rank).alias("m"))
        .select("host", "path", "m.*")
    )
    return pages.join(best, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Every row with `host`, `path`, `rule` (host and path of the deciding rule) and `verdict`.

    `rules`: host, path and verdict ('allow' or 'block'); hosts in lower case. A null url
    and one without `://` have an empty host and path. Without a rule that fits, `rule` is
    null and `verdict` is `default`. Columns of `pages` with these four names are replaced;
    rows keep their number and all other columns. An empty table stays empty.
    """
    rules = rules.select("host", "path", "verdict").where("host is not null and path is not null and verdict is not null")
    taken = [c for c in pages.columns if c.lower() in ("rule", "verdict")]
    pages = pages.drop(*taken).withColumns({"host": host_of(url_col), "path": path_of(url_col)})
    sizes = rules.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("host") + F.length("path")), F.lit(0)).alias("b")).first()
    if sizes["n"] <= MAX_RULES and sizes["b"] <= MAX_RULE_BYTES:
        return _by_trie(pages, [tuple(r) for r in rules.collect()], default)
    return _by_join(pages, rules, default)
