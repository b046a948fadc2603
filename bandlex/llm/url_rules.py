"""Allow and block rules for URLs, in a trie over host labels and path segments.

A rule names a host and a path, and fits that host and its subdomains where the URL's
path starts with the rule's.  The trie goes down the host's labels from the last one, then
the path's segments; the last part of a rule's path may be the beginning of a segment.
Going down with a URL meets every rule that fits it, and the longest wins: more labels
first, then a longer path.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandlex.llm.shared import settle
from bandlex.operators.lookup import fits_broadcast

ALLOW, BLOCK = "allow", "block"
MAX_RULES = 200_000  # that are broadcast as a trie; more are joined
MAX_RULE_BYTES = 32 << 20  # of their text and places in the list


class Rule(NamedTuple):
    verdict: str
    rule: str  # host and path, such as ``example.com/de/``

    def parts(self) -> tuple[list[str], list[str], str]:
        """Labels from the last one, whole segments of the path, and the rest of it."""
        host, slash, path = self.rule.partition("/")
        *segments, rest = (slash + path).split("/")
        return host.lower().split(".")[::-1], segments, rest


# the trie


class Node:
    """A place in the trie.  ``rules`` are those that end here, by the beginning of the next
    segment that they ask for, the longest first."""

    __slots__ = ("labels", "segments", "rules")

    def __init__(self) -> None:
        self.labels: dict[str, Node] = {}
        self.segments: dict[str, Node] = {}
        self.rules: list[tuple[str, Rule]] = []


def build_trie(rules: Iterable[Rule]) -> Node:
    """Of two rules for the same host and path, block wins."""
    root = Node()
    for rule in sorted(set(rules), key=lambda r: (r.rule, r.verdict == ALLOW)):
        labels, segments, rest = rule.parts()
        node = root
        for label in labels:
            node = node.labels.setdefault(label, Node())
        for segment in segments:
            node = node.segments.setdefault(segment, Node())
        if all(known != rest for known, _ in node.rules):
            node.rules.append((rest, rule))
            node.rules.sort(key=lambda known: -len(known[0]))
    return root


def longest_match(root: Node, host: str, path: str) -> Rule | None:
    """The longest rule that fits."""
    best, node = None, root
    segments = path.split("/")
    for label in host.split(".")[::-1]:
        node = node.labels.get(label)
        if node is None:
            break
        at, found = node, None
        for segment in segments:
            # the longest beginning that fits at each depth; deeper ones are longer
            found = next((rule for rest, rule in at.rules if segment.startswith(rest)), found)
            at = at.segments.get(segment)
            if at is None:
                break
        best = found or best
    return best


# URLs


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII in lower case; empty
    for null and without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _by_trie(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    shared = pages.sparkSession.sparkContext.broadcast([tuple(r) for r in rules])
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = functools.lru_cache(1 << 16)(functools.partial(longest_match, build_trie(Rule(*r) for r in shared.value)))
        for batch in batches:
            host, path = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("host", "path"))
            found = list(map(match, host, path))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([r and r[i] for r in found], pa.string()) for i in (1, 0))],
                [*batch.schema.names, "rule", "rule_verdict"],
            )

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pages.dtypes)
    return pages.mapInArrow(judge, f"{schema}, rule string, rule_verdict string")


def _by_join(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by a join, for more rules than a task should hold: a URL meets the rules of
    the beginnings of its labels and segments, and keeps the longest that fits."""
    keyed = rules.select(
        "rule",
        F.col("verdict").alias("rule_verdict"),
        F.lower(F.substring_index("rule", "/", 1)).alias("r_host"),
        F.regexp_extract("rule", r"(?s)^[^/]*(.*)", 1).alias("r_path"),
    )
    keyed = keyed.withColumn("r_whole", F.regexp_extract("r_path", r"(?s)^(.*/)?", 1))
    urls = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    # "" and every beginning of the path that ends with a slash
    parts = F.split("path", "/")
    wholes = F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))),
    )
    met = urls.select("host", "path", F.explode(suffixes).alias("r_host"), wholes.alias("wholes"))
    met = met.select("host", "path", "r_host", F.explode("wholes").alias("r_whole"))
    fits = met.join(keyed, ["r_host", "r_whole"]).where(F.col("path").startswith(F.col("r_path")))
    length = F.struct(F.size(F.split("r_host", r"\.")), F.length("r_path"), F.col("rule_verdict") == BLOCK)
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "rule_verdict"), length).alias("best"))
    return pages.join(best, ["host", "path"], "left").select(
        *pages.columns, F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict")
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = ALLOW, max_rules: int = MAX_RULES, max_bytes: int = MAX_RULE_BYTES
) -> DataFrame:
    """``page_id, host, path, rule, verdict``, one row per row of ``pages``.

    ``rules`` has ``verdict`` (allow or block) and ``rule``; rows with a null are ignored.
    Without a rule that fits, ``rule`` is null and the verdict ``default``: so for null
    URLs and those without ``://``, whose host and path are empty.  At most
    ``max_rules`` rules of ``max_bytes`` are broadcast as a trie; others are joined, with
    the same result.  Repeated rows are judged alike; other columns
    are ignored; no rows give no rows.
    """
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rules = rules.select("verdict", "rule").dropna().distinct()
    # a collection of at most max_rules + 1 rows, whose bytes are measured before
    found = rules.limit(max_rules + 1).collect() if fits_broadcast(rules, "rule", max_bytes) else None
    small = found is not None and len(found) <= max_rules
    judged = _by_trie(urls, [Rule(*r) for r in found]) if small else _by_join(urls, settle(rules))
    verdict = F.coalesce("rule_verdict", F.lit(default))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
