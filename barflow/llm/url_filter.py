"""URL filter: a broadcast trie over reversed host labels and path segments.

A rule (host, path, verdict) fits its host and all subdomains when the path of
the url starts with the rule's path. The deepest host label wins, then the
longest path; between equal rules block wins over allow. The trie is broadcast
in parts of at most ``max_rules`` rules each, a proven bound; a longer list is
judged part by part, carrying the best match on.

Defined results: a null url or one without ``://`` has an empty host and path;
what no rule fits gets ``default``; an empty table gives no rows; repeated rows
are judged each. Only the url column is read by the trie, so other columns
cannot clash with it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 200_000
RULES_HERE = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


class Node:
    """A host label or a path segment; ``ends`` maps the rest of a rule to (verdict, rule)."""

    __slots__ = ("below", "ends", "paths", "reach", "whole")

    def __init__(self) -> None:
        self.below: dict[str, Node] = {}
        self.ends: dict[str, tuple[str, str]] = {}
        self.reach = 0
        self.paths: Node | None = None
        self.whole: tuple[str, str] | None = None


def _place(slot: tuple[str, str] | None, verdict: str, rule: str) -> tuple[str, str]:
    return (verdict, rule) if slot is None or verdict == "block" else slot


def build_trie(rules: Iterable[tuple[str, str, str]]) -> Node:
    root = Node()
    for host, path, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict {verdict!r} is neither allow nor block")
        node = root
        for label in reversed(host.split(".")):
            node = node.below.setdefault(label, Node())
        rule = host + path
        if not path:
            node.whole = _place(node.whole, verdict, rule)
            continue
        node.paths = at = node.paths or Node()
        *segments, last = path.split("/")
        for segment in segments:
            at = at.below.setdefault(segment, Node())
        at.ends[last] = _place(at.ends.get(last), verdict, rule)
        at.reach = max(at.reach, len(last))
    return root


def _longest_path(at: Node | None, path: str) -> tuple[int, tuple[str, str]] | None:
    """The longest rule path that ``path`` starts with, as (its length, slot)."""
    best, done = None, 0
    parts = path.split("/")
    for i, part in enumerate(parts):
        if at is None:
            break
        if at.ends:
            for n in range(min(len(part), at.reach), -1, -1):
                if (slot := at.ends.get(part[:n])) is not None:
                    best = (done + n, slot)
                    break
        if i + 1 < len(parts):
            at = at.below.get(part)
            done += len(part) + 1
    return best


def match(root: Node, host: str, path: str) -> tuple[int, int, str, str] | None:
    """(labels, path length, verdict, rule) of the winning rule."""
    best, node = None, root
    for depth, label in enumerate(reversed(host.split(".")), 1):
        node = node.below.get(label)
        if node is None:
            break
        found = _longest_path(node.paths, path)
        if found:
            best = (depth, found[0], *found[1])
        elif node.whole:
            best = (depth, 0, *node.whole)
    return best


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://(.*)\z", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return host, path


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    url: str = "url",
    default: str = "allow",
    max_rules: int = MAX_RULES,
) -> DataFrame:
    """``row`` (the page's columns), host, path, rule (null: none) and verdict."""
    spark = pages.sparkSession
    host, path = url_parts(pages[url].cast("string"))
    row = F.struct(*[pages[c] for c in pages.columns])
    none = F.lit(None).cast("struct<labels:int, length:int, verdict:string, rule:string>")
    out = pages.select(row.alias("row"), host.alias("host"), path.alias("path"), none.alias("best"))
    for start in range(0, len(rules), max_rules):
        shared = spark.sparkContext.broadcast(rules[start : start + max_rules])

        @F.pandas_udf("labels int, length int, verdict string, rule string")
        def fits(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            root = build_trie(shared.value)
            for hosts, paths in batches:
                found = [match(root, h, p) or (None,) * 4 for h, p in zip(hosts, paths, strict=True)]
                yield pd.DataFrame(found, columns=["labels", "length", "verdict", "rule"]).astype(
                    {"labels": "Int32", "length": "Int32", "verdict": object, "rule": object}
                )

        this = out.withColumn("part", fits("host", "path"))
        newer = F.col("part.labels").isNotNull() & (
            F.col("best.labels").isNull()
            | (F.struct("part.labels", "part.length") > F.struct("best.labels", "best.length"))
            | (
                (F.struct("part.labels", "part.length") == F.struct("best.labels", "best.length"))
                & (F.col("part.verdict") == "block")
            )
        )
        out = this.withColumn("best", F.when(newer, F.col("part")).otherwise(F.col("best"))).drop("part")
    return out.select(
        "row", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
