"""URL filter: a trie over reversed host labels, then path segments; the longest matching entry decides."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Past so many characters of entries the trie is not broadcast; entries are joined by host instead.
MAX_BROADCAST_CHARS = 16_000_000

Entry = tuple[str, str, str]  # host, path prefix, allow or block


def host_of(url: Column) -> Column:
    """From after the first `://` up to /, ?, # or the end, A-Z lower-cased; empty for null or without `://`."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ?, # or the end; empty for null or without `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def build(entries: Iterable[Entry]) -> dict:
    """Nodes are dicts: host labels lead to nodes; "/" leads to the node's path trie.

    In a path trie, whole segments lead to nodes; an entry ends at a node in "=" as a list of
    (rest of a segment that the next one must start with, rule, verdict), the longest rest first.
    """
    root: dict = {}
    for host, path, verdict in entries:
        node = root
        for label in reversed(host.split(".")) if host else ():
            node = node.setdefault("h:" + label, {})
        node = node.setdefault("/", {})
        *whole, rest = path.split("/")
        for segment in whole:
            node = node.setdefault("p:" + segment, {})
        node.setdefault("=", []).append((rest, host + path, verdict))
        node["="].sort(key=lambda end: (-len(end[0]), end[2] != "block"))
    return root


def _longest_path(node: dict, segments: Sequence[str]) -> Iterator[tuple[str, str]]:
    for i, segment in enumerate(segments):
        for rest, rule, verdict in node.get("=", ()):
            if segment.startswith(rest):
                yield rule, verdict
                break
        if i == len(segments) - 1 or (node := node.get("p:" + segment)) is None:
            return


def match(root: dict, host: str, path: str) -> tuple[str, str] | None:
    """The longest entry (host and path characters together; block before allow if equal) that fits."""
    found, segments, node = [], path.split("/"), root
    labels = iter(reversed(host.split(".")))
    while node is not None:
        if "/" in node:
            found += _longest_path(node["/"], segments)
        label = next(labels, None)
        node = None if label is None else node.get("h:" + label)
    return max(found, key=lambda r: (len(r[0]), r[1] == "block")) if found else None


def judged(pages: DataFrame, entries: Sequence[Entry], url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict; columns of these names are replaced.

    An entry fits its host and all subdomains, if the path starts with the entry's. Among those that fit the longest
    decides, block before allow if they are equally long; without any the rule is null and the verdict `default`.
    A null url, or one without `://`, has an empty host and path, which only entries with an empty host and path fit.
    """
    df = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    entries = sorted(set(entries))
    if sum(len(host) + len(path) for host, path, _ in entries) > MAX_BROADCAST_CHARS:
        return _joined(df, entries, default)
    trie = pages.sparkSession.sparkContext.broadcast(build(entries))

    @F.pandas_udf("rule string, verdict string")
    def look_up(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        root = trie.value
        found = [match(root, h, p) or (None, default) for h, p in zip(hosts, paths, strict=True)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    df = df.withColumn("found_", look_up("host", "path"))
    return df.withColumns({"rule": F.col("found_.rule"), "verdict": F.col("found_.verdict")}).drop("found_")


def _joined(df: DataFrame, entries: Sequence[Entry], default: str) -> DataFrame:
    """The same by a join on hosts and their parent domains, for entries too many to broadcast."""
    spark = df.sparkSession
    rules = spark.createDataFrame(list(entries), "entry_host string, entry_path string, entry_verdict string")
    labels = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(0), F.size(labels)), lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")
    )
    keys = df.select("host", "path").distinct().withColumn("entry_host", F.explode(F.array_distinct(parents)))
    fits = keys.join(rules, "entry_host").filter(F.expr("startswith(path, entry_path)"))
    rule = F.concat("entry_host", "entry_path")
    order = F.struct(F.length(rule), (F.col("entry_verdict") == "block"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct(rule.alias("rule"), F.col("entry_verdict").alias("verdict")), order).alias("best_"))
    out = df.drop("rule", "verdict").join(best, ["host", "path"], "left")
    return out.withColumns({"rule": F.col("best_.rule"), "verdict": F.coalesce("best_.verdict", F.lit(default))}).drop("best_")
