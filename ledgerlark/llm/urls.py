"""URL verdicts from allow and block rules in a trie of reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlark.llm.common import broadcast

MAX_RULES = 1_000_000  # a larger list is refused, which bounds the broadcast


class Trie:
    """Rules under the labels of their host, last label first, then under their path's segments.

    A rule's last path segment may be the beginning of a longer one, so it is kept as a prefix
    at the node of the whole segments before it. The longest host wins, then the longest path;
    of an allow and a block rule with the same host and path, block wins.
    """

    HOSTS, PATHS, RULES = 0, 1, 2

    def __init__(self, rules: Sequence[tuple[str, str]]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules")
        self.root = self.node()
        for verdict, rule in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"{verdict}: a rule allows or blocks")
            host, slash, tail = rule.partition("/")
            self.add(host.translate(LOWER), slash + tail, rule, verdict)

    @staticmethod
    def node() -> tuple[dict, dict, dict]:
        return {}, {}, {}

    def add(self, host: str, path: str, rule: str, verdict: str) -> None:
        node = self.root
        for label in reversed(host.split(".")) if host else ():
            node = node[self.HOSTS].setdefault(label, self.node())
        *whole, last = path.split("/")
        for segment in whole:
            node = node[self.PATHS].setdefault(segment, self.node())
        if node[self.RULES].get(last, ("", ""))[1] != "block":
            node[self.RULES][last] = (rule, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest match, or None."""
        node, on_the_way = self.root, [self.root]
        for label in reversed(host.split(".")):
            node = node[self.HOSTS].get(label)
            if node is None:
                break
            on_the_way.append(node)
        segments = path.split("/")
        for node in reversed(on_the_way):
            found = None
            for segment in segments:
                fits = [p for p in node[self.RULES] if segment.startswith(p)]
                if fits:
                    found = node[self.RULES][max(fits, key=len)]
                node = node[self.PATHS].get(segment)
                if node is None:
                    break
            if found:
                return found
        return None


LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def parts(url: str | None) -> tuple[str, str]:
    """(host, path): the host ends at the first of ``/?#``, the path at the first of ``?#``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1].split("#", 1)[0].split("?", 1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(LOWER), slash + path


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], default: str = "allow", url: str = "url"
) -> DataFrame:
    """``pages`` packed in ``page`` (without other large columns: select first), with ``host, path, rule, verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's. Without a
    fitting rule the verdict is ``default`` and the rule null; so it is for a null or malformed
    url, whose host and path are empty. Each row is judged by itself; an empty table gives no rows.
    """
    trie = broadcast(pages.sparkSession, Trie(rules))
    lines = pages.select(F.struct(*pages.columns).alias("page"), F.col(url).cast("string").alias("url"))
    schema = lines.select("page").schema
    for name in ("host", "path", "rule", "verdict"):
        schema = schema.add(name, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = trie.value.find
        for batch in batches:
            cut = [parts(u) for u in batch.column("url").to_pylist()]
            found = [find(h, p) or (None, default) for h, p in cut]
            columns = [[h for h, _ in cut], [p for _, p in cut], [r for r, _ in found], [v for _, v in found]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page"), *[pa.array(c, pa.string()) for c in columns]],
                names=["page", "host", "path", "rule", "verdict"],
            )

    return lines.mapInArrow(run, schema)
