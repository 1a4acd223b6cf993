"""URL filters: one trie over reversed host labels and path segments."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm import _store

#: The rules are broadcast; a larger set is refused.
MAX_RULE_BYTES = 64 << 20

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class UrlRule:
    """action is allow or block; path starts with a slash or is empty."""

    action: str
    host: str
    path: str = "/"

    @classmethod
    def parse(cls, action: str, rule: str) -> UrlRule:
        host, slash, path = rule.partition("/")
        return cls(action, host.translate(_LOWER), slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): after the first ://, host A-Z lower-cased; both empty without it."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host_end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path_end = min((i for i in (rest.find(c, host_end) for c in "?#") if i >= 0), default=len(rest))
    return rest[:host_end].translate(_LOWER), rest[host_end:path_end]


class UrlTrie:
    """Host labels from the right, then path segments from the left.

    A node is [children, path root, rules]. A path rule ends at a node for its
    closed segments; what follows its last slash is kept there as an open rest,
    to be compared as a prefix.
    """

    def __init__(self, rules: Iterable[UrlRule]):
        self.root: list = [{}, None, None]
        for rule in rules:
            if rule.action not in ("allow", "block"):
                raise ValueError(f"unknown action {rule.action!r}")
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node[0].setdefault(label, [{}, None, None])
            if node[1] is None:
                node[1] = [{}, None, None]
            node = node[1]
            *closed, rest = rule.path.split("/")
            for segment in closed:
                node = node[0].setdefault(segment, [{}, None, None])
            if node[2] is None:
                node[2] = {}
            had = node[2].get(rest)
            if had is None or rule.action == "block":  # block wins between equal rules
                node[2][rest] = (len(rule.text), rule.text, rule.action)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, action) of the longest rule that fits, by characters; at a tie the longer host."""
        best, segments, node = None, path.split("/"), self.root
        for label in reversed(host.split(".")):
            node = node[0].get(label)
            if node is None:
                break
            if node[1] is None:
                continue
            at, i = node[1], 0
            while at is not None:
                if at[2]:
                    tail = "/".join(segments[i:]) if len(at[2]) > 1 or "" not in at[2] else ""
                    for rest, found in at[2].items():
                        if tail.startswith(rest) and (best is None or found[0] >= best[0]):
                            best = found
                if i >= len(segments) - 1:  # the last segment isn't closed by a slash
                    break
                at, i = at[0].get(segments[i]), i + 1
        return best and (best[1], best[2])


def judge_urls(df: DataFrame, rules: Iterable[UrlRule], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Verdict on each row's url: id, host, path, rule (null where none fits), verdict.

    A rule fits its host and all subdomains where the url's path starts with the
    rule's; the longest wins, between equals a block. Null and odd urls have an
    empty host and path and get the default. Repeated rows are judged each for
    itself; other columns of df are not read, whatever their names.
    """
    if default not in ("allow", "block"):
        raise ValueError(f"unknown default {default!r}")
    spark = df.sparkSession
    _store.prepare(spark)
    trie = UrlTrie(rules)
    if (size := len(pickle.dumps(trie))) > MAX_RULE_BYTES:
        raise ValueError(f"the rules take {size} bytes; at most {MAX_RULE_BYTES} are broadcast")
    shared = spark.sparkContext.broadcast(trie)
    narrow = df.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{url_col}`").cast("string").alias("__url"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value.find
        for batch in batches:
            hosts, paths, names, verdicts = [], [], [], []
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                rule, verdict = find(host, path) or (None, default)
                hosts.append(host)
                paths.append(path)
                names.append(rule)
                verdicts.append(verdict)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.string()) for x in (hosts, paths, names, verdicts))], [id_col, "host", "path", "rule", "verdict"])

    kind = narrow.schema[id_col].dataType.simpleString()
    return narrow.mapInArrow(judge, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")
