"""URL rules: a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.rows import LOWER, UPPER, add_columns, written

# Rules in one trie, which every task builds from a broadcast list: a rule takes some 1.8 KB
# there, so 200,000 take up to 360 MB of a task. More rules are matched in several passes.
RULES_PER_TRIE = 200_000


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def rank(self) -> list[int]:
        """Longer is greater: host labels, then the path; allow beats block."""
        return [self.host.count("."), len(self.path), int(self.verdict == "allow")]


def url_host(url: Column) -> Column:
    """From the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class _Paths:
    """Rules of one host by path segment; a rule may end inside a segment."""

    __slots__ = ("next", "ends")

    def __init__(self) -> None:
        self.next: dict[str, _Paths] = {}
        self.ends: list[tuple[str, Rule]] = []  # (start of the next segment, rule), longest first


class UrlTrie:
    """Longest match: more host labels first, then the longer path; allow beats block on a tie."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for rule in rules:
            if rule.verdict not in ("allow", "block"):
                raise ValueError(f"a rule allows or blocks: {rule}")
            node = self.root
            for label in reversed(rule.host.translate(str.maketrans(UPPER, LOWER)).split(".")):
                node = node.setdefault(label, {})
            paths = node.setdefault(None, _Paths())
            *whole, start = rule.path.split("/")
            for segment in whole:
                paths = paths.next.setdefault(segment, _Paths())
            paths.ends.append((start, rule))
            paths.ends.sort(key=lambda e: (-len(e[0]), e[1].verdict != "allow"))

    def match(self, host: str, path: str) -> Rule | None:
        best, node, segments = None, self.root, None
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                segments = segments or path.split("/")
                best = self._longest(node[None], segments) or best
        return best

    @staticmethod
    def _longest(paths: _Paths, segments: list[str]) -> Rule | None:
        best = None
        for segment in segments:
            for start, rule in paths.ends:
                if segment.startswith(start):
                    best = rule
                    break
            paths = paths.next.get(segment)
            if paths is None:
                break
        return best


def with_verdict(
    df: DataFrame,
    rules: Iterable[Rule],
    url: str = "url",
    default: str = "allow",
    rules_per_trie: int = RULES_PER_TRIE,
) -> DataFrame:
    """df with host, path, rule (text or null) and verdict of every url.

    A rule fits its host and all subdomains where the url's path starts with the
    rule's. Without a fitting rule the verdict is the default. A null url, an empty
    one or one without :// has empty host and path. Repeated rows are judged alike,
    an empty table gives an empty one, other columns pass through, and columns named
    like a result give way to it. Without rules every url gets the default.
    """
    rules = list(rules)
    source = F.col(f"`{url}`")
    out = df.withColumns({"host": url_host(source), "path": url_path(source)})
    for start in range(0, max(1, len(rules)), rules_per_trie):
        sent = df.sparkSession.sparkContext.broadcast(rules[start : start + rules_per_trie])

        def make(sent=sent, start=start):
            trie = UrlTrie(sent.value)

            def judge(batch):
                hosts, paths = (batch.column(c).to_pylist() for c in ("host", "path"))
                found = [trie.match(h, p) for h, p in zip(hosts, paths)]
                judged = [(r.text, r.verdict, r.rank) if r else (None, default, None) for r in found]
                if start:
                    before = zip(*(batch.column(c).to_pylist() for c in ("rule", "verdict", RANK)))
                    judged = [old if old[2] and old[2] >= (new[2] or []) else new for old, new in zip(before, judged)]
                kinds = (pa.string(), pa.string(), pa.list_(pa.int32()))
                return [pa.array([j[k] for j in judged], kind) for k, kind in enumerate(kinds)]

            return judge

        if start:
            out = written(out, "verdicts")
        out = add_columns(out, make, f"rule string, verdict string, {RANK} array<int>")
    return out.drop(RANK)


RANK = "_rule_rank"
