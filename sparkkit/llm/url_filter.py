"""URL allow and block lists as a trie over reversed host labels and path segments (operator 2)."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from .common import free_name, small

ALLOW, BLOCK = "allow", "block"
HOST_PATH = re.compile(r"://([^/?#]*)([^?#]*)")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MAX_RULE_BYTES = 64 << 20  # a larger list has to be split by the caller: the trie is broadcast


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty without `://`."""
    found = HOST_PATH.search(url) if url else None
    return (found[1].translate(LOWER), found[2]) if found else ("", "")


class Trie:
    """Nodes are dicts: host labels from the top level down, then under `None` the path's segments.

    A path node maps whole segments to nodes; its entry `None` maps the beginning of the next segment, with
    which a rule's path ends, to the rule.
    """

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        if sum(len(h) + len(p) for h, p, _ in rules) > MAX_RULE_BYTES:
            raise ValueError("the rules are too large to broadcast")
        self.root: dict = {}
        for host, path, verdict in rules:
            if verdict not in (ALLOW, BLOCK):
                raise ValueError(f"unknown verdict {verdict!r}")
            node = self.root
            for label in reversed(host.translate(LOWER).split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, last = path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            ends = node.setdefault(None, {})
            # of equal rules the blocking one holds; under None is the length up to which beginnings are looked up
            if ends.get(last, (0, 0, ALLOW))[2] == ALLOW:
                ends[last] = (len(host) + len(path), len(host), verdict, host + path)
            ends[None] = max(ends.get(None, 0), len(last))

    def longest(self, host: str, path: str) -> tuple | None:
        """The longest rule (host and path together, then host) that fits."""
        best, segments = None, path.split("/")
        node = self.root
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            here = node.get(None)
            for segment in segments:
                if here is None:
                    break
                ends = here.get(None)
                for n in range(min(len(segment), ends[None]) + 1) if ends else ():
                    rule = ends.get(segment[:n])
                    if rule and (best is None or rule[:2] > best[:2]):
                        best = rule
                here = here.get(segment)
        return best


def filter_urls(rows: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url", default: str = ALLOW) -> DataFrame:
    """Add `host`, `path`, `rule`, `verdict` to every row.

    A rule (host, path, verdict) fits its host and all subdomains if the url's path starts with the rule's
    path.  The longest fitting rule decides, without one `default` does and `rule` is null.  A null url, or
    one without `://`, has an empty host and path.  Rows are independent: repeated rows get equal answers, an empty
    table gives an empty result.  If the table has a column of one of these names, the new one gets underscores before it.
    """
    trie = rows.sparkSession.sparkContext.broadcast(Trie(rules))
    new = [free_name(rows, n) for n in ("host", "path", "rule", "verdict")]
    names, at = rows.columns, rows.columns.index(url)

    def judge(batches):
        longest = trie.value.longest
        for b in small(batches):
            out: list[list] = [[], [], [], []]
            for text in b.column(at).to_pylist():
                host, path = split_url(text)
                found = longest(host, path)
                for column, value in zip(out, (host, path, found and found[3], found[2] if found else default)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, pa.string()) for c in out)], names=[*names, *new])

    return rows.mapInArrow(judge, StructType([*rows.schema.fields, *(StructField(n, StringType()) for n in new)]))
