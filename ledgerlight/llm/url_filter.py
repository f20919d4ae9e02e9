"""URL filters: a sort-merge range join of urls with host/path rules.

A reversed host (``com.example.www.``) turns "this host and all subdomains"
into an interval of keys: everything that starts with the rule's key. Two such
intervals are nested or apart, so a sweep over sorted urls needs only a stack of
the rules that are open at the present key. Spark sorts the urls of each
partition (with spill); no url is shuffled, so a host with a third of all
urls stays spread over its partitions. Rules travel as a broadcast of a checked size:
``MAX_RULES`` at a time, further ones in further sweeps over the result.

Defined cases: a null url, or one without ``://``, has empty host and path
and no rule; rows are kept one for one, repeated ``page_id`` included; of equal rules with
different verdicts ``block`` wins; an empty rule list leaves the default verdict; columns of
other names pass through only by ``page_id``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules that one sweep broadcasts (about 20 MB at 100 bytes a rule).
MAX_RULES = 200_000
DEFAULT_VERDICT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


def _reversed_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _sweep(rules: list[tuple[str, str, str, str]]):
    """A function that gives each row of key-sorted batches its longest rule.
    ``rules``: (key, path, rule, verdict) sorted by key in UTF-8 order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[tuple[str, list]] = []          # open intervals, the innermost last
        at, last = 0, None
        for batch in batches:
            names, verdicts = [], []
            for key, path, old, old_verdict in zip(batch["key"], batch["path"], batch["rule"], batch["verdict"]):
                if key != last:
                    last = key
                    code = key.encode("utf-8", "surrogatepass")
                    while at < len(rules) and rules[at][0].encode("utf-8", "surrogatepass") <= code:
                        start = rules[at][0]
                        while stack and not start.startswith(stack[-1][0]):
                            stack.pop()
                        if stack and stack[-1][0] == start:
                            stack[-1][1].append(rules[at])
                        else:
                            stack.append((start, [rules[at]]))
                        at += 1
                    while stack and not key.startswith(stack[-1][0]):
                        stack.pop()
                best, verdict = old, old_verdict
                for _, group in stack:
                    for _, prefix, rule, says in group:
                        if path.startswith(prefix) and (best is None or len(rule) > len(best)):
                            best, verdict = rule, says
                names.append(best)
                verdicts.append(verdict)
            yield batch.assign(rule=pd.Series(names, dtype=object, index=batch.index),
                               verdict=pd.Series(verdicts, dtype=object, index=batch.index))

    return run


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = DEFAULT_VERDICT,
               max_rules: int = MAX_RULES) -> DataFrame:
    """``pages`` (page_id, url) with host, path, the longest fitting rule and
    the verdict. ``rules``: (verdict, host, path); the host fits itself and its
    subdomains, the path is a prefix."""
    unique: dict[str, tuple[str, str, str, str]] = {}
    for verdict, host, path in rules:
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        if unique.get(host + path, ("",) * 4)[3] != "block":
            unique[host + path] = (reversed_key(host), path, host + path, verdict)
    ordered = sorted(unique.values(), key=lambda r: (r[0].encode(), r[1].encode()))
    swept = (pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
             .select("page_id", "host", "path", _reversed_key(F.col("host")).alias("key"),
                     F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
             .sortWithinPartitions("key"))
    for i in range(0, max(len(ordered), 1), max_rules):
        part = ordered[i:i + max_rules]
        if i:
            swept = swept.sortWithinPartitions("key")
        swept = swept.mapInPandas(_sweep(part), swept.schema)
    return swept.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
