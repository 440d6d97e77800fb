"""URL filters: allow and block entries over hosts and paths, the longest fitting entry wins.

The entries form one trie: labels of the host from its end, then segments of the path, each with its closing slash. What
an entry's path has behind its last slash stays at the node as a prefix of the next segment. A trie whose text is within
a stated bound is broadcast and walked once for each url. Entries beyond the bound stay a table: a url then meets its
host's endings that have entries, and of those hosts the path's beginnings, by equi-joins.
"""

from __future__ import annotations

import string
from functools import partial

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from cardloom.llm.batches import Memo, arrow_fields, ddl, row_map
from cardloom.sources.tables import stage

BOUND = 32 << 20  # bytes of entries that may be broadcast
RULES = "host string, path string, verdict string"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (ascii_lower(F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit(""))),
            F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit("")))


def clean_rules(rules: DataFrame) -> DataFrame:
    """One verdict for each (host, path): of several the last in the alphabet, so ``block`` beats ``allow``.

    Entries with a null field are left out."""
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").dropna()
    return rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))


def segments(path: str) -> list[str]:
    """``/en/x`` gives ``/``, ``en/`` and ``x``; the last has no slash and may be empty."""
    parts = path.split("/")
    return [p + "/" for p in parts[:-1]] + [parts[-1]]


class Trie:
    """Nested dictionaries: ``hosts`` by label, its node's ``paths`` by segment."""

    def __init__(self, rules: list[tuple[str, str, str]]) -> None:
        self.root: dict = {"next": {}, "paths": None}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node["next"].setdefault(label, {"next": {}, "paths": None})
            if node["paths"] is None:
                node["paths"] = {"next": {}, "ends": []}
            node = node["paths"]
            *whole, open_end = segments(path)
            for segment in whole:
                node = node["next"].setdefault(segment, {"next": {}, "ends": []})
            # Compared as written: characters first, then the longer host.
            node["ends"].append((open_end, (len(host) + len(path), len(host), host + path, verdict)))

    def path_tries(self, host: str) -> list[dict]:
        """The path tries of all entries whose host is ``host`` or a domain above it."""
        found, node = [], self.root
        for label in reversed(host.split(".")):
            node = node["next"].get(label)
            if node is None:
                break
            if node["paths"] is not None:
                found.append(node["paths"])
        return found

    @staticmethod
    def longest(tries: list[dict], path: str) -> tuple[str | None, str | None]:
        """(rule, verdict) of the longest entry that ``path`` begins with."""
        best = None
        for node in tries:
            for segment in segments(path):
                for open_end, entry in node["ends"]:
                    if segment.startswith(open_end) and (best is None or entry > best):
                        best = entry
                node = node["next"].get(segment)
                if node is None:
                    break
        return best[2:] if best else (None, None)


def _walk(batch: pa.RecordBatch, trie: Broadcast):
    tries = Memo(trie.value.path_tries, limit=100_000)
    keys, hosts, paths = (c.to_pylist() for c in batch.columns)
    for key, host, path in zip(keys, hosts, paths):
        yield key, host, path, *trie.value.longest(tries[host], path)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id", url: str = "url",
          bound: int = BOUND) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` (host and path of the longest fitting entry, else null) and ``verdict`` (its
    verdict, else ``default``) of every row.

    ``rules`` has ``host``, ``path`` and ``verdict``. An entry fits its host and all below it, for paths that begin with
    its own. The longest has most characters in host and path together, of equals the longer host. A null url and one
    without ``://`` have an empty host and path, which an entry may name. Null keys and repeated rows stay, other columns
    are left out, and an empty table gives an empty table. Entries of more than ``bound`` bytes are joined, not broadcast.
    """
    host, path = host_and_path(F.col(url))
    found = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    entries = clean_rules(rules)
    size = entries.agg(F.sum(F.octet_length("host") + F.octet_length("path") + F.octet_length("verdict"))).first()[0] or 0
    judged = _by_broadcast(found, key, entries) if size <= bound else _by_join(found, entries)
    return judged.select(key, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _by_broadcast(found: DataFrame, key: str, entries: DataFrame) -> DataFrame:
    trie = found.sparkSession.sparkContext.broadcast(Trie([tuple(r) for r in entries.collect()]))  # within the bound
    text = ["host", "path", "rule", "verdict"]
    schema = pa.schema([*arrow_fields(found, [key]), *[(c, pa.string()) for c in text]])
    return found.mapInArrow(row_map(partial(_walk, trie=trie), schema), f"{ddl(found, [key])}, " + ", ".join(f"{c} string" for c in text))


def _by_join(found: DataFrame, entries: DataFrame) -> DataFrame:
    whole = F.regexp_extract("path", "^(?s:.*)/", 0)  # up to the last slash
    ruled = stage(entries.select("host", "path", "verdict", whole.alias("whole"), F.substring("path", F.length(whole) + 1, F.length("path")).alias("open"),
                                 F.regexp_count("path", F.lit("/")).alias("depth")), "rules")
    hosts = stage(ruled.groupBy("host").agg(F.max("depth").alias("deepest")), "rule_hosts")
    distinct = found.select("host", "path").distinct()
    labels = F.split("host", r"\.", -1)
    endings = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = (distinct.select("host", "path", F.explode(endings).alias("above"))
           .join(hosts.withColumnRenamed("host", "above"), "above"))
    parts = F.split("path", "(?<=/)", -1)
    reach = F.least(F.col("deepest"), F.regexp_count("path", F.lit("/")))
    beginnings = F.transform(F.sequence(F.lit(0), reach), lambda i: F.array_join(F.slice(parts, 1, i), ""))
    tried = met.select("host", "path", "above", F.explode(beginnings).alias("whole"))
    fits = (tried.join(ruled.select(F.col("host").alias("above"), "whole", "open", F.col("path").alias("rule_path"), "verdict"), ["above", "whole"])
            .where(F.startswith(F.substring("path", F.length("whole") + 1, F.length("path")), F.col("open"))))
    entry = F.struct((F.length("above") + F.length("rule_path")).alias("n"), F.length("above").alias("h"),
                     F.concat("above", "rule_path").alias("rule"), "verdict")
    best = fits.groupBy("host", "path").agg(F.max(entry).alias("e"))
    return found.join(stage(best, "verdicts"), ["host", "path"], "left").select(*found.columns, "e.rule", "e.verdict")


# The entries of the registered query.
ENTRIES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]

VERDICT_SQL = """
WITH rules(h, p, v) AS (VALUES """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in ENTRIES) + f"""),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
urls AS (SELECT DISTINCT host, path FROM parts),
best AS (SELECT host, path, max(struct_pack(n := length(h || p), hn := length(h), rule := h || p, v := v)) AS e FROM urls JOIN rules
         ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, parts.host, parts.path, e.rule AS rule, coalesce(e.v, 'allow') AS verdict
FROM parts LEFT JOIN best ON parts.host = best.host AND parts.path = best.path"""
