"""URL rules in a sorted digest array.

All entries, rules and listed hosts alike, are strings ``host/path``. Their 64-bit xxhash keys lie
sorted in one file, with the strings behind them; every executor fetches the file and maps it into
memory. A url is probed with the suffixes of its host and the prefixes of its path for which
entries of that many labels and characters exist: all probes of a batch in one binary search, and
a found key counts only if the stored string is the probe.

The longest rule that fits gives the verdict; without one, a url is blocked when a listed host is
its host or above it.

Nulls: a null url, or one without ``://``, has an empty host and path, which no entry fits.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from triagelake.llm.common import map_columns, share_file, table

BLOCK, ALLOW, LISTED = 0, 1, 2
#: The rules, and the hosts that are blocked where no rule fits.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_HOSTS = tuple(f"{name}.example.{top}" for name in NAMES for top in ("com", "net", "org"))

LOWER = {c: c + 32 for c in range(65, 91)}
HOST = re.compile("[^/?#]*")
PATH = re.compile("[^?#]*")


def parse(url: str | None) -> tuple[str, str]:
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    host = HOST.match(url, at + 3)
    return host.group().translate(LOWER), PATH.match(url, host.end()).group()


def build(entries: list[tuple[str, int]]) -> bytes:
    """The file: number of entries, sorted keys, kinds, ends of the strings, the strings."""
    coded = sorted((xxhash.xxh64_intdigest(e.encode()), e.encode(), kind) for e, kind in entries)
    return b"".join([
        np.array([len(coded)], "<u8").tobytes(),
        np.array([k for k, _, _ in coded], "<u8").tobytes(),
        np.array([kind for _, _, kind in coded], "<u8").tobytes(),
        np.cumsum([len(e) for _, e, _ in coded], dtype="<u8").tobytes(),
        b"".join(e for _, e, _ in coded),
    ])


class DigestArray:
    """The mapped file. ``hash_`` is a parameter so that tests can make keys collide."""

    def __init__(self, path: str, hash_=xxhash.xxh64_intdigest):
        self.hash = hash_
        mapped = np.memmap(path, np.uint8, "r")
        n = int(mapped[:8].view("<u8")[0])
        cells = mapped[8 : 8 + 24 * n].view("<u8")
        self.keys, self.kinds, self.ends = cells[:n], cells[n : 2 * n], cells[2 * n :]
        self.strings = mapped[8 + 24 * n :]
        self.labels, self.lengths = set(), set()
        for i in range(n):
            host, _, rest = self.entry(i).partition(b"/")
            self.labels.add(host.count(b".") + 1)
            self.lengths.add(len(rest.decode()) + 1)

    def entry(self, i: int) -> bytes:
        start = int(self.ends[i - 1]) if i else 0
        return self.strings[start : int(self.ends[i])].tobytes()

    def probes(self, host: str, path: str) -> list[str]:
        """Every entry string that would fit."""
        prefixes = [path[:n] for n in self.lengths if len(path) >= n]
        parts = host.rsplit(".", max(self.labels, default=0))
        return [".".join(parts[-n:]) + p for n in self.labels if n <= len(parts) for p in prefixes] if prefixes else []

    def look_up(self, probes: list[str]) -> list[list[int]]:
        """Numbers of the entries equal to each probe."""
        keys = np.array([self.hash(p.encode()) for p in probes], np.uint64)
        low = np.searchsorted(self.keys, keys, "left")
        high = np.searchsorted(self.keys, keys, "right")
        found: list[list[int]] = [[] for _ in probes]
        for k in np.flatnonzero(low < high).tolist():
            text = probes[k].encode()
            found[k] = [i for i in range(int(low[k]), int(high[k])) if self.entry(i) == text]
        return found

    def judge(self, parsed: list[tuple[str, str]]) -> list[tuple[str | None, str]]:
        probes, owner = [], []
        for k, (host, path) in enumerate(parsed):
            # with an empty path a listed host fits all the same, but no rule does
            own = self.probes(host, path or "/")
            probes += own
            owner += [k] * len(own)
        rules: list[str | None] = [None] * len(parsed)
        verdicts = ["allow"] * len(parsed)
        for k, probe, entries in zip(owner, probes, self.look_up(probes) if probes else []):
            for kind in (int(self.kinds[i]) for i in entries):
                if kind == LISTED:
                    verdicts[k] = verdicts[k] if rules[k] else "block"
                elif parsed[k][1] and (rules[k] is None or len(probe) > len(rules[k])):
                    rules[k], verdicts[k] = probe, "block" if kind == BLOCK else "allow"
        return list(zip(rules, verdicts))


def share_rules(spark: SparkSession, rules=RULES, listed=LISTED_HOSTS) -> str:
    kinds = {"block": BLOCK, "allow": ALLOW}
    entries = [(r, kinds[v]) for r, v in rules] + [(h + "/", LISTED) for h in listed]
    return share_file(spark, build(entries), "digests")


def filter_urls(pages: DataFrame, rules=RULES, listed=LISTED_HOSTS) -> DataFrame:
    """``pages`` with host, path, rule and verdict of their ``url``."""
    name = share_rules(pages.sparkSession, rules, listed)

    def make():
        array = DigestArray(SparkFiles.get(name))

        def work(urls):
            parsed = [parse(u) for u in urls]
            judged = array.judge(parsed)
            return [h for h, _ in parsed], [p for _, p in parsed], [r for r, _ in judged], [v for _, v in judged]

        return work

    return map_columns(pages, ["url"], "host string, path string, rule string, verdict string", make)


def op7_digest_array(spark, sf_dir: str) -> DataFrame:
    judged = filter_urls(table(spark, sf_dir, "pages", "page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _fits(rule: str) -> str:
    host, _, path = rule.partition("/")
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}'))"


OP7_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), hosts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut
), parsed AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts
), ruled AS (
  SELECT *, CASE {" ".join(f"WHEN {_fits(r)} THEN '{r}'" for r, _ in sorted(RULES, key=lambda r: -len(r[0])))} END AS rule FROM parsed
)
SELECT page_id, host, path, rule,
  CASE {" ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in RULES)}
       WHEN {" OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in LISTED_HOSTS)} THEN 'block'
       ELSE 'allow' END AS verdict
FROM ruled
"""
