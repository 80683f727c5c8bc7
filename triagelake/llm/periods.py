"""Runs of repeated words, found with suffix trees.

A run is a stretch with smallest period q and at least ``max(SHORTEST, 2 * q)`` words that no neighbouring word extends.

1. Every word of a run is covered by a sequence of ``GRAM`` words that occurs twice in the text. Stretches of
   covered words are told by hashes of such sequences (a collision only makes a stretch longer); words outside
   them are in no run, and no run leaves its stretch. Prose ends here.
2. A stretch becomes two suffix trees (Ukkonen), of its words and of their reversal. An Euler tour in
   the order of the symbols gives the order of the suffixes and, kept as the lowest depth between neighbouring leaves
   in a table of minima, the lowest common ancestor of two leaves, and with it the
   length of what two places share, in constant time and for all candidates at once.
3. Each run has a Lyndon root of its period under the order of the symbols or under its reverse. The longest
   Lyndon word at a place ends at the next smaller suffix. These words, two a place, are the candidates; each is
   extended in both directions and is a run if that covers its period twice.

Null and blank texts have no words and no runs. A text is one task's work: about 0.5 kB of memory for
each word of a stretch. Words are kept as they are; ties between runs are settled by the queries. Repeated rows and
rows of one or of no doc_id are documents of their own, an empty table gives no rows, and of further columns none is
read, so that their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import map_columns, table

SHORTEST = 12
#: Half of ``SHORTEST``: with longer sequences a run of the shortest kind would not be covered.
GRAM = SHORTEST // 2
_ODD = 0x9E3779B97F4A7C15


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches of words in a sequence of ``GRAM`` words that occurs again."""
    n = len(ids) - GRAM + 1
    if n <= GRAM:
        return []
    key = np.zeros(n, np.uint64)
    for k in range(GRAM):
        key = (key ^ ids[k : k + n].astype(np.uint64)) * np.uint64(_ODD)
        key ^= key >> np.uint64(29)
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    starts = np.flatnonzero(again)
    if not len(starts):
        return []
    new = np.flatnonzero(np.diff(starts) > GRAM) + 1  # the next sequence does not touch this one
    first = starts[np.concatenate([[0], new])]
    last = starts[np.concatenate([new - 1, [len(starts) - 1]])] + GRAM
    return [(int(a), int(b)) for a, b in zip(first, last) if b - a >= SHORTEST]


class SuffixTree:
    """Ukkonen's tree of symbols 1, 2, ..., closed by 0."""

    def __init__(self, symbols: np.ndarray):
        text = [*symbols.tolist(), 0]
        self.n = len(text)
        self.width = width = int(symbols.max(initial=0)) + 1
        begin, stop, link, edges, open_end = [0], [0], [0], {}, self.n
        node = edge = length = todo = 0
        for i, symbol in enumerate(text):
            waiting, todo = 0, todo + 1
            while todo:
                if not length:
                    edge = i
                key = node * width + text[edge]
                below = edges.get(key)
                if below is None:
                    edges[key] = len(begin)
                    begin.append(i), stop.append(open_end), link.append(0)
                    if waiting:
                        link[waiting] = node
                    waiting = node
                else:
                    size = stop[below] - begin[below]
                    if length >= size:
                        node, edge, length = below, edge + size, length - size
                        continue
                    if text[begin[below] + length] == symbol:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    cut = begin[below] + length
                    middle = edges[key] = len(begin)
                    edges[middle * width + symbol] = middle + 1
                    edges[middle * width + text[cut]] = below
                    begin += begin[below], i
                    stop += cut, open_end
                    link += 0, 0
                    begin[below] = cut
                    if waiting:
                        link[waiting] = middle
                    waiting = middle
                todo -= 1
                if node:
                    node = link[node]
                elif length:
                    length, edge = length - 1, i - todo + 1
        del link
        self.size = np.array(stop) - np.array(begin)
        self.leaf = np.array(stop) == open_end
        self.leaf[0] = False
        places = np.fromiter(edges.keys(), np.int64, len(edges))
        self.child = np.fromiter(edges.values(), np.int64, len(edges))
        self.parent, self.symbol = np.divmod(places, width)

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(order, low): the suffixes as an Euler tour meets them, the end symbol first under both orders, and the
        lowest depth that the tour reaches between a leaf and the one before it."""
        symbol = np.where(self.symbol > 0, self.width - self.symbol, 0) if reverse else self.symbol
        by = np.lexsort((-symbol, self.parent))  # the stack turns the order round
        child, ends = self.child[by].tolist(), np.cumsum(np.bincount(self.parent, minlength=len(self.size)))
        begins, ends = (ends - np.bincount(self.parent, minlength=len(self.size))).tolist(), ends.tolist()
        size, leaf, depth = self.size.tolist(), self.leaf.tolist(), [0] * len(self.size)
        first = [False] * len(size)
        for a, b in zip(begins, ends):
            if b > a:
                first[child[b - 1]] = True
        order, low, lowest, stack, above = [], [], 0, [0], [0] * len(size)
        while stack:
            at = stack.pop()
            up = above[at]
            if not first[at]:
                lowest = up
            if leaf[at]:
                order.append(at)
                low.append(lowest)
                continue
            depth[at] = down = up + size[at]
            for c in child[begins[at] : ends[at]]:
                above[c] = down
                stack.append(c)
        # leaves were made in the order of their suffixes
        number = np.cumsum(self.leaf) - 1
        return number[order], np.array(low)


class Shared:
    """The length of what the suffixes at two places share, from the lowest common ancestor of their leaves."""

    def __init__(self, order: np.ndarray, low: np.ndarray):
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self.low = [low.astype(np.int32)]
        width = 1
        while width * 2 <= len(low):
            self.low.append(np.minimum(self.low[-1][:-width], self.low[-1][width:]))
            width *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places i <> j."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp(b - a)[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.low[k][a[at]], self.low[k][b[at] - (1 << k)])
        return out


def lyndon_words(rank: np.ndarray) -> np.ndarray:
    """The length of the longest Lyndon word at every place: up to the next smaller suffix."""
    ranks, out, stack = rank.tolist(), np.zeros(len(rank) - 1, np.int64), [len(rank) - 1]
    for i in range(len(rank) - 2, -1, -1):
        while ranks[stack[-1]] > ranks[i]:
            stack.pop()
        out[i] = stack[-1] - i
        stack.append(i)
    return out


def find_runs(ids: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """(start, length, period) rows of all runs of at least ``shortest`` symbols, by start and period."""
    n = len(ids)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    symbols = np.unique(ids, return_inverse=True)[1] + 1
    tree = SuffixTree(symbols)
    forward = Shared(*tree.tour())
    turned = np.empty(n + 1, np.int64)
    turned[tree.tour(reverse=True)[0]] = np.arange(n + 1)
    del tree
    backward = Shared(*SuffixTree(symbols[::-1]).tour())
    place = np.tile(np.arange(n), 2)
    period = np.concatenate([lyndon_words(forward.rank), lyndon_words(turned)])
    right = forward(place, place + period)
    left = np.zeros(len(place), np.int64)
    inner = place > 0  # the words before two places lie, turned round, at n - place
    left[inner] = backward(n - place[inner], n - place[inner] - period[inner])
    found = np.stack([place - left, left + period + right, period], 1)
    found = found[(found[:, 1] >= 2 * period) & (found[:, 1] >= shortest)]
    return np.unique(found, axis=0)


def runs_of(ids: np.ndarray) -> np.ndarray:
    """(start, length, period) rows of a text given as word numbers, by start, then period."""
    parts = []
    for start, end in stretches(ids):
        found = find_runs(ids[start:end])
        found[:, 0] += start
        parts.append(found)
    found = np.concatenate([np.zeros((0, 3), np.int64), *parts])
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """Which words stay: of every run the first period."""
    gone = np.zeros(n + 1, np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 0] + found[:, 1], -1)
    return np.cumsum(gone[:-1]) == 0


def periodic_runs(docs: DataFrame, reshape: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of ``docs`` (doc_id, text): all runs as (start, length, period), and the
    text without their repetitions, its words joined by blanks. ``reshape`` may give, for a doc_id and a
    number of words, the places of the words to take instead."""

    def one(doc: int | None, text: str | None):
        words = (text or "").encode().split()
        n = len(words)
        if reshape is not None and n and (places := reshape(doc, n)) is not None:
            words = [words[i] for i in places.tolist()]
            n = len(words)
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
        found = runs_of(ids)
        if len(found):
            words = [w for w, k in zip(words, kept_words(n, found).tolist()) if k]
        rows = [{"start": s, "length": k, "period": q} for s, k, q in found.tolist()]
        return n, rows, b" ".join(words).decode()

    def make():
        return lambda ids, texts: tuple(map(list, zip(*map(one, ids, texts))))

    shape = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return map_columns(docs.select("doc_id", "text"), ["doc_id", "text"], shape, make, drop=("text",))


def planted(doc: int | None, n: int) -> np.ndarray | None:
    """The contract's periodic copies: of every tenth document by checksum, from a word on."""
    if doc is None or (h := crc32(str(doc).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def op13_tree_runs(spark, sf_dir: str) -> DataFrame:
    runs = periodic_runs(table(spark, sf_dir, "documents", "doc_id", "text"), planted)
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return runs.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.length")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * -best.length) div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )
