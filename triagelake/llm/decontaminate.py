"""Passages of test items found in training texts with a generalised suffix automaton.

All items go into one automaton over words. A text streams through it; the state after each word
tells the longest stretch of words, ending there, that occurs in some item. A window is
``window`` (10) consecutive words of an item, or a whole shorter item; wherever one occurs, its
words are hit. ``decontaminate`` removes hit words and drops texts of which more than a stated
share is hit.

The automaton is sent to every task. It has at most two states a word, so its size is bounded by
``max_words``: items beyond that go into further automata, one pass over the texts each, and the
hits of all passes are joined per text.

Nulls: a null text has no words; an item without words is no window; items without an id
match like others and are listed as ``null``.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import fresh, map_columns, sha256, table
from triagelake.session import materialise

WINDOW = 10
MAX_WORDS = 1_000_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Of UTF-8: A-Z in lower case, every other byte that is in no word becomes a blank.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


class Automaton:
    """Suffix automaton of all ``items`` (id, words), with the windows that end in each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            if words:
                coded.append((name, [self.ids.setdefault(w, len(self.ids) + 1) for w in words]))
        last = 0
        for _, word_ids in coded:
            last = 0
            for w in word_ids:
                last = self._extend(last, w)
        self.shortest = min((min(window, len(w)) for _, w in coded), default=window)
        pairs = {a * (len(self.ids) + 1) + b for _, w in coded for a, b in zip(w, w[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        self._mark(coded)

    def _extend(self, last: int, word: int) -> int:
        """The state of what ``last`` stands for and ``word`` after it."""
        nxt, link, length = self.next, self.link, self.length
        old = nxt[last].get(word)
        if old is not None:
            return old if length[old] == length[last] + 1 else self._split(last, word, old)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and word not in nxt[at]:
            nxt[at][word] = new
            at = link[at]
        if at >= 0:
            old = nxt[at][word]
            link[new] = old if length[old] == length[at] + 1 else self._split(at, word, old)
        return new

    def _split(self, at: int, word: int, old: int) -> int:
        """A copy of ``old`` for the shorter strings, those that end at ``at`` and ``word``."""
        copy = len(self.next)
        self.next.append(dict(self.next[old]))
        self.link.append(self.link[old])
        self.length.append(self.length[at] + 1)
        self.link[old] = copy
        while at >= 0 and self.next[at].get(word) == old:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _mark(self, coded: list[tuple[str, list[int]]]) -> None:
        """``full``: the state of the window that ends in a state, and its items; ``short``: the
        whole short items (words, id) that end there."""
        self.items: dict[int, set[str]] = {}
        self.full = [0] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            if self.length[s] >= self.window:
                up = self.link[s]
                self.full[s] = s if self.length[up] < self.window else self.full[up]
        own: dict[int, list[tuple[int, str]]] = {}
        for name, word_ids in coded:
            state = 0
            for w in word_ids:
                state = self.next[state][w]
                if self.full[state]:
                    self.items.setdefault(self.full[state], set()).add(name)
            if len(word_ids) < self.window:
                own.setdefault(state, []).append((len(word_ids), name))
        self.short: dict[int, list[tuple[int, str]]] = {}
        if own:
            for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
                if here := own.get(s, []) + self.short.get(self.link[s], []):
                    self.short[s] = here

    def stretches(self, words: list[bytes]) -> tuple[list[int], list[tuple[int, int]]]:
        """Word ids, and the stretches [a, b) in which alone a window can occur: every pair of
        neighbours occurs in some item, and the shortest window fits."""
        ids = np.fromiter(map(self.ids.get, words, repeat(0)), np.int64, len(words))
        known = ids > 0
        if self.shortest > 1 and len(ids) > 1:
            both = np.flatnonzero(known[:-1] & known[1:])
            keys = ids[both] * (len(self.ids) + 1) + ids[both + 1]
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            inside = np.zeros(len(ids) + 1, bool)
            if len(self.pairs):
                inside[both[self.pairs[at] == keys] + 1] = True  # the pair (i - 1, i)
            edge = np.flatnonzero(np.diff(np.concatenate([[False], inside[1:]]).astype(np.int8)))
            runs = [(int(a), int(b) + 1) for a, b in zip(edge[::2], edge[1::2])]
        else:
            edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
            runs = [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])]
        return ids, [(a, b) for a, b in runs if b - a >= self.shortest]

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit words as disjoint stretches [a, b) in order, and the ids of the items that occur."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        if not self.ids or not words:
            return spans, found
        ids, runs = self.stretches(words)
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for a, b in runs:
            state = matched = 0
            for i, w in enumerate(ids[a:b].tolist(), a):
                while state and w not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                if w in nxt[state]:
                    state = nxt[state][w]
                    matched += 1
                longest = 0
                if matched >= window:
                    longest = window
                    found |= self.items[self.full[state]]
                for n, name in self.short.get(state, ()):
                    if n <= matched:
                        found.add(name)
                        longest = max(longest, n)
                if longest:
                    start = i + 1 - longest
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, i + 1))
        return spans, found


def automata(benchmark: DataFrame, window: int = WINDOW, max_words: int = MAX_WORDS) -> list[Automaton]:
    """The items in as many automata as ``max_words`` asks for (an item is never divided)."""
    built, part, size = [], [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("id"), "text")
    for row in rows.toLocalIterator():
        words = words_of(row["text"])
        if part and size + len(words) > max_words:
            built.append(Automaton(part, window))
            part, size = [], 0
        part.append((row["id"], words))
        size += len(words)
    return [*built, Automaton(part, window)]


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_items(docs: DataFrame, benchmark: DataFrame, name: str = "matched", window: int = WINDOW,
               max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` with a struct ``name``: n_words, spans (hit stretches of word numbers), items."""
    kind = f"`{name}` struct<n_words: long, spans: array<array<int>>, items: array<string>>"
    sc, parts = docs.sparkSession.sparkContext, automata(benchmark, window, max_words)
    for number, automaton in enumerate(parts):
        sent = sc.broadcast(automaton)

        def make(sent=sent, first=not number):
            graph = sent.value

            def one(text, before):
                words = words_of(text)
                spans, items = graph.matches(words)
                if before is not None:
                    spans = joined([*map(tuple, before["spans"]), *spans])
                    items = items | set(before["items"])
                return {"n_words": len(words), "spans": [list(s) for s in spans], "items": sorted(items)}

            if first:
                return lambda texts: ([one(t, None) for t in texts],)
            return lambda texts, done: ([one(t, d) for t, d in zip(texts, done)],)

        docs = map_columns(docs, ["text"] if not number else ["text", name], kind, make)
        if number + 1 < len(parts):
            docs = materialise(docs)
    return docs


def without_words(text: str, spans: list[list[int]]) -> str:
    """``text`` without the words of the ``spans``, nor what stands between them."""
    low = text.translate({c: c + 32 for c in range(65, 91)})
    places = [m.span() for m in WORD.finditer(low)]
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join([*kept, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.8, window: int = WINDOW) -> DataFrame:
    """``docs`` without passages of the items; the same columns.

    Texts of which more than ``coverage`` of the words are hit are dropped, and so is what has no
    words left once its passages are removed; from others the hit words are cut, again and again
    until none is found. Other texts stay as they are, null ones too. ``n_chars``, if there, is
    that of the new text.
    """
    benchmark = materialise(benchmark.select("item_id", "text"))
    name = fresh(docs, "matched")
    found = find_items(docs, benchmark, name, window)
    sent = [docs.sparkSession.sparkContext.broadcast(a) for a in automata(benchmark, window)]

    def make():
        graphs = [s.value for s in sent]

        def clean(text, hit):
            if not hit["spans"]:
                return text, True
            if sum(b - a for a, b in hit["spans"]) > coverage * hit["n_words"]:
                return None, False
            spans = hit["spans"]
            while spans:
                text = without_words(text, spans)
                words = words_of(text)
                spans = joined([s for g in graphs for s in g.matches(words)[0]])
            return text, bool(words)

        def work(texts, hits):
            return zip(*[clean(t, h) for t, h in zip(texts, hits)])

        return work

    kept = fresh(docs, "kept")
    done = map_columns(found, ["text", name], f"text string, `{kept}` boolean", make).where(F.col(kept))
    if "n_chars" in docs.columns:
        hit = F.size(F.col(name)["spans"]) > 0
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(hit, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)


def op6_suffix_automaton(spark, sf_dir: str) -> DataFrame:
    found = find_items(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark")
    )

    def make():
        def work(hits):
            n_hit = [sum(b - a for a, b in h["spans"]) for h in hits]
            return (
                [h["n_words"] for h in hits], n_hit, [len(h["items"]) for h in hits],
                [sha256(",".join(h["items"])) for h in hits], [n > 0 for n in n_hit],
            )

        return work

    out = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return map_columns(found, ["matched"], out, make, drop=("text", "matched"))


OP6_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM item_words, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i) WHERE len(w) > 0
), lens AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM words, lens)
), hits AS (
  SELECT DISTINCT doc_id, i, d.n, item_id FROM doc_windows d JOIN item_windows t ON d.win = t.win AND d.n = t.n
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
