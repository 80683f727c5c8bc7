import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from triagelake.llm.periods import (
    Shared, SuffixTree, find_runs, lyndon_words, op13_tree_runs, periodic_runs, planted, runs_of, stretches,
)


def slow_runs(words, shortest=12):
    """All runs, from the stretches of equal words at each distance; the least period of a stretch counts."""
    found, n = set(), len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(shortest, 2 * q):
                part = words[i : j + q]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.add((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def _texts():
    r = random.Random(2)
    yield from ([], [1], [1] * 5, [1] * 40, [1, 2] * 20, [1, 2, 3] * 4, [1, 2, 3] * 4 + [1], list(range(50)))
    yield [1, 2, 3, 4, 5, 6] * 2
    yield [*range(30), *range(30)] + [99] + [*range(30), *range(30)]
    fib = [[1], [1, 2]]
    while len(fib) < 12:
        fib.append(fib[-1] + fib[-2])
    yield fib[-1]
    for _ in range(150):
        out = []
        while len(out) < r.randint(1, 160):
            part = [r.randint(0, r.choice([1, 2, 4, 60])) for _ in range(r.randint(1, 25))]
            out += part * r.choice([1, 1, 2, 3, 5]) + part[: r.randint(0, len(part))]
        yield out


def test_runs_equal_brute_force():
    some = 0
    for words in _texts():
        ids = np.array(words, np.int64)
        want = slow_runs(words)
        assert [tuple(x) for x in runs_of(ids).tolist()] == want
        assert sorted(map(tuple, find_runs(ids, 2).tolist())) == sorted(slow_runs(words, 2))
        some += bool(want)
    assert some > 60


def test_tree_gives_order_and_shared_lengths():
    r = random.Random(4)
    for _ in range(30):
        s = [r.randint(1, 3) for _ in range(r.randint(2, 60))]
        order, low = SuffixTree(np.array(s)).tour()
        assert order.tolist() == sorted(range(len(s) + 1), key=lambda i: s[i:])
        shared = Shared(order, low)
        i, j = np.triu_indices(len(s), 1)
        want = [next((k for k in range(len(s) - b) if s[a + k] != s[b + k]), len(s) - b) for a, b in zip(i, j)]
        assert shared(i, j).tolist() == want
        words = lyndon_words(shared.rank)
        for a, k in enumerate(words):
            assert all(s[a : a + k] < s[b : a + k] for b in range(a + 1, a + k))
            longer = [e for e in range(a + k + 1, len(s) + 1) if all(s[a:e] < s[b:e] for b in range(a + 1, e))]
            assert not longer


def test_prose_has_no_stretches():
    assert stretches(np.arange(5000)) == []


def slow_document(doc, text, shape=True):
    words = (text or "").encode().split()
    n, h = len(words), crc32(str(doc).encode())
    if shape and doc is not None and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc, len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("rows", [[], [
    (None, "a b " * 30), (None, None), (1, ""), (2, " \n\t"), (3, "é ü " * 40), (3, "é ü " * 40),
    (3, "x\x0by\x1cz " * 9), (38, "w " * 5000), (5, "one"), (7, " ".join(str(i % 97) for i in range(900))),
]])
def test_edge_cases(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' as runs", "1 as n_words").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op13_tree_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((slow_document(*r) for r in rows), key=str)
    plain = periodic_runs(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()
    assert sorted(len(r.runs) for r in plain) == sorted(slow_document(*r, shape=False)[1] for r in rows)


def test_documents_equal_brute_force(spark, sf_dir):
    docs = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: tuple(r) for r in op13_tree_runs(spark, sf_dir).collect()}
    assert len(got) == len(docs) and sum(r[1] for r in got.values()) >= 90
    short = [r for r in docs if len(r.text) < 9000]
    assert len(short) > 800
    for r in short:
        assert got[r.doc_id] == slow_document(r.doc_id, r.text)
    changed = [planted(r.doc_id, len(r.text.split())) for r in docs if r.text.split()]
    assert sum(c is not None for c in changed) > 60
