from collections import defaultdict

import numpy as np
import pytest
import xxhash

from triagelake.llm.simhash import fingerprint, keep_one, link_classes, near_groups
from triagelake.llm.graph import components, stars


def slow_fingerprint(text, k=4):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def slow_groups(points, distance=4):
    """component (smallest position) of every fingerprint, by comparing all."""
    label = list(range(len(points)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(points)):
        for j in range(i):
            if bin((points[i] ^ points[j]) & (1 << 64) - 1).count("1") <= distance:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


@pytest.mark.parametrize(
    "text", [None, "", " \n", "One", "a b c", "A b\tc\x0bd", "x y z w x y z w x y z w", "é\u00a0ü a b c d", "w " * 9000]
)
def test_fingerprint(text):
    assert fingerprint(text) == slow_fingerprint(text)


def test_links_equal_brute_force(spark):
    random = np.random.default_rng(1)
    points = list(random.integers(-(1 << 63), 1 << 63, 40))
    for p in list(points):
        for _ in range(8):  # chains of changed bits
            p = int(p) ^ sum(1 << int(b) for b in random.integers(0, 62, random.integers(1, 5)))
            points.append(p)
    points = sorted({int(p) for p in points})
    classes = spark.createDataFrame([(p,) for p in points], "fp long")
    want = defaultdict(set)
    for i, c in enumerate(slow_groups(points)):
        want[c].add(points[i])
    for tile in (1024, 3):  # 3: every block is dealt into tiles
        labels = {r.node: r.label for r in components(link_classes(classes, tile=tile)).collect()}
        got = defaultdict(set)
        for p in points:
            got[labels.get(p, p)].add(p)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_whole_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = sorted(docs.collect())
    points = [slow_fingerprint(r.text) for r in rows]
    want = {(r.doc_id, p, rows[c].doc_id) for r, p, c in zip(rows, points, slow_groups(points))}
    assert {tuple(r) for r in near_groups(docs).collect()} == want


def test_edges(spark):
    schema = "doc_id long, text string, copies int"
    text = "one two three four five six"
    data = [(3, text, 1), (3, text, 1), (5, text.upper(), 2), (7, None, 3), (8, " ", 4), (None, text, 5), (9, "else", None)]
    docs = spark.createDataFrame(data, schema)
    kept = sorted(keep_one(docs).collect(), key=str)
    assert sorted((r.doc_id for r in kept), key=str) == [3, 7, 9, None]
    assert keep_one(docs).columns == docs.columns
    assert keep_one(docs.limit(0)).count() == 0


def test_components_of_a_hub_equal_brute_force(spark):
    random = np.random.default_rng(3)
    pairs = [(0, int(v)) for v in random.permutation(np.arange(1, 1_500))]  # one node meets most edges
    pairs += [(5_000, int(v)) for v in range(4_000, 4_400)]  # and one is the largest of its component
    pairs += [(int(a), int(a) + 1) for a in range(6_000, 6_300)] + [(7, 7), (6_000, 6_001), (6_001, 6_000)]
    want = {v: 0 for v in range(1, 1_500)} | {v: 4_000 for v in [*range(4_001, 4_400), 5_000]}
    want |= {v: 6_000 for v in range(6_001, 6_301)}
    edges = spark.createDataFrame(pairs, "u long, v long")
    got = components(edges).collect()
    assert {r.node: r.label for r in got} == want and len(got) == len(want)
    assert components(edges.limit(0)).count() == 0


def test_rows_of_a_hub_do_not_meet_in_one_task(spark):
    ends = spark.createDataFrame([(0, v) for v in range(1, 2_000)] + [(v, v + 1) for v in range(1, 1_000)], "u long, v long")
    near, low = stars(ends, ends.count())
    assert low.count() == 1_000
    sizes = near.rdd.mapPartitions(lambda rows: [sum(r.u == 0 for r in rows)]).collect()
    assert sum(sizes) == 1_999 and max(sizes) < 1_000  # the rows of node 0 stay dealt as they were
    assert {(r.u, r.m) for r in near.collect()} == {(0, 1)} | {(v, v + 1) for v in range(1, 1_000)}
