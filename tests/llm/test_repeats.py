import hashlib
import os
import random
import time
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagelake.llm import repeats
from triagelake.llm.repeats import radix_groups, repeated_spans, runs, without_repeats


def _order(doc):
    return doc is not None, doc or 0


def slow_repeats(rows, window=100):
    """(doc_id, removed bytes, spans, hash of the rest), by a dictionary of all windows."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in texts:
        for s in range(len(b) - window + 1):
            w, place = b[s : s + window], (_order(d), s)
            first[w] = min(first.get(w, place), place)
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - window + 1):
            if first[b[s : s + window]] < (_order(d), s):
                gone[s : s + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _prose(r, n):
    return " ".join("".join(r.choice("aeioustrnl") for _ in range(r.randint(1, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def cases():
    """Nulls, blanks, repeated rows, periodic texts, texts of one id, shared lines and passages."""
    r = random.Random(3)
    base = [_prose(r, 300) for _ in range(6)]
    rows = [
        (None, base[0]), (None, base[0]), (0, None), (1, ""), (2, "a" * 1000), (3, "ab" * 333), (3, "ab" * 333),
        (4, base[1][:99]), (5, base[1]), (6, base[1]), (7, base[2] + base[1][50:700] + base[3]),
        (8, "x" + base[2][:150] + "é" * 200), (9, base[0][10:]), (10, base[4] + base[4]),
        (11, base[1][300:399] + "!" + base[1][300:401]), (12, "é" * 150), (12, base[5]), (12, "z" + base[5]),
    ]
    line = _prose(r, 12)[:75]
    rows += [(i, _prose(r, r.randint(5, 60)) + line + _prose(r, r.randint(5, 60))) for i in range(20, 50)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits, hot, at_once", [(1 << 29, 1 << 16, 1 << 14), (64, 0, 8), (1 << 29, 4, 8)])
def test_equals_brute_force(spark, cases, bits, hot, at_once, monkeypatch):
    """With 64 bits nearly every digit passes the bitmap; every digit, or some, are hot."""
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "RUNS_AT_ONCE", at_once)
    docs = spark.createDataFrame(cases, "doc_id long, text string").repartition(5)
    docs = docs.withColumn("spans", F.lit("clash")).withColumn("row", F.lit(1))
    got = [
        (r.doc_id, len(r.text.encode()), sum(s.end - s.start for s in r.spans), len(r.spans))
        for r in repeated_spans(docs, bits).collect()
    ]
    assert sorted(got, key=str) == [x[:4] for x in slow_repeats(cases)]


def test_kept_bytes(spark, cases):
    docs = spark.createDataFrame(cases, "doc_id long, text string").repartition(3)
    kept = without_repeats(docs).select(
        "doc_id", "n_bytes", F.col("n_bytes") - F.length("kept"), F.size("spans"), F.sha2("kept", 256))
    assert sorted(map(tuple, kept.collect()), key=str) == slow_repeats(cases)


def _bytes_below(folders):
    return sum(os.lstat(os.path.join(d, f)).st_size for top in folders for d, _, names in os.walk(top) for f in names)


def test_texts_are_neither_stored_nor_shuffled(spark, tmp_path, monkeypatch):
    """Every text shares a line with all others, which is shorter than a window: nothing is removed, and no text moves."""
    r = random.Random(8)
    line = _prose(r, 20)[:80]
    rows = [(i, f"{r.getrandbits(20_000):x}{line}{r.getrandbits(20_000):x}") for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    monkeypatch.setattr(
        repeats, "materialise", lambda df: df.write.parquet(to := f"{tmp_path}/steps/{uuid.uuid4().hex}") or spark.read.parquet(to))
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    spark.sparkContext._jvm.System.gc()
    time.sleep(1)
    before = _bytes_below(local)
    docs = spark.read.parquet(f"{tmp_path}/docs")
    size = sum(len(t) for _, t in rows)
    assert repeated_spans(docs).agg(F.sum(F.size("spans")), F.sum(F.length("text"))).first() == (0, size)
    assert _bytes_below([*local, f"{tmp_path}/steps"]) - before < size


def test_runs_that_pass_by_chance_are_sent_once_a_part(spark, monkeypatch):
    """A passage of 400 texts, while nearly every run passes the bitmap: its runs do not all meet in one task."""
    r = random.Random(9)
    passage = _prose(r, 60)
    rows = [(i, f"{_prose(r, 20)}{passage}{_prose(r, 20)}") for i in range(400)]
    sent = []
    compare = repeats._repeated_windows
    monkeypatch.setattr(
        repeats, "_repeated_windows", lambda runs: sent.append(runs.groupBy("digit").count().agg(F.max("count")).first()[0]) or compare(runs))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    repeated = repeated_spans(docs, 64).agg(F.sum(F.expr("aggregate(spans, 0, (n, s) -> n + s.end - s.start)"))).first()[0]
    assert repeated == sum(x[2] for x in slow_repeats(rows)) and sent[0] < 400


def test_repeated_rows(spark, cases):
    """Rows that repeat within a task and across tasks share their spans and stay rows of their own."""
    rows = cases + cases[:12] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    kept = without_repeats(docs).select(
        "doc_id", "n_bytes", F.col("n_bytes") - F.length("kept"), F.size("spans"), F.sha2("kept", 256))
    assert sorted(map(tuple, kept.collect()), key=str) == slow_repeats(rows)


def test_empty_table(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_equal_windows_choose_equal_places():
    r = random.Random(5)
    text = (_prose(r, 30_000) + " " + "ab" * 400).encode()  # more than one block
    shared = text[70_000:71_000]
    data = np.frombuffer(text + b"##" + shared, np.uint8)
    start, count, place = runs(data, np.array([0, len(text), len(data)]))
    chosen = np.full(len(data), -1)
    for s, c, p in zip(start, count, place):
        chosen[s : s + c] = p - np.arange(s, s + c)
    windows = np.arange(len(data) - 99)
    inside = (windows + 100 <= len(text)) | (windows >= len(text))
    assert ((chosen[:-99] >= 0) == inside).all() and (chosen[windows[inside]] < 48).all()
    at = len(text) + 2
    assert (chosen[at : at + 901] == chosen[70_000:70_901]).all()


def test_radix_groups():
    data = np.frombuffer(b"abc" * 60 + b"x" + b"abc" * 40 + b"\0" * 8, np.uint8)
    starts = np.arange(len(data) - 107)
    index, group = radix_groups(data, starts)
    text = data.tobytes()
    want = {}
    for s in starts:
        want.setdefault(text[s : s + 100], set()).add(int(s))
    got = {}
    for i, g in zip(index, group):
        got.setdefault(g, set()).add(int(starts[i]))
    assert sorted(map(sorted, got.values())) == sorted(sorted(w) for w in want.values() if len(w) > 1)
