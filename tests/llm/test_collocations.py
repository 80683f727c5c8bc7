import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from triagelake.llm import collocations as c
from triagelake.llm.collocations import collocations, count_phrases, frequent_slots, packed_phrases


def slow_collocations(rows, threshold=10, inside=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    found = {}
    for (lang, *w), a in f.items():
        if len(w) > 1 and a >= threshold:
            cuts = []
            for k in range(1, len(w)):
                l, r = f[lang, *w[:k]], f[lang, *w[k:]]
                cuts.append((1_000_000 * a * a // (l * r), k, l, r))
            found[lang, *w] = (a, min(cuts))
    out = []
    for lang in n:
        mine = []
        for (of, *w), (a, (score, _, l, r)) in found.items():
            longer = [b for (o, *v), (b, _) in found.items() if o == of and len(v) == 3 and len(w) == 2 and w in (v[:2], v[1:])]
            if of == lang and not any(100 * b >= inside * a for b in longer):
                mine.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    """Nulls, blanks, borders of pieces, capitals, other white space, repeated rows, phrases at the threshold."""
    r = random.Random(8)
    words = ["a", "b", "C", "d", "eé", "É", "x y", "|", "\x00z", "w\x1c"]
    out = [(None, None), ("en", ""), ("en", " \t\n"), (None, "p q. P Q\tp,q " * 12), ("de", "one two three " * 9 + "one two"), ("fr", "m n " * 10)]
    for i in range(250):
        text = "".join(
            r.choice(words[: r.choice([3, 10])]) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\r\n", "\x0b", " ! "])
            for _ in range(r.randint(0, 40)))
        out.append((r.choice(["en", "en", "de", None, "und"]), text))
    return out + out[10:20] * 3


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("shards, slots", [(3, 1 << 26), (1, 1 << 26), (4, 16)])  # 16 slots: all are shared
def test_equals_brute_force(spark, rows, shards, slots, monkeypatch):
    for name in ("PART", "WORDS", "HELD"):
        monkeypatch.setattr(c, name, 200)
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "'c' as phrase", "0 as k").repartition(3)
    got = collocations(docs, shards=shards, max_slots=slots).select(*COLUMNS)
    assert sorted(map(tuple, got.collect())) == slow_collocations(rows)


def test_top_and_ties(spark, rows):
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations(docs, threshold=3, inside_percent=80, top=4).select(*COLUMNS)
    assert sorted(map(tuple, got.collect())) == slow_collocations(rows, 3, 80, 4)


def test_large_counts_are_exact(spark):
    score = spark.sql(
        "select (cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0)))"
        " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0))) as s"
        " from values (999999999999989L, 999999999999989L, 999999999999999L) as t(a, l, r)").first()[0]
    assert score == 1_000_000 * 999999999999989**2 // (999999999999989 * 999999999999999)


def test_empty_table(spark):
    assert collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_slots_hold_the_frequent(spark, rows):
    docs = spark.createDataFrame([x for x in rows if x[0] and x[1]], "lang string, text string")
    frequent, log = frequent_slots(docs, shards=2)
    assert log == 13 and all(0 < np.unpackbits(bits).sum() < 1024 for bits in frequent)
    with pytest.raises(ValueError):
        frequent_slots(docs, shards=11)


def test_tasks_send_packed_counts(spark):
    """Twenty times the frequent phrases are no more rows between the tasks."""
    sent = []
    for n in (100, 2000):
        text = " ".join(f"w{i}" for i in range(n))
        docs = spark.createDataFrame([("en", text)] * 12, "lang string, text string").coalesce(1)
        frequent, log = frequent_slots(docs)
        sent.append(packed_phrases(docs, frequent, log).count())
        counts = count_phrases(docs, frequent, log)
        assert dict(counts.where("k = 3").groupBy("n").count().collect()) == {12: n - 2}
    assert sent[1] <= sent[0] <= 4


def test_hashes_of_words():
    """Words of any length differ, and hash alike wherever they stand; borders are 0."""
    words = [b"a" * n for n in range(1, 150)] + [b"a" * n + b"b" for n in range(150)] + ["é".encode(), b"\x00", b"\x00\x00"]
    found = c._numbers(pa.array(words + [c.BORDER] + words[::-1], pa.large_binary()).slice(1))
    assert len(set(found.tolist())) == len(words) + 1 and found[len(words) - 1] == 0
    assert found[: len(words) - 1].tolist() == found[: len(words) - 1 : -1][: len(words)].tolist()[1:]
