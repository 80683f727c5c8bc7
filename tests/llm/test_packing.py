import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from triagelake.llm.common import tokenizer_file
from triagelake.llm.packing import op8_exact_complement, pack, plan_lengths, sequences
from triagelake.llm.tokenise import VOCABULARY, Encoder


def check_plan(counts, capacity):
    plan = plan_lengths(counts, capacity)
    fill, taken = {}, {}
    for length, first, last, per, base, offset in zip(plan.length, plan.first, plan.last, plan.per, plan.base, plan.offset):
        taken.setdefault(length, []).append((first, last))
        for r in range(first, last):
            seq, at = base + (r - first) // per, offset + (r - first) % per * length
            fill.setdefault(seq, []).append((at, length))
    for length, n in counts.items():
        spans = sorted(taken.get(length, [])) if n else []
        assert sum(b - a for a, b in spans) == n and all(b == c for (_, b), (c, _) in zip(spans, spans[1:]))
    for seq in fill.values():
        at = 0
        for start, length in sorted(seq):
            assert start == at
            at += length
        assert at <= capacity
    assert len(fill) == plan.sequences
    return plan.sequences


def best(counts, capacity):
    """Fewest sequences, by search (small cases)."""
    items = sorted((x for x, n in counts.items() for _ in range(n)), reverse=True)
    low = [len(items)]

    def go(i, bins):
        if len(bins) >= low[0]:
            return
        if i == len(items):
            low[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                go(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1 :]])
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return low[0]


def test_plans():
    rnd = random.Random(2)
    for _ in range(150):
        capacity = rnd.randint(1, 16)
        counts = {x: rnd.randint(1, 3) for x in rnd.sample(range(1, capacity + 1), rnd.randint(0, min(4, capacity)))}
        assert check_plan(counts, capacity) <= best(counts, capacity) * 1.5 + 0.5
    counts = {x: rnd.randint(0, 40) for x in range(1, 4097)}
    total = max(sum(x * n for x, n in counts.items()), 4096 * sum(n for x, n in counts.items() if x > 2048))
    assert check_plan(counts, 4096) <= -(-total // 4096) * 1.012 + 1
    assert plan_lengths({}, 4096).sequences == 0


@pytest.mark.parametrize("text", [None, "", " ", "I'LL say: it's 12,5 €!", "É́ ǅ İstanbul ΣΑΣ", "<|endoftext|> a<|endoftext|>b",
                                  "a\x1cb c d\x85e", "x" * 70000, "Über straße 😀", "don't<|can't"])
def test_encoder_equals_the_whole_path(text):
    whole = Tokenizer.from_file(tokenizer_file(VOCABULARY)).encode(text or "", add_special_tokens=False).ids + [1]
    encode = Encoder()
    assert np.frombuffer(encode(text), "<u4").tolist() == whole == np.frombuffer(encode(text), "<u4").tolist()


def test_whole_table(spark, sf_dir):
    tokenizer = Tokenizer.from_file(tokenizer_file(VOCABULARY))
    want = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[s : s + 4096], "<u4")
            want.add((r.doc_id, k, s, len(part), zlib.crc32(part.tobytes())))
    got = op8_exact_complement(spark, sf_dir).collect()
    assert {tuple(r)[:5] for r in got} == {(a, b, c, d, e) for a, b, c, d, e in want} and len(got) == len(want)
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by_seq) <= -(-sum(r.length for r in got) // 4096) + 1


def test_round_trip_and_edges(spark):
    data = [(1, None, 7), (1, None, 7), (None, "", 7), (2, "some words here " * 40, 7)]
    docs = spark.createDataFrame(data, "doc_id long, text string, rank int")
    packed = pack(docs, 50, with_ids=True).collect()
    joined = {r.sequence_id: bytes(r.ids) for r in sequences(spark.createDataFrame(packed)).collect()}
    encode = Encoder()
    for r in packed:
        text = dict((d[0], d[1]) for d in data)[r.doc_id]
        part = encode(text)[4 * r.start : 4 * (r.start + r.length)]
        assert joined[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == part == bytes(r.ids)
    assert pack(docs.limit(0)).count() == 0
