import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_pii import plain
from tests.llm.test_simhash import slow_fingerprint, slow_groups
from triagelake.llm.common import tokenizer_file
from triagelake.llm.decontaminate import words_of
from triagelake.llm.tokenise import VOCABULARY
from triagelake.session import materialise


def windows(words, n=10):
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def test_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, results = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
        results.append(docs.collect())
        assert name == "packing" or docs.columns == columns
    known, single, clean, masked, packed = results
    assert len(known) == 1000  # every document is in one of the languages
    rows = sorted(known, key=lambda r: r.doc_id)
    groups = slow_groups([slow_fingerprint(r.text) for r in rows])
    assert {r.doc_id for r in single} == {rows[c].doc_id for c in groups}
    items = [words_of(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    grams = set().union(*map(windows, items))
    before = {r.doc_id: r for r in single}
    for r in clean:
        assert not windows(words_of(r.text)) & grams
        if not windows(words_of(before[r.doc_id].text)) & grams:
            assert r == before.pop(r.doc_id)
        else:
            assert len(r.text) < len(before.pop(r.doc_id).text) and r.n_chars == len(r.text)
    for r in before.values():  # dropped
        assert windows(words_of(r.text)) & grams
    texts = {r.doc_id: r.text for r in clean}
    for r in masked:
        assert not plain(r.text)
        assert r.text == texts[r.doc_id] or plain(texts[r.doc_id])
    tokenizer = Tokenizer.from_file(tokenizer_file(VOCABULARY))
    want = set()
    for r in masked:
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids + [1]
        want |= {(r.doc_id, k, s, min(4096, len(ids) - s), zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes()))
                 for k, s in enumerate(range(0, len(ids), 4096))}
    assert {tuple(r)[:5] for r in packed} == want and len(packed) == len(want)


def test_empty_table(spark, sf_dir, tmp_path):
    for name in ("documents", "benchmark"):
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        (df.limit(0) if name == "documents" else df).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
