import zlib

import numpy as np
from pyspark.sql import functions as F

from triagelake.llm.toxicity import Model, fit, label_model, op9_weak_supervision, score, stems, words_of


def test_words():
    assert words_of("You IDIOT, you're a été 12x") == {b"you": 1, b"idiot": 1, b"you're": 1, b"a": 1, "été".encode(): 1, b"x": 1}
    assert words_of(None) == {}
    assert stems(b"lowering") == [b"lowe*", b"lower*"] and stems("chóné".encode()) == ["chón*".encode()] and stems(b"four") == []


def test_label_model_finds_accuracies_and_correlations():
    rnd = np.random.default_rng(0)
    y = rnd.random(4000) < 0.2
    good = [np.where(y, rnd.random(4000) < 0.6, rnd.random(4000) < 0.02) for _ in range(5)]
    noise = rnd.random(4000) < 0.3
    votes = np.array([*good, *[noise] * 20]).T  # twenty copies of a voter that knows nothing
    given = np.where(rnd.random(4000) < 0.1, ~y, y).astype(int)  # a tenth of the labels is wrong
    p = label_model(votes, given, trust=0.9)
    assert ((p > 0.5) == y).mean() > 0.95 > (given == y).mean()


def test_held_out(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.01", "sf0.1")  # the smaller table has six toxic texts held out
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = op9_weak_supervision(spark, sf_dir).collect()
    assert len(got) == 10000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    high, low = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in high for b in low])
    assert auc > 0.95 and np.mean([s >= 0.5 for s in low]) < 0.05


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 2), (2, "", 2), (None, "you idiot", 2), (4, "x " * 50_000, 2), (4, "a good day", 2)],
                                 "doc_id long, text string, label int")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, label int")
    model = fit(docs, none, F.lit(True))
    assert model.weights is None
    got = [r.score for r in score(docs, model).collect()]
    assert got[2] > 0.5 and max(got[:2] + got[3:]) < 0.5
    some = spark.createDataFrame([(1, 0), (2, 0), (4, 1), (4, 1)], "doc_id long, label int")
    assert score(docs, fit(docs, some, F.lit(True))).count() == 5
    assert score(docs.limit(0), Model()).count() == 0
