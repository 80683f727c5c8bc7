import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from triagelake.llm import langid
from triagelake.llm.langid import count_grams, fit, grams, keep_known, learn, predict, training_rows


def slow_line(text):
    import unicodedata

    low = (text or "").lower()
    words = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in low).split()
    return "   " + " ".join(words) + " " if words else ""


def slow_probability(counts, gram, chars):
    """Interpolated Kneser-Ney by its definition, for one language; counts: of 4-grams."""
    tables = {4: Counter(counts)}
    for k in (3, 2, 1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    p = 1 / (chars + 1)
    for k in (1, 2, 3, 4):
        t, g = tables[k], gram[4 - k :]
        once, twice = (sum(n == i for n in t.values()) for i in (1, 2))
        d = min(0.9, max(0.1, once / max(once + 2 * twice, 1)))
        same = [n for x, n in t.items() if x[:-1] == g[:-1]]
        if same:
            p = max(t.get(g, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * p
    return p


def counted(spark, rows):
    return learn(count_grams(spark.createDataFrame(rows, "text string, lang string")))


def test_grams_and_models_equal_their_definition(spark):
    texts = ["The cat, the CAT and 12 dogs!", "", None, " -- ", "été à la plage", "𐐨𐐩 x"]
    for t in texts:
        line = slow_line(t)
        want = [line[i : i + 4] for i in range(len(line) - 3)] if line else []
        got = grams(t)[0]
        if t != "𐐨𐐩 x":
            assert ["".join(chr(int(k) >> s & 0xFFFF).replace("\x01", " ") for s in (48, 32, 16, 0)) for k in got] == want
        assert len(got) == len(want)
    learned = {"en": texts[0], "fr": "les chats et le chien, là où 他 豈豈豈豈 is"}  # keys above and below 2^63
    models = counted(spark, [(t, lang) for lang, t in learned.items()])
    assert models.langs == ["en", "fr"]
    chars = len({c for t in learned.values() for c in slow_line(t)})
    probes = ["the cow ate qx", "le chat 豈豈豈 他"]
    for number, lang in enumerate(models.langs):
        line = slow_line(learned[lang])
        counts = Counter(line[i : i + 4] for i in range(len(line) - 3))
        for text in probes:
            probe = slow_line(text)
            want = [slow_probability(counts, probe[i : i + 4], chars) for i in range(len(probe) - 3)]
            keys, back = np.unique(grams(text)[0], return_inverse=True)
            assert np.allclose(models.probabilities(keys)[back, number], want)
            assert np.allclose(models.bits([grams(text)[0], keys[:0]])[:, number], [-np.log2(want).mean(), 0])


def test_probabilities_add_up_and_no_rows_no_model(spark):
    models = counted(spark, [("the cat sat on the mat", "en"), ("le chat est sur la table", "fr")])
    chars = {1 if c == " " else ord(c) for c in "the cat sat on the mat le chat est sur la table"}
    for gram in (*grams("the")[0], *grams("chat q")[0]):
        context = int(gram) & ((1 << 48) - 1)
        keys = np.array(sorted(context << 16 | c for c in {*chars, ord("z")}), np.uint64)  # z: any unknown one
        assert np.allclose(models.probabilities(keys).sum(0), 1)
    assert counted(spark, [("", "en"), ("12", "fr")]) is None


def test_rare_languages_outlast_a_hot_one(spark):
    """More 4-grams of one language than a model could once have: a rare one loses none of its own."""
    rnd = np.random.default_rng(4)
    hot = spark.createDataFrame([(i, "".join(map(chr, rnd.integers(0x4E00, 0x9000, 11_000))), "zz") for i in range(220)],
                                "doc_id long, text string, lang string")
    words = "και το να είναι με την που για από δεν στο μια αλλά σαν όταν ο η".split()
    rare = [(1000 + i, " ".join(rnd.choice(words, 12)), "el") for i in range(12)]
    docs = hot.union(spark.createDataFrame(rare, hot.schema))
    models = learn(count_grams(docs))
    texts = [r[1] for r in rare]
    alone = counted(spark, [(t, "el") for t in texts])
    keys = np.unique(np.concatenate([grams(t)[0] for t in texts]))
    alone.floor = models.floor  # the characters of the other language are known too
    assert np.allclose(models.probabilities(keys)[:, models.langs.index("el")], alone.probabilities(keys)[:, 0])
    assert {r.lang_pred for r in predict(docs.where("lang = 'el'"), models).collect()} == {"el"}
    assert count_grams(hot).count() > 2_000_000


def test_counts(spark):
    rows = spark.createDataFrame([("aaaa b", "x"), ("aaaa", "x"), ("b", "y"), ("", "y")], "text string, lang string")
    got = {(r.lang, r.gram): r.n for r in count_grams(rows.repartition(3)).collect()}
    want = Counter((lang, int(k.view(np.int64))) for t, lang in [("aaaa b", "x"), ("aaaa", "x"), ("b", "y")] for k in grams(t)[0])
    assert got == want


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = langid.op4_kneser_ney(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in out) and np.mean([r.score for r in held]) > 0.9
    assert sum(r.rejected for r in out) == 0


def test_rejection_and_edges(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("score_", F.lit(1))
    odd = [(-1, None), (-2, ""), (-3, "123 !!"), (-4, "Быстрая коричневая лиса прыгает через ленивую собаку " * 9), (None, "zz")]
    extra = spark.createDataFrame([(i, t, None, None, 0, 1) for i, t in odd], docs.schema)
    kept = keep_known(docs.unionByName(extra), training_rows())
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len(ids) >= docs.count() and not {-1, -2, -3, -4} & set(ids)
    assert keep_known(docs.limit(0), training_rows()).count() == 0
    assert fit(extra, F.lit(True)) is None
    assert {r.lang_pred for r in predict(extra, None).collect()} == {"und"}


def test_a_rare_language_has_its_own_limit(spark, monkeypatch):
    rnd = np.random.default_rng(1)
    words = ["the", "cat", "and", "dog", "sat", "on", "mat", "here", "now"]
    hot = [(i, " ".join(rnd.choice(words, 90)), "en") for i in range(4000)]
    rare = [(10_000 + i, "".join(chr(c) for c in rnd.integers(0x4E00, 0x5600, 300)), "zz") for i in range(60)]
    docs = spark.createDataFrame(hot + rare, "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "MAX_CALIBRATION", 24)  # none of them is rare
    models = fit(docs, F.lit(True))
    assert max(models.limits["en"]) < min(models.limits["zz"]) < np.inf
    judged = predict(docs, models).collect()
    assert all(r.lang_pred == r.lang and not r.rejected for r in judged)
    odd = spark.createDataFrame([(1, " ".join(["qxzv wjkh pfgb"] * 20), None)], docs.schema)
    assert [r.rejected for r in predict(odd, models).collect()] == [True]


def test_limits_by_language_and_class():
    rows = [("a", 3, 500, 500, 2.0), ("a", 1, 30, 30, 3.0), ("b", 3, 4, 3, 9.0), ("c", 3, 2, 0, None)]
    got = langid.limits_of(["a", "b", "c", "d"], rows)
    assert got["a"] == [6.75, 4.5, 4.5, 3.0]
    assert all(x >= 1.5 * 9.0 for x in got["b"]) and np.isfinite(got["b"]).all()
    assert np.isinf(got["c"]).all() and np.isinf(got["d"]).all()
