"""Language identification with interpolated Kneser-Ney character models.

For every language the character 4-grams of all labelled texts are counted; lower orders follow
from them as continuation counts. Counts, totals of contexts and discounts are Spark aggregates over all
of the rows. The predicted language has the lowest cross-entropy per character.

The models are sorted arrays of 64-bit keys (four 16-bit characters), one for the counts and one for the
contexts of each order, in which a key has an entry for each language that knows it. Spark sorts them
into Parquet files in the shared folder; an executor fetches these, turns them into plain arrays on
its own disk once, and its workers map the arrays into memory and look keys up by binary search. No
count is left out, and neither the driver nor a worker holds the models.

Calibration uses labelled rows that were held back from the counts (1 of ``HELD_BACK`` by hash): the
score is the probability of a right prediction given how far the second language lies behind (two
numbers, fitted on at most ``MAX_CALIBRATION`` of the rows), and a text is rejected when its
cross-entropy is far above what texts of its language and length class reach, over all of the rows. A
language of which no held-back row was recognised has no limit.

Texts are lower-cased; everything but letters and marks counts as one blank. A null text or one
without a letter is ``und`` with score 0. Very long texts are scored whole, ``CHUNK`` characters at a time.
Of languages with equal cross-entropy the first by name is taken. Repeated rows count as often as they
occur and are all judged. Rows with a null lang are not learned from; without any labelled row all texts
are ``und``, and only texts without a letter are rejected. Columns of ``docs`` pass through; one that bears
the name of an added column is replaced by it (`keep_known` takes names that are free).
"""

from __future__ import annotations

import fcntl
import json
import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import crc32_mod, fresh, map_columns, table
from triagelake.session import materialise

ORDER = 4
HELD_BACK = 16
MAX_CALIBRATION = 4096
#: Length classes in letters, and how far above the highest calibration value a text may lie.
CLASSES = (16, 64, 256)
MARGIN = 1.5
#: Rows of a class that tell its limit; with fewer it is as much wider as ``MARGIN`` again.
ENOUGH = 20
BLANK = 1
CHUNK = 1 << 19


@cache
def alphabet() -> tuple[np.ndarray, np.ndarray]:
    """16-bit code of every code point (0: not in a word), and whether it is a letter."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    letter = np.array([k == "L" for k in kinds])
    points = np.arange(0x110000)
    codes = np.where(points < 0x10000, points, 0xE000 + points % 0x1900)
    return np.where(letter | np.array([k == "M" for k in kinds]), codes, 0).astype(np.uint16), letter


def grams(text: str | None) -> tuple[np.ndarray, bool]:
    """Keys of all 4-grams of the blank-padded text, and whether it has a letter."""
    codes, letter = alphabet()
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    word = codes[points]
    inside = word > 0
    first_blank = ~inside & np.concatenate([[False], inside[:-1]])  # one blank for each gap
    word = np.where(inside, word, BLANK)[inside | first_blank]
    ends = [] if len(word) and word[-1] == BLANK else [BLANK]
    line = np.concatenate([[BLANK] * (ORDER - 1), word, ends]).astype(np.uint64)
    keys = line[: len(line) - ORDER + 1].copy() if len(word) else np.zeros(0, np.uint64)
    for k in range(1, ORDER) if len(word) else ():
        keys = keys << np.uint64(16) | line[k : len(line) - ORDER + 1 + k]
    return keys, bool(letter[points].any())


def count_grams(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows; each task sums its own counts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        waiting: dict[str, list] = {}

        def settle(lang):
            old_keys, old_n = sums.get(lang, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            keys, n = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
            at = np.minimum(np.searchsorted(old_keys, keys), max(len(old_keys) - 1, 0))
            known = old_keys[at] == keys if len(old_keys) else np.zeros(len(keys), bool)
            old_n[at[known]] += n[known]
            keys = np.concatenate([old_keys, keys[~known]])
            order = np.argsort(keys, kind="stable")
            sums[lang] = keys[order], np.concatenate([old_n, n[~known]])[order]

        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                keys, _ = grams(text.as_py())
                for at in range(0, len(keys), CHUNK):
                    held = waiting.setdefault(lang, [])
                    held.append(keys[at : at + CHUNK])
                    if sum(map(len, held)) >= CHUNK:
                        settle(lang)
        for lang in list(waiting):
            settle(lang)
        for lang, (keys, n) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)],
                ["lang", "gram", "n"],
            )

    counted = rows.select("text", "lang").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


#: Columns of the arrays: the language's number, the count or total, and how many kinds follow a context.
ARRAYS = {"key": np.int64, "lang": np.int32, "n": np.int64, "kinds": np.int64}


@cache
def mapped(files: tuple[str, ...], langs: tuple[str, ...]) -> dict[int, dict[str, np.ndarray]]:
    """The arrays by section, mapped into memory from this executor's disk.

    The first worker to come writes them from the fetched ``files``; the list of the sections' ends
    is written last, so that a worker lost on the way leaves nothing that counts.
    """
    base = SparkFiles.get(files[0]) + ".arrays"
    with open(base + ".lock", "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.exists(base):
            ends = _write_arrays(files, langs, base)
            with open(base + ".new", "w") as f:
                json.dump(ends, f)
            os.replace(base + ".new", base)
    with open(base) as f:
        ends = json.load(f)
    whole = {name: np.memmap(f"{base}.{name}", kind, "r") for name, kind in ARRAYS.items()}
    starts = [0, *ends[:-1]]
    return {i: {name: values[at:end] for name, values in whole.items()} for i, (at, end) in enumerate(zip(starts, ends))}


def _write_arrays(files: tuple[str, ...], langs: tuple[str, ...], base: str) -> list[int]:
    sizes = np.zeros(2 * ORDER, np.int64)
    names, last = pa.array(langs), (-1, 0)
    out = {name: open(f"{base}.{name}", "wb") for name in ARRAYS}
    try:
        for file in files:
            for batch in pq.ParquetFile(SparkFiles.get(file)).iter_batches(1 << 16):
                section, key = (batch.column(c).to_numpy() for c in ("section", "key"))
                if not len(key):
                    continue
                step = np.diff(section)
                rising = (step > 0) | ((step == 0) & (key[1:] >= key[:-1]))
                if not rising.all() or (section[0], key[0]) < last:
                    raise ValueError("the model's files are not in order")
                last = section[-1], key[-1]
                sizes += np.bincount(section, minlength=2 * ORDER)
                cells = {c: batch.column(c).to_numpy() for c in ("key", "n", "kinds")}
                cells["lang"] = pc.index_in(batch.column("lang"), value_set=names).to_numpy()
                for name, kind in ARRAYS.items():
                    out[name].write(np.ascontiguousarray(cells[name], kind).data)
    finally:
        for f in out.values():
            f.close()
    return np.cumsum(sizes).tolist()


@dataclass
class Models:
    """What is small of the models of all languages, and the files of their arrays.

    Section 2 (k - 1) holds the counts of order k, the next one its contexts.
    """

    langs: list[str]
    files: tuple[str, ...]
    discounts: np.ndarray  # (orders, languages)
    floor: float = 1.0
    slope: tuple[float, float] = (0.0, 1.0)
    limits: dict[str, list[float]] = field(default_factory=dict)  # by language and length class

    def probabilities(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Of each of the distinct ``keys`` in each language."""
        if not order:
            return np.full((len(keys), len(self.langs)), self.floor)
        sections = mapped(self.files, tuple(self.langs))
        discount = self.discounts[order - 1]
        low, back = np.unique(keys & np.uint64((1 << 16 * (order - 1)) - 1), return_inverse=True)
        out = self.probabilities(low, order - 1)[back]
        context, back = np.unique(keys >> np.uint64(16), return_inverse=True)
        total, weight = np.ones((2, len(context), len(self.langs)))
        rows, lang, n, kinds = entries(sections[2 * order - 1], context)
        total[rows, lang] = n
        weight[rows, lang] = discount[lang] * kinds / n
        out *= weight[back]
        rows, lang, n, _ = entries(sections[2 * order - 2], keys)
        out[rows, lang] += (n - discount[lang]) / total[back[rows], lang]
        return out

    def bits(self, many: list[np.ndarray]) -> np.ndarray:
        """Cross-entropy per character of each array of keys in each language."""
        out = np.zeros((len(many), len(self.langs)))
        held: list[np.ndarray] = []
        owners: list[int] = []
        size, most = 0, max(1, CHUNK // len(self.langs))

        def settle():
            starts = np.cumsum([0, *map(len, held[:-1])])
            keys, back = np.unique(np.concatenate(held), return_inverse=True)
            logs = np.log2(self.probabilities(keys))[back]
            np.add.at(out, owners, -np.add.reduceat(logs, starts, axis=0))

        for i, keys in enumerate(many):
            for at in range(0, len(keys), most):
                held.append(keys[at : at + most])
                owners.append(i)
                size += len(held[-1])
                if size >= most:
                    settle()
                    held, owners, size = [], [], 0
        if held:
            settle()
        return out / np.maximum([len(k) for k in many], 1)[:, None]


def entries(section: dict[str, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of all entries of the ``keys``: the key's place, the language, the count and the kinds."""
    keys = keys.view(np.int64)
    first, end = (np.searchsorted(section["key"], keys, side) for side in ("left", "right"))
    many = end - first
    rows = np.repeat(np.arange(len(keys)), many)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many) + first[rows]
    return rows, section["lang"][at], section["n"][at], section["kinds"][at]


def learn(counts: DataFrame) -> Models | None:
    """Models from counted (lang, gram, n) rows, all of which are used."""
    spark = counts.sparkSession
    orders = {ORDER: materialise(counts)}
    for order in range(ORDER - 1, 0, -1):  # how many characters stand before each shorter gram
        short = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1)).alias("gram")
        orders[order] = materialise(orders[order + 1].groupBy("lang", short).agg(F.count("*").alias("n")))
    once = {}
    for order, rows in orders.items():
        seen = rows.groupBy("lang").agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2))
        once |= {(order, lang): (one, two) for lang, one, two in seen.collect()}
    langs = sorted({lang for _, lang in once})
    if not langs:
        return None
    discounts = [[one / max(one + 2 * two, 1) for one, two in (once[order, lang] for lang in langs)]
                 for order in range(1, ORDER + 1)]
    sections = []
    for order, rows in sorted(orders.items()):
        context = rows.groupBy("lang", F.shiftrightunsigned("gram", 16).alias("gram"))
        context = context.agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))
        for section, part in ((2 * order - 2, rows.withColumn("kinds", F.lit(0).cast("long"))), (2 * order - 1, context)):
            sections.append(part.select(F.lit(section).alias("section"), F.col("gram").alias("key"), "lang", "n", "kinds"))
    stored = sections[0]
    for part in sections[1:]:
        stored = stored.unionAll(part)
    stored = materialise(stored.orderBy("section", "key", "lang"))
    files = sorted(stored.inputFiles(), key=lambda uri: uri.rsplit("/", 1)[1])
    for uri in files:
        spark.sparkContext.addFile(uri)
    chars = orders[1].select("gram").distinct().count()
    return Models(langs, tuple(uri.rsplit("/", 1)[1] for uri in files), np.clip(discounts, 0.1, 0.9), 1 / (chars + 1))


def fit(docs: DataFrame, training: Column) -> Models | None:
    """Models learned from the text and lang of the rows for which ``training`` holds."""
    docs = docs.select("doc_id", "text", "lang")
    labelled = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    held_back = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_BACK)) == 0
    models = learn(count_grams(labelled.where(~held_back)))
    if models is None:
        return None
    judged = judge(labelled.where(held_back), models).where("letters > 0")
    judged = materialise(judged.select("doc_id", "lang", "best", "bits", "gap", "letters"))
    right, size = F.col("lang") == F.col("best"), sum((F.col("letters") >= c).cast("int") for c in CLASSES)
    highest = judged.groupBy("lang", size.alias("size")).agg(
        F.count("*").alias("n"), F.count(F.when(right, 1)).alias("right"), F.max(F.when(right, F.col("bits"))).alias("bits"))
    models.limits = limits_of(models.langs, [tuple(r) for r in highest.collect()])
    seen = judged.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_CALIBRATION).toPandas()
    calibrate(models, seen["lang"].eq(seen["best"]).to_numpy(), seen["gap"].to_numpy(float), seen["letters"].to_numpy())
    return models


def calibrate(models: Models, right: np.ndarray, gap: np.ndarray, letters: np.ndarray) -> None:
    x = np.column_stack([np.ones(len(gap)), np.log1p(gap * letters)])
    target = np.where(right, (right.sum() + 1) / (right.sum() + 2), 1 / ((~right).sum() + 2))
    w = np.array([0.0, 1.0])
    for _ in range(30):  # Newton steps, held near the start where there are few rows
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2)
        step = np.linalg.solve(bend, x.T @ (target - p) - (w - [0.0, 1.0]))
        w = w + np.clip(step, -0.5, 0.5)
    models.slope = float(w[0]), float(max(w[1], 0.0))


def widths(rows: list[int], bits: list[float]) -> list[float]:
    """Limits by length class from the number of rows and the highest cross-entropy of each."""
    limits = [np.inf] * (len(CLASSES) + 1)
    for c in range(len(CLASSES), -1, -1):  # a shorter class is never narrower than a longer one
        if rows[c] >= ENOUGH:
            limits[c] = MARGIN * bits[c]
        if c < len(CLASSES) and np.isfinite(limits[c + 1]):  # with too few rows: a half wider
            limits[c] = max(limits[c], limits[c + 1]) if np.isfinite(limits[c]) else 1.5 * limits[c + 1]
    return limits


def limits_of(langs: list[str], highest: list[tuple[str, int, int, int, float | None]]) -> dict[str, list[float]]:
    """Limits of every language by length class, from (lang, class, rows, right rows, highest cross-entropy
    of the right ones). Where a language has too few rows, that of all languages holds, or a wider one
    than its own rows give, whichever is wider."""
    classes = range(len(CLASSES) + 1)
    of = {(lang, c): (n, right, bits or 0.0) for lang, c, n, right, bits in highest}
    get = lambda lang, c: of.get((lang, c), (0, 0, 0.0))
    together = widths([sum(get(x, c)[0] for x in langs) for c in classes],
                      [max(get(x, c)[2] for x in langs) for c in classes])
    limits = {}
    for lang in langs:
        own = [get(lang, c) for c in classes]
        if not any(right for _, right, _ in own):
            limits[lang] = [np.inf for _ in classes]
            continue
        limits[lang] = widths([right for _, right, _ in own], [bits for _, _, bits in own])
        few = MARGIN * MARGIN * max(bits for _, _, bits in own)
        for c in classes:
            if not np.isfinite(limits[lang][c]):
                limits[lang][c] = max(together[c], few)
        for c in reversed(classes[:-1]):
            limits[lang][c] = max(limits[lang][c], limits[lang][c + 1])
    return limits


def judge(docs: DataFrame, models: Models, names: tuple[str, ...] = ("best", "bits", "gap", "letters")) -> DataFrame:
    """``docs`` without text but with the best language, its cross-entropy, how far the next
    lies behind, and the number of characters scored (0: no letter)."""
    return _scored(docs, models, names, lambda m, best, bits, gap, n: (best, bits, gap, n),
                   "string double double long", drop=("text",))


def _scored(docs, models, names, finish, kinds, drop=()):
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def make():
        m: Models = sent.value

        def work(texts):
            made = [grams(t) for t in texts]
            bits = m.bits([k if letter else k[:0] for k, letter in made])
            order = np.argsort(bits, axis=1, kind="stable")
            rows = []
            for (keys, letter), b, o in zip(made, bits, order):
                gap = float(b[o[1]] - b[o[0]]) if len(o) > 1 else 1.0
                rows.append(finish(m, m.langs[o[0]], float(b[o[0]]), gap, len(keys) if letter else 0))
            return [list(c) for c in zip(*rows)] if rows else [[] for _ in names]

        return work

    schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds.split()))
    return map_columns(docs, ["text"], schema, make, drop=drop)


def _verdict(m: Models, best: str, bits: float, gap: float, n: int) -> tuple[str, float, bool]:
    if not n:
        return "und", 0.0, True
    a, b = m.slope
    limit = m.limits[best][int(np.digitize(n, CLASSES))] if m.limits else np.inf
    return best, float(1 / (1 + np.exp(-(a + b * np.log1p(gap * n))))), bits > limit


def predict(docs: DataFrame, models: Models | None, names: tuple[str, str, str] = ("lang_pred", "score", "rejected"),
            drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the predicted language, the probability that it is right, and whether the text
    is rejected: without a letter, or unlike any text of the learned languages."""
    if models is None:

        def make():
            blank = lambda t: not grams(t)[1]
            return lambda texts: (["und"] * len(texts), [0.0] * len(texts), [blank(t) for t in texts])

        schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, ("string", "double", "boolean")))
        return map_columns(docs, ["text"], schema, make, drop=drop)
    return _scored(docs, models, names, _verdict, "string double boolean", drop)


def keep_known(docs: DataFrame, training: Column) -> DataFrame:
    """``docs`` without the rejected rows; the same columns."""
    names = tuple(fresh(docs, n) for n in ("lang_pred_", "score_", "rejected_"))
    judged = predict(docs, fit(docs, training), names)
    return judged.where(~F.col(names[2])).select(*docs.columns)


def training_rows() -> Column:
    """Rows whose crc32 of the doc_id is not 2 modulo 4; rows without a doc_id are not learned from."""
    return F.coalesce(crc32_mod("doc_id", 4) != 2, F.lit(False))


def op4_kneser_ney(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    judged = predict(docs.select("doc_id", "text"), fit(docs, training_rows()), drop=("text",))
    held_out = F.coalesce(crc32_mod("doc_id", 4) == 2, F.lit(False))
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
