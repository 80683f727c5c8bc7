"""Toxicity by weak supervision.

1. Voters. Words and word beginnings (``STEMS`` letters) that labelled toxic texts use far more
   often than others become voters, besides a short general lexicon and patterns (shouting,
   runs of signs, an insult right after "you"). A voter says toxic, clean or nothing.
2. Label model. A generative model of the hidden label and the votes: every voter has an accuracy
   on either label, fitted by expectation maximisation that starts from the given labels' rates.
   Voters that agree more than the label explains are correlated; each one's evidence is divided
   by its correlated votes, so that ten copies of a voter count as one.
3. Classifier. Logistic regression on word features learns the model's posterior labels; documents
   are scored by it alone.

Learning uses at most ``MAX_LABELLED`` labelled rows, those with the smallest hash of their id;
scoring reads every whole text. Labels, lang, source and doc_id are no features. A null text is
the empty text. Without labelled rows of both kinds, only the general lexicon speaks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import crc32_mod, map_columns, table

MAX_LABELLED = 20_000
MAX_VOTERS = 250
STEMS = (4, 5)
#: Words whose voters a task remembers.
KNOWN_WORDS = 200_000
#: A word or beginning votes if so many toxic texts have it, and its log odds are so high.
LEAST_TEXTS = 4
LEAST_ODDS = 2.0
#: A general lexicon, for texts unlike the labelled ones.
LEXICON = (
    "idiot idiots idiotic moron morons stupid dumb loser losers scum trash worthless pathetic disgusting clown"
    " imbecile bastard retard vermin filth"
).split()
#: Bytes that are in no word become blanks; A-Z become lower case.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 or c == 39 else 32 for c in range(256)
)
SHOUT = re.compile("[A-Z]{4,}")
SIGNS = re.compile(r"[!?]{3,}")
YOU = re.compile(r"\byou(?:'re| are)? (?:an? |the |all )?(\w+)", re.I)
PATTERNS = ("shouting", "signs", "you")
NUMERIC = ("votes", "share", "distinct", *PATTERNS)


def words_of(text: str | None) -> Counter:
    """Words, as the UTF-8 bytes of their letters, and how often each is there."""
    return Counter((text or "").encode().translate(FOLD).split())


def stems(word: bytes) -> list[bytes]:
    """Beginnings of ``STEMS`` letters, marked by a star."""
    if word.isascii():
        return [word[:n] + b"*" for n in STEMS if len(word) > n]
    letters = word.decode("utf-8", "ignore")
    return [letters[:n].encode() + b"*" for n in STEMS if len(letters) > n]


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, toxic, clean): in how many labelled texts of either kind a word or stem is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
                words = words_of(text.as_py())
                counts[label].update(words.keys() | {s for w in words for s in stems(w)})
        both = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(both, pa.binary()), pa.array([counts[1][w] for w in both], pa.int64()),
             pa.array([counts[0][w] for w in both], pa.int64())], ["word", "toxic", "clean"])

    made = rows.select("text", "label").mapInArrow(run, "word binary, toxic long, clean long")
    return made.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


@dataclass
class Model:
    voters: list[bytes] = field(default_factory=lambda: [w.encode() for w in LEXICON])
    weights: np.ndarray | None = None  # of NUMERIC, then of each voter, then the bias
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None

    def __post_init__(self):
        self.words = {w: i for i, w in enumerate(self.voters) if not w.endswith(b"*")}
        self.stems = {w: i for i, w in enumerate(self.voters) if w.endswith(b"*")}
        self.known: dict[bytes, tuple[int, ...]] = {}
        self.heads = {s[:4] for s in self.stems}

    def voters_of(self, word: bytes) -> tuple[int, ...]:
        got = self.known.get(word)
        if got is None:
            found = [self.words[word]] if word in self.words else []
            found += [self.stems[s] for s in stems(word) if s in self.stems] if word[:4] in self.heads else []
            got = tuple(found)
            if len(self.known) < KNOWN_WORDS:
                self.known[word] = got
        return got

    def features(self, text: str | None) -> tuple[list[float], dict[int, int]]:
        """The numeric features, and how often each voter that votes has its word."""
        text = text or ""
        words = words_of(text)
        total, votes = 0, {}
        get = self.known.get
        for word, n in words.items():
            total += n
            hit = get(word)
            if hit is None:
                hit = self.voters_of(word)
            for v in hit:
                votes[v] = votes.get(v, 0) + n
        spoken = sum(votes.values())
        you = bool(votes) and any(m.group(1).lower().encode() in self.words for m in YOU.finditer(text))
        patterns = [bool(SHOUT.search(text)), bool(SIGNS.search(text)), you]
        return [np.log1p(spoken), min(1.0, 50 * spoken / max(total, 1)), np.log1p(len(votes)), *map(float, patterns)], votes

    def matrix(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), len(NUMERIC) + len(self.voters)), np.float32)
        for i, text in enumerate(texts):
            numeric, votes = self.features(text)
            out[i, : len(NUMERIC)] = numeric
            for v, n in votes.items():
                out[i, len(NUMERIC) + v] = min(n, 3) ** 0.5
        return out

    def score(self, texts: list[str | None]) -> list[float]:
        x = self.matrix(texts)
        if self.weights is None:  # nothing was learned: the lexicon decides
            return [float(v) for v in 1 / (1 + np.exp(2 - 4 * x[:, 0]))]
        z = ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
        return [float(v) for v in 1 / (1 + np.exp(-np.clip(z, -30, 30)))]


def choose_voters(counts: DataFrame, toxic: int, clean: int, most: int = MAX_VOTERS) -> list[bytes]:
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    rows = (
        counts.withColumn("odds", odds)
        .where((F.col("toxic") >= LEAST_TEXTS) & (F.col("odds") >= LEAST_ODDS))
        .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "word").limit(most).collect()
    )
    return [bytes(r["word"]) for r in rows] + [
        w.encode() for w in LEXICON if w.encode() not in {bytes(r["word"]) for r in rows}
    ]


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 20, trust: float = 0.98) -> np.ndarray:
    """Probability of label 1 for each row of ``votes`` (rows, voters; 1: it says toxic, 0: nothing).

    The given label is one voter more, right with probability ``trust``. Rates of the others start
    from it and are re-estimated on the posterior; evidence is divided by the correlation left
    between voters once the label is known.
    """
    v = votes.astype(np.float64)
    given = np.where(labels == 1, 1.0, -1.0) * np.log(trust / (1 - trust))
    p = np.where(labels == 1, trust, 1 - trust)
    for _ in range(rounds):
        prior = np.clip(p.mean(), 1e-4, 1 - 1e-4)
        on = (p @ v + 0.05) / (p.sum() + 1)
        off = ((1 - p) @ v + 0.05) / ((1 - p).sum() + 1)
        left = v - np.outer(p, on) - np.outer(1 - p, off)  # what the label does not explain
        spread = np.sqrt((left**2).mean(0)) + 1e-9
        correlation = (left.T @ left) / len(v) / np.outer(spread, spread)
        share = 1 / np.maximum((np.clip(correlation, 0, 1) ** 2).sum(0), 1)
        says = np.log(on / off) * share
        silent = np.log((1 - on) / (1 - off)) * share
        z = np.log(prior / (1 - prior)) + given + v @ says + (1 - v) @ silent
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return p


def train_linear(x: np.ndarray, p: np.ndarray, l2: float = 0.2, rounds: int = 25) -> np.ndarray:
    """Logistic regression on probabilities ``p`` by Newton's method; the last weight is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = l2 * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        bend = (x * (q * (1 - q))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, x.T @ (p - q) - ridge @ w)
        w += step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, training: Column, most: int = MAX_LABELLED) -> Model:
    """A model from the texts of ``docs`` whose doc_id is in ``labels`` (doc_id, label 0 or 1)."""
    chosen = (
        labels.where(training & F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    # at most `most` narrow rows: the texts stay where they are
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    n = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model()
    model = Model(choose_voters(word_counts(rows), n[1], n[0]))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = sent.value

        def work(texts):
            made = [m.features(t) for t in texts]
            return ([numeric for numeric, _ in made], [sorted(v) for _, v in made], [[v[k] for k in sorted(v)] for _, v in made])

        return work

    seen = map_columns(rows.select("doc_id", "text", "label"), ["text"],
                       "numeric array<double>, voters array<int>, times array<int>", make, drop=("text",)).collect()
    seen.sort(key=lambda r: str(r["doc_id"]))
    x = np.zeros((len(seen), len(NUMERIC) + len(model.voters)))
    for i, r in enumerate(seen):
        x[i, : len(NUMERIC)] = r["numeric"]
        for v, k in zip(r["voters"], r["times"]):
            x[i, len(NUMERIC) + v] = min(k, 3) ** 0.5
    y = np.array([r["label"] for r in seen])
    if not len(y) or y.min() == y.max():
        return Model()
    voters = x[:, len(NUMERIC) - len(PATTERNS) :] > 0
    posterior = label_model(voters, y)
    model.mean, model.scale = np.zeros(x.shape[1]), np.maximum(np.abs(x).max(0), 1e-9)
    model.weights = train_linear(x / model.scale, posterior)
    patterns = np.arange(len(NUMERIC) - len(PATTERNS), len(NUMERIC))
    if (against := patterns[model.weights[patterns] < 0]).size:  # a voter says toxic or nothing
        x[:, against] = 0
        model.weights = train_linear(x / model.scale, posterior)
    return model


def score(docs: DataFrame, model: Model, name: str = "score", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the probability that the text is toxic."""
    model.known = {}
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = sent.value
        return lambda texts: (m.score(texts),)

    return map_columns(docs, ["text"], f"`{name}` double", make, drop=drop)


def op9_weak_supervision(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    held_out = F.coalesce(crc32_mod("doc_id", 5) == 0, F.lit(False))
    scored = score(docs, fit(docs, labels, ~held_out), drop=("text",))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
