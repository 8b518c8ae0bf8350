"""Toxicity by weak supervision: many voters, a label model of their accuracies and correlations, and a
linear classifier trained on its posterior labels."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tidemark.llm.common import staged, text_batches

#: Training is bounded: this many labelled rows of each class, and this many words.
ROWS_PER_CLASS, WORDS = 10_000, 20_000
LEXICON_WORDS = 200
#: Standard errors by which a word's frequencies in the two classes must differ.
SURE = 3.0

# Word lists of the fixed lexicon voters.
LEXICONS = {
    "insults": "idiot idiots moron morons imbecile fool clown loser losers jerk creep cretin dunce halfwit lunatic pig rat coward liar",
    "contempt": "stupid dumb pathetic worthless disgusting useless ridiculous vile filthy repulsive hideous wretched",
    "objects": "trash garbage scum filth vermin dirt waste rubbish sewage parasite parasites",
    "threats": "kill murder strangle slaughter lynch shoot",
    "other_languages": "idiota imbécil estúpido estúpida basura escoria payaso idiote imbécile stupide ordure clochard "
    "dumm dummkopf trottel abschaum müll versager widerlich",
}

words_of = re.compile(r"[^\W\d_]+").findall
_SHOUTED = re.compile(r"\b[A-Z]{4,}\b.*\b[A-Z]{4,}\b|!{3,}")
_ADDRESSED = re.compile(r"\b(?:you|this|that|are|is|such|a|an|der|die|le|la|el)\W+([^\W\d_]+)", re.I)


@dataclass
class Voters:
    """Each voter says 1 (toxic), 0 (clean) or 2 (abstains) of a text; ``mined`` are learned lexicons."""

    mined: list[frozenset] = field(default_factory=list)

    def __post_init__(self):
        self.fixed = [frozenset(x.split()) for x in LEXICONS.values()]
        self.all = frozenset().union(*self.fixed, *self.mined)

    def votes(self, text: str, words: set[str]) -> list[int]:
        hits = words & self.all
        out = [1 if hits & x else 2 for x in self.fixed]
        out += [1 if hits & x else 0 for x in self.mined]
        rare = self.mined or self.fixed
        out.append(1 if sum(bool(hits & x) for x in rare) >= 2 else 2)
        out.append(1 if len(hits) >= 3 else 2 if hits else 0)
        out.append(1 if hits and any(w.lower() in hits for w in _ADDRESSED.findall(text)) else 2)
        out.append(1 if hits and _SHOUTED.search(text) else 2)
        return out


class LabelModel:
    """p(class) times a tree of class-conditional votes: each voter depends on the class and one other voter.

    Fitted by expectation maximisation over counted vote vectors. Accuracies are the voters' tables
    given the class; correlations are the edges of the tree, those with the largest mutual information
    given the class under the current posterior. The first voter is taken as mostly right to start
    from; the majority of the other votes stands in where it abstains.
    """

    def __init__(self, votes: np.ndarray, counts: np.ndarray, prior: float, rounds: int = 30):
        toxic, clean = (votes[:, 1:] == 1).sum(1), (votes[:, 1:] == 0).sum(1)
        majority = np.clip((toxic + prior) / (toxic + clean + 1), 0.02, 0.98)
        self.posterior = np.where(votes[:, 0] == 2, majority, 0.8 * (votes[:, 0] == 1) + 0.2 * majority)
        self.prior, self.parents = prior, [-1] * votes.shape[1]
        for _ in range(rounds):
            self._maximise(votes, counts)
            new = self.predict(votes)
            if np.abs(new - self.posterior).max() < 1e-6:
                break
            self.posterior = new

    def _pair(self, votes, weight, i, j):
        table = np.bincount(votes[:, i] * 3 + votes[:, j], weight, 9).reshape(3, 3) + 0.1
        return table / table.sum()

    def _maximise(self, votes, counts):
        weights = [counts * (1 - self.posterior), counts * self.posterior]
        total = sum(w.sum() for w in weights)
        n = votes.shape[1]
        info = np.zeros((n, n))
        for w in weights:
            for i in range(n):
                for j in range(i):
                    p = self._pair(votes, w, i, j)
                    info[i, j] += w.sum() / total * (p * np.log(p / p.sum(1, keepdims=True) / p.sum(0, keepdims=True))).sum()
        info += info.T
        inside, self.parents = [0], [-1] * n  # the largest spanning tree, from the first voter on
        while len(inside) < n:
            rest = [i for i in range(n) if i not in inside]
            gain, child, parent = max((info[i, j], -i, j) for i in rest for j in inside)
            self.parents[-child] = parent
            inside.append(-child)
        self.tables = []
        for w in weights:
            own = []
            for i, parent in enumerate(self.parents):
                if parent < 0:
                    p = np.bincount(votes[:, i], w, 3) + 0.3
                    own.append(np.tile(p / p.sum(), (3, 1)))
                else:
                    p = self._pair(votes, w, parent, i)
                    own.append(p / p.sum(1, keepdims=True))
            self.tables.append(own)

    def predict(self, votes: np.ndarray) -> np.ndarray:
        """The probability of class 1 of each vote vector."""
        odds = np.log(self.prior) - np.log1p(-self.prior)
        total = np.full(len(votes), odds)
        for i, parent in enumerate(self.parents):
            given = votes[:, parent] if parent >= 0 else np.zeros(len(votes), int)
            total += np.log(self.tables[1][i][given, votes[:, i]]) - np.log(self.tables[0][i][given, votes[:, i]])
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))

    def accuracies(self, votes: np.ndarray, counts: np.ndarray) -> list[float]:
        """The estimated share of right votes among those each voter cast."""
        out = []
        for i in range(votes.shape[1]):
            v = votes[:, i]
            cast = counts * (v != 2)
            out.append(float((cast * np.where(v == 1, self.posterior, 1 - self.posterior)).sum() / max(cast.sum(), 1e-9)))
        return out


@dataclass
class Classifier:
    """A linear model over the words a text holds and the votes cast on it."""

    voters: Voters
    weights: dict[str, float] = field(default_factory=dict)
    vote_weights: np.ndarray | None = None
    bias: float = -30.0

    def margin(self, text: str) -> float:
        words = set(words_of(text.lower()))
        total = self.bias
        for w in words & self.weights.keys():
            total += self.weights[w]
        if self.vote_weights is not None:
            total += sum(self.vote_weights[i, v] for i, v in enumerate(self.voters.votes(text, words)))
        return total

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(text), -30, 30))))


def _fit_logistic(rows: list[np.ndarray], size: int, target: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 300):
    """Weights of a sparse logistic regression by accelerated gradient steps; the last one is the bias."""
    sizes = np.array([len(r) for r in rows])
    column = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    often = np.bincount(column, weight[row], size)
    scale = 1 / np.sqrt(often / weight.sum() + 1e-4)  # each column's own step
    w, b, m, mb = np.zeros(size), 0.0, np.zeros(size), 0.0
    rate = 1.0 / max(1.0, float(sizes.mean() if len(rows) else 1))
    for _ in range(rounds):
        z = np.bincount(row, w[column], len(rows)) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / weight.sum()
        grad = np.bincount(column, error[row], size) + ridge * w / len(rows)
        m = 0.9 * m + grad * scale**2
        mb = 0.9 * mb + error.sum()
        w -= 4 * rate * m
        b -= 4 * rate * mb
    return w, b


def _word_rows(docs: DataFrame) -> DataFrame:
    """Documents with their distinct words and the smallest hash of their three-word shingles."""

    def run(batches):
        for keys, texts in text_batches(batches):
            lists = [words_of(t.lower()) for t in texts]
            sketch = [min((xxh3_64_intdigest(" ".join(x[i : i + 3])) >> 1 for i in range(max(1, len(x) - 2)))) for x in lists]
            words = pa.array([sorted(set(x)) for x in lists], pa.list_(pa.string()))
            columns = [pa.array(keys, pa.int64()), pa.array(texts), words, pa.array(sketch, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "words", "sketch"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, text string, words array<string>, sketch bigint")


def _labelled(docs: DataFrame, labels: DataFrame, rows_per_class: int) -> DataFrame:
    """(doc_id, toxic, text, words) of at most ``rows_per_class`` rows of each class.

    Of rows with the same smallest shingle hash one is used, so that a group of copies or near copies
    does not make its words look like signs of its class.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    by_hash = [F.xxhash64("doc_id"), "doc_id"]
    chosen = [known.filter(F.col("toxic") == y).orderBy(*by_hash).limit(rows_per_class) for y in (0, 1)]
    # At most rows_per_class rows of either class: a bound on what is broadcast.
    chosen = F.broadcast(chosen[0].union(chosen[1]).withColumnRenamed("doc_id", "id2"))
    rows = docs.filter("text IS NOT NULL").select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("id2")).select("doc_id", "toxic", "text")
    found = _word_rows(rows).join(F.broadcast(chosen), F.col("doc_id") == F.col("id2")).drop("id2")
    return found.dropDuplicates(["sketch", "toxic"]).drop("sketch")


def _lift(n: tuple[int, int]):
    """Log of how much oftener a row of class 1 holds a word (a and b: rows of class 1 and 0 that do)."""
    return F.log((F.col("a") + 0.5) / (F.col("b") + 0.5) * ((n[0] + 1) / (n[1] + 1)))


def _sureness(n: tuple[int, int]):
    """The same in standard errors."""
    return _lift(n) / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))


def _mined(words: DataFrame, n: tuple[int, int]) -> list[frozenset]:
    """Two lexicons of words that toxic rows hold far more often, learned from either half of the rows."""
    out = []
    for half in (0, 1):
        own = words.filter(F.col("half") == half).groupBy("word").agg(
            F.sum("toxic").alias("a"), F.sum(F.lit(1) - F.col("toxic")).alias("b")
        )
        top = own.filter((F.col("a") >= n[1] / 100) & (_lift(n) > 2) & (_sureness(n) >= SURE)).orderBy(F.desc("a"), "word").limit(LEXICON_WORDS)
        out.append(frozenset(r.word for r in top.collect()))
    return out


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Classifier:
    """A classifier from documents (doc_id, text) and labels (doc_id, toxic).

    At most ``rows_per_class`` labelled rows of each class are used, those with the smallest hash of
    their doc_id, and at most ``WORDS`` words, those most tied to a class. Labels pick the mined
    lexicons and the final calibration and are one voter; the classifier itself learns from the
    label model's posterior. Without labelled rows of both classes every score is zero.
    """
    counted = labels.filter("toxic IN (0, 1)").groupBy("toxic").count().collect()
    total = {r.toxic: r["count"] for r in counted}
    rows = staged(_labelled(docs, labels, rows_per_class), "labelled-words")
    n = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not (n.get(0) and n.get(1)):
        return Classifier(Voters())
    exploded = rows.select("toxic", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half"), F.explode("words").alias("word"))
    voters = Voters(_mined(exploded, (n[0], n[1])))
    by_word = exploded.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(F.lit(1) - F.col("toxic")).alias("b"))
    tied = by_word.withColumn("tie", F.abs(_sureness((n[0], n[1])))).filter(F.col("tie") >= SURE)
    vocabulary = {r.word: i for i, r in enumerate(tied.orderBy(F.desc("tie"), "word").limit(WORDS).select("word").collect())}

    def encode(batches):
        for batch in batches:
            texts, words = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ids = [sorted(vocabulary[w] for w in x if w in vocabulary) for x in words]
            votes = [bytes(voters.votes(t, set(x))) for t, x in zip(texts, words, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(3), pa.array(ids, pa.list_(pa.int32())), pa.array(votes, pa.binary())],
                ["doc_id", "toxic", "ids", "votes"],
            )

    made = rows.select("text", "words", "doc_id", "toxic").mapInArrow(encode, "doc_id bigint, toxic int, ids array<int>, votes binary")
    got = sorted(made.collect(), key=lambda r: (r.doc_id, r.toxic))  # rows_per_class bounds it
    votes = np.array([list(r.votes) for r in got], int)
    truth = np.array([r.toxic for r in got])
    weight = np.where(truth == 1, total[1] / n[1], total[0] / n[0]).astype(float)  # as if no class had been cut
    prior = min(0.5, max(0.001, total[1] / (total[0] + total[1])))
    cast = np.concatenate([truth[:, None], votes], 1)  # the labels are a voter too, of unknown accuracy
    kinds, which = np.unique(cast, axis=0, return_inverse=True)
    label_model = LabelModel(kinds, np.bincount(which.ravel(), weight), prior)
    soft = label_model.predict(cast)
    size = len(vocabulary)
    columns = [np.concatenate([np.array(r.ids, np.int64), size + 3 * np.arange(votes.shape[1]) + v]) for r, v in zip(got, votes, strict=True)]
    w, b = _fit_logistic(columns, size + 3 * votes.shape[1], soft, weight, ridge=1.0)
    z = np.array([w[c].sum() + b for c in columns])
    a, c = _calibrated(z, truth, weight)
    words = {x: float(a * w[i]) for x, i in vocabulary.items() if w[i]}
    return Classifier(voters, words, a * w[size:].reshape(-1, 3), float(a * b + c))


def _calibrated(z: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities of the labels (Newton steps)."""
    a, c = 1.0, 0.0
    spread = z.std() or 1.0
    z = z / spread
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + c, -30, 30)))
        g = weight * (p - truth)
        h = weight * np.maximum(p * (1 - p), 1e-6)
        grad = np.array([(g * z).sum() + 0.05 * a, g.sum()])
        hess = np.array([[(h * z * z).sum() + 0.05, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        a, c = a - step[0], c - step[1]
    return a / spread, c


def predict(docs: DataFrame, model: Classifier, name: str = "score") -> DataFrame:
    """``docs`` (text, ...) with ``name`` (0 to 1) added; other columns are kept, but one of that name is replaced.

    A null text counts as empty; a long one is scored whole. Equal texts have equal scores.
    """
    docs = docs.drop(name)
    place = docs.columns.index("text")
    names = [*docs.columns, name]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        for batch in batches:
            scores = [model.score(t.as_py() or "") for t in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names)

    return docs.mapInArrow(run, f"{fields}, `{name}` double")
