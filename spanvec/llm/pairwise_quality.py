"""Document quality by Bradley-Terry pairwise ranking.

A document's features are counts over its whole text. A better and a worse
document make a preference pair; the chance that the better one wins is the
logistic function of the difference of their scores, linear in the features. The
weights that make the labelled preferences likeliest are found by Newton steps on
the feature differences. The score quantile that leaves the labelled share of bad
documents below it becomes the threshold, and is mapped to 0.3.

Learning takes at most ``sample_rows`` labelled documents; scoring reads every text.

Defined results for odd input: a NULL text is scored as an empty one; a document
labelled twice with different values teaches nothing; without labels of both kinds
every score is 0.5; a row without an id is scored and not held out; repeated rows
are scored each; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanvec.llm.labelled import held_out, sample_ids, texts_of

THRESHOLD = 0.3
SYMBOLS = b"*$%&#|!?<>{}=_@/\\~^+[]"


def _classes() -> np.ndarray:
    """Which count each byte belongs to."""
    kind = np.full((256, 10), 0.0)
    for b in range(256):
        c = chr(b)
        kind[b] = [
            c in "abcdefghijklmnopqrstuvwxyz", c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ", c in "0123456789", c in " \t",
            c == "\n", c == ".", c in ",;:'\"()-", b in SYMBOLS, b >= 0xC0, b < 32 and c not in "\t\n",
        ]
    return kind


CLASSES = _classes()
FEATURES = 27


def features(text: str) -> list[float]:
    """Counts of the whole text as shares and logarithms."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(data, minlength=256)
    lower, upper, digits, blanks, lines, stops, marks, symbols, wide, control = (counts @ CLASSES).tolist()
    letters, chars = lower + upper + wide, max(1, len(text))
    words = text.split()
    n = max(1, len(words))
    distinct = len(set(words))
    repeats = sum(map(operator.eq, words, words[1:]))
    alternate = sum(map(operator.eq, words, words[2:]))
    alone = sum(counts[b] for b in b"|")
    shares = [
        upper / max(1, letters), digits / chars, blanks / chars, lines / n, stops / n, marks / n, symbols / n,
        symbols / chars, wide / max(1, letters), control / chars, letters / chars, repeats / n, alternate / n, alone / n,
    ]
    logs = [np.log1p(100 * s) for s in (shares[0], shares[1], shares[3], shares[4], shares[5], shares[6], shares[11], shares[12], shares[13])]
    lengths = [np.log1p(len(words)), np.log1p(len(text) / n), np.log(max(1, distinct)) / np.log(max(2, n)), float(not words)]
    return shares + logs + lengths


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    learned: bool = True

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.learned:
            return np.full(len(x), 0.5)
        raw = ((x - self.mean) / self.scale) @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(raw + np.log(THRESHOLD / (1 - THRESHOLD)), -500, 500)))


def fit(x: np.ndarray, label: np.ndarray, *, rounds: int = 4, ridge: float = 1e-3, steps: int = 25, seed: int = 5) -> QualityModel:
    """Weights of a Bradley-Terry model over pairs of a better and a worse row.

    Each round pairs every row of the larger kind with a row of the smaller one, so
    the pairs grow with the rows, not with their square.
    """
    better, worse = x[label == 1], x[label == 0]
    if not len(better) or not len(worse):
        zero = np.zeros(FEATURES)
        return QualityModel(zero, zero + 1, zero, 0.0, False)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    better, worse = (better - mean) / scale, (worse - mean) / scale
    rng = np.random.default_rng(seed)
    size = max(len(better), len(worse))
    gap = np.concatenate([better[rng.permutation(size) % len(better)] - worse[rng.permutation(size) % len(worse)] for _ in range(rounds)])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        lost = 1 / (1 + np.exp(np.clip(gap @ w, -500, 500)))  # chance that the worse one wins
        slope = gap.T @ lost / len(gap) - ridge * w
        curve = (gap * (lost * (1 - lost))[:, None]).T @ gap / len(gap) + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    scores = ((x - mean) / scale) @ w
    return QualityModel(mean, scale, w, float(np.quantile(scores, float((label == 0).mean()))))


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in texts_of(batches, 1):
        rows = [features(t or "") for t in texts]
        yield pa.RecordBatch.from_pydict({"label": part.column(0), "x": pa.array(rows, pa.list_(pa.float64()))})


def learn(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 20_000, seed: int = 5) -> QualityModel:
    """A model from labelled documents outside the held-out fold.

    Only the ids of the sample travel to the texts: ``sample_rows`` rows at most.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("_most"))
    chosen = sample_ids(known.where("label = _most").select("doc_id", F.col("label").cast("int")), sample_rows, seed)
    texts = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").select("label", "text")
    x = texts.mapInArrow(_features_of, "label int, x array<double>")
    rows = x.orderBy(F.xxhash64("x"), "label").limit(sample_rows).toArrow()
    if not rows.num_rows:
        return fit(np.zeros((0, FEATURES)), np.zeros(0))
    return fit(np.array(rows["x"].to_pylist()), rows["label"].to_numpy(), seed=seed)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in texts_of(batches, 1):
            found = sent.value.score(np.array([features(t or "") for t in texts]).reshape(-1, FEATURES))
            yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "score": pa.array(found, pa.float64())})

    kind = dict(docs.dtypes)["doc_id"]
    scored = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, score double")
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The documents, all their columns, that the model accepts."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in texts_of(batches, text_at):
            found = sent.value.score(np.array([features(t or "") for t in texts]).reshape(-1, FEATURES))
            yield part.filter(pa.array(found >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
