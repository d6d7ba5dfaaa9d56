"""Quality scores by positive-unlabelled learning.

Trusted positives are the rows labelled 1; the unlabelled web text is every
document of the training fold, its label unread. A linear model of text-shape
features is fitted to the non-negative unbiased risk

    prior * R+(positives)  +  max(0, R-(unlabelled) - prior * R-(positives))

with the logistic loss; where the second part falls below 0, the step goes up
that part instead, so the model cannot gain by calling every positive certain.
The class prior is estimated: the share of label 1 among the labelled rows, or,
where no row is labelled 0, the lowest ratio of unlabelled to positive mass above
any score of a first fit, on the halves that fit did not see.

Features of the whole text: frequencies of hashed trigrams of character classes
(a letter is only a lower or an upper one, a digit a digit; marks stay), and
binned measures: words, their length, repeats, lines, marks, capitals, digits.

Each side of the fit has at most twice ``TRAIN_ROWS`` whole texts, picked by a
hash. Null and empty texts have the features of no words and are scored like any
other. Repeated rows are scored row by row; a doc_id labelled both ways is no
positive. Without any positive all scores are the prior. Extra columns of any
name are not read. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import balanced, sampled
from .language_id import held_out

TRAIN_ROWS = 6000
BUCKETS = 256
# The quantiles that cut a measure into bins, finer at the ends.
CUTS = (0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.94, 0.97, 0.99)
THRESHOLD = 0.3
STEPS = 800
RATE = 0.05
DECAY = 1e-5

# Latin-1 bytes to character classes: lower, upper, digit; blanks by kind; marks and other bytes as they are.
_CLASSES = np.arange(256, dtype=np.int64)
_CLASSES[[c for c in range(256) if chr(c).islower()]] = ord("a")
_CLASSES[[c for c in range(256) if chr(c).isupper()]] = ord("A")
_CLASSES[[c for c in range(256) if chr(c).isdigit()]] = ord("0")
MEASURES = 9


def text_features(text: str | None) -> np.ndarray:
    """MEASURES numbers and BUCKETS trigram frequencies."""
    out = np.zeros(MEASURES + BUCKETS, np.float32)
    raw = (text or "").encode("latin-1", "replace")
    words = raw.split()
    if not words:
        return out
    cls = _CLASSES[np.frombuffer(raw, np.uint8)]
    n, letters = len(cls), max(int(((cls == 97) | (cls == 65)).sum()), 1)
    blank = (cls == 32) | ((cls >= 9) & (cls <= 13))
    distinct = set(words)
    lines = [x for x in raw.split(b"\n") if x]
    most = max(words.count(w) for w in sorted(distinct)[:1]) if len(distinct) == 1 else 0
    out[:MEASURES] = (
        np.log(len(words)), np.log(n / len(words)), len(distinct) / len(words) * np.log(len(words) + 1),
        (cls == 65).sum() / letters, (cls == 48).sum() / n, 1 - (letters + blank.sum()) / n,
        len(set(lines)) / len(lines), np.log(n / len(lines)), sum(a == b for a, b in zip(words, words[1:])) / len(words) + (most == len(words) > 1))
    if n > 2:
        grams = (cls[:-2] * 961 + cls[1:-1] * 31 + cls[2:]) * 2654435761 >> 7
        out[MEASURES:] = np.sqrt(np.bincount(grams % BUCKETS, minlength=BUCKETS) / (n - 2))
    return out


def _features(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([text_features(t.as_py()).tobytes() for t in b.column(0)], pa.binary())], ["x"])

    return balanced(docs.select(F.col("text").cast("string").alias("text"))).mapInArrow(run, "x binary")


def _collected(docs: DataFrame) -> np.ndarray:
    rows = [np.frombuffer(r["x"], np.float32) for r in _features(docs).collect()]  # a bounded sample
    return np.array(rows, dtype=np.float64).reshape(len(rows), MEASURES + BUCKETS)


def design(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Binned measures (one column a bin) beside the trigram frequencies."""
    bins = [(np.searchsorted(cuts[i], x[:, i], "right")[:, None] == np.arange(len(CUTS) + 1)) for i in range(MEASURES)]
    return np.concatenate([*bins, 4 * x[:, MEASURES:], np.ones((len(x), 1))], axis=1).astype(np.float64)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def risk(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the unbiased risk: prior R+(p), and R-(u) - prior R-(p)."""
    zp, zu = p @ w, u @ w
    return prior * softplus(-zp).mean(), softplus(zu).mean() - prior * softplus(zp).mean()


def step_direction(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Gradient of the non-negative risk; of minus its second part where that is negative."""
    zp, zu = p @ w, u @ w
    second = u.T @ sigmoid(zu) / len(u) - prior * (p.T @ sigmoid(zp)) / len(p)
    if softplus(zu).mean() - prior * softplus(zp).mean() < 0:
        return -second
    return prior * (p.T @ (sigmoid(zp) - 1)) / len(p) + second


def minimise(p: np.ndarray, u: np.ndarray, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights after ``steps`` Adam steps over both whole samples."""
    w, m, v = np.zeros(p.shape[1]), np.zeros(p.shape[1]), np.zeros(p.shape[1])
    for t in range(1, steps + 1):
        g = step_direction(w, p, u, prior) + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def lowest_ratio(p: np.ndarray, u: np.ndarray, least: float = 0.5) -> float:
    """min over thresholds of (share of u above) / (share of p above), where at
    least the share ``least`` of p is above."""
    cuts = np.quantile(p, np.linspace(0, 1 - least, 50))
    return float(min(1.0, min((u >= c).mean() / (p >= c).mean() for c in cuts)))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, prior: float | None = None) -> dict:
    """The model from (doc_id, text) and (doc_id, quality)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .where("doc_id is not null and quality is not null").groupBy("doc_id") \
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    n = marks.agg(F.count_if(F.col("low") >= 1).alias("ones"), F.count_if(F.col("high") <= 0).alias("zeros")).first()
    if prior is None and n["zeros"]:
        prior = n["ones"] / (n["ones"] + n["zeros"])
    trusted = sampled(marks.where(F.col("low") >= 1).select("doc_id"), ["doc_id"], train_rows, n["ones"])
    # the ids are a bounded sample; the texts of repeated rows are bounded again
    positives = texts.join(F.broadcast(trusted), "doc_id", "left_semi").limit(2 * train_rows)
    p, u = _collected(positives), _collected(sampled(texts, ["doc_id", "text"], train_rows))
    if not len(p) or not len(u):
        return {"w": None, "prior": 1.0 if prior is None else prior}
    both = np.concatenate([p, u])
    cuts = np.quantile(both[:, :MEASURES], CUTS, axis=0).T
    p, u = design(p, cuts), design(u, cuts)
    if prior is None:
        first = minimise(p[::2], u[::2], 0.5)
        prior = lowest_ratio(p[1::2] @ first, u[1::2] @ first)
    return {"w": minimise(p, u, prior), "cuts": cuts, "prior": prior}


def scores(x: np.ndarray, model: dict) -> np.ndarray:
    if model["w"] is None:
        return np.full(len(x), model["prior"])
    return sigmoid(design(x, model["cuts"]) @ model["w"])


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one weight a feature

    def run(batches):
        for b in batches:
            x = np.array([text_features(t.as_py()) for t in b.column(1)], dtype=np.float64).reshape(b.num_rows, MEASURES + BUCKETS)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(x, shared.value), pa.float64())], ["doc_id", "score"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return balanced(read).mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted; learnt from the rows not held out."""
    kept = lambda df: df.where(~held_out("doc_id"))
    model = fit(kept(docs), kept(labels))
    return score_documents(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
