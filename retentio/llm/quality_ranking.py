"""Quality classifier: Bradley-Terry pairwise ranking.

Texts become a fixed vector of ratios (one pass, Arrow batches).  Preference
pairs (a label-1 text over a label-0 text) train a linear score by logistic
loss on feature differences.  The score's empirical quantile among the
training texts, bent so that the quantile at the share of label 0 lands on
``cut``, is the returned score; a text is predicted good from ``cut`` on.

Training uses at most ``max_labelled`` labelled rows (those with the smallest
hash of id, the same in every run) and ``max_pairs`` pairs; scoring covers
every row.

Defined results: NULL or empty text is the zero vector and is scored like any
other; NULL ids are scored but never learnt from; rows whose label is NULL
are not learnt from; repeated rows get equal scores; without both labels
every score is 1; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.llm.common import WORD, table

FEATURES = ("log_words", "mean_word_length", "symbols", "exclaims", "capitals", "digits", "same_as_previous",
            "repeated_triples", "distinct_words", "repeated_lines", "short_lines", "bare_symbols", "worst")
_WORD = re.compile(WORD)
_SYMBOL = re.compile(r"[#*$%&|<>@~^=+{}\\\[\]_]")
_CAPITAL = re.compile(r"[A-Z]")
_DIGIT = re.compile(r"[0-9]")
_BARE = re.compile(r"(?:^|(?<=\s))[^\w\s]+(?=\s|$)")


def features(text: str | None) -> list[float]:
    words = _WORD.findall(text or "")
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    triples = list(zip(words, words[1:], words[2:]))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    symbols = len(_SYMBOL.findall(text)) / n
    exclaims = text.count("!") / n
    capitals = len(_CAPITAL.findall(text)) / chars
    same = sum(map(str.__eq__, words, words[1:])) / n
    repeated = 1 - len(set(triples)) / len(triples) if triples else 0.0
    repeated_lines = 1 - len(set(lines)) / len(lines) if lines else 0.0
    return [np.log1p(n), chars / n, min(symbols, 2.0), min(exclaims, 2.0), capitals,
            len(_DIGIT.findall(text)) / chars, same, repeated, len(set(words)) / n, repeated_lines,
            sum(len(x) < 20 for x in lines) / max(1, len(lines)), min(len(_BARE.findall(text)) / n, 1.0),
            max(min(symbols, 1.0), min(exclaims, 1.0), min(1.0, 2 * capitals), same, repeated, repeated_lines)]


@dataclass(frozen=True)
class Ranking:
    """A fitted ranking: standardisation, weights and the score's quantile knots."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray          # raw scores
    levels: np.ndarray         # returned scores at the knots
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.ones(len(x))
        raw = ((x - self.mean) / self.scale).clip(-8, 8) @ self.weights
        return np.interp(raw, self.knots, self.levels)


def bradley_terry(difference: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights that maximise the likelihood of ``w . difference > 0`` (Newton steps)."""
    w = np.zeros(difference.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(difference @ w).clip(-30, 30)))
        gradient = difference.T @ (1 - p) - ridge * w
        hessian = (difference * (p * (1 - p))[:, None]).T @ difference + ridge * np.eye(len(w))
        move = np.linalg.solve(hessian, gradient)
        w = w + move
        if np.abs(move).max() < 1e-6:
            break
    return w


def fit(x: np.ndarray, label: np.ndarray, cut: float = 0.3, max_pairs: int = 200_000, seed: int = 7) -> Ranking:
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]), np.empty(0), np.empty(0), cut)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = ((x - mean) / scale).clip(-8, 8)
    rng = np.random.default_rng(seed)
    n = min(max_pairs, len(good) * len(bad))
    w = bradley_terry(z[rng.choice(good, n)] - z[rng.choice(bad, n)])
    raw = np.sort(z @ w)
    level = np.linspace(0, 1, len(raw))
    at = len(bad) / len(label)
    knots, levels = raw, np.where(level < at, cut * level / at, cut + (1 - cut) * (level - at) / max(1 - at, 1e-9))
    knots, first = np.unique(knots, return_index=True)
    return Ranking(mean, scale, w, knots, levels[first], cut)


def training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int, label_col: str, fold: int) -> DataFrame:
    """Features and label of the sampled labelled rows outside the held-out fold."""
    chosen = (labels.select(F.col("doc_id").alias("_id"), F.col(label_col).alias("_label"))
              .filter(F.col("_id").isNotNull() & F.col("_label").isNotNull()
                      & (F.crc32(F.col("_id").cast("string")) % fold != 0))
              .orderBy(F.xxhash64("_id"), "_label").limit(max_labelled))     # the documented bound
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("_text"))
    return rows.join(F.broadcast(chosen), "_id").select("_text", F.col("_label").cast("long").alias("_label"))


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", cut: float = 0.3,
          max_labelled: int = 20_000, max_pairs: int = 200_000, fold: int = 5) -> Ranking:
    def measure(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([features(t.as_py()) for t in b.column("_text")], pa.list_(pa.float64())),
                 b.column("_label")], names=["x", "label"])

    sample = (training_rows(docs, labels, max_labelled, label_col, fold)
              .mapInArrow(measure, "x array<double>, label long").toArrow())
    x = np.array(sample.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    label = sample.column("label").to_numpy()
    order = np.lexsort([*x.T, label])          # the same model whatever order the rows came in
    return fit(x[order], label[order], cut, max_pairs)


def score_documents(docs: DataFrame, ranking: Ranking, fold: int = 5) -> DataFrame:
    """Every document with ``held_out``, ``score`` and ``predicted``."""
    src = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("_text"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def score(batches):
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column("_text")], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ranking.score(x))], names=["doc_id", "score"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % fold == 0, F.lit(False))
    return src.mapInArrow(score, f"doc_id {id_type}, score double").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= ranking.cut).cast("int").alias("predicted"))


def query(spark, sf_dir):
    """op5: quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, learn(docs, table(spark, sf_dir, "labels")))
