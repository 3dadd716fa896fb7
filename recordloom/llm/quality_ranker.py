"""Quality classifier learned from preferences (Bradley-Terry).

A document marked good is preferred to one marked bad. The probability of that is the logistic function of the difference of
their scores, and a score is linear in features of the text, so the loss is logistic regression on feature
differences. The threshold is the quantile of the scores at which the marks are told apart best; published scores
put it at 0.3.

Weights are fitted on a bounded sample of marked rows (``SAMPLE``, the rows of lowest hash); scoring reads every text
once and shuffles nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.texts import batches, stage

SAMPLE = 16_000  # marked rows the weights are fitted on
PAIRS = 60_000  # preferences drawn from them
THRESHOLD = 0.3
FOLDS = 5
RIDGE = 1e-3
QUANTILES = 2000
SMOOTH = 200  # bytes of neutral text that every text is thought to have besides its own
SMOOTH_WORDS = 30

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGIT = bytes(range(48, 58))
SYMBOL = b"#*$%&<>@~^=_{}\\"
CLASSES = (UPPER, DIGIT, SYMBOL, b"|", b"!?", b".,;:")
FEATURES = len(CLASSES) + 6


def features(text: bytes) -> list[float]:
    """What the score sees of a text; all are bounded or grow with a logarithm."""
    n_bytes = max(1, len(text))
    words = text.split()
    n = max(1, len(words))
    # in a short text a single number or capital must not weigh like a habit
    shares = [(len(text) - len(text.translate(None, kind))) / (n_bytes + SMOOTH) for kind in CLASSES]
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    return [
        *map(np.sqrt, shares),
        np.log1p(len(words) / SMOOTH_WORDS),
        np.log((n_bytes + 6 * SMOOTH_WORDS) / (n + SMOOTH_WORDS)),
        np.log((len(set(words)) + SMOOTH_WORDS) / (n + SMOOTH_WORDS)),
        repeats / (n + SMOOTH_WORDS),
        (len(lines) - len(set(lines))) / (len(lines) + 2),
        np.log((n + SMOOTH_WORDS) / (len(lines) + 2)),
    ]


def matrix(texts: list[bytes | None]) -> np.ndarray:
    return np.array([features(text or b"") for text in texts], float).reshape(len(texts), FEATURES)


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float  # raw score at the chosen quantile

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.clip(self.raw(x) - self.cut, -30, 30) + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-at))


def fit_pairs(x: np.ndarray, marks: np.ndarray, pairs: int = PAIRS) -> Ranker:
    """Weights from preferences between marked rows, by Newton's method on the logistic loss.

    Without rows of both marks nothing can be learned: every text then scores above the threshold.
    """
    good, bad = np.flatnonzero(marks == 1), np.flatnonzero(marks == 0)
    if not len(good) or not len(bad):
        return Ranker(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), -1.0)
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.clip((x - mean) / scale, -8, 8)
    n = min(pairs, len(good) * len(bad))
    turn = np.arange(n)
    difference = z[good[turn % len(good)]] - z[bad[(turn + turn // len(good)) % len(bad)]]
    w = np.zeros(FEATURES)
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(difference @ w, -30, 30)))  # of the wrong order
        gradient = RIDGE * w - difference.T @ p / n
        hessian = RIDGE * np.eye(FEATURES) + (difference * (p * (1 - p))[:, None]).T @ difference / n
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    raw = z @ w
    return Ranker(mean, scale, w, best_quantile(raw, marks))


def best_quantile(raw: np.ndarray, marks: np.ndarray) -> float:
    """The score quantile with the highest mean of the two marks' hit rates; the middle one of equals."""
    levels = np.quantile(raw, np.linspace(0, 1, QUANTILES + 1))
    good, bad = np.sort(raw[marks == 1]), np.sort(raw[marks == 0])
    hit = 1 - np.searchsorted(good, levels) / len(good) + np.searchsorted(bad, levels) / len(bad)
    best = np.flatnonzero(hit >= hit.max() - 1e-12)
    return float(levels[best[0]] + levels[best[-1]]) / 2


def fold(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Ranker:
    """Learns from marked rows outside the held-out fold.

    Marks other than 0 and 1 are ignored; an id marked both ways counts as 0. At most ``sample`` ids are used, those of lowest
    hash, and only their features reach the driver.
    """
    marked = labels.where(F.col(label_col).isin(0, 1) & (fold(id_col) != 0)).groupBy(F.col(id_col).alias("id"))
    marks = marked.agg(F.min(label_col).cast("int").alias("mark"))
    chosen = stage(marks.orderBy(F.xxhash64("id"), "id").limit(sample), "marked")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(chosen, "id")

    def run(part: pa.RecordBatch) -> dict:
        x = matrix(part.column("text").cast(pa.binary()).to_pylist())
        rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float64()))
        return {"id": part.column("id"), "mark": part.column("mark"), "x": rows}

    found = batches(texts, {"id": "id", "mark": "mark", "text": "text"}, run, "id bigint, mark int, x array<double>")
    table = found.toArrow().sort_by("id")
    x = np.array(table.column("x").to_pylist(), float).reshape(-1, FEATURES)
    return fit_pairs(x, np.array(table.column("mark").to_pylist(), int))


def score(docs: DataFrame, ranker: Ranker, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row; a NULL text scores as an empty one."""

    def run(part: pa.RecordBatch) -> dict:
        x = matrix(part.column("text").cast(pa.binary()).to_pylist())
        return {"doc_id": part.column("doc_id"), "score": pa.array(ranker.score(x))}

    return batches(docs, {"doc_id": id_col, "text": text_col}, run, "doc_id {id}, score double")


def score_column(ranker: Ranker, text_col: str = "text") -> Column:
    """The score as a column, for filters that keep the other columns as they are."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(ranker.score(matrix([t.encode("utf-8") for t in texts.fillna("")])))

    return scored(F.col(f"`{text_col}`"))
