"""Quality classifier: Naive Bayes support vectors over hashed n-gram indicators."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField

from .arrow import WORD, Memo, WordTable, grams, labelled_sample, map_texts, pieces

DIM = 1 << 18
_AGAIN = (4, 16, 64)


class _Kinds(dict):
    """For str.translate: letters as x or X, digits as d, other signs of ASCII as they are, all else as x."""

    def __missing__(self, c: int) -> str:
        kind = self[c] = "x" if c > 127 or chr(c).islower() else "X" if chr(c).isupper() else "d" if chr(c).isdigit() else chr(c)
        return kind


_KINDS = _Kinds()
_SHAPES = Memo(lambda kinds: xxhash.xxh3_64_intdigest(re.sub(r"(.)\1+", r"\1+", kinds).encode()) >> 1, 4 << 20)


def _row(word: str) -> tuple[int, int]:
    """Hash of the word in lower case, and of its shape, where runs of one kind of character count as two."""
    return xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "surrogatepass")) >> 1, _SHAPES[word.translate(_KINDS)]


class Indicators:
    """The distinct features of a text: words and their 2-grams, shapes and their 2- and 3-grams, and runs of words seen before in it.

    For the last, each 3-gram of words that occurred earlier in the text is marked; n marks in a row are one n-gram of marks.
    A long text is taken by pieces with the last two words carried over.
    """

    def __init__(self):
        self.table = WordTable(_row, 2)
        self.place = np.zeros(DIM, np.int32)

    def of(self, text: str) -> np.ndarray:
        found, words, last = [], [], np.zeros((0, 2), np.uint64)
        for piece in pieces(text):
            rows = np.concatenate([last, self.table.of(WORD.findall(piece)).astype(np.uint64)])
            word, shape = rows[len(last) :, 0], rows[:, 1]
            words.append(word)
            for salt, h in enumerate((word, shape[len(last) :], grams(shape, 2), grams(shape, 3), grams(rows[-len(word) - 1 :, 0], 2))):
                found.append(self._distinct(self._bucket(h, salt)))
            last = rows[-2:]
        marks = self._again(np.concatenate(words))
        found += [np.array([DIM - 1 - k]) for k, n in enumerate(_AGAIN) if marks >= n]
        return self._distinct(np.concatenate(found)).astype(np.int32)

    def _distinct(self, x: np.ndarray) -> np.ndarray:
        """Each value once, in no order; values are under DIM."""
        order = np.arange(len(x), dtype=np.int32)
        self.place[x] = order
        return x[self.place[x] == order]

    @staticmethod
    def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
        return ((h * np.uint64(2 * salt + 0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(DIM - len(_AGAIN))).astype(np.int64)

    @staticmethod
    def _again(words: np.ndarray) -> int:
        """The longest run of 3-grams that occurred before."""
        g = grams(words, 3)
        if not len(g):
            return 0
        seen = np.ones(len(g) + 2, bool)
        seen[np.concatenate([[0], np.unique(g, return_index=True)[1] + 1, [len(g) + 1]])] = False
        return int(np.diff(np.flatnonzero(~seen)).max()) - 1


@dataclass(frozen=True)
class NbSvm:
    """margin = (weights over the features + bias) / their length; chance = 1 / (1 + exp(-(slope margin + shift)))."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, features: np.ndarray) -> float:
        return float((self.weights[features].sum(dtype=np.float64) + self.bias) / np.sqrt(1.0 + self.squares[features].sum(dtype=np.float64)))

    def chance(self, margin: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500))))


def fit(features: list[np.ndarray], y: np.ndarray, c: float = 1.0, epochs: int = 20, seed: int = 7) -> NbSvm:
    """Class log-count ratios scale the indicators; dual coordinate descent fits the hinge loss; a logistic curve maps margins.

    Both classes weigh the same. Without examples of both classes every score is the share of class 1, or 0.5 without any.
    """
    n, ones = len(y), int(y.sum())
    if not 0 < ones < n:
        share = min(max(ones / n, 1e-6), 1 - 1e-6) if n else 0.5
        zero = np.zeros(DIM, np.float32)
        return NbSvm(zero, zero, 0.0, 0.0, float(np.log(share / (1 - share))))
    p, q = np.ones(DIM), np.ones(DIM)
    for f, label in zip(features, y):
        (p if label else q)[f] += 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    ratio -= np.log(ones + 1) - np.log(p.sum()) - np.log(n - ones + 1) + np.log(q.sum())  # against rows of the class, not features
    values = [ratio[f] for f in features]
    norms = np.array([np.sqrt(1.0 + v @ v) for v in values])
    values = [v / s for v, s in zip(values, norms)]
    sign = np.where(y == 1, 1.0, -1.0)
    most = np.where(y == 1, c * n / (2 * ones), c * n / (2 * (n - ones)))
    w, b, alpha = np.zeros(DIM), 0.0, np.zeros(n)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(n):
            f, v = features[i], values[i]
            gradient = sign[i] * (w[f] @ v + b / norms[i]) - 1.0
            new = min(max(alpha[i] - gradient, 0.0), most[i])  # rows have length 1
            step = (new - alpha[i]) * sign[i]
            if step:
                w[f] += step * v
                b += step / norms[i]
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    margins = np.array([w[f] @ v + b / s for f, v, s in zip(features, values, norms)])
    slope, shift = _curve(margins, y, most / c)
    return NbSvm((w * ratio).astype(np.float32), (ratio**2).astype(np.float32), b, slope, shift)


def _curve(m: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (over 0) and shift of the logistic curve, by Newton's method with softened targets."""
    ones, zeros = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g, h = weight * (p - t), weight * np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(g * m).sum() + 1e-3 * a, g.sum()])
        hessian = np.array([[(h * m * m).sum() + 1e-3, (h * m).sum()], [(h * m).sum(), h.sum()]]) + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        a, b = max(a - step[0], 1e-3), b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def _extract():
    made = Indicators()
    return lambda texts: [[made.of(x or "") for x in texts]]


def train(docs: DataFrame, labels: DataFrame, keep, rows: int = 2500, label: str = "quality", key: str = "doc_id", text: str = "text") -> NbSvm:
    """A model from about `rows` labelled documents of each class (the bound on what the driver gets), whole texts, those that keep holds for."""
    sample = labelled_sample(docs, labels, label, keep, rows, key, text)
    got = map_texts(sample, _extract, [StructField("features", ArrayType(IntegerType()))], (key, "y"), text).toArrow().sort_by(key)
    column = got.column("features").combine_chunks()
    flat, at = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]).astype(int) if len(column) else np.zeros(1, int)
    return fit([flat[a:b] for a, b in zip(at, at[1:])], got.column("y").to_numpy())


def _scorer(shared):
    model, made = shared.value, Indicators()

    def score(texts: list) -> list:
        return [[model.chance(model.margin(made.of(x or ""))) for x in texts]]

    return score


def score_quality(docs: DataFrame, model: NbSvm, text: str = "text", keys: tuple = ("doc_id",)) -> DataFrame:
    """keys and score (0 to 1, higher: class 1 likelier) of each whole text; null and empty texts get the bias's score.

    The model has a fixed size and is sent once to each executor. Repeated rows each give a row, an empty table gives none; further
    columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, partial(_scorer, shared), [StructField("score", DoubleType())], keys, text)


def predicted(df: DataFrame) -> DataFrame:
    return df.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
