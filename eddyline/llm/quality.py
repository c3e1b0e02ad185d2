"""Document quality by a regularised quadratic discriminant.

Each class is a Gaussian over transformed document statistics.  Its covariance is shrunk towards a
mixture of the pooled covariance and its own mean variance, and kept as a Cholesky factor, so a score
costs two triangular products.  The difference of the log densities, Mahalanobis term and
log-determinant included, goes through a logistic curve fitted on the training rows, which turns it
into the probability of label 1.

Moments are sums, taken by Spark over all rows that ``fit`` is given; the caller bounds those
(``tables.training_rows``).  The curve has two numbers and is fitted on at most about ``CURVE_ROWS`` of
them that a hash chooses.

Statistics are those of the text alone, over the whole text.  Null and empty texts have statistics of
zero words and a score like any other.  With training rows of one class only, or none, every score is
that class's share (one half for none).  Rows with a null label or id are not learnt from.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.tables import written

#: Most rows that the logistic curve is fitted on.
CURVE_ROWS = 20_000

#: Weight of the pooled covariance in a class covariance, and of the mean variance in the result.
TO_POOLED, TO_SPHERE = 0.10, 0.02

NAMES = [
    "log words", "word length", "capitals", "marks", "digits", "signs", "shouts", "short words",
    "distinct words", "commonest word", "said twice", "compressed size", "line length", "repeated lines",
    "beyond ascii",
]

_KIND = np.zeros(256, np.int64)  # 0 other, 1 capital, 2 small, 3 digit, 4 mark, 5 sign, 6 shout, 7 beyond ASCII
for _chars, _kind in ((b".,;:'\"-()", 4), (b"#$%&*|<>{}[]~^_=\\@+/`", 5), (b"!?", 6)):
    _KIND[list(_chars)] = _kind
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 1, 2, 3, 7

_ZIP_BLOCK = 1 << 16


#: Characters, words or lines' worth of the usual share that each share starts from, so that a few
#: words do not make an extreme document.
USUAL_WEIGHT = 8


def _share(part: float, whole: float, usual: float) -> float:
    return float(np.log((part + USUAL_WEIGHT * usual) / (whole + USUAL_WEIGHT)))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one text, in the order of ``NAMES``."""
    data = (text or "").encode()
    kinds = np.bincount(_KIND, np.bincount(np.frombuffer(data, np.uint8), minlength=256), 8)
    visible = float(kinds.sum()) - sum(data.count(c) for c in b" \n\t\r")
    letters = kinds[1] + kinds[2] + kinds[7]
    words = data.split()
    n = len(words)
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    lines = [line for line in data.split(b"\n") if line.strip()]
    packed = sum(
        len(zlib.compress(data[k : k + _ZIP_BLOCK], 1)) for k in range(0, len(data), _ZIP_BLOCK)
    )
    return [
        float(np.log1p(n)),
        float(np.log((visible + 1) / (n + 1))),
        _share(kinds[1], letters, 0.02),
        _share(kinds[4], visible, 0.02),
        _share(kinds[3], visible, 0.002),
        _share(kinds[5], visible, 0.002),
        _share(kinds[6], visible, 0.002),
        _share(sum(len(w) <= 3 for w in words), n, 0.3),
        float(np.log((len(seen) + 1) / (n + 1))),
        _share(max(seen.values(), default=0), n, 0.05),
        _share(sum(map(eq, words, words[1:])), n, 0.01),
        float(np.log((packed + 12) / (len(data) + 24))),
        float(np.log((n + 1) / (len(lines) + 1))),
        _share(len(lines) - len(set(lines)), len(lines), 0.02),
        _share(kinds[7], visible, 0.02),
    ]


def document_statistics(text: Column | str) -> Column:
    """The statistics as an array of doubles."""

    @F.arrow_udf("array<double>")
    def computed(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return computed(text)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log densities' constants of the two classes."""

    means: np.ndarray  # 2 x d
    whiten: np.ndarray  # 2 x d x d: inverse of the Cholesky factor
    constants: np.ndarray  # 2
    curve: tuple[float, float]
    fallback: float | None = None

    def difference(self, rows: np.ndarray) -> np.ndarray:
        """log density of class 1 less that of class 0."""
        log = [
            c - 0.5 * (((rows - m) @ w.T) ** 2).sum(axis=1)
            for m, w, c in zip(self.means, self.whiten, self.constants, strict=True)
        ]
        return log[1] - log[0]

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.fallback is not None:
            return np.full(len(rows), self.fallback)
        slope, shift = self.curve
        return 1 / (1 + np.exp(-np.clip(slope * _bend(self.difference(rows)) + shift, -30, 30)))


def _bend(difference: np.ndarray) -> np.ndarray:
    """Far differences count by their logarithm: tails of a Gaussian are too sure of themselves."""
    return np.arcsinh(difference)


def _moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products of each label: one row of sums per task, added by Spark."""
    d = len(NAMES)

    def partial(batches):
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = np.array(batch["statistics"].tolist()).reshape(-1, d)
            for label in (0, 1):
                own = x[batch["label"].to_numpy() == label]
                sums[label] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        for label in (0, 1):
            yield pd.DataFrame(
                {"label": label, "place": np.arange(sums.shape[1]), "value": sums[label]}
            )

    parts = rows.select("label", "statistics").mapInPandas(
        partial, "label int, place int, value double"
    )
    found = parts.groupBy("label", "place").agg(F.sum("value").alias("value")).toPandas()
    out = {}
    for label in (0, 1):
        values = found[found["label"] == label].sort_values("place")["value"].to_numpy()
        if len(values) and values[0]:
            out[label] = values[0], values[1 : 1 + d], values[1 + d :].reshape(d, d)
    return out


def _curve(difference: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps with a small ridge."""
    x = np.stack([_bend(difference), np.ones(len(difference))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (labels - p) - 1e-3 * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(rows: DataFrame) -> Discriminant:
    """Learns from ``doc_id, label, statistics``; other labels than 0 and 1 are left out."""
    # Written, so that the texts are read once, and one Python worker of a task is enough.
    rows = written(rows.where("label in (0, 1) and doc_id is not null"), "quality-statistics")
    moments = _moments(rows)
    d = len(NAMES)
    if len(moments) < 2:
        only = next(iter(moments), None)
        flat = np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), (0.0, 0.0)
        return Discriminant(*flat, fallback=0.5 if only is None else float(only))
    own, means = {}, {}
    for label, (n, total, products) in moments.items():
        means[label] = total / n
        own[label] = products / n - np.outer(means[label], means[label])
    total = sum(m[0] for m in moments.values())
    pooled = sum(moments[k][0] * own[k] for k in own) / total
    whiten, constants = [], []
    for label in (0, 1):
        cov = (1 - TO_POOLED) * own[label] + TO_POOLED * pooled
        scale = np.diag(pooled) + 1e-6
        cov = (1 - TO_SPHERE) * cov + TO_SPHERE * np.diag(scale)
        factor = np.linalg.cholesky(cov)
        whiten.append(np.linalg.inv(factor))
        constants.append(np.log(moments[label][0] / total) - np.log(np.diag(factor)).sum())
    shape = np.array([means[0], means[1]]), np.array(whiten), np.array(constants)
    share = min(1.0, CURVE_ROWS / total)
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", "statistics"), F.lit(1 << 30)) < int(share * (1 << 30)))
    seen = chosen.select("doc_id", "label", "statistics").toPandas()
    seen = seen.sort_values("doc_id", kind="stable")
    if seen["label"].nunique() < 2:
        return Discriminant(*shape, curve=(1.0, 0.0))
    raw = Discriminant(*shape, curve=(1.0, 0.0))
    x = np.array(seen["statistics"].tolist()).reshape(-1, d)
    return Discriminant(*shape, curve=_curve(raw.difference(x), seen["label"].to_numpy(float)))


def score(statistics_column: Column | str, model: Discriminant) -> Column:
    """The probability of label 1, from the statistics."""

    @F.arrow_udf("double")
    def scored(rows: pa.Array) -> pa.Array:
        x = np.array(rows.to_pylist(), np.float64).reshape(-1, len(NAMES))
        return pa.array(model.score(x))

    return scored(statistics_column)
