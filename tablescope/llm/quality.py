"""Text quality by a regularised quadratic discriminant.

Each whole text becomes a vector of transformed statistics (logarithms of
sizes, log-odds of shares).  Per class the mean and the covariance are summed
up on the executors; the covariance of a class is shrunk towards the pooled
one and towards a multiple of the identity.  The score compares the two log
densities, each a squared Mahalanobis length under the cached Cholesky factor
plus its log determinant, and turns the difference into a probability.

Defined cases: a null text counts as empty; an empty text has the vector of
zero counts and is scored like any other.  Labels other than 0 and 1 teach
nothing; repeated labels of one id teach once.  Without both classes every
score is the share of class 1 among the labels, or 0.5 without labels.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import fresh

TO_POOLED = 0.1  # weight of the pooled covariance
TO_IDENTITY = 0.02  # weight of the identity
FEATURES = 18


def _byte_classes() -> np.ndarray:
    """0 lower or non-ASCII letter, 1 capital, 2 digit, 3 white space, 4 sentence mark, 5 other sign, 6 later byte of a character."""
    kind = np.full(256, 5, np.uint8)
    kind[128:192], kind[192:] = 6, 0
    for i in range(128):
        c = chr(i)
        kind[i] = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c.isspace() else 4 if c in ".,;:?'\"-" else kind[i]
    return kind


def _log_odds(part: float, whole: float) -> float:
    return math.log((part + 0.5) / (whole - part + 0.5)) if whole >= part else 0.0


def statistics_of(text: str, kind: np.ndarray) -> list[float]:
    """The transformed statistics of one text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    lower, upper, digit, space, mark, sign = (sum(np.bincount(kind[raw[s : s + 4_000_000]], minlength=7) for s in range(0, len(raw), 4_000_000)) if len(raw) else np.zeros(7, int))[:6].tolist()
    chars = lower + upper + digit + space + mark + sign
    words = text.split()
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    distinct = len(set(words))
    again = sum(map(operator.eq, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x]
    short = int((lengths <= 3).sum())
    return [
        math.log1p(n),
        math.log1p(lengths.mean()) if n else 0.0,
        math.log1p(lengths.std()) if n else 0.0,
        math.log1p(lengths.max()) if n else 0.0,
        _log_odds(upper, lower + upper),
        _log_odds(digit, chars),
        _log_odds(space, chars),
        _log_odds(mark, chars),
        _log_odds(sign, chars),
        _log_odds(distinct, n),
        _log_odds(again, n),
        _log_odds(n - 1 - pairs, n - 1) if n > 1 else 0.0,
        _log_odds(short, n),
        math.log1p(len(lines)),
        math.log1p(n / max(1, len(lines))),
        _log_odds(len(lines) - len(set(lines)), len(lines)),
        math.log((sign + 0.5) / (n + 1)),
        math.log((mark + 0.5) / (n + 1)),
    ]


def with_statistics(docs: DataFrame, text: str = "text", column: str = "statistics") -> DataFrame:
    """``docs`` with an array of the transformed statistics of each text."""

    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        kind = _byte_classes()
        return pd.Series([statistics_of(t if t is not None else "", kind) for t in texts])

    return docs.withColumn(column, measure.asNondeterministic()(F.col(text)))


@dataclass
class QualityModel:
    """Per class the mean, the Cholesky factor of the covariance and the constant of the log density."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.means):
            return np.full(len(x), self.prior)
        log_density = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            z = np.linalg.solve(factor, (x - mean).T)  # whitened by the cached factor
            log_density.append(constant - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(np.clip(log_density[0] - log_density[1], -500, 500)))


def fit(rows: DataFrame, statistics: str = "statistics", label: str = "label", to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> QualityModel:
    """Learn from every row whose label is 0 or 1."""

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for y, part in batch.groupby("y"):
                x = np.column_stack([np.ones(len(part)), np.array(part["x"].tolist(), float)])
                held[int(y)] = held.get(int(y), 0) + x.T @ x
        for y, m in held.items():
            yield pd.DataFrame({"y": y, "i": np.arange(m.size), "v": m.ravel()})

    known = rows.select(F.col(statistics).alias("x"), F.col(label).cast("int").alias("y")).where("y IN (0, 1) AND x IS NOT NULL")
    sums = known.mapInPandas(moments, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v").alias("v")).toPandas()  # 2 x (features + 1)^2 numbers
    tables = {int(y): p.sort_values("i")["v"].to_numpy().reshape(FEATURES + 1, FEATURES + 1) for y, p in sums.groupby("y")}
    count = {y: t[0, 0] for y, t in tables.items()}
    prior = count.get(1, 0) / sum(count.values()) if count else 0.5
    if len(tables) < 2 or min(count.values()) < 2:
        return QualityModel(np.zeros((0, FEATURES)), np.zeros((0, FEATURES, FEATURES)), np.zeros(0), prior)
    means = np.stack([tables[y][0, 1:] / count[y] for y in (0, 1)])
    own = [tables[y][1:, 1:] / count[y] - np.outer(means[y], means[y]) for y in (0, 1)]
    pooled = sum(own[y] * count[y] for y in (0, 1)) / sum(count.values())
    factors, constants = [], []
    for y in (0, 1):
        s = (1 - to_pooled) * own[y] + to_pooled * pooled
        s = (1 - to_identity) * s + to_identity * (np.trace(s) / FEATURES + 1e-6) * np.eye(FEATURES)
        factors.append(np.linalg.cholesky(s))
        constants.append(math.log(count[y] / sum(count.values())) - np.log(np.diag(factors[-1])).sum())
    return QualityModel(means, np.stack(factors), np.array(constants), prior)


def score(rows: DataFrame, model: QualityModel, statistics: str = "statistics", column: str = "score") -> DataFrame:
    """``rows`` with the probability of class 1; the model is a few kilobytes."""

    @F.pandas_udf("double")
    def value(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(x.tolist(), float).reshape(len(x), FEATURES)))

    return rows.withColumn(column, value(F.col(statistics)))


def labelled(rows: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """Statistics of the rows with a label, as ``(statistics, label)``; ids are matched as given, null ids never."""
    (held,) = fresh(rows, "_label")
    known = labels.select(F.col(key).alias(held + "_id"), F.col(label).cast("int").alias(held)).where(F.col(held).isin(0, 1)).distinct()
    return rows.join(known, F.col(key) == F.col(held + "_id")).select("statistics", F.col(held).alias("label"))
