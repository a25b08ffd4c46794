"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Method.  A text is described by a fixed list of statistics (shares of signs, lengths and repeats of
words and lines), transformed to be roughly normal.  Each class gets its mean and its covariance,
shrunk towards the pooled covariance and a multiple of the identity.  The score is the posterior of
class 1: the difference of the Mahalanobis log-densities, from Cholesky factors that are computed
once and cached in the model.

Labels are joined to ids after the statistics are made; sums, not rows, of the labelled statistics
reach the driver.  Labels, language, source and id are never part of a statistic.

Defined results: a null or empty text is the empty text and gets a score like any other; a null id
stays a row, is not held out and has no label; labelled ids that repeat count once per label; without
labels of both classes the score is the share of class 1 (0.5 without any); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, lazily, stage, text_of

#: Share of the pooled covariance, then of the identity; the posterior is tempered, as statistics are not independent normals.
POOLED, IDENTITY, TEMPER = 0.2, 0.02, 0.25
THRESHOLD = 0.3
#: Words in one window; the worst windows of a text are statistics too.
WINDOW = 32
_PUNCTUATION = frozenset(".,;:?'\"()-")
STATISTICS = ("words", "word_length", "length_spread", "upper", "symbols", "digits", "stops", "distinct", "repeats",
              "commonest", "lines", "same_lines", "worst_upper", "worst_symbols", "worst_repeats", "worst_stops",
              "shared_ends", "one_sign")


def _logit(p: float, n: float) -> float:
    """Log-odds of a share of n cases, kept finite by half a case on either side."""
    p = (p * n + 0.5) / (n + 1)
    return float(np.log(p / (1 - p)))


def statistics(text: str) -> list[float]:
    """The transformed statistics of a whole text, in the order of ``STATISTICS``."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    lengths = np.fromiter(map(len, words), "i8", n)
    codes = np.frombuffer(" ".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    # signs of the ASCII range are counted by table, all others are letters
    kinds = _KINDS[np.minimum(codes, 128)]
    blank = kinds == 0
    word = np.cumsum(blank)
    upper = np.bincount(word[kinds == 2], minlength=n)
    symbols = np.bincount(word[kinds == 3], minlength=n)
    digits = int((kinds == 4).sum())
    stops = np.bincount(word[kinds == 5], minlength=n)
    ends = codes[np.cumsum(lengths + 1) - 2]
    same = np.fromiter((a == b for a, b in zip(words, words[1:], strict=False)), bool, n - 1) if n > 1 else np.zeros(0, bool)
    same = np.concatenate([[False], same])
    lowered: dict[str, int] = {}
    for w in words:
        lowered[w] = lowered.get(w, 0) + 1
    signs = int(lengths.sum())
    lines = [x for x in text.split("\n") if x.strip()]
    cuts = np.arange(0, n, WINDOW)
    per_window = np.add.reduceat(lengths, cuts)
    in_window = np.minimum(WINDOW, n - cuts)
    # a short last window says little; it is weighed by its words
    weight = in_window / WINDOW
    window = lambda x, by: float((np.add.reduceat(x, cuts) / by * weight).max())
    odd_ends = (_KINDS[np.minimum(ends, 128)] == 3).astype("i8")
    return [
        float(np.log1p(n)), float(np.log(lengths.mean())), float(np.log1p(lengths.std())),
        _logit(upper.sum() / signs, signs), _logit(symbols.sum() / signs, signs), _logit(digits / signs, signs),
        _logit(min(1.0, stops.sum() / n), n), _logit(len(lowered) / n, n) + 0.5 * float(np.log1p(n)),
        _logit(same.mean(), n), _logit(max(lowered.values()) / n, n), float(np.log1p(n / max(1, len(lines)))),
        _logit(1 - len(set(lines)) / max(1, len(lines)), len(lines)),
        float(np.log(0.02 + window(upper, per_window))), float(np.log(0.02 + window(symbols, per_window))),
        float(np.log(0.02 + window(same.astype("i8"), in_window))), float(np.log(0.05 + window(stops, in_window))),
        _logit(odd_ends.mean(), n), float(np.log(0.02 + np.mean((symbols == lengths)))),
    ]


def _kinds() -> np.ndarray:
    """0 blank, 1 letter, 2 capital, 3 symbol, 4 digit, 5 punctuation; 128 stands for all beyond ASCII."""
    out = np.full(129, 3, "i1")
    for c in range(128):
        s = chr(c)
        out[c] = 0 if s == " " else 4 if s.isdigit() else 2 if s.isupper() else 1 if s.isalpha() else 5 if s in _PUNCTUATION else 3
    out[128] = 1
    return out


_KINDS = _kinds()


@dataclass(frozen=True)
class Model:
    """Means, inverse Cholesky factors and constants of both classes; ``share`` is that of class 1."""

    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None
    constants: tuple[float, float]
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        log_density = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(1)
                       for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        margin = TEMPER * (log_density[1] - log_density[0]) + np.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(margin, -60, 60)))


def fit(counts: list[float], sums: list[np.ndarray], squares: list[np.ndarray], pooled: float = POOLED,
        identity: float = IDENTITY) -> Model:
    """A model from the number, sum and sum of products of each class's statistics."""
    total = sum(counts)
    if min(counts) < 2:
        return Model(None, None, (0.0, 0.0), counts[1] / total if total else 0.5)
    means = [s / n for s, n in zip(sums, counts, strict=True)]
    own = [q / n - np.outer(m, m) for q, m, n in zip(squares, means, counts, strict=True)]
    within = sum(n * c for n, c in zip(counts, own, strict=True)) / total
    # the identity is scaled by the spread of each statistic
    spread = np.diag(np.diag(within) + 1e-6)
    factors, constants = [], []
    for c in own:
        mixed = (1 - pooled - identity) * c + pooled * within + identity * spread
        lower = np.linalg.cholesky(mixed + 1e-9 * np.eye(len(mixed)))
        factors.append(np.linalg.inv(lower))
        constants.append(-float(np.log(np.diag(lower)).sum()))
    return Model(tuple(means), tuple(factors), tuple(constants), counts[1] / total)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "x": [statistics(t) for t in pdf["text"]]})


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for label, g in pdf.groupby("label"):
            x = np.stack(g["x"].to_list())
            values = np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
            yield pd.DataFrame({"label": int(label), "i": np.arange(len(values)), "value": values})


def _score(batches: Iterator[pd.DataFrame], model: Model, threshold: float) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        score = model.score(np.stack(pdf["x"].to_list())) if len(pdf) else np.zeros(0)
        yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": score,
                            "predicted": (score >= threshold).astype("i4")})


def train(described: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Model:
    """Fit on the labelled ids that are not held out; only sums over them are collected."""
    known = (labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & ~held_out(F.col("id"))).dropDuplicates(["id", "label"]))
    rows = described.join(known, described["doc_id"] == known["id"]).select("label", "x")
    sums = rows.mapInPandas(lazily(_moments), "label int, i int, value double").groupBy("label", "i").agg(F.sum("value").alias("value"))
    d = len(STATISTICS)
    values = np.zeros((2, 1 + d + d * d))
    for r in sums.collect():  # two classes of 1 + d + d * d sums
        values[r["label"], r["i"]] = r["value"]
    return fit(list(values[:, 0]), list(values[:, 1:1 + d]), list(values[:, 1 + d:].reshape(2, d, d)))


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x``: the statistics of every row, written once."""
    return stage(text_of(docs, id_col, text_col).mapInPandas(lazily(_describe), "doc_id long, x array<double>"), "statistics")


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
             text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    described = describe(docs, id_col, text_col)
    model = train(described, labels, label_col)
    scored = described.mapInPandas(lazily(_score, model, threshold), "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
              text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, with all their columns.

    Texts are described a second time, so that rows are filtered where they are and no text is shuffled.
    """
    model = train(describe(docs, id_col, text_col), labels, label_col)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        scores = pd.Series(model.score(np.array([statistics(t) for t in texts]).reshape(len(texts), -1)))
        give_back()
        return scores

    return docs.filter(score(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))) >= threshold)
