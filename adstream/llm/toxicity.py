"""Toxicity as ordered grades: cumulative-link regression on sparse text features."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.shingles import texts

SAMPLE_ROWS = 20_000
FEATURE_BITS = 20
GRADES = 3
_MIN_DOCUMENTS = 3
_MIN_Z = 5.0
_L2 = 1e-5
_STEPS = 600
_BEGINNINGS = (5, 7)
_CACHED_WORDS = 500_000
_EDGES = b".,;:!?\"'()[]{}*#$%&|<>-_"


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade <= k) = sigmoid(thresholds[k] - weights . x), one weight per feature for all k."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k, one row per score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def _word_features(word: bytes) -> tuple[int, ...]:
    """Hashes of a word without marks at its edges, and of its beginnings."""
    bare = word.strip(_EDGES).decode("utf-8", "replace")
    parts = {bare, *(bare[:n] + "~" for n in _BEGINNINGS if len(bare) > n)} - {""}
    return tuple(sorted({xxhash.xxh32_intdigest(p.encode()) >> (32 - FEATURE_BITS) for p in parts}))


class _WordFeatures(dict):
    """Features of words, or of those only that a model knows; remembered up to a bound."""

    def __init__(self, wanted: np.ndarray | None = None):
        self.wanted = wanted

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        found = _word_features(word)
        if self.wanted is not None:
            found = tuple(f for f in found if self.wanted[f])
        self[word] = found
        return found


def _counts(text: bytes | None, features: _WordFeatures) -> dict[int, int]:
    """How often each feature occurs in the whole text, in lower case (A-Z)."""
    out: dict[int, int] = {}
    for word, n in Counter(text.lower().split() if text else ()).items():
        for f in features[word]:
            out[f] = out.get(f, 0) + n
    return out


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per feature, in how many texts and in how many toxic ones it occurs, added up within the batch."""
    features = _WordFeatures()
    for batch in batches:
        every, bad = np.zeros(1 << FEATURE_BITS, np.int64), np.zeros(1 << FEATURE_BITS, np.int64)
        for text, toxic in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
            found = np.fromiter(_counts(text, features), np.int64)
            every[found] += 1
            bad[found] += toxic
        seen = np.flatnonzero(every)
        yield pa.record_batch([pa.array(x) for x in (seen, every[seen], bad[seen])], names=["feature", "n", "bad"])


def _featurise(wanted: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _WordFeatures(wanted)
        for batch in batches:
            found = [_counts(t, features) for t in texts(batch.column(0))]
            yield pa.record_batch(
                [
                    pa.array([list(c) for c in found], pa.list_(pa.int64())),
                    pa.array([list(c.values()) for c in found], pa.list_(pa.int64())),
                    batch.column(1),
                ],
                names=["x", "n", "toxic"],
            )

    return run


def fit(
    rows: list[np.ndarray], counts: list[np.ndarray], toxic: np.ndarray, features: np.ndarray, grades: int = GRADES
) -> OrdinalModel:
    """Fit on the given features and their counts, which enter as ln(1 + n); toxic is 0 or 1.

    As labels say yes or no only, the grades above 0 split the toxic samples by how
    much of these features they have, at equal shares.
    """
    n, n_toxic, size = len(rows), int(toxic.sum()), 1 << FEATURE_BITS
    features = np.sort(features)
    index = np.full(size, -1, np.int64)
    index[features] = np.arange(len(features))
    sparse = [index[x][index[x] >= 0] for x in rows]
    value = np.concatenate([np.log1p(c[index[x] >= 0]) for x, c in zip(rows, counts)]) if n else np.empty(0)
    sizes = np.array([len(s) for s in sparse], np.int64)
    row = np.repeat(np.arange(n), sizes)
    hits = np.bincount(row, weights=value, minlength=n)
    grade = np.zeros(n, np.int64)
    if n_toxic:
        cuts = np.quantile(hits[toxic == 1], np.arange(1, grades - 1) / (grades - 1), method="higher")
        grade[toxic == 1] = 1 + (hits[toxic == 1, None] > cuts[None, :]).sum(axis=1)
    col = np.concatenate(sparse) if n else np.empty(0, np.int64)
    weights = np.zeros(len(features))
    gaps = np.full(grades - 1, 1.0)
    first, rate = 2.0, 0.5
    squares = [np.full_like(weights, 1e-8), np.full_like(gaps, 1e-8)]
    for _ in range(_STEPS if n else 0):
        # Thresholds are a first one and positive gaps, so they stay in order.
        thresholds = first + np.r_[0.0, np.cumsum(np.exp(gaps[1:]))]
        score = np.bincount(row, weights=weights[col] * value, minlength=n) if len(col) else np.zeros(n)
        padded = np.r_[-np.inf, thresholds, np.inf]
        high = 1 / (1 + np.exp(-np.clip(padded[grade + 1] - score, -60, 60)))
        low = 1 / (1 + np.exp(-np.clip(padded[grade] - score, -60, 60)))
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        g_score = d_high - d_low
        g_weights = np.bincount(col, weights=g_score[row] * value, minlength=len(weights)) / n + _L2 * weights
        g_threshold = np.zeros(grades + 1)
        np.add.at(g_threshold, grade + 1, -d_high)
        np.add.at(g_threshold, grade, d_low)
        inner = g_threshold[1:-1] / n
        g_gaps = np.r_[inner.sum(), np.cumsum(inner[::-1])[::-1][1:] * np.exp(gaps[1:])]
        for parameter, gradient, square in ((weights, g_weights, squares[0]), (gaps, g_gaps, squares[1])):
            square += gradient**2
            step = rate * gradient / np.sqrt(square)
            if parameter is gaps:
                first -= step[0]
                gaps[1:] -= step[1:]
            else:
                weights -= step
    thresholds = first + np.r_[0.0, np.cumsum(np.exp(gaps[1:]))]
    return OrdinalModel(features, weights, thresholds)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> OrdinalModel:
    """Fit on at most about ``sample_rows`` labelled rows, chosen by a hash of the id.

    Features are those that toxic samples have significantly more often, by counts added
    up in Spark. Only these features' counts per sampled text come to the driver.
    """
    # One label and one text per id: copies of either add nothing, however many there are.
    known = labels.filter("toxic IS NOT NULL").groupBy(F.col(id_col).alias("_of"))
    known = known.agg(F.max(F.col("toxic").cast("int")).alias("_y"))
    every = max(1, known.count() // sample_rows)
    sample = known.filter(F.pmod(F.xxhash64("_of"), F.lit(every)) == 0).limit(2 * sample_rows)
    text = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_body"))
    rows = text.join(F.broadcast(sample), F.col("_id") == F.col("_of")).groupBy("_of", "_y")
    rows = rows.agg(F.min("_body").alias("_body")).select("_body", "_y")
    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("_y"), F.lit(0)).alias("bad")).first()
    share = totals["bad"] / max(totals["n"], 1)
    found = rows.mapInArrow(_feature_counts, "feature long, n long, bad long").groupBy("feature")
    found = found.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    spread = F.sqrt(F.col("n") * F.lit(max(share * (1 - share), 1e-9)))
    telling = found.filter((F.col("n") >= _MIN_DOCUMENTS) & (F.col("bad") >= 2))
    telling = telling.filter((F.col("bad") - F.col("n") * F.lit(share)) / spread >= _MIN_Z)
    features = np.array([r["feature"] for r in telling.select("feature").collect()], np.int64)
    wanted = np.zeros(1 << FEATURE_BITS, bool)
    wanted[features] = True
    sets = rows.mapInArrow(_featurise(wanted), "x array<long>, n array<long>, toxic int").toArrow()
    x, n = ([np.asarray(v, np.int64) for v in sets.column(c).to_pylist()] for c in ("x", "n"))
    return fit(x, n, np.array(sets.column("toxic").to_pylist(), np.int64), features)


def _score(model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = OrdinalModel(*model.value)
        weights = np.zeros(1 << FEATURE_BITS)
        weights[fitted.features] = fitted.weights
        features = _WordFeatures(weights != 0)
        for batch in batches:
            found = [_counts(t, features) for t in texts(batch.column(0))]
            score = np.array([sum(weights[f] * np.log1p(n) for f, n in c.items()) for c in found], float)
            above = fitted.above(score)
            yield pa.record_batch(
                [
                    *batch.columns[1:],
                    pa.array(above.sum(axis=1)),
                    pa.array(above[:, 0]),
                    pa.array((above >= 0.5).sum(axis=1).astype(np.int32)),
                ],
                names=[*batch.schema.names[1:], "severity", "toxic_probability", "grade"],
            )

    return run


def score_toxicity(
    docs: DataFrame, model: OrdinalModel, text_col: str = "text", columns: list[str] | None = None
) -> DataFrame:
    """Adds ``severity`` (expected grade), ``toxic_probability`` and ``grade`` to every row.

    ``grade`` counts the thresholds that the text is above with a probability of at
    least one half; 0 is not toxic. Whole texts are read. A NULL or empty text has no
    features and gets the scores of such a text; repeated rows are scored each; columns of
    ``docs`` (or the ones in ``columns``) stay but for those named like the new ones; an
    empty table gives an empty result.
    """
    new = ("severity", "toxic_probability", "grade")
    columns = [c for c in (docs.columns if columns is None else columns) if c not in new]
    rows = docs.select(F.col(text_col).cast("string").alias("_body"), *columns)
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    # Plain arrays: workers need not have this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.thresholds))
    return rows.mapInArrow(_score(shared), f"{kept}severity double, toxic_probability double, grade int")
