"""Quality classifier on document statistics (operator 3).

Each text becomes a vector of statistics (lengths, character classes, repeated
words, lines and windows).  The vector is standardised and mapped by random
Fourier features, whose inner products approximate a Gaussian kernel.  Ridge
regression on them comes from normal equations that each partition sums up over
its own rows; only those sums reach the driver.  The raw score is calibrated by
isotonic regression on rows that the regression has not seen.

Labels are learned from a hash sample of about ``MAX_TRAIN`` labelled rows
(a documented bound); every document is scored.

Defined cases: null text is empty, and empty texts get a score like others;
repeated label rows count each; null labels and null doc_ids are not learned
from; without any labelled row, or with one class only, every score is the share
of ones (0.5 if there is no label).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, about, ship
from .words import rolling, slices, split_words

MAX_TRAIN = 200_000
FEATURES = 256
WIDTH = 3.0
RIDGE = 1e-2
SEED = 3
TRAIN_PARTS = 16
BINS = 2000

_CLASSES = {
    "upper": range(65, 91), "digit": range(48, 58), "symbol": b"#*$%&|<>", "bang": b"!?", "stop": b".,;:", "line": b"\n", "high": range(128, 256),
}
_TABLE = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASSES.items()}
NAMES = (
    "log_words", "word_length", "upper", "digit", "symbol", "symbol_share", "bang", "stop", "lines", "high",
    "distinct", "top_word", "repeat3", "repeat8", "dup_lines", "short",
)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of statistics per text."""
    words = split_words(texts)
    data, at = words.data, words.offset
    n_docs = len(at) - 1
    out = np.zeros((n_docs, len(NAMES)))
    size = np.maximum(np.diff(at), 1)

    def per_doc(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[edges[1:]] - total[edges[:-1]]

    n = np.diff(words.first)
    some = np.maximum(n, 1)
    count = {k: per_doc(t[data], at) for k, t in _TABLE.items()}
    out[:, 0] = np.log1p(n)
    out[:, 1] = per_doc(words.end - words.start, words.first) / some
    out[:, 2], out[:, 3], out[:, 9] = count["upper"] / size, count["digit"] / size, count["high"] / size
    out[:, 4], out[:, 5] = np.log1p(count["symbol"] / some * 10), count["symbol"] / size
    out[:, 6], out[:, 7] = np.log1p(count["bang"] / some * 10), count["stop"] / some
    out[:, 8] = np.log1p(count["line"] / some * 100)
    out[:, 15] = n < 10
    for d in range(n_docs):
        lo, hi = words.first[d], words.first[d + 1]
        if hi > lo:
            _, c = np.unique_counts(words.hash[lo:hi])
            out[d, 10], out[d, 11] = len(c) / (hi - lo), c.max() / (hi - lo)
            for col, k in ((12, 3), (13, 8)):
                grams = rolling(words.hash[lo:hi], k)
                if len(grams):
                    out[d, col] = 1 - len(np.unique_values(grams)) / len(grams)
            if count["line"][d]:
                lines = [x for x in data[at[d] : at[d + 1]].tobytes().split(b"\n") if x.strip()]
                out[d, 14] = 1 - len(set(lines)) / max(1, len(lines))
    return out


def measured(docs: DataFrame) -> DataFrame:
    """``(doc_id, x array<double>)``: the statistics of every document."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in slices(batches, "text"):
            x = statistics(batch.column("text"))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), flat], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, x array<double>")


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy().reshape(-1, len(NAMES))


class Model:
    """Standardisation, random Fourier features, ridge weights and the calibration curve."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.omega = rng.normal(0, 1 / WIDTH, (len(NAMES), FEATURES))
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights: np.ndarray | None = None
        self.curve: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.zeros(1))

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([np.ones((len(z), 1)), np.sqrt(2 / FEATURES) * np.cos(z @ self.omega + self.phase)], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.curve), 0, 1)


def _sums(rows: DataFrame, f, width: int) -> np.ndarray:
    """Sum of ``f(x, y)`` (a vector of fixed length) over the rows: one vector from each of TRAIN_PARTS partitions."""

    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += f(_matrix(batch.column("x")), batch.column("y").to_numpy().astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["v"])

    parts = rows.select("x", "y").mapInArrow(run, "v binary").collect()
    return sum((np.frombuffer(r["v"]) for r in parts), np.zeros(width))


def isotonic(at: np.ndarray, weight: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres and values of the non-decreasing fit, ``at`` ascending."""
    blocks: list[list[float]] = []
    for a, w, m in zip(at, weight, mean):
        blocks.append([a * w, w, m * w])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 1], b[:, 2] / b[:, 1]


def fit(x: DataFrame, labelled: DataFrame, s: Scratch) -> Model | float:
    """Model from ``x(doc_id, x)`` and ``labelled(doc_id, y)``; a number if there is nothing to tell classes apart."""
    rows = x.join(labelled.where("doc_id is not null and y is not null"), "doc_id").withColumn("at", F.xxhash64("doc_id", "y"))
    train = s.stash(about(s.stash(rows, "labelled"), F.col("at"), MAX_TRAIN).repartition(TRAIN_PARTS).select("x", F.col("y").cast("double").alias("y"), (F.pmod("at", F.lit(5)) == 0).alias("curve")), "train")
    k = len(NAMES)
    got = _sums(train, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(axis=0), (x * x).sum(axis=0)]), 2 + 2 * k)
    n, ones = got[:2]
    if not n or ones in (0, n):
        return ones / n if n else 0.5
    mean = got[2 : 2 + k] / n
    scale = np.sqrt(np.maximum(got[2 + k :] / n - mean**2, 0))
    scale[scale < 1e-9] = 1
    model = Model(mean, scale)
    d = FEATURES + 1

    def normal(x, y):
        z = model.lift(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    eq = _sums(train.where("not curve"), normal, d * d + d)
    penalty = RIDGE * max(1.0, eq[0]) / d * np.eye(d)
    penalty[0, 0] = 1e-9
    model.weights = np.linalg.solve(eq[: d * d].reshape(d, d) + penalty, eq[d * d :])

    def binned(x, y):
        at = np.clip(((model.raw(x) + 1) / 3 * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)])

    curve = _sums(train.where("curve"), binned, 2 * BINS)
    weight, hits = curve[:BINS], curve[BINS:]
    at = np.flatnonzero(weight)
    if len(at):
        model.curve = isotonic((at + 0.5) / BINS * 3 - 1, weight[at], hits[at] / weight[at])
    return model


def classify(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``(doc_id, score)`` for every row of ``docs(doc_id, text)``; ``labelled(doc_id, y)`` has the rows to learn from."""
    with Scratch(docs.sparkSession, "classifier") as s:
        x = s.stash(measured(docs), "statistics", keep=True)
        model = fit(x, labelled, s)
        if not isinstance(model, Model):
            return x.select("doc_id", F.lit(float(model)).alias("score"))
        held = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches):
            for batch in batches:
                score = held.value.score(_matrix(batch.column("x"))) if batch.num_rows else np.zeros(0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

        return x.mapInArrow(run, "doc_id long, score double")
