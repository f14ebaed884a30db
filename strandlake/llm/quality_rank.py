"""Quality classifier: Bradley-Terry ranking of documents.

A document's worth is w.x for a feature vector x of its whole text. For a preferred document i and a lesser one j the
Bradley-Terry model has P(i beats j) = sigmoid(w.(x_i - x_j)), so w minimises the logistic loss on feature differences
of preference pairs (a labelled good document beside a labelled bad one). A quantile of the training worths then gives
the threshold; the published score is a sigmoid that is CUT there.

What is learned from is bounded, whatever the size of the corpus: `max_rows` labelled rows (20,000; those whose hashed
doc_id is least) and `pairs` preference pairs drawn from them (200,000). Every document is scored.

Null text counts as empty; an empty text has a score like any other, texts of any length are read whole. Repeated rows
give repeated results; in training, rows that share an id are rows of their own within the bound. Equal scores are equal
decisions. Without labelled rows of both kinds every score is CUT (nothing is rejected for want of evidence). An empty
table gives an empty result. Columns besides id and text are ignored, whatever they are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, table

#: predicted is 1 from this score on.
CUT = 0.7
FEATURES = (
    "log_words", "word_len", "short_words", "long_words", "distinct_words", "distinct_pairs", "echo", "upper", "digits", "symbols", "bangs", "bars",
    "stops", "commas", "line_len", "repeated_lines", "loud_lines", "log_symbols", "log_upper", "log_echo", "log_bars", "odd_length", "sparse_words",
)
_UPPER, _DIGIT = np.arange(65, 91), np.arange(48, 58)
_SYMBOLS = np.frombuffer(b"#*$%&<>^~_=\\{}", np.uint8)


def features(text: str | None) -> list[float]:
    """FEATURES of one text."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    m = max(n, 1)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters = max(int(seen[65:91].sum() + seen[97:123].sum()), 1)
    sizes = np.fromiter(map(len, words), np.int32, n)
    echo = sum(map(eq, words, words[1:])) / m
    lines = [x for x in raw.split(b"\n") if x.strip()]
    k = max(len(lines), 1)
    symbols, upper, bars = int(seen[_SYMBOLS].sum()) / m, int(seen[_UPPER].sum()) / letters, int(seen[124]) / m
    distinct = len(set(words)) / m
    # natural prose repeats more words the longer it is: distinct words against what such a length has
    expected = 1 / (1 + 0.05 * math.sqrt(m))
    return [
        math.log1p(n), float(sizes.sum()) / m, float((sizes <= 3).sum()) / m, float((sizes >= 14).sum()) / m, distinct,
        len(set(zip(words, words[1:], strict=False))) / m, echo, upper, int(seen[_DIGIT].sum()) / max(len(raw), 1), symbols, int(seen[33]) / m, bars,
        int(seen[46]) / m, int(seen[44]) / m, math.log1p(n / k), 1 - len(set(lines)) / k, sum(x.isupper() for x in lines) / k,
        math.log1p(50 * symbols), math.log1p(20 * upper), math.log1p(50 * echo), math.log1p(50 * bars), abs(math.log1p(n) - 5.5), max(0.0, expected - distinct),
    ]


@dataclass(frozen=True)
class Ranking:
    """A fitted model: worth(x) = weights.((x - mean) / scale), clipped features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        worth = self._worth(x)
        return 1 / (1 + np.exp(-np.clip(worth - self.threshold + math.log(CUT / (1 - CUT)), -30, 30)))

    def _worth(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights


def fit(x: np.ndarray, good: np.ndarray, pairs: int = 200_000, ridge: float = 1.0, seed: int = 11) -> Ranking:
    """Newton steps on the pairwise logistic loss of `pairs` drawn pairs; then the quantile threshold that agrees best with
    the labels."""
    d = x.shape[1] if x.ndim == 2 else len(FEATURES)
    if len(x) == 0 or good.all() or not good.any():
        return Ranking(np.zeros(d), np.ones(d), np.zeros(d), 0.0)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    winners, losers = np.flatnonzero(good), np.flatnonzero(~good)
    diff = z[rng.choice(winners, pairs)] - z[rng.choice(losers, pairs)]
    w = np.zeros(d)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        step = np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff + ridge * np.eye(d), diff.T @ (1 - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    worth = z @ w
    cuts = np.quantile(worth, np.linspace(0, 1, 401))
    right = [int(((worth >= c) == good).sum()) for c in cuts]
    return Ranking(mean, scale, w, float(cuts[int(np.argmax(right))]))


def _rows(it: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in in_slices(it):
        x = np.array([features(t) for t in batch.column("text").to_pylist()], np.float64).reshape(-1, len(FEATURES))
        yield batch.select(keep), x


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Ranking:
    """Fit on at most max_rows labelled rows outside the held-out part, those whose hashed id is least."""
    chosen = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").cast("int").alias("label"))
    order = F.xxhash64("doc_id")
    chosen = chosen.orderBy(order, "doc_id", "label").limit(max_rows)  # at most max_rows rows of 12 bytes are broadcast
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select(order.alias("h"), "label", "text")
    names = [f"f{i}" for i in range(len(FEATURES))]

    def measure(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, x in _rows(it, ["h", "label"]):
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), *(pa.array(c) for c in x.T)], ["h", "label", *names])

    # the driver gets max_rows rows of numbers at most, in one order however they were dealt, and never texts
    measured = rows.mapInArrow(measure, "h long, label int, " + ", ".join(f"{c} double" for c in names))
    got = measured.orderBy("h", "label", *names).limit(max_rows).toArrow()
    x = np.column_stack([got.column(c).to_numpy() for c in names]) if got.num_rows else np.zeros((0, len(names)))
    return fit(x, got.column("label").to_numpy() == 1)


def score_documents(docs: DataFrame, model: Ranking) -> DataFrame:
    """doc_id and score of every row."""

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, x in _rows(it, ["doc_id"]):
            yield pa.RecordBatch.from_arrays([kept.column(0), pa.array(model.scores(x))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: Ranking) -> DataFrame:
    """The rows that score CUT or more, with all their columns."""
    names = docs.columns

    def choose(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, x in _rows(it, names):
            yield kept.filter(pa.array(model.scores(x) >= CUT))

    return docs.mapInArrow(choose, docs.schema)


def op1_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
