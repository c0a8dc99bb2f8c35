"""Quality classifier: a factorisation machine.

A document's features are its hashed words (weights by count, of unit length
together), statistics of its structure, and metadata.  The score is a
logistic function of

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

whose pairwise part is computed in linear time as half of
sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

It is fitted in numpy on the driver, on a sample of at most
``TRAIN_ROWS`` labelled documents (their features are extracted by Spark),
and scores whole texts in Arrow batches.  The model has a fixed size.

Defined cases
* null or empty text: no words, all statistics zero; it gets a score;
* null metadata: zero;
* null doc_id: scored, counted as held out where its remainder is null;
* no labels, or labels of one class only: the score of every document is
  the share of that class (one half without any);
* repeated rows are scored alike; empty input: empty output;
* other columns pass through; an existing score or predicted is replaced.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import labelled
from .common import require

WORDS = 1 << 14
FACTORS = 8
TRAIN_ROWS = 8000
#: Passes over the sample, and the fewest steps that a small sample gets.
EPOCHS, STEPS = 8, 500
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
STATISTICS = 16
#: Characters whose features are held at once.
SLICE_CHARS = 1 << 22
MEMO = 400_000

_KIND = np.zeros(256, dtype=np.uint8)  # 0 other, 1 upper, 2 lower, 3 digit, 4 punctuation, 5 white space, 6 beyond ASCII
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 1, 2, 3, 6
for _c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
    _KIND[_c] = 4
for _c in b" \t\n\x0b\x0c\r":
    _KIND[_c] = 5


class _Buckets(dict):
    """Word -> hash bucket, remembered within a Python worker."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        at = self[word] = zlib.crc32(word.encode()) % WORDS
        return at


_buckets = _Buckets()


def statistics(text: str, words: Counter, total: int) -> np.ndarray:
    """Shares and logarithms that describe the structure; all zero if empty."""
    out = np.zeros(STATISTICS, dtype=np.float32)
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    if not len(raw):
        return out
    kinds = _KIND[raw]
    share = np.bincount(kinds, minlength=7) / len(raw)
    twice = raw[1:] == raw[:-1]
    lines = text.split("\n")
    letters = max(share[1] + share[2], 1e-9)
    out[:7] = share
    out[7] = share[1] / letters
    out[8] = np.count_nonzero(twice & (kinds[1:] == 4)) / len(raw)
    out[9] = np.count_nonzero(twice & (kinds[1:] == 2)) / len(raw)
    out[10] = len(words) / max(1, total)
    out[11] = max(words.values()) / total if total else 0
    out[12] = len(set(lines)) / len(lines)
    out[13] = math.log1p(len(raw) / max(1, total)) / 4
    out[14] = math.log1p(total / len(lines)) / 8
    out[15] = math.log1p(total) / 12
    return out


def features(text: str | None, metadata: tuple = ()) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values: word buckets, then statistics, then metadata."""
    text = text or ""
    words = text.split()
    total = len(words)
    words = Counter(words)
    at = np.fromiter(map(_buckets.__getitem__, words), dtype=np.int32, count=len(words))
    of = np.sqrt(np.fromiter(words.values(), dtype=np.float32, count=len(words)))
    if total:
        of /= np.sqrt(np.square(of).sum())
    rest = np.concatenate([statistics(text, words, total),
                           np.array([math.log1p(abs(float(m or 0))) / 16 for m in metadata], dtype=np.float32)])
    return (np.concatenate([at, WORDS + np.arange(len(rest), dtype=np.int32)]),
            np.concatenate([of, rest]).astype(np.float32))


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, at: np.ndarray, of: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One margin per document; its features begin at ``starts``."""
        weighed = self.factors[at] * of[:, None]
        sums = np.add.reduceat(weighed, starts, axis=0)
        squares = np.add.reduceat(np.square(weighed).sum(axis=1), starts)
        return self.bias + np.add.reduceat(self.linear[at] * of, starts) + 0.5 * (np.square(sums).sum(axis=1) - squares)

    def scores(self, at: np.ndarray, of: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(at, of, starts).astype(np.float64), -30, 30)))


def constant(share: float, size: int) -> Machine:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Machine(math.log(share / (1 - share)), np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray, size: int,
        epochs: int = EPOCHS, rate: float = 0.1, batch: int = 128, decay: float = 1e-5) -> Machine:
    """Weighted logistic loss by Adagrad over shuffled batches."""
    rng = np.random.default_rng(7)
    batch = min(batch, max(16, len(rows) // 20))
    epochs = max(epochs, -(-STEPS * batch // len(rows)))
    linear = np.zeros(size, np.float32)
    factors = rng.normal(0, 0.05, (size, FACTORS)).astype(np.float32)
    machine = Machine(0.0, linear, factors)
    seen_l, seen_f, seen_b = np.full(size, 1e-2, np.float32), np.full((size, FACTORS), 1e-2, np.float32), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), batch):
            picked = order[a:a + batch]
            at = np.concatenate([rows[i][0] for i in picked])
            of = np.concatenate([rows[i][1] for i in picked])
            sizes = np.array([len(rows[i][0]) for i in picked])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            off = (machine.scores(at, of, starts) - y[picked]) * weight[picked] / len(picked)
            off = off.astype(np.float32)
            each = np.repeat(off, sizes) * of
            sums = np.add.reduceat(factors[at] * of[:, None], starts, axis=0)
            slope_f = each[:, None] * (np.repeat(sums, sizes, axis=0) - factors[at] * of[:, None])
            unique, back = np.unique(at, return_inverse=True)
            grad_l = np.bincount(back, each, len(unique)).astype(np.float32) + decay * linear[unique]
            grad_f = np.stack([np.bincount(back, slope_f[:, f], len(unique)) for f in range(FACTORS)], axis=1)
            grad_f = grad_f.astype(np.float32) + decay * factors[unique]
            seen_l[unique] += np.square(grad_l)
            seen_f[unique] += np.square(grad_f)
            linear[unique] -= rate * grad_l / np.sqrt(seen_l[unique])
            factors[unique] -= rate * grad_f / np.sqrt(seen_f[unique])
            seen_b += float(off.sum()) ** 2
            machine.bias -= rate * float(off.sum()) / math.sqrt(seen_b)
    return machine


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT,
          rows: int = TRAIN_ROWS, metadata: tuple[str, ...] = ()) -> Machine:
    """A machine from at most ``rows`` labelled documents outside the held-out fold."""
    size = WORDS + STATISTICS + len(metadata)
    sample, counts = labelled.sample(docs, labels, label, folds, held_out, rows, metadata)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            meta = list(zip(*[b.column(m).to_pylist() for m in metadata])) if metadata else [()] * b.num_rows
            found = [features(t.as_py(), m) for t, m in zip(b.column("text"), meta)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.float32()))], ["doc_id", "y", "at", "of"])

    got = sample.select("doc_id", "y", "text", *metadata).mapInArrow(
        batches, "doc_id long, y int, at array<int>, of array<float>").toArrow().sort_by("doc_id")
    y = np.array(got["y"].to_pylist(), dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.5, size)
    rows_ = [(a.values.to_numpy(), f.values.to_numpy()) for a, f in zip(got["at"], got["of"])]
    # back to the shares that the labels have
    scale = {c: counts[c] / max(1, int((y == c).sum())) for c in (0, 1)}
    weight = np.where(y == 1, scale[1], scale[0]).astype(np.float32)
    return fit(rows_, y, weight / weight.mean(), size)


def score(docs: DataFrame, machine: Machine, metadata: tuple[str, ...] = (), threshold: float = THRESHOLD,
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with score and predicted."""
    docs = docs.drop(*[c for c in ("score", "predicted") if c in docs.columns])
    keep = keep or docs.columns
    held = docs.sparkSession.sparkContext.broadcast(machine)  # of fixed size

    def scored(texts: pa.Array, meta: list[tuple]) -> np.ndarray:
        out, at = np.empty(len(texts)), 0
        while at < len(texts):
            found, chars, begin = [], 0, at
            while at < len(texts) and (chars < SLICE_CHARS or at == begin):
                text = texts[at].as_py()
                found.append(features(text, meta[at]))
                chars += len(text or "")
                at += 1
            starts = np.concatenate([[0], np.cumsum([len(f[0]) for f in found])[:-1]])
            out[begin:at] = held.value.scores(
                np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), starts)
        return out

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            meta = list(zip(*[b.column(m).to_pylist() for m in metadata])) if metadata else [()] * b.num_rows
            yield pa.RecordBatch.from_arrays(
                [*map(b.column, keep), pa.array(scored(b.column("text"), meta), pa.float64())], [*keep, "score"])

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(batches, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT,
             rows: int = TRAIN_ROWS, metadata: tuple[str, ...] = (), threshold: float = THRESHOLD,
             keep: list[str] | None = None) -> DataFrame:
    """Fits on the labelled documents and scores all of ``docs``; held_out
    marks the rows of the fold that no label was learned from."""
    require(docs, ["doc_id", "text", *metadata])
    machine = train(docs, labels, label, folds, held_out, rows, metadata)
    return score(docs, machine, metadata, threshold, keep).withColumn(
        "held_out", F.coalesce(labelled.remainder("doc_id", folds) == held_out, F.lit(True)))
