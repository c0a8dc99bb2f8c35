"""Toxicity: a convolutional text classifier, trained in numpy.

A word's embedding is the sum of two hashed rows, one for the word and one
for its first letters.  Filters of several widths run over the sequence of
embeddings; each filter's largest response in the document (max pooling,
over the whole text) feeds a logistic unit with weights of at least zero.  Gradients are written out by
hand: only the position of each maximum takes part.

Thresholds are calibrated by language on part of the sample that the
weights were not fitted on.  The language of a text is guessed from its own
function words, never read from a column.  A language's threshold becomes
the published one by shifting the margins of its documents, so that one
threshold holds for all scores.

Defined cases
* null or empty text, or text without letters: no responses; scored by the
  bias alone;
* text of any length is scored as a whole, in overlapping windows;
* no labels, or labels of one class only: the score of every document is
  the share of that class (one half without any);
* null doc_id: scored, counted as held out;
* repeated rows are scored alike; empty input: empty output;
* other columns pass through; an existing score, predicted or language is
  replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import labelled
from .common import require

WORDS = 1 << 17
PREFIXES = 1 << 14
PREFIX = 4
DIM = 16
#: Spread of embeddings before training: words that were never seen stay close to zero.
START = 0.01
WIDTHS = (1, 2, 3)
FILTERS = 8
TRAIN_ROWS = 8000
EPOCHS, STEPS = 6, 600
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
#: Positive calibration documents that a language needs for a threshold of its own.
LEAST_POSITIVE = 8
#: Words in a window, and words whose responses are held at once.
WINDOW, BLOCK = 1 << 13, 1 << 15
MEMO = 400_000

#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are with as be this have from or by not but at an",
    "de": "der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch es an werden aus er",
    "fr": "le la les de des et un une du en que qui dans il pour pas sur au par plus avec est ce ne se",
    "es": "el la los las de y en que del un una por con para su al lo como más se no es sus pero",
}
LANGUAGES = [*FUNCTION_WORDS, "other"]
_LANGUAGE = {}
for _i, _words in enumerate(FUNCTION_WORDS.values()):
    for _w in _words.split():
        _LANGUAGE[_w] = _LANGUAGE.get(_w, 0) | 1 << _i


class _Codes(dict):
    """Token -> word bucket, prefix bucket and language marks in one integer,
    remembered within a Python worker; -1 for a token without letters."""

    def __missing__(self, token: str) -> int:
        word = token
        if not token.isalpha():
            word = "".join(c for c in token if c.isalpha())
        code = -1
        if word:
            code = (zlib.crc32(word.encode()) % WORDS
                    | zlib.crc32(word[:PREFIX].encode()) % PREFIXES << 20 | _LANGUAGE.get(word, 0) << 40)
        if len(token) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[token] = code
        return code


_codes = _Codes()


def encode(text: str | None) -> np.ndarray:
    """A text's words as codes."""
    tokens = (text or "").lower().split()
    codes = np.fromiter(map(_codes.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    return codes[codes >= 0]


def language(codes: np.ndarray) -> int:
    """The language with most function words; the last one if there are none."""
    marks = codes >> 40
    found = [int(np.count_nonzero(marks >> i & 1)) for i in range(len(FUNCTION_WORDS))]
    return int(np.argmax(found)) if max(found) else len(FUNCTION_WORDS)


@dataclass
class Network:
    words: np.ndarray
    prefixes: np.ndarray
    filters: list[np.ndarray]  # per width: (width, DIM, FILTERS)
    offsets: list[np.ndarray]
    out: np.ndarray
    bias: float
    shift: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))

    def embedded(self, codes: np.ndarray) -> np.ndarray:
        return self.words[codes & 0xFFFFF] + self.prefixes[codes >> 20 & 0xFFFFF]

    def responses(self, x: np.ndarray) -> np.ndarray:
        """Responses of all filters at every place of (words, DIM); a filter
        at the end sees zeros beyond it."""
        found = []
        for w, filters in enumerate(self.filters):
            width = WIDTHS[w]
            own = x @ filters.transpose(1, 0, 2).reshape(DIM, -1)
            total = own[:, :FILTERS].copy()
            for o in range(1, width):
                total[:-o or None] += own[o:, o * FILTERS:(o + 1) * FILTERS]
            found.append(total + self.offsets[w])
        return np.concatenate(found, axis=1)

    def pooled(self, docs: list[np.ndarray]) -> np.ndarray:
        """Largest responses per document, zero at least."""
        out = np.zeros((len(docs), len(WIDTHS) * FILTERS), np.float32)
        reach, block, owner, held = max(WIDTHS) - 1, [], [], 0

        def flush():
            if not block:
                return
            gap = np.zeros((reach, DIM), np.float32)  # filters do not see across windows
            parts, starts, at = [], [], 0
            for codes in block:
                parts += [self.embedded(codes), gap]
                starts.append(at)
                at += len(codes) + reach
            found = self.responses(np.concatenate(parts))
            # a place inside the gap sees zeros only, so its response is the offset
            keep = np.ones(at, bool)
            ends = np.array([s + len(c) for s, c in zip(starts, block)])
            for r in range(reach):
                keep[ends + r] = False
            found[~keep] = 0
            np.maximum.at(out, np.array(owner), np.maximum.reduceat(found, np.array(starts), axis=0))

        for i, codes in enumerate(docs):
            for a in range(0, len(codes), WINDOW):
                part = codes[a:a + WINDOW + reach]
                block.append(part)
                owner.append(i)
                held += len(part)
                if held >= BLOCK:
                    flush()
                    block, owner, held = [], [], 0
        flush()
        return out

    def margins(self, docs: list[np.ndarray]) -> np.ndarray:
        return self.pooled(docs) @ self.out + self.bias

    def scores(self, docs: list[np.ndarray], languages: np.ndarray) -> np.ndarray:
        margins = self.margins(docs).astype(np.float64) + self.shift[languages]
        return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def fresh(seed: int = 11) -> Network:
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    return Network(
        draw(WORDS, DIM, scale=START), draw(PREFIXES, DIM, scale=START),
        [draw(w, DIM, FILTERS, scale=0.3 / math.sqrt(w)) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        np.abs(draw(len(WIDTHS) * FILTERS, scale=0.3)), -2.0)


def constant(share: float) -> Network:
    net, share = fresh(), min(max(share, 1e-6), 1 - 1e-6)
    net.out[:], net.bias = 0, math.log(share / (1 - share))
    return net


class _Adagrad:
    def __init__(self, array: np.ndarray, rate: float):
        self.array, self.rate, self.seen = array, rate, np.full_like(array, 1e-3)

    def step(self, grad: np.ndarray, rows=slice(None)) -> None:
        self.seen[rows] += np.square(grad)
        self.array[rows] -= self.rate * grad / np.sqrt(self.seen[rows])


def fit(docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, batch: int = 64,
        rate: float = 0.05) -> Network:
    rng, net = np.random.default_rng(5), fresh()
    words, prefixes, out = _Adagrad(net.words, rate), _Adagrad(net.prefixes, rate), _Adagrad(net.out, rate)
    filters = [_Adagrad(f, rate) for f in net.filters]
    offsets = [_Adagrad(o, rate) for o in net.offsets]
    bias, seen = net.bias, 1e-3
    batch = min(batch, max(8, len(docs) // 20))
    epochs = max(epochs, -(-STEPS * batch // len(docs)))
    reach = max(WIDTHS) - 1
    gap = np.full(reach, -1, np.int64)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for a in range(0, len(order), batch):
            picked = order[a:a + batch]
            codes = np.concatenate([np.concatenate([docs[i], gap]) for i in picked])
            sizes = np.array([len(docs[i]) + reach for i in picked])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            real = codes >= 0
            x = net.embedded(np.where(real, codes, 0))
            x[~real] = 0
            found = net.responses(x)
            found[~real] = -np.inf
            top = np.zeros((len(picked), found.shape[1]), np.int64)
            for d, (s, n) in enumerate(zip(starts, sizes)):
                top[d] = s + found[s:s + n].argmax(axis=0)
            peak = np.take_along_axis(found, top, axis=0)
            on = peak > 0
            pool = np.where(on, peak, 0).astype(np.float32)
            p = 1 / (1 + np.exp(-np.clip(pool @ net.out + bias, -30, 30)))
            off = ((p - y[picked]) * weight[picked] / len(picked)).astype(np.float32)
            back = off[:, None] * net.out * on  # (documents, filters)
            grad_x_at, grad_x = [], []
            for w, width in enumerate(WIDTHS):
                mine = slice(w * FILTERS, (w + 1) * FILTERS)
                g, at = back[:, mine], top[:, mine]
                grad = np.zeros_like(net.filters[w])
                for o in range(width):
                    place = np.minimum(at + o, len(x) - 1)
                    grad[o] = np.einsum("bf,bfd->df", g, x[place])
                    grad_x_at.append(place.ravel())
                    grad_x.append((g[:, :, None] * net.filters[w][o].T[None]).reshape(-1, DIM))
                filters[w].step(grad)
                offsets[w].step(g.sum(axis=0))
            at, slope = np.concatenate(grad_x_at), np.concatenate(grad_x)
            live = real[at] & (np.abs(slope).max(axis=1) > 0)
            at, slope = at[live], slope[live]
            for table, row in ((words, codes[at] & 0xFFFFF), (prefixes, codes[at] >> 20 & 0xFFFFF)):
                unique, inverse = np.unique(row, return_inverse=True)
                total = np.zeros((len(unique), DIM), np.float32)
                np.add.at(total, inverse, slope)
                table.step(total, unique)
            out.step(pool.T @ off)
            np.maximum(net.out, 0, out=net.out)  # a response is evidence; none outweighs another
            seen += float(off.sum()) ** 2
            bias -= rate * float(off.sum()) / math.sqrt(seen)
    net.bias = bias
    return net


def calibrate(net: Network, docs: list[np.ndarray], y: np.ndarray, threshold: float = THRESHOLD) -> Network:
    """Shifts per language, so that its best threshold on these documents
    becomes ``threshold``: the middle of the widest gap between margins
    among the cuts with the fewest errors."""
    margins = net.margins(docs).astype(np.float64)
    languages = np.array([language(d) for d in docs])
    goal = math.log(threshold / (1 - threshold))

    def shift(m: np.ndarray, t: np.ndarray) -> float:
        order = np.argsort(m)
        m, t = m[order], t[order]
        errors = np.concatenate([[0], np.cumsum(t)]) + np.concatenate([np.cumsum((1 - t)[::-1])[::-1], [0]])
        edges = np.concatenate([[m[0] - 2], m, [m[-1] + 2]])
        best = np.flatnonzero(errors == errors.min())
        cut = best[np.argmax(edges[best + 1] - edges[best])]
        return goal - (edges[cut] + edges[cut + 1]) / 2

    common = shift(margins, y) if 0 < y.sum() < len(y) else 0.0
    net.shift[:] = common
    for i in range(len(LANGUAGES)):
        mine = languages == i
        if LEAST_POSITIVE <= y[mine].sum() < mine.sum():
            net.shift[i] = shift(margins[mine], y[mine])
    return net


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT,
          rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> Network:
    """A network from at most ``rows`` labelled documents outside the
    held-out fold; every fifth of them calibrates, the others fit."""
    sample, counts = labelled.sample(docs, labels, label, folds, held_out, rows)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"),
                 pa.array([encode(t.as_py()) for t in b.column("text")], pa.list_(pa.int64()))], ["doc_id", "y", "codes"])

    got = sample.select("doc_id", "y", "text").mapInArrow(
        batches, "doc_id long, y int, codes array<bigint>").toArrow().sort_by("doc_id")
    y = np.array(got["y"].to_pylist(), dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.5)
    coded = [c.values.to_numpy() for c in got["codes"]]
    coded = [c if len(c) else np.zeros(1, np.int64) for c in coded]
    scale = {c: counts[c] / max(1, int((y == c).sum())) for c in (0, 1)}
    weight = np.sqrt(np.where(y == 1, scale[1], scale[0])).astype(np.float32)
    apart = np.arange(len(y)) % 5 == 4
    fitting = np.flatnonzero(~apart)
    net = fit([coded[i] for i in fitting], y[fitting], weight[fitting] / weight[fitting].mean())
    checked = np.flatnonzero(apart) if 0 < y[apart].sum() < apart.sum() else np.arange(len(y))
    return calibrate(net, [coded[i] for i in checked], y[checked], threshold)


def score(docs: DataFrame, net: Network, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with score, language and predicted."""
    docs = docs.drop(*[c for c in ("score", "predicted", "language") if c in docs.columns])
    keep = keep or docs.columns
    held = docs.sparkSession.sparkContext.broadcast(net)  # of fixed size

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = held.value
        for b in it:
            scores, spoken = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64)
            block, begin, words = [], 0, 0
            for i, text in enumerate(b.column("text")):
                codes = encode(text.as_py())
                block.append(codes)
                spoken[i] = language(codes)
                words += len(codes)
                if words >= BLOCK or i == b.num_rows - 1:
                    scores[begin:i + 1] = net.scores(block, spoken[begin:i + 1])
                    block, begin, words = [], i + 1, 0
            yield pa.RecordBatch.from_arrays(
                [*map(b.column, keep), pa.array(scores), pa.array([LANGUAGES[s] for s in spoken], pa.string())],
                [*keep, "score", "language"])

    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("score", T.DoubleType()), T.StructField("language", T.StringType())])
    return docs.mapInArrow(batches, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT,
             rows: int = TRAIN_ROWS, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Fits on the labelled documents and scores all of ``docs``; held_out
    marks the rows of the fold that no label was learned from."""
    require(docs, ["doc_id", "text"])
    net = train(docs, labels, label, folds, held_out, rows, threshold)
    return score(docs, net, threshold, keep).withColumn(
        "held_out", F.coalesce(labelled.remainder("doc_id", folds) == held_out, F.lit(True)))
