"""Quality classifier: a generalised additive model with pairwise interactions.

Features are measured on whole texts (lengths, shares of character classes, repetition, layout);
labels, language, source and ids are never among them. Cyclic boosting goes round the features and
fits a shallow tree on one feature's bins at a time, so the model is a lookup table per feature,
and then one per chosen pair of features; a score is the logistic of a sum of looked-up values.

The fit uses a bounded sample (``SAMPLE_ROWS`` labelled rows of the training folds, those of the
smallest hashed ids); scoring is one pass over all rows in Arrow batches.

Defined cases: a null text counts as empty and is scored like any other; with no labelled row every
score is 1, so nothing is rejected; several labels of one id count as their largest, null labels
not at all; repeated rows are scored alike; extra columns stay in ``scored`` and ``accepted``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finflow.llm.common import fold_of, free_name

SAMPLE_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS = 120, 60
RATE, LEAVES, L2 = 0.15, 4, 2.0
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2

FEATURES = ("log_words", "word_length", "upper", "digits", "stops", "marks", "symbols", "bangs", "bars",
            "wide", "distinct_words", "log_lines", "distinct_lines", "line_length", "capital_words", "marked_words")

_UPPER, _LOWER = np.arange(65, 91), np.arange(97, 123)
_MARKS = np.frombuffer(b",;:'\"-()?", np.uint8)
_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@[\\]^_`{}~", np.uint8)


def features_of(data: bytes) -> list[float]:
    n = max(1, len(data))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    lines = data.split(b"\n")
    w = max(1, len(words))
    letters = max(1, int(counts[_UPPER].sum() + counts[_LOWER].sum()))
    distinct = set(words)
    return [
        np.log1p(len(words)), sum(map(len, words)) / w, counts[_UPPER].sum() / letters, counts[48:58].sum() / n,
        counts[46] / w, counts[_MARKS].sum() / w, counts[_SYMBOLS].sum() / w, counts[33] / w, counts[124] / w,
        counts[128:].sum() / n, len(distinct) / w, np.log1p(len(lines)), len(set(lines)) / len(lines), n / len(lines),
        sum(x.istitle() for x in distinct) / max(1, len(distinct)),
        sum(not x[-1:].isalnum() and x[-1] < 128 for x in distinct) / max(1, len(distinct)),
    ]


def _matrix(texts: pa.Array) -> np.ndarray:
    rows = [features_of(t or b"") for t in texts.cast(pa.large_binary()).to_pylist()]
    return np.array(rows, np.float64).reshape(-1, len(FEATURES))


@dataclass
class Model:
    bias: float = 0.0
    edges: list = field(default_factory=list)  # by feature: inner bounds of its bins
    tables: list = field(default_factory=list)  # by feature: a value for each bin
    pairs: list = field(default_factory=list)  # (feature, feature, inner bounds, inner bounds, table)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for f, (edges, values) in enumerate(zip(self.edges, self.tables)):
            out += values[np.searchsorted(edges, x[:, f], side="right")]
        for f, g, fe, ge, values in self.pairs:
            out += values[np.searchsorted(fe, x[:, f], side="right"), np.searchsorted(ge, x[:, g], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _bounds(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int) -> np.ndarray:
    """Step for each bin from a tree of so many leaves, grown by the best split of any leaf."""
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + L2)
    parts = [(0, len(grad))]
    while len(parts) < leaves:
        best = max(((gain(a, k) + gain(k, b) - gain(a, b), a, k, b) for a, b in parts for k in range(a + 1, b)), default=None)
        if best is None or best[0] <= 1e-9:
            break
        _, a, k, b = best
        parts[parts.index((a, b)):parts.index((a, b)) + 1] = [(a, k), (k, b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + L2)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """Best single cut on one feature with a cut on the other on either side, and its gain."""
    best, out = 0.0, np.zeros_like(grad)
    for turn in (False, True):
        a, b = (grad.T, hess.T) if turn else (grad, hess)
        g, h = a.cumsum(0).cumsum(1), b.cumsum(0).cumsum(1)
        for i in range(a.shape[0] - 1):
            halves = [(0, i + 1), (i + 1, a.shape[0])]
            total, step = 0.0, np.zeros_like(a)
            for lo, hi in halves:
                top = g[hi - 1] - (g[lo - 1] if lo else 0)
                weight = h[hi - 1] - (h[lo - 1] if lo else 0)
                left = top[:-1] ** 2 / (weight[:-1] + L2) + (top[-1] - top[:-1]) ** 2 / (weight[-1] - weight[:-1] + L2)
                if not len(left):
                    step[lo:hi] = top[-1] / (weight[-1] + L2)
                    total += top[-1] ** 2 / (weight[-1] + L2)
                    continue
                k = int(left.argmax())
                total += left[k]
                step[lo:hi, :k + 1] = top[k] / (weight[k] + L2)
                step[lo:hi, k + 1:] = (top[-1] - top[k]) / (weight[-1] - weight[k] + L2)
            if total > best:
                best, out = total, step.T if turn else step
    return out, best - grad.sum() ** 2 / (hess.sum() + L2)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Main effects first, then the pairs whose trees explain most of what is left."""
    if not len(y):
        return Model(bias=40.0)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(bias=float(np.log(rate / (1 - rate))))
    margin = np.full(len(y), model.bias)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    model.edges = [_bounds(x[:, f], BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    for _ in range(ROUNDS):
        for f, at in enumerate(bins):
            r, w = slopes()
            n = len(model.tables[f])
            step = RATE * _tree(np.bincount(at, r, n), np.bincount(at, w, n), LEAVES)
            model.tables[f] += step
            margin += step[at]
    coarse = [_bounds(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]

    def grid(f, g, r, w):
        shape = len(coarse[f]) + 1, len(coarse[g]) + 1
        at = cells[f] * shape[1] + cells[g]
        return at, np.bincount(at, r, shape[0] * shape[1]).reshape(shape), np.bincount(at, w, shape[0] * shape[1]).reshape(shape)

    r, w = slopes()
    gains = sorted(((_pair_tree(*grid(f, g, r, w)[1:])[1], f, g) for f in range(len(cells)) for g in range(f)
                    if len(coarse[f]) and len(coarse[g])), reverse=True)
    model.pairs = [(f, g, coarse[f], coarse[g], np.zeros((len(coarse[f]) + 1, len(coarse[g]) + 1))) for _, f, g in gains[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for f, g, _, _, values in model.pairs:
            r, w = slopes()
            at, gg, hh = grid(f, g, r, w)
            step = RATE * _pair_tree(gg, hh)[0]
            values += step
            margin += step.ravel()[at]
    return model


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on labelled rows outside the held-out fold, at most ``sample_rows`` of them."""
    known = (labels.where("quality is not null and doc_id is not null").where(fold_of(F.col("doc_id"), FOLDS) != HELD_OUT)
             .groupBy("doc_id").agg(F.max("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    # At most sample_rows rows of two numbers: small enough to broadcast whatever the corpus.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "quality")

    def measure(batches):
        for batch in batches:
            x = _matrix(batch.column(0))
            yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in x.T], batch.column(1).cast(pa.float64())], names=[*FEATURES, "y"])

    # An id that occurs in many rows must not grow the sample.
    schema = ", ".join(f"{c} double" for c in (*FEATURES, "y"))
    got = rows.mapInArrow(measure, schema).orderBy(F.xxhash64(*FEATURES)).limit(sample_rows).toPandas()
    return fit(got[list(FEATURES)].to_numpy(np.float64), got["y"].to_numpy(np.float64))


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the column ``name`` (0 to 1, higher: better)."""
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            score = model.score(_matrix(batch.column(place))) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=[*names, name])

    names = list(docs.columns)
    schema = docs.select("*", F.lit(0.0).alias(name)).schema
    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = scored(docs.select("doc_id", "text"), train(docs, labels))
    return rows.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                       "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns untouched."""
    name = free_name(docs.columns, "score")
    return scored(docs, train(docs, labels), name).where(F.col(name) >= THRESHOLD).drop(name)
