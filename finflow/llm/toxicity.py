"""Toxicity by compression distance: which of two zstandard dictionaries makes a text's windows shorter.

A window is a word between blanks. Two dictionaries are trained: one on the windows of ordinary
documents, one on those of toxic documents that ordinary ones lack (a window counts if the documents
that hold it speak for toxicity by ``EVIDENCE``, a likelihood ratio; near copies count once). Every
window is compressed with the ordinary dictionary alone and with the toxic one set behind it. The
base being the same, the lengths differ only where the toxic dictionary knows more of the window: the
bytes it saves are the window's gain. A window with no ``GRAM`` bytes in a row that only the toxic
dictionary has saves nothing and is not compressed. A document's counts of windows by gain go through
a logistic function whose weights are fitted on labelled rows that trained no dictionary.

The fit uses a bounded sample (``SAMPLE_ROWS`` labelled rows of the training folds, those of the
smallest hashed ids; of each at most ``ROW_WINDOWS`` distinct windows for the dictionaries, those of
the smallest checksums); every text is scored whole.

Defined cases: a null text counts as empty and is scored like any other; without toxic rows in the
sample every score is 0; several labels of one id count as their largest, null labels not at all;
repeated rows are scored alike; extra columns stay in ``scored``, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finflow.llm.common import fold_of, free_name

SAMPLE_ROWS, ROW_WINDOWS = 12_000, 1_000
ORDINARY_BYTES, TOXIC_BYTES = 64 << 10, 16 << 10
#: Twice the log-likelihood ratio that makes a window toxic; about 3.7 standard deviations.
EVIDENCE = 14.0
GRAM, FRAME, CARRIER = 5, b"   ", 60
GAINS = range(2, 9)
THRESHOLD = 0.3
FOLDS, HELD_OUT, CALIBRATION = 4, 2, 3
L2 = 0.1
#: Windows a task remembers the gain of.
MEMO = 400_000

_WORD = re.compile(r"\w{1,64}")


def windows(text: bytes | None) -> list[str]:
    return _WORD.findall((text or b"").decode("utf-8", "replace").lower())


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))  # none: every score is 0

    def gains(self) -> Gains:
        return Gains(self.ordinary, self.toxic)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -40, 40))) if len(self.weights) else np.zeros(len(x))


def _grams(data: bytes) -> set[bytes]:
    return {data[k:k + GRAM] for k in range(len(data) - GRAM + 1)}


class Gains(dict):
    """Bytes that the toxic dictionary saves on a window, remembered for the first ``MEMO`` windows."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        super().__init__()
        import zstandard
        self.telling = _grams(toxic) - _grams(ordinary)
        # What the ordinary dictionary holds in one piece takes the place of a frame's fixed costs.
        self.carrier = ordinary[-4000:][:CARRIER]

        def compressor(content: bytes):
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters(
                strategy=zstandard.STRATEGY_BTOPT, min_match=4, window_log=18, hash_log=17, chain_log=17, search_log=8,
                target_length=256, write_content_size=False, write_checksum=False, write_dict_id=False)
            held.precompute_compress(compression_params=how)
            return zstandard.ZstdCompressor(compression_params=how, dict_data=held).compress

        self.plain, self.both = (compressor(c) for c in (ordinary or FRAME * 3, (ordinary or FRAME * 3) + toxic))

    def __missing__(self, window: str) -> int:
        word, telling = window.encode(), self.telling
        near = b" " + word + b" "
        gain = 0
        if any(near[k:k + GRAM] in telling for k in range(len(near) - GRAM + 1)):
            whole = self.carrier + FRAME + word + FRAME
            gain = len(self.plain(whole)) - len(self.both(whole))
        if len(self) < MEMO:
            self[window] = gain
        return gain


def features_of(words: list[str], gains: Gains) -> list[float]:
    found = [g for g in map(gains.__getitem__, words) if g > 0]
    return [1.0, *(math.log1p(sum(g >= k for g in found)) for k in GAINS), max(found, default=0) / 8,
            math.log1p(len(words)), math.log1p(sum(g - 1 for g in found))]


N_FEATURES = 4 + len(GAINS)


def _dictionary(samples: list[bytes], size: int) -> bytes:
    import zstandard
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little to train on: it all fits
        return b"".join(samples)[:size]


def dictionaries(rows: list[tuple[int, int, str]]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) from (label, key of near copies, windows one to a line) rows."""
    kept: dict[int, tuple[int, list[str]]] = {}
    for y, key, own in sorted(rows):
        kept.setdefault(key, (y, own.split("\n") if own else []))
    held = [Counter(), Counter()]
    for y, own in kept.values():
        held[y].update(own)
    n = [sum(y == k for y, _ in kept.values()) for k in (0, 1)]

    def evidence(word: str) -> float:
        a, b = held[1][word], held[0][word]
        share = n[1] / (n[0] + n[1])
        if a <= (a + b) * share:
            return 0.0
        return 2 * (a * math.log(a / ((a + b) * share)) + (b * math.log(b / ((a + b) * (1 - share))) if b else 0.0))

    telling = {w for w in held[1] if evidence(w) >= EVIDENCE}
    framed = lambda own: FRAME + FRAME.join(w.encode() for w in own) + FRAME
    toxic = [framed(t) for y, own in kept.values() if y for t in [[w for w in own if w in telling]] if t]
    ordinary = [framed(own) for y, own in kept.values() if not y and own]
    return _dictionary(ordinary, ORDINARY_BYTES), _dictionary(toxic, TOXIC_BYTES)


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + L2 * np.eye(len(w)), x.T @ (y - p) - L2 * w)
    return w


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Dictionaries and weights from labelled rows outside the held-out fold, at most ``sample_rows`` of them."""
    known = (labels.where("toxic is not null and doc_id is not null").where(fold_of(F.col("doc_id"), FOLDS) != HELD_OUT)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
             .withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(CALIBRATION))))
    # At most sample_rows rows of three numbers: small enough to broadcast whatever the corpus.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic", "part")

    def take(batches):
        for batch in batches:
            out = []
            for text, y in zip(batch.column(0).cast(pa.large_binary()).to_pylist(), batch.column(1).to_pylist()):
                words = windows(text)
                key = min((zlib.crc32(" ".join(words[k:k + 3]).encode()) for k in range(max(1, len(words) - 2))), default=0)
                own = sorted(set(words), key=lambda w: (zlib.crc32(w.encode()), w))[:ROW_WINDOWS]
                out.append((int(y > 0), key, "\n".join(own)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()),
                                              pa.array([r[2] for r in out], pa.string())], names=["y", "key", "words"])

    # An id that occurs in many rows must not grow the sample.
    got = (rows.where(F.col("part") > 0).mapInArrow(take, "y int, key long, words string")
           .orderBy(F.xxhash64("key", "words"), "y").limit(sample_rows).collect())
    if not any(r.y for r in got):
        return Model()
    model = Model(*dictionaries([tuple(r) for r in got]))
    if not model.toxic:  # nothing tells the toxic rows from the others
        return Model()
    names = [f"x{k}" for k in range(N_FEATURES)]

    def measure(batches):
        gains = model.gains()
        for batch in batches:
            x = _matrix(batch.column(0), gains)
            yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in x.T], pa.array(batch.column(1)).cast(pa.float64())], names=[*names, "y"])

    schema = ", ".join(f"{c} double" for c in (*names, "y"))
    held = (rows.where(F.col("part") == 0).mapInArrow(measure, schema).orderBy(F.xxhash64(*names), "y").limit(sample_rows).toPandas())
    y = (held["y"].to_numpy(np.float64) > 0).astype(float)
    return Model(model.ordinary, model.toxic, fit(held[names].to_numpy(np.float64), y) if y.any() else np.zeros(0))


def _matrix(texts: pa.Array, gains: Gains) -> np.ndarray:
    rows = [features_of(windows(t), gains) for t in texts.cast(pa.large_binary()).to_pylist()]
    return np.array(rows, np.float64).reshape(-1, N_FEATURES)


def scored(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """``docs`` with a last column, the chance (0 to 1) that the text is toxic; it is called ``name``, with
    underscores added while ``docs`` has such a column."""
    place, names = docs.columns.index("text"), [*docs.columns, free_name(docs.columns, name)]

    def run(batches):
        gains = model.gains()
        for batch in batches:
            score = model.score(_matrix(batch.column(place), gains))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=names)

    return docs.mapInArrow(run, docs.select("*", F.lit(0.0).alias(names[-1])).schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = scored(docs.select("doc_id", "text"), train(docs, labels), "score")
    return rows.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
