"""Spelling variants: words one edit apart, each with the much more frequent word it may stand for.

Bloom-guided neighbourhoods: every word's edits are generated as hashes (a rolling hash changes by
one term when a letter is replaced or left out) and probed against blocked Bloom filters of the
vocabulary, one filter for each word length, which every task holds. Only the edits that a filter
lets through are spelt out and shuffled to an exact join with the vocabulary, which removes the
filters' errors. Being one edit apart goes both ways, so letters are left out but never put in, and
replaced only by later ones: each pair is found once, from one side.

The filters take ``BITS`` bits a word and at most ``FILTER_BYTES`` in all, whatever the vocabulary;
beyond that the bits are spread thinner, more edits pass, and the join still decides.

Defined cases: a null or empty text has no words; a null id counts as the empty text in the rule
that deletes letters; every row counts, repeated ones too; an empty table gives an empty result;
further columns of ``docs`` are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finflow.llm.common import ASCII_LOWER, ASCII_UPPER, mix64, written

MIN_LENGTH, MIN_COUNT, TIMES, DELETE_EVERY = 6, 5, 5, 199
BITS, PROBES, FILTER_BYTES = 16, 7, 48 << 20
#: Words of this length and more share a filter.
LONGEST = 40
#: Edits probed together, and words a task counts before it hands them on.
EDITS, HELD = 2_000_000, 300_000

_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, delete_every: int = DELETE_EVERY) -> DataFrame:
    """``word``, ``n`` of all runs of Latin letters of so many letters, a few by rule without one letter."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)

    def count(batches):
        held: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            for name, text in zip(batch.column(0).to_pylist(), texts):
                start = zlib.crc32(f"{name or ''}:".encode())
                for word, n in Counter(runs.findall((text or b"").translate(_LOWER).decode("utf-8", "replace"))).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % delete_every == 0:
                        k = h % len(word)
                        word = word[:k] + word[k + 1:]
                        if len(word) < min_length:
                            continue
                    held[word] += n
                if len(held) > HELD:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    parts = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _powers(length: int) -> np.ndarray:
    """Weight of each letter of a word of so many letters: powers of the base, the last letter's is 1."""
    return np.array([pow(_BASE, length - 1 - k, 1 << 64) for k in range(length)], np.uint64)


def _letters(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of letters (all below U+0100)."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _by_length(words: list[str]):
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        yield length, np.flatnonzero(lengths == length)


def _places(h: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and the 63 bits that name its places in the block."""
    h = mix64(h)
    return ((h >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32), mix64(h ^ np.uint64(0x5851F42D4C957F2D))


def places_set(h: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, the block's eight words with the hash's places set) of each hash."""
    block, places = _places(h, n_blocks)
    out = np.zeros((len(h), 8), np.uint64)
    rows = np.arange(len(h))
    for k in range(PROBES):
        at = (places >> np.uint64(9 * k)) & np.uint64(511)
        out[rows, (at >> np.uint64(6)).astype(np.int64)] |= np.uint64(1) << (at & np.uint64(63))
    return block.astype(np.int64), out


def passing(table: dict[int, np.ndarray], h: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the hashes that the filter of this length lets through."""
    words = table.get(min(length, LONGEST))
    if words is None:
        return np.empty(0, np.int64)
    block, places = _places(h, len(words))
    left = np.arange(len(h))
    for k in range(PROBES):
        at = (places[left] >> np.uint64(9 * k)) & np.uint64(511)
        here = words[block[left].astype(np.int64), (at >> np.uint64(6)).astype(np.int64)]
        left = left[(here >> (at & np.uint64(63))) & np.uint64(1) == 1]
    return left


def filters(words: DataFrame, bits: int = BITS, most: int = FILTER_BYTES) -> dict[int, np.ndarray]:
    """Blocked Bloom filters by word length (a block is 512 bits, a row of eight 64-bit words), put together
    from the tasks' blocks; at most ``most`` bytes reach the driver."""
    sizes = words.groupBy(F.least(F.length("word"), F.lit(LONGEST)).alias("shard")).count().collect()  # LONGEST rows at most
    thinner = min(1.0, most / max(1, sum(r["count"] for r in sizes) * bits / 8))
    blocks = {r.shard: max(1, int(r["count"] * bits * thinner / 512)) for r in sizes}
    cells = [f"w{k}" for k in range(8)]

    def place(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            for length, own in _by_length(words):
                h = (_letters([words[k] for k in own]).astype(np.uint64) * _powers(length)).sum(1, dtype=np.uint64)
                shard = min(length, LONGEST)
                block, bits_set = places_set(h, blocks[shard])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), shard, np.int32)), pa.array(block), *map(pa.array, bits_set.view(np.int64).T)],
                                                 names=["shard", "block", *cells])

    schema = "shard int, block long, " + ", ".join(f"{c} long" for c in cells)
    got = (words.select("word").mapInArrow(place, schema).groupBy("shard", "block").agg(*[F.bit_or(c).alias(c) for c in cells]).toArrow())
    shards, rows = got.column("shard").to_numpy(), got.column("block").to_numpy()
    table = np.stack([got.column(c).to_numpy() for c in cells], axis=1).view(np.uint64)
    out = {shard: np.zeros((n, 8), np.uint64) for shard, n in blocks.items()}
    for shard, own in out.items():
        here = shards == shard
        own[rows[here]] = table[here]
    return out


def _edits(letters: np.ndarray, alphabet: np.ndarray):
    """(hash, word, place, letter; 0: left out) of the edits of words of one length; later letters only."""
    n, length = letters.shape
    wide, weight = letters.astype(np.uint64), _powers(length)
    terms = wide * weight
    whole = terms.sum(1, dtype=np.uint64)
    # What stands before a place loses one power of the base when the place's letter goes.
    before = np.zeros((n, length), np.uint64)
    shorter = np.concatenate([weight[1:], [np.uint64(0)]])
    before[:, 1:] = np.cumsum(wide * shorter, axis=1, dtype=np.uint64)[:, :-1]
    after = whole[:, None] - np.cumsum(terms, axis=1, dtype=np.uint64)
    # A letter of a run of equal ones gives the same word whichever goes: only the run's first.
    w, p = np.nonzero(np.concatenate([np.ones((n, 1), bool), letters[:, 1:] != letters[:, :-1]], axis=1))
    yield length - 1, before[w, p] + after[w, p], w, p, np.zeros(len(w), np.uint8)
    for at in range(length):
        w, c = np.nonzero(alphabet[None, :] > letters[:, at, None])
        new = alphabet[c]
        yield length, whole[w] + (new.astype(np.uint64) - wide[w, at]) * weight[at], w, np.full(len(w), at), new


def near_pairs(words: DataFrame, table: dict[int, np.ndarray]) -> DataFrame:
    """``word``, ``n``, ``other``, ``other_n`` of all words one edit apart, each pair once."""
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast(table)  # FILTER_BYTES at most
    letters = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()  # 90 rows at most
    alphabet = np.array(sorted(ord(r.c) for r in letters), np.uint8)

    def probe(batches):
        held = shared.value
        for batch in batches:
            words = batch.column(0).to_pylist()
            for length, own in _by_length(words):
                step = max(1, EDITS // max(1, len(alphabet) + length))
                for k in range(0, len(own), step):
                    some = own[k:k + step]
                    for other_length, h, w, p, c in _edits(_letters([words[i] for i in some]), alphabet):
                        left = passing(held, h, other_length)
                        if not len(left):
                            continue
                        rows = some[w[left]]
                        other = [words[i][:a] + (chr(x) if x else "") + words[i][a + 1:] for i, a, x in zip(rows.tolist(), p[left].tolist(), c[left].tolist())]
                        yield pa.RecordBatch.from_arrays([*[x.take(pa.array(rows)) for x in batch.columns], pa.array(other, pa.string())], names=["word", "n", "other"])

    found = words.select("word", "n").mapInArrow(probe, "word string, n long, other string")
    return found.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").select("word", "n", "other", "other_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` of (word, form) rows: forms followed to the last by pointer jumping. A form is
    ``TIMES`` as frequent as its word, so chains are short and have no rings."""
    now = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "variant-roots")
    while now.where("moved").limit(1).count():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = written(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
                      "variant-roots")
    return now.drop("moved")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, times: int = TIMES,
             delete_every: int = DELETE_EVERY) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of so many letters and occurrences."""
    words = written(word_counts(docs, min_length, delete_every).where(F.col("n") >= min_count), "variant-words")
    pairs = written(near_pairs(words, filters(words)), "variant-pairs")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("down"), "other")).alias("best"))
    near = words.join(best, "word", "left")
    far = -F.col("best.down") >= times * F.col("n")
    out = written(near.select("word", F.when(far, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                              F.when(far, -F.col("best.down")).alias("form_n")), "variant-forms")
    last = roots(out.where("form is not null"))
    return out.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame) -> DataFrame:
    return variants(docs)
