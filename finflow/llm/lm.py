"""Language-model scores by a hierarchical Pitman-Yor model.

Restaurants of words: one for each context of ORDER - 1 words that occurs in training, whose parent is
that of the next shorter context, down to the restaurant of no context. A new table there has a dish
spelt by a hierarchy of byte restaurants, one for each context: the letter before, that and the class of
the second one before, and so on. Every context restaurant shares its parent (the shorter context) with
its siblings, down to the empty context and a uniform base. A word's end is a symbol of its own, and the
end of a text is the empty word (which also stands before a text's first word), so probabilities add up
to one over all texts.

Seating is sampled by blocked Gibbs sweeps: given the parents' predictive probabilities of the last
sweep, the customers of every dish are seated anew, restaurant by restaurant; tables send customers
to the parent. Words are rows of a DataFrame; n-grams are named by 64-bit hashes of their words and kept
packed (a table of hashes, and columns of numbers in it) in parts of about PART_TOKENS training tokens. A
trigram and its bigram lie by the word they share (the one before the last), which a frequent word splits by
the other word, so no part grows with a word. In a sweep the parts of bigrams send those of trigrams their
parents' probabilities and get the tables back, both in a fixed order without keys; a dish whose only
customer has its only table is not seated again. The spelling tables have a fixed number of cells
(contexts x symbols), whatever the corpus, so those pass through the driver. Predictive probabilities
are averaged over the sweeps after burn-in. What a step has superseded is removed.

A context unseen in training leaves the word to the shorter one. ``score`` is the log probability of the text
itself: a word without customers has what the context's restaurants pass on, times the new-table mass, times
the probability of its own spelling. ``event_score`` counts each such word as the event "some unseen word"
instead (the contract's base has that event), whatever its letters.

Texts are taken apart once, into blocks of tokens. A block asks each part for its distinct n-grams and words
once, packed; its answers (customers, tables, probabilities in the order asked) meet its texts in one task.

Defined cases: a null or blank text is the end token alone; repeated rows are each learnt from and
scored; without training rows the score rests on the uniform spelling base and every count is 0; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from array import array
from collections import defaultdict
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from finflow.llm.common import Kept, WordHashes, fold_of, mix64  # noqa: F401 (WordHashes: the hashes that name words)

FOLDS, HELD_OUT = 7, 2
SWEEPS, BURN_IN = 3, 1
KEPT = range(SWEEPS - BURN_IN)
#: Words of an n-gram (the last one and its longest context), and the strength of the context restaurants (their discounts are estimated).
ORDER, CONTEXT_STRENGTH = 3, 1.0
#: Strength of the word restaurant (its discount is estimated), discounts and strengths of the byte restaurants by depth (0: no context).
WORD_STRENGTH = 50.0
BYTE_DISCOUNT, BYTE_STRENGTH = (0.1, 0.3, 0.5, 0.6), (1.0, 2.0, 2.0, 2.0)
#: Restaurants by depth: previous symbol (256: none), class of the second, class of the third before.
SYMBOLS, END, CLASSES, FAR_CLASSES = 257, 256, 16, 4
#: Tokens of a block of texts, and training tokens for each part of the packed n-grams.
FLUSH_TOKENS, PART_TOKENS = 2_000_000, 2_000_000
#: Rounds in which the parts are asked for the texts' n-grams, by order.
TURNS = {2: 1, ORDER: 3}


def words_of(data: bytes) -> list[bytes]:
    return data.lower().split()


# -- seating --------------------------------------------------------------------------------

def seat(customers: np.ndarray, fresh: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables of every dish after its customers are seated one by one.

    ``fresh``: weight of a new table, (strength + discount * all tables) * the parent's probability.
    Past the first customers, several are seated at once at the probability of the first of them.
    """
    customers = np.asarray(customers, np.int64)
    tables = (customers > 0).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    seated = np.ones(len(live), np.int64)
    while len(live):
        c, t, a = customers[live], tables[live], fresh[live]
        step = np.minimum(np.maximum(1, seated // 16), c - seated)
        p = a / np.maximum(seated - discount * t + a, 1e-300)
        tables[live] += rng.binomial(step, np.clip(p, 0.0, 1.0))
        seated += step
        keep = seated < c
        live, seated = live[keep], seated[keep]
    return tables


# -- spelling -------------------------------------------------------------------------------

def _spelling(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Cell (deepest restaurant * SYMBOLS + symbol) of every symbol of the words, and each word's first place."""
    flat = np.frombuffer(b"\n".join(words) + b"\n", np.uint8).astype(np.int64)  # words hold no white space
    flat[flat == 10] = END
    before = [np.concatenate([[END], flat[:-1]])]
    for _ in range(2):
        back = np.concatenate([[END], before[-1][:-1]])
        back[before[-1] == END] = END
        before.append(back)
    place = (before[0] * CLASSES + before[1] % CLASSES) * FAR_CLASSES + before[2] % FAR_CLASSES
    ends = np.flatnonzero(flat == END)
    return place * SYMBOLS + flat, np.concatenate([[0], ends[:-1] + 1])


CELLS = SYMBOLS * CLASSES * FAR_CLASSES * SYMBOLS


class Spelling:
    """Byte restaurants of all depths; ``log`` is the natural log of the deepest predictive probabilities."""

    def __init__(self):
        self.shapes = [(1, SYMBOLS), (SYMBOLS, SYMBOLS), (SYMBOLS * CLASSES, SYMBOLS), (SYMBOLS * CLASSES * FAR_CLASSES, SYMBOLS)]
        self.prob = [np.full(s, 1 / SYMBOLS, np.float32) for s in self.shapes]
        self.tables = [np.zeros(s, np.int64) for s in self.shapes]

    @staticmethod
    def _parent(depth: int, size: int) -> np.ndarray:
        own = np.arange(size)
        return own // FAR_CLASSES if depth == 3 else own // CLASSES if depth == 2 else np.zeros(size, np.int64)

    def sweep(self, cells: np.ndarray, counts: np.ndarray, rng) -> None:
        """Seats the symbols of all tables' dishes, deepest contexts first, then renews the probabilities."""
        customers = np.zeros(CELLS, np.int64)
        customers[cells] = counts
        customers = customers.reshape(self.shapes[3])
        held = [None] * 4
        for depth in (3, 2, 1, 0):
            held[depth] = customers
            r, b = np.nonzero(customers)
            parent = self._parent(depth, self.shapes[depth][0])
            base = self.prob[depth - 1][parent[r], b] if depth else np.full(len(r), 1 / SYMBOLS)
            weight = BYTE_STRENGTH[depth] + BYTE_DISCOUNT[depth] * self.tables[depth].sum(axis=1)[r]
            tables = np.zeros(self.shapes[depth], np.int64)
            tables[r, b] = seat(customers[r, b], weight * base, BYTE_DISCOUNT[depth], rng)
            self.tables[depth] = tables
            if depth:
                customers = np.zeros(self.shapes[depth - 1], np.int64)
                np.add.at(customers, (parent[r], b), tables[r, b])
        for depth in range(4):
            c, t, d, s = held[depth], self.tables[depth], BYTE_DISCOUNT[depth], BYTE_STRENGTH[depth]
            above = self.prob[depth - 1][self._parent(depth, self.shapes[depth][0])] if depth else np.float32(1 / SYMBOLS)
            whole = c.sum(axis=1, keepdims=True) + s
            self.prob[depth] = ((c - d * t) / whole + (s + d * t.sum(axis=1, keepdims=True)) / whole * above).astype(np.float32)

    @property
    def log(self) -> np.ndarray:
        return np.log(self.prob[3]).ravel()


def distinct_rows(log: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of ``Spelling.log`` and each context's row: contexts without customers share their
    parent's. It is sent so, as every executor keeps a broadcast's copy on its disk."""
    rows, at = np.unique(log.reshape(-1, SYMBOLS), axis=0, return_inverse=True)
    return rows, at.ravel().astype(np.int32)


def spelt(words: list[bytes], log: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Natural log of the base probability of every word, by the ``distinct_rows``."""
    if not words:
        return np.empty(0)
    cells, first = _spelling(words)
    rows, at = log
    return np.add.reduceat(rows[at[cells // SYMBOLS], cells % SYMBOLS].astype(np.float64), first)


# -- texts ----------------------------------------------------------------------------------

def packed(**columns: np.ndarray) -> bytes:
    """Arrays as compressed bytes: whole numbers (0 and up) in their narrowest type, byte planes apart."""
    out = []
    for name, x in columns.items():
        if x.dtype.kind in "iub" and x.dtype != np.int64:
            x = x.astype(np.int64)
        if x.dtype == np.int64 and name != "words":  # hashes use all bits
            x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
        planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes()
        out.append((name, x.dtype.str, len(planes), pa.compress(planes, "zstd", asbytes=True) if planes else b""))
    return pickle.dumps(out)


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    out = {}
    for name, kind, size, planes in pickle.loads(data):
        kind = np.dtype(kind)
        raw = np.frombuffer(pa.decompress(planes, size, "zstd", asbytes=True) if size else b"", np.uint8)
        x = np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).ravel()
        out[name] = x.astype(np.int64) if kind.kind == "u" else x
    return out


class _Codes(dict):
    """Numbers of words in the order they are met; the end token is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def blocks_of(docs: DataFrame) -> DataFrame:
    """block, ids, data: runs of about FLUSH_TOKENS tokens of the table, each with its own numbering of words (by falling frequency)."""
    kind = docs.schema["doc_id"].dataType
    ids_type = pa.list_(to_arrow_type(kind))

    def run(batches):
        def out():
            at = np.frombuffer(flat, np.uint32).astype(np.int64)
            rank = np.argsort(-np.bincount(at, minlength=len(codes)), kind="stable")
            place = np.empty(len(rank), np.int64)
            place[rank] = np.arange(len(rank))
            words = list(codes)
            spelling = np.frombuffer(b"\n".join([words[i] for i in rank]), np.uint8)
            data = packed(spelling=spelling, tokens=place[at], sizes=np.array(sizes, np.int64), learnt=np.concatenate(learnt).astype(np.int64))
            number = (TaskContext.get().partitionId() << 32) + done
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.ListArray.from_arrays(
                pa.array([0, len(sizes)], pa.int32()), pa.chunked_array(ids, ids_type.value_type).combine_chunks()).cast(ids_type),
                pa.array([data], pa.large_binary()).cast(pa.binary())], names=["block", "ids", "data"])

        def new():
            return _Codes({b"": 0}), array("I"), [], [], []

        done = 0
        codes, flat, sizes, learnt, ids = new()
        for batch in batches:
            texts, since = batch.column(1).cast(pa.large_binary()).to_pylist(), 0
            flags = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for i, data in enumerate(texts):
                own = words_of(data or b"")
                flat.extend(map(codes.__getitem__, own))
                flat.append(0)
                sizes.append(len(own) + 1)
                if len(flat) >= FLUSH_TOKENS or i + 1 == len(texts):
                    ids.append(batch.column(0).slice(since, i + 1 - since))
                    learnt.append(flags[since:i + 1])
                    since = i + 1
                if len(flat) >= FLUSH_TOKENS:
                    yield out()
                    done += 1
                    codes, flat, sizes, learnt, ids = new()
        if sizes:
            yield out()

    return docs.select("doc_id", "text", (fold_of(F.col("doc_id"), FOLDS) != HELD_OUT).alias("learnt")).mapInArrow(
        run, f"block long, ids array<{kind.simpleString()}>, data binary")


@dataclass
class Texts:
    """A block taken apart: its words and their hashes, the texts' tokens (numbers of words; ends too), sizes and whether they are learnt."""

    words: list[bytes]
    hashes: np.ndarray
    tokens: np.ndarray
    sizes: np.ndarray
    learnt: np.ndarray

    @classmethod
    def read(cls, data: bytes) -> Texts:
        x = unpacked(data)
        words = x["spelling"].astype(np.uint8).tobytes().split(b"\n")
        return cls(words, _hashed(words), x["tokens"].astype(np.int32), x["sizes"], x["learnt"].astype(bool))  # a block has few words

    def grams(self) -> list[np.ndarray]:
        """The token two before, the one before, and itself; a text is preceded by ends."""
        end, first = self.words.index(b""), np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        before = np.concatenate([self.tokens[-1:], self.tokens[:-1]])  # the last text ended with an end
        second = np.concatenate([before[:1], before[:-1]])
        second[first] = end
        return [second, before, self.tokens]


def _hashed(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _joint(columns: list[np.ndarray], size: int, bits: int) -> tuple[np.ndarray, int]:
    """One number for every row of the columns, all below ``size``, in the rows' order, and what all numbers are below:
    of that many bits, if ranks of the first columns allow it."""
    key, top = columns[0].astype(np.int64), size
    for more in columns[1:]:
        if top * size >= 1 << bits:
            order, new = _ranked(key, top)
            key[order] = np.cumsum(new) - 1
            top = int(new.sum()) or 1
        key *= size
        key += more
        top *= size
    return key, top


def _ranked(key: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts numbers below ``top``, and where a new one begins in it."""
    shift = len(key).bit_length()
    if top <= 1 << 62 - shift:  # a number and its place are one: values sort several times faster than places
        key = key << shift
        key |= np.arange(len(key))
        key.sort()
        order = key & ((1 << shift) - 1)
        key >>= shift
    else:
        order = np.argsort(key)
        key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return order, new


def _distinct(columns: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts the rows, the places in it where a distinct row begins, and each sorted row's number."""
    order, new = _ranked(*_joint(columns, size, 62 - len(columns[0]).bit_length()))
    number = np.cumsum(new)
    number -= 1
    return order, np.flatnonzero(new), number


@dataclass
class Parts:
    """Where n-grams are kept: by the word they share (the one before the last), which frequent words split by the other word."""

    n: int = 1
    words: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # frequent words' hashes, sorted
    ways: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # parts each is split into

    def of(self, hashes: np.ndarray, shared: np.ndarray, other: np.ndarray) -> np.ndarray:
        own, n = hashes.view(np.uint64), np.uint64(self.n)
        part = (mix64(own) % n).astype(np.int64)[shared]
        if len(self.words):
            at, there = _found(self.words, hashes)
            ways = np.where(there, self.ways[at], 1)
            split = np.flatnonzero(ways[shared] > 1)
            shared = shared[split]
            turn = mix64(own)[other[split]] % ways.astype(np.uint64)[shared]
            part[split] = (mix64(own[shared] + turn * np.uint64(0x9E3779B97F4A7C15)) % n).astype(np.int64)
        return part


def _places(parts: int, part: np.ndarray):
    """Each part that occurs, and the places of its rows in their order."""
    order = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")
    ends = np.cumsum(np.bincount(part, minlength=parts))
    for i in np.flatnonzero(np.diff(ends, prepend=0)):
        yield int(i), order[ends[i - 1] if i else 0:ends[i]]


def _dealt(parts: int, part: np.ndarray, hashes: np.ndarray, names: list[str], columns: list[np.ndarray], **values):
    """(part, packed rows) of each part: the rows in their order, words numbered anew within it."""
    for i, at in _places(parts, part):
        own = [c[at] for c in columns]
        used = np.zeros(len(hashes), bool)
        for c in own:
            used[c] = True
        number = np.cumsum(used) - 1
        own = [number[c] for c in own]
        own[0] = np.diff(own[0], prepend=0)  # rows are sorted by it
        yield i, packed(words=hashes[used], **dict(zip(names, own)), **{n: v[at] for n, v in values.items()})


def _rows(data: bytes) -> dict[str, np.ndarray]:
    """What ``_dealt`` packed."""
    x = unpacked(data)
    first = "v2" if "v2" in x else "v1"
    x[first] = _summed(x[first])
    return x


def _summed(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.int64)


def _merged(rows: list[dict[str, np.ndarray]], names: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct words (by falling frequency) of several packed lists of rows, and the lists' columns in their numbers."""
    words, at = np.unique(np.concatenate([x["words"] for x in rows]), return_inverse=True)
    start = np.cumsum([0, *(len(x["words"]) for x in rows)])
    columns = [np.concatenate([at[s + x[n]] for s, x in zip(start, rows)]) for n in names]
    rank = np.argsort(-sum(np.bincount(c, minlength=len(words)) for c in columns), kind="stable")
    place = np.empty(len(rank), np.int64)
    place[rank] = np.arange(len(rank))
    place = place.astype(np.int32)
    return words[rank], [place[c] for c in columns]


# -- training -------------------------------------------------------------------------------

def word_counts(blocks: DataFrame) -> DataFrame:
    """word, w (its hash), c: training tokens by word (the end token is the empty word)."""

    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                x = Texts.read(data)
                n = np.bincount(x.tokens[np.repeat(x.learnt, x.sizes)], minlength=len(x.words))
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({"word": pa.array([x.words[i] for i in at], pa.binary()), "w": pa.array(x.hashes[at]),
                                                  "c": pa.array(n[at], pa.int64())})

    return blocks.select("data").mapInArrow(run, "word binary, w long, c long").groupBy("word", "w").agg(F.sum("c").alias("c"))


#: A packed table or message: the part it is for, the part it comes from, dishes with one and with two customers.
PACKED = "part int, src long, kind string, one long, two long, data binary"
ARROW = pa.schema([("part", pa.int32()), ("src", pa.int64()), ("kind", pa.string()), ("one", pa.int64()), ("two", pa.int64()), ("data", pa.binary())])


def _message(part: int, src: int, kind: str, data: bytes, one: int = 0, two: int = 0) -> dict:
    return {"part": part, "src": src, "kind": kind, "one": one, "two": two, "data": data}


def _sent(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, ARROW)


def _by_kind(table: pa.Table) -> dict[str, list[dict]]:
    """The messages of each kind, by the part they come from; their data stays where Arrow has it."""
    got = defaultdict(list)
    for src, kind, data in sorted(zip(table.column("src").to_pylist(), table.column("kind").to_pylist(), table.column("data")), key=lambda r: r[0]):
        got[kind].append({"src": src, "data": data.as_buffer()})
    return got


def gram_counts(blocks: DataFrame, parts: Parts) -> DataFrame:
    """Training tokens (c) by word and the two before it, packed for the parts of the contexts."""

    def run(batches):
        for batch in batches:
            for number, data in zip(*(c.to_pylist() for c in batch.columns)):
                x = Texts.read(data)
                live = np.repeat(x.learnt, x.sizes)
                grams = [g[live] for g in x.grams()]
                order, first, _ = _distinct(grams, len(x.words))
                rows = [g[order[first]] for g in grams]
                c = np.diff(np.append(first, len(order)))
                for part, own in _dealt(parts.n, parts.of(x.hashes, rows[1], rows[0]), x.hashes, NAMES, rows, c=c):
                    yield pa.RecordBatch.from_pylist([_message(part, number, "grams", own)], ARROW)

    return blocks.select("block", "data").mapInArrow(run, PACKED)


NAMES = ["v2", "v1", "w"]


def _grams(table: pa.Table, parts: Parts) -> pa.Table:
    """Trigrams of a part (kind grams), what sweeps need of them (core), and their pairs, packed for the parts of the pairs."""
    part = table.column("part")[0].as_py()
    rows = [_rows(r["data"]) for r in _by_kind(table)["grams"]]
    words, columns = _merged(rows, NAMES)
    c = np.concatenate([x["c"] for x in rows])
    del rows
    order, first, _ = _distinct(columns, len(words))
    c = np.add.reduceat(c[order], first)
    first = order[first]
    v2, v1, w = (x[first] for x in columns)
    del columns, order, first
    many = c > 1
    out = [_message(part, part, "grams", packed(words=words, v2=np.diff(v2, prepend=0), v1=v1, w=w, c=c), int((c == 1).sum()), int((c == 2).sum()))]
    # Pairs, by part and then by word: those with a trigram that is seated anew are numbered so on both sides.
    order, first, number = _distinct([v1, w], len(words))
    pair = np.empty(len(order), np.int64)
    pair[order] = number
    one, two = v1[order[first]], w[order[first]]
    dishes, moving = np.bincount(pair), np.bincount(pair[many], minlength=len(first))
    to = parts.of(words, one, two)
    for at, own in _dealt(parts.n, to, words, NAMES[1:], [one, two], dishes=dishes, moving=moving):
        out.append(_message(at, part, "pairs", own))
    turn = np.argsort(to, kind="stable")
    turn = turn[moving[turn] > 0]
    place = np.zeros(len(to), np.int64)
    place[turn] = np.arange(len(turn))
    _, begin, room = _distinct([v2, v1], len(words))  # sorted as they are
    alone = np.bincount(room[~many], minlength=len(begin))
    rooms, room = np.unique(room[many], return_inverse=True)
    out.append(_message(part, part, "core", packed(room=room, alone=alone[rooms], pair=place[pair[many]], c=c[many],
                                                   t=np.ones(many.sum(), np.int64), to=np.bincount(to[turn], minlength=parts.n))))
    return _sent(out)


def _pairs(table: pa.Table) -> pa.Table:
    """Bigrams of a part that have one customer whatever the seating (kind pairs), the others (live) and the words' sums."""
    part = table.column("part")[0].as_py()
    got = _by_kind(table)["pairs"]
    rows = [_rows(r["data"]) for r in got]
    words, columns = _merged(rows, NAMES[1:])
    order, first, number = _distinct(columns, len(words))
    own = np.empty(len(order), np.int64)
    own[order] = number
    dishes, moving = (np.concatenate([x[n] for x in rows]) for n in ("dishes", "moving"))
    c, still = np.bincount(own, dishes).astype(np.int64), np.bincount(own, dishes - moving).astype(np.int64)
    v1, w = (x[order[first]] for x in columns)
    live = (c > 1) | (c > still)
    one, two = int((c == 1).sum()), int((c == 2).sum())
    at = np.cumsum(live) - 1
    sources = np.concatenate([np.full(int((x["moving"] > 0).sum()), r["src"]) for r, x in zip(got, rows)])
    moves = at[own[moving > 0]]
    out = [_message(part, part, "pairs", packed(words=words, v1=np.diff(v1[~live], prepend=0), w=w[~live]), one, two)]
    # The live ones have words of their own numbering.
    used = np.zeros(len(words), bool)
    used[v1[live]] = used[w[live]] = True
    place = np.cumsum(used) - 1
    state = {"words": words[used], "v1": place[v1[live]], "w": place[w[live]], "still": still[live], "c": c[live],
             "t": np.ones(live.sum(), np.int64), "moves": moves, "sources": sources}
    out.append(_message(part, part, "live", packed(**state)))
    return _sent(out)


@dataclass
class Model:
    """What scoring needs besides the words' own table."""

    tokens: int  # training tokens (N)
    types: int  # distinct ones (V)
    outside: list[float] = field(default_factory=lambda: [1.0 for _ in KEPT])  # probability of all words without customers, by kept sweep
    discounts: dict[int, float] = field(default_factory=dict)  # of the context restaurants, by order
    fresh: list[float] = field(default_factory=lambda: [1.0 for _ in KEPT])  # new-table mass of the word restaurant, by kept sweep
    spellings: list[np.ndarray] = field(default_factory=lambda: [Spelling().log for _ in KEPT])
    parts: Parts = field(default_factory=Parts)  # where the packed n-grams are
    trigrams: DataFrame | None = None  # packed: all trigrams, and the tables of those with more than one customer
    bigrams: DataFrame | None = None  # packed: bigrams of one customer, and the others with customers and tables
    facts: DataFrame | None = None  # customers and tables of dishes and of restaurants by rows, see ``_facts``
    kept: dict[int, list] = field(default_factory=dict)  # the written tables behind n-grams of each order

    @property
    def unseen(self) -> float:
        return sum(self.outside) / len(self.outside)


def _letters(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Cells and customers of the spelling restaurants: the symbols of every table's dish."""

    def run(batches):
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            if batch.num_rows:
                own = batch.column(0).to_pylist()
                cells, first = _spelling(own)
                size = np.diff(np.append(first, len(cells)))
                total += np.bincount(cells, np.repeat(batch.column(1).to_numpy(), size), CELLS).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    # The table has a fixed number of cells, whatever the corpus.
    got = words.select("word", "t").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    return got.column("cell").to_numpy(), got.column("n").to_numpy()


def _discount(rows: DataFrame, c: str) -> float:
    """The usual estimate of a discount from dishes with one and two customers."""
    one, two = rows.agg(F.count_if(F.col(c) == 1), F.count_if(F.col(c) == 2)).first()
    return min(0.95, max(0.05, one / max(1, one + 2 * two)))


def train(docs: DataFrame, seed: int = 11) -> tuple[Model, DataFrame]:
    """The model and its words: word, w (hash), c (training tokens), q (averaged predictive probability without context), and by kept
    sweep q0 ..., rn0 ... and rt0 ... (customers and tables of the restaurant of the contexts that this word alone is)."""
    blocks = Kept(docs.sparkSession, "blocks", blocks_of(docs))
    got = _trained(blocks.all, seed)
    blocks.drop()
    return got


def _trained(blocks: DataFrame, seed: int = 11) -> tuple[Model, DataFrame]:
    spark = blocks.sparkSession
    counted = Kept(spark, "words", word_counts(blocks))
    total = counted.all.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    model = Model(total["n"] or 0, total["v"])
    if not model.tokens:
        zero = [F.lit(0.0).cast("float").alias(f"q{i}") for i in KEPT] + [F.lit(0).cast("long").alias(f"{x}{i}") for i in KEPT for x in ("rn", "rt")]
        return model, counted.all.select("word", "w", "c", F.lit(0.0).alias("q"), *zero)
    # Words with a quarter of a part's tokens are few.
    often = counted.all.where(F.col("c") > PART_TOKENS // 4).select("w", "c").orderBy("w").toArrow()
    model.parts = parts = Parts(model.tokens // PART_TOKENS + 1, often.column("w").to_numpy(), often.column("c").to_numpy() // (PART_TOKENS // 4) + 1)
    grams = Kept(spark, "grams", gram_counts(blocks, parts).groupBy("part").applyInArrow(lambda t: _grams(t, parts), PACKED), "kind")
    pairs = Kept(spark, "pairs", grams["pairs"].groupBy("part").applyInArrow(_pairs, PACKED), "kind")
    grams.drop("pairs")
    core, live, last = grams["core"], pairs["live"], [(grams, "core"), (pairs, "live")]
    model.discounts = {ORDER: _estimate(grams["grams"]), 2: _estimate(pairs["pairs"])}
    rest = pairs["pairs"].select("data").mapInArrow(_rest_rows, "w long, rest long, r long").groupBy("w").agg(F.sum("rest").alias("rest"), F.sum("r").alias("r"))
    words = Kept(spark, "words-first", _summed_up(counted.all.join(rest, "w"), live).withColumn("t", F.lit(1).cast("long")))
    counted.drop()
    before, words = words, words.all
    discount = _discount(words, "n")
    spelling, rng = Spelling(), np.random.default_rng(seed)
    letters = _letters(words)  # one table for each distinct word at first
    for _ in range(2):
        spelling.sweep(*letters, rng)
    whole = words.agg(F.sum("n")).first()[0]
    words, tables = words.withColumn("p", F.col("n") / F.lit(whole)), model.types
    model.fresh, model.outside, model.spellings = [], [], []
    for sweep in range(SWEEPS):
        keep = [sweep - BURN_IN] if sweep >= BURN_IN else []
        core, live, last = _reseated(core, live, last, words, model.discounts, sweep, keep)
        log = spark.sparkContext.broadcast(distinct_rows(spelling.log))
        rows = _summed_up(words.drop("n", "rc", "rt", "t", "s", "p"), live)
        for i in keep:
            rows = rows.withColumns({f"rn{i}": F.col("rc"), f"rt{i}": F.col("rt")})
        whole = words.agg(F.sum("rest")).first()[0] + (live.agg(F.sum("two")).first()[0] or 0) + WORD_STRENGTH
        seated = Kept(spark, f"words-{sweep}", _seated(rows, log, WORD_STRENGTH + discount * tables, discount, sweep))
        log.destroy()  # the words are written
        before.drop()
        before, words = seated, seated.all
        tables, known = words.agg(F.sum("t"), F.sum("s")).first()
        fresh = (WORD_STRENGTH + discount * tables) / whole
        words = words.withColumn("p", (F.col("n") - discount * F.col("t")) / whole + fresh * F.col("s"))
        for i in keep:
            words = words.withColumn(f"q{i}", F.col("p"))
            model.fresh.append(fresh)
            model.outside.append(fresh * max(1 - known, 1e-12))
            model.spellings.append(spelling.log)
        if sweep + 1 < SWEEPS:
            spelling.sweep(*_letters(words), rng)
    # Single precision is plenty for a probability, and every block is sent it.
    each = [F.col(f"q{i}").cast("float").alias(f"q{i}") for i in KEPT]
    mean = reduce(lambda x, y: x + y, [F.col(f"q{i}") for i in KEPT]) / len(KEPT)
    done = Kept(spark, "model-words", words.select("word", "w", "c", mean.cast("float").alias("q"), *each, *[f"{x}{i}" for i in KEPT for x in ("rn", "rt")]))
    before.drop()
    model.trigrams, model.bigrams = grams["grams"].unionByName(core), pairs["pairs"].unionByName(live)
    model.kept = {ORDER: [(grams, "grams"), last[0]], 2: [(pairs, "pairs"), last[1]], 1: [(done, None)]}
    model.facts = _facts(model, done.all)
    return model, done.all


def _estimate(packs: DataFrame) -> float:
    one, two = packs.agg(F.sum("one"), F.sum("two")).first()
    return min(0.95, max(0.05, one / max(1, one + 2 * two)))


def _rest_rows(batches):
    for batch in batches:
        for data in batch.column(0).to_pylist():
            x = _rows(data)
            sums = [np.bincount(x[of], minlength=len(x["words"])) for of in ("w", "v1")]
            yield pa.RecordBatch.from_arrays([pa.array(x["words"]), *map(pa.array, sums)], names=["w", "rest", "r"])


def _live_rows(batches):
    for batch in batches:
        for data in batch.column(0).to_pylist():
            x = unpacked(data)
            sums = [np.bincount(x[of], x[what], len(x["words"])).astype(np.int64) for of, what in (("w", "t"), ("v1", "c"), ("v1", "t"))]
            yield pa.RecordBatch.from_arrays([pa.array(x["words"]), *map(pa.array, sums)], names=["w", "ln", "lc", "lt"])


def _summed_up(words: DataFrame, live: DataFrame) -> DataFrame:
    """``words`` (rest, r: what bigrams of one customer give) with n, the word's customers, and rc and rt, its restaurant's customers and tables."""
    sums = live.select("data").mapInArrow(_live_rows, "w long, ln long, lc long, lt long").groupBy("w").agg(*[F.sum(x).alias(x) for x in ("ln", "lc", "lt")])
    none = F.lit(0).cast("long")
    return words.join(sums, "w", "left").withColumns({
        "n": F.col("rest") + F.coalesce("ln", none), "rc": F.col("r") + F.coalesce("lc", none), "rt": F.col("r") + F.coalesce("lt", none)}).drop("ln", "lc", "lt")


def _reseated(core, live, last, words: DataFrame, discounts: dict[int, float], sweep: int, keep: list[int]):
    """Seats all context restaurants' customers anew, the longest contexts first, given the last sweep's parents.

    The parts of the bigrams send the trigrams' parts their parents' probabilities and get the tables there, in a fixed order."""
    spark = core.sparkSession

    def asked(batches):
        for batch in batches:
            for part, data in zip(*(c.to_pylist() for c in batch.columns)):
                ws = unpacked(data)["words"]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ws), part, np.int32)), pa.array(np.arange(len(ws))), pa.array(ws)], names=["part", "i", "w"])

    def weighed(known: pa.Table, own: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _sent([])
        part, x = own.column("part")[0].as_py(), unpacked(own.column("data")[0].as_py())
        p, rc, rt = np.zeros((3, len(x["words"])))
        at = known.column("i").to_numpy()
        p[at], rc[at], rt[at] = (known.column(n).to_numpy() for n in ("p", "rc", "rt"))
        d = discounts[2]
        x["fresh"] = (CONTEXT_STRENGTH + d * rt[x["v1"]]) * p[x["w"]]
        chance = ((x["c"] - d * x["t"] + x["fresh"]) / (rc[x["v1"]] + CONTEXT_STRENGTH)).astype(np.float32)
        x["fresh"] = x["fresh"].astype(np.float32)
        return _sent([_message(part, part, "live", packed(**x)), *(
            _message(int(to), part, "chances", packed(p=chance[x["moves"][x["sources"] == to]])) for to in np.unique(x["sources"]))])

    def seated(table: pa.Table) -> pa.Table:
        part, got = table.column("part")[0].as_py(), _by_kind(table)
        x, d = unpacked(got["core"][0]["data"]), discounts[ORDER]
        above = np.concatenate([np.empty(0, np.float32), *(unpacked(r["data"])["p"] for r in got["chances"])]).astype(np.float64)
        tables = x["alone"] + np.bincount(x["room"], x["t"], len(x["alone"]))
        fresh = (CONTEXT_STRENGTH + d * tables[x["room"]]) * above[x["pair"]]
        x["t"] = seat(x["c"], fresh, d, np.random.default_rng(xxhash.xxh3_64_intdigest(x["c"].tobytes(), sweep)))
        for i in keep:
            x[f"t{i}"] = x["t"]
        sums, ends = np.bincount(x["pair"], x["t"], len(above)).astype(np.int64), np.cumsum(x["to"])
        return _sent([_message(part, part, "core", packed(**x)), *(
            _message(int(to), part, "tables", packed(t=sums[ends[to] - x["to"][to]:ends[to]])) for to in np.flatnonzero(x["to"]))])

    def settled(table: pa.Table) -> pa.Table:
        part, got = table.column("part")[0].as_py(), _by_kind(table)
        x = unpacked(got["live"][0]["data"])
        tables = np.concatenate([np.empty(0, np.int64), *(unpacked(r["data"])["t"] for r in got["tables"])])
        x["c"] = x["still"] + np.bincount(x["moves"], tables, len(x["still"])).astype(np.int64)
        fresh = x.pop("fresh").astype(np.float64)
        x["t"] = seat(x["c"], fresh, discounts[2], np.random.default_rng(xxhash.xxh3_64_intdigest(x["c"].tobytes(), SWEEPS + sweep)))
        for i in keep:
            x[f"n{i}"], x[f"t{i}"] = x["c"], x["t"]
        return _sent([_message(part, part, "live", packed(**x), two=int(x["t"].sum()))])

    asks = live.select("part", "data").mapInArrow(asked, "part int, i long, w long").join(words.select("w", "p", "rc", "rt"), "w").drop("w")
    one = Kept(spark, f"weighed-{sweep}", asks.groupBy("part").cogroup(live.groupBy("part")).applyInArrow(weighed, PACKED), "kind")
    two = Kept(spark, f"seated-{sweep}", core.unionByName(one["chances"]).groupBy("part").applyInArrow(seated, PACKED), "kind")
    three = Kept(spark, f"settled-{sweep}", one["live"].unionByName(two["tables"]).groupBy("part").applyInArrow(settled, PACKED), "kind")
    one.drop()
    two.drop("tables")
    for kept, kind in last:
        kept.drop(kind)
    return two["core"], three["live"], [(two, "core"), (three, "live")]


#: Columns that name an n-gram or a context in the facts: n-grams have their order as their kind, their contexts its negative.
KEY = ["kind", *(f"x{i}" for i in range(ORDER))]


def _trigrams(got: dict[str, list[dict]]) -> dict[str, np.ndarray]:
    """The trigrams of a part with c and, by kept sweep, t0 ...; sorted."""
    x, core = _rows(got["grams"][0]["data"]), unpacked(got["core"][0]["data"])
    for i in KEPT:
        x[f"t{i}"] = np.ones(len(x["c"]), np.int64)
        x[f"t{i}"][x["c"] > 1] = core[f"t{i}"]
    return x


def _bigrams(got: dict[str, list[dict]]) -> dict[str, np.ndarray]:
    """The bigrams of a part with n0, t0, ... by kept sweep; sorted."""
    still, live = _rows(got["pairs"][0]["data"]), unpacked(got["live"][0]["data"])
    words, (v1, w) = _merged([still, live], NAMES[1:])
    order, _, _ = _distinct([v1, w], len(words))
    values = {f"{x}{i}": np.concatenate([np.ones(len(still["w"]), np.int64), live[f"{x}{i}"]])[order] for i in KEPT for x in "nt"}
    return {"words": words, "v1": v1[order].astype(np.int64), "w": w[order].astype(np.int64), **values}


def _starts(columns: list[np.ndarray]) -> np.ndarray:
    """Places at which sorted rows change."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _facts(model: Model, words: DataFrame) -> DataFrame:
    """KEY, n0, t0 ...: customers and tables of every dish and of every restaurant, by kept sweep."""
    values = [f"{x}{i}" for i in KEPT for x in "nt"]
    schema = ", ".join(["kind int", *(f"{x} long" for x in [*KEY[1:], *values])])

    def named(kind, hashes, columns, numbers):
        size = len(columns[0])
        xs = [hashes[c] for c in columns] + [np.zeros(size, np.int64)] * (ORDER - len(columns))
        return pa.Table.from_arrays([pa.array(np.full(size, kind, np.int32)), *map(pa.array, xs), *map(pa.array, numbers)], names=[*KEY, *values])

    def three(table: pa.Table) -> pa.Table:
        x = _trigrams(_by_kind(table))
        columns, numbers = [x[n] for n in NAMES], [x["c"] if v[0] == "n" else x[v] for v in values]
        first = _starts(columns[:2])
        return pa.concat_tables([named(3, x["words"], columns, numbers),
                                 named(-3, x["words"], [c[first] for c in columns[:2]], [np.add.reduceat(v, first) for v in numbers])])

    def two(table: pa.Table) -> pa.Table:
        x = _bigrams(_by_kind(table))
        return named(2, x["words"], [x["v1"], x["w"]], [x[v] for v in values])

    nothing = [F.lit(0).cast("long").alias(x) for x in KEY[2:]]
    rooms = words.where("rn0 > 0").select(F.lit(-2).alias("kind"), F.col("w").alias("x0"), *nothing, *[F.col(f"r{v}").alias(v) for v in values])
    return model.trigrams.groupBy("part").applyInArrow(three, schema).unionByName(
        model.bigrams.groupBy("part").applyInArrow(two, schema)).unionByName(rooms)


def _seated(words: DataFrame, log, fresh: float, discount: float, sweep: int) -> DataFrame:
    """``words`` with t (tables after a new seating of the n customers) and s (the spelling's probability)."""

    def run(batches):
        for batch in batches:
            own = batch.column("word").to_pylist()
            if not own:
                continue
            base = np.exp(spelt(own, log.value))
            # Seeded by content, so that a task run again seats alike.
            seed = xxhash.xxh3_64_intdigest(own[0] + b" " + own[-1], len(own) * SWEEPS + sweep)
            t = seat(batch.column("n").to_numpy(), fresh * base, discount, np.random.default_rng(seed))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(t, pa.int64()), pa.array(base)], names=[*names, "t", "s"])

    names = words.columns
    return words.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema) + ", t long, s double")


# -- scoring --------------------------------------------------------------------------------

def _asking(blocks: DataFrame, k: int, parts: Parts, turn: int = 0, turns: int = 1) -> DataFrame:
    """The blocks' distinct n-grams of k words (of one: words), packed for the parts that hold them; a turn asks a share of the parts."""

    def run(batches):
        for batch in batches:
            for number, data in zip(*(c.to_pylist() for c in batch.columns)):
                x = Texts.read(data)
                if k == 1:
                    out = [_message(part, number, "ask", packed(words=x.hashes[at])) for part, at in _places(parts.n, x.hashes % parts.n)]
                else:
                    grams = x.grams()[-k:]
                    if turns > 1:
                        mine = parts.of(x.hashes, *_shared(grams)) % turns == turn
                        grams = [g[mine] for g in grams]
                    rows = _asked(grams, len(x.words))[0]
                    part = parts.of(x.hashes, *_shared(rows))
                    out = [_message(at, number, "ask", own) for at, own in _dealt(parts.n, part, x.hashes, NAMES[-k:], rows)]
                yield pa.RecordBatch.from_pylist(out, ARROW)

    return blocks.select("block", "data").mapInArrow(run, PACKED)


def _shared(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The word by which an n-gram is kept, and the other one."""
    return (rows[1], rows[0]) if len(rows) == ORDER else (rows[0], rows[1])


def _told(known: pa.Table, asks: pa.Table) -> pa.Table:
    """Answers of a part's words to the blocks that ask: c (0: unknown), q0 ..., rn0, rt0 ..."""
    own, out = known.column("w").to_numpy(), []
    order = np.argsort(own)
    own = own[order]
    values = {n: known.column(n).to_numpy()[order] for n in known.column_names if n not in ("w", "part")}
    for row in asks.to_pylist():
        asked = unpacked(row["data"])["words"]
        at, there = _found(own, asked)
        none = {n: np.zeros(len(asked), v.dtype) for n, v in values.items()}
        for n, v in values.items():
            none[n][there] = v[at[there]]
        out.append(_message(row["part"], row["src"], "1", packed(**none)))
    return _sent(out)


def _asked(grams: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct n-grams, sorted, and each token's."""
    order, first, number = _distinct(grams, size)
    own = np.empty(len(order), np.int32)  # as many as a block's tokens at most
    own[order] = number
    del number
    first = order[first]
    return [g[first] for g in grams], own


def _found(own: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each asked number in the sorted ones, and whether it is there."""
    at = np.minimum(np.searchsorted(own, asked), max(len(own) - 1, 0))
    return at, own[at] == asked if len(own) else np.zeros(len(asked), bool)


def _numbers(words: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Numbers of the asked words among the words, -1 for those that are not there."""
    order = np.argsort(words)
    at, there = _found(words[order], asked)
    return np.where(there, order[at], -1) if len(words) else np.full(len(asked), -1)


def _answered(k: int):
    """Answers of a part to the blocks that ask: c, t0 ... of trigrams and of their contexts (rc, rt0 ...); n0, t0 ... of bigrams."""

    def run(table: pa.Table) -> pa.Table:
        part, got = table.column("part")[0].as_py(), _by_kind(table)
        values = ["c", *(f"t{i}" for i in KEPT)] if k == ORDER else [f"{x}{i}" for i in KEPT for x in "nt"]
        own = (_trigrams if k == ORDER else _bigrams)(got) if ("grams" if k == ORDER else "pairs") in got else None
        if own:
            size = len(own["words"])
            if k == ORDER:
                first = _starts([own["v2"], own["v1"]])
                rooms = (own["v2"] * size + own["v1"])[first]
                sums = {v: np.add.reduceat(own[v], first) for v in values}
                dishes = np.repeat(np.arange(len(first)) * size, np.diff(np.append(first, len(own["w"])))) + own["w"]
            else:
                dishes = own["v1"] * size + own["w"]
            own = {n: x for n, x in own.items() if n not in NAMES}  # the words and the values are left
        out = []
        for row in got["ask"]:
            x = _rows(row["data"])
            if not own:
                answer = {v: np.zeros(len(x["w"]), np.int64) for v in values}
                if k == ORDER:
                    answer |= {f"r{v}": np.zeros(len(_starts([x["v2"], x["v1"]])), np.int64) for v in values}
            else:
                code = _numbers(own["words"], x["words"])
                v1, w = code[x["v1"]], code[x["w"]]
                if k == ORDER:
                    v2, new = code[x["v2"]], _starts([x["v2"], x["v1"]])
                    at, there = _found(rooms, (v2 * size + v1)[new])
                    there &= (v2[new] >= 0) & (v1[new] >= 0)
                    answer = {f"r{v}": np.where(there, sums[v][at], 0) for v in values}
                    room = np.repeat(np.where(there, at, -1), np.diff(np.append(new, len(w))))
                else:
                    answer, room = {}, v1
                at, there = _found(dishes, room * size + w)
                there &= (room >= 0) & (w >= 0)
                answer |= {v: np.where(there, own[v][at], 0) for v in values}
            out.append(_message(part, row["src"], str(k), packed(**answer)))
        return _sent(out)

    return run


def _descend(p: list[np.ndarray], k: int, d: float, x: Texts, told: dict[int, bytes], by_word: dict[str, np.ndarray], parts: Parts) -> None:
    """Takes the tokens' probabilities by kept sweep from the next shorter context to that of n-grams of k words, in place.

    ``told``: the parts' answers. The restaurants' terms are computed by distinct n-gram, part by part."""
    rows, number = _asked(x.grams()[-k:], len(x.words))
    own_mass, passed = np.empty((2, len(KEPT), len(rows[0])))
    for q, own in _places(parts.n, parts.of(x.hashes, *_shared(rows))):
        theirs = unpacked(told.pop(q))
        if k == ORDER:
            sizes = np.diff(np.append(_starts([r[own] for r in rows[:2]]), len(own)))
        for i in KEPT:
            if k == ORDER:
                c, n, t = theirs["c"], *(np.repeat(theirs[v], sizes) for v in ("rc", f"rt{i}"))
            else:
                c, n, t = theirs[f"n{i}"], *(by_word[v][rows[0][own]] for v in (f"rn{i}", f"rt{i}"))
            whole = n + CONTEXT_STRENGTH
            own_mass[i, own] = (c - d * theirs[f"t{i}"]) / whole
            passed[i, own] = (CONTEXT_STRENGTH + d * t) / whole
    del rows
    for i in KEPT:
        p[i] *= passed[i][number]
        p[i] += own_mass[i][number]


def score(docs: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score, event_score of every row."""
    return _scored(Kept(docs.sparkSession, "blocks", blocks_of(docs)).all, model, words)


def _scored(blocks: DataFrame, model: Model, words: DataFrame, spend: bool = False) -> DataFrame:
    """``spend``: the model's tables go once they have answered."""
    spark = blocks.sparkSession
    spellings = spark.sparkContext.broadcast([distinct_rows(x) for x in model.spellings])
    qs, rooms = [f"q{i}" for i in KEPT], [f"{x}{i}" for i in KEPT for x in ("rn", "rt")]
    tokens, types, fresh, outside, discounts, parts = model.tokens, model.types, model.fresh, model.outside, model.discounts, model.parts
    got = []
    for k, held in ((ORDER, model.trigrams), (2, model.bigrams)):
        # By turns, since the questions take more room than the answers.
        turns = min(TURNS[k], parts.n) if held is not None else 0
        for turn in range(turns):
            both = held.where(F.col("part") % turns == turn).unionByName(_asking(blocks, k, parts, turn, turns))
            got.append(Kept(spark, f"answers-{k}", both.groupBy("part").applyInArrow(_answered(k), PACKED)).all)
        for kept, kind in model.kept.get(k, []) if spend else []:
            kept.drop(kind)
    known = words.select("w", F.pmod("w", F.lit(parts.n)).cast("int").alias("part"), "c", *qs, *rooms)
    got.append(Kept(spark, "answers-1", known.groupBy("part").cogroup(_asking(blocks, 1, parts).groupBy("part")).applyInArrow(_told, PACKED)).all)
    for kept, kind in model.kept.get(1, []) if spend else []:
        kept.drop(kind)
    answers = reduce(DataFrame.unionByName, got).select(F.col("src").alias("block"), "part", "kind", "data")

    def answer(texts: pa.Table, known: pa.Table) -> pa.Table:
        x, told = Texts.read(texts.column("data")[0].as_py()), defaultdict(dict)
        for part, kind, data in zip(known.column("part").to_pylist(), known.column("kind").to_pylist(), known.column("data")):
            told[kind][part] = data.as_buffer()  # unpacked one at a time: a block's answers are large as arrays
        by_word = {n: np.zeros(len(x.words)) for n in ["c", *qs, *rooms]}
        for q, at in _places(parts.n, x.hashes % parts.n):
            theirs = unpacked(told["1"].pop(q))
            for n, own in by_word.items():
                own[at] = theirs[n]
        c = by_word["c"]
        found = c > 0
        for i, q in enumerate(qs):
            by_word[q][~found] = outside[i]
        p = [by_word[q][x.tokens] for q in qs]
        for k in sorted(discounts):
            _descend(p, k, discounts[k], x, told.pop(str(k)), by_word, parts)
        first = np.concatenate([[0], np.cumsum(x.sizes)[:-1]])
        plain = np.add.reduceat(np.log10((c + 1) / (tokens + types + 1))[x.tokens], first)
        event = np.add.reduceat(np.log10(sum(p) / len(p)), first)
        # Logarithm of what a spelling has of the event of all unseen words; as a number, a very long word's would be nought.
        new, share = np.flatnonzero(~found), np.zeros(len(x.words))
        for i in KEPT:
            share[new] = np.log(fresh[i] / outside[i]) + spelt([x.words[j] for j in new], spellings.value[i])
            np.log(p[i], out=p[i])
            p[i] += share[x.tokens]
        mean = reduce(lambda y, z: np.logaddexp(y, z, out=y), p)
        mean -= np.log(len(KEPT))
        mean /= np.log(10)
        return pa.table({"doc_id": texts.column("ids").combine_chunks().flatten(), "n_tokens": pa.array(x.sizes, pa.int64()),
                         "n_known": pa.array(np.add.reduceat(found[x.tokens].astype(np.int64), first), pa.int64()),
                         "base_score": pa.array(plain, pa.float64()),
                         "score": pa.array(np.add.reduceat(mean, first), pa.float64()),
                         "event_score": pa.array(event, pa.float64())})

    kind = blocks.schema["ids"].dataType.elementType
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        answer, f"doc_id {kind.simpleString()}, n_tokens long, n_known long, base_score double, score double, event_score double")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, event_score."""
    blocks = Kept(docs.sparkSession, "blocks", blocks_of(docs)).all
    model, words = _trained(blocks)
    return _scored(blocks, model, words, spend=True).select(
        "doc_id", (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "event_score")
