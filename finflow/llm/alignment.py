"""Cross-tokenizer alignment: which ids of two tokenizers cover the same bytes of a text.

Both tokenizers' cumulative byte ends become end-to-index dictionaries; the intersection of their
key sets, sorted, slices both id lists into groups, and the links of a slice are all its pairs.
A text is cut before every blank or line feed that follows a non-blank and before some marks that
follow a letter: neither tokenizer has an entry reaching over such a place (checked when the
vocabularies are loaded, else texts stay whole), so both end there and a piece's groups are
remembered per worker, for a bounded number of pieces.

Counting goes in blocks of about ``BLOCK`` bytes of text: a block holds its documents' links as
numbers into the block's distinct id pairs, and only those pairs are counted, looked up and sent
back, never the links themselves. A document lies in one block, so a pair's count of documents is
the sum over blocks.

Defined cases: a null or empty text, one that is not UTF-8, and one whose tokens do not give its
bytes back have no tokens (zeros, empty digest); every row is a document of its own, repeated and
null ids included; an empty table gives an empty result; further columns of ``docs`` are not read.
"""

from __future__ import annotations

import gc
import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from finflow.llm.common import written
from finflow.llm.tokens import slices, vocabulary

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text in a block, and pieces of text a worker remembers.
BLOCK, PIECES, PIECE_BYTES = 16 << 20, 500_000, 64 << 20
#: Links of a piece listed one by one; a longer piece's are counted by distinct pair.
LISTED = 4096
#: New pieces that are tokenized as one text.
TOGETHER = 400

#: Marks before which a text is cut when a letter precedes, if the second vocabulary allows.
MARKS = ",.;!?"


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others as letters from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def listed(entries: dict[int, bytes]) -> tuple[list[bytes], np.ndarray]:
    """Bytes and their number by id; ids without bytes spell nothing."""
    spelt = [entries.get(i, b"") for i in range(max(entries) + 2)]
    return spelt, np.array([len(x) for x in spelt], np.int64)


def coded(side, pieces: list[str], data: list[bytes], together: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces in one array and how many each has (-1: they do not spell the piece), so many pieces
    at a time as one text: a piece ends where the next one's blank or line feed begins."""
    runs = ["".join(pieces[k:k + together]) for k in range(0, len(pieces), together)]
    lists = side.many(runs)
    ids = np.fromiter(itertools.chain.from_iterable(lists), np.int64)
    if b"".join(map(side.bytes.__getitem__, ids.tolist())) == b"".join(data):
        ends, want = np.cumsum(side.width[ids]), np.cumsum([len(x) for x in data])
        at = np.searchsorted(ends, want)
        if (ends[at] == want).all():
            return ids, np.diff(at + 1, prepend=0)
    if together > 1:
        return coded(side, pieces, data, 1)
    good = [b"".join(map(side.bytes.__getitem__, own)) == x for own, x in zip(lists, data)]
    ids = np.fromiter(itertools.chain.from_iterable(itertools.compress(lists, good)), np.int64)
    return ids, np.array([len(own) if ok else -1 for own, ok in zip(lists, good)], np.int64)


class ByteLevel:
    """Ids of texts by a byte-level BPE file, special tokens' strings being plain text."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        entries = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes, self.width = listed({i: bytes(letters[c] for c in token) for token, i in entries.items()})

    def many(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Ids by a sentencepiece file that puts a blank before a text of its own."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = m = SentencePieceProcessor(model_file=path)
        plain = [i for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))]
        entries = {i: m.id_to_piece(i).replace("▁", " ").encode() for i in plain}
        self.parts = not any(" " in b.decode().lstrip(" ") or b"\n" in b for b in entries.values())
        spelt = "\n".join(b.decode() for b in entries.values())
        #: Marks that no entry has behind a letter.
        self.marks = [m for m in MARKS if not re.search(rf"[^\W\d_]{re.escape(m)}", spelt)]
        entries |= {i: bytes([int(m.id_to_piece(i)[3:5], 16)]) for i in range(m.get_piece_size()) if m.is_byte(i)}
        self.bytes, self.width = listed(entries)
        self.blank, self.letter = m.piece_to_id("▁"), m.encode("x")

    def many(self, texts: list[str]) -> list[list[int]]:
        """``texts`` begin with the blank that the model adds, or (pieces of a text) with a line feed or a mark."""
        lead = {" ": "", "\n": ""}
        coded = self.model.encode([lead.get(t[0], "x") + t.removeprefix(" ") for t in texts], num_threads=1)
        # Before a line feed the model's own blank stands alone, before a mark a letter does; of a blank alone it makes nothing.
        return [(ids or [self.blank]) if t[0] == " " else ids[1 if t[0] == "\n" else len(self.letter):] for t, ids in zip(texts, coded)]


def groups_of(a_width: np.ndarray, b_width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups stop on either side: each byte offset at which an id ends on both."""
    left, right = (dict(zip(np.cumsum(w).tolist(), range(1, len(w) + 1))) for w in (a_width, b_width))
    common = sorted(left.keys() & right.keys())
    return tuple(np.fromiter(map(side.__getitem__, common), np.int64, len(common)) for side in (left, right))


def cross(a: np.ndarray, b: np.ndarray, a_stop: np.ndarray, b_stop: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Links (a << 32 | b) of the chosen groups, group after group."""
    x, y = np.diff(a_stop, prepend=0), np.diff(b_stop, prepend=0)
    n = np.where(few, x * y, 0)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    y_of = np.repeat(y, n)
    return (a[np.repeat(a_stop - x, n) + k // np.maximum(y_of, 1)] << 32) | b[np.repeat(b_stop - y, n) + k % np.maximum(y_of, 1)]


def counted(a: np.ndarray, b: np.ndarray, a_stop: np.ndarray, b_stop: np.ndarray, own: slice) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of the groups ``own`` and how many links each has, without listing the links."""
    pairs, counts = [], []
    for g in range(own.start, own.stop):
        i, n = np.unique(a[a_stop[g - 1] if g else 0:a_stop[g]], return_counts=True)
        j, m = np.unique(b[b_stop[g - 1] if g else 0:b_stop[g]], return_counts=True)
        pairs.append(((i[:, None] << 32) | j).ravel())
        counts.append((n[:, None] * m).ravel())
    return tally(np.concatenate(pairs), np.concatenate(counts))


def tally(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, at = np.unique(pairs, return_inverse=True)
    out = np.zeros(len(own), np.int64)
    np.add.at(out, at, counts)
    return own, out


def digits(a: np.ndarray, b: np.ndarray, a_stop: np.ndarray, b_stop: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;`` of all groups in one text, and where each group's part ends."""
    x, y = np.diff(a_stop, prepend=0), np.diff(b_stop, prepend=0)
    upto = np.cumsum(x + y)
    marks = np.full(len(a) + len(b), ord(","), np.uint8)
    marks[upto - y - 1], marks[upto - 1] = ord("|"), ord(";")
    ids = np.empty(len(marks), np.int64)
    left = np.repeat(np.arange(len(x)), x)  # group of each id of either side
    right = np.repeat(np.arange(len(y)), y)
    ids[np.arange(len(a)) + (b_stop - y)[left]] = a
    ids[np.arange(len(b)) + a_stop[right]] = b
    width = np.searchsorted(10 ** np.arange(1, 19), ids, side="right") + 1
    end = np.cumsum(width + 1)
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    out[end - 1] = marks
    for k in range(int(width.max(initial=0))):
        here = width > k
        out[end[here] - 2 - k] = ids[here] // 10 ** k % 10 + ord("0")
    return out.tobytes(), end[upto - 1] if len(end) else np.empty(0, np.int64)


class Aligner:
    """Groups and links of texts; what it learnt of a piece of text is kept for later texts."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteLevel(byte_path), Pieces(piece_path)
        # The byte-level pattern parts words before blanks, and letters from marks, whatever its vocabulary.
        self.parts = self.b.parts
        marks = "".join(map(re.escape, self.b.marks))
        self.cut = re.compile(r"(?<=\S)(?=[ \n])" + (rf"|(?<=[^\W\d_])(?=[{marks}])" if marks else ""))
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.sizes = np.zeros((1 << 12, 3), np.int64)  # tokens of either side, groups; -1: bytes differ
        self.digests: list[bytes] = []
        self.links: list[bytes] = []
        self.counted: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # pieces of many links
        self.held = 0

    def learn(self, pieces: list[str], together: int) -> None:
        data = [p.encode() for p in pieces]
        (a, n_a), (b, n_b) = (coded(side, pieces, data, together) for side in (self.a, self.b))
        differ = np.flatnonzero((n_a < 0) | (n_b < 0))
        if len(differ):  # such a piece has no tokens on either side
            a, b = (x[np.repeat(~np.isin(np.arange(len(n)), differ), np.maximum(n, 0))] for x, n in ((a, n_a), (b, n_b)))
            n_a[differ] = n_b[differ] = 0
        a_stop, b_stop = groups_of(self.a.width[a], self.b.width[b])
        last = np.searchsorted(a_stop, np.cumsum(n_a), side="right")  # groups up to a piece's end
        n_groups = np.diff(last, prepend=0)
        text, upto = digits(a, b, a_stop, b_stop)
        digest_at = np.concatenate([[0], upto])[np.concatenate([[0], last])].tolist()
        x, y = np.diff(a_stop, prepend=0), np.diff(b_stop, prepend=0)
        n_links = np.concatenate([[0], np.cumsum(x * y)])[np.concatenate([[0], last])]
        many = np.flatnonzero(np.diff(n_links) > LISTED)
        few = np.ones(len(x), bool)
        for k in many.tolist():
            few[last[k] - n_groups[k]:last[k]] = False
        pairs = cross(a, b, a_stop, b_stop, few)
        link_at = (8 * np.concatenate([[0], np.cumsum(np.where(few, x * y, 0))])[np.concatenate([[0], last])]).tolist()
        first = len(self.digests)
        self.digests += [text[s:max(s, e - 1)] for s, e in zip(digest_at, digest_at[1:])]
        flat = pairs.tobytes()
        self.links += [flat[s:e] for s, e in zip(link_at, link_at[1:])]
        for k in many.tolist():
            own = slice(last[k] - n_groups[k], last[k])
            self.counted[first + k] = counted(a, b, a_stop, b_stop, own)
        while len(self.sizes) < first + len(pieces):
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        self.sizes[first:first + len(pieces)] = np.stack([n_a, n_b, n_groups], axis=1)
        self.sizes[first + differ, 0] = -1
        self.number.update(zip(pieces, range(first, first + len(pieces))))
        self.held += sum(map(len, pieces))

    def many(self, texts: list[bytes | None]):
        """(tokens of A, of B, groups, digest, distinct pairs, links of each) of every text."""
        for own in slices([t or b"" for t in texts]):
            if len(self.number) > PIECES or self.held > PIECE_BYTES:
                self.forget()
            gc.disable()  # millions of flat objects, none in a cycle
            try:
                cut = [self._cut(t) for t in own]
                new = set(itertools.chain.from_iterable(cut)).difference(self.number)
                # A piece that ends in a blank (a text's last one) or begins with a mark could melt into another.
                alone = [p for p in new if p[0] not in " \n" or p[-1].isspace()] if self.parts else sorted(new)
                for some, together in ((sorted(new.difference(alone)), TOGETHER), (alone, 1)):
                    if some:
                        self.learn(some, together)
                out = [self._one(list(map(self.number.__getitem__, pieces))) for pieces in cut]
            finally:
                gc.enable()
            yield from out

    def _cut(self, text: bytes) -> list[str]:
        try:
            s = " " + text.decode() if text else ""
        except UnicodeDecodeError:
            s = ""
        return self.cut.split(s) if s and self.parts else [s] if s else []

    def _one(self, at: list[int]):
        sizes = self.sizes[at] if at else np.zeros((1, 3), np.int64) - 1
        if sizes[:, 0].min() < 0:
            return 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64)
        n_a, n_b, n_groups = sizes.sum(0).tolist()
        pairs, counts = np.unique(np.frombuffer(b"".join([self.links[k] for k in at]), np.int64), return_counts=True)
        many = [self.counted[k] for k in at if k in self.counted] if self.counted else []
        if many:
            pairs, counts = tally(np.concatenate([pairs, *(p for p, _ in many)]), np.concatenate([counts, *(c for _, c in many)]))
        digest = hashlib.sha256(b";".join([self.digests[k] for k in at])).hexdigest()
        return n_a, n_b, n_groups, digest, pairs, counts


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """This process's aligner: later tasks of a worker find it loaded and its memory filled."""
    import tokenizers
    held = tokenizers.__dict__.setdefault("_held_aligners", {})  # the library outlives a task, pickled code does not
    key = byte_path, piece_path
    if key not in held:
        held[key] = Aligner(byte_path, piece_path)
    return held[key]


def _packed(x: np.ndarray) -> bytes:
    """32-bit numbers, all their first bytes, all their second ones and so on: small numbers compress well so."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def blocks(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Rows of documents (``pair`` null) and rows of a block's distinct pairs (``n``: documents that hold it)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"block long, doc_id {id_type}, n_a long, n_b long, n_groups long, groups_sha256 string, "
              "gaps binary, times binary, pair long, n long")

    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        work = aligner(byte_path, piece_path)
        block, size, ids, rows = TaskContext.get().partitionId() << 32, 0, [], []

        def flush():
            every, at, n = np.unique(np.concatenate([r[4] for r in rows]), return_inverse=True, return_counts=True)
            starts = np.cumsum([0] + [len(r[4]) for r in rows])
            gaps = [_packed(np.diff(at[s:e], prepend=0)) for s, e in zip(starts, starts[1:])]
            doc = [pa.array([block] * len(rows), pa.int64()), pa.chunked_array(ids).combine_chunks().cast(fields.field(1).type),
                   *[pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], pa.array([r[3] for r in rows], pa.string()),
                   pa.array(gaps, pa.binary()), pa.array([_packed(r[5]) for r in rows], pa.binary()),
                   pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64())]
            yield pa.RecordBatch.from_arrays(doc, schema=fields)
            for s in range(0, len(every), 50_000):
                own = every[s:s + 50_000]
                pair = [pa.array([block] * len(own), pa.int64()), *[pa.nulls(len(own), f.type) for f in list(fields)[1:8]],
                        pa.array(own), pa.array(n[s:s + 50_000])]
                yield pa.RecordBatch.from_arrays(pair, schema=fields)

        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            done = 0
            for k, row in enumerate(work.many(texts)):
                rows.append(row)
                size += len(texts[k] or b"")
                if size >= BLOCK:
                    ids.append(batch.column(0).slice(done, k + 1 - done))
                    done = k + 1
                    yield from flush()
                    block, size, ids, rows = block + 1, 0, [], []
            if done < batch.num_rows:
                ids.append(batch.column(0).slice(done))
        if rows:
            yield from flush()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def aligned(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(a row per document, a row per linked id pair).

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.
    Pairs: a, b, n (documents that hold the pair linked), best (none of a's pairs is in more).
    """
    held = written(blocks(docs, byte_path or vocabulary(BYTE_BPE), piece_path or vocabulary(PIECE_BPE)), "align-blocks")
    pairs = held.where("pair is not null").select("block", "pair", "n")
    total = pairs.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("pair", 32))
    # At most one row for each entry of the first vocabulary.
    top = total.groupBy("a").agg(F.max("n").alias("top"))
    total = written(total.join(F.broadcast(top), "a").select("pair", "a", "n", (F.col("n") == F.col("top")).alias("best")), "align-pairs")
    answers = pairs.select(F.col("block").alias("asked_by"), "pair").join(total.select("pair", "n", "best"), "pair")
    rows = held.where("pair is null").drop("pair", "n")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
              "groups_sha256 string")

    def look_up(own: pa.Table, found: pa.Table) -> pa.Table:
        found = found.sort_by("pair")
        n, best = found.column("n").to_numpy(), found.column("best").to_numpy()
        sums = []
        for gaps, times in zip(own.column("gaps").to_pylist(), own.column("times").to_pylist()):
            at, k = np.cumsum(_unpacked(gaps)), _unpacked(times)
            sums.append((k.sum(), k[best[at].astype(bool)].sum(), (k * n[at]).sum()) if len(at) else (0, 0, 0))
        sums = np.array(sums, np.int64).reshape(-1, 3)
        return pa.table([*[own.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")], *[pa.array(c) for c in sums.T],
                         own.column("groups_sha256")],
                        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    out = rows.groupBy("block").cogroup(answers.groupBy("asked_by")).applyInArrow(look_up, schema)
    return out, total.select("a", F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "n", "best")


def report(docs: DataFrame) -> DataFrame:
    return aligned(docs)[0]
