"""Token ids of whole texts by a public tokenizer file, inside tasks.

The tokenizer's rules never reach across ASCII white space, so a text's ids are those of its
space-separated chunks in order; chunks are remembered per Python worker (a bounded number), and
only new ones go through the tokenizer, letters-only words many at a time.
"""

from __future__ import annotations

import gc
import unicodedata

import numpy as np

WORD_BPE = "word_bpe_49k.json"


#: Chunks a Python worker remembers (about 200 bytes each) before it starts anew.
CHUNKS = 800_000


def vocabulary(name: str = WORD_BPE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(path: str) -> Encoder:
    """This process's encoder of a vocabulary: later tasks of a worker find it loaded and its memory filled."""
    import tokenizers
    held = tokenizers.__dict__.setdefault("_held_encoders", {})  # the library outlives a task, pickled code does not
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


class Encoder:
    """``many(texts)``: little-endian unsigned 32-bit ids of UTF-8 texts, as bytes."""

    #: Marks that form a piece of their own after a Latin letter.
    MARKS = b".,!*#$%&|;:?"
    #: UTF-8 of the accented Latin letters (all letters of two bytes up to U+024F).
    ACCENTED = frozenset(chr(k).encode() for k in range(0xC0, 0x250) if chr(k).isalpha())
    #: Words tokenized together; a word's end shows in the vocabulary's end-of-word pieces.
    TOGETHER = 400

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit
        self.tokenizer = Tokenizer.from_file(path)
        # Letters in the form that the tokenizer's normalizer gives need no more than cutting at blanks.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.memo: dict[bytes, bytes] = {}

    def _alone(self, chunks: list[bytes]) -> None:
        coded = self.tokenizer.encode_batch_fast([c.decode("utf-8") for c in chunks], add_special_tokens=False)
        self.memo.update((c, np.asarray(e.ids, "<u4").tobytes()) for c, e in zip(chunks, coded))

    def _together(self, words: list[bytes]) -> None:
        """Words of letters only: each is one piece, so its last id is an end-of-word one."""
        groups = [words[i:i + self.TOGETHER] for i in range(0, len(words), self.TOGETHER)]
        coded = self.letters.encode_batch_fast([b" ".join(g).decode("utf-8") for g in groups], add_special_tokens=False)
        for group, e in zip(groups, coded):
            ids = np.asarray(e.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(group):  # the vocabulary sees other word ends than the letters do
                self._alone(group)
                continue
            flat, start = ids.tobytes(), 0
            for word, stop in zip(group, (4 * stops).tolist()):
                self.memo[word] = flat[start:stop]
                start = stop

    def _learn(self, chunks: set[bytes]) -> None:
        memo = self.memo
        words, others, joined = set(), set(), []

        def add(part: bytes) -> None:
            text = part.decode("utf-8")
            # Lower-case composed letters are what the normalizer makes of them.
            plain = text.isalpha() and text.lower() == text and unicodedata.is_normalized("NFC", text)
            (words if plain else others).add(part)

        for c in chunks:
            if c.isalpha() and c.islower():  # ASCII letters
                words.add(c)
                continue
            core = c.rstrip(self.MARKS)
            last = core[-1:] if core[-1:].isascii() else core[-2:]
            if len(core) == len(c) or not (last.isalpha() or last in self.ACCENTED):
                add(c)
                continue
            marks = c[len(core):]
            joined.append((c, core, marks))
            if core not in memo:
                words.add(core) if core.isalpha() and core.islower() else add(core)
            if marks not in memo:
                others.add(marks)
        self._together(list(words))
        self._alone(list(others))
        for c, core, marks in joined:
            memo[c] = memo[core] + memo[marks]

    def many(self, texts: list[bytes]) -> list[bytes]:
        if len(self.memo) > CHUNKS:
            self.memo.clear()
        # The tokenizer lower-cases; doing it before merges chunks, but must not make a special token of another text.
        chunks = [(t if b"<|" in t else t.lower()).split() for t in texts]
        memo = self.memo
        gc.disable()  # millions of flat objects, none in a cycle
        try:
            new: set[bytes] = set()
            for own in chunks:
                new.update(set(own).difference(memo))
            if new:
                self._learn(new)
            return [b"".join(map(memo.__getitem__, own)) for own in chunks]
        finally:
            gc.enable()


def slices(texts: list[bytes], most: int = 4 << 20):
    """Runs of texts of about ``most`` bytes together."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run
