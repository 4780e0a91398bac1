"""Licence scans by a positional index over rare licence words.

Every notice (a template's text, or one of the fixed base phrases) is indexed by the rarest word of
its mandatory key phrase: the word of the highest inverse document frequency, counted over the whole
corpus. No match goes without that word, so every place is found. Where it stands, the key phrase has
to stand word by word; then all places of the notice at which the phrase is near its own place are
verified: the share of template words in line is the coverage.

Templates and index are fixed text, so their size does not depend on the corpus; only document
frequencies of template words are counted, one number for each.

Defined cases: a null or wordless text has no match and score 0; repeated rows each get their
result; overlapping places all count; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finflow.llm.common import WORD_BYTES

# The contract's phrases and labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: label: (opening words of the public notice, its mandatory key phrase)
TEMPLATES = {
    "agpl": ("gnu affero general public license", "affero general public license"),
    "apache-2.0": ("licensed under the apache license version 2 0", "apache license"),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted",
            "source and binary forms"),
    "boost": ("boost software license version 1 0", "boost software license"),
    "cc-by-nc": ("licensed under cc by nc 4 0", "cc by nc"),
    "cc-by-sa": ("licensed under cc by sa 4 0", "cc by sa"),
    "cc0": ("to the extent possible under law the author has dedicated all copyright to the public domain cc0", "public domain"),
    "copyright": ("copyright c all rights reserved", "rights reserved"),
    "creative-commons": ("this work is licensed under a creative commons attribution license", "creative commons"),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", "gnu general public license"),
    "isc": ("permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify"),
    "lgpl": ("gnu lesser general public license", "lesser general public license"),
    "mit": ("released under the mit license", "mit license"),
    "mit-text": ("permission is hereby granted free of charge to any person obtaining a copy of this software",
                 "permission is hereby granted"),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    "unlicense": ("this is free and unencumbered software released into the public domain", "unencumbered software"),
}

#: Words by which the key phrase may be off its place, and the least coverage of a match.
SLACK, COVERAGE = 2, 0.5


def _notices() -> list[tuple[str, list[bytes], list[bytes], bool]]:
    """(label, words, key phrase, whether all words must stand)"""
    cut = lambda s: s.encode().split()
    return ([(label, cut(p), cut(p), True) for p, label in BASE.items()]
            + [(label, cut(text), cut(key), False) for label, (text, key) in TEMPLATES.items()])


def words_of(data: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and other than ASCII characters, A-Z lower-cased."""
    return data.translate(WORD_BYTES).split()


def document_frequencies(docs: DataFrame) -> dict[bytes, int]:
    """Documents that hold each word of the notices."""
    vocabulary = frozenset(w for _, words, _, _ in _notices() for w in words)

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for data in batch.column(0).cast(pa.large_binary()).to_pylist():
                seen.update(vocabulary.intersection(words_of(data or b"")))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.binary()), "docs": pa.array(list(seen.values()), pa.int64())})

    found = docs.select("text").mapInArrow(run, "word binary, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))
    return {bytes(r["word"]): r["docs"] for r in found.collect()}  # one row for each word of the notices at most


def build_index(frequencies: dict[bytes, int]) -> dict[bytes, list[tuple[int, int]]]:
    """Rarest word of a key phrase: its places (notice, position in the phrase)."""
    index: dict[bytes, list[tuple[int, int]]] = {}
    for k, (_, _, key, _) in enumerate(_notices()):
        rare = min(key, key=lambda w: (frequencies.get(w, 0), w))
        index.setdefault(rare, []).append((k, key.index(rare)))
    return index


def matches_in(words: list[bytes], index, notices) -> list[tuple[int, int, float]]:
    """(notice, first word, coverage) of every verified place."""
    out = set()
    for at, w in enumerate(words):
        for k, i in index.get(w, ()):
            _, text, key, exact = notices[k]
            j = at - i
            if j < 0 or words[j:j + len(key)] != key:
                continue
            if exact:
                out.add((k, j, 1.0))
                continue
            first = next((x for x in range(len(text)) if text[x:x + len(key)] == key), 0)
            for s in range(j - first - SLACK, j - first + SLACK + 1):
                share = sum(words[s + x] == v for x, v in enumerate(text) if 0 <= s + x < len(words)) / len(text)
                if share >= COVERAGE:
                    out.add((k, s, share))
    return sorted(out, key=lambda m: (m[1], m[0]))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and ``matches``: array of (label, base, start, words, coverage) of every row."""
    index, notices = build_index(document_frequencies(docs)), _notices()

    def run(batches):
        for batch in batches:
            counts, found = [], []
            for data in batch.column(1).cast(pa.large_binary()).to_pylist():
                words = words_of(data or b"")
                counts.append(len(words))
                found.append([{"label": notices[k][0], "base": notices[k][3], "start": s, "words": len(notices[k][1]), "coverage": c}
                              for k, s, c in matches_in(words, index, notices)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(found, kind)],
                                             names=["doc_id", "n_words", "matches"])

    kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("words", pa.int32()),
                               ("coverage", pa.float64())]))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_words long, matches array<struct<label:string,base:boolean,start:bigint,words:int,coverage:double>>")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score: the best match's coverage, less 1 / (1 + its words) of it; 0 without a match.
    """
    rows = scan(docs)
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    names = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    trust = F.transform("matches", lambda m: m["coverage"] * (1 - 1 / (1 + m["words"])))
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), names(base).alias("base_labels"), names(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(trust), F.lit(0.0)).alias("score"))
