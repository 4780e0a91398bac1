"""Cross-tokenizer alignment, toxicity and spelling variants: brute force, awkward rows, empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import odd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from finflow.llm import alignment, queries, toxicity, variants
from finflow.llm.common import table

ROWS = odd.documents() + [
    (301, "▁ a blank of the second vocabulary", "en", "s", 1, "k", 7), (302, "tail blank ", "en", "s", 1, "k", 7),
    (303, "  two  blanks\n\nand\r\nlines\tof, text;x !y", "en", "s", 1, "k", 7), (304, "<s> <unk> <0x41> <|endoftext|>", "en", "s", 1, "k", 7),
    (305, "汉字 にほん 한글 😀😀 é ﬁ ½,² x y z", "en", "s", 1, "k", 7), (306, "a,.;!?b", "en", "s", 1, "k", 7),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, odd.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], odd.SCHEMA)


# --- alignment -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def coders():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path(alignment.BYTE_BPE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path(alignment.PIECE_BPE))
    letters = alignment.byte_letters()
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return a, b, a_bytes, b_bytes


def groups_by_hand(text, coders):
    """Both sides' ids of every group of a whole text, None without tokens."""
    a, b, a_bytes, b_bytes = coders
    if not text:
        return None
    sides = [[(i, a_bytes[i]) for i in a.encode(" " + text, add_special_tokens=False).ids], [(i, b_bytes(i)) for i in b.encode(text)]]
    if any(b"".join(x for _, x in s) != (" " + text).encode() for s in sides):
        return None
    ends = [np.cumsum([len(x) for _, x in s]).tolist() for s in sides]
    common = sorted(set(ends[0]) & set(ends[1]))
    return [tuple([i for (i, _), e in zip(s, own) if lo < e <= hi] for s, own in zip(sides, ends)) for lo, hi in zip([0, *common], common)]


def alignment_by_hand(texts, coders):
    groups = [groups_by_hand(t, coders) for t in texts]
    links = [[(x, y) for p, q in g or [] for x in p for y in q] for g in groups]
    count = Counter(p for own in links for p in set(own))
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for g, own in zip(groups, links):
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g or [])
        out.append((sum(len(p) for p, _ in g or []), sum(len(q) for _, q in g or []), len(g or []), len(own),
                    sum(count[p] == top[p[0]] for p in own), sum(count[p] for p in own), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out, count, top


def aligned_rows(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


@pytest.mark.parametrize("setting", [{}, {"BLOCK": 2000, "PIECES": 20, "TOGETHER": 3, "LISTED": 2}])
def test_alignment(docs, coders, monkeypatch, setting):
    """Also in blocks of a few documents, with a small memory, and with links counted instead of listed."""
    for name, value in setting.items():
        monkeypatch.setattr(alignment, name, value)
    want, count, top = alignment_by_hand([r[1] for r in ROWS], coders)
    rows, pairs = alignment.aligned(docs)
    assert aligned_rows(rows) == Counter((r[0], *w) for r, w in zip(ROWS, want))
    assert {(r.a, r.b): (r.n, r.best) for r in pairs.collect()} == {p: (n, n == top[p[0]]) for p, n in count.items()}


def test_alignment_query(spark, coders):
    held = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    want, *_ = alignment_by_hand([r.text for r in held], coders)
    got = aligned_rows(queries.QUERIES["op11_tokenizer_alignment"](spark, SF_SMALL))
    assert got == Counter((r.doc_id, *w) for r, w in zip(held, want))


def test_alignment_of_bytes_that_are_no_text(spark):
    bad = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text UNION ALL SELECT 2L, 'ab'")
    got = {r.doc_id: r for r in alignment.report(bad).collect()}
    assert (got[1].n_a, got[1].n_links, got[1].groups_sha256) == (0, 0, "") and got[2].n_a > 0


def test_groups_use_common_ends_only():
    a_stop, b_stop = alignment.groups_of(np.array([1, 2, 3]), np.array([3, 1, 2]))
    assert (a_stop.tolist(), b_stop.tolist()) == ([2, 3], [1, 3])


# --- spelling variants ---------------------------------------------------------------


def variants_by_hand(rows, min_count=5, times=5, every=199):
    n = Counter()
    for r in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            w = w.translate(odd.LOWER)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{w}".encode())
            n[w[:h % len(w)] + w[h % len(w) + 1:] if h % every == 0 else w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= min_count}
    cuts = {}
    for w in n:
        for i in range(len(w)):
            cuts.setdefault((w[:i], w[i + 1:], i), set()).add(w)
    near = {w: set() for w in n}
    for (head, tail, _), own in cuts.items():
        for w in own:
            near[w] |= own - {w}
            if head + tail in n:
                near[w].add(head + tail)
                near[head + tail].add(w)
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda o: (-n[o], o), default=None)
        if best is not None and n[best] >= times * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), k, len(near[w]), n[form[w]] if w in form else None) for w, k in n.items()}


@pytest.fixture(scope="module")
def misspelt(spark):
    """Words of very different frequency, edits of them and edits of edits; accents, capitals, repeated letters."""
    rng = random.Random(8)
    base = ["".join(rng.choice("abeéßz") for _ in range(rng.randint(6, 11))) for _ in range(30)] + ["aaaaaa", "aaaaaaa", "zzzzzzzz", "x" * 60]
    words, weights = [], []
    for w in base:
        chain = [(w, 400)]
        for _ in range(4):
            x, k = rng.choice(chain)
            i = rng.randrange(len(x))
            chain.append((rng.choice([x[:i] + x[i + 1:], x[:i] + rng.choice("abeéÿ") + x[i:], x[:i] + rng.choice("abeéÿ") + x[i + 1:]]), max(2, k // rng.choice([4, 6]))))
        words += [x.upper() if rng.random() < .1 else x for x, _ in chain]
        weights += [k for _, k in chain]
    rows = [(k, " ".join(rng.choices(words, weights, k=60)) + ", don't×stop÷now", "en", "s", 1, "k", 7) for k in range(150)]
    rows += [(None, rows[0][1], None, None, None, None, None), (5, None, "en", "s", 1, "k", 7), rows[3], rows[3]]
    return rows, spark.createDataFrame(rows, odd.SCHEMA).repartition(4)


@pytest.mark.parametrize("setting", [{}, {"HELD": 5, "EDITS": 2000, "LONGEST": 8, "FILTER_BYTES": 512}])
def test_variants(misspelt, monkeypatch, setting):
    """Also with tiny buffers and with filters so small that they let nearly everything through."""
    for name, value in setting.items():
        monkeypatch.setattr(variants, name, value)
    rows, docs = misspelt
    if "FILTER_BYTES" in setting:
        monkeypatch.setattr(variants.filters, "__defaults__", (variants.BITS, variants.FILTER_BYTES))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.variants(docs, delete_every=7).collect()}
    want = variants_by_hand(rows, every=7)
    assert got == want and any(w[0] and w[1] != w[0] for w in want.values())


def test_edits_are_all_words_one_edit_away():
    word, alphabet = "banana", np.array([ord(c) for c in "abnz"], np.uint8)
    letters = variants._letters([word])
    got = set()
    for length, h, w, p, c in variants._edits(letters, alphabet):
        for x, at, new in zip(h.tolist(), p.tolist(), c.tolist()):
            other = word[:at] + (chr(new) if new else "") + word[at + 1:]
            assert len(other) == length
            assert x == int((variants._letters([other]).astype(np.uint64) * variants._powers(length)).sum(dtype=np.uint64))
            got.add(other)
    want = {word[:i] + word[i + 1:] for i in range(6)} | {word[:i] + c + word[i + 1:] for i in range(6) for c in "abnz" if c > word[i]}
    assert got == want


# --- toxicity ------------------------------------------------------------------------


def toxic_table(spark, n=900, seed=2):
    rng = random.Random(seed)
    plain = ["".join(rng.choice(["an", "the", "ir", "lo", "me", "ta", "ré", "sch"]) for _ in range(rng.randint(1, 4))) for _ in range(900)]
    bad = ["grumph", "skelwort", "blurgan", "vraknid"]
    rows, labels = [], []
    for k in range(n):
        words = rng.choices(plain, k=rng.randint(20, 120))
        toxic = int(rng.random() < .25)
        for _ in range(toxic * rng.randint(2, 5)):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((k, " ".join(words), "en", "s", 1, "k", 7))
        labels.append((k, 1, toxic))
    return (spark.createDataFrame(rows, odd.SCHEMA).withColumn("toxicity", F.lit("mine")).repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((a, c) for a, _, c in labels))


def test_toxicity_finds_planted_words(spark):
    docs, labels, truth = toxic_table(spark)
    got = toxicity.report(docs, labels).collect()
    assert got and all(r.held_out == (odd.fold(r.doc_id, 4) == 2) and r.predicted == int(r.score >= .3) and 0 <= r.score <= 1 for r in got)
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out]
    assert np.mean([p for p, y in held if y]) >= .95 and np.mean([p for p, y in held if not y]) <= .03


def test_toxicity_learns_from_the_training_folds_alone(spark):
    """Labels of the held-out fold do not matter; nor do the columns besides the text."""
    docs, labels, _ = toxic_table(spark, 400)
    other = labels.withColumn("toxic", F.when(toxicity.fold_of(F.col("doc_id"), 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = toxicity.report(docs, labels).collect()
    b = toxicity.report(docs.withColumn("lang", F.lit("zz")).repartition(2), other).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_toxicity_cases(spark, docs, none):
    _, labels, _ = toxic_table(spark, 300)
    train, *_ = toxic_table(spark, 300)
    model = toxicity.train(train, labels)
    got = toxicity.scored(docs.withColumnRenamed("key", "Toxicity"), model)
    assert got.columns == [*docs.columns[:5], "Toxicity", "spans", "toxicity_"]
    rows = got.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.toxicity_ <= 1 for r in rows)
    assert len({r.toxicity_ for r in rows if not r.text}) == 1
    no_labels = spark.createDataFrame([(1, 1, None), (None, 1, 1)], labels.schema)
    assert {r.score for r in toxicity.report(docs, no_labels).collect()} == {0.0}
    assert {r.score for r in toxicity.report(docs, labels.withColumn("toxic", F.lit(0))).collect()} == {0.0}
    assert toxicity.report(none, labels).count() == 0


def test_a_window_is_measured_against_both_dictionaries():
    rng = random.Random(1)
    ordinary = [(0, k, "\n".join("".join(rng.choice(["an", "ther", "ir", "lo"]) for _ in range(3)) for _ in range(60))) for k in range(200)]
    toxic = [(1, 1000 + k, "grumphwort\nthero") for k in range(50)]
    gains = toxicity.Model(*toxicity.dictionaries(ordinary + toxic)).gains()
    assert gains["grumphwort"] >= 5 and gains["anlother"] == 0 and gains["unrelated"] == 0


def test_empty_tables(none):
    assert alignment.report(none).count() == 0
    assert variants.report(none).count() == 0
