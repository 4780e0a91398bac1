"""Registered queries over the smallest driver tables: against DuckDB where there is SQL, else brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import odd
import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck

from finflow.llm import packing, quality, queries, secrets, tokens


@pytest.fixture(scope="module")
def tables():
    con = duck(SF_SMALL)
    read = lambda q: con.execute(q).fetchall()
    return {"documents": read("SELECT doc_id, text, lang, source FROM documents"), "labels": read("SELECT doc_id, quality, toxic FROM labels"),
            "benchmark": read("SELECT item_id, text FROM benchmark")}


def run(spark, name):
    return queries.QUERIES[name](spark, SF_SMALL).collect()


def test_sql(spark):
    names = list(queries.ORACLE)
    assert set(names) == {"op3_near_duplicates", "op6_extendible_sharding", "op7_exact_top_k", "op8_decontamination", "op13_spelling_variants"}
    bad = {k: v for k, v in compare(spark, SF_SMALL, names).items() if not v.startswith("OK") or "TYPES" in v}
    assert not bad, bad


def test_op1(spark, tables):
    got = run(spark, "op1_license_scan")
    want = {r[0]: odd.license_base(r[1]) for r in tables["documents"]}
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == want


def places(rows, length):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= length
    return len(bins)


def pieces(rows, length):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.vocabulary())
    out = Counter()
    for doc_id, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), length)):
            out[doc_id, k, at, len(ids[at:at + length]), zlib.crc32(ids[at:at + length].tobytes())] += 1
    return out


def test_op2(spark, tables):
    got = run(spark, "op2_best_fit_packing")
    want = pieces([(r[0], r[1]) for r in tables["documents"]], packing.LENGTH)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert places(got, packing.LENGTH) <= -(-sum(r.length for r in got) // packing.LENGTH) + 1


def test_op4(spark, tables):
    got = run(spark, "op4_secret_scan")
    want = {r[0]: odd.secret_spans(r[1]) for r in tables["documents"]}
    assert len(got) == len(want)
    for r in got:
        spans = want[r.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert r.base_sha256 == odd.span_digest(spans)
        names = [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans]
        assert [x for x in r.spans.split(",") if x and not x.startswith("markov")] == names


def test_op5(spark, tables):
    got = {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in run(spark, "op5_token_rollup")}
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.vocabulary())
    toxic = {r[0]: r[2] for r in tables["labels"]}
    want = defaultdict(lambda: [0, 0])
    for doc_id, text, lang, source in tables["documents"]:
        if toxic.get(doc_id) == 1:
            continue
        source = "labelled" if doc_id in toxic else source
        for version, n in (("words", len((text or "").encode().split())), ("word_bpe_49k", len(t.encode(text or "", add_special_tokens=False).ids))):
            want[source, lang, version][0] += 1
            want[source, lang, version][1] += n
    assert got == {k: tuple(v) for k, v in want.items()}


def test_op9(spark, tables):
    rows, n = odd.unigram(tables["documents"])
    got = {r.doc_id: r for r in run(spark, "op9_language_model")}
    for doc_id, n_tokens, n_known, base in rows:
        r = got[doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n_tokens, n_known, n, odd.fold(doc_id, 7) == 2)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score < 0
    held = [r for r in got.values() if r.held_out]
    # The base counts an unseen word as one event: a lower perplexity than it, counted alike. The text's own probability is smaller.
    assert sum(r.event_score for r in held) > sum(r.base_score for r in held)
    assert all(r.score <= r.event_score + 1e-6 for r in got.values())


def test_op10(spark, tables):
    got = {r.doc_id: r for r in run(spark, "op10_quality_classifier")}
    assert len(got) == len(tables["documents"])
    assert all(r.held_out == (odd.fold(i, 4) == 2) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for i, r in got.items())
    held = [(got[i].predicted, q) for i, q, _ in tables["labels"] if got[i].held_out]
    assert np.mean([p == q for p, q in held]) >= 0.85


def test_pipeline(spark, tables):
    """Every stage by brute force on its predecessor's rows (models are the operators' own)."""
    import corpus_pipeline
    docs = spark.createDataFrame([(*r, len(r[1])) for r in tables["documents"]], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame(tables["labels"], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = tables["documents"]
    rows = [r for r in rows if model.score(np.array([quality.features_of((r[1] or "").encode())]))[0] >= quality.THRESHOLD]
    found = odd.near_duplicates(rows, 5, 80)
    rows = [r for r, (i, n, c) in zip(rows, found) if not n or i == c]
    rows = [r for r, w in zip(rows, odd.decontaminated(rows, tables["benchmark"])) if not w[4]]
    left = spark.createDataFrame([(*r, len(r[1])) for r in rows], docs.schema)
    done = {r.doc_id: r.text for r in secrets.redact(left).collect()}
    assert set(done) == {r[0] for r in rows}
    for doc_id, text, *_ in rows:
        if odd.secret_spans(text):
            assert "[SECRET]" in done[doc_id] and not odd.secret_spans(done[doc_id].replace("[SECRET]", ""))
        elif done[doc_id] != text:
            assert "[SECRET]" in done[doc_id]
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in got} == set(done)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces(done.items(), packing.LENGTH)
    places(got, packing.LENGTH)


def test_stages_keep_the_columns():
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "decontamination", "secret_scan", "best_fit_packing"]
