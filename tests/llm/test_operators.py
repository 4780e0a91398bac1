"""Every operator against brute force on awkward documents, and on empty tables."""

import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from finflow.llm import decontam, licenses, lm, near_dup, packing, quality, rollup, secrets, sharding, tokens, topk
from finflow.llm.common import table
from finflow.session import scratch_path

ROWS = odd.documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, odd.SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(odd.ITEMS, "item_id long, text string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], odd.SCHEMA)


def bag(rows):
    return Counter(map(repr, rows))


def same_rows(a, b):
    assert not bag(a) - bag(b) and not bag(b) - bag(a), (list((bag(a) - bag(b)))[:3], list((bag(b) - bag(a)))[:3])


@pytest.mark.parametrize("size,percent", [(2, 80), (5, 80)])
def test_near_duplicates(docs, size, percent):
    got = near_dup.near_duplicates(docs, size, percent).collect()
    same_rows([(r.doc_id, r.n_shingles, r.component_id) for r in got], odd.near_duplicates(ROWS, size, percent))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_one_of_each(docs):
    kept = near_dup.one_of_each(docs)
    assert kept.columns == docs.columns
    want = odd.near_duplicates(ROWS, 5, 80)
    groups = {(r[2] if n else r[1:2] + r[:1]) for r, (_, n, _) in zip(((x[0], x[1], w[2]) for x, w in zip(ROWS, want)), want)}
    got = kept.collect()
    assert len(got) == len(groups)
    assert len({repr(tuple(r)) for r in got}) == len(got)


def test_one_id_on_many_rows(spark):
    """Null ids and one id on a third of all rows: every row meets the classes of its own text only, and links as by brute force."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(120)]
    texts += [t.replace(t.split()[5], "edit", 1) for t in texts[:60]]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else 1000 + i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_dup.near_duplicates(frame).collect()
    same_rows([(r.doc_id, r.n_shingles, r.component_id) for r in got], odd.near_duplicates(rows, 5, 80))
    signed = near_dup.sign(frame, 5)
    wanted = signed.select("class_id", F.col("doc_id").alias("rep"), F.col("text_key").alias("rep_key"))
    assert near_dup._sets(frame, wanted, 5).count() == len(set(texts))


@pytest.mark.parametrize("name", ["score", "spans", "text_key", "key_of", "_id", "_key", "SPANS"])
def test_clashing_names(spark, name):
    """A column of a name that an operator uses inside comes through untouched."""
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame(odd.ITEMS, "item_id long, text string")
    rows = [(1, "token = abcdefgh12345 é", "mine"), (2, "plain words", None), (3, odd.ITEMS[0][1], "bad")]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {name} string")
    read = lambda df: sorted((r[0], r[2]) for r in df.collect())
    every = [(1, "mine"), (2, None), (3, "bad")]
    for done, want in ((quality.accepted(docs, labels.limit(0)), every), (near_dup.one_of_each(docs), every),
                       (decontam.clean(docs, items), every[:2]), (secrets.redact(docs), every)):
        assert done.columns == docs.columns and read(done) == want


def test_clean_filters_a_written_verdict(docs, items):
    """No filter takes texts apart: the verdicts are read back before they are filtered."""
    plan = decontam.clean(docs, items)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_near_duplicates_crowd(spark, monkeypatch):
    """A hub with many edits of it, regions split deeper and blocks of a few classes: no link is lost."""
    import random
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(150):
        w = list(base)
        for _ in range(rng.choice((2, 5, 9, 14))):
            w[rng.randrange(len(w))] = f"e{k}_{rng.randrange(1000)}"
        rows.append((k, " ".join(w)))
    monkeypatch.setattr(near_dup, "BLOCK", 20)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    same_rows([(r.doc_id, r.n_shingles, r.component_id) for r in got], odd.near_duplicates(rows, 2, 80))


def test_components(spark):
    """A long path, a star and a loop."""
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (200, 202), (203, 203)]
    frame = spark.createDataFrame([(f"{a:05d}".encode(), f"{b:05d}".encode()) for a, b in edges], "a binary, b binary")
    got = {bytes(r.node).decode(): bytes(r.root).decode() for r in near_dup.components(frame).collect()}
    assert got == {f"{x:05d}": f"{(0 if x <= 60 else 100 if x < 200 else 200):05d}" for e in edges[:-1] for x in e}


def test_decontamination(docs, items):
    got = decontam.contamination(docs, items).collect()
    same_rows([(r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in got], odd.decontaminated(ROWS, odd.ITEMS))
    kept = decontam.clean(docs, items)
    assert kept.columns == docs.columns
    same_rows([tuple(r) for r in kept.collect()], [r for r, w in zip(ROWS, odd.decontaminated(ROWS, odd.ITEMS)) if not w[4]])


def test_decontamination_stays_native(docs, items):
    plan = decontam.contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(k in plan for k in ("Python", "Pandas", "Arrow"))


def test_secrets(docs):
    got = secrets.report(docs).collect()
    want = [(r[0], odd.secret_spans(r[1])) for r in ROWS]
    same_rows([(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got],
              [(i, *(sum(s[1] == k for s in spans) for k in range(3)), odd.span_digest(spans)) for i, spans in want])
    plan = secrets.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(k in plan for k in ("Python", "Pandas", "Arrow"))


def test_secrets_learnt(spark):
    """Random strings that no base detector knows are found, long ordinary words are not."""
    rng = np.random.default_rng(1)
    random = ["".join(rng.choice(list(secrets.ALPHABET[:62]), 40)) for _ in range(60)]
    words = ["".join(rng.choice(["ing", "tion", "the", "er", "an", "hou", "ble", "con"], 8)) for _ in range(400)]
    rows = [(i, f"token = {r} then {' '.join(words[i:i + 8])}") for i, r in enumerate(random)]
    model = secrets.train(spark.createDataFrame(rows, "doc_id long, text string"))
    fresh = ["".join(rng.choice(list(secrets.ALPHABET[:62]), 32)) for _ in range(50)]
    plain = ["".join(rng.choice(["ing", "tion", "the", "er", "an", "hou", "ble", "con"], 7)) for _ in range(50)]
    texts = [(i, f"é {t} end") for i, t in enumerate(fresh + plain)]
    got = {r.doc_id: r.spans for r in secrets.scan(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    hits = [any(s["kind"] == 3 for s in got[i]) for i in range(100)]
    assert sum(hits[:50]) >= 48 and sum(hits[50:]) <= 2
    assert all(texts[i][1][s["start"]:s["end"]] in fresh for i in range(50) for s in got[i] if s["kind"] == 3)


def test_secrets_alphabets(spark):
    """As trained on a registered table: random strings of every alphabet are found, alone and behind names and paths."""
    import string

    rng = np.random.default_rng(4)
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = secrets.train(docs)
    kinds = {"base62": string.ascii_letters + string.digits, "base36": string.ascii_lowercase + string.digits,
             "base32": string.ascii_uppercase + "234567", "base64": string.ascii_letters + string.digits + "+/", "hex": "0123456789abcdef"}
    before = ("", "deployment_access_key=", "/services/incoming/webhooks/", "configuration-of-the-service/authentication=")
    cases = [(a, b, n) for a in kinds for b in before for n in (20, 32)]
    texts = [f"{b}{''.join(rng.choice(list(kinds[a]), n))}" for a, b, n in cases for _ in range(10)]
    ids = [r.w for r in docs.select(F.explode(F.regexp_extract_all("text", F.lit(r"\b[a-z]{8,12}\b"), F.lit(0))).alias("w"))
           .distinct().orderBy(F.xxhash64("w")).limit(4000).collect()]
    plain = [j.join(rng.choice(ids, 3)) for j in "/_-=" for _ in range(50)]
    rows = spark.createDataFrame([(i, f"x {t} y") for i, t in enumerate(texts + plain)], "doc_id long, text string")
    hit = {r.doc_id: any(s["kind"] >= 2 for s in r.spans) for r in secrets.scan(rows, model).collect()}
    print(sum(hit[i] for i in range(len(texts))), len(texts), sum(hit[len(texts) + i] for i in range(len(plain))), len(plain))
    for j, case in enumerate(cases):
        assert sum(hit[10 * j + i] for i in range(10)) >= 8, case
    assert sum(hit[i] for i in range(len(texts))) >= 0.97 * len(texts)
    assert sum(hit[len(texts) + i] for i in range(len(plain))) <= 0.02 * len(plain)


def test_redact(docs):
    done = secrets.redact(docs)
    assert done.columns == docs.columns
    model = secrets.train(docs)
    spans = {(r.doc_id, r.text): [(s["start"], s["end"]) for s in r.s] for r in secrets.scan(docs, model, name="s").collect()}

    def cut(text, own):
        out, at = "", 0
        for s, e in own:
            if s > at or not out:
                out += text[at:s] + "[SECRET]"
            at = max(at, e)
        return out + text[at:] if own else text

    want = [(r[0], cut(r[1], spans[r[0], r[1]])) for r in ROWS]
    same_rows([(r.doc_id, r.text) for r in done.collect()], want)
    assert all(r.n_chars == len(r.text) for r in done.where("n_chars IS NOT NULL AND text IS NOT NULL").collect())


def test_packing(docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.vocabulary())
    want = Counter()
    for r in ROWS:
        ids = np.array(t.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), 64)):
            want[r[0], k, at, len(ids[at:at + 64]), zlib.crc32(ids[at:at + 64].tobytes())] += 1
    got = packing.packed(docs, length=64).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    check_places(got, 64)
    assert len({r.sequence_id for r in got}) <= 1.01 * -(-sum(r.length for r in got) // 64)


def check_places(got, length):
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length


def test_packing_levels(spark, monkeypatch):
    """Several blocks, opened and packed again; hard lengths; copies."""
    monkeypatch.setattr(packing, "BLOCK", 60)
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(["a"] * int(n))) for i, n in enumerate(rng.integers(20, 70, 500))]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), length=128).collect()
    check_places(got, 128)
    assert len(got) == 500
    bound = -(-sum(r.length for r in got) // 128)
    assert len({r.sequence_id for r in got}) <= 1.08 * bound


def test_packer_improves_on_best_fit():
    """Triplets that best fit cannot place perfectly: evolution needs no more bins than it."""
    rng = np.random.default_rng(4)
    sizes = []
    for _ in range(60):
        a, b = rng.integers(30, 40, 2)
        sizes += [a, b, 100 - a - b]
    packer = packing.Packer(np.array(sizes), 100, 1)
    first = packer.new(0.0)
    people = packer.evolve([first], 0, 400)
    assert packer.fitness(people[0]) > packer.fitness(first) or packer.done(first)
    fill = np.bincount(people[0], sizes)
    assert fill.max() <= 100 and (people[0] >= 0).all()


def test_quality(spark, none):
    rng = np.random.default_rng(6)
    good = lambda: " ".join(rng.choice(["the", "river", "runs", "slowly", "past", "houses."], 60))
    junk = lambda: " ".join(w + "***" for w in rng.choice(["buy", "now", "cheap"], 60))
    rows = [(i, good() if i % 4 else junk()) for i in range(600)] + [(900, None), (901, ""), (None, "text"), (5, good())]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(600)] + [(1, 1, 0), (None, 1, 0), (7, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.report(frame, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert all(r.held_out == (odd.fold(r.doc_id, 4) == 2) for r in got)
    assert np.mean([r.predicted == int(r.doc_id % 4 > 0) for r in held]) > 0.97
    assert {r.predicted for r in quality.report(frame, labels.limit(0)).collect()} == {1}
    assert quality.accepted(frame.withColumn("score", F.lit("x")), labels).columns == ["doc_id", "text", "score"]
    assert quality.report(none, labels).count() == 0


def test_quality_pairs():
    """An effect that no single feature shows is learnt by the pair tables."""
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.9


def test_licenses(docs):
    got = licenses.report(docs).collect()
    same_rows([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got],
              [(r[0], *odd.license_base(r[1])) for r in ROWS])
    by = {r.doc_id: r for r in got}
    label = {t: i for i, t, *_ in ROWS}
    assert "mit" in by[label["Released under the MIT License."]].labels.split(",")
    assert "cc-by-nc" in by[label["Licensed under CC BY-NC 4.0."]].labels.split(",")
    assert by[label["word"]].score == 0 and all(0 <= r.score <= 1 for r in got)
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in got if r.base_labels)


def test_licences_every_place(spark):
    """All places with the key phrase and the coverage, as by brute force, whatever words the corpus lacks or abounds in."""
    rng, notices = np.random.default_rng(2), licenses._notices()
    some = sorted({w.decode() for _, ws, _, _ in notices for w in ws}) + ["mit", "x", "y"]
    texts = ["The MIT License (MIT)", "x all rights reserved", "mit mit released license under"] + ["mit released", "the license"] * 20
    for _ in range(300):
        ws = [w.decode() for w in notices[rng.integers(len(notices))][1]]
        texts.append(" ".join(["x", *(w if rng.random() < 0.85 else rng.choice(some) for w in ws), *rng.choice(some, 4)]))

    def by_hand(words):
        for k, (label, text, key, exact) in enumerate(notices):
            first = next((i for i in range(len(text)) if text[i:i + len(key)] == key), 0)
            for s in range(-len(text), len(words)):
                at = lambda i: words[i] if 0 <= i < len(words) else None
                share = sum(at(s + i) == w for i, w in enumerate(text)) / len(text)
                near = any(words[j:j + len(key)] == key for j in range(max(0, s + first - licenses.SLACK), s + first + licenses.SLACK + 1))
                if share == 1 if exact else near and share >= licenses.COVERAGE:
                    yield label, s, round(share, 9)

    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {r.doc_id: sorted((m.label, m.start, round(m.coverage, 9)) for m in r.matches) for r in got}
    assert found == {i: sorted(by_hand(licenses.words_of(t.encode()))) for i, t in enumerate(texts)}
    assert any(m[0] == "mit" for m in found[0]) and any(m[0] == "copyright" for m in found[1])


def test_language_model(docs, none):
    rows, n = odd.unigram(ROWS)
    got = lm.report(docs).collect()
    assert {r.train_tokens for r in got} == {n}
    same_rows([(r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got], [(i, a, b, round(s, 6)) for i, a, b, s in rows])
    assert all(r.held_out == (odd.fold(r.doc_id, 7) == 2) and r.score < 0 for r in got)
    assert lm.report(none).count() == 0


def test_language_model_adds_up(docs):
    """Known words and the unseen one share the whole probability."""
    model, words = lm.train(docs)
    assert words.agg(F.sum("q")).first()[0] + model.unseen == pytest.approx(1, abs=1e-4)


def test_language_model_contexts(spark):
    """Word order counts, and an unseen word scores by its spelling."""
    rng = np.random.default_rng(5)
    subject, verb, thing = (np.array([f"{x}{i}" for i in range(12)]) for x in ("cat", "sees", "tree"))
    line = lambda: " ".join(f"the {rng.choice(subject)} {rng.choice(verb)} every {rng.choice(thing)}" for _ in range(20))
    rows = [(i, line()) for i in range(200)]
    model, words = lm.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert model.facts.where("kind = 3").count() > model.facts.where("kind = 2").count() > 0
    fresh = [line() for _ in range(20)]
    texts = fresh + [" ".join(rng.permutation(t.split())) for t in fresh] + ["the cat77 sees1", "the \x07qz%kx sees1", "cat77 the"]
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, words).collect()}
    assert all(got[i].score > got[i + 20].score + 20 and abs(got[i].base_score - got[i + 20].base_score) < 1e-6 for i in range(20))
    assert got[40].score > got[41].score + 3 and all(r.score <= r.event_score + 1e-9 for r in got.values())


def test_language_model_by_hand(spark):
    """Scores from the restaurants and spellings by the recursion written out; after any context, known words and the unseen event add up to one."""
    rows = [(i, "a b c a b d a c c b") for i in range(40)] + [(100 + i, "b a d d c") for i in range(9)]
    model, words = lm.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    facts = {tuple(r[:len(lm.KEY)]): r for r in model.facts.collect()}
    known, hashes = {bytes(r.word): r for r in words.collect()}, lm.WordHashes()
    code = lambda w: int(np.uint64(hashes[w]).view(np.int64))
    fact = lambda kind, ws: facts.get((kind, *map(code, ws), *[0] * (lm.ORDER - len(ws))))

    def chance(before, w, i):
        p = known[w][f"q{i}"] if w in known else model.outside[i]
        for k in range(2, lm.ORDER + 1):
            dish, room = fact(k, (*before[-k + 1:], w)), fact(-k, before[-k + 1:])
            if room:
                c, t = (dish[f"n{i}"], dish[f"t{i}"]) if dish else (0, 0)
                d, s = model.discounts[k], lm.CONTEXT_STRENGTH
                p = (c - d * t + (s + d * room[f"t{i}"]) * p) / (room[f"n{i}"] + s)
        return p

    for before in ((b"", b""), (b"a", b"b"), (b"d", b"d"), (b"b", b"zz"), (b"c", b"d")):
        for i in lm.KEPT:
            assert sum(chance(before, w, i) for w in [*known, b"none"]) == pytest.approx(1, abs=1e-5)
    def spelling(w, i):
        """Natural log of an unseen word's part of the event, byte by byte."""
        log, total = model.spellings[i].reshape(lm.SYMBOLS, lm.CLASSES, lm.FAR_CLASSES, lm.SYMBOLS), 0.0
        last = [lm.END] * 3
        for b in [*w, lm.END]:
            total += float(log[last[0], last[1] % lm.CLASSES, last[2] % lm.FAR_CLASSES, b])
            last = [b, *last[:2]]
        return np.log(model.fresh[i] / model.outside[i]) + total

    texts = ["a b c", "b zz a c", "", "d d d", "b ab a c", "a " + "x" * 5000]
    scores = {}
    for r in lm.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, words).collect():
        ws = [b"", b"", *texts[r.doc_id].encode().split(), b""]
        event = sum(np.log10(np.mean([chance((ws[j - 2], ws[j - 1]), ws[j], i) for i in lm.KEPT])) for j in range(2, len(ws)))
        assert r.event_score == pytest.approx(event, abs=1e-5)
        logs = [[np.log(chance((ws[j - 2], ws[j - 1]), ws[j], i)) + (0 if ws[j] in known else spelling(ws[j], i)) for i in lm.KEPT]
                for j in range(2, len(ws))]
        want = sum(np.logaddexp.reduce(x) - np.log(len(x)) for x in logs) / np.log(10)
        assert r.score == pytest.approx(want, abs=1e-5, rel=1e-6)
        scores[r.doc_id] = r.score
    assert scores[4] > scores[1] + 0.5 and scores[5] < -1000  # garbage is told apart, and a long word is not cut off at the smallest number


def test_seating_matches_one_by_one():
    """Tables after grouped seating are as many as after seating one customer at a time."""
    rng = np.random.default_rng(0)
    for c, a, d in ((1, 1.0, 0.5), (5, 2.0, 0.3), (400, 3.0, 0.6), (3000, 0.5, 0.2)):
        slow = []
        for _ in range(60):
            t = 1
            for i in range(1, c):
                t += rng.random() < a / (i - d * t + a)
            slow.append(t)
        fast = lm.seat(np.full(2000, c), np.full(2000, a), d, rng)
        assert fast.min() >= 1 and fast.max() <= c
        assert abs(fast.mean() - np.mean(slow)) <= 0.08 * np.mean(slow) + 4 * np.std(slow) / 60 ** 0.5


def test_token_rollup(spark, docs, tmp):
    counts = rollup.token_counts(docs, rollup.versions_of()).withColumn("op", F.lit(rollup.INSERT))
    own = rollup.Rollup(spark, f"{tmp}/roll")
    assert own.commit("a", counts) and not own.commit("a", counts)
    now = defaultdict(list)  # every row of an id counts, null ids and repeats too
    for r in counts.collect():
        now[r.doc_id, r.version].append((r.source, r.lang, r.version, r.tokens))
    assert sum(map(len, now.values())) == 2 * len(ROWS) > len(now)

    def check():
        want = defaultdict(lambda: [0, 0])
        for rows in now.values():
            for *group, n in rows:
                want[tuple(group)][0] += 1
                want[tuple(group)][1] += n
        got = {(r.source, r.lang, r.version): [r.docs, r.tokens] for r in own.totals().collect()}
        assert got == dict(want)

    check()
    change = [("delete", 101, None, None, "words", None), ("delete", 999, None, None, "words", None),
              ("revise", 102, "moved", "de", "words", 77), ("insert", 555, "s", "en", "words", 3), ("revise", 556, "s", None, "words", 4),
              ("insert", 557, "s", "en", "words", 5), ("insert", 557, "s", "en", "words", 5), ("insert", 557, "t", "en", "words", 6),
              ("insert", 558, "s", "en", "words", 9), ("delete", 558, None, None, "words", None), ("revise", None, "s", "en", "words", 2)]
    frame = spark.createDataFrame(change, "op string, doc_id long, source string, lang string, version string, tokens long")
    # A commit that broke off leaves a ledger without a finished delta; the next try replaces it.
    frame.limit(1).write.parquet(f"{tmp}/roll/ledger/batch=b")
    assert own.commit("b", frame) and not own.commit("b", frame)
    gone = {(i, v) for op, i, _, _, v, _ in change if op == "delete"}
    for _, i, _, _, v, _ in change:
        now.pop((i, v), None)
    for op, i, s, g, v, n in change:
        if (i, v) not in gone:
            now[i, v].append((s, g, v, n))
    check()
    assert own.commit("empty", frame.limit(0))
    # A later sequence replaces an earlier one; a batch of one id reads one part of the ledger.
    late = [(2, "revise", 557, "s", "en", "words", 8), (1, "delete", 557, "s", "en", "words", 1)]
    assert own.commit("late", spark.createDataFrame(late, "sequence int, op string, doc_id long, source string, lang string, version string, tokens long"))
    now[557, "words"] = [("s", "en", "words", 8)]
    check()
    assert len({r.part for r in own._committed("ledger").where("doc_id = 557").collect()}) == 1
    held = {(r.doc_id, r.version): r.docs for r in own.documents().groupBy("doc_id", "version").agg(F.sum("docs").alias("docs")).collect()}
    assert held == {k: len(v) for k, v in now.items() if v}


def test_sharding(spark, docs, none):
    got = sharding.shards(docs, 4000).collect()
    assert len(got) == len(ROWS)
    size = defaultdict(list)
    for r in got:
        size[r.shard].append(r.bytes)
        assert r.depth == len(r.shard)
    for r in got:
        assert r.shard_bytes == sum(size[r.shard]) and r.fits == (r.shard_bytes <= 4000)
        assert r.fits or len(size[r.shard]) == 1
    names = sorted(size)
    assert not any(b.startswith(a) for a in names for b in names if a != b)
    # Copies of one row share all hashed bits and are parted all the same.
    copies = spark.createDataFrame([(1, "x" * 900)] * 40, "doc_id long, text string").repartition(5)
    hot = sharding.shards(copies, 4000).collect()
    assert len(hot) == 40 and all(r.fits for r in hot)
    assert sharding.shards(none, 4000).count() == 0


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.standard_normal(10)]) for i in range(0, 400)]
    rows += [(500 + i, rows[0][1]) for i in range(8)] + [(-50, rows[3][1]), (1000, [1.0] * 3), (1050, [2.0] * 3), (1051, [1e10] * 3)]
    rows += [(None, rows[1][1]), (2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 10), (2150, [float("inf")] * 10), (1100, []), (1150, [])]
    rows += [rows[7]] * 3 + [(50, rows[9][1]), (50, rows[50][1]), (1, rows[8][1]), (1, rows[1][1])]  # every row takes part, whatever its id
    rows += [(3000, [1e300] * 2), (3050, [-1e301, 1.0]), (3051, [0.5, 0.25])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    low, high = -(1 << 63), (1 << 63) - 1
    clip = lambda x: min(max(int(x), low), high)
    valid = [(i, [int(float(clip(np.floor(256 * x)))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for j, (q, v) in enumerate(valid):
        if q % 50 == 0:
            best = sorted((-clip(sum(a * b for a, b in zip(v, w))), i) for n, (i, w) in enumerate(valid) if n != j and len(w) == len(v))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    for block in (4096, 64):  # one block, and many: floors from the first round
        monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
        monkeypatch.setattr(topk, "QUERY_BLOCK", block // 8)
        same_rows([tuple(r) for r in topk.neighbours(frame).collect()], want)
    assert topk.neighbours(frame.limit(0)).count() == 0


def test_empty_tables(spark, none, items):
    assert near_dup.near_duplicates(none).count() == 0
    assert near_dup.one_of_each(none).count() == 0
    assert decontam.contamination(none, items).count() == 0
    assert decontam.contamination(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), items.limit(0)).first().n_words == 2
    assert secrets.report(none).count() == 0
    assert packing.packed(none).count() == 0
    assert licenses.report(none).count() == 0


def test_spelling_tables_are_sent_small_and_dropped(spark, monkeypatch):
    """op9: executors keep a copy of every broadcast on disk; contexts without customers are not sent each, a sweep's table goes after it."""
    from pyspark.core.broadcast import Broadcast
    sent, dropped, make, drop = [], [], type(spark.sparkContext).broadcast, Broadcast.destroy
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or make(self, value))
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: dropped.append(self) or drop(self, *a))
    docs = spark.createDataFrame([(i, f"some words of text {i} and more {i % 3}") for i in range(40)], "doc_id long, text string")
    model, _ = lm.train(docs)
    assert len(sent) == len(dropped) == lm.SWEEPS
    for log in model.spellings:
        rows, at = lm.distinct_rows(log)
        assert np.array_equal(rows[at], log.reshape(-1, lm.SYMBOLS))
    assert all(sum(x.nbytes for x in value) < model.spellings[0].nbytes / 10 for value in sent)


def test_language_model_in_many_parts(spark, monkeypatch):
    """op9: n-grams are counted, seated and found alike however many blocks and parts there are, also with frequent words, which are split."""
    monkeypatch.setattr(lm, "PART_TOKENS", 300)
    rng = np.random.default_rng(3)
    texts = [" ".join(["the" if x < 30 else "of" if x < 40 else f"w{x}" for x in rng.integers(0, 100, 40)]) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    model, words = lm.train(docs)
    assert model.parts.n > 4 and len(model.parts.words) >= 2 and model.parts.ways.max() > 4
    h = lambda w: int(np.uint64(lm.WordHashes()[w]).view(np.int64))
    three = Counter()
    for i, t in enumerate(texts):
        if odd.fold(i, lm.FOLDS) != lm.HELD_OUT:
            ws = [h(w) for w in [b"", b"", *t.encode().split(), b""]]
            three.update(zip(ws, ws[1:], ws[2:]))
    facts = {tuple(r[:len(lm.KEY)]): r for r in model.facts.collect()}
    assert {k[1:]: r.n0 for k, r in facts.items() if k[0] == 3} == three
    assert len(facts) == model.facts.count()
    for i in lm.KEPT:
        room, dish, one = (Counter() for _ in range(3))
        for (kind, *xs), r in facts.items():
            if kind == 3:
                dish[tuple(xs[1:])] += r[f"t{i}"]
                room[tuple(xs[:2])] += r[f"t{i}"]
            elif kind == 2:
                one[xs[0]] += r[f"n{i}"]
            assert 1 <= r[f"t{i}"] <= r[f"n{i}"]
        assert {tuple(k[1:3]): r[f"n{i}"] for k, r in facts.items() if k[0] == 2} == dish
        assert {tuple(k[1:3]): r[f"t{i}"] for k, r in facts.items() if k[0] == -3} == room
        assert {k[1]: r[f"n{i}"] for k, r in facts.items() if k[0] == -2} == one
    known = {r.w: r for r in words.collect()}

    def chance(v2, v1, w, i):
        p = known[w][f"q{i}"] if w in known else model.outside[i]
        for k, before in ((2, (v1,)), (3, (v2, v1))):
            pad = (0,) * (lm.ORDER - k)
            dish, held = facts.get((k, *before, w, *pad)), facts.get((-k, *before, 0, *pad))
            if held:
                c, t = (dish[f"n{i}"], dish[f"t{i}"]) if dish else (0, 0)
                p = (c - model.discounts[k] * t + (1 + model.discounts[k] * held[f"t{i}"]) * p) / (held[f"n{i}"] + 1)
        return p

    fresh = [*texts[:10], "the zz of the w50 zz", "", "of of of of"]
    for r in lm.score(spark.createDataFrame(list(enumerate(fresh)), "doc_id long, text string").repartition(3), model, words).collect():
        ws = [h(w) for w in [b"", b"", *fresh[r.doc_id].encode().split(), b""]]
        want = sum(np.log10(np.mean([chance(*g, i) for i in lm.KEPT])) for g in zip(ws, ws[1:], ws[2:]))
        assert r.event_score == pytest.approx(want, abs=1e-5)


def test_language_model_leaves_little_on_disk(spark):
    """op9: what a step has superseded goes, a trigram takes a few bytes, and only what the result reads is left."""
    def folders():
        top = os.path.dirname(scratch_path(spark, "x"))
        return {f for f in (os.listdir(top) if os.path.isdir(top) else []) if any(n.endswith(".parquet") for _, _, ns in os.walk(os.path.join(top, f)) for n in ns)}

    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 400) % 5000)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    before = folders()
    model, _ = lm.train(docs)
    size = model.trigrams.agg(F.sum(F.octet_length("data"))).first()[0]
    assert size < 12 * model.facts.where("kind = 3").count()
    before |= folders()
    assert len(lm.report(docs).collect()) == 300
    assert {f.rsplit("-", 1)[0] for f in folders() - before} <= {"blocks", *(f"answers-{k}" for k in range(1, lm.ORDER + 1))}


def test_language_model_answers_in_little_memory(spark, monkeypatch):
    """op9: the task that scores a block holds about as much as its tokens take, not every part's answers as arrays at once."""
    import tracemalloc

    from pyspark.sql.pandas.group_ops import PandasCogroupedOps
    asked, apply = [], PandasCogroupedOps.applyInArrow
    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", lambda self, f, schema: asked.append((self, f)) or apply(self, f, schema))
    monkeypatch.setattr(lm, "PART_TOKENS", 50_000)
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 2000, 2000))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    scored = lm.score(docs, *lm.train(docs))
    groups, answer = asked[-1]
    texts, known = groups._gd1._df.toArrow(), groups._gd2._df.toArrow()
    assert texts.num_rows == 1
    tracemalloc.start()
    try:
        got = answer(texts, known)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 180 * sum(got.column("n_tokens").to_pylist())
    want = {r.doc_id: (r.n_tokens, r.score, r.event_score) for r in scored.collect()}
    for r in got.to_pylist():
        assert (r["n_tokens"], r["score"], r["event_score"]) == pytest.approx(want[r["doc_id"]])
