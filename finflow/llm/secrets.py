"""Secret scans in DataFrame operations alone.

Three fixed detectors (assignments, access keys, long hex runs) and a learnt one: two character
Markov models, of random strings and of ordinary identifiers, whose log-likelihood ratio decides
over every run of ``MIN_RUN`` or more key characters: a run is found if a stretch of it has enough
evidence, so a secret behind a name or a path counts as one that stands alone. The span is the whole run.

Places come from cutting the text at the matches: the pieces between matches and the matches
themselves add up to it, so running sums of their lengths are the code-point offsets.

Training data are labelled by the fixed detectors: runs that an assignment, access key or hex match
yields are random strings, identifiers (also in capitals and joined by a capital) and plain numbers
elsewhere are ordinary. Kinds of random strings weigh alike however often each occurs, and a part of
the model is uniform, since a corpus may label one alphabet alone. Transitions to and from separators
say nothing. Random strings come from all documents, ordinary ones from about ``SAMPLE_DOCS`` (by
hashed id), ``SAMPLE_RUNS`` of each kind. The models are tables over a fixed alphabet, so their size
does not depend on the data.

Defined cases: a null or empty text has no span; repeated rows each get their result; without a
run of a class in the sample its model is uniform; an empty table gives an empty result;
extra columns are kept by ``redact`` and ignored by ``scan``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finflow.llm.common import free_name, written

# The base detectors (the contract's patterns; minimum lengths apply to the match or group 2).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters and more
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

MIN_RUN = 16
RUN = r"[A-Za-z0-9+/_=-]{16,}"
#: The characters a run can hold, and so the models' states.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Log-likelihood ratio (natural log, per transition) that a random stretch exceeds, and what its transitions have above it in sum.
THRESHOLD, EVIDENCE = 0.5, 15.0
#: Joints of names, paths and values, and the share of the uniform distribution in the model of random strings.
SEPARATORS, UNIFORM = "+/_=-", 0.25
SAMPLE_DOCS, SAMPLE_RUNS = 20_000, 5_000
#: Ordinary runs: identifiers and plain numbers, sampled apart, since numbers are rare among words.
IDENTIFIER = r"\b[A-Za-z_][A-Za-z0-9_]{7,}\b"
NUMBER = r"\b[0-9]{8,}\b"
#: Smoothing: what every character counts at least, and the weight of the overall probabilities in a row.
FLOOR, BACKING = 0.5, 4.0


def _cut(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches of the pattern and the pieces of text around them (one more)."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _spans(text: Column, pattern: str, kind: int, keep) -> Column:
    """Array of (start, kind, end) of the matches that ``keep`` accepts, empty when there are none."""
    found, gaps = _cut(text, pattern)
    empty = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    steps = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: (F.length(m) + F.length(g)).cast("long"))
    # Ends of the matches: running sums of the lengths before them.
    ends = F.aggregate(steps, F.array().cast("array<long>"),
                       lambda acc, n: F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0).cast("long")) + n)))
    spans = F.zip_with(found, ends, lambda m, e: F.struct(
        (e - F.length(m)).alias("start"), F.lit(kind).alias("kind"), e.alias("end"), m.alias("m")))
    kept = F.transform(F.filter(spans, lambda s: keep(s["m"])), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.when(F.regexp_like(text, F.lit(pattern)), kept).otherwise(empty)


def _assigned(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN, 2)


def base_spans(text: Column) -> Column:
    return F.concat(
        _spans(text, ASSIGN, 0, lambda m: F.length(_assigned(m)) >= ASSIGN_MIN),
        _spans(text, ACCESS, 1, lambda m: F.lit(True)),
        _spans(text, HEX, 2, lambda m: F.lit(True)))


def _transitions(runs: DataFrame) -> dict[tuple[int, int], int]:
    """Counts of (character, next character) by place in the alphabet; at most its size squared rows."""
    at = lambda i: F.instr(F.lit(ALPHABET), F.substring("run", i, F.lit(1)))
    pairs = runs.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("run") - 1), lambda i: F.struct(
        at(i).alias("x"), at(i + 1).alias("y")))).alias("p")).where("p.x > 0 and p.y > 0")
    return {(r["x"], r["y"]): r["n"] for r in pairs.groupBy("p.x", "p.y").agg(F.count("*").alias("n")).collect()}


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_runs: int = SAMPLE_RUNS) -> list[list[float]]:
    """Log-likelihood ratio of every transition, random over ordinary."""
    text = F.coalesce(F.col("text"), F.lit(""))
    every = max(1, docs.count() // sample_docs)
    values = F.transform(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.struct(
        F.when(F.regexp_like(v, F.lit(f"^({ACCESS})$")), 1).when(F.regexp_like(v, F.lit(f"^({HEX})$")), 2).otherwise(0).alias("kind"), v.alias("run")))
    found = lambda pattern, kind: F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), lambda v: F.struct(
        F.lit(kind).alias("kind"), v.alias("run")))
    labelled = docs.select(text.alias("text")).select(F.explode(F.concat(values, found(ACCESS, 1), found(HEX, 2))).alias("r")).select(
        "r.kind", "r.run").where(F.length("run") >= MIN_RUN)
    labelled = written(labelled.distinct(), "labelled")  # read once for each kind, found once
    rest = F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    ordinary = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select(rest.alias("text")).select(
        F.explode(F.concat(found(IDENTIFIER, 0), found(NUMBER, 1))).alias("r")).select("r.kind", "r.run")
    pick = lambda runs, k: runs.where(F.col("kind") == k).select("run").distinct().orderBy(F.xxhash64("run"), "run").limit(sample_runs)
    random = [c for c in (_transitions(pick(labelled, k)) for k in range(3)) if c] or [{}]
    words = pick(ordinary, 0).select(F.explode(F.array(
        F.col("run"), F.upper("run"), F.concat(F.lower("run"), F.initcap("run")))).alias("run"))
    plain = _conditional(_transitions(words.unionByName(pick(ordinary, 1))))
    random = [[sum(p) / len(p) for p in zip(*rows)] for rows in zip(*map(_conditional, random))]
    return [[0.0 if x in SEPARATORS or y in SEPARATORS else math.log((1 - UNIFORM) * r + UNIFORM / len(ALPHABET)) - math.log(p)
             for y, r, p in zip(ALPHABET, *rows)] for x, rows in zip(ALPHABET, zip(random, plain))]


def _conditional(counts: dict[tuple[int, int], int]) -> list[list[float]]:
    """Probability of the next character by the last one, backed by its overall probability."""
    k = len(ALPHABET)
    overall = [FLOOR + sum(counts.get((x, y), 0) for x in range(1, k + 1)) for y in range(1, k + 1)]
    whole = sum(overall)
    rows = []
    for x in range(1, k + 1):
        own = [counts.get((x, y), 0) for y in range(1, k + 1)]
        rows.append([(n + BACKING * o / whole) / (sum(own) + BACKING) for n, o in zip(own, overall)])
    return rows


def evidence(run: Column, model: list[list[float]], threshold: float = THRESHOLD) -> Column:
    """The largest sum, over the stretches of a run of alphabet characters, of what transitions have above the threshold."""
    k = len(ALPHABET)
    cells = F.split(F.lit(",".join(repr(v) for row in model for v in row)), ",").cast("array<double>")  # folded to one literal
    at = lambda i: F.instr(F.lit(ALPHABET), F.substring(run, i, F.lit(1)))
    each = F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.get(cells, (at(i) - 1) * k + at(i + 1) - 1) - threshold)
    # A stretch begins anew where the sum so far is below nothing.
    start = F.struct(F.lit(0.0).alias("now"), F.lit(0.0).alias("best"))
    return F.aggregate(each, start, lambda acc, v: F.struct(
        F.greatest(acc["now"] + v, F.lit(0.0)).alias("now"), F.greatest(acc["best"], acc["now"] + v).alias("best")), lambda acc: acc["best"])


def scan(docs: DataFrame, model: list[list[float]] | None = None, threshold: float = THRESHOLD, name: str = "spans") -> DataFrame:
    """``docs`` with the column ``name``: sorted array of (start, kind, end), kind by place in KINDS, end exclusive."""
    model = model if model is not None else train(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    learnt = _spans(text, RUN, 3, lambda m: evidence(m, model, threshold) > EVIDENCE)
    return docs.withColumn(name, F.array_sort(F.concat(base_spans(text), learnt)))


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def report(docs: DataFrame, model: list[list[float]] | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov."""
    rows = scan(docs.select("doc_id", "text"), model)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return rows.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                       F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), count(3).alias("n_markov"))


def redact(docs: DataFrame, mark: str = "[SECRET]", model: list[list[float]] | None = None) -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark``; ``n_chars``, if there, follows."""
    spans = free_name(docs.columns, "spans")
    rows = scan(docs, model, name=spans)
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, s):
        # A span that begins inside the last one only moves its end.
        fresh = (s["start"] > acc["at"]) | (acc["out"] == F.lit(""))
        piece = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.when(fresh, F.concat(acc["out"], piece, F.lit(mark))).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    whole = F.aggregate(spans, start, step, lambda acc: F.concat(
        acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text"))))
    rows = rows.withColumn("text", F.when(F.size(spans) > 0, whole).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
