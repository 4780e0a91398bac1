"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations alone.

A window is ``window`` consecutive words of an item (an item of fewer words is one window). Both
sides are cut into word shingles; a window's occurrence needs every one of its shingles, so its
necessary prefix is a single one: the rarest, by the number of its places in the corpus (unseen
shingles first, ties by hash). The join runs on that prefix token only. What it finds has to keep the position (the window must
start at or after the first word) and length (it must end by the last word) bounds and is then
verified word by word against the document.

1. Document shingles that occur in the benchmark at all are found with their positions, in the
   only pass that takes every text apart (its number of words comes along as one more row). The
   benchmark's shingles are a written table, so Spark sees their true size and broadcasts them
   or not by its own threshold; nothing is forced.
2. Their counts choose each window's prefix token; the hits of those tokens are the candidates.
3. Candidates are gathered per document and verified in the row; only their texts are read again.

Defined cases: a null or wordless text has no words, is hit nowhere and is not contaminated; a
wordless or null item has no window; items with equal texts all count; items of a null id are
matched like others but have no name to list; repeated document rows each get their result; empty
tables work; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finflow.llm.common import ascii_lower, free_name, written

WINDOW = 13
SHINGLE = 4
#: Token of the row that carries a document's number of words.
MARK = 0
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _shingle(array: Column, at: Column, size: int) -> Column:
    """Hash of ``size`` words from the 0-based place ``at``."""
    return F.xxhash64(F.lit(size), *[F.get(array, at + k) for k in range(size)])


def _places(array: Column, size: int) -> Column:
    """Hashes of all shingles of ``size`` words, by place."""
    n = F.size(array) - (size - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: _shingle(array, i, size))
                  ).otherwise(F.array().cast("array<bigint>"))


def windows_of(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item_id, window (its words), at (offset of a shingle in it), size, token of every window's shingles."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    w = w.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("window"))
    per_size = [
        w.where(F.size("window") == size if size < shingle else F.size("window") >= size)
        .select("item_id", "window", F.lit(size).alias("size"), F.posexplode(_places(F.col("window"), size)).alias("at", "token"))
        for size in range(1, shingle + 1)
    ]
    out = per_size[0]
    for more in per_size[1:]:
        out = out.unionByName(more)
    return out


def row_key() -> list[Column]:
    """Tells rows apart by id and text; equal rows have equal results."""
    return [F.col("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key")]


def hits_of(docs: DataFrame, tokens: DataFrame, sizes: list[int]) -> DataFrame:
    """doc_id, text_key, place, token: shingles of the documents that the benchmark has, and for
    every row of ``docs`` one of token ``MARK`` whose place is the number of words."""
    w = docs.select(*row_key(), words(F.col("text")).alias("w"))
    mark = F.array(F.struct(F.size("w").alias("place"), F.lit(MARK).cast("long").alias("token")))
    shingles = F.concat(mark, *[F.transform(_places(F.col("w"), s), lambda h, i: F.struct(i.alias("place"), h.alias("token"))) for s in sizes])
    rows = w.select("doc_id", "text_key", F.explode(shingles).alias("s")).select("doc_id", "text_key", "s.place", "s.token")
    return rows.join(tokens, "token")


def verified(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """doc_id, text_key, n_hit, item_ids of the documents with candidates: (start, window, items) each."""
    found = candidates.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "window", "items")).alias("candidates"))
    found = written(found, "window-candidates").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "candidates")
    rows = docs.select(*row_key(), "text")
    rows = rows.join(found, rows["doc_id"].eqNullSafe(found["_id"]) & (rows["text_key"] == found["_key"]))
    rows = rows.dropDuplicates(["doc_id", "text_key"]).select("doc_id", "text_key", "candidates", words(F.col("text")).alias("w"))
    there = F.filter("candidates", lambda c: (c["start"] + F.size(c["window"]) <= F.size("w"))
                     & (F.slice("w", c["start"] + 1, F.size(c["window"])) == c["window"]))
    # No filter on what is verified here: pushed below, it would take the text apart for every candidate.
    rows = rows.select("doc_id", "text_key", there.alias("c"))
    covered = F.array_distinct(F.flatten(F.transform("c", lambda c: F.sequence(c["start"], c["start"] + F.size(c["window"]) - 1))))
    names = F.array_sort(F.array_distinct(F.flatten(F.transform("c", lambda c: c["items"]))))
    return rows.select("doc_id", "text_key", F.size(covered).cast("long").alias("n_hit"), names.alias("item_ids"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, percent: int = 5) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, item_ids, contaminated of every row of ``docs``.

    n_hit: words inside any occurrence of any window; item_ids: sorted strings of the items with
    occurring windows; contaminated: n_hit > 0 and 100 * n_hit >= percent * n_words.
    """
    parts = written(windows_of(items, window, shingle).groupBy("window", "size", "at", "token").agg(
        F.collect_set(F.col("item_id").cast("string")).alias("items")), "windows")
    mark = docs.sparkSession.range(1).select(F.lit(MARK).cast("long").alias("token"))
    tokens = written(parts.select("token").unionByName(mark).distinct(), "window-tokens")
    sizes = sorted(r["size"] for r in parts.select("size").distinct().collect()) or [shingle]
    found = written(hits_of(docs, tokens, sizes), "window-hits")
    hits = found.where(F.col("token") != MARK).distinct()
    seen = hits.groupBy("token").agg(F.count("*").alias("seen"))
    # The rarest shingle of each window is its prefix token.
    ranked = parts.join(seen, "token", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    prefix = (ranked.groupBy("window").agg(
        F.min(F.struct("seen", "token", "at", "items")).alias("p"))
        .select(F.col("p.token").alias("token"), F.col("p.at").alias("at"), F.col("p.items").alias("items"), "window"))
    prefix = written(prefix, "window-prefixes")
    candidates = hits.join(prefix, "token").withColumn("start", F.col("place") - F.col("at")).where("start >= 0")
    there = verified(docs, candidates).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "n_hit", "item_ids")
    rows = found.where(F.col("token") == MARK).select("doc_id", "text_key", F.col("place").cast("long").alias("n_words"))
    rows = rows.join(there, rows["doc_id"].eqNullSafe(there["_id"]) & (rows["text_key"] == there["_key"]), "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words")))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns untouched."""
    # Written before it is filtered: a filter on the verdict would be pushed below the verification and take texts apart for every candidate.
    found = written(contamination(docs, items).select("doc_id", "text_key", "contaminated"), "contaminated")
    bad = found.where("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    key = free_name(docs.columns, "text_key")
    keyed = docs.withColumn(key, row_key()[1])
    return keyed.join(bad, keyed["doc_id"].eqNullSafe(bad["_id"]) & (keyed[key] == bad["_key"]), "left_anti").drop(key)
