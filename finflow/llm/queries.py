"""Registered queries of the numbered operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finflow.llm import alignment, decontam, licenses, lm, near_dup, packing, quality, rollup, secrets, sharding, topk, toxicity, variants
from finflow.llm.common import table
from finflow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return register


@query("op1_license_scan")
def op1(spark, sf_dir):
    return licenses.report(table(spark, sf_dir, "documents"))


@query("op2_best_fit_packing")
def op2(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op3_near_duplicates", rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) > 1 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])
                                          ELSE ws END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * common >= 80 * (a.n + b.n - common)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
""")
def op3(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


@query("op4_secret_scan")
def op4(spark, sf_dir):
    return secrets.report(table(spark, sf_dir, "documents"))


@query("op5_token_rollup")
def op5(spark, sf_dir):
    """Loads all documents (the batch is sent twice), then takes down the toxic ones and moves the rest of the labelled to one source."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    feed = rollup.Rollup(spark, scratch_path(spark, "rollup"))
    counts = rollup.token_counts(docs, rollup.versions_of()).withColumn("op", F.lit(rollup.INSERT))
    feed.commit("load", counts)
    feed.commit("load", counts)
    known = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    held = feed.documents().join(known, "doc_id")
    feed.commit("labelled", held.withColumn("op", F.when(F.col("toxic") == 1, rollup.DELETE).otherwise(rollup.REVISE))
                .withColumn("source", F.lit("labelled")).drop("toxic"))
    return feed.totals()


_BITS = "array_to_string(list_transform(string_split(md5(doc_id::VARCHAR || ':' || text), ''), lambda c: lpad(bin(('0x' || c)::INTEGER), 4, '0')), '')"


@query("op6_extendible_sharding", f"""
WITH b AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS bytes, {_BITS} AS bits FROM documents),
w AS (SELECT doc_id, bytes, d, substr(bits, 1, d) AS shard FROM b, range(0, 33) AS r(d)),
n AS (SELECT shard, d, sum(bytes)::BIGINT AS shard_bytes FROM w GROUP BY ALL HAVING sum(bytes) <= {sharding.LIMIT} OR count(*) = 1),
l AS (SELECT doc_id, bytes, w.shard, w.d::INTEGER AS depth, shard_bytes, row_number() OVER (PARTITION BY doc_id ORDER BY w.d) AS k
      FROM w JOIN n ON w.shard = n.shard AND w.d = n.d)
SELECT doc_id, bytes, shard, depth, shard_bytes, shard_bytes <= {sharding.LIMIT} AS fits FROM l WHERE k = 1
""")
def op6(spark, sf_dir):
    return sharding.shards(table(spark, sf_dir, "documents"))


@query("op7_exact_top_k", """
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM e q JOIN e c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p) WHERE rank <= 5
""")
def op7(spark, sf_dir):
    return topk.neighbours(table(spark, sf_dir, "embeddings"))


_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op8_decontamination", rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
v AS (SELECT DISTINCT item_id, least(len(ws), 13) AS size, unnest(list_transform(range(1, greatest(len(ws) - 12, 1) + 1),
        lambda i: array_to_string(ws[i:i + 12], ' '))) AS win FROM b WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT size FROM v),
g AS (SELECT doc_id, size, unnest(range(1, len(ws) - size + 2)) AS pos, ws FROM d, sizes WHERE len(ws) >= size),
h AS (SELECT g.doc_id, v.item_id, g.pos, g.size FROM g JOIN v ON v.size = g.size AND v.win = array_to_string(g.ws[g.pos:g.pos + g.size - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS k FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
""")
def op8(spark, sf_dir):
    rows = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                       F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


@query("op9_language_model")
def op9(spark, sf_dir):
    return lm.report(table(spark, sf_dir, "documents"))


@query("op10_quality_classifier")
def op10(spark, sf_dir):
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_tokenizer_alignment")
def op11(spark, sf_dir):
    return alignment.report(table(spark, sf_dir, "documents"))


@query("op12_toxicity")
def op12(spark, sf_dir):
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: crc32 by its table of 256 values; a replaced letter leaves equal words around the same place, a deleted one the shorter word.
@query("op13_spelling_variants", rf"""
WITH RECURSIVE crc AS (SELECT list(c ORDER BY k) AS t FROM (SELECT k, list_reduce(list_concat([k], [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(0, 256) AS r(k))),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
         WHERE length(run) >= 6 GROUP BY ALL),
hexed AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (SELECT run, n, xor(list_reduce(list_concat([4294967295], list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
             lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) AS h FROM hexed, crc),
w AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
        FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i) AS head, substr(word, i + 2) AS tail FROM w, range(0, 100000) AS r(i) WHERE i < length(word)),
pairs AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
          UNION SELECT w.word, w.n, c.word, c.n FROM cut c JOIN w ON w.word = c.head || c.tail
          UNION SELECT c.word, c.n, w.word, w.n FROM cut c JOIN w ON w.word = c.head || c.tail),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS k FROM pairs),
f AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
             CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n FROM w LEFT JOIN ranked ON ranked.word = w.word AND k = 1),
chain AS (SELECT word, word AS at FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, chain.at AS root, f.n, f.n_near, f.form_n FROM f JOIN chain ON chain.word = f.word JOIN f AS l ON l.word = chain.at AND l.form IS NULL
""")
def op13(spark, sf_dir):
    return variants.report(table(spark, sf_dir, "documents"))
