"""Shards by extendible hashing.

A document's bits are those of the MD5 of its id and text. A bucket is a prefix of bits; a bucket
over the byte limit, and only such a one, splits on the next bit, until every bucket fits. The
directory (bucket by prefix) is found from byte sums over prefixes: first over as many bits as the
total size asks for, then deeper under those alone that are still too large.

Rows that are equal in id and text share all bits, so no bit parts them: they are numbered by
their input partition and its rows in further bits, after the MD5's.

Defined cases: a null text has no bytes; a document over the limit has a bucket of its own with
``fits`` false; an empty table has no bucket; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finflow.llm.common import written

LIMIT = 1 << 20
#: Bits of the first directory beyond those that even shards would need, and of every deeper step.
SPARE, STEP = 4, 8
BITS = 128 + 64


def _bits(hex_text):
    """Text of 0 and 1 of a hexadecimal text."""
    return F.array_join(F.transform(F.split(hex_text, ""), lambda c: F.lpad(F.conv(c, 16, 2), 4, "0")), "")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, bytes, bits of every row."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    tail = F.reverse(F.lpad(F.bin(F.monotonically_increasing_id()), 64, "0"))
    return docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
                       F.concat(_bits(F.md5(key)), tail).alias("bits"))


def shards(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, bytes, shard (its bits), depth, shard_bytes, fits of every row."""
    rows = written(sized(docs), "sized")
    total = rows.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    depth = min(BITS, max(0, (total // limit).bit_length() + SPARE))
    open_rows, done = rows, None
    base = 0
    while True:
        # Sums over the longest prefixes, then over all shorter ones of them.
        sums = open_rows.groupBy(F.substring("bits", 1, depth).alias("p")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows"))
        levels = F.explode(F.sequence(F.lit(base), F.lit(depth)))
        nodes = (sums.select("p", "bytes", "rows", levels.alias("d")).groupBy(F.expr("substring(p, 1, d)").alias("shard"), F.col("d").alias("depth"))
                 .agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("rows")).withColumn("whole", (F.col("shard_bytes") <= limit) | (F.col("rows") == 1)))
        nodes = nodes.where(F.col("whole") | (F.col("depth") == depth))
        # The shortest fitting prefix on the way down is the bucket.
        way = sums.select("p", levels.alias("depth")).withColumn("shard", F.expr("substring(p, 1, depth)"))
        leaf = (way.join(nodes, ["shard", "depth"]).groupBy("p")
                .agg(F.min(F.struct("depth", "shard", "shard_bytes", "whole")).alias("n")).select("p", "n.*"))
        leaf = written(leaf, "directory")
        placed = open_rows.withColumn("p", F.substring("bits", 1, depth)).join(leaf, "p").drop("p")
        last = depth >= BITS
        fits = placed if last else placed.where("whole")
        done = fits if done is None else done.unionByName(fits)
        if last or leaf.where("not whole").isEmpty():
            break
        open_rows = written(placed.where("not whole").select("doc_id", "bytes", "bits"), "oversized")
        base, depth = depth, min(BITS, depth + STEP)
    return done.select("doc_id", "bytes", "shard", F.col("depth").cast("int").alias("depth"), "shard_bytes", (F.col("shard_bytes") <= limit).alias("fits"))
