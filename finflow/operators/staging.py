"""Idempotent staging loads."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from finflow.session import read_or_none


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key: the row that sorts first on ``order`` (which must be total).

    ``min_by`` is an aggregate, so a key holding a third of all rows is reduced
    map-side by partial aggregation instead of being sorted in one window task.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    ordering = F.struct(*_cols(order))
    if all(isinstance(o, str) for o in order) and set(others) <= set(order):
        row = F.min(ordering)  # the order holds the whole row: it need not travel twice
    else:
        row = F.min_by(F.struct(*[F.col(f"`{c}`") for c in others]), ordering)
    picked = df.groupBy(*keys).agg(row.alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in others])


def keys_present(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def insert_if_absent(batch: DataFrame, existing: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Rows of ``batch`` to append so that the first row per key wins inside the
    batch and an existing row wins across loads (``INSERT .. ON CONFLICT DO NOTHING``).

    Rows with a null key are never inserted (a primary key is NOT NULL). Only the keys of
    the existing table are read; how the two sides meet is left to the optimizer.
    """
    first = first_per_key(batch.filter(keys_present(keys)), keys, order)
    return first.join(existing.select(*keys), on=keys, how="left_anti")


#: Folders of a staging table and 64-bit words of each folder's key filter: with 16 bits a key the filter
#: serves a million keys a folder; beyond that more folders are opened than need be, and no key is missed.
#: A large table takes more folders, for good: the number belongs to its layout.
KEY_BUCKETS, FILTER_WORDS = 64, 1 << 18
#: Bits that a key sets, a folder's size in the batch's keys up to which it is opened unasked, rows of a folder that are written together.
KEY_BITS, LIKE, FOLDER_ROWS = 4, 4, 1 << 20
BUCKET = "key_bucket"


def key_filter_path(table_path: str) -> str:
    """Bloom filters of a staging table's keys; the name is hidden from readers of the folder."""
    root, name = os.path.split(table_path.rstrip("/"))
    return os.path.join(root, "_key_filters", name)


def staged(spark: SparkSession, table_path: str) -> DataFrame | None:
    """A staging table's own columns; None where there is no table."""
    table = read_or_none(spark, table_path)
    return None if table is None else table.drop(BUCKET)


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _word(keys: list[str], words: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.xxhash64(*keys), 20), F.lit(words)).cast("int")


def _bits(keys: list[str]) -> Column:
    g, bits = F.xxhash64(F.lit("bits"), *keys), F.lit(0).cast("long")
    for k in range(KEY_BITS):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(g, 8 * k).bitwiseAND(63).cast("int")))
    return bits


def _placed(df: DataFrame, keys: list[str], buckets: int, words: int) -> DataFrame:
    """``df`` with its rows' folder, filter word and the bits that a key sets there."""
    return df.withColumns({BUCKET: _bucket(keys, buckets), "__word": _word(keys, words), "__bits": _bits(keys)})


def possibly_known(placed: DataFrame, filters: DataFrame) -> DataFrame:
    """The rows of ``placed`` whose key the filter of their folder may hold; of the filters only their words travel."""
    at = [BUCKET, "__word"]
    held = (filters.withColumnRenamed("word", "__word").join(placed.select(*at), at, "left_semi")
            .groupBy(*at).agg(F.bit_or("bits").alias("__held")))
    return placed.join(held, at).filter(F.col("__held").bitwiseAND(F.col("__bits")) == F.col("__bits")).drop("__held")


def _buckets_of(df: DataFrame) -> list[int]:
    """Folder numbers of rows: as many as there are folders at most."""
    return sorted(r[0] for r in df.select(BUCKET).distinct().collect())


def folders_to_open(batch: DataFrame, rows: dict[int, int], filters: DataFrame, keys: list[str], buckets: int, words: int) -> list[int]:
    """Folders that may hold a key of ``batch`` (distinct keys with their folder; ``rows``: how many by folder).

    A folder that holds at most ``LIKE`` times the batch's own keys (by its filter's bits) is opened unasked:
    reading them costs what the batch costs. The batch's keys in all other folders are looked up in the filters.
    """
    filled = filters.groupBy(BUCKET).agg(F.sum(F.bit_count("bits")).alias("n")).collect()
    sure = [r[BUCKET] for r in filled if r["n"] <= LIKE * KEY_BITS * rows[r[BUCKET]]]
    asked = [b for b in rows if b not in sure]
    if not asked:
        return sorted(sure)
    own = F.col(BUCKET).isin(asked)
    return sorted(sure + _buckets_of(possibly_known(_placed(batch.filter(own).select(*keys), keys, buckets, words), filters.filter(own))))


def load_staging(batch: DataFrame, table_path: str, keys: list[str], order: list, **layout) -> dict:
    """``keyed_load``'s counts of rows attempted and inserted."""
    got = keyed_load(batch, table_path, keys, order, **layout)
    return {k: got[k] for k in ("rows_attempted", "rows_inserted")}


def keyed_load(batch: DataFrame, table_path: str, keys: list[str], order: list, drop_cols: list[str] | None = None,
               buckets: int = KEY_BUCKETS, words: int = FILTER_WORDS) -> dict:
    """Append new rows to a Parquet staging table; returns attempted and inserted counts and the
    number of the table's folders whose keys were read.

    The table is laid out by key hash (``key_bucket=`` folders) with a Bloom filter per folder beside
    it. A batch's keys are looked up in the filters of its own folders; only folders in which one may
    be present, or which are no larger than the batch (``folders_to_open``), are opened, so a load costs
    what the batch and its repeated keys cost, not what the table holds. A load writes its keys' bits
    before its rows: a run that dies in between leaves bits without rows, which cost a look into a folder,
    never a row twice.

    Re-running the same batch inserts nothing (idempotent). ``rows_attempted`` counts the rows offered,
    ``rows_inserted`` those appended. ``drop_cols`` (ordering-only columns) are not written. Only a path
    that does not exist is an empty target; a table that cannot be read fails the load. A table without
    filters (written by other means) is compared as a whole and keeps its layout.
    """
    spark = batch.sparkSession
    out_cols = [c for c in batch.columns if c not in (drop_cols or [])]
    filters = read_or_none(spark, key_filter_path(table_path))
    table = read_or_none(spark, table_path)
    seen = Observation("attempted")
    offered = batch.observe(seen, F.count(F.lit(1)).alias("n"))
    if table is not None and filters is None:
        kept = Observation("inserted")
        new = insert_if_absent(offered, table, keys, order).select(*out_cols).observe(kept, F.count(F.lit(1)).alias("n"))
        new.write.mode("append").parquet(table_path)
        return {"rows_attempted": int(seen.get.get("n", 0) or 0), "rows_inserted": int(kept.get.get("n", 0) or 0), "folders_opened": None}
    first = first_per_key(offered.filter(keys_present(keys)), keys, order).withColumn(BUCKET, _bucket(keys, buckets)).persist()
    rows = {}
    if first.count():  # (a global count: the observed number is lost where a plan is found to be empty)
        rows = {r[BUCKET]: r["count"] for r in first.groupBy(BUCKET).count().collect()}
    attempted = int(seen.get.get("n", 0) or 0)
    new, opened = first, []
    if filters is not None and rows:
        opened = folders_to_open(first, rows, filters.filter(F.col(BUCKET).isin(list(rows))), keys, buckets, words)
        if opened and table is not None:
            new = first.join(keys_in_folders(table, keys, opened), keys, "left_anti")
    # One shuffle serves both writes: a folder's rows come together, those of a large folder by ranges of its filter's words.
    parts = max(rows.values(), default=0) // FOLDER_ROWS + 1
    part = F.floor(_word(keys, words).cast("long") * parts / words).cast("int")
    new = new.select(*out_cols, BUCKET, part.alias("__part")).repartition(BUCKET, "__part").persist()
    n_new = new.count()
    if n_new:
        (new.groupBy(BUCKET, "__part", _word(keys, words).alias("word")).agg(F.bit_or(_bits(keys)).alias("bits")).drop("__part")
            .write.mode("append").partitionBy(BUCKET).parquet(key_filter_path(table_path)))
        new.drop("__part").write.mode("append").partitionBy(BUCKET).parquet(table_path)
    new.unpersist()
    first.unpersist()
    return {"rows_attempted": attempted, "rows_inserted": n_new, "folders_opened": len(opened)}


def keys_in_folders(table: DataFrame, keys: list[str], folders: list[int]) -> DataFrame:
    """Keys in some of a staging table's folders; the other folders are not listed for reading."""
    return table.filter(F.col(BUCKET).isin(folders)).select(*keys)


def metadata_row(spark, table_name: str, row_count: int) -> DataFrame:
    return spark.range(1).select(
        F.lit(table_name).alias("table_name"),
        F.current_timestamp().alias("load_time"),
        F.lit(row_count).cast("bigint").alias("row_count"))


def latest_load_metadata(log: DataFrame) -> DataFrame:
    """Last load time and that load's row count per table (replace-by-key view over
    an append-only log, so writers never rewrite the table)."""
    return log.groupBy("table_name").agg(
        F.max("load_time").alias("load_time"),
        F.max_by("row_count", F.struct("load_time", "row_count")).alias("row_count"))
