"""Helpers shared by the operators: table access, written intermediates, word hashing."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finflow.session import hadoop_path, scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()

#: Bytes outside ``[0-9A-Za-z]`` and below 0x80 become a blank, A-Z their small letters.
#: UTF-8 bytes of other characters are all 0x80 and above, so they stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

#: Distinct words a Python worker remembers the hash (or ids) of; beyond it they are computed each time.
MEMO_WORDS = 400_000

#: Setting by which a query's shuffle files are removed at its end.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint dir and read it back.

    Cuts the lineage: a lost executor costs a re-read, and later plans see the true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Kept:
    """A table written under the shared checkpoint dir, by the values of ``by`` if given, that can go once it is superseded.

    The shuffles behind it go when it is written: what is read later are its files.
    """

    def __init__(self, spark: SparkSession, name: str, df: DataFrame, by: str | None = None):
        self.spark, self.path, self.schema, self.by = spark, scratch_path(spark, name), df.schema, by
        before = spark.conf.get(SHUFFLES_GO, None)
        spark.conf.set(SHUFFLES_GO, "true")
        try:
            writer = df.write.option("compression", "zstd")
            (writer.partitionBy(by) if by else writer).parquet(self.path)
        finally:
            spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)

    @property
    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _folder(self, value: str) -> str:
        return f"{self.path}/{self.by}={value}"

    def __getitem__(self, value: str) -> DataFrame:
        fs, path = hadoop_path(self.spark, self._folder(value))
        if not fs.exists(path):
            return self.spark.createDataFrame([], self.schema)
        rest = type(self.schema)([f for f in self.schema if f.name != self.by])
        return self.spark.read.schema(rest).parquet(self._folder(value)).withColumn(self.by, F.lit(value)).select(*self.schema.names)

    def drop(self, value: str | None = None) -> None:
        fs, path = hadoop_path(self.spark, self.path if value is None else self._folder(value))
        fs.delete(path, True)


def ascii_lower(text: Column) -> Column:
    """A-Z to small letters, every other character untouched.

    For text of ASCII alone ``lower`` does just that and is much cheaper than ``translate``.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_LOWER)
    )


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores added while a column has it (in any case, as Spark compares names)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


class WordHashes(dict):
    """64-bit hash of a word's bytes, remembered for the first ``MEMO_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < MEMO_WORDS:
            self[word] = value
        return value


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (multiply and xor-shift rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
