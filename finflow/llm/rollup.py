"""Token-count rollups kept up by deltas.

A rollup lives in a folder of the shared storage. A batch of changes (inserts, deletes, revised
counts) is compared with the ledger, and what it alters becomes signed rows: what an id counted so
far is taken away under its old source and language, what it counts now is added under the new
ones. Totals by source, language and version are sums of signed rows, so they never need the corpus
again.

Each batch writes its own folders, ``ledger/batch=<id>`` and ``deltas/batch=<id>``; the second is
complete when Spark's success marker stands in it. Committing an id again changes nothing, and a
commit that broke off is replaced as a whole by the next try. Ledger rows are laid out by a hash of
their id (``part``, one of ``PARTS`` folders), and a batch reads only the parts that hold its ids.

Defined cases: every row counts, also rows that repeat an id or have none: what an id holds is all
rows that the batch gives it, by source and language. Rows of the largest sequence of an id and
version replace what it held; where one of them is a delete, the id goes (deletes come after
inserts). An insert of a known id is a revision and a revision of an unknown one an insert; deleting
an unknown one does nothing; null ids, sources and languages are values like others; a null or empty
text counts 0 tokens; empty batches commit.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finflow.llm.common import written
from finflow.llm.tokens import encoder, slices, vocabulary

INSERT, REVISE, DELETE = "insert", "revise", "delete"
#: Ledger rows name a document; delta rows are summed by group and name none.
SCHEMA = "doc_id long, source string, lang string, version string, docs long, tokens long"
#: Folders of a batch's ledger, by a hash of the id.
PARTS = 16


def token_counts(docs: DataFrame, versions: dict[str, str]) -> DataFrame:
    """doc_id, source, lang, version, tokens by every tokenizer (name: vocabulary file, or "words" for space-separated words)."""

    def run(batches):
        coders = {v: None if path == "words" else encoder(path) for v, path in versions.items()}
        for batch in batches:
            texts = [t or b"" for t in batch.column(3).cast(pa.large_binary()).to_pylist()]
            for version, coder in coders.items():
                n = ([len(t.split()) for t in texts] if coder is None
                     else [len(ids) // 4 for part in slices(texts) for ids in coder.many(part)])
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())],
                                                 names=["doc_id", "source", "lang", "version", "tokens"])

    return docs.select(F.col("doc_id").cast("long"), "source", "lang", "text").mapInArrow(
        run, "doc_id long, source string, lang string, version string, tokens long")


def _part():
    return F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int")


class Rollup:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, path: str) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def _committed(self, kind: str) -> DataFrame:
        """Signed rows of all committed batches, those of the ledger with their part."""
        schema = SCHEMA + ", part int" if kind == "ledger" else SCHEMA
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/deltas")
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        paths = [f"{self.root}/{kind}/{n}" for n in names if self._exists(f"{self.root}/deltas/{n}/_SUCCESS")]
        # Batch by batch: each folder is the root of its own parts.
        batches = [self.spark.read.schema(schema).parquet(p) for p in paths] or [self.spark.createDataFrame([], schema)]
        return reduce(DataFrame.unionByName, batches)

    def _held(self, ledger: DataFrame) -> DataFrame:
        """doc_id, version, source, lang, docs, tokens that count now."""
        return ledger.groupBy("doc_id", "version", "source", "lang").agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs > 0")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Applies ``changes``; False if the batch was committed before.

        Columns: op, doc_id, source, lang, version, tokens, optional sequence and docs (the rows that one row stands for, else 1).
        """
        if self._exists(f"{self.root}/deltas/batch={batch}/_SUCCESS"):
            return False
        if "sequence" not in changes.columns:
            changes = changes.withColumn("sequence", F.lit(0))
        if "docs" not in changes.columns:
            changes = changes.withColumn("docs", F.lit(1))
        # Rows of one id are summed before they move, so that an id with a third of all rows is a few rows.
        new = changes.withColumn("gone", F.col("op") == DELETE).groupBy("doc_id", "version", "source", "lang", "sequence", "gone").agg(
            F.sum(F.col("docs").cast("long")).alias("docs"), F.sum(F.coalesce("tokens", F.lit(0)).cast("long")).alias("tokens"))
        new = written(new, "changes")  # read several times below, counted once
        # Null sequences come first; of the last one, a delete comes after all else.
        last = new.groupBy("doc_id", "version").agg(F.max(F.struct("sequence", "gone")).alias("last"))
        same = "o.doc_id <=> n.doc_id AND o.version <=> n.version"
        parts = [r["part"] for r in new.select(_part().alias("part")).distinct().collect()]  # PARTS at most
        old = self._held(self._committed("ledger").where(F.col("part").isin(parts)))
        touched = old.alias("o").join(new.select("doc_id", "version").alias("n"), F.expr(same), "left_semi")
        away = touched.select("doc_id", "source", "lang", "version", (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
        there = new.alias("o").join(last.alias("n"), F.expr(f"{same} AND o.sequence <=> n.last.sequence AND NOT n.last.gone"), "left_semi").select(
            "doc_id", "source", "lang", "version", "docs", "tokens")
        ledger = f"{self.root}/ledger/batch={batch}"
        away.unionByName(there).withColumn("part", _part()).hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(ledger)
        self.grouped(self.spark.read.schema(SCHEMA + ", part int").parquet(ledger)).withColumn("doc_id", F.lit(None).cast("long")).select(
            "doc_id", "source", "lang", "version", "docs", "tokens").write.mode("overwrite").parquet(f"{self.root}/deltas/batch={batch}")
        return True

    @staticmethod
    def grouped(rows: DataFrame) -> DataFrame:
        return rows.groupBy("source", "lang", "version").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def documents(self) -> DataFrame:
        """doc_id, version, source, lang, docs (its rows), tokens of all that counts now."""
        return self._held(self._committed("ledger"))

    def totals(self) -> DataFrame:
        """source, lang, version, docs, tokens over all committed batches."""
        return self.grouped(self._committed("deltas")).where("docs <> 0 OR tokens <> 0")


def versions_of(names: Iterable[str] = ("word_bpe_49k.json",)) -> dict[str, str]:
    return {"words": "words"} | {n.rpartition(".")[0]: vocabulary(n) for n in names}
