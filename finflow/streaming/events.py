"""Event streams.

The production source is a Kafka topic per dataset; any source producing the same
columns (a JSON file stream in tests) plugs in. Every sink is checkpointed, and the
staging sink reuses the batch path's ``clean`` and insert-if-absent load, so replaying an
epoch after a failure inserts nothing twice.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from finflow import schemas
from finflow.operators import quality as Q
from finflow.operators import staging as ST
from finflow.operators.transform import clean
from finflow.plans.batch_run import typed_for_target
from finflow.session import hadoop_path, scratch_path

# Output format per dataset folder; workbook datasets are written as Parquet (no XLSX writer).
SINK_FORMATS = {
    "sales": "csv", "vehicles": "csv", "inventory": "csv", "payments": "csv", "suppliers": "csv",
    "procurement": "csv", "interactions": "json", "telemetry": "json",
    "customers": "parquet", "dealers": "parquet",
}
DEAD_LETTER = "_dead_letter"


def kafka_source(spark: SparkSession, servers: str, topics: list[str],
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """One subscription for all dataset topics, starting at the latest offsets. A
    trigger takes whatever has arrived; a bound is for deployments that need one.
    (The Kafka connector must be on the classpath of the deployment.)"""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", ",".join(topics)).option("startingOffsets", "latest"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received_at"))


def json_file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     archive_dir: str | None = None) -> DataFrame:
    """A9 / test source: files of events, one JSON text per line, read as text like the
    values of a topic, so a line that is no JSON is kept as it is. With ``archive_dir`` each
    file is moved there once its batch has committed (``cleanSource=archive``)."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.text(path).withColumn("received_at", F.current_timestamp())


def decode(df: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> columns of the superset event schema, keys beyond it as the map
    ``other_fields``, and the text itself as ``raw_value``. What is no JSON object has
    nulls in all columns."""
    known = F.array(*[F.lit(c) for c in schemas.EVENT_FIELDS])
    parsed = df.withColumn("__e", F.from_json(F.col(value_col), schemas.EVENT_SCHEMA)).withColumn(
        "__all", F.from_json(F.col(value_col), "map<string,string>"))
    keep = [c for c in df.columns if c != value_col]
    other = F.map_filter("__all", lambda k, v: ~F.array_contains(known, k))
    return parsed.select(*keep, "__e.*", other.alias("other_fields"), F.col(value_col).alias("raw_value"))


def dataset_rows(events: DataFrame, dataset: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of one dataset with its fixed columns: aliases are taken where an event lacks the
    canonical key, everything else the event carries goes to ``other_fields`` as JSON.
    ``keep`` names columns passed on as they are."""
    rows = events.filter(F.col("event_type") == dataset)
    columns = schemas.event_columns(dataset)
    sources: dict[str, list[str]] = {}
    for src, dst in schemas.COLUMN_ALIASES.get(dataset, []):
        sources.setdefault(dst, []).append(src)
    if dataset == "telemetry":
        rows = rows.withColumn("location", F.coalesce("location", F.when(
            F.col("location_lat").isNotNull() & F.col("location_long").isNotNull(),
            F.concat_ws(",", "location_lat", "location_long"))))
    used = {"event_type", *columns, *(s for own in sources.values() for s in own)}
    rest = [c for c in schemas.EVENT_FIELDS if c not in used]
    left = F.map_filter(F.map_from_arrays(F.array(*[F.lit(c) for c in rest]), F.array(*[F.col(c) for c in rest])),
                        lambda k, v: v.isNotNull())
    other = F.map_concat(left, F.coalesce("other_fields", F.create_map().cast("map<string,string>")))
    return rows.select(
        *keep, "event_type", "received_at", *[F.coalesce(c, *sources.get(c, [])).alias(c) for c in columns],
        F.when(F.size(other) > 0, F.to_json(other)).alias("other_fields"))


def supported(df: DataFrame) -> DataFrame:
    """Events of the ten dataset types."""
    return df.filter(F.col("event_type").isin(schemas.STREAM_EVENT_TYPES))


def unsupported(df: DataFrame) -> DataFrame:
    """Everything else, for a dead-letter sink."""
    return df.filter(~F.coalesce(F.col("event_type").isin(schemas.STREAM_EVENT_TYPES), F.lit(False)))


@contextmanager
def _dealt(batch: DataFrame):
    """The micro-batch written once to a scratch folder, a part for each sink: its sinks and the events of
    a sink, with their ``position`` in the batch. A sink reads its own events alone (kept in memory, every
    sink would read the whole batch, with all columns that its events lack). The folder goes at the end."""
    spark, path = batch.sparkSession, scratch_path(batch.sparkSession, "micro-batch")
    own = F.coalesce(F.col("event_type").isin(schemas.STREAM_EVENT_TYPES), F.lit(False))
    parts = batch.withColumns({"raw_value": F.when(~own, F.col("raw_value")),  # only dead letters are kept as they came
                               "position": F.monotonically_increasing_id(),
                               "__sink": F.when(own, F.col("event_type")).otherwise(DEAD_LETTER)})
    try:
        parts.write.option("compression", "zstd").partitionBy("__sink").parquet(path)
        dealt = spark.read.schema(parts.schema).parquet(path)
        sinks = [r[0] for r in dealt.select("__sink").distinct().collect()]
        yield sorted(set(sinks) - {DEAD_LETTER}), lambda sink: dealt.filter(F.col("__sink") == sink).drop("__sink")
    finally:
        fs, p = hadoop_path(spark, path)
        fs.delete(p, True)


def route_batch(batch: DataFrame, epoch_id: int, out_root: str) -> None:
    """Write one micro-batch into one folder per dataset, in that dataset's
    format and with its fixed columns, under an epoch-stamped directory (a replayed epoch
    overwrites itself)."""
    with _dealt(batch) as (present, events):
        for et in present:
            w = dataset_rows(events(et), et).write.mode("overwrite")
            if SINK_FORMATS[et] == "csv":
                w = w.option("header", True).option("escape", '"')
            w.format(SINK_FORMATS[et]).save(os.path.join(out_root, et, f"epoch_{epoch_id:08d}"))
        _dead_letters(events(DEAD_LETTER), epoch_id, out_root)


def _dead_letters(events: DataFrame, epoch_id: int, out_root: str) -> None:
    """The messages of no dataset, as they came."""
    (unsupported(events).select("raw_value", "event_type", "received_at").write.mode("overwrite")
        .parquet(os.path.join(out_root, DEAD_LETTER, f"epoch_{epoch_id:08d}")))


def start_router(events: DataFrame, out_root: str, checkpoint: str, available_now: bool = False,
                 interval_seconds: int = schemas.FLUSH_MAX_SECONDS):
    """Time-bounded micro-batches of all that has arrived (exact count-or-age
    batches are T4's); ``available_now`` drains what is there and stops (the final flush)."""
    w = (events.writeStream.foreachBatch(lambda df, eid: route_batch(df, eid, out_root))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{interval_seconds} seconds")
    return w.start()


def stage_batch(batch: DataFrame, epoch_id: int, staging_root: str, quarantine_root: str) -> None:
    """The stream feeds the batch path: per dataset ``clean`` -> split -> insert-if-absent
    into the same staging tables; dirty rows to quarantine, other messages to the dead
    letters. A dataset's columns are fixed, so an event fares alike in any micro-batch.
    Replays are idempotent."""
    with _dealt(batch) as (present, events):
        for et in present:
            rows = dataset_rows(events(et), et, keep=("position",)).drop("received_at").withColumn(
                "row_pos", F.struct(F.lit(epoch_id).cast("long").alias("b"), F.col("position").alias("i"))).drop("position")
            c = clean(rows, et, optional=schemas.EVENT_OPTIONAL.get(et, ())).persist()
            try:
                ok, dirty = Q.split_clean_dirty(c)
                typed = typed_for_target(ok, schemas.STAGING[et])
                ST.load_staging(typed, os.path.join(staging_root, et), schemas.PRIMARY_KEYS[et],
                                ["row_pos"], drop_cols=["row_pos"])
                (dirty.select(F.lit(epoch_id).alias("epoch"), "violations",
                              F.to_json(F.struct(*[F.col(x) for x in dirty.columns
                                                   if x not in ("violations", "is_dirty", "row_pos")])).alias("row_json"))
                      .write.mode("overwrite").parquet(os.path.join(quarantine_root, et, f"epoch_{epoch_id:08d}")))
            finally:
                c.unpersist()
        _dead_letters(events(DEAD_LETTER), epoch_id, quarantine_root)


def start_staging(events: DataFrame, staging_root: str, quarantine_root: str, checkpoint: str,
                  available_now: bool = True):
    w = (events.writeStream.foreachBatch(lambda df, eid: stage_batch(df, eid, staging_root, quarantine_root))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def arrival_counts(events: DataFrame) -> DataFrame:
    """Running count of arrivals per event type (complete-mode aggregate)."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("arrived"))


def observed(events: DataFrame, name: str = "arrivals") -> DataFrame:
    """Per-batch counters surfaced in ``query.lastProgress['observedMetrics']``."""
    return events.observe(name, F.count(F.lit(1)).alias("events"),
                          F.count(F.when(~F.coalesce(F.col("event_type").isin(schemas.STREAM_EVENT_TYPES),
                                                     F.lit(False)), 1)).alias("unsupported"))


def start_drain(spark: SparkSession, writer):
    """T5 for stateful queries: run ``writer`` (configured with ``availableNow``) without
    empty micro-batches, so pending processing-time timeouts cannot keep the run alive;
    rows still buffered stay in the checkpointed state and are released by the next run.

    The setting is captured by the query's own session when it starts, so it is changed
    only around ``start()``.
    """
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    old = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        return writer.start()
    finally:
        spark.conf.set(key, old)


# --- T4: exact count-or-age batches per event type (stateful) --------------------------------

BATCH_OUT = T.StructType([
    T.StructField("event_type", T.StringType()), T.StructField("bucket", T.IntegerType()),
    T.StructField("flush_seq", T.LongType()), T.StructField("reason", T.StringType()),
    T.StructField("payload", T.StringType()),
])
BATCH_STATE = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("since_ms", T.LongType()),
    T.StructField("buffer", T.ArrayType(T.StringType())),
])


def _make_batcher(max_rows: int, max_seconds: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        et, bucket = key
        seq, since, buf = state.get if state.exists else (0, 0, [])
        buf, now = list(buf), state.getCurrentProcessingTimeMs()

        def released(payloads, first, reason):
            """Whole batches of ``payloads`` from sequence number ``first``."""
            n = len(payloads)
            return pd.DataFrame({"event_type": et, "bucket": bucket, "flush_seq": first + np.arange(n) // max_rows,
                                 "reason": reason, "payload": payloads}, columns=[f.name for f in BATCH_OUT.fields])

        if not state.hasTimedOut:
            for pdf in pdfs:
                if not buf:
                    since = now
                buf += pdf["payload"].tolist()
                full = len(buf) // max_rows
                if full:
                    yield released(buf[:full * max_rows], seq, "size")
                    seq, buf, since = seq + full, buf[full * max_rows:], now
        # The age is that of the oldest event that waits: later arrivals do not put it off.
        if buf and now - since >= max_seconds * 1000:
            yield released(buf, seq, "age")
            seq, buf = seq + 1, []
        state.update((seq, since, buf))
        if buf:
            state.setTimeoutDuration(max(1, since + max_seconds * 1000 - now))

    return fn


def bounded_batches(events: DataFrame, max_rows: int = schemas.FLUSH_MAX_ROWS,
                    max_seconds: int = schemas.FLUSH_MAX_SECONDS, buckets: int = 16) -> DataFrame:
    """T4: release events in batches of exactly ``max_rows`` per type, or fewer once the
    oldest buffered event is ``max_seconds`` old (processing-time timeout).

    State per group is at most ``max_rows - 1`` payloads. Each type is split over
    ``buckets`` hash buckets so a type carrying a third of all events is spread over
    several tasks (``buckets=1`` gives one batch sequence per type). The salt hashes the
    payload with its arrival time (the Kafka message timestamp, or the micro-batch time
    that Spark keeps in the offset log), so it is deterministic under replay and copies
    of one payload arriving at different times spread over buckets too.
    """
    salt = [F.col("raw_value")] + ([F.col("received_at")] if "received_at" in events.columns else [])
    keyed = events.select(
        "event_type", F.pmod(F.xxhash64(*salt), F.lit(buckets)).cast("int").alias("bucket"),
        F.col("raw_value").alias("payload"))
    return keyed.groupBy("event_type", "bucket").applyInPandasWithState(
        _make_batcher(max_rows, max_seconds), BATCH_OUT, BATCH_STATE, "append",
        GroupStateTimeout.ProcessingTimeTimeout)
