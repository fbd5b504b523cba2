"""Incremental file ingestion with Structured Streaming.

A file-source stream with a checkpoint replaces the "Status = New" bookkeeping:
the checkpoint remembers which files were consumed, so every run processes only
new files, exactly once per sink commit (foreachBatch with the batch id).
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import ts_lit
from ..operators.merge import overwrite_partitions
from ..session import new_run_dir
from ..sources.tables import load

EVENTS_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def run_available_now(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an availableNow query to drain its backlog, however long that takes;
    a limit in seconds is opt-in."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream {query.name} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """``recentProgress`` as rows (batch id, input rows) for monitoring: Spark keeps the
    latest updates only; ``batch_counts`` has every batch."""
    rows = [(int(p["batchId"]), int(p["numInputRows"])) for p in query.recentProgress]
    return spark.createDataFrame(rows, "batch_id BIGINT, num_input_rows BIGINT")


BATCH_COL = "_batch_id"


def batch_counts(spark: SparkSession, sink_table: str) -> DataFrame:
    """Rows of every stored micro-batch, from the sink itself."""
    return spark.table(sink_table).groupBy(F.col(BATCH_COL).alias("batch_id")).agg(F.count(F.lit(1)).alias("n_rows"))


def write_batch_idempotent(batch: DataFrame, batch_id: int, sink_table: str) -> None:
    """Store one micro-batch as the ``_batch_id = batch_id`` partition of the sink.

    ``foreachBatch`` is at-least-once: after a failure the same batch id is
    replayed. Overwriting that batch's own partition (dynamic overwrite) makes a
    replay replace what the failed attempt may have written instead of adding it
    twice, so the table holds every batch exactly once.
    """
    spark = batch.sparkSession
    out = batch.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
    if spark.catalog.tableExists(sink_table):
        overwrite_partitions(out, sink_table)
    else:
        out.write.partitionBy(BATCH_COL).saveAsTable(sink_table)


def stream_new_records(spark: SparkSession, src_path: str, schema: str, sink_table: str,
                       checkpoint: str, fmt: str = "parquet", max_files: int | None = None,
                       transform=None, name: str | None = None,
                       archive_dir: str | None = None) -> StreamingQuery:
    """Process the files not seen yet (per the checkpoint) into a table.

    The checkpoint makes the source resume after the last committed batch, and
    each batch lands idempotently (``write_batch_idempotent``), so every file is
    stored once however often the job is restarted. ``max_files`` drip-feeds the
    backlog a few files per micro-batch. Readers drop the ``_batch_id`` column.
    ``archive_dir`` moves consumed source files there once their batch has
    committed (Spark's ``cleanSource=archive``), replacing a separate purge step.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    stream = reader.load(src_path)
    if transform is not None:
        stream = transform(stream)

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch_idempotent(batch, batch_id, sink_table)

    writer = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    if name:
        writer = writer.queryName(name)
    query = run_available_now(writer.start())
    # micro-batches wrote through the stream's session; drop this session's cached listing
    if spark.catalog.tableExists(sink_table):
        spark.catalog.refreshTable(sink_table)
    return query


def _land_events(events: DataFrame, path: str, lo: dt.datetime, hi: dt.datetime) -> None:
    """Land one slice of events as files (one folder per day) in the source folder."""
    part = events.filter((F.col("ts") >= ts_lit(lo)) & (F.col("ts") < ts_lit(hi)))
    part = part.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    part.write.mode("append").partitionBy("day").parquet(path)


def _stream_setup(spark: SparkSession, tag: str):
    root = new_run_dir(spark, tag)
    db = f"{tag}_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/db'")
    return root, f"{db}.events_sink"


def s_new_only(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrivals of event files; the second run picks up only the new files."""
    root, sink = _stream_setup(spark, "stream_new")
    src = f"{root}/landing"
    events = load(spark, sf, "events")
    bounds = events.agg(F.min("ts"), F.max("ts")).first()
    mid = bounds[0] + (bounds[1] - bounds[0]) / 2
    _land_events(events, src, bounds[0], mid)
    stream_new_records(spark, src, EVENTS_DDL + ", day STRING", sink, f"{root}/checkpoint")
    _land_events(events, src, mid, bounds[1] + dt.timedelta(seconds=1))
    stream_new_records(spark, src, EVENTS_DDL + ", day STRING", sink, f"{root}/checkpoint")
    return spark.table(sink).drop("day", BATCH_COL)


def s_drip_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The backlog drained a few files per micro-batch; rows per batch are reported."""
    root, sink = _stream_setup(spark, "stream_drip")
    src = f"{root}/landing"
    events = load(spark, sf, "events")
    bounds = events.agg(F.min("ts"), F.max("ts")).first()
    _land_events(events, src, bounds[0], bounds[1] + dt.timedelta(seconds=1))
    stream_new_records(spark, src, EVENTS_DDL + ", day STRING", sink, f"{root}/checkpoint",
                       max_files=4, transform=lambda s: s.select("event_id", "event_type", "value"))
    if batch_counts(spark, sink).agg(F.sum("n_rows")).first()[0] != events.count():
        raise AssertionError("the stored batches do not add up to the landed events")
    return spark.table(sink).drop(BATCH_COL)
