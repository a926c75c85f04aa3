"""Queries that run a stream over a table's files to its end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tarnflow.plans.derived import READS, frame
from tarnflow.plans.read_queries import _REASON, _SCORES
from tarnflow.session import read_table
from tarnflow.streaming.ingest import arriving, running_counts, windowed_counts


def _events(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _finished(stream, mode):
    """The stream's whole result, a few groups."""
    name = f"stream_{uuid.uuid4().hex}"
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def stream_running_counts(spark, sf_dir):
    """Reads as they arrive; the derived reads are files of the session's shared folder."""
    reads = frame(spark, sf_dir, READS)
    folder = reads.inputFiles()[0].rsplit("/", 1)[0]
    return _finished(running_counts(arriving(spark, folder, reads.schema), ["project"]), "complete")


def stream_windowed_counts(spark, sf_dir):
    rows = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    found = _finished(windowed_counts(rows, width="1 day"), "complete")
    return found.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


QUERIES = {f.__name__: f for f in (stream_running_counts, stream_windowed_counts)}
ORACLE_SQL = {
    "stream_running_counts": f"select project, count(*) as reads, count(*) filter (where {_REASON} <> 'kept') as rejected from ({_SCORES}) group by project",
    "stream_windowed_counts": "select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n from events group by all",
}
