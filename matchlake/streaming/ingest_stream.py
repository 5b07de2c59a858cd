"""File-source stream over the raw document folder.

A run with ``trigger(availableNow=True)`` picks up only files the stream's
checkpoint has not seen, processes them in one or more micro-batches and
stops.  Each micro-batch goes through ``operators.ingest.run_batch`` inside
``foreachBatch``: bronze parse, three tables, quarantine, ledger, commit record.

The commit record names the stream (its query id, which lives and dies with
the checkpoint) and the epoch.  A replayed micro-batch finds the batch it was
committed as, and publishing is attempted again either way, since publishing a
batch twice writes the same rows.  A stream with a new checkpoint over a store
that already holds batches starts at epoch 0 under another id: it skips
documents by match id, never by a number.
No watermark: there is no event-time logic, incrementality is by file.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions import file_stem
from matchlake.operators.ingest import Paths, publish_fact_batch, run_batch
from matchlake.sources.documents import yaml_to_json


def document_stream(spark: SparkSession, raw_dir: str, glob: str = "*.json",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(raw_dir)
    return raw.select(file_stem(F.col("_metadata.file_name")).alias("match_id"), F.col("value"))


def start_ingest_stream(spark: SparkSession, raw_dir: str, store: Paths, checkpoint: str, fmt: str = "json",
                        glob: str | None = None, available_now: bool = True,
                        max_files_per_trigger: int | None = None, publish: tuple | None = None, **fact_options):
    """Start the stream; returns the ``StreamingQuery`` (await or stop it).

    ``publish=(people_raw, profiles_raw, leagues)`` also appends each
    micro-batch's fact rows to ``fact_by_batch`` (``publish_fact_batch``).
    """
    glob = glob or ("*.yaml" if fmt == "yaml" else "*.json")
    stream_id: list[str] = []
    started = threading.Event()

    def process(batch: DataFrame, epoch_id: int) -> None:
        started.wait()      # the first micro-batch may run before start() has returned the id
        docs = yaml_to_json(batch) if fmt == "yaml" else batch.withColumn("parse_error", F.lit(None).cast("string"))
        out = run_batch(batch.sparkSession, docs, store, stream=(stream_id[0], epoch_id))
        if publish is not None and "batch_id" in out:
            publish_fact_batch(batch.sparkSession, store, *publish, batch_id=out["batch_id"], **fact_options)

    writer = (document_stream(spark, raw_dir, glob, max_files_per_trigger).writeStream
              .foreachBatch(process).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    query = writer.start()
    stream_id.append(str(query.id))
    started.set()
    return query
