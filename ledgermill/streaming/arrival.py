"""Arriving number files, one micro-batch at a time, staged as the batch loader does.

Each batch parses its lines with the loader's parser, keeps rejected lines, counts them, and enters the log; a batch that
fails the gate leaves the former load of its quarter in place. Batches of one quarter are told apart by their load, so a
repeated batch replaces what it wrote before, and late delivery is settled by the latest complete load.
"""
from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill.schema import QUARTER
from ledgermill.settings import Settings
from ledgermill.sources import staging, tsv


def watch_numbers(spark: SparkSession, source: str, root: str, checkpoint: str, settings: Settings | None = None
                  ) -> StreamingQuery:
    """Stage every ``<source>/<quarter>/num.txt`` not seen yet under ``root``, then stop."""
    limit = (settings or Settings()).max_reject_rate
    quarter = F.regexp_extract(F.col("_metadata.file_path"), "([0-9]{4}q[1-4])/num[.]txt$", 1)
    arrived = spark.readStream.text(f"{source}/*/num.txt").select("value", quarter.alias(QUARTER))

    def stage(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            # the quarters of a batch are a handful of names
            for (name,) in batch.select(QUARTER).distinct().orderBy(QUARTER).collect():
                started, load = time.perf_counter(), staging.new_load()
                lines = batch.where(F.col(QUARTER) == name).select("value")
                result, headers = staging.write_version(lines, root, "num", name, load)
                status = "complete" if headers and result.reject_rate <= limit else "failed"
                staging.append_log(batch.sparkSession, root, [
                    (name, "num", result.lines, result.parsed, result.rejected, None, time.perf_counter() - started,
                     status, load)])
        finally:
            batch.unpersist()

    return (arrived.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def staged_numbers(spark: SparkSession, root: str) -> DataFrame:
    """The numbers staged so far, whether or not the other files of their quarters have come."""
    return staging.read_current(spark, root, "num")
