"""Incremental re-adjudication as readings arrive.

The differential rerun of the batch engine, driven by Structured Streaming: a
micro-batch names the affected cases, only those are adjudicated again from
all of their readings, and the newest record of a case replaces the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from evidentia import schemas
from evidentia.plans import adjudicate as plan
from evidentia.policy import DEFAULT, Policy


def latest_records(versions: DataFrame) -> DataFrame:
    """The newest version of every record."""
    row = F.struct(*plan.RECORD[1:])
    newest = versions.groupBy("case_id").agg(F.max_by(row, "batch").alias("r"))
    return newest.select("case_id", "r.*")


def adjudicate_arrivals(
    spark: SparkSession, arrivals: str, store: str, records: str, checkpoint: str, policy: Policy = DEFAULT
):
    """Start the stream; returns the query.

    ``arrivals`` receives parquet files of readings. Each micro-batch writes
    its own ``batch=<id>`` folder of ``store`` and ``records`` and overwrites
    it when retried, so a restart repeats no work and leaves no duplicates.
    """

    def rerun(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{store}/batch={number}")
        fresh = session.read.schema(schemas.READINGS).parquet(f"{store}/batch={number}")
        affected = fresh.select("case_id").distinct()
        # only batches up to this one, so that a replay sees what it saw first
        known = session.read.parquet(store).filter(F.col("batch") <= number)
        readings = known.select(*schemas.READINGS.names).join(affected, "case_id", "left_semi")
        plan.adjudicate(readings, policy).write.mode("overwrite").parquet(f"{records}/batch={number}")

    stream = spark.readStream.schema(schemas.READINGS).parquet(arrivals)
    return (
        stream.writeStream.foreachBatch(rerun)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
