"""Incremental re-computation of subjects whose fragments arrive in batches (§2.11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from sitewright.sources.lake import merge_history, path_exists, remove_path, replace_scope


def stream_fragments(spark: SparkSession, incoming: str, schema: str, path: str, checkpoint: str, subject: list[str], key: list[str]) -> StreamingQuery:
    """Keep a table of fragments, partitioned by subject, up to date with a folder of arriving files.

    Each micro-batch reads only the partitions of the subjects it holds, lets incoming full keys win
    over archived ones and replaces these subjects as a whole. All available files are processed once.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        subjects = batch.select(*subject).distinct()
        archive = batch.limit(0)
        if path_exists(spark, path):
            archive = spark.read.schema(batch.schema).parquet(path).join(subjects, subject, "left_semi")
        merged = merge_history(batch, archive, key)
        # the partitions are overwritten, so what was read from them is written elsewhere first
        staged = f"{path}_staged/{number}"
        merged.write.mode("overwrite").parquet(staged)
        replace_scope(spark, spark.read.schema(merged.schema).parquet(staged), subjects, path, subject)
        remove_path(spark, staged)

    return spark.readStream.schema(schema).parquet(incoming).writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
