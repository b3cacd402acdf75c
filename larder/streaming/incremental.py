"""Incremental ingest of a folder of CSV files as a stream that stops when caught up.

The file source remembers which files it has read; within new files the rule of the batch
version holds: only rows above the highest stored key are appended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.ingest import csv_options, high_water_mark, with_load_metadata
from larder.sources.tables import Lake


def ingest_new_files(
    lake: Lake, folder: str, table: str, key: str, schema: T.StructType, checkpoint: str
) -> int:
    """Append the new rows of new files to ``bronze.<table>``; returns the table's rows.

    A batch that is repeated after a failure adds nothing: its rows are no longer above
    the stored maximum.
    """
    spark = lake.spark

    def append(batch: DataFrame, batch_id: int) -> None:
        high = high_water_mark(lake, table, key)
        if high is not None:
            batch = batch.filter(F.col(key) > F.lit(high))
        lake.append(with_load_metadata(batch, folder), "bronze", table)

    stream = spark.readStream.options(**csv_options()).schema(schema).csv(folder)
    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return lake.read("bronze", table).count()
