"""Exports that arrive as files over time: each refresh reads only the files that are new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.sinks.batches import put_batch
from lakeops.sinks.tables import overwrite_table
from lakeops.sources.snapshots import SCHEMAS

# What tells records of one kind apart; kinds without a key are facts, of which every record counts.
KEYS = {
    "jobs": ("job_id",),
    "clusters": ("cluster_id",),
    "runs": ("run_id",),
    "prices": ("sku_name", "price_start_time"),
    "usage": (),
}
# Where a record is from: the newest file wins, then the last by name, then the greatest record as text.
AGE = "_age"


def _aged(records: DataFrame) -> DataFrame:
    return records.withColumn(AGE, F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file")))


def newest(records: DataFrame, key: Sequence[str]) -> DataFrame:
    """One record for each key, that of the greatest age stamp; ties go to the greatest record as text.

    A maximum in the tasks first, so a key with many versions never meets in numbers.
    """
    rest = [c for c in records.columns if c not in key]
    own = [c for c in rest if c != AGE]
    # One struct for each record, compared from its left: what is compared and what is kept travel once.
    text = F.to_json(F.struct(*own)).alias("text")
    picked = records.groupBy(*key).agg(F.max(F.struct(F.col(AGE).alias("age"), text, F.struct(*own).alias("own"))).alias("_newest"))
    return picked.select(*key, *[(F.col("_newest.age") if c == AGE else F.col("_newest.own")[c]).alias(c) for c in rest])


def refresh(spark: SparkSession, record: str, path: str, table: str, checkpoint: str, *, key: Sequence[str] | None = None, fmt: str = "json", files: int | None = None) -> DataFrame:
    """Take up the files that have come to ``path`` since the last call; returns the records as they are now.

    Files are a stream that ends when there are no more; its progress is kept in
    ``checkpoint``, a shared folder that belongs to ``table``. Records with a key
    are merged with the table, which is replaced at once: a merge that is cut off
    and repeated gives the same rows. Facts are appended in batches that are put
    in place whole, under the stream's own number. ``files`` bounds the files of
    one batch. A path without files gives an empty table.
    """
    key = KEYS[record] if key is None else key
    reader = spark.readStream.schema(SCHEMAS[record]).format(fmt)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)

    def merge(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        if not key:
            put_batch(own, batch.drop(AGE), table, f"{number:012d}")
            return
        every = batch
        if own.catalog.tableExists(table):
            every = batch.unionByName(own.table(table))
        overwrite_table(newest(every, key), table)

    query = _aged(reader.load(path)).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], SCHEMAS[record])
    # The stream writes in a session of its own; this one may still know the files of before.
    spark.catalog.refreshTable(table)
    return spark.table(table).select(*spark.createDataFrame([], SCHEMAS[record]).columns)
