"""Tables that are appended to in named batches, each of which is there once however often it is sent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The column that names the batch of a row.
BATCH = "batch"


def aligned(spark: SparkSession, rows: DataFrame, table: str) -> DataFrame:
    """The rows with the table's columns in its order; columns the table lacks are added to it first."""
    present = {c.lower() for c in spark.table(table).columns}
    added = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name.lower() not in present]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
    given = {c.lower() for c in rows.columns}
    in_order = [
        F.col(f"`{f.name}`") if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(table).schema
    ]
    return rows.select(*in_order)


def has_batches(spark: SparkSession, table: str) -> bool:
    return any(c.name.lower() == BATCH and c.isPartition for c in spark.catalog.listColumns(table))


def put_batch(spark: SparkSession, rows: DataFrame, table: str, batch: str, fmt: str = "parquet") -> DataFrame:
    """Put rows into a table under the name ``batch``, in place of what it holds under that name.

    Each batch is a partition, put in place when all its rows are written: one
    that is cut off leaves none, and one that is sent again replaces itself.
    Batches of different names may be sent side by side. Returns the table.
    """
    rows = rows.drop(BATCH).withColumn(BATCH, F.lit(batch))
    if not spark.catalog.tableExists(table):
        # Without rows first, so a first batch that is cut off leaves a table that the next one finds in order.
        empty = spark.createDataFrame([], rows.schema).write.format(fmt).partitionBy(BATCH)
        empty.mode("ignore").option("partitionOverwriteMode", "dynamic").saveAsTable(table)
    if has_batches(spark, table):
        aligned(spark, rows, table).write.mode("overwrite").insertInto(table)
        return spark.table(table)
    # A table from before batches can't replace one: a batch that it holds already is not written again.
    columns = {c.lower() for c in spark.table(table).columns}
    if BATCH not in columns or spark.table(table).filter(F.col(BATCH) == batch).isEmpty():
        aligned(spark, rows, table).write.insertInto(table)
    return spark.table(table)
