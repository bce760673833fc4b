"""The run log: append-only, with columns added as the log grows."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.procedures import CANNOT_CREATE, MANUAL_PORT, PROCEDURE_CREATED
from lakeops.sinks.batches import aligned, has_batches, put_batch
from lakeops.sinks.tables import FAILED, TABLE_CREATED
from lakeops.sinks.views import VIEW_CREATED

def run_stamp() -> str:
    """The present instant as a run's stamp, in UTC."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def append_run_log(
    spark: SparkSession, outcomes: DataFrame, table: str, run_ts: str, fmt: str = "parquet", *, batch: str | None = None
) -> DataFrame:
    """Append outcomes stamped with the run; returns the whole log.

    Columns the log lacks are added first, columns the outcomes lack are null.
    With a ``batch``, a name that is the caller's for these outcomes within the
    run, they replace what the log holds under that name: a batch that is sent
    again, whether its first write was cut off or only its answer lost, is in
    the log once (see ``put_batch``).
    """
    rows = outcomes.withColumn("migrated_at", F.lit(run_ts))
    if batch is not None:
        return put_batch(spark, rows, table, f"{run_ts} {batch}", fmt)
    if not spark.catalog.tableExists(table):
        rows.write.format(fmt).saveAsTable(table)
        return spark.table(table)
    if has_batches(spark, table):
        # A log of batches knows no others: rows without a name are a batch that nobody sends again.
        return put_batch(spark, rows, table, f"{run_ts} {uuid.uuid4().hex}", fmt)
    aligned(spark, rows, table).write.insertInto(table)
    return spark.table(table)


def run_summary(log: DataFrame) -> DataFrame:
    """Tallies of a run in one row; tables are counted as tried and as created."""
    kind, status = F.col("kind"), F.col("status")
    counts = {
        "n_objects": F.count(F.lit(1)),
        "n_tables": F.count_if(kind == "table"),
        "n_tables_created": F.count_if(status == TABLE_CREATED),
        "n_views": F.count_if(kind == "view"),
        "n_views_created": F.count_if(status == VIEW_CREATED),
        "n_procedures_created": F.count_if(status == PROCEDURE_CREATED),
        "n_procedures_manual_port": F.count_if(status.startswith(MANUAL_PORT.rstrip("_"))),
        "n_procedures_host_too_old": F.count_if(status == CANNOT_CREATE),
        "n_failed": F.count_if(status == FAILED),
    }
    return log.agg(*[count.alias(name) for name, count in counts.items()])
