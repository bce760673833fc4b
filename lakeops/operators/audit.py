"""Which jobs run on shared clusters, and their latest run."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.skew import salted_join

# Labels of the report, and the characters of a start in it (YYYY-MM-DD HH:MM:SS).
UNKNOWN = "Unknown"
ABSENT_CLUSTER = "UNKNOWN/TERMINATED"
START_LENGTH = 19


def cutoff(as_of: datetime | str, days_lookback: int) -> datetime:
    """Instant ``days_lookback`` days before ``as_of``; a naive ``as_of`` is UTC."""
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return as_of.astimezone(timezone.utc) - timedelta(days=days_lookback)


def flatten_tasks(
    jobs: DataFrame, *, job: str = "job_id", tasks: str = "settings.tasks", cluster: str = "existing_cluster_id"
) -> DataFrame:
    """One row per task of nested job records; jobs without tasks give none."""
    return jobs.select(F.col(job).alias("job_id"), F.explode(tasks).alias("_task")).select(
        "job_id", F.col(f"_task.{cluster}").alias("existing_cluster_id")
    )


def task_pairs(tasks: DataFrame, *, job: str = "job_id", cluster: str = "existing_cluster_id") -> DataFrame:
    """Tasks counted per (job, shared cluster); tasks on no existing cluster are left out."""
    named = F.col(cluster).isNotNull() & (F.col(cluster).cast("string") != "")
    return (
        tasks.filter(named)
        .groupBy(F.col(job).alias("job_id"), F.col(cluster).alias("cluster_id"))
        .agg(F.count(F.lit(1)).cast("int").alias("num_tasks_on_cluster"))
    )


def job_cluster_usage(
    jobs: DataFrame,
    tasks: DataFrame,
    *,
    job: str = "job_id",
    job_name: str = "job_name",
    cluster: str = "existing_cluster_id",
    salts: int = 4,
) -> DataFrame:
    """Shared clusters of each known job with their task counts.

    Tasks are counted before the join, so the join sees one row per pair.
    """
    known = jobs.select(F.col(job).alias("job_id"), F.col(job_name).alias("job_name"))
    pairs = task_pairs(tasks, job=job, cluster=cluster)
    return salted_join(pairs, known, "job_id", spread_by="cluster_id", how="inner", salts=salts).select(
        "job_id", "job_name", "cluster_id", "num_tasks_on_cluster"
    )


def _utc_clock(seconds: Column) -> Column:
    """UTC wall-clock time of epoch seconds, whatever the session's time zone."""
    zero = F.lit(0)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def _start_bounds(runs: DataFrame, start: str, since: datetime) -> tuple[Column, Column]:
    """Cutoff in the column's own type (so the filter reaches the scan) and the start as UTC wall-clock time."""
    kind = runs.select(start).schema[0].dataType
    if isinstance(kind, T.IntegralType):
        milliseconds = F.nullif(F.col(start), F.lit(0)).cast("decimal(20,0)")
        return F.lit(int(since.timestamp() * 1000)), _utc_clock(milliseconds / 1000)
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(since.replace(tzinfo=None).isoformat(" ")).cast(kind), F.col(start)
    return F.lit(since.isoformat(" ")).cast("timestamp"), _utc_clock(F.unix_seconds(F.col(start)))


def _order_number(start: Column, kind: T.DataType) -> tuple[Column, int]:
    """A start as a whole number that orders as it does, and how many of them make a second."""
    if isinstance(kind, T.IntegralType):
        return start.cast("decimal(19,0)"), 1000
    if isinstance(kind, T.TimestampNTZType):
        # Local times count from their own midnight of 1970, so no change of clocks moves them.
        days = F.unix_date(F.to_date(start)).cast("long")
        whole = (days * 24 + F.hour(start)) * 60 + F.minute(start)
        return (whole * 60 * 1_000_000 + F.extract(F.lit("SECOND"), start) * 1_000_000).cast("decimal(19,0)"), 1_000_000
    return F.unix_micros(start).cast("decimal(19,0)"), 1_000_000


def latest_run(
    runs: DataFrame,
    as_of: datetime | str,
    days_lookback: int,
    *,
    job: str = "job_id",
    run: str = "run_id",
    start: str = "start_time",
    result_state: str = "result_state",
    life_cycle_state: str = "life_cycle_state",
) -> DataFrame:
    """Latest run of each job that started at or after the cutoff.

    Ties go to the higher run id, then to the higher state. Starts are epoch
    milliseconds (0 reads as unknown) or timestamps.

    Start and run id become one number, whose maximum for each job and state is
    kept in a hash table while the runs are read: no run is sorted, and a job
    with very many runs sends one row per state and task. Run ids that are not
    whole numbers are compared as they are, which sorts.
    """
    since, clock = _start_bounds(runs, start, cutoff(as_of, days_lookback))
    kind, run_kind = (runs.select(c).schema[0].dataType for c in (start, run))
    state = F.coalesce(F.col(result_state), F.col(life_cycle_state)).alias("state")
    recent = runs.filter(F.col(start) >= since)
    job_id = F.col(job).alias("job_id")
    if isinstance(run_kind, T.IntegralType):
        number, per_second = _order_number(F.col(start), kind)
        base, middle = (F.lit(Decimal(n)).cast("decimal(20,0)") for n in (1 << 64, 1 << 63))
        rank = number * base + F.coalesce(F.col(run).cast("decimal(19,0)") + middle, F.lit(0))
        best = recent.select(job_id, state, rank.cast("decimal(38,0)").alias("rank")).groupBy("job_id", "state").agg(F.max("rank").alias("rank"))
        # A row for each state of a job is left.
        last = Window.partitionBy("job_id").orderBy(F.col("rank").desc(), F.col("state").desc())
        best = best.withColumn("place", F.row_number().over(last)).filter("place = 1")
        run_part = F.pmod("rank", base)
        run_id = F.when(run_part != 0, (run_part - middle).cast(run_kind))
        seconds = F.floor((F.col("rank") - run_part) / base / per_second)
        known = F.col("rank") - run_part != 0 if isinstance(kind, T.IntegralType) else F.lit(True)
        return best.select("job_id", run_id.alias("latest_run_id"), _start_text(F.when(known, _utc_clock(seconds))), F.col("state").alias("latest_run_state"))
    latest = F.max(F.struct(F.col(start).alias("start"), F.col(run).alias("run"), clock.alias("clock"), state))
    best = recent.groupBy(job_id).agg(latest.alias("latest"))
    return best.select("job_id", F.col("latest.run").alias("latest_run_id"), _start_text(F.col("latest.clock")), F.col("latest.state").alias("latest_run_state"))


def _start_text(clock: Column) -> Column:
    return F.substring(clock.cast("string"), 1, START_LENGTH).alias("latest_run_start_time")


def cluster_dim(
    clusters: DataFrame,
    *,
    cluster: str = "cluster_id",
    name: str = "cluster_name",
    node_type: str = "node_type_id",
    driver_node_type: str = "driver_node_type_id",
    workers: str = "num_workers",
    autoscale_min: str = "autoscale_min",
    autoscale_max: str = "autoscale_max",
    spark_version: str = "spark_version",
    source: str = "cluster_source",
) -> DataFrame:
    """Cluster attributes with their display defaults; columns may be nested."""

    def first_filled(*columns: str) -> Column:
        return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in columns], F.lit(UNKNOWN))

    low, high, fixed = F.col(autoscale_min), F.col(autoscale_max), F.col(workers)
    sizing = (
        F.when(
            low.isNotNull(),
            F.concat(F.lit("Autoscale "), low, F.lit("-"), F.coalesce(high.cast("string"), F.lit("None"))),
        )
        .when(fixed.isNotNull(), F.concat(F.lit("Fixed "), fixed))
        .otherwise(UNKNOWN)
    )
    return clusters.select(
        F.col(cluster).alias("cluster_id"),
        F.col(name).alias("cluster_name"),
        first_filled(node_type).alias("worker_node_type"),
        first_filled(driver_node_type, node_type).alias("driver_node_type"),
        sizing.alias("workers_config"),
        fixed.cast("int").alias("num_workers"),
        low.cast("int").alias("autoscale_min_workers"),
        high.cast("int").alias("autoscale_max_workers"),
        first_filled(spark_version).alias("spark_version"),
        first_filled(source).alias("cluster_source"),
    )


def with_absent_defaults(joined: DataFrame, present: str) -> DataFrame:
    """Defaults for rows whose cluster is gone. A present cluster with a null name keeps it."""
    gone = F.col(present).isNull()
    labels = {c: UNKNOWN for c in ("worker_node_type", "driver_node_type", "workers_config", "spark_version")}
    labels["cluster_name"] = ABSENT_CLUSTER
    return joined.withColumns({c: F.when(gone, F.lit(v)).otherwise(F.col(c)) for c, v in labels.items()}).drop(present)


def cluster_lookup(pairs: DataFrame, clusters: DataFrame, *, salts: int = 4) -> DataFrame:
    """Cluster attributes for (job, cluster) pairs. ``clusters`` comes from :func:`cluster_dim`."""
    details = clusters.drop("num_workers", "cluster_source").withColumn("_present", F.lit(True))
    joined = salted_join(pairs, details, "cluster_id", spread_by="job_id", salts=salts)
    return with_absent_defaults(joined, "_present")
