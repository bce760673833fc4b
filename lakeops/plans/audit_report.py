"""The shared-cluster audit: five scans, one plan, one write."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.audit import cluster_dim, cutoff, latest_run, task_pairs, with_absent_defaults
from lakeops.operators.cost import MONEY, cost_rollup
from lakeops.operators.skew import salted_join


def audit_report(
    jobs: DataFrame,
    tasks: DataFrame,
    clusters: DataFrame,
    runs: DataFrame,
    usage: DataFrame | None,
    prices: DataFrame | None,
    host: str,
    as_of: datetime | str,
    days_lookback: int,
    *,
    snapshot_at: Column | None = None,
    grain: str | None = "month",
    salts: int = 4,
) -> DataFrame:
    """One row per job and shared cluster: cluster, latest run, task count, cost.

    Without ``usage`` the cost columns are null. Cost belongs to the cluster and
    repeats on each of its jobs, so it does not add up over rows. Everything
    about a job is gathered per job, everything about a cluster per cluster,
    and each of the two is joined to the pairs once.
    """
    stamp = F.current_timestamp() if snapshot_at is None else snapshot_at
    pairs = task_pairs(tasks)
    job_side = jobs.select("job_id", "job_name").join(latest_run(runs, as_of, days_lookback), "job_id", "left")
    details = cluster_dim(clusters).drop("num_workers", "cluster_source").withColumn("_present", F.lit(True))
    if usage is None or prices is None:
        no_cost = F.lit(None).cast(MONEY)
        cluster_side = details.withColumns({"total_dbus_consumed": no_cost, "estimated_cost_usd": no_cost})
    else:
        # Full outer: a cluster that is gone may still have cost.
        cost = cost_rollup(usage, prices, cutoff(as_of, days_lookback), grain=grain)
        cluster_side = details.join(cost, "cluster_id", "full")
    rows = salted_join(pairs, job_side, "job_id", spread_by="cluster_id", how="inner", salts=salts)
    rows = salted_join(rows, cluster_side, "cluster_id", spread_by="job_id", salts=salts)
    url = F.concat(F.lit(host.rstrip("/") + "/jobs/"), F.col("job_id"))
    return (
        with_absent_defaults(rows, "_present")
        .withColumns({"job_url": url, "snapshot_timestamp": stamp})
        .select(
            "job_id",
            "job_name",
            "job_url",
            "cluster_id",
            "cluster_name",
            "worker_node_type",
            "driver_node_type",
            "workers_config",
            "autoscale_min_workers",
            "autoscale_max_workers",
            "spark_version",
            "latest_run_id",
            "latest_run_start_time",
            "latest_run_state",
            "num_tasks_on_cluster",
            "snapshot_timestamp",
            "total_dbus_consumed",
            "estimated_cost_usd",
        )
    )
