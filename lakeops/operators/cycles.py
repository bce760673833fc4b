"""Cycles among views: which members each one has, and which views only stand above one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.deps import dependency_levels
from lakeops.operators.skew import salted_join
from lakeops.session import written_out


def _settled(start: DataFrame, step: Callable[[DataFrame], DataFrame], same: Callable[[DataFrame, DataFrame], bool]) -> DataFrame:
    """Repeat a step until it changes nothing; each result is written, so no plan grows."""
    now = written_out(start)
    while True:
        after = written_out(step(now))
        if same(now, after):
            return after
        now = after


def view_cycles(nodes: DataFrame, edges: DataFrame, *, node: str = "view_id", dep: str = "dep_id") -> DataFrame:
    """Nodes that have no level: ``node``, ``cycle`` and ``n_members``.

    ``cycle`` is the least member of a node's cycle, the largest set of nodes
    that all reach each other; it is null for a node that stands above cycles
    without being on one. A node that reads only itself is on none.

    Nodes without a cycle below are trimmed first, then those without one above.
    Of the rest each learns the least node that it reaches; from that node, the
    nodes of the same one that it reaches are its cycle. Those are taken out, and
    the rest goes round again, as often as cycles stand above each other. A round
    is a join on the edges that are left and a minimum for each node.
    """
    edges = edges.select(F.col(node).alias("node"), F.col(dep).alias("dep")).filter("node <> dep").distinct()
    open_ = dependency_levels(nodes.select(F.col(node).alias("node")), edges, node="node", dep="dep").filter("is_circular").select("node")
    inside = edges.join(open_, "node", "left_semi").join(open_.withColumnRenamed("node", "dep"), "dep", "left_semi").select("node", "dep")
    inside = written_out(inside)
    below = dependency_levels(open_.withColumnRenamed("node", "dep"), inside, node="dep", dep="node")
    left = written_out(below.filter("is_circular").select(F.col("dep").alias("node")))
    held = written_out(inside.join(left, "node", "left_semi").join(left.withColumnRenamed("node", "dep"), "dep", "left_semi").select("node", "dep"))
    found = None
    while not left.isEmpty():
        members = _least_cycles(left, held)
        found = members if found is None else found.union(members)
        left = written_out(left.join(members, "node", "left_anti"))
        held = written_out(held.join(left, "node", "left_semi").join(left.withColumnRenamed("node", "dep"), "dep", "left_semi").select("node", "dep"))
    if found is None:
        return open_.select(F.col("node").alias(node), F.lit(None).cast(open_.schema["node"].dataType).alias("cycle"), F.lit(0).cast("bigint").alias("n_members"))
    sizes = found.groupBy("cycle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    on = found.join(sizes, "cycle").select("node", "cycle", F.col("n").alias("n_members"))
    placed = open_.join(on, "node", "left")
    return placed.select(F.col("node").alias(node), "cycle", F.coalesce("n_members", F.lit(0)).alias("n_members"))


def _least_cycles(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, cycle) of the cycles whose least node is the least that they reach."""

    def lowered(now: DataFrame) -> DataFrame:
        # Many edges, one color for each node: the edges of a node that many read are salted.
        seen = salted_join(edges, now.withColumnRenamed("node", "dep"), "dep", spread_by="node", how="inner")
        return now.union(seen.select("node", "color")).groupBy("node").agg(F.min("color").alias("color"))

    def total(colors: DataFrame) -> int:
        return colors.agg(F.sum(F.xxhash64("node", "color").cast("decimal(38,0)"))).first()[0]

    colors = _settled(nodes.withColumn("color", F.col("node")), lowered, lambda a, b: total(a) == total(b))
    same = edges.join(colors, "node").join(colors.select(F.col("node").alias("dep"), F.col("color").alias("dep_color")), "dep")
    same = written_out(same.filter("color = dep_color").select("node", "dep"))

    def spread(now: DataFrame) -> DataFrame:
        reached = salted_join(same, now, "node", spread_by="dep", how="inner")
        return now.union(reached.select(F.col("dep").alias("node"), "cycle")).distinct()

    roots = colors.filter("node = color").select("node", F.col("color").alias("cycle"))
    return _settled(roots, spread, lambda a, b: a.count() == b.count())
