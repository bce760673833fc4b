"""Connected components of a link table, as joins and groupings; each round is kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import new_path, remove_path


def _round(links: DataFrame) -> DataFrame:
    """Links (a, b), a above b, moved towards the least node.

    First each link's lower end gives way to its own least neighbour, then all lower ends of a node are linked to the
    least of them. Least neighbours are partial minima; a hot lower end is one side of a join that adaptive execution splits.
    """
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), "m")
    lowered = links.join(least, links["b"] == least["of"], "left").select("a", F.coalesce("m", "b").alias("b"))
    root = lowered.groupBy("a").agg(F.min("b").alias("m"))
    both = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")), F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("l")
    return lowered.join(root, "a").select(both).select(F.col("l.x").alias("a"), F.col("l.y").alias("b")).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node it is linked with, for every node of ``links`` (columns a, b).

    Rounds go on until nothing changes. Loops and repeated links don't matter; no links give no rows.
    """
    spark = links.sparkSession
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    state = path = None
    while True:
        last, path = path, new_path(spark)
        now.write.parquet(path)
        if last:
            remove_path(spark, last)
        held = spark.read.schema(now.schema).parquet(path)
        # Each change lowers an end of a link, so equal counts and hashes mean that nothing has moved.
        seen = tuple(held.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == state:
            break
        state, now = seen, _round(held)
    roots = held.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return held.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
