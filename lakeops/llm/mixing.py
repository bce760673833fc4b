"""Mixing sources to target weights: equal-token blocks given to sources and shards by Sainte-Lague apportionment."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.expressions import numbered

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 64
SHARD_ROWS = 4096
MOST_TIMES = 3


def apportion(votes: list[float] | np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients votes / (2 k + 1); ties go to the earlier party. No votes at all give no seats.

    Rounded shares come first, then single seats are added or taken back in quotient order, which ends at the same seats
    as giving them one by one.
    """
    votes = np.asarray(votes, float)
    total = votes.sum()
    given = np.zeros(len(votes), np.int64)
    if total <= 0 or seats <= 0:
        return given
    given = np.ceil(votes * (seats / total) - 0.5).astype(np.int64).clip(0)
    over = int(given.sum()) - seats
    if over > 0:
        heap = [(votes[k] / (2 * given[k] - 1), -k) for k in np.flatnonzero(given)]
        heapq.heapify(heap)
        for _ in range(over):
            _, k = heap[0]
            given[-k] -= 1
            if given[-k]:
                heapq.heapreplace(heap, (votes[-k] / (2 * given[-k] - 1), k))
            else:
                heapq.heappop(heap)
    elif over < 0:
        heap = [(-votes[k] / (2 * given[k] + 1), k) for k in range(len(votes))]
        heapq.heapify(heap)
        for _ in range(-over):
            _, k = heap[0]
            given[k] += 1
            heapq.heapreplace(heap, (-votes[k] / (2 * given[k] + 1), k))
    return given


def targets(sizes: list[int], weights: list[float], most_times: int = MOST_TIMES) -> list[float]:
    """Words for each source: the sum of all sizes shared by weight, no source above ``most_times`` its size.

    What a stopped source can't take is shared among the others by weight, until none is above its limit.
    """
    out = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), sum(sizes)
    while open_:
        weight = sum(weights[k] for k in open_)
        full = {k for k in open_ if left * weights[k] > most_times * sizes[k] * weight} if weight else set()
        if not full:
            for k in open_:
                out[k] = left * weights[k] / weight if weight else 0.0
            break
        for k in full:
            out[k] = float(most_times * sizes[k])
        left -= sum(most_times * sizes[k] for k in full)
        open_ -= full
    return out


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 9) -> DataFrame:
    """``docs`` with size, source_size, target and taken: the words of each document that the mix takes, repeats counted.

    Sources in code point order, null last, take the weights in turn. Each source's target becomes a number of equal
    blocks by highest quotients, which its shards get by the same rule; a shard's documents stand in seeded order, and
    its blocks are taken from the start of that order, passing over the shard again when the quota is above its size. A
    source whose target is too small for a block has that many words instead. So a source's taken words miss its target by
    about one block, none is left out for its size, and no document is taken more than three times.

    The driver holds one row for each source. A hot source has as many shards as its rows need. A null text has size 0;
    a null source is a source; equal rows are rows of their own; an empty table gives an empty table. Columns of the same
    names in ``docs`` are replaced.
    """
    keep = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    docs, own = numbered(docs, keep)
    id_, text, source = (own[c] for c in (id_col, text_col, source_col))
    # Rows of one id are told apart by their texts, so copies of an id spread as well.
    place = F.xxhash64(F.lit(seed), F.col(id_), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    base = docs.select("*", place.alias("__place"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    per = base.groupBy(F.col(source).alias("__source")).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    per = sorted(per, key=lambda r: (r["__source"] is None, r["__source"] or ""))
    sizes, share = [r["n"] for r in per], [weights[k % len(weights)] for k in range(len(per))]
    wanted = targets(sizes, share)
    seats = apportion(wanted, round(sum(wanted) / BLOCK_WORDS))
    # Blocks, or words of a source without one.
    given = [(int(q), BLOCK_WORDS) if q else (round(t), 1) for q, t in zip(seats, wanted)]
    plan = base.sparkSession.createDataFrame(
        [(r["__source"], r["n"], float(t), *q, max(1, -(-r["rows"] // SHARD_ROWS))) for r, t, q in zip(per, wanted, given)],
        "__source string, source_size long, target double, __seats long, __block long, __shards long",
    )
    # One row for each source, which the driver holds already: bounded, and no source's rows meet in one task.
    rows = base.join(F.broadcast(plan), base[source].eqNullSafe(plan["__source"]))
    rows = rows.withColumn("__shard", F.pmod("__place", F.col("__shards")))

    def quota(one: pd.DataFrame) -> pd.DataFrame:
        one = one.sort_values("of_shard")
        given = apportion(one["shard_size"].to_numpy(), int(one["seats"].iloc[0]))
        return pd.DataFrame({"of_source": one["of_source"], "of_shard": one["of_shard"], "shard_size": one["shard_size"], "quota": given})

    shards = rows.groupBy(F.col("__source").alias("of_source"), F.col("__shard").alias("of_shard")).agg(F.sum("size").alias("shard_size"), F.first("__seats").alias("seats"))
    quotas = shards.groupBy("of_source").applyInPandas(quota, "of_source string, of_shard long, shard_size long, quota long")
    order = Window.partitionBy("__source", "__shard").orderBy(F.xxhash64(F.lit(seed + 1), "__place"), "__place", F.col(id_).asc_nulls_first(), "size")
    rows = rows.withColumn("__end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(quotas, rows["__source"].eqNullSafe(quotas["of_source"]) & (rows["__shard"] == quotas["of_shard"]))
    want = F.least(F.col("quota") * F.col("__block"), F.col("shard_size") * MOST_TIMES)
    passes = F.when(F.col("shard_size") > 0, F.floor(want / F.col("shard_size"))).otherwise(0)
    rest = want - passes * F.col("shard_size")
    part = F.greatest(F.lit(0), F.least(F.col("__end"), rest) - (F.col("__end") - F.col("size")))
    return rows.select(*[F.col(n).alias(c) for c, n in own.items()], "size", "source_size", "target", (passes * F.col("size") + part).cast("long").alias("taken"))


def mixed_documents(mixed: DataFrame, columns: list[str], *, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The mix as documents: a row for each whole pass over a document, and one with the first words of it for the rest.

    A document of which nothing is taken has no row, unless it has no words at all: that is kept once.
    """
    given, own = numbered(mixed, mixed.columns)
    size, taken, text = (F.col(own[c]) for c in ("size", "taken", text_col))
    copies = F.greatest(F.when(size > 0, F.ceil(taken / size)).otherwise(1), F.lit(0)).cast("int")
    out = given.withColumn("copies", copies).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    left = taken - (F.col("copy") - 1) * size
    begin = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0), F.lit(1), F.greatest(left, F.lit(1)).cast("int")), "")
    cut = (size > 0) & (left < size)
    out = out.withColumn("put", F.when(cut, begin).otherwise(text))
    put = {text_col: F.col("put")}
    if chars_col in columns:
        put[chars_col] = F.when(cut, F.length("put").cast("long")).otherwise(F.col(own[chars_col]))
    return out.select(*[put.get(c, F.col(own[c])).alias(c) for c in columns])
