"""Exact top-k search: tiles of queries against shards of vectors, partial selection, merging in a tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vectors in one shard and queries in one tile at most; lists that one merge takes; queries whose lists travel together.
SHARD_ROWS, TILE_ROWS, FAN_IN, SLICE_ROWS = 16_384, 32_768, 16, 2_048
NONE = np.iinfo(np.int64).min
_PACKED = "tile long, shard long, n int, dim int, ids binary, numbers binary"
_LISTS = "tile long, slice long, shard long, n int, k int, query_ids binary, scores binary, ids binary"


def quantised(vector: Column, scale: float) -> Column:
    """Whole numbers floor(scale * x), x as double; null where the vector or a component is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.when(vector.isNotNull() & ~odd, F.transform(x, lambda v: F.floor(F.lit(scale) * v).cast("long")))


def _pack(groups: pd.DataFrame) -> pd.DataFrame:
    one = groups.sort_values("id", kind="stable")
    vectors = [np.asarray(v, np.int64) for v in one["vector"]]
    dim = max(map(len, vectors))
    matrix = np.zeros((len(vectors), dim), np.int64)
    for k, v in enumerate(vectors):
        matrix[k, : len(v)] = v
    row = {"tile": one["part"].iloc[0], "shard": one["part"].iloc[0], "n": len(one), "dim": dim, "ids": one["id"].to_numpy(np.int64).tobytes(), "numbers": matrix.tobytes()}
    return pd.DataFrame([row])


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows: in floating point where no sum can lose a digit, else in integers."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k first of each row by score, then smaller id, where ids rise along a row. NONE marks a place without score."""
    n, wide = scores.shape
    if wide > k:
        edge = ~np.partition(~scores, k - 1, axis=1)[:, k - 1 : k]
        above, level = scores > edge, scores == edge
        tie = level & (np.cumsum(level, axis=1) <= (k - above.sum(axis=1))[:, None])
        at = np.nonzero(above | tie)[1].reshape(n, k)
        scores, ids = np.take_along_axis(scores, at, 1), np.take_along_axis(ids, at, 1)
    order = np.lexsort((ids, ~scores), axis=1)
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _padded(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    more = k - scores.shape[1]
    return np.pad(scores, ((0, 0), (0, more)), constant_values=NONE), np.pad(ids, ((0, 0), (0, more)), constant_values=np.iinfo(np.int64).max)


def top_k(queries: DataFrame, vectors: DataFrame, k: int, id_col: str, vector_col: str, scale: float = 64.0) -> DataFrame:
    """For each query its ``k`` highest integer inner products over all other vectors: query_id, rank, id, score.

    Components become floor(scale * x). Ties go to the smaller id; fewer than ``k`` vectors give all. A row is left out
    where its id is null, or its vector is null or holds a null or non-finite component. Rows of one id count once, with
    the smallest vector; vectors of unequal lengths are compared over the components both have. Scores must fit 64 bits.
    An empty table gives no rows.

    Vectors are packed into shards and queries into tiles, both of bounded size; each pair of tile and shard is one
    product whose rows are cut to ``k`` at once. The short lists meet in a tree of ``FAN_IN`` at a time. Nothing is
    broadcast, and a task never holds more than a tile, a shard and one slice of products.
    """

    def cleaned(df: DataFrame) -> DataFrame:
        out = df.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("vector"))
        return out.where("id is not null and vector is not null").groupBy("id").agg(F.min("vector").alias("vector"))

    spark = vectors.sparkSession
    rows, asked = vectors.select(F.lit(1)).count(), queries.select(F.lit(1)).count()
    shards = max(-(-rows // SHARD_ROWS), min(2 * spark.sparkContext.defaultParallelism, -(-rows // 512)), 1)
    tiles = max(1, -(-asked // TILE_ROWS))

    def packed(df: DataFrame, parts: int) -> DataFrame:
        return df.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))).groupBy("part").applyInPandas(_pack, _PACKED)

    blocks = packed(cleaned(vectors), shards).withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    asks = packed(cleaned(queries), tiles).select(F.col("tile").alias("of"), F.col("n").alias("qn"), F.col("dim").alias("qdim"), F.col("ids").alias("qids"), F.col("numbers").alias("qnumbers"))
    pairs = blocks.join(asks, blocks["tile"] == asks["of"]).drop("of").repartition(max(1, min(shards * tiles, 4096)), "tile", "shard")

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                ids, qids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.qids, np.int64)
                dim = min(r.dim, r.qdim)
                b = np.frombuffer(r.numbers, np.int64).reshape(r.n, r.dim)[:, :dim]
                q = np.frombuffer(r.qnumbers, np.int64).reshape(r.qn, r.qdim)[:, :dim]
                for slice_, begin in enumerate(range(0, r.qn, SLICE_ROWS)):
                    found, step = [], 256
                    for at in range(begin, min(begin + SLICE_ROWS, r.qn), step):
                        own = qids[at : min(at + step, begin + SLICE_ROWS)]
                        scores = _product(q[at : at + len(own)], b)
                        scores[ids == own[:, None]] = NONE
                        s, i = _best(scores, np.broadcast_to(ids, scores.shape), k)
                        found.append(_padded(s, i, k))
                    s, i = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
                    yield pd.DataFrame([{"tile": r.tile, "slice": slice_, "shard": r.shard, "n": len(s), "k": k, "query_ids": qids[begin : begin + len(s)].tobytes(), "scores": s.tobytes(), "ids": i.tobytes()}])

    lists = pairs.mapInPandas(products, _LISTS)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[0]
        s = np.concatenate([np.frombuffer(x, np.int64).reshape(first["n"], k) for x in group["scores"]], axis=1)
        i = np.concatenate([np.frombuffer(x, np.int64).reshape(first["n"], k) for x in group["ids"]], axis=1)
        by_id = np.argsort(i, axis=1, kind="stable")
        s, i = _best(np.take_along_axis(s, by_id, 1), np.take_along_axis(i, by_id, 1), k)
        return pd.DataFrame([{"tile": first["tile"], "slice": first["slice"], "shard": first["shard"] // FAN_IN, "n": first["n"], "k": k, "query_ids": first["query_ids"], "scores": s.tobytes(), "ids": i.tobytes()}])

    left = shards
    while left > 1:
        lists = lists.withColumn("next", F.floor(F.col("shard") / FAN_IN)).groupBy("tile", "slice", "next").applyInPandas(lambda group: merge(group), _LISTS)
        left = -(-left // FAN_IN)

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                s, i = np.frombuffer(r.scores, np.int64), np.frombuffer(r.ids, np.int64)
                asked = np.repeat(np.frombuffer(r.query_ids, np.int64), k)
                there = s != NONE
                yield pd.DataFrame({"query_id": asked, "rank": np.tile(np.arange(1, k + 1, dtype=np.int32), r.n), "id": i, "score": s})[there]

    return lists.mapInPandas(opened, "query_id long, rank int, id long, score long")
