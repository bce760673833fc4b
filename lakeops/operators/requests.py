"""Asking a caller's function for many texts: one bad request fails alone, and none is asked twice."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.sinks.batches import put_batch

# The batch function travels with the plan, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Ask = Callable[[list[str]], list[str]]
ANSWERED = "digest string, answer string, error string"
# Characters of an error that are kept.
ERROR_CHARS = 1000


def ask_apart(fn: Ask, requests: list[str]) -> list[tuple[str | None, str | None]]:
    """(answer, error) of each request; a batch that fails is halved until the failing requests stand alone.

    For one bad request in n that is about 2 log2(n) calls more. As many answers as requests must come back.
    """
    found: list[tuple[str | None, str | None]] = [(None, None)] * len(requests)
    open_ = [(0, len(requests))] if requests else []
    while open_:
        a, b = open_.pop()
        try:
            answers = list(fn(requests[a:b]))
            if len(answers) != b - a:
                raise ValueError(f"{len(answers)} answers to {b - a} requests")
            found[a:b] = [(answer, None) for answer in answers]
        except Exception as error:
            if b - a == 1:
                found[a] = (None, str(error)[:ERROR_CHARS] or type(error).__name__)
            else:
                middle = (a + b) // 2
                open_ += [(a, middle), (middle, b)]
    return found


def request_digest(request: str = "request") -> Column:
    return F.sha2(F.col(request).cast("binary"), 256)


def with_answers(rows: DataFrame, fn: Ask, cache: str, *, request: str = "request", tasks: int | None = None, waves: int = 1) -> DataFrame:
    """``rows`` with ``answer`` and ``error``; null requests have neither.

    ``cache`` is a table of answers by the digest of their request: only requests
    it has no answer to are asked, each once however many rows have it. They go
    out in ``waves``, each kept in the cache before the next: what is lost with
    an executor is asked again, but for no more than one wave. Failed requests
    are asked again by the next call. ``tasks`` spreads a wave over that many.
    """
    spark = rows.sparkSession
    keyed = rows.drop("answer", "error").withColumn("_digest", request_digest(request))
    wanted = keyed.filter(F.col(request).isNotNull()).groupBy(F.col("_digest").alias("digest")).agg(F.first(request).alias("request"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = ask_apart(fn, batch["request"].tolist())
            yield pd.DataFrame({"digest": batch["digest"], "answer": pd.Series([a for a, _ in found], index=batch.index, dtype=object), "error": pd.Series([e for _, e in found], index=batch.index, dtype=object)})

    call = uuid.uuid4().hex
    for wave in range(waves):
        part = wanted.filter(F.pmod(F.xxhash64("digest"), F.lit(waves)) == wave)
        if spark.catalog.tableExists(cache):
            known = spark.table(cache).filter("error IS NULL").select("digest")
            part = part.join(known, "digest", "left_anti")
        if tasks:
            part = part.repartition(tasks, "digest")
        put_batch(spark, part.mapInPandas(run, ANSWERED), cache, f"{call} {wave:06d}")
    # Of several tries the one that was answered, else this call's.
    newest = F.max_by(F.struct("answer", "error"), F.struct(F.col("error").isNull(), F.col("batch").startswith(call)))
    answers = spark.table(cache).groupBy(F.col("digest").alias("_digest")).agg(newest.alias("_found"))
    joined = keyed.join(answers, "_digest", "left")
    return joined.select(*[c for c in keyed.columns if c != "_digest"], F.col("_found.answer").alias("answer"), F.col("_found.error").alias("error"))
