"""Jump consistent hashing: stable keys to shards without a ring table, and gapless slots within a shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the published generator: multiplier of the 64-bit congruence.
MULTIPLIER = 2862933555777941757
LOW = 0xFFFFFFFF
#: Steps walked for every key; the few keys that need more walk on to the shard count.
USUAL_STEPS = 64
#: Rows numbered by one task, and repeats of one row listed by one task.
BUCKET_ROWS, CHUNK_ROWS = 100_000, 4096


def _low_product(x: Column, factor: int) -> Column:
    """x times factor, modulo 2^32, for x below 2^32; no step leaves 63 bits."""
    return (x * F.lit(factor & 0xFFFF) + F.shiftleft((x * F.lit(factor >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)).bitwiseAND(F.lit(LOW))


def _step(shards: int):
    def walk(state: Column, _: Column) -> Column:
        hi, lo = state["hi"], state["lo"]
        first, second = lo * F.lit(MULTIPLIER & 0xFFFF), lo * F.lit((MULTIPLIER >> 16) & 0xFFFF)
        low = first + F.shiftleft(second.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
        high = F.shiftright(low, 32) + F.shiftright(second, 16) + _low_product(lo, MULTIPLIER >> 32) + _low_product(hi, MULTIPLIER & LOW)
        high = high.bitwiseAND(F.lit(LOW))
        moved = F.struct(
            state["jump"].alias("shard"),
            F.floor((state["jump"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double"))).cast("long").alias("jump"),
            high.alias("hi"),
            low.bitwiseAND(F.lit(LOW)).alias("lo"),
        )
        return F.when(state["jump"] < shards, moved).otherwise(state)

    return walk


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of a 64-bit key, by the published jump walk; a null key counts as 0.

    With one more shard a key stays where it is or goes to the new one.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.lit(-1).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("jump"),
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(F.lit(LOW)).alias("lo"),
    )
    usual = min(shards, USUAL_STEPS)
    done = F.aggregate(F.sequence(F.lit(1), F.lit(usual)), start, _step(shards))
    if shards > usual:  # a key needs about ln(shards) steps, in the worst case one for each shard
        rest = F.aggregate(F.sequence(F.lit(usual + 1), F.lit(shards)), done, _step(shards))
        done = F.when(done["jump"] < shards, rest).otherwise(done)
    return done["shard"].cast("int")


def stable_key(df: DataFrame, columns: list[str]) -> Column:
    """The 64-bit key of a row: one integer column as it is, anything else hashed; null columns are skipped by the hash."""
    if len(columns) == 1 and isinstance(df.schema[columns[0]].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return df[columns[0]]
    return F.xxhash64(*[df[c].cast("string") for c in columns])


def with_shards(df: DataFrame, key: list[str], shards: int, shard_col: str = "shard") -> DataFrame:
    """``df`` with the shard of each row; no shuffle. An existing column of that name is replaced.

    Rows of one key share a shard, null keys that of key 0; an empty table gives an empty table.
    """
    return df.withColumn(shard_col, jump_shard(stable_key(df, key), shards))


def number_slots(df: DataFrame, shard_col: str, slot_col: str, rows: int) -> DataFrame:
    """Rows numbered from 0 without gaps within each shard; ``rows`` is a row count to size the work by.

    Equal rows are counted before they are shuffled and listed again afterwards, in chunks that many tasks share, so a
    row repeated without end loads no task. A shard is numbered in buckets of about ``BUCKET_ROWS`` rows, and only the
    buckets' totals meet in one task.
    """
    columns = [c for c in df.columns if c != slot_col]
    own = {k: f"__{k}" for k in ("n", "bucket", "at", "base", "chunk")}
    if clash := set(own.values()) & set(columns):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    buckets = max(16, -(-rows // BUCKET_ROWS))
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(own["n"]))
    counted = counted.withColumn(own["bucket"], F.pmod(F.xxhash64(*columns), F.lit(buckets)))
    inside = Window.partitionBy(shard_col, own["bucket"]).orderBy(*[F.col(c).asc_nulls_first() for c in columns])
    placed = counted.withColumn(own["at"], F.sum(own["n"]).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(own["n"]))
    totals = counted.groupBy(shard_col, own["bucket"]).agg(F.sum(own["n"]).alias("__total"))
    before = Window.partitionBy(shard_col).orderBy(own["bucket"]).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        F.col(shard_col).alias("__shard"),
        F.col(own["bucket"]).alias("__of"),
        F.coalesce(F.sum("__total").over(before), F.lit(0)).alias(own["base"]),
    )
    placed = placed.join(bases, (F.col(shard_col) == F.col("__shard")) & (F.col(own["bucket"]) == F.col("__of")))
    once = placed.withColumn(own["chunk"], F.explode(F.sequence(F.lit(0).cast("long"), F.col(own["n"]) - 1, F.lit(CHUNK_ROWS).cast("long"))))
    last = F.least(F.col(own["n"]), F.col(own["chunk"]) + CHUNK_ROWS) - 1
    slots = F.explode(F.sequence(F.col(own["chunk"]), last)).alias("__copy")
    listed = once.select("*", slots)
    return listed.select(*columns, (F.col(own["base"]) + F.col(own["at"]) + F.col("__copy")).cast("long").alias(slot_col))


def shard_manifest(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where each document goes: id, size in UTF-8 bytes plus 1, text checksum, law, shard, slot, shard with one more.

    Law ``key``: the id and the shard count decide, so appending a shard moves rows only into it. A null or empty text has
    size 1, a null text no checksum; a null id counts as key 0. Equal rows are kept, each with a slot of its own; other
    columns are not looked at. An empty table gives an empty table.
    """
    base = docs.select(
        F.col(id_col),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col(text_col).cast("binary")).cast("long").alias("text_crc32"),
    )
    key = stable_key(base, [id_col])
    base = base.withColumns({"law": F.lit("key"), "shard": jump_shard(key, shards), "grown_shard": jump_shard(key, shards + 1)})
    rows = docs.select(F.lit(1)).count()
    return number_slots(base, "shard", "slot", -(-rows // shards))
