"""Line deduplication over content-defined chunks of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.expressions import let, numbered
from lakeops.session import written_out

#: A chunk ends after a line when the rolling hash of the last WINDOW line hashes falls on 0 of DIVISOR: on average after
#: DIVISOR lines. Only chunks of LEAST_LINES lines or more are looked at.
WINDOW, DIVISOR, LEAST_LINES = 2, 2, 2
#: Factor of the rolling hash, modulo a prime that keeps products within 63 bits; fixed values.
FACTOR, PRIME = 1_000_003, 2_147_483_647


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _chunks(lines: Column) -> Column:
    """Start (from 0) and number of lines of each chunk."""
    count = F.size(lines)

    def rolling(hashes: Column, k: Column) -> Column:
        """Hash of the WINDOW lines up to line k, counted from 1; lines before the first count as 0."""
        value = F.lit(0).cast("long")
        for back in range(WINDOW - 1, -1, -1):
            value = (value * FACTOR + F.coalesce(F.get(hashes, k - 1 - back), F.lit(0).cast("long"))) % PRIME
        return value

    def chunk(ends: Column, end: Column, k: Column) -> Column:
        start = F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1))
        return F.struct(start.alias("start"), (end - start).alias("lines"))

    hashes = F.transform(lines, lambda x: F.pmod(F.xxhash64(x), F.lit(PRIME)))
    ends = let(hashes, lambda h: F.filter(F.sequence(F.lit(1), count), lambda k: (k == count) | (F.xxhash64(rolling(h, k)) % DIVISOR == 0)))
    return let(ends, lambda e: F.transform(e, lambda end, k: chunk(e, end, k)))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated chunks of lines cut out of the text, and ``removed_lines``, how many lines that were.

    The lines of a text are cut into chunks where a rolling hash of line hashes says so, so an inserted line shifts no
    boundary but its own. A chunk of two lines or more that stands in several places, in one document or many, stays at
    the first by id and position and goes everywhere else. Hashes only find the chunks to compare: what goes has the same
    bytes as what stays.

    A null text stays null and an empty text empty; a single line is never cut. Rows of one id and text are one document:
    they are treated alike, and none is a repeat of the other. Null ids come first. An empty table gives an empty table,
    and a column ``removed_lines`` is replaced.
    """
    text = F.col(text_col)
    key = [F.col(id_col).alias("__id"), F.xxhash64(text).alias("__mark")]
    base = docs.where(text.contains("\n")).select(*key, _lines(text).alias("lines"))
    chunk = F.explode(_chunks(F.col("lines"))).alias("chunk")
    body = F.array_join(F.slice("lines", F.col("chunk.start") + 1, F.col("chunk.lines")), "\n")
    every = base.select("__id", "__mark", "lines", chunk).where(F.col("chunk.lines") >= LEAST_LINES)
    every = every.select("__id", "__mark", F.col("chunk.start").alias("start"), F.col("chunk.lines").alias("n"), body.alias("body")).withColumn("hash", F.xxhash64("body"))
    # Hashes alone are shuffled to find what repeats. What repeats grows with the documents: joins are shuffled at every size.
    often = every.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select(F.col("hash").alias("of"))
    shared = written_out(every.join(written_out(often).hint("merge"), F.col("hash") == F.col("of"), "left_semi"))
    first = shared.groupBy("hash", "body").agg(F.min(F.struct("__id", "__mark", "start")).alias("first"))
    again = shared.join(first.select(F.col("hash").alias("h"), F.col("body").alias("b"), "first"), (F.col("hash") == F.col("h")) & (F.col("body") == F.col("b")))
    again = again.where(~F.struct("__id", "__mark", "start").eqNullSafe(F.col("first")))
    return _without(docs, again.select("__id", "__mark", "start", "n"), id_col, text_col)


def _without(docs: DataFrame, again: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the lines of ``again``: __id and __mark of a document, start and number of lines n, which may overlap."""
    docs, own = numbered(docs, [c for c in docs.columns if c != "removed_lines"])
    text = F.col(own[text_col])
    # A document's own repeats: bounded by the document.
    cut = written_out(again.distinct().groupBy("__id", "__mark").agg(F.collect_set(F.struct("start", "n")).alias("cut")))
    cut = cut.select(F.col("__id").alias("__of"), F.col("__mark").alias("__m"), "cut")
    out = docs.join(cut.hint("merge"), F.col(own[id_col]).eqNullSafe(F.col("__of")) & (F.xxhash64(text) == F.col("__m")), "left")
    gone = F.array_distinct(F.flatten(F.transform("cut", lambda c: F.sequence(c["start"], c["start"] + c["n"] - 1))))
    each = F.transform(_lines(text), lambda x, k: F.struct(k.alias("k"), x.alias("line")))
    left = let(F.map_from_arrays(gone, F.transform(gone, lambda _: F.lit(True))), lambda out: F.filter(each, lambda s: ~F.map_contains_key(out, s["k"])))
    put = F.when(F.col("cut").isNull(), text).otherwise(F.array_join(F.transform(left, lambda s: s["line"]), "\n"))
    removed = F.coalesce(F.size(gone), F.lit(0)).cast("long")
    return out.select(*[(put if c == text_col else F.col(n)).alias(c) for c, n in own.items()], removed.alias("removed_lines"))


def without_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated runs of LEAST_LINES lines or more cut out of the text, whatever stands around them.

    Every LEAST_LINES neighbouring lines are compared with all others, so a repeat is found wherever a chunk would end
    and its matches cover the whole run, as if each were grown until the lines differ. Such lines stay at their first
    place by id and position and go everywhere else, except where a repeat overlaps its own first place. A line goes
    only for an equal line at an earlier place, so one of each stays. Lines are the same by the SHA-256 of their bytes.

    Nulls, empty texts, single lines, rows of one id and text, empty tables and ``removed_lines`` are as for
    :func:`without_repeats`.
    """
    text = F.col(text_col)
    base = docs.where(text.contains("\n")).select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__mark"), _lines(text).alias("lines"))
    starts = F.sequence(F.lit(0), F.size("lines") - LEAST_LINES)
    digest = lambda k: F.unhex(F.sha2(F.array_join(F.slice("lines", k + 1, LEAST_LINES), "\n").cast("binary"), 256))
    runs = F.when(F.size("lines") >= LEAST_LINES, F.transform(starts, lambda k: F.struct(k.alias("start"), digest(k).alias("digest"))))
    every = base.select("__id", "__mark", F.explode(runs).alias("run")).select("__id", "__mark", "run.start", "run.digest")
    # Digests alone are shuffled, texts are not. What repeats grows with the documents: joins are shuffled at every size.
    place = F.struct("__id", "__mark", "start")
    first = every.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(~F.col("first").eqNullSafe(F.col("last")))
    first = written_out(first.select(F.col("digest").alias("of"), "first"))
    again = every.join(first.hint("merge"), F.col("digest") == F.col("of"))
    own = F.col("__id").eqNullSafe(F.col("first.__id")) & (F.col("__mark") == F.col("first.__mark")) & (F.col("start") < F.col("first.start") + LEAST_LINES)
    return _without(docs, again.where(~own).select("__id", "__mark", "start", F.lit(LEAST_LINES).alias("n")), id_col, text_col)
