"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns, and the least length of a match (for ``assign``, of its value).
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: A match of a run pattern is the longest run, so short runs can be passed over by the pattern itself.
LONG_RUNS = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
#: What the models read: runs that could be a key. Only runs of this length are judged.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Character classes of the models: a letter, digit or sign each for itself.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET)
_WHOLE = f"^[{ALPHABET.replace('-', '')}-]{{2,}}$"
#: Words whose spelling trains the ordinary model: letters, with a digit or two at most at the end.
IDENTIFIER = r"[A-Za-z][A-Za-z_-]{3,}[0-9]{0,2}"
#: A run is a secret when its mean log-likelihood ratio for each step is above 0 and this many spreads above that of
#: ordinary words, both from words that did not train; one word in FOLDS is held out by its checksum.
SPREADS, FOLDS = 4.0, 5


def _spans(text: Column, pattern: str, group: int, least: int, kind: str) -> Column:
    """Spans of leftmost matches that do not overlap, in code points; the gaps between them come from a split at the same pattern."""
    whole, value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    # One entry for each match: the gap before it, the match, and the length that decides.
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("match"), value.alias("value"))
    empty = F.array().cast("array<struct<start:int,end:int,kind:string,value:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def add(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["gap"])
        end = begin + F.length(part["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), part["value"].alias("value"))
        kept = F.when(F.length(part["value"]) >= least, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.alias("at"), kept.alias("found"))

    found = F.aggregate(F.filter(parts, lambda p: p["match"].isNotNull()), start, add)["found"]
    return F.when(text.rlike(pattern), found).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds, each with kind, start, end (exclusive) and the value that was found."""
    return F.concat(
        _spans(text, ASSIGN, 1, LEAST["assign"], "assign"),
        _spans(text, LONG_RUNS["access"], 0, LEAST["access"], "access"),
        _spans(text, LONG_RUNS["hex"], 0, LEAST["hex"], "hex"),
    )


def _steps(value: Column) -> Column:
    """Pairs of neighbouring characters as one number each: SIZE * first + second."""
    at = lambda k: F.instr(F.lit(ALPHABET), F.substr(value, k, F.lit(1))) - 1
    return F.transform(F.sequence(F.lit(1), F.length(value) - 1), lambda k: at(k) * SIZE + at(k + 1))


def counted(samples: DataFrame) -> DataFrame:
    """Distinct values with their number n; samples that are counted already stay as they are."""
    return samples if "n" in samples.columns else samples.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def held_out(value: Column) -> Column:
    """Words that no model is trained on."""
    return F.crc32(value.cast("binary")) % FOLDS == 0


def calibrated(model: list[float], identifiers: DataFrame) -> tuple[float, float]:
    """Mean log-likelihood ratio of a step of ordinary words, and how far a word strays from it for the root of its steps.

    A word of n steps strays by its share of 1 / sqrt(n), so one pair of numbers serves words of every length. Only they
    reach the driver. Each distinct word counts once; without words both are 0.
    """
    inside = counted(identifiers).where(F.col("value").rlike(_WHOLE))
    each = inside.select((F.length("value") - 1).cast("double").alias("steps"), log_ratio(F.col("value"), model).alias("ratio"))
    sums = each.agg(F.sum("steps").alias("n"), F.sum(F.col("steps") * F.col("ratio")).alias("s"), F.sum(F.col("steps") * F.col("ratio") ** 2).alias("q"), F.count(F.lit(1)).alias("words")).first()
    if not sums["words"]:
        return 0.0, 0.0
    mean = sums["s"] / sums["n"]
    # Steps times squared distance, on average over words: a word's mean over n steps has 1 / n of a step's variance.
    return mean, math.sqrt(max(0.0, (sums["q"] - mean * sums["s"]) / sums["words"]))


def train(random_strings: DataFrame, identifiers: DataFrame) -> list[float]:
    """Log-likelihood ratio of each step under the two models, as SIZE * SIZE numbers; both inputs have a column value.

    First-order chains with add-one smoothing. Strings are counted before they are cut into steps, and only the SIZE *
    SIZE counts of each side reach the driver. No samples on either side leave that model uniform.
    """

    def counts(samples: DataFrame) -> list[float]:
        inside = samples.where(F.col("value").rlike(_WHOLE))
        each = counted(inside).select(F.explode(_steps(F.col("value"))).alias("step"), "n")
        out = [0.0] * (SIZE * SIZE)
        for step, n in each.groupBy("step").agg(F.sum("n")).collect():
            out[step] = float(n)
        return out

    def logs(found: list[float]) -> list[float]:
        rows = [sum(found[a * SIZE : (a + 1) * SIZE]) for a in range(SIZE)]
        return [math.log((found[a * SIZE + b] + 1) / (rows[a] + SIZE)) for a in range(SIZE) for b in range(SIZE)]

    return [r - o for r, o in zip(logs(counts(random_strings)), logs(counts(identifiers)))]


def log_ratio(value: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio for each step; above 0, the string looks random."""
    table = F.array(*[F.lit(round(x, 6)) for x in model])
    total = F.aggregate(_steps(value), F.lit(0.0), lambda sum_, step: sum_ + F.get(table, step))
    return total / F.greatest(F.length(value) - 1, F.lit(1))


def labelled_samples(found: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Random strings and ordinary identifiers of a scanned table: values of fixed spans with a digit, and all other words.

    ``found`` has the text and its base spans in ``base``. A document gives each of its words once.
    """
    values = found.select(F.explode(F.col("base.value")).alias("value")).where(F.col("value").rlike("[0-9]"))
    every = F.regexp_extract_all(F.col(text_col), F.lit(rf"(?<![A-Za-z0-9+/_=-]){IDENTIFIER}(?![A-Za-z0-9+/_=-])"), F.lit(0))
    return values, found.select(F.explode(F.array_except(every, F.col("base.value"))).alias("value"))


def scan(docs: DataFrame, model: list[float], text_col: str = "text", ordinary: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, end, kind, value) in order of start, then kind as listed.

    ``spans`` also has kind ``markov``: runs of key characters, of whatever kinds, outside every base span, whose mean
    log-likelihood ratio is above 0 and SPREADS spreads above that of ``ordinary`` words (see calibrated). A null or empty text has no spans. Columns of the same names are
    replaced; equal rows are kept.
    """
    rank = lambda kind: F.when(kind == "assign", 0).when(kind == "access", 1).when(kind == "hex", 2).otherwise(3)

    def ordered(spans: Column) -> Column:
        keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))
        return F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))

    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("base", ordered(base_spans(text)))
    runs = _spans(text, CANDIDATE, 0, 16, "markov")
    free = F.filter(
        runs,
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        & (log_ratio(s["value"], model) > F.greatest(F.lit(0.0), F.lit(ordinary[0]) + F.lit(SPREADS * ordinary[1]) / F.sqrt(F.length(s["value"]) - 1))),
    )
    return out.withColumn("spans", ordered(F.concat("base", free)))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
