"""Toxicity by compression distance: windows of a text compressed with dictionaries of ordinary and of toxic text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakeops.llm.words import NON_ALNUM, SPACES, Hasher, mix, runs
from lakeops.session import written_out

#: Labelled rows that the models are fitted on, at most: a fixed bound, chosen by hash. Their texts are used whole.
TOXIC_ROWS, ORDINARY_ROWS = 3_000, 3_000
#: Bytes of text in a window, bytes of the dictionaries, the level of compression.
WINDOW, ORDINARY_BYTES, TOXIC_BYTES, LEVEL = 48, 65_536, 8_192, 3
#: Bytes of the pieces of text that are counted, and random labellings that tell chance from toxic text.
GRAM, SHUFFLES = 4, 3
#: A piece in fewer rows than this is not counted.
LEAST_ROWS = 3
#: Words whose runs tell copies of a text.
COPY_WORDS = 3
#: Coded bytes saved from which a window counts.
SAVED = (4, 6)
FOLDS = 5


def held_out(id_: Column) -> Column:
    """Rows that nothing is learnt from: those whose id's checksum is divisible by FOLDS, and rows without an id."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def normal(text: str | None) -> bytes:
    """Lower case, white space as single spaces, one at either end."""
    return b" " + " ".join((text or "").lower().split()).encode() + b" "


class Coder:
    """Texts in a code of two bytes for each byte: the byte, and a hash of its word up to it.

    So two pieces of text are equal in code only where their words begin alike, and a dictionary's matches, as those of
    text that people read, hold on to the beginnings of words.
    """

    def __init__(self) -> None:
        self.words = Hasher(NON_ALNUM, fold=False)

    def prefixes(self, raw: bytes) -> np.ndarray:
        """For each byte the hash of what stands from the last separator to it, in one byte; in slices of bounded size."""
        out = [np.zeros(0, np.uint8)]
        for _, data in self.words._slices(raw):
            power, inverse = self.words._powers(len(data) + 1)
            at = np.arange(len(data))
            last = np.maximum.accumulate(np.where(self.words.separator[data], at, 0))
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.words.value[data] * power[: len(data)], out=total[1:])
            out.append((mix((total[at + 1] - total[last]) * inverse[last]) >> np.uint64(56)).astype(np.uint8))
        return np.concatenate(out)

    def code(self, raw: bytes) -> bytes:
        out = np.empty(2 * len(raw), np.uint8)
        out[0::2], out[1::2] = np.frombuffer(raw, np.uint8), self.prefixes(raw)
        return out.tobytes()

    def windows(self, raw: bytes) -> list[bytes]:
        """The whole text, coded, in pieces of about WINDOW bytes of text, cut before a space where there is one."""
        coded, out, at = self.code(raw), [], 0
        while at < len(raw):
            end = min(len(raw), at + WINDOW)
            if end < len(raw):
                cut = raw.rfind(b" ", at + 1, end)
                end = cut if cut > at else end
            out.append(coded[2 * at : 2 * end])
            at = end
        return out

    def grams(self, raw: bytes) -> np.ndarray:
        """Every GRAM bytes of the text with the hash of their first byte, as numbers."""
        data = np.frombuffer(raw, np.uint8).astype(np.int64)
        n = len(data) - GRAM + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        out = self.prefixes(raw)[:n].astype(np.int64)
        for k in range(GRAM):
            out |= data[k : k + n] << 8 * (k + 1)
        return out

    def marked(self, raw: bytes, marks: np.ndarray) -> list[bytes]:
        """The coded stretches of the text that marked grams cover; ``marks`` are sorted."""
        grams = self.grams(raw)
        place = np.minimum(np.searchsorted(marks, grams), max(0, len(marks) - 1))
        hit = np.flatnonzero(marks[place] == grams) if len(marks) and len(grams) else []
        change = np.zeros(len(raw) + 1, np.int64)
        np.add.at(change, hit, 1)
        np.add.at(change, np.asarray(hit, np.int64) + GRAM, -1)
        inside = np.diff(np.r_[0, (np.cumsum(change)[:-1] > 0).astype(np.int8), 0])
        coded = self.code(raw)
        return [coded[2 * a : 2 * b] for a, b in zip(np.flatnonzero(inside == 1), np.flatnonzero(inside == -1))]


def _compressor(dictionary: bytes) -> zstd.ZstdCompressor:
    params = zstd.ZstdCompressionParameters.from_level(
        LEVEL, source_size=2 * WINDOW, dict_size=ORDINARY_BYTES + TOXIC_BYTES, format=zstd.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    if not dictionary:
        return zstd.ZstdCompressor(compression_params=params)
    return zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(dictionary, dict_type=zstd.DICT_TYPE_RAWCONTENT), compression_params=params)


def trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """A zstandard dictionary of the samples; where they are too few to train one, the samples themselves."""
    if not samples:
        return b""
    try:
        return zstd.train_dictionary(size, samples, k=segment, d=6).as_bytes()
    except zstd.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


class Distance:
    """What each window saves when the dictionary has toxic text as well, summed up for a whole text."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.dictionaries = ordinary, toxic
        self.plain, self.both = _compressor(ordinary), _compressor(ordinary + toxic)
        self.coder = Coder()

    def features(self, text: str | None) -> list[float]:
        pieces = self.coder.windows(normal(text))
        plain, both = self.plain.compress, self.both.compress
        saved = np.fromiter((len(plain(w)) - len(both(w)) for w in pieces), np.float64, len(pieces))
        top = np.sort(saved)[::-1][:3]
        some, many = ((saved >= s) for s in SAVED)
        return [top[0], top.mean(), saved.mean(), some.mean(), many.mean(), np.log(len(saved)), some.sum() / np.sqrt(len(saved))]


class Calibration:
    """Logistic regression of the label on the features, by Newton steps."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, ridge: float = 1e-3) -> None:
        self.mean, self.scale = features.mean(axis=0), features.std(axis=0) + 1e-9
        x = self._scaled(features)
        self.weight = np.zeros(x.shape[1])
        for _ in range(40):
            p = self._sigmoid(x)
            step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(x.shape[1]), x.T @ (labels - p) - ridge * self.weight)
            self.weight += step
            if np.abs(step).max() < 1e-9:
                break

    def _scaled(self, features: np.ndarray) -> np.ndarray:
        return np.c_[np.ones(len(features)), (features - self.mean) / self.scale]

    def _sigmoid(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weight, -30, 30)))

    def score(self, features: np.ndarray) -> np.ndarray:
        return self._sigmoid(self._scaled(features))


def _sample(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    order = [F.xxhash64(F.col("id").cast("string")), "id"]
    return known.where("toxic = 1").orderBy(*order).limit(TOXIC_ROWS).union(known.where("toxic = 0").orderBy(*order).limit(ORDINARY_ROWS))


def _by_rows(rows: DataFrame, schema: str, each) -> DataFrame:
    """What ``each(coder, *columns)`` yields for every row, as rows."""
    fields = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder()
        for batch in batches:
            for values in zip(*(column.to_pylist() for column in batch.columns)):
                columns = each(coder, *values)
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

    return rows.mapInArrow(run, schema)


def without_copies(sample: DataFrame) -> DataFrame:
    """``sample`` (id, toxic, text) with one row of each group of copies, told by the least hash of their runs of words."""
    words = Hasher(SPACES)

    def family(coder: Coder, id_: str, toxic: int, text: str | None) -> list:
        _, _, hashes = words.spans(normal(text))
        _, found = runs(hashes, np.zeros(len(hashes), np.int64), COPY_WORDS)
        return [[id_], [toxic], [int(found.min() >> np.uint64(1)) if len(found) else 0], [text]]

    found = _by_rows(sample.select(F.col("id").cast("string"), F.col("toxic"), "text"), "id string, toxic int, family long, text string", family)
    first = found.groupBy("toxic", "family").agg(F.min(F.struct("id", "text")).alias("first"))
    return first.select("toxic", "family", "first.text")


def toxic_grams(rows: DataFrame) -> DataFrame:
    """Grams that stand in more toxic rows of ``rows`` (toxic, family, text) than chance allows.

    The measure is twice the log-likelihood ratio of a gram's rows being toxic as often as they are, against the share of
    toxic rows. The same rows under random labels, as many of them toxic, tell how far chance goes: what is above all of
    their grams is kept. So the limit follows the sample's size, with nothing to set.
    """
    labels = ["toxic", *(f"l{k}" for k in range(SHUFFLES))]
    sizes = rows.agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n")).first()
    share = (sizes["a"] or 0) / max(1, sizes["n"])
    # The same share of the rows by a hash of each: the fraction of the hash that lies below it.
    chance = [(F.pmod(F.xxhash64(F.lit(k), "family", "toxic"), F.lit(1 << 30)) < int(share * (1 << 30))).cast("int").alias(f"l{k}") for k in range(SHUFFLES)]
    labelled = rows.select("toxic", *chance, "text")
    totals = labelled.agg(*[(F.sum(c) / F.count(F.lit(1))).alias(c) for c in labels]).first()

    def grams(coder: Coder, *values) -> list:
        own = np.unique(coder.grams(normal(values[-1])))
        return [own, *(np.full(len(own), v, np.int32) for v in values[:-1])]

    schema = "gram long, " + ", ".join(f"{c} int" for c in labels)
    counted = _by_rows(labelled, schema, grams).groupBy("gram").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in labels])

    def ratio(label: str) -> Column:
        s = totals[label] or 0.0
        a, n = F.col(label), F.col("n")
        if not 0 < s < 1:
            return F.lit(0.0)
        part = lambda x, expected: F.when(x > 0, x * F.ln(x / expected)).otherwise(0.0)
        return F.when(a > n * s, 2 * (part(a, n * s) + part(n - a, n * (1 - s)))).otherwise(0.0)

    scored = written_out(counted.where(F.col("n") >= LEAST_ROWS).select("gram", ratio("toxic").alias("toxic"), F.greatest(*map(ratio, labels[1:])).alias("chance")))
    limit = scored.agg(F.max("chance")).first()[0]
    return scored.where(F.col("toxic") > (limit or 0.0)).select("gram")


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[Distance, Calibration] | None:
    """Dictionaries and calibration from a bounded sample of labelled rows; None without rows of either label.

    The ordinary dictionary is trained on all windows of the ordinary rows. The toxic one is trained on the text of the
    toxic rows less what ordinary rows have as often: the stretches covered by grams that stand in toxic rows beyond
    chance. It is used after the ordinary one, so a window is shorter with it only for what toxic text adds. Copies of a
    text count once in both. The driver holds the sample's windows, a number of rows times their length.
    """
    # TOXIC_ROWS + ORDINARY_ROWS ids: a bounded broadcast, so the texts of other rows stay where they are.
    sample = docs.join(F.broadcast(_sample(labels, id_col, label_col)), F.col(id_col) == F.col("id")).select("id", "toxic", F.col(text_col).alias("text"))
    sample = written_out(sample)
    kinds = {r["toxic"] for r in sample.select("toxic").distinct().collect()}
    if kinds != {0, 1}:
        return None
    single = written_out(without_copies(sample))
    marks = np.array(sorted(r["gram"] for r in toxic_grams(single).collect()), np.int64)

    def stretches(coder: Coder, text: str | None) -> list:
        return [coder.marked(normal(text), marks)]

    def windows(coder: Coder, text: str | None) -> list:
        return [coder.windows(normal(text))]

    def pieces(label: int, each) -> list[bytes]:
        """Distinct pieces of the rows of a label in one order, as often as they occur, so that every fit gives the same."""
        found = _by_rows(single.where(F.col("toxic") == label).select("text"), "piece binary", each)
        counted = found.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).collect()
        every = [bytes(r["piece"]) for r in sorted(counted, key=lambda r: bytes(r["piece"])) for _ in range(r["n"])]
        return [every[k] for k in np.random.default_rng(5).permutation(len(every))]

    toxic = trained(pieces(1, stretches), TOXIC_BYTES, 24)
    distance = Distance(trained(pieces(0, windows), ORDINARY_BYTES, 32), toxic)
    rows = _features(sample.select("id", "toxic", "text"), distance).orderBy("id", "features").collect()
    return distance, Calibration(np.array([r["features"] for r in rows]), np.array([r["toxic"] for r in rows], float))


def _features(rows: DataFrame, distance: Distance) -> DataFrame:
    """The columns of ``rows`` but the last, a text, and its features."""
    ordinary, toxic = distance.dictionaries
    fields = T.StructType([*rows.schema.fields[:-1], *T.StructType.fromDDL("features array<double>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Distance(ordinary, toxic)
        for batch in batches:
            found = pa.array([own.features(t) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], fields.names)

    return rows.mapInArrow(run, fields)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row for each document: id, held_out, score from 0 to 1, predicted (1 from 0.5 on).

    Every whole text is cut into windows, coded so that words hold together (see Coder), and each is compressed with the
    dictionary of ordinary text and with that of ordinary and toxic text; a calibrated regression turns the bytes saved into the score. Only the text enters it. Labels of rows
    with ``held_out`` are not looked at; several labels of one id count as the highest, null labels not at all.

    A null or empty text is scored as one window without words. A null id is held out. Without labels of both kinds every
    score is 0. Equal rows are kept, an empty table gives an empty table, and other columns are not looked at.
    """
    model = fit(docs, labels, id_col, text_col, label_col)
    base = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    if model is None:
        return base.select(id_col, "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    distance, calibration = model
    scale = [float(w / s) for w, s in zip(calibration.weight[1:], calibration.scale)]
    start = float(calibration.weight[0] - (calibration.weight[1:] * calibration.mean / calibration.scale).sum())
    found = _features(base, distance)
    logit = sum((F.col("features")[k] * w for k, w in enumerate(scale)), F.lit(start))
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), logit))))
    return found.select(id_col, "held_out", score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
