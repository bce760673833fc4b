"""Near-duplicates by DartMinHash: sparse weighted signatures, banded joins, exact checks, connected classes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.graph import components
from lakeops.llm.words import Hasher, grouped, mix, runs, weighted
from lakeops.session import written_out

WORDS, SIMILARITY = 5, 0.8
#: 25 bands of 5 coordinates miss a pair of similarity 0.8 once in 20,000 times.
BANDS, BAND_ROWS = 25, 5
COORDINATES = BANDS * BAND_ROWS
#: Members, and elements of all members, that one tile holds.
TILE_MEMBERS, TILE_ELEMENTS = 256, 250_000
_POISSON = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(20)])


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _throw(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, limit: np.ndarray, out: np.ndarray) -> None:
    """Throw the darts of all elements with a rank below their owner's ``limit``; keep the earliest for each coordinate.

    The plane of weight and rank over an element is cut into cells of area 1: weight bands [0, 1), [1, 2), [2, 4), ... and
    strips of height 1 / width. The hash of element and cell gives the number of its darts (Poisson) and their places, so
    equal elements meet equal darts whatever set they stand in.
    """
    low, width, level = 0.0, 1.0, 0
    while len(element):
        strips = np.ceil(limit[owner] * width).astype(np.int64)
        cell_of = np.repeat(np.arange(len(element)), strips)
        strip = np.arange(len(cell_of)) - np.repeat(np.cumsum(strips) - strips, strips)
        cell = mix(element[cell_of] ^ mix(strip.astype(np.uint64) * np.uint64(64) + np.uint64(level + 1)))
        darts = np.searchsorted(_POISSON, _unit(cell), side="right")
        dart_of = np.repeat(np.arange(len(cell)), darts)
        number = np.arange(len(dart_of)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(cell[dart_of] + (number.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        of = cell_of[dart_of]
        rank = (strip[dart_of] + _unit(dart)) / width
        place = mix(dart ^ np.uint64(0xD1B54A32D192ED03))
        inside = rank < limit[owner[of]]
        if level:
            inside &= low + _unit(place) * width < weight[of]
        of, dart, place, rank = of[inside], dart[inside], place[inside], rank[inside]
        coordinate = ((mix(place) >> np.uint64(32)) * np.uint64(COORDINATES)) >> np.uint64(32)
        packed = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (dart & np.uint64(0xFFFFFFFF))
        np.minimum.at(out.reshape(-1), owner[of] * COORDINATES + coordinate.astype(np.int64), packed)
        low, width, level = (1.0, 1.0, 1) if level == 0 else (low + width, width * 2, level + 1)
        more = weight > low
        owner, element, weight = owner[more], element[more], weight[more]


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, owners: int) -> np.ndarray:
    """Signature of each owner, one 64-bit number for each coordinate; all ones for an owner without elements.

    Two sets agree in a coordinate with a probability of their weighted Jaccard similarity. Darts are thrown up to a rank
    that leaves a coordinate empty now and then; sets with an empty one are thrown again up to twice that rank.
    """
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((owners, COORDINATES), empty, np.uint64)
    total = np.bincount(owner, weights=weight, minlength=owners)
    limit = COORDINATES * (math.log(COORDINATES) + 3) / np.maximum(total, 1)
    open_ = total > 0
    while open_.any():
        own = open_[owner]
        _throw(owner[own], element[own], weight[own], limit, out)
        open_ &= (out == empty).any(axis=1)
        out[open_] = empty
        limit = np.where(open_, limit * 2, limit)
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """One number for each band of each signature."""
    value = found & np.uint64(0xFFFFFFFF)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(found), BANDS)).copy()
    for k in range(BAND_ROWS):
        out = mix(out ^ (value[:, k::BAND_ROWS][:, :BANDS] + np.uint64(k + 1)))
    return out


def _elements(hasher: Hasher, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number and hash of each word, and of each run of WORDS words."""
    number, _, _, hashes, _ = hasher.batch(texts)
    owner, shingle = runs(hashes, number, WORDS)
    return number, hashes, owner, shingle


def _content(number: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    """128 bits for each text's sequence of words."""
    place = np.arange(len(hashes)) - np.searchsorted(number, number)
    out = np.zeros((texts, 2), np.uint64)
    for k, salt in enumerate((0x8CB92BA72F3D8DD7, 0x2545F4914F6CDD1D)):
        at = mix(place.astype(np.uint64) + np.uint64(salt))
        np.add.at(out[:, k], number, mix(hashes ^ at) * (at | np.uint64(1)))
    return out


def _node(content: np.ndarray) -> np.ndarray:
    return mix(content[:, 0] ^ mix(content[:, 1])).view(np.int64)


def sketched(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, content (16 bytes: texts of the same words have the same), words, node, bands; null bands for a text without words."""
    fields = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T.StructType.fromDDL("content binary, node long, words long, bands array<long>").fields])
    kinds = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            # Each text has some COORDINATES * (ln COORDINATES + 3) darts, however short it is.
            for first, group in grouped(texts, rows=512):
                number, hashes, owner, shingle = _elements(hasher, group)
                content = _content(number, hashes, len(group))
                owner, element, weight = weighted(owner, shingle)
                keys = band_keys(signatures(owner, element, weight, len(group))).view(np.int64)
                words = np.bincount(number, minlength=len(group))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.reshape(-1)), mask=pa.array(words == 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(group)), pa.array([c.tobytes() for c in content], pa.binary()), pa.array(_node(content)), pa.array(words.astype(np.int64)), bands.cast(kinds)],
                    ["id", "content", "node", "words", "bands"],
                )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, fields)


def _shingled(texts: DataFrame) -> DataFrame:
    """node and its elements, of rows (node, text) whose text has that node.

    Elements are run hashes with their repeat number mixed in, so that plain set overlap is weighted overlap.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            asked = batch.column(0).to_numpy()
            for first, group in grouped(batch.column(1).cast(pa.binary()).to_pylist()):
                number, hashes, owner, shingle = _elements(hasher, group)
                own = np.flatnonzero(_node(_content(number, hashes, len(group))) == asked[first : first + len(group)])
                owner, element, weight = weighted(owner, shingle)
                again = np.repeat(np.arange(len(element)), weight)
                copy = np.arange(len(again)) - np.repeat(np.cumsum(weight) - weight, weight)
                each = np.where(copy == 0, element[again], mix(element[again] + copy.astype(np.uint64)))
                begin, end = np.searchsorted(owner[again], own), np.searchsorted(owner[again], own, side="right")
                found = pa.array([each[x:y].tobytes() for x, y in zip(begin, end)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(asked[first + own]), found], ["node", "elements"])

    return texts.mapInArrow(run, "node long, elements binary").groupBy("node").agg(F.first("elements").alias("elements"))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Weighted Jaccard similarity of all sets, by products of incidence columns; elements of a single set are left out."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.float64)
    owner = np.repeat(np.arange(n), size.astype(np.int64))
    values, at, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(seen > 1)
    place = np.full(len(values), -1, np.int64)
    place[shared] = np.arange(len(shared))
    at = place[at]
    owner, at = owner[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    both, step = np.zeros((n, n)), 4096
    for begin in range(0, len(shared), step):
        a, b = np.searchsorted(at, (begin, begin + step))
        part = np.zeros((n, min(step, len(shared) - begin)), np.float32)
        part[owner[a:b], at[a:b] - begin] = 1
        both += part @ part.T
    return both / np.maximum(size[:, None] + size[None, :] - both, 1)


def _links(group: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links that join what belongs together in a tile: a spanning forest of all pairs that are similar enough."""
    nodes = group["node"].to_numpy()
    root = np.unique(group["component"].to_numpy(), return_inverse=True)[1] if "component" in group else np.arange(len(nodes))
    similar = _overlaps([np.frombuffer(e, np.uint64) for e in group["elements"]]) >= least
    a, b = np.nonzero(np.triu(similar, 1))
    parent = list(range(int(root.max()) + 1))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(int(root[x])), find(int(root[y]))
        if p != q:
            parent[p] = q
            out.append((nodes[x], nodes[y]))
    return pd.DataFrame(out, columns=["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row for each document: its id and ``class_id``, the least id of its class.

    Documents are in one class if a chain of pairs with a weighted Jaccard similarity of at least ``similarity`` joins
    them, over runs of five words (separated by ASCII white space, ASCII case folded, counted as often as they occur; a
    text of fewer words is one run). Texts without words, null or empty, are copies of each other. Rows of one id are one
    document and in one class, whatever their texts. A null id has no class. Equal rows are kept as rows. An empty table
    gives an empty table. Other columns are not looked at.

    Copies of one word sequence become one node before anything is compared. Signatures meet by band; buckets of the same
    members count once. A bucket is cut into tiles of bounded size whose members are compared exactly; a large bucket
    whose tiles are not yet one component has every pair of tiles compared as well. So no pair that shares a band is
    dropped, and no task lists pairs: it gives at most one link for each member. Nodes are told apart by 64 bits.
    """
    # What is joined here grows with the documents, so joins are shuffled at every size.
    found = written_out(sketched(docs, id_col, text_col))
    named = found.where("id is not null")
    nodes = written_out(named.groupBy("node").agg(F.min("id").alias("least"), F.max("words").alias("words"), F.min("bands").alias("bands")))
    banded = nodes.where("bands is not null").select("node", "words", F.explode("bands").alias("band"))
    buckets = (
        banded.groupBy("band")
        .agg(F.count(F.lit(1)).alias("members"), F.sum("words").alias("elements"), F.bit_xor(F.xxhash64("node")).alias("mark"), F.min("node").alias("low"), F.max("node").alias("high"))
        .where("members > 1")
        .groupBy("members", "elements", "mark", "low", "high")
        .agg(F.min("band").alias("bucket"))
    )
    tiles = F.greatest(F.ceil(F.col("members") / TILE_MEMBERS), F.ceil(F.col("elements") / TILE_ELEMENTS)).cast("long")
    placed = banded.join(buckets.select("bucket", tiles.alias("tiles")).hint("merge"), F.col("band") == F.col("bucket"))
    placed = written_out(placed.select("node", "bucket", "tiles", F.pmod(F.xxhash64("node", F.lit(3)), F.col("tiles")).alias("tile")))
    wanted = written_out(nodes.join(placed.hint("merge"), "node", "left_semi").select("node", "least"))
    texts = docs.select(F.col(id_col).alias("least"), F.col(text_col).alias("text")).join(wanted.hint("merge"), "least").select("node", "text")
    elements = written_out(_shingled(texts))

    def linked(members: DataFrame, *tile: str) -> DataFrame:
        return written_out(members.join(elements.hint("merge"), "node").groupBy("bucket", *tile).applyInPandas(lambda g: _links(g, similarity), "a long, b long"))

    several = named.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("id", "a")
    links = linked(placed, "tile").union(named.join(several, "id").select("a", F.col("node").alias("b")))
    classes = written_out(components(links))
    spread = placed.where("tiles > 1")
    if spread.limit(1).count():
        known = spread.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
        open_ = known.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
        left = known.join(open_, "bucket", "left_semi")
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
        pairs = left.select("*", other).where("other <> tile").withColumns({"one": F.least("tile", "other"), "two": F.greatest("tile", "other")})
        settled = classes.select(F.col("node").alias("a"), F.col("component").alias("b"))
        classes = written_out(components(settled.union(linked(pairs, "one", "two"))))
    settled = nodes.select("node", "least").join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = settled.groupBy("component").agg(F.min("least").alias("class_id"))
    class_of = settled.join(least, "component").select("node", "class_id")
    rows = named.select("id", "node").join(class_of, "node").select(F.col("id").alias(id_col), "class_id")
    unnamed = found.where("id is null").select(F.col("id").alias(id_col), F.col("id").alias("class_id"))
    return rows.union(unnamed)


def keep_one(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is not the least of its class; of rows that share an id, the least one stays.

    ``classes`` is the result of near_duplicates. Rows without an id stay.
    """
    classes = written_out(classes)
    again = classes.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("n"), F.min("class_id").alias("class_id"))
    out = again.where(F.col(id_col) != F.col("class_id")).select(id_col)
    repeated = again.where((F.col("n") > 1) & (F.col(id_col) == F.col("class_id"))).select(id_col)
    once = docs.join(written_out(out.union(repeated)).hint("merge"), id_col, "left_anti").select(*docs.columns)
    first = docs.join(written_out(repeated), id_col, "left_semi").groupBy(F.col(id_col).alias("__id")).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return once.union(first.select(*docs.columns))
