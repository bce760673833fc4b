"""Top-k search, sharding and mixing against plain versions."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from lakeops.llm import mixing, sharding, topk

DOCS = "doc_id long, text string, source string, shard string, size string"


def test_jump_hash_matches_the_published_walk(spark):
    keys = [0, 1, 2, 7, -1, 2**63 - 1, -(2**63), *range(1000, 1300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = df.select("k", *[sharding.jump_shard(F.col("k"), n).alias(f"s{n}") for n in (1, 2, 8, 9, 1000)]).collect()
    for r in got:
        for n in (1, 2, 8, 9, 1000):
            assert r[f"s{n}"] == plain.jump(r["k"], n)


def test_a_walk_beyond_the_usual_steps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "USUAL_STEPS", 2)
    df = spark.range(200).select("id", sharding.jump_shard(F.col("id"), 50).alias("s"))
    assert all(r["s"] == plain.jump(r["id"], 50) for r in df.collect())


def test_appending_a_shard_moves_rows_only_into_it(spark):
    df = spark.range(5000).select(sharding.jump_shard(F.col("id"), 8).alias("a"), sharding.jump_shard(F.col("id"), 9).alias("b"))
    rows = df.collect()
    moved = [r for r in rows if r["a"] != r["b"]]
    assert all(r["b"] == 8 for r in moved)
    assert 0.07 < len(moved) / len(rows) < 0.15


def test_manifest_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 3)
    rows = [(1, "a", "x", "c", "d"), (None, None, None, None, None), (2, "", "x", "c", "d"), (3, "ü" * 50_000, "x", "c", "d")]
    rows += [(7, "same", "x", "c", "d")] * 10 + [(7, "other", "x", "c", "d")]
    got = sharding.shard_manifest(spark.createDataFrame(rows, DOCS), 8).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len((t or "").encode()) + 1) for d, t, *_ in rows)
    for r in got:
        text = next(t for d, t, *_ in rows if d == r["doc_id"] and len((t or "").encode()) + 1 == r["size"])
        assert r["text_crc32"] in ({zlib.crc32(t.encode()) for d, t, *_ in rows if d == r["doc_id"]} if text is not None else {None})
        assert r["shard"] == plain.jump(r["doc_id"] or 0, 8) and r["grown_shard"] == plain.jump(r["doc_id"] or 0, 9)
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_manifest_of_no_rows(spark):
    assert sharding.shard_manifest(spark.createDataFrame([], DOCS), 8).collect() == []


def test_text_keys_have_shards(spark):
    df = sharding.with_shards(spark.createDataFrame([("a", "old"), ("b", "old"), (None, "old")], "k string, shard string"), ["k"], 4)
    assert {r["shard"] for r in df.collect()} <= set(range(4))


def test_apportionment_is_by_highest_quotients():
    rng = np.random.default_rng(1)
    for _ in range(200):
        votes, seats = rng.integers(0, 50, rng.integers(1, 9)), int(rng.integers(0, 60))
        got = mixing.apportion(votes, seats)
        quotients = sorted(((-v / (2 * k + 1), p) for p, v in enumerate(votes) for k in range(seats) if v), key=lambda x: x)[:seats]
        want = Counter(p for _, p in quotients)
        # Ties between parties may fall either way: the quotients given are the same.
        given = sorted(-v / (2 * k + 1) for p, v in enumerate(votes) for k in range(got[p]))
        assert given == pytest.approx([q for q, _ in quotients]) and got.sum() == sum(want.values())


def test_targets_share_the_excess(spark):
    rng = np.random.default_rng(2)
    for _ in range(50):
        sizes = [int(x) for x in rng.integers(0, 1000, 7)]
        weights = [(5, 2, 1)[k % 3] for k in range(7)]
        got = mixing.targets(sizes, weights)
        assert got == pytest.approx(plain.targets(sizes, weights), abs=1e-6, rel=1e-9)
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [5, 2]) == [0.0, 0.0]


def test_mix_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_ROWS", 7)
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(["wörd"] * int(rng.integers(0, 900))), f"s{k % 4}", "c", "d") for k in range(60)]
    rows += [(None, None, None, None, None), (100, "", None, "c", "d"), (101, "w " * 20_000, None, "c", "d"), *[(102, "a b c", "s1", "c", "d")] * 5]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len(plain.words(t))) for d, t, *_ in rows)
    sources = sorted({r["source"] for r in got}, key=lambda s: (s is None, s or ""))
    sizes = [sum(r["size"] for r in got if r["source"] == s) for s in sources]
    wanted = plain.targets(sizes, [(5, 2, 1)[k % 3] for k in range(len(sources))])
    for s, size, target in zip(sources, sizes, wanted):
        own = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == size and r["target"] == pytest.approx(target) for r in own)
        assert abs(sum(r["taken"] for r in own) - target) <= 2 * mixing.BLOCK_WORDS
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)
    again = mixing.mix(df.repartition(5)).collect()
    key = lambda r: (r["doc_id"] or -1, r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_documents_hold_the_words_taken(spark):
    rows = [(k, f"  one two\tthree {k} five", f"s{k % 3}", "c", "d") for k in range(300)] + [(900, "", "s1", "c", "d"), (901, None, "s1", "c", "d")]
    df = spark.createDataFrame(rows, DOCS)
    mixed = mixing.mix(df)
    taken = {r["doc_id"]: r["taken"] for r in mixed.collect()}
    out = mixing.mixed_documents(mixed, df.columns)
    assert out.columns == df.columns or set(out.columns) == set(df.columns)
    held = Counter()
    texts = {d: t for d, t, *_ in rows}
    for r in out.collect():
        held[r["doc_id"]] += len(plain.words(r["text"]))
        assert (texts[r["doc_id"]] or "").startswith(r["text"] or "")
    assert all(held[d] == n for d, n in taken.items())
    assert 900 in held and 901 in held


def test_sources_smaller_than_a_block_are_mixed(spark):
    rows = [(k, "one two three four five six", "s0", "c", "d") for k in range(500)] + [(1000, "x y z", "s1", "c", "d"), (1001, "w", "s2", "c", "d"), (1002, "u v", None, "c", "d")]
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(spark.createDataFrame(rows, DOCS)).collect()}
    assert (taken[1000], taken[1001], taken[1002]) == (9, 3, 6)
    alone = mixing.mix(spark.createDataFrame(rows[-1:], DOCS))
    assert [r["taken"] for r in alone.collect()] == [2] and mixing.mixed_documents(alone, alone.columns).count() == 1


def test_mix_of_no_rows(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []


def _plain_top(vectors, k, scale=64):
    clean = {}
    for i, v in vectors:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(scale * x)) for x in v]
        clean[i] = min(q, clean.get(i, q))
    out = []
    for i in sorted(clean):
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(clean[i], w)), j) for j, w in clean.items() if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return out


def test_top_k_of_odd_vectors(spark, monkeypatch):
    for name, value in (("SHARD_ROWS", 40), ("TILE_ROWS", 6), ("FAN_IN", 2), ("SLICE_ROWS", 3)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(4)
    vectors = [(k - 100, [float(x) for x in rng.integers(-2, 3, 6) / 4]) for k in range(400)]
    vectors += [(None, [1.0] * 6), (1000, None), (1020, [None] * 6), (1040, [float("nan")] * 6), (1060, [float("inf")] * 6), (1080, []), (1100, [0.5, 0.25])]
    vectors += [(40, vectors[140][1]), (41, vectors[141][1]), (1120, [1e7] * 6), (1121, [3e7] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], "id long, embedding array<double>, score int")
    got = topk.top_k(df.where("id % 20 = 0"), df, 7, "id", "embedding").collect()
    assert sorted(tuple(r) for r in got) == _plain_top(vectors, 7)
    few = df.where("id between 0 and 4")
    assert sorted(tuple(r) for r in topk.top_k(few.where("id % 20 = 0"), few, 7, "id", "embedding").collect()) == _plain_top([v for v in vectors if v[0] is not None and 0 <= v[0] <= 4], 7)


def test_top_k_of_no_vectors(spark):
    none = spark.createDataFrame([], "id long, embedding array<float>")
    assert topk.top_k(none, none, 20, "id", "embedding").collect() == []


def test_columns_of_any_name_pass_through_the_mix(spark):
    names = ["__place", "__seats", "__shards", "__source", "shard_size", "quota", "of_source", "of_shard", "__shard", "seats", "__end", "copies", "copy", "put", "_0", "a.b"]
    df = spark.createDataFrame([(k, f"one two three {k}", f"s{k % 3}", 9, *["x"] * len(names)) for k in range(40)], ["doc_id", "text", "source", "n_chars", *names])
    mixed = mixing.mix(df)
    assert mixed.columns == [*df.columns, "size", "source_size", "target", "taken"]
    assert all(r[c] == "x" for r in mixed.collect() for c in names)
    out = mixing.mixed_documents(mixed, df.columns)
    assert out.columns == df.columns and all(r[c] == "x" for r in out.collect() for c in names)
