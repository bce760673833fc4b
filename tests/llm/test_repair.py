"""Conversation repair against a program that keeps every state's best edits as text."""

from __future__ import annotations

import random

import duckdb
import plain
import pytest

from lakeops.llm import repair
from lakeops.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, state string, part string"
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _check(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    df = repair.damage(df)
    want = {c: plain.repaired(own) for c, own in plain.damaged(rows).items()}
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in repair.repair_report(df, "present").collect()}
    assert got == {c: w[:-1] for c, w in want.items()}
    turns: dict = {c: [] for c in want}
    for r in sorted(repair.repaired_turns(df, "present").collect(), key=lambda r: r["place"]):
        turns[r["conv_id"]].append((r["role"], r["text"]))
    assert turns == {c: list(w[-1]) for c, w in want.items()}


def _random(rng, conversations, longest, texts):
    roles = ["user", "assistant", "system", "tool", "", None, "unknown", "User"]
    for c in range(conversations):
        for k in range(rng.randrange(1, longest)):
            turn = rng.choice([k, k, k, k, k + 1, None, k * 7])
            yield c if c else None, turn, rng.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], rng.choice(texts)


@pytest.mark.parametrize("most", [4096, 5])
def test_odd_conversations(spark, monkeypatch, most):
    monkeypatch.setattr(repair, "PIECE_ROWS", most)
    rng = random.Random(most)
    texts = ["Yes.", "No!", "cut off", "", " \t\n", None, "Why? ", "é.", " .", "What.\x0b", "a" * 50 + ".", "b?", "c."]
    _check(spark, list(_random(rng, 150, 14, texts)))


def test_a_conversation_over_many_tasks(spark, monkeypatch, setting):
    """One conversation holds nearly all rows and ends as the plain program has it, with joins of both kinds."""
    monkeypatch.setattr(repair, "PIECE_ROWS", 7)
    rng = random.Random(2)
    texts = [f"{k}{rng.choice(['.', '!', '', ' '])}" for k in range(300)]
    rows = [(9, k, rng.choice(["user", "assistant"]), rng.choice(texts)) for k in range(600)]
    rows += list(_random(rng, 20, 6, texts))
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    _check(spark, rows)


def test_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE_CHARS", 1000)
    _check(spark, [(1, k, ("user", "assistant")[k % 2], "long " * 60_000 + f"{k}.") for k in range(5)] + [(2, 0, "user", "Hi.")])


def test_ties_go_to_the_ascii_least(spark):
    # Deleting and keeping cost as much as rerolling in other places: the report has the least text.
    _check(spark, [(1, k, "assistant", f"{k}.") for k in (1, 2, 3)] + [(3, 5, "user", "a."), (3, 6, "user", "b."), (3, 8, "assistant", "c.")])


def test_nothing_left(spark):
    """Rows that are all dropped leave a conversation with zeros; no rows at all leave none."""
    gone = next((c, t) for c in range(100) for t in range(20) if not plain.damaged([(c, t, "user", "x.")])[c])
    _check(spark, [(*gone, "user", "x.")])
    _check(spark, [])


def test_checkpoints_are_as_good_as_keeping_all():
    rng = random.Random(4)
    for n in (0, 1, 2, 3, 10, 50, 101):
        codes = [rng.choice([repair.GONE, *((i, c) for i in ("s", "u", "a", "") for c in (True, False))]) for _ in range(n)]
        rows = [(k, {"s": "system", "u": "user", "a": "assistant", "": "tool"}.get(c[0], "user"), f"{k}" + ("" if c[1] else ".") if c[0] is not None else "") for k, c in enumerate(codes)]
        one = repair.Conversation()
        list(one.feed([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], set(), repair.END))
        list(one.finish())
        assert one.report() == plain.repaired(rows)[:-1]
        cells = repair.matrix(codes)
        assert min(cells[q] + repair.END[q] for q in range(4)) == one.cost


def test_the_query_over_its_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{path}/conversations.parquet'").fetchall()
    want = {c: plain.repaired(own)[:-1] for c, own in plain.damaged(rows).items()}
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in QUERIES["op12_repair"](spark, path).collect()}
    assert got == want
