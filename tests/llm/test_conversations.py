"""Repaired conversations against a search over all edits."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from barspan.llm import conversations as cv
from barspan.llm import queries

KIND = "conv_id long, turn long, role string, text string"
TEXTS = ["Yes.", "no", "Why?", "", " \n", "Stop! ", "A. b", "Wait.\x0b", None, " ", "x" * 3000 + "."]
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User", "superuser", "a"]


def table_of(seed, n, longest=9):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        turn = 0
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice([0, 1, 1, 1, 2])
            role = rng.choice(ROLES) if rng.random() < 0.3 else ROLES[turn % 2]
            text = rng.choice(TEXTS) if rng.random() < 0.6 else f"Text {turn} of {conv}."
            rows.append((conv if conv else None, None if rng.random() < 0.05 else turn, role, text))
    return rows + rows[3:6]


def frame(spark, rows):
    clashes = ["conv", "piece", "part", "code", "digest", "late", "exit", "last", "entry", "single", "audit"]
    return spark.createDataFrame(rows, KIND).withColumns({c: F.lit("clash") for c in clashes}).repartition(4)


def answers(spark, monkeypatch, rows):
    monkeypatch.setattr(queries, "table", lambda *_: frame(spark, rows))
    return sorted(map(tuple, queries.QUERIES["op12_conversations"](spark, "").collect()), key=repr)


@pytest.mark.parametrize("piece", [1024, 3, 1])
def test_conversations(spark, monkeypatch, piece):
    """Also in pieces of few rows, whose partial paths are put together."""
    monkeypatch.setattr(cv, "PIECE_ROWS", piece)
    rows = table_of(piece, 150)
    assert answers(spark, monkeypatch, rows) == sorted(brute.conversations(rows), key=repr)


@pytest.mark.parametrize("conv", [7, None])
def test_one_conversation_over_all_partitions(spark, monkeypatch, conv):
    """One conversation holds most rows: it spans partitions, with duplicates far from their first place."""
    monkeypatch.setattr(cv, "PIECE_ROWS", 16)
    # Otherwise Spark reads the few rows in one partition.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(9)
    rows = [(conv, i // 2 if 300 < i < 320 else i, rng.choice(ROLES[:8]), rng.choice([f"n {i % 400}.", f"m {i}", "Same."])) for i in range(1200)]
    rows += table_of(5, 10)
    got = answers(spark, monkeypatch, rows)
    assert got == sorted(brute.conversations(rows), key=repr)
    pieces = cv.repair(frame(spark, rows))
    assert pieces.where(F.col("conv").eqNullSafe(F.lit(conv))).select("part").distinct().count() > 4
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_nothing_left(spark, monkeypatch):
    rows = [(i, None, "user", None) for i in range(60)]
    assert answers(spark, monkeypatch, rows) == sorted(brute.conversations(rows), key=repr)
    assert answers(spark, monkeypatch, []) == []


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi!"), (1, 3, "user", "Hi!"), (1, 4, "assistant", "cut of")]
    pieces = cv.repair(spark.createDataFrame(rows, KIND))
    turns = [(r.edit, r.role, r.text) for r in cv.repaired_turns(pieces).orderBy("part", "piece", "place").collect()]
    line = cv.summary(pieces).first()
    assert (line.cost, line.audit, line.duplicate, line.truncated) == (6, "KRRDD", 1, 1)
    assert turns == [("K", "system", "Be kind."), ("R", "user", "Hello."), ("R", "assistant", "Hi!")]


def test_paths_of_random_rows():
    """Costs and letters of many pieces at once, from the start and joined in the middle."""
    rng = random.Random(2)
    for _ in range(200):
        turns, codes = [], bytearray()
        for i in range(rng.randint(1, 40)):
            initial, fault = rng.randrange(4), rng.choice([0, 0, 0, 3, 1])
            turns.append((i, ["system", "user", "assistant", "tool"][initial], "" if fault == cv.BLANK else f"t{i}" + ("" if fault == cv.CUT else ".")))
            codes.append(4 * initial + fault)
        want = brute.repaired(turns)
        whole = cv.Paths([bytes(codes)], np.zeros((1, 4), np.int64), np.array([True]))
        spell = lambda p, s: cv.LETTERS[(x := p.letter[p.spelled(np.array([s]))[0]])[x > 0]].tobytes().decode()
        assert (whole.cost[0, 0], spell(whole, 0)) == want[5:7]
        half = len(codes) // 2
        second = cv.Paths([bytes(codes[half:])], np.zeros((1, 4), np.int64), np.array([True]))
        first = cv.Paths([bytes(codes[:half])], second.cost[:1], np.array([False]))
        assert first.cost[0, 0] == want[5] == (cv.matrix(bytes(codes)) + cv.TO_END[None]).min(axis=1)[0]
        assert spell(first, 0) + spell(second, first.exit_states(0)[0]) == want[6]
