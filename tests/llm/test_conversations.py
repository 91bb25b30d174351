"""Conversation repair against a search over whole edit strings."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import conversations as V

SCHEMA = "conv_id long, turn long, role string, text string"


def repaired(df, tmp_path, name="c"):
    return sorted((tuple(r) for r in V.repair(df, str(tmp_path / name)).collect()), key=repr)


def odd_rows(n, seed, turns):
    r = random.Random(seed)
    return [(r.choice([None, 1, 1, 1, 2, 3, 4]), r.choice([None, *range(turns)]), r.choice(["user", "user", "assistant", "system", "tool", "", None, "s"]),
             r.choice(["Hi.", "x", "", " \n", "Yes!", "no? ", "b. c", "a", "b", "c.", None, "é ", "long " * 500])) for _ in range(n)]


def test_small_conversations(table, tmp_path):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table("conversations").collect()]
    assert repaired(V.damage(table("conversations")), tmp_path) == brute.repairs(brute.damaged(rows))


@pytest.mark.parametrize("bits, n, turns", [(14, 400, 60), (4, 900, 300), (1, 60, 9)])
def test_long_conversations_over_many_blocks(frame, tmp_path, monkeypatch, bits, n, turns):
    monkeypatch.setattr(V, "BLOCK_BITS", bits)  # turns of a block
    rows = odd_rows(n, bits, turns)
    assert repaired(V.damage(frame(rows, SCHEMA).repartition(3)), tmp_path) == brute.repairs(brute.damaged(rows))


def test_one_conversation_in_many_partitions(spark, frame, tmp_path, monkeypatch):
    rows = [(7, i % 700, "user" if i % 3 else "assistant", f"t{i % 90}.") for i in range(1500)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = V.rows_of(frame(rows, SCHEMA).repartition(4))
        got = repaired(df, tmp_path)
        assert spark.read.parquet(str(tmp_path / "c" / "pieces")).count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == brute.repairs([(*r, 1) for r in rows])


def test_equal_rows_lost_conversations_and_names(frame, clash, tmp_path):
    lost = next(c for c in range(500) if list(brute.damaged([(c, 0, "user", "x.")]))[0][4] == 0)
    rows = [(lost, 0, "user", "x.")] + [(5, 3, "user", "same.")] * 40 + [(5, 4, "assistant", "so.")] + [(None, None, None, None)] * 3
    df = V.damage(clash(frame(rows, SCHEMA)))
    got = repaired(df, tmp_path)
    assert got == brute.repairs(brute.damaged(rows))
    assert (lost, 0, 0, 0, 0, 0, 0, "", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855") in got


def test_empty(frame, tmp_path):
    assert V.repair(V.damage(frame([], SCHEMA)), str(tmp_path / "c")).count() == 0


def test_text_ids(frame, tmp_path):
    df = V.rows_of(frame([("a", 1, "user", "Hi."), ("a", 2, "assistant", "Yes."), ("b", 1, "assistant", "Hm")], SCHEMA.replace("conv_id long", "conv_id string")))
    assert [(r[0], r[6], r[7]) for r in repaired(df, tmp_path)] == [("a", 0, "KK"), ("b", 4, "D")]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 400])
def test_walk_in_parts_is_the_walk(n):
    r = random.Random(n)
    codes = bytes(r.choice([0, 0, 0, 1, 2]) * 4 + r.randrange(4) for _ in range(n))
    whole, _ = V.walk(codes)
    cut = r.randint(0, n)
    middle = V.costs(codes[cut:], V.END)
    first, state = V.walk(codes[:cut], V.NOTHING, middle, False)
    assert first + V.walk(codes[cut:], state)[0] == whole


def test_matrices_give_the_costs():
    r = random.Random(1)
    codes = bytes(r.choice([0, 0, 1, 2]) * 4 + r.randrange(4) for _ in range(37))
    units = [V.costs(codes, tuple(0 if i == j else V.NEVER for i in range(4))) for j in range(4)]
    assert V.costs(codes, V.END) == tuple(min(units[j][i] + V.END[j] for j in range(4)) for i in range(4))


def test_damage(frame):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    got = V.damage(frame(rows, SCHEMA)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((c, t, r, x if k else "", k)) for c, t, r, x, k in brute.damaged(rows))
    assert V.damage(frame(rows, SCHEMA)).where(F.col("copies") == 2).count() > 0
