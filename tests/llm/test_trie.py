"""The prefix trie against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from galewright.llm import catalog, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def built(df, width):
    conv_id = F.col("conv_id")
    turns = prefix_trie.numbered_turns(df)
    lent = prefix_trie.with_borrowed_starts(turns, conv_id - conv_id % 100, F.crc32(conv_id.cast("string").cast("binary")) % 6)
    return sorted([tuple(r) for r in prefix_trie.prefix_trie(lent, width).select(*COLUMNS).collect()], key=str)


def rebuilt(rows):
    given = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            given[conv_id].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [(role, text) for *_, role, text in sorted(turns)] for c, turns in given.items()}
    out = {}
    for c, turns in own.items():
        lender = c - c % 100 if c >= 0 else c + (-c) % 100
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns if lender == c else own.get(lender, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        own = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        saved[path] = own + sum(saved[k] for k in children[path])
    for path, some in members.items():
        ends = ",".join(str(c) for c in sorted(some) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(some), len(path), parent, len(some), len(children[path]), leaves[path], saved[path], digest))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def talk():
    """Shared starts of up to 25 turns, turnless results, NULLs in every column, ties and repeated rows."""
    draw = random.Random(1)
    rows = []
    for c in [*range(-5, 60), 100, 101, 150, 205, None]:
        topic = draw.choice([0, 1])
        for t in range(draw.choice([0, 1, 3, 9, 20, 30])):
            turn = draw.choice([t, None, 3]) if draw.random() < 0.1 else t
            role = None if draw.random() < 0.03 else "user"
            text = None if draw.random() < 0.02 else f"é👍{topic}.{t}" if t < 25 else f"{c} {t}"
            rows.append((c, turn, role, text))
    return rows + rows[:3]


@pytest.mark.parametrize("width", [3, 8])
def test_nodes_equal_brute_force(spark, talk, width):
    df = spark.createDataFrame(talk, SCHEMA).repartition(5).withColumns({c: F.lit(1) for c in ("pos", "at", "t1", "node", "block")})
    assert built(df, width) == brute(talk)


def test_one_conversation_held_by_most(spark):
    rows = [(c, t, "user", f"common {t}") for c in range(0, 90_000, 100) for t in range(11)]
    rows += [(c, t, "user", f"{c} {t}") for c in range(50, 500, 100) for t in range(12)]
    assert built(spark.createDataFrame(rows, SCHEMA), 4) == brute(rows)


def test_no_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert built(df, 8) == []
    assert built(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA), 8) == []


def test_ids_of_one_end_are_hashed_across_pieces(spark):
    ends = spark.range(30_000).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("node"), F.lit(3).cast("long").alias("depth"))
    (row,) = prefix_trie.ends_digests(ends).collect()
    assert row["ends_sha256"] == hashlib.sha256(",".join(map(str, range(30_000))).encode()).hexdigest()


def test_query_matches_sql(spark, sf, entry):
    assert differences(entry["op12_prefix_trie"](spark, sf), connect(sf), catalog.oracle_sql()["op12_prefix_trie"]) == []
