"""The FM-index against plain search, and the removal of repeated passages against a table of windows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from galewright.llm import substring_dedup
from galewright.llm.fm_index import FMIndex

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("cap", [1, 2, 3, 5, 8, 13])
def test_matching_statistics_equal_plain_search(cap):
    draw = np.random.default_rng(cap)
    for _ in range(12):
        kinds = draw.integers(2, 5)
        held = [draw.integers(0, kinds, draw.integers(0, 25)) for _ in range(draw.integers(1, 8))]
        asked = [draw.integers(0, kinds + 1, draw.integers(0, 30)) for _ in range(5)] + held
        places = {}
        for i, text in enumerate(held):
            for n in range(1, cap + 1):
                for at in range(len(text) - n + 1):
                    places.setdefault(tuple(text[at : at + n]), i)
        bounds = [np.cumsum([0, *(len(t) for t in texts)]) for texts in (held, asked)]
        index = FMIndex(np.concatenate(held).astype(np.uint64), bounds[0], cap)
        found = index.matching_statistics(np.concatenate(asked).astype(np.uint64), bounds[1])
        least = index.least_by_block(np.arange(len(held)))
        for text, start in zip(asked, bounds[1]):
            for at in range(len(text)):
                n = 0
                while n < cap and at + n < len(text) and tuple(text[at : at + n + 1]) in places:
                    n += 1
                assert found.length[start + at] == n
                if n == cap:
                    assert least[found.block[start + at]] == places[tuple(text[at : at + n])]


def brute(rows, window):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, words in texts:
        if i is not None:
            for at in range(len(words) - window + 1):
                key = tuple(words[at : at + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, words in texts:
        gone = set()
        if i is not None:
            for at in range(len(words) - window + 1):
                if first[tuple(words[at : at + window])] < i:
                    gone.update(range(at, at + window))
        kept = " ".join(w for at, w in enumerate(words) if at not in gone)
        out.append((i, len(words), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def removed(df, **options):
    rows = substring_dedup.without_repeats(df, **options).withColumn("digest", F.sha2(F.col("kept").cast("binary"), 256)).collect()
    for row in rows:
        assert sum(end - start for start, end in row["removed"]) == row["n_removed"]
    return sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept"], r["digest"]) for r in rows], key=repr)


@pytest.fixture(scope="module")
def passages():
    """Few words, so that windows repeat at any offset; common passages, near copies, texts of one word."""
    draw = random.Random(5)
    common = [" ".join(draw.choices("abcdefghijklmnop", k=draw.randint(10, 60))) for _ in range(6)]
    rows = []
    for i in range(300):
        parts = [" ".join(draw.choices(["a", "b", "é", "d\t"], k=draw.randint(0, 30))) for _ in range(2)]
        if draw.random() < 0.6:
            parts.insert(1, draw.choice(common))
        rows.append((i, draw.choice([" ", "\n", " \x0b "]).join(parts)))
    rows += [(i, rows[7][1]) for i in range(300, 420)]
    rows += [(1000, "x " * 2000), (1001, "x " * 1500), (1002, "x " * 12), (-5, common[0]), (None, common[0]), (7, common[1]), (7, common[1])]
    return rows


@pytest.mark.parametrize("window", [3, 13])
def test_removal_equals_brute_force(spark, passages, window):
    df = spark.createDataFrame(passages, SCHEMA).repartition(7)
    assert removed(df, window=window) == brute(passages, window)


def test_windows_of_common_minimizers_are_dealt_one_by_one(spark, passages):
    df = spark.createDataFrame(passages, SCHEMA).repartition(5)
    for many in (0, 5):
        assert removed(df, window=6, many=many) == brute(passages, 6)


def test_edge_rows_and_clashing_columns(spark, edges, no_rows):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    df = edges.withColumns({c: F.lit("clash") for c in ("batch", "minimizer", "shard", "owner", "content", "kept")})
    assert removed(df) == brute(rows, 13)
    assert removed(no_rows) == []


def test_query_equals_brute_force(spark, sf, docs, entry):
    found = entry["op11_substring_dedup"](spark, sf).collect()
    wanted = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], 13)
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found) == sorted((i, n, gone, digest) for i, n, gone, _, digest in wanted)
