"""Variable grams, the bound on affected grams, and spelling variants against brute force."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import connect, differences

from galewright.llm import catalog, spelling

LETTERS = "abcé"
SCHEMA = "word string, n long"


def edits(word):
    for i in range(len(word) + 1):
        for c in LETTERS:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            for c in LETTERS:
                yield word[:i] + c + word[i + 1 :]


def dictionary(words, least):
    grams = Counter()
    for _, marked in spelling.by_length(*spelling.single_bytes(pa.array(words))):
        for q, keys in spelling.gram_keys(marked, spelling.MOST).items():
            if q >= spelling.LEAST:
                grams.update(keys.ravel().tolist())
    kept = {g: n for g, n in grams.items() if n >= least or g < 1 << 16}
    known, counts = np.array(list(kept), np.uint64), np.array(list(kept.values()), np.int64)
    return spelling.Dictionary.pruned(known, counts, least)


def grams_of(words, held):
    out = {}
    arrays = spelling.single_bytes(pa.array(words))
    for rows, marked in spelling.by_length(*arrays):
        found = spelling.decompose(marked, held, held.extendable(), held.suffixes())
        for i, row in enumerate(rows):
            out[words[row]] = Counter(found.key[i][found.kept[i]].tolist()), int(found.affected[i])
    return out


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(LETTERS, min_size=5, max_size=9), min_size=30, max_size=60, unique=True))
def test_one_edit_affects_no_more_grams_than_the_bound(words):
    held = dictionary(words, 4)
    some = words[:6]
    others = {w: sorted(set(edits(w)) - {w}) for w in some}
    found = grams_of(sorted({*some, *(e for w in some for e in others[w] if e)}), held)
    for word in some:
        grams, affected = found[word]
        for other in others[word]:
            assert (grams - found[other][0]).total() <= affected


def test_dictionary_splits_frequent_grams_and_is_closed_under_prefixes():
    held = dictionary([f"abc{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)], 4)
    assert len(held.longer)
    longer = set(held.longer.tolist())
    assert all(g >> 8 in longer for g in longer if g >> 8 >= 1 << 16)


def brute(words):
    near = {w: {e for e in edits_any(w, words) if e in words and e != w} for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda e: (-words[e], e), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=str)


def edits_any(word, words):
    letters = sorted(set("".join(words)))
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
            yield word[:i] + c + word[i + 1 :]
        yield word[:i] + word[i + 1 :]


def found(df, **options):
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted([tuple(r) for r in spelling.variant_groups(df, **options).select(*columns).collect()], key=str)


@pytest.fixture(scope="module")
def vocabulary():
    draw = np.random.default_rng(3)
    words = {}
    for _ in range(700):
        word = "".join(draw.choice(list("abcéÿ"), size=draw.integers(5, 8)))
        words[word] = int(draw.integers(3, 60))
    long = "ab" * 300
    return words | {long: 9, long + "c": 3, long[:100] + "x" + long[101:]: 4, "aaaaa": 50, "aaaaaa": 50}


@pytest.mark.parametrize("block", [2048, 16])
def test_variants_equal_brute_force(spark, vocabulary, block):
    df = spark.createDataFrame([*vocabulary.items(), (None, 3), ("abcde", None)], SCHEMA).repartition(4)
    vocabulary.pop("abcde", None)
    df = df.where("word IS NULL OR n IS NULL OR word <> 'abcde'")
    assert found(df, block=block) == brute(vocabulary)


def test_no_words(spark, no_rows):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert spelling.counted_words(no_rows).count() == 0


def test_words_beyond_one_byte_are_refused():
    with pytest.raises(ValueError):
        spelling.single_bytes(pa.array(["slołwo"]))


def test_counted_words_on_edge_rows(spark, edges):
    wanted = Counter()
    for row in edges.collect():
        for run in regex.findall("[A-Za-zÀ-ÿ]+", row["text"] or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if row['doc_id'] is None else row['doc_id']}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            wanted[run] += len(run) >= 4
    got = {r["word"]: r["n"] for r in spelling.counted_words(edges, least=4, often=2, lose=3).collect()}
    assert got == {w: n for w, n in wanted.items() if n >= 2}


def test_crc32_of_runs_of_every_length():
    data = np.random.default_rng(1).integers(0, 256, 4000, dtype=np.uint8)
    length = np.array([0, 1, 2, 47, 48, 49, 50, 300, 1000, 7])
    start = np.cumsum(length) - length
    before = np.array([zlib.crc32(bytes([i])) for i in range(len(length))], np.uint32)
    wanted = [zlib.crc32(bytes([i]) + data[s : s + n].tobytes()) for i, (s, n) in enumerate(zip(start, length))]
    assert spelling.crc32_each(data, start, start + length, before).tolist() == wanted


def test_query_matches_sql(spark, sf, entry):
    assert differences(entry["op13_spelling_variants"](spark, sf), connect(sf), catalog.oracle_sql()["op13_spelling_variants"]) == []
