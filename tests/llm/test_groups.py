"""SimHash, embeddings and components against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from galewright.llm import embedding_dedup, simhash
from galewright.llm.components import components


def closed(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(rows):
    """(doc_id, fingerprint) -> (doc_id, fingerprint, component) by comparing all pairs."""
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (rows[i][1] ^ rows[j][1]).bit_count() <= 3]
    heads = closed(len(rows), links)
    least = {}
    for (doc_id, _), head in zip(rows, heads):
        least[head] = min((x for x in (least.get(head), doc_id) if x is not None), default=None)
    return [(d, f, least[h]) for (d, f), h in zip(rows, heads)]


@pytest.mark.parametrize("block", (2048, 3))
def test_groups_equal_brute_force(docs, edges, block):
    table = edges.select("doc_id", "text").unionByName(docs.where("doc_id < 250").select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    wanted = grouped([(r[0], fingerprint(r[1])) for r in table.collect()])
    found = [(r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(table, block=block).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_one_of_each_group_stays(edges, no_rows):
    kept = simhash.keep_one(edges)
    assert kept.columns == edges.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    members = {r.doc_id for r in simhash.near_duplicates(edges).where("doc_id = component_id").collect()}
    assert sorted(i for i in ids if i is not None) == sorted(members) and ids.count(None) == 1
    assert ids.count(1) == 1 and 2 not in ids and 3 not in ids and ids.count(4) == 1
    assert simhash.keep_one(no_rows).count() == 0 and simhash.near_duplicates(no_rows).count() == 0


def test_thresholds_cover_the_radius():
    rng = np.random.default_rng(5)
    bits = rng.random((4000, 64)) < rng.uniform(0.05, 0.95, 64)
    bits[:, 1] = bits[:, 0]
    both = (bits.T.astype(float) @ bits).astype(float)
    for n in (100, 10**6, 10**10):
        plan = simhash.allocate(n, both * n / 4000, 3)
        assert sum(t + 1 for _, t in plan) == 4  # so some group differs in its threshold or fewer bits
        used = [b for g, _ in plan for b in g]
        assert len(used) == len(set(used))
    groups = simhash.grouped_bits(4000, both, 4)
    assert any(0 in g and 1 in g for g in groups) and sorted(b for g in groups for b in g) == list(range(64))
    fair = np.full((64, 64), 0.25) + 0.25 * np.eye(64)
    assert len(simhash.allocate(10**11, fair * 10**11, 3)) < len(simhash.allocate(10**4, fair * 10**4, 3))


def test_components_equal_union_find(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 440)] + [(5, 5)]
    heads = closed(500, pairs)
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(found.get(x, x) == heads[x] for x in range(500))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors():
    rng = np.random.default_rng(9)
    base = rng.normal(size=(60, 64))
    rows = [v for v in base]
    for k in range(12):  # neighbours at cosines around the threshold
        for cos in (0.88, 0.905, 0.93, 0.97, 0.999):
            side = rng.normal(size=64)
            side -= side @ base[k] / (base[k] @ base[k]) * base[k]
            rows.append(cos * base[k] / np.linalg.norm(base[k]) + np.sqrt(1 - cos**2) * side / np.linalg.norm(side))
    rows += [base[20] + 0.05 * rng.normal(size=64) for _ in range(90)]  # a dense group
    rows += [base[30], base[30], 7 * base[30]]
    out = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    bad = [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf"), *[1.0] * 63], [None, *[1.0] * 63], [1.0, 2.0]]
    return out, [*((1000 + i, v) for i, v in enumerate(bad)), (None, out[0][1]), (None, None)]


@pytest.mark.parametrize("block", (2048, 40))
def test_vectors_link_as_by_brute_force(spark, block):
    good, bad = vectors()
    unit = np.array([v for _, v in good])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    table = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("node", F.lit("clash"))
    settings = embedding_dedup.VectorSettings(block=block)
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(table.repartition(4), settings).collect()}
    assert embedding_dedup.near_duplicates(table, settings).count() == len(good) + len(bad)
    links = np.array([found[i].n_links for i, _ in good])
    assert (links <= close.sum(axis=1)).all() and links.sum() >= 0.95 * close.sum()
    heads = closed(len(good), np.argwhere(close))
    assert np.mean([found[i].component_id == heads[i] for i, _ in good]) > 0.97
    assert all(found[i].n_links == 0 and found[i].component_id == i and found[i].kept for i, _ in bad if i is not None)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values() if r.vec_id is not None)


def test_no_usable_vectors(spark):
    table = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in embedding_dedup.near_duplicates(table).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


def test_sample_vectors_all_links(spark, sf, entry):
    found = entry["op3_embedding_groups"](spark, sf).toPandas()
    assert len(found) == 500 and (found.kept == (found.vec_id == found.component_id)).all()


def shared_direction(rng, n, dim, rank, share, cosines):
    """Vectors around a common direction, of full or low rank, and neighbours at given cosines."""
    spread = rng.normal(size=(n, rank)) @ rng.normal(size=(rank, dim))
    spread /= np.linalg.norm(spread, axis=1, keepdims=True)
    common = rng.normal(size=dim)
    unit = np.sqrt(share) * common / np.linalg.norm(common) + np.sqrt(1 - share) * spread
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    base, towards = unit[:600], unit[-600:]
    side = towards - (towards * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = np.resize(cosines, 600)[:, None]
    return np.vstack([unit, cosine * base + np.sqrt(1 - cosine**2) * side])


def met(index, apart):
    close = [np.bitwise_count(embedding_dedup.substring(apart, t, index.width)) <= index.flips for t in range(index.tables)]
    return np.logical_or.reduce(close) & (np.bitwise_count(apart).sum(axis=1) <= index.radius)


@pytest.mark.parametrize("n", (3000, 10**6, 10**9))
@pytest.mark.parametrize(("dim", "rank", "share"), ((64, 64, 0.5), (64, 64, 0.7), (96, 12, 0.5), (24, 24, 0.0), (384, 384, 0.5)))
def test_index_finds_links_of_vectors_that_share_a_direction(dim, rank, share, n):
    unit = shared_direction(np.random.default_rng(8), 3000, dim, rank, share, (0.9001, 0.91, 0.92))
    settings = embedding_dedup.VectorSettings()
    rotation = embedding_dedup.fit_rotation(unit, settings)
    index = embedding_dedup.choose_index(rotation, unit, n, settings)
    assert embedding_dedup.Index.unpacked(index.packed()) == index
    i, j = np.nonzero(np.triu(unit @ unit.T >= settings.threshold, 1))
    codes = rotation.codes(unit)
    assert met(index, codes[i] ^ codes[j]).mean() > 0.95


def test_few_pairs_of_topics_reach_the_cosine():
    """Vectors of 200 topics with no links: pairs a vector sends to the cosine, at ten times the vectors."""
    rng = np.random.default_rng(4)
    topic = rng.normal(size=(200, 384))
    unit = topic[rng.integers(200, size=20_000)] + rng.normal(size=(20_000, 384))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    settings = embedding_dedup.VectorSettings()
    rotation = embedding_dedup.fit_rotation(unit[:5000], settings)
    codes = rotation.codes(unit)
    x, y = rng.integers(20_000, size=(2, 1_000_000))
    apart = codes[x[x != y]] ^ codes[y[x != y]]
    for n in (50_000, 500_000):
        index = embedding_dedup.choose_index(rotation, unit[:5000], n, settings)
        assert met(index, apart).mean() * n / 2 < 5


def test_links_at_the_threshold_are_found_in_the_result(spark):
    """At cosines of 0.9 to 0.92, on a common direction: the query's path from end to end."""
    unit = shared_direction(np.random.default_rng(12), 2500, 64, 64, 0.5, (0.9001, 0.905, 0.91, 0.915, 0.92))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(unit)]
    found = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, 0)
    close = (cosine >= 0.9).sum(axis=1)
    assert ((cosine >= 0.9) & (cosine < 0.921)).sum() > 0.9 * close.sum() >= 1080
    links = np.array([found[i] for i in range(len(unit))])
    assert (links <= close).all() and links.sum() >= 0.95 * close.sum()


def test_every_length_is_compared(spark):
    rng = np.random.default_rng(10)
    long, short = shared_direction(rng, 700, 48, 48, 0.6, (0.91,)), shared_direction(rng, 650, 24, 24, 0.3, (0.93,))
    few = shared_direction(rng, 700, 300, 300, 0.0, (0.95,))[[0, 700, 1]]  # a vector, its neighbour and another
    groups = (long, np.vstack([short, short[[5, 7]]]), few, np.array([[1.0], [2.0], [-1.0]]))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(v for g in groups for v in g)]
    settings = embedding_dedup.VectorSettings(block=500, piece=20_000)
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), settings).collect()}
    at = 0
    for unit in groups:
        close = unit @ unit.T / np.outer(np.linalg.norm(unit, axis=1), np.linalg.norm(unit, axis=1)) >= settings.threshold
        np.fill_diagonal(close, False)
        links = np.array([found[at + i].n_links for i in range(len(unit))])
        assert (links <= close.sum(axis=1)).all() and links.sum() >= 0.95 * close.sum()
        at += len(unit)
    copies = at - 8
    assert not found[copies].kept and not found[copies + 1].kept
