"""Token ids, token files, packing and the piece codec against the libraries; the pipeline."""

from __future__ import annotations

import struct
import zlib
from itertools import permutations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from edge_rows import EDGES
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from galewright.llm import language_id, packing, piece_codec, quality, simhash, token_files
from galewright.llm.catalog import BYTE_BPE, PIECE_BPE
from galewright.llm.textarrays import text_slices
from galewright.llm.tokens import TextEncoder


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return lambda text: [*found.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


PARTS = st.sampled_from(["a", "B", "'s", "'ll", "'", " ", "  ", "\n", "\t", "1", "²", "é", "ß", "!", "…", "漢", "👍", "<|endoftext|>", " ", "́"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=14).map("".join), max_size=8), st.integers(1, 40))
def test_encoder_equals_the_library(texts, limit):
    tokenizer = TextEncoder(BYTE_BPE, known=20)
    found = [ids for t in text_slices(pa.array(texts, pa.string()), limit) for e in [tokenizer.encode(t)] for ids in np.split(e.ids, e.first[1:-1])]
    assert [f.tolist() for f in found] == [[*tokenizer.tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=1200))
def test_any_id_of_a_file_is_addressed_directly(ids):
    ids = np.array(ids, dtype=np.uint32)
    file = token_files.TokenFile(token_files.write_file(np.array([7]), np.array([True]), np.array([0, len(ids)]), ids))
    assert (file.ids() == ids).all() and [file[i] for i in range(len(ids))] == ids.tolist() == file.document(0)
    with pytest.raises(IndexError):
        file[len(ids)]


@pytest.mark.parametrize("per_file", (1_000_000, 50))
def test_token_files_hold_all_documents_in_order(spark, edges, library, tmp_path, per_file):
    token_files.save(token_files.token_files(edges, BYTE_BPE, ids_per_file=per_file), str(tmp_path / "files"))
    files = token_files.load(spark, str(tmp_path / "files"))
    found = token_files.read_documents(files).orderBy("start").collect()
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == sorted(
        (repr(i), len(library(t)), crc(library(t))) for i, t, *_ in EDGES
    )
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    one = token_files.TokenFile(files.where("n_docs > 0").first().content)
    assert [one[i] for i in range(min(40, one.n_ids))] == one.ids()[:40].tolist()


def test_empty_token_files(spark, no_rows, tmp_path):
    token_files.save(token_files.token_files(no_rows, BYTE_BPE), str(tmp_path / "none"))
    assert token_files.read_documents(token_files.load(spark, str(tmp_path / "none"))).count() == 0


def test_pieces_are_cut_and_packed(edges, library):
    found = packing.pack_documents(edges, BYTE_BPE, 64).collect()
    wanted = []
    for doc_id, text, *_ in EDGES:
        ids = library(text)
        cuts = [*range(len(ids) % 64 or 64, len(ids), 64), len(ids)]
        wanted += [(repr(doc_id), k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip([0, *cuts], cuts))]
    assert sorted((repr(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(wanted)
    check_sequences(found, 64)


def check_sequences(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0, *(n for _, n in places)])[:-1].tolist()
        assert sum(n for _, n in places) <= capacity
    return len(bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=6))
def test_bounds_and_bins_against_brute_force(lengths):
    sizes = np.array(lengths, dtype=np.int64)
    bins, offsets = packing.best_fit_decreasing(sizes, 20)

    def next_fit(order):
        used, left = 0, 0
        for n in order:
            if n > left:
                used, left = used + 1, 20
            left -= n
        return used

    best = min((next_fit(p) for p in permutations(lengths)), default=0)  # some order of next fit is optimal
    assert packing.lower_bound(sizes, 20) <= best <= len(set(bins.tolist()))
    assert all(o + n <= 20 for o, n in zip(offsets, sizes))


def test_partitions_with_gaps_are_packed_again(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(n)) for i, n in enumerate(rng.integers(300, 900, 3000))]
    items = spark.createDataFrame(rows, "name long, length long")
    found = packing.pack(items, 1000, per_task=400).collect()
    assert sorted((r.name, r.length) for r in found) == rows
    used = check_sequences(found, 1000)
    whole = len(set(packing.best_fit_decreasing(np.array([n for _, n in rows]), 1000)[0].tolist()))
    assert packing.lower_bound(np.array([n for _, n in rows]), 1000) <= used <= whole * 1.02


def test_packing_refuses_what_it_cannot_place(spark, no_rows):
    with pytest.raises(Exception, match="length outside"):
        packing.pack(spark.createDataFrame([(1, 5), (2, None)], "name long, length long"), 10).collect()
    with pytest.raises(ValueError, match="result's own"):
        packing.pack(spark.createDataFrame([(1, 5)], "offset long, length long"), 10)
    assert packing.pack_documents(no_rows, BYTE_BPE, 64).count() == 0


def test_piece_codec_equals_the_library(docs, edges, no_rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    for table in (edges, docs.limit(60)):
        texts = {(r.doc_id, r.text) for r in table.collect()}
        found = piece_codec.transcode(table, PIECE_BPE).collect()
        wanted = {(repr(i), struct.pack(f"<{len(ids)}I", *ids), library.decode(ids)) for i, t in texts for ids in [library.encode(t or "")]}
        assert {(repr(r.doc_id), bytes(r.ids), r.decoded) for r in found} == wanted and len(found) == table.count()
    assert piece_codec.transcode(no_rows, PIECE_BPE).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "aa", "ti", "on", "the", " ", "    ", "\n", "漢", "▁", "é", "<s>", "1", "ing"]), max_size=25).map("".join), max_size=5))
def test_piece_encoder_equals_the_library(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    encoder = piece_codec._kept(piece_codec.PieceEncoder, PIECE_BPE)
    for part in text_slices(pa.array(texts, pa.string()), 50):
        found = encoder.encode(part)
        assert [x.tolist() for x in np.split(found.ids, found.first[1:-1])] == [library.encode(t) for t in texts[part.row : part.row + len(part)]]


def test_pipeline_keeps_what_its_stages_keep(spark, sf, docs, library):
    import corpus_pipeline

    labels = spark.read.parquet(f"{sf}/labels.parquet")
    known = language_id.keep_identified(docs, language_id.fit(docs)).select("doc_id")
    table = docs.join(known, "doc_id", "left_semi").select(*docs.columns)
    good = quality.rate(table, quality.fit(table, labels)).where("predicted = 1").select("doc_id")
    table = table.join(good, "doc_id", "left_semi").select(*docs.columns)
    kept = {r.doc_id for r in simhash.near_duplicates(table).where("doc_id = component_id").collect()}
    found = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in found} == kept
    total = {}
    for r in found:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {r.doc_id: len(library(r.text)) for r in docs.collect() if r.doc_id in kept}
    check_sequences(found, 2048)
    clean = {r.doc_id for r in labels.where("quality = 1").collect()}
    heads = {r.doc_id for r in simhash.near_duplicates(docs).where("doc_id = component_id").collect()}
    assert len(clean & heads - kept) == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "quality classifier", "SimHash near-dedup", "best-fit packing"]
