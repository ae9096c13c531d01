"""SentencePiece ids of whole texts by suffix-array matching, and texts from ids.

The chunks of a batch (words with the blanks before them) that the worker hasn't met are laid one after
the other and indexed by a suffix array. Every piece of the vocabulary is looked up by binary search;
its range of the array is where it occurs. The occurrences are edges, sorted by where they end, and
relaxed in that order: for every position one edge is the last token of the text up to there.

For a byte-pair model that edge is the one that leaves a valid pair: merging is local, so a sequence of
pieces is what the merges produce exactly when each piece and each neighbouring pair is. Pairs are
judged once each, by merging their text.

Supported are byte-pair models with the identity normalizer and without user-defined pieces; others are
refused. The model file is read directly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.llm.frames import columns_as, map_arrow
from galewright.llm.textarrays import Texts, mixed, range_hashes, ranges, text_slices
from galewright.llm.tokens import HashTable, Ids

# Fixed values of the model file: kinds of pieces, and the mark that stands for a blank.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_BYTE_PAIR = 2
_BLANK = "▁"


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        tag = varint()
        size = {1: 8, 5: 4}.get(tag & 7)
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if size is None else size
            yield tag >> 3, message[at : at + size]
            at += size


class PieceModel:
    """Pieces and settings of a model file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            fields = list(_fields(file.read()))
        pieces = [dict(_fields(v)) for k, v in fields if k == 1]
        trainer, normalizer = (next((dict(_fields(v)) for k, v in fields if k == n), {}) for n in (2, 3))
        self.pieces = [p.get(1, b"").decode() for p in pieces]
        self.kinds = [p.get(3, _NORMAL) for p in pieces]
        scores = [np.frombuffer(p.get(2, b"\0\0\0\0"), dtype="<f4")[0] for p in pieces]
        if trainer.get(3, 1) != _BYTE_PAIR or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError(f"{path}: only byte-pair models with the identity normalizer are supported")
        if set(self.kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or trainer.get(24, 0):
            raise ValueError(f"{path}: a kind of piece is not supported")
        self.prefix = bool(normalizer.get(3, 1))
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == _NORMAL}
        self.rank = {p: (-scores[i], i) for p, i in self.ids.items()}
        self.unknown = self.kinds.index(_UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == _BYTE}
        self.longest = max(map(len, self.ids), default=1)
        # Blanks begin a chunk of their own unless a piece runs over into them.
        self.splits = not any(_BLANK in p.lstrip(_BLANK) for p in self.ids)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text: the best pair first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            ranked = [(self.rank[a + b][0], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank]
            if not ranked:
                break
            k = min(ranked)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts


def suffix_array(codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions by the order of the ``width`` codes that follow each, and those codes as sorted byte
    strings. Codes are 16 bits wide, 0 marks the end of a chunk and stands behind the last."""
    padded = np.concatenate((codes, np.zeros(width, dtype=codes.dtype))).astype(">u2")
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)[: len(codes)]
    keys = np.ascontiguousarray(windows).view(f"S{2 * width}").ravel()
    order = np.argsort(keys, kind="stable")
    return order, keys[order]


class PieceEncoder:
    """Encodes texts; known chunks and pairs are kept between batches, at most ``known`` of each."""

    def __init__(self, path: str, known: int = 2_000_000):
        self.model, self.known = PieceModel(path), known
        self.names = list(self.model.ids)
        self.piece_ids = np.array([self.model.ids[p] for p in self.names], dtype=np.int64)
        self.piece_sizes = np.array([len(p) for p in self.names], dtype=np.int64)
        points = [np.frombuffer(p.encode("utf-32-le"), dtype=np.uint32) for p in self.names]
        self.piece_points = np.zeros((len(points), self.model.longest), dtype=np.uint32)
        for row, found in zip(self.piece_points, points):
            row[: len(found)] = found
        self.alone = np.array([self.model.merged(p) == [p] for p in self.names])  # pieces that merging can reach
        self._forget()
        self.pairs, self.pair_good = HashTable(), np.zeros(0, dtype=bool)

    def _forget(self) -> None:
        self.table = HashTable()
        self.place = self.length = np.zeros(0, dtype=np.int64)
        self.pool, self.used = np.zeros(1 << 16, dtype=np.uint32), 0

    def encode(self, texts: Texts) -> Ids:
        blank = ord(_BLANK)
        codes = np.frombuffer(texts.data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        lead = np.zeros(len(texts.data) + 1, dtype=np.int64)
        np.cumsum((texts.data & 0xC0) != 0x80, out=lead[1:])
        offsets = lead[texts.offsets]
        sizes = np.diff(offsets)
        extra = (sizes > 0) & self.model.prefix
        shift = np.concatenate(([0], np.cumsum(extra)))
        full = np.full(len(codes) + shift[-1], blank, dtype=np.uint32)
        full[np.arange(len(codes)) + np.repeat(shift[1:], sizes)] = np.where(codes == 0x20, np.uint32(blank), codes)
        offsets = offsets + shift
        new = np.zeros(len(full) + 1, dtype=bool)
        new[offsets] = True
        if self.model.splits and len(full):
            new[1:-1] |= (full[1:] == blank) & (full[:-1] != blank)
        start = np.flatnonzero(new[:-1])
        end = np.append(start[1:], len(full))
        hashes = range_hashes(mixed(full.astype(np.uint64) + np.uint64(1)), start, end)
        at = self._places(full, start, end, hashes)
        total = np.concatenate(([0], np.cumsum(self.length[at])))[np.searchsorted(start, offsets)]
        return Ids(self.pool[ranges(self.place[at], self.length[at])], total)

    def _places(self, full: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        at = self.table.find(hashes)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            _, first = np.unique(hashes[missing], return_index=True)
            if self.table.used and self.table.used + len(first) > self.known:
                self._forget()
                return self._places(full, start, end, hashes)
            new = missing[first]
            size = (end - start)[new]
            order = np.argsort(-size, kind="stable")  # for ``relax``
            new, size = new[order], size[order]
            ids, lengths = self._match(full[ranges(start[new], size)], size)
            while self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate((self.pool, np.zeros(len(self.pool), dtype=np.uint32)))
            self.pool[self.used : self.used + len(ids)] = ids
            self.place = np.concatenate((self.place, self.used + np.cumsum(lengths) - lengths))
            self.length = np.concatenate((self.length, lengths))
            self.used += len(ids)
            self.table.add(hashes[new])
            at[missing] = self.table.find(hashes[missing])
        return at

    def _match(self, points: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks that stand in ``points``, longest first, and how many each has."""
        first = np.cumsum(size) - size
        seen = np.unique(points)
        if len(seen) >= 0xFFFF:
            raise ValueError("more than 65,534 different characters in one slice of a batch")
        gapped = np.zeros(len(points) + len(size), dtype=np.uint16)  # a 0 behind each chunk
        where = np.arange(len(points)) + np.repeat(np.arange(len(size)), size)
        gapped[where] = np.searchsorted(seen, points) + 1
        begin = first + np.arange(len(size))
        order, keys = suffix_array(gapped, self.model.longest)
        # Binary search of every piece whose characters occur.
        rank = np.searchsorted(seen, self.piece_points)
        inside = seen[np.minimum(rank, len(seen) - 1)] == self.piece_points
        used = np.arange(self.model.longest) < self.piece_sizes[:, None]
        possible = np.flatnonzero((inside | ~used).all(axis=1) & self.alone)
        low = np.where(used[possible], rank[possible] + 1, 0).astype(">u2")
        high = np.where(used[possible], rank[possible] + 1, 0xFFFF).astype(">u2")
        kind = f"S{2 * self.model.longest}"
        lo = np.searchsorted(keys, np.ascontiguousarray(low).view(kind).ravel(), side="left")
        hi = np.searchsorted(keys, np.ascontiguousarray(high).view(kind).ravel(), side="right")
        count = np.maximum(hi - lo, 0)
        edge_start = order[ranges(lo, count)]
        edge_piece = np.repeat(possible, count)
        # Characters that are no piece are edges of their own, of piece -1.
        known = np.zeros(len(gapped), dtype=bool)
        known[edge_start[self.piece_sizes[edge_piece] == 1]] = True
        odd = np.flatnonzero(~known & (gapped != 0))
        edge_start = np.concatenate((edge_start, odd))
        edge_piece = np.concatenate((edge_piece, np.full(len(odd), -1)))
        edge_end = edge_start + np.where(edge_piece < 0, 1, self.piece_sizes[edge_piece])
        return self._relax(points, where, begin, size, edge_start, edge_end, edge_piece)

    def _relax(self, points, where, begin, size, edge_start, edge_end, edge_piece) -> tuple[np.ndarray, np.ndarray]:
        """Find the last piece of every prefix, in the order of the prefixes' lengths in all chunks at once."""
        chunk = np.searchsorted(begin, edge_start, side="right") - 1
        step = edge_end - begin[chunk]
        order = np.argsort(step, kind="stable")
        edge_start, edge_end, edge_piece, step = edge_start[order], edge_end[order], edge_piece[order], step[order]
        last = np.full(int(size.sum()) + len(size) + 1, -2, dtype=np.int64)  # by end position; -2: none yet
        bounds = np.searchsorted(step, np.arange(1, (int(size[0]) if len(size) else 0) + 2))
        opening = np.zeros(len(last), dtype=bool)
        opening[begin] = True
        for a, b in zip(bounds[:-1], bounds[1:]):
            s, e, piece = edge_start[a:b], edge_end[a:b], edge_piece[a:b]
            good = opening[s] | self._pair_valid(last[s], piece)
            last[e[good]] = piece[good]
        # Walk back from the ends of all chunks.
        at, live = begin + size, np.arange(len(size))
        ends, pieces, owners = [], [], []
        while len(live):
            piece = last[at]
            ends.append(at)
            pieces.append(piece)
            owners.append(live)
            at = at - np.where(piece < 0, 1, self.piece_sizes[piece])
            more = at > begin[live]
            at, live = at[more], live[more]
        none = np.zeros(0, dtype=np.int64)
        ends, pieces, owners = (np.concatenate([none, *x]) for x in (ends, pieces, owners))
        order = np.argsort(ends, kind="stable")
        ends, pieces, owners = ends[order], pieces[order], owners[order]
        width = np.ones(len(pieces), dtype=np.int64)
        odd = np.flatnonzero(pieces < 0)
        spelled = []
        if len(odd):
            position = np.searchsorted(where, ends[odd] - 1)
            spelled = [self._spelled(chr(p)) for p in points[position].tolist()]
            width[odd] = [len(x) for x in spelled]
        place = np.cumsum(width) - width
        out = np.zeros(int(width.sum()), dtype=np.uint32)
        plain = pieces >= 0
        out[place[plain]] = self.piece_ids[pieces[plain]]
        for k, ids in zip(odd, spelled):
            out[place[k] : place[k] + len(ids)] = ids
        return out, np.bincount(owners, weights=width, minlength=len(size)).astype(np.int64)

    def _spelled(self, char: str) -> list[int]:
        """A character without a piece: its bytes, or the unknown piece."""
        return [self.model.bytes[b] for b in char.encode()] if self.model.bytes else [self.model.unknown]

    def _pair_valid(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Do the two pieces stay as they are when their text is merged? A character without a piece never merges."""
        out = (left == -1) | (right == -1)
        ask = np.flatnonzero((left >= 0) & (right >= 0))
        key = mixed((left[ask].astype(np.uint64) << np.uint64(32)) | right[ask].astype(np.uint64))
        at = self.pairs.find(key)
        if (at < 0).any():
            if self.pairs.used > self.known:
                self.pairs, self.pair_good = HashTable(), np.zeros(0, dtype=bool)
            new, first = np.unique(key[self.pairs.find(key) < 0], return_index=True)
            first = np.flatnonzero(self.pairs.find(key) < 0)[first]
            names, merged = self.names, self.model.merged
            judged = []
            for i in ask[first].tolist():
                pair = [names[left[i]], names[right[i]]]
                judged.append("".join(pair) not in self.model.rank and merged("".join(pair)) == pair)
            self.pair_good = np.concatenate((self.pair_good, judged)).astype(bool)
            self.pairs.add(new)
            at = self.pairs.find(key)
        out[ask] = self.pair_good[at]
        return out


class PieceDecoder:
    """Texts of ids: pieces one after the other, blanks for their marks, without the added first one."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        spelled = []
        for piece, kind in zip(self.model.pieces, self.model.kinds):
            plain = piece.replace(_BLANK, " ").encode()
            spelled.append({_BYTE: bytes([int(piece[3:5], 16)]) if kind == _BYTE else b"", _CONTROL: b"", _UNKNOWN: " ⁇ ".encode()}.get(kind, plain))
        self.length = np.array([len(s) for s in spelled], dtype=np.int64)
        self.place = np.cumsum(self.length) - self.length
        self.pool = np.frombuffer(b"".join(spelled), dtype=np.uint8)

    def decode(self, found: Ids) -> list[str]:
        lengths = self.length[found.ids]
        data = self.pool[ranges(self.place[found.ids], lengths)].tobytes()
        bounds = np.concatenate(([0], np.cumsum(lengths)))[found.first]
        skip = int(self.model.prefix)
        texts = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            a += skip if data[a : a + 1] == b" " and b > a else 0
            texts.append(data[a:b].decode("utf-8", "replace"))
        return texts


_WORKERS: dict[tuple[type, str], object] = {}


def _kept(kind: type, path: str):
    """The worker's encoder or decoder; kept between tasks."""
    if (kind, path) not in _WORKERS:
        _WORKERS[kind, path] = kind(path)
    return _WORKERS[kind, path]


def transcode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, decoded`` of every row: the whole text's ids as little-endian unsigned 32-bit
    integers, and the text decoded from them.

    NULL and empty texts have no ids and decode to the empty text. A text that holds the blank's mark
    decodes with a blank in its place. Repeated rows stay rows of their own; only the two named columns
    are read. One narrow pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _kept(PieceEncoder, model), _kept(PieceDecoder, model)
        for batch in batches:
            ids = batch.column("doc_id")
            for texts in text_slices(batch.column("text"), 1 << 22):
                found = encoder.encode(texts)
                raw = found.ids.astype("<u4").tobytes()
                blobs = [raw[4 * a : 4 * b] for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(texts.row, len(texts)), pa.array(blobs, pa.binary()), pa.array(decoder.decode(found), pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    named = columns_as(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(named, run, "doc_id long, ids binary, decoded string")
