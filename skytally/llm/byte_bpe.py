"""Byte-level BPE encoding and decoding with numpy matrices.

Pieces of text (matches of the tokenizer's pattern) are put into buckets by length. A bucket is one padded matrix with a
row per piece, first of single-byte ids. In each round every row looks up its adjacent pairs in a hash table, merges its
leftmost pair of minimum rank, and is compacted by one place; rows without a pair that merges leave the matrix. A piece
that is itself in the vocabulary is one id.

Null texts are empty; an empty text has no ids. Rows are encoded apart from each other, so repeated rows get equal
results and an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skytally.llm.pretokens import ChunkEncoder
from skytally.llm.shared import in_slices

NONE = np.int32(2**31 - 1)

# Cells of one matrix; a longer bucket is cut into several matrices.
CELLS = 4_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PairTable:
    """Open-addressing hash table from pairs of ids to the id of their concatenation, looked up by whole arrays."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = rank
        self.bits = max(4, int(len(pairs) * 2).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys, values = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32)
        slots = self._slot(keys)
        while len(keys):
            # Of the keys that want the same free slot one gets it; the others go on to the next slot.
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values = keys[~placed], values[~placed]
            slots = (slots[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the merged pairs, ``NONE`` where a pair does not merge."""
        keys = (left.astype(np.int64) << 32) | right
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out


class ByteBpe:
    """Encoder and decoder for one file of ranks."""

    # Pieces of more bytes than this are merged one by one with a heap: a matrix would need as many rounds as bytes.
    LONG = 512

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.pool = np.zeros(int(self.lengths.sum()), np.uint8)
        for token, rank in ranks.items():
            self.pool[self.starts[rank] : self.starts[rank] + len(token)] = np.frombuffer(token, np.uint8)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of every piece, in order."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if (rank := self.ranks.get(piece)) is not None:
                out[i] = np.array([rank], np.int32)
            elif len(piece) > self.LONG:
                out[i] = self._merge_long(piece)
            elif piece:
                buckets.setdefault(-(-len(piece) // 4) * 4, []).append(i)
        for width, members in sorted(buckets.items()):
            step = max(1, CELLS // width)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for i, ids in zip(part, self._merge_matrix([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _merge_matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        lengths = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        ids = self.byte_ids[raw]
        inside = np.arange(width)
        ids[inside >= lengths[:, None]] = -1
        done: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        rows = np.arange(len(pieces))
        merged = self._pair_ranks(ids, lengths)
        while len(rows):
            best = merged.argmin(axis=1)  # the first of equal minima: the leftmost pair
            rank = merged[np.arange(len(rows)), best]
            ended = rank == NONE
            if ended.any():
                for r, row, n in zip(rows[ended], ids[ended], lengths[ended], strict=True):
                    done[r] = row[:n].copy()
                go = ~ended
                rows, ids, lengths, best, rank = rows[go], ids[go], lengths[go], best[go], rank[go]
                if not len(rows):
                    break
            # Compaction: the merged id replaces its left half, and what stands right of the pair moves up by one.
            width = ids.shape[1]
            take = np.arange(width - 1)[None, :] + (np.arange(width - 1)[None, :] > best[:, None])
            ids = np.take_along_axis(ids, take, axis=1)
            ids[np.arange(len(rows)), best] = rank
            lengths = lengths - 1
            merged = self._pair_ranks(ids, lengths)
        return done

    def _pair_ranks(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if ids.shape[1] < 2:
            return np.full((len(ids), 1), NONE, np.int32)
        out = np.full((ids.shape[0], ids.shape[1] - 1), NONE, np.int32)
        valid = np.arange(ids.shape[1] - 1)[None, :] < (lengths - 1)[:, None]
        out[valid] = self.pairs.lookup(ids[:, :-1][valid], ids[:, 1:][valid])
        return out

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece: a heap of (rank, place) over a linked list."""
        import heapq

        ids = [int(i) for i in self.byte_ids[np.frombuffer(piece, np.uint8)]]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        arr = np.array(ids, np.int32)
        ranks = self.pairs.lookup(arr[:-1], arr[1:]).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r != NONE]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = after[i]
            if j < len(ids):
                r = int(self.pairs.lookup(np.array([ids[i]], np.int32), np.array([ids[j]], np.int32))[0])
                if r != NONE:
                    heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([i for i in ids if i >= 0], np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, gathered from one pool."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ends):
            return b""
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.pool[shift + np.arange(ends[-1])].tobytes()


_LOADED: dict[str, ByteBpe] = {}
_CODECS: dict[tuple, tuple] = {}


def load_bpe(path: str) -> ByteBpe:
    """The codec of a file of ranks, loaded once per worker."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(load_ranks(path))
    return _LOADED[path]


def text_encoder(path: str, pattern: str) -> tuple[Callable[[list], list], ByteBpe]:
    """A function from texts to arrays of ids, and the codec it uses. Loaded once per worker."""
    if (path, pattern) not in _CODECS:
        bpe = load_bpe(path)
        encoder = ChunkEncoder(pattern, lambda ps: [i.tobytes() for i in bpe.encode_pieces([p.encode() for p in ps])])
        _CODECS[path, pattern] = (encoder.encode, bpe)
    encode, bpe = _CODECS[path, pattern]
    return lambda texts: [np.frombuffer(ids, np.int32) for ids in encode(texts)], bpe


def encode_documents(
    df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", rows: int = 256
) -> DataFrame:
    """Ids of every whole text: the id column, ``ids`` (array of int) and ``decoded`` (binary). ``path`` must be readable
    on every executor. No shuffle; memory grows with the longest ``rows`` texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bpe = text_encoder(path, pattern)
        for batch in in_slices(batches, rows):
            ids = encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(i) for i in ids], pa.binary())],
                [id_col, "ids", "decoded"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded binary")


def digest_documents(
    df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", rows: int = 256
) -> DataFrame:
    """Per document the number of ids, the SHA-256 of the ids in decimal with a blank between, and the SHA-256 of the
    bytes that the ids decode to. Like ``encode_documents``, without sending ids back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bpe = text_encoder(path, pattern)
        decimal = np.array([b"%d" % i for i in range(len(bpe.lengths))], object)
        for batch in in_slices(batches, rows):
            ids = encode(batch.column(1).to_pylist())
            shown = [hashlib.sha256(b" ".join(decimal[i].tolist())).hexdigest() for i in ids]
            decoded = [hashlib.sha256(bpe.decode(i)).hexdigest() for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(i) for i in ids], pa.int64()), pa.array(shown), pa.array(decoded)],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
