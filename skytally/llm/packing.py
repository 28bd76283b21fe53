"""Hierarchical packing of tokenized documents into sequences of several lengths.

Every task packs the documents of its own input split as they stream by, so nothing is shuffled. It collects a pool of
about ``pool_tokens`` tokens and then works from the longest tier down:

1. A document gives as many full windows of the longest tier as it can; what is left of it is routed to the smallest tier
   that holds it.
2. The longest piece of the pool opens a window of its tier. The gap behind it is filled with the longest whole piece of
   the shorter tiers that fits, again and again. If none fits, the shortest longer piece is cut, and its rest stays
   in the pool. So every window is filled exactly, and few documents are cut.
3. A window that the pool cannot fill waits for the next pool. At the end of the task its content is cut at tiers and
   then at powers of two, so that no sequence is padded.

Windows of one tier are gathered into step groups of ``step_tokens`` tokens. What is incomplete at the end of the task is
combined over tiers, longest first, so step groups stay level.

A null text is empty; an empty document still has its end token. Repeated rows are packed as often as they occur. An
empty table gives an empty result. Ids of sequences and step groups hold the number of the task and are gapless in it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from skytally.llm import hf_tokens
from skytally.llm.shared import in_slices

TIERS = (256, 512, 1024, 2048)

COLUMNS = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long, "
    "step_group long"
)


class Packer:
    """Packs pieces of documents; ``add`` and ``finish`` return closed sequences as lists of (document, start, length)."""

    def __init__(self, tiers: Sequence[int] = TIERS, pool_tokens: int = 1 << 20) -> None:
        if any(t & (t - 1) for t in tiers):
            raise ValueError("tiers are powers of two")
        self.tiers, self.longest, self.pool_tokens = sorted(tiers), max(tiers), pool_tokens
        self.pool: list[tuple[int, int, int]] = []  # (length, document, start), shortest first
        self.held = 0

    def add(self, doc: int, tokens: int) -> list[list[tuple[int, int, int]]]:
        full = tokens // self.longest
        closed = [[(doc, i * self.longest, self.longest)] for i in range(full)]
        if rest := tokens % self.longest:
            self.pool.append((rest, doc, full * self.longest))
            self.held += rest
        if self.held >= self.pool_tokens:
            closed += self._pack()
        return closed

    def finish(self) -> list[list[tuple[int, int, int]]]:
        closed = self._pack()
        left = [(doc, start, length) for length, doc, start in reversed(self.pool)]
        self.pool, self.held = [], 0
        sizes, total = [], sum(length for _, _, length in left)
        for tier in reversed(self.tiers):
            sizes += [tier] * (total // tier)
            total %= tier
        sizes += [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
        for size in sizes:
            sequence = []
            while size:
                doc, start, length = left.pop(0)
                used = min(size, length)
                sequence.append((doc, start, used))
                if used < length:
                    left.insert(0, (doc, start + used, length - used))
                size -= used
            closed.append(sequence)
        return closed

    def _pack(self) -> list[list[tuple[int, int, int]]]:
        self.pool.sort()
        pool, closed = self.pool, []
        while pool:
            length, doc, start = pool.pop()
            tier = self.tiers[bisect_left(self.tiers, length)]
            sequence, gap = [(doc, start, length)], tier - length
            while gap and pool:
                at = bisect_right(pool, gap, key=lambda piece: piece[0])
                if at:
                    length, doc, start = pool.pop(at - 1)
                    sequence.append((doc, start, length))
                    gap -= length
                else:
                    length, doc, start = pool.pop(0)
                    sequence.append((doc, start, gap))
                    insort(pool, (length - gap, doc, start + gap))
                    gap = 0
            if gap:  # the pool is used up: this window waits
                self.pool = pool = sorted((length, doc, start) for doc, start, length in sequence)
                break
            closed.append(sequence)
        self.held = sum(length for length, _, _ in pool)
        return closed


class StepGroups:
    """Numbers of step groups for sequences of several tiers."""

    def __init__(self, step_tokens: int) -> None:
        self.step_tokens, self.next = step_tokens, 0
        self.open: dict[int, list] = {}

    def add(self, tier: int, item) -> list[tuple[object, int]]:
        """Items whose group is closed by this one, with its number."""
        group = self.open.setdefault(tier, [])
        group.append(item)
        if len(group) * tier < self.step_tokens:
            return []
        del self.open[tier]
        self.next += 1
        return [(x, self.next - 1) for x in group]

    def finish(self) -> list[tuple[object, int]]:
        out, room = [], 0
        for tier, group in sorted(self.open.items(), reverse=True):
            for item in group:
                if room < tier:
                    self.next, room = self.next + 1, self.step_tokens
                room -= tier
                out.append((item, self.next - 1))
        self.open = {}
        return out


def pack_documents(
    df: DataFrame,
    tokenizer_path: str,
    *,
    tiers: Sequence[int] = TIERS,
    end_id: int = 1,
    step_tokens: int = 1 << 15,
    pool_tokens: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = 256,
    with_ids: bool = False,
    special_tokens: bool = False,
) -> DataFrame:
    """One row per piece of a document: where it starts in its document, where it stands in its sequence, the
    sequence's tier and step group. ``with_ids`` adds the piece's ids; ``special_tokens`` is
    that of ``hf_tokens.text_encoder``. ``tokenizer_path`` must be readable on every
    executor. A task holds the ids of its pool and of one open step group per tier."""
    names = [id_col, *(c.split()[0] for c in COLUMNS.split(", "))] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, _ = hf_tokens.text_encoder(tokenizer_path, special_tokens)
        base = TaskContext.get().partitionId() << 33
        packer, groups = Packer(tiers, pool_tokens), StepGroups(step_tokens)
        held: dict[int, list] = {}  # number of a document -> its id, its ids, tokens not yet placed
        out: dict[str, list] = {n: [] for n in names}
        kinds: dict[str, pa.DataType] = {}
        n_docs = n_sequences = 0

        def place(sequence: list[tuple[int, int, int]]) -> None:
            nonlocal n_sequences
            offset, rows_ = 0, []
            for doc, start, length in sequence:
                entry = held[doc]
                ids = entry[1][start : start + length]
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                rows_.append((entry[0], start, length, crc, len(entry[1]), base + n_sequences, offset, ids))
                offset += length
                entry[2] -= length
                if not entry[2]:
                    del held[doc]
            n_sequences += 1
            tier = packer.tiers[min(bisect_left(packer.tiers, offset), len(packer.tiers) - 1)]
            for closed, number in groups.add(tier, (tier, rows_)):
                emit(closed, number)

        def emit(item: tuple, number: int) -> None:
            tier, rows_ = item
            for row in rows_:
                for name, value in zip(names, (*row[:7], tier, base + number, row[7]), strict=False):
                    out[name].append(value)

        def flush() -> pa.RecordBatch:
            types = [kinds.get(id_col, pa.int64()), *[pa.int64()] * 8] + [pa.list_(pa.int32())] * with_ids
            batch = pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, types, strict=True)], names)
            for values in out.values():
                values.clear()
            return batch

        for batch in in_slices(batches, rows):
            kinds[id_col] = batch.schema.field(0).type
            encoded = encode(batch.column(1).to_pylist())
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids = np.append(ids, np.int32(end_id))
                held[n_docs] = [doc_id, ids, len(ids)]
                for sequence in packer.add(n_docs, len(ids)):
                    place(sequence)
                n_docs += 1
            if len(out[id_col]) >= 4096:
                yield flush()
        for sequence in packer.finish():
            place(sequence)
        for item, number in groups.finish():
            emit(item, number)
        if out[id_col]:
            yield flush()

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {COLUMNS}" + ", ids array<int>" * with_ids
    return df.select(id_col, text_col).mapInArrow(run, schema)
