"""Hierarchical multi-length packing.

Documents become token ids with an end id and are cut into pieces that fill sequences.

* Routing: whole windows of the longest tier are taken from a document directly; what remains goes
  to the shortest tier (a power of two) that holds it.
* Each tier is packed from the longest down: a window opens with an item of its own tier, and its
  gap is filled with whole items of shorter tiers, largest first; the last gap is closed by cutting
  one item. So windows of every tier end up exactly full.
* What is left of a task at its end is cut into powers of two, which need no padding either.
* Sequences are dealt to step groups so that their token counts are balanced.

A task packs what it reads, in windows of ``group_tokens``: memory is bounded, nothing is shuffled,
and a task that runs again packs the same way. Ids of sequences and steps carry the task's number.
"""

from __future__ import annotations

import heapq
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from loamline.llm.bpe import encoder
from loamline.llm.tables import slices

GROUP_TOKENS = 1 << 19
_TASK_BITS = 38


class Packer:
    """Packs (document, ids) pairs; ``flush`` gives finished pieces."""

    def __init__(self, length: int, width: int):
        if length < 1 or length & (length - 1):
            raise ValueError("the sequence length must be a power of two")
        self.length, self.width = length, width
        self.tiers = [1 << k for k in range(length.bit_length() - 1, -1, -1)]
        self.queues: dict[int, deque] = {t: deque() for t in self.tiers}
        self.done: list[list[tuple]] = []
        self.waiting = 0

    def add(self, doc, ids: bytes) -> None:
        total = len(ids) // self.width
        whole = total - total % self.length
        for at in range(0, whole, self.length):
            self.done.append([(doc, total, at, self._cut(ids, at, self.length))])
        if total > whole:
            self._route((doc, total, whole, self._cut(ids, whole, total - whole)))
        self.waiting += total

    def _cut(self, ids: bytes, at: int, n: int) -> bytes:
        return ids[at * self.width : (at + n) * self.width]

    def _len(self, piece: tuple) -> int:
        return len(piece[3]) // self.width

    def _route(self, piece: tuple) -> None:
        self.queues[1 << (self._len(piece) - 1).bit_length()].append(piece)

    def _split(self, piece: tuple, n: int) -> tuple[tuple, tuple]:
        doc, total, start, ids = piece
        return (doc, total, start, self._cut(ids, 0, n)), (doc, total, start + n, ids[n * self.width :])

    def _filler(self, gap: int) -> tuple | None:
        """A whole item if one surely fits, else the head of the shortest longer one."""
        for t in self.tiers:
            if t <= gap and self.queues[t]:
                return self.queues[t].popleft()
        for t in reversed(self.tiers):
            if t > gap and self.queues[t]:
                piece = self.queues[t].popleft()
                if self._len(piece) > gap:
                    piece, rest = self._split(piece, gap)
                    self._route(rest)
                return piece
        return None

    def pack(self) -> list[tuple]:
        """Packs the queues; returns the pieces of the one window that stayed open."""
        for t in self.tiers:
            while self.queues[t]:
                window = [self.queues[t].popleft()]
                gap = t - self._len(window[0])
                while gap:
                    piece = self._filler(gap)
                    if piece is None:
                        return window
                    window.append(piece)
                    gap -= self._len(piece)
                self.done.append(window)
        return []

    def flush(self, last: bool) -> list[list[tuple]]:
        """Sequences as lists of pieces. What stays open waits for more unless this is the end."""
        rest = self.pack()
        if last:
            left = sum(map(self._len, rest))
            rest.reverse()
            while left:
                gap = room = 1 << (left.bit_length() - 1)
                window = []
                while gap:
                    piece = rest.pop()
                    if self._len(piece) > gap:
                        piece, tail = self._split(piece, gap)
                        rest.append(tail)
                    window.append(piece)
                    gap -= self._len(piece)
                self.done.append(window)
                left -= room
        else:
            for piece in rest:
                self._route(piece)
        out, self.done, self.waiting = self.done, [], 0
        return out


def balanced_steps(lengths: list[int], budget: int) -> list[int]:
    """A step number for each sequence: longest first, always to the step with fewest tokens."""
    steps = [(0, i) for i in range(max(1, -(-sum(lengths) // budget)))]
    out = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        tokens, step = heapq.heappop(steps)
        out[i] = step
        heapq.heappush(steps, (tokens + lengths[i], step))
    return out


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = 1024,
    end_id: int = 0,
    step_tokens: int = 1 << 16,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32 bit), doc_tokens,
    sequence_id, offset, sequence_length, step_id.

    ``tokenizer`` is the path of a file of the tokenizers library that every worker can read. Each
    row of ``docs`` is a document of its own, repeated rows included; null text is empty and gives
    the end id alone. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    plain = docs.select(docs[id_col].alias("id"), docs[text].alias("text"))
    schema = (
        f"`{id_col}` {plain.schema['id'].dataType.simpleString()}, start long, length long, ids binary, "
        "doc_tokens long, sequence_id long, offset long, sequence_length int, step_id long"
    )

    def run(batches):
        tokens = encoder(tokenizer)
        packer = Packer(length, tokens.dtype.itemsize)
        end = np.array([end_id], tokens.dtype).tobytes()
        base = TaskContext.get().partitionId() << _TASK_BITS
        sequences = steps = 0
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for part in slices(batch, 500):
                ids = part.column(0).to_pylist()
                for doc, coded in zip(ids, tokens.encode(part.column(1).to_pylist())):
                    packer.add(doc, coded + end)
                if packer.waiting >= group_tokens:
                    done = packer.flush(False)
                    if done:
                        yield from _rows(done, tokens.dtype, id_type, base + sequences, base + steps, step_tokens)
                        sequences += len(done)
                        steps += len(done)
        done = packer.flush(True)
        if done:
            yield from _rows(done, tokens.dtype, id_type, base + sequences, base + steps, step_tokens)

    return plain.mapInArrow(run, schema)


def _rows(done, dtype, id_type, first: int, first_step: int, step_tokens: int):
    width = dtype.itemsize
    lengths = [sum(len(p[3]) for p in window) // width for window in done]
    steps = balanced_steps(lengths, step_tokens)
    columns: list[list] = [[] for _ in range(9)]
    for i, window in enumerate(done):
        offset = 0
        for doc, total, start, ids in window:
            n = len(ids) // width
            wide = np.frombuffer(ids, dtype).astype("<u4").tobytes()
            row = (doc, start, n, wide, total, first + i, offset, lengths[i], first_step + steps[i])
            for column, value in zip(columns, row):
                column.append(value)
            offset += n
    longs = pa.int64()
    types = [id_type, longs, longs, pa.binary(), longs, longs, longs, pa.int32(), longs]
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_length", "step_id"]
    arrays = [pa.array(c, t) for c, t in zip(columns, types)]
    whole = pa.RecordBatch.from_arrays(arrays, names)
    yield from slices(whole, 4_096)
