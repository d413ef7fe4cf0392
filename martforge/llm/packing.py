"""Packing token ids into fixed windows by minimum bin slack.

Documents are encoded, given an end id, and cut at every full window; the
full windows need no packing.  The remainders wait in a pool, counted by
length.  A window starts with the longest waiting remainder; a subset-sum
dynamic program over the multiset of the other lengths, one bit per reachable
total, finds the total closest to the capacity, and walking back through its
steps gives how many pieces of each length to take.  The same choice is used
again as long as the counts allow.  What is still free in a window (at the end
of a task, when few lengths are left) is filled by cutting the longest waiting
piece, so windows are full; the last partial window of a task is cut into
sequences whose lengths are powers of two, which need no padding.

Every task packs the documents it reads, with a bounded pool: nothing is
shuffled, and no group of documents meets in one task.  Sequence ids are unique
over all tasks (task number times 2^31 plus a counter).

A null text is the empty text (the end id only).  Repeated rows are packed each;
other columns are ignored; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martforge.llm import common
from martforge.llm.word_tokens import encoder

POOL = 4096  # remainders that wait in a task before windows are built


class Pool:
    """Waiting pieces by length."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_length: dict[int, list] = {}
        self.lengths: list[int] = []  # the lengths that wait, ascending
        self.size = 0

    def add(self, length: int, piece) -> None:
        waiting = self.by_length.setdefault(length, [])
        if not waiting:
            insort(self.lengths, length)
        waiting.append(piece)
        self.size += 1

    def take(self, length: int):
        waiting = self.by_length[length]
        piece = waiting.pop()
        if not waiting:
            del self.lengths[bisect_left(self.lengths, length)]
        self.size -= 1
        return piece

    def best_fill(self, room: int) -> list[tuple[int, int]]:
        """(length, count) of waiting pieces whose total is as close to ``room``
        as it gets.  Bit t of the program is set when total t can be reached;
        counts enter by doubling, and the steps are kept to walk back."""
        within = (1 << (room + 1)) - 1
        reach, steps = 1, []
        for i in range(bisect_left(self.lengths, room + 1) - 1, -1, -1):
            length = self.lengths[i]
            left, chunk = min(len(self.by_length[length]), room // length), 1
            while left:
                n = min(chunk, left)
                left -= n
                chunk *= 2
                steps.append((length, n, reach))
                reach |= (reach << (length * n)) & within
            if reach >> room:
                break
        total = reach.bit_length() - 1
        counts: dict[int, int] = {}
        for length, n, before in reversed(steps):
            if not before >> total & 1:
                counts[length] = counts.get(length, 0) + n
                total -= length * n
        return sorted(counts.items(), reverse=True)

    def windows(self, keep: int) -> Iterator[list]:
        """Windows (lists of pieces) until at most ``keep`` pieces wait."""
        while self.size > keep:
            longest = self.lengths[-1]
            lead = self.take(longest)
            fill = self.best_fill(self.capacity - longest)
            need = dict(fill)
            need[longest] = need.get(longest, 0) + 1
            yield [lead] + [self.take(n) for n, k in fill for _ in range(k)]
            while self.size > keep and all(len(self.by_length.get(n, ())) >= k for n, k in need.items()):
                yield [self.take(n) for n, k in need.items() for _ in range(k)]


def _powers(length: int) -> list[int]:
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


class Packer:
    """Pieces are (doc_id, start, ids as bytes, tokens of the document)."""

    def __init__(self, capacity: int, first_sequence: int, pool: int = POOL):
        self.capacity, self.next_sequence, self.limit = capacity, first_sequence, pool
        self.pool = Pool(capacity)

    def _sequence(self, pieces: list) -> list[tuple]:
        rows, at = [], 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            rows.append((doc, start, n, zlib.crc32(ids), total, self.next_sequence, at, ids))
            at += n
        self.next_sequence += 1
        return rows

    def _window(self, pieces: list) -> list[tuple]:
        """A window; free room is filled by cutting the longest waiting piece."""
        room = self.capacity - sum(len(p[2]) // 4 for p in pieces)
        while room and self.pool.size:
            length = self.pool.lengths[-1]
            doc, start, ids, total = self.pool.take(length)
            cut = min(room, length)
            pieces.append((doc, start, ids[:4 * cut], total))
            if cut < length:
                self.pool.add(length - cut, (doc, start + cut, ids[4 * cut:], total))
            room -= cut
        if not room:
            return self._sequence(pieces)
        rows = []
        for size in _powers(self.capacity - room):
            part, left = [], size
            while left:
                doc, start, ids, total = pieces.pop(0)
                n = min(left, len(ids) // 4)
                part.append((doc, start, ids[:4 * n], total))
                if 4 * n < len(ids):
                    pieces.insert(0, (doc, start + n, ids[4 * n:], total))
                left -= n
            rows += self._sequence(part)
        return rows

    def add(self, doc, ids: bytes) -> list[tuple]:
        total, step, rows, start = len(ids) // 4, 4 * self.capacity, [], 0
        while (start + self.capacity) <= total:
            rows += self._sequence([(doc, start, ids[4 * start:4 * start + step], total)])
            start += self.capacity
        if start < total:
            self.pool.add(total - start, (doc, start, ids[4 * start:], total))
            if self.pool.size >= self.limit:
                rows += self._drain(self.limit // 2)
        return rows

    def _drain(self, keep: int) -> list[tuple]:
        return [r for w in self.pool.windows(keep) for r in self._window(w)]

    def close(self) -> list[tuple]:
        return self._drain(0)


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, with ``with_ids``, the ids (little-endian unsigned
    32-bit); sequences are the pieces of a sequence_id by offset."""
    common.bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(common.file_bytes(tokenizer))
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    fields += [("ids", pa.binary())] * with_ids
    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n, _ in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc, end = encoder(shared.value), np.array([end_id], "<u4").tobytes()
        packer = Packer(capacity, TaskContext.get().partitionId() << 31)

        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])

        rows: list[tuple] = []
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), enc.encode(common.texts_of(batch))):
                rows += packer.add(doc, ids + end)
                if len(rows) > 5000:
                    yield out(rows)
                    rows = []
        rows += packer.close()
        if rows:
            yield out(rows)

    return common.id_and_text(docs).mapInArrow(run, schema)
