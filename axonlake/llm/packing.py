"""Sum-of-squares packing of documents' tokens into sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .tokens import encoded

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Tokens that are packed together, which bounds what a task holds.
RUN_TOKENS = 1 << 25
#: Pieces, and words, whose ids a worker keeps at most, besides a run's ids.
KNOWN = 200_000


class Packer:
    """Online packing into windows of size tokens. levels[h] counts the windows filled to h, 0 < h < size. A piece of r
    tokens goes to the level h (or a new window) that least increases the sum of the squared counts; ties take the
    fullest. A document of size tokens or more first fills whole windows. What is open at the end is merged by cutting:
    the emptiest windows fill the gaps of the fullest, and the last one is cut at powers of two, which need no padding.
    """

    def __init__(self, size: int):
        self.size, self.levels, self.open, self.held, self.next = size, np.zeros(size + 1, np.int64), {}, 0, 0

    def _window(self) -> int:
        self.next += 1
        return self.next - 1

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[tuple]:
        total = len(ids)
        self.held += total
        whole = total - total % self.size
        for s in range(0, whole, self.size):
            yield self._row((doc, s, ids[s : s + self.size], total), self._window(), 0)
        r = total - whole
        if not r:
            return
        piece = (doc, whole, ids[whole:], total)
        n = self.levels
        # What lifting a window from h to h + r adds to the sum of squares, less 2; a full window is no longer counted.
        cost = np.where(n[1 : self.size - r + 1] > 0, 2 * (n[1 + r :] - n[1 : self.size - r + 1]), np.iinfo(np.int64).max)
        if len(cost) and cost[-1] <= 0:
            cost[-1] -= 1
        best = len(cost) - 1 - int(np.argmin(cost[::-1])) if len(cost) else -1
        h = best + 1 if best >= 0 and cost[best] <= 2 * n[r] - 1 else 0
        w, pieces = self.open[h].pop() if h else (self._window(), [])
        self.levels[h] -= h > 0
        pieces.append(piece)
        if h + r == self.size:
            yield from self._rows(w, pieces)
        else:
            self.levels[h + r] += 1
            self.open.setdefault(h + r, []).append((w, pieces))

    def _row(self, piece, window, offset) -> tuple:
        doc, start, ids, total = piece
        return doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, window, offset

    def _rows(self, window, pieces) -> Iterator[tuple]:
        at = 0
        for p in pieces:
            yield self._row(p, window, at)
            at += len(p[2])

    def merge(self) -> Iterator[tuple]:
        """Empties the open windows; the next document starts anew."""
        windows = [(h, w, p) for h in sorted(self.open, reverse=True) for w, p in self.open[h]]
        self.open, self.held = {}, 0
        self.levels[:] = 0
        left, right, spare = 0, len(windows) - 1, []
        while left <= right:
            h, w, pieces = windows[left]
            while h < self.size and (spare or right > left):
                if not spare:
                    spare = windows[right][2][::-1]
                    right -= 1
                doc, start, ids, total = spare.pop()
                take = min(self.size - h, len(ids))
                pieces.append((doc, start, ids[:take], total))
                if take < len(ids):
                    spare.append((doc, start + take, ids[take:], total))
                h += take
            left += 1
            if h == self.size:
                yield from self._rows(w, pieces)
            else:
                spare = pieces[::-1]
        if not spare:
            return
        rest = spare[::-1]
        n = sum(len(p[2]) for p in rest)
        for bit in reversed(range(n.bit_length())):
            if n >> bit & 1:
                w, at, want = self._window(), 0, 1 << bit
                while at < want:
                    doc, start, ids, total = rest.pop(0)
                    take = min(want - at, len(ids))
                    yield self._row((doc, start, ids[:take], total), w, at)
                    if take < len(ids):
                        rest.insert(0, (doc, start + take, ids[take:], total))
                    at += take


def _pack(path: str, spaced: bool, end: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, packer = TaskContext.get().partitionId() << 36, Packer(size)
        names = [f.split()[0] for f in SCHEMA.split(", ")]

        def table(rows):
            cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(7)]
            cols[5] = pa.array([r[5] + base for r in rows], pa.int64())
            return pa.RecordBatch.from_arrays(cols, names)

        rows: list[tuple] = []
        for d, ids in encoded(batches, path, spaced, end, most=KNOWN):
            rows.extend(packer.add(d, ids))
            if packer.held >= RUN_TOKENS:
                rows.extend(packer.merge())
            if len(rows) >= 20_000:
                yield table(rows)
                rows = []
        rows.extend(packer.merge())
        yield table(rows)

    return run


def packed(docs: DataFrame, path: str, spaced: bool = False, end: int = 2, size: int = 4096) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of sequences of at most size tokens.

    Each partition of the input packs its own documents in their order, so nothing is shuffled, a lost task is redone
    alike, and a document never waits for another machine; a partition of over RUN_TOKENS tokens is packed in runs of that
    many, so a task holds a run's ids at most. sequence_id is the partition and a running number. Null and
    empty texts are the end id alone; repeated rows are packed each; no rows give no pieces; other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pack(path, spaced, end, size), SCHEMA)
