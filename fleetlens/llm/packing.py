"""Bounded-space online packing of documents into sequences of at most 4096 tokens.

Each partition keeps a fixed number of open windows. What is left of a document after its full windows
goes into the window that it fills best; if it fits nowhere, the fullest window is closed, and a fresh one
takes its place. At the end the open windows of all partitions are laid end to end and cut at
the window length, so padding stays below a window in all of them together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import small_batches, stored
from fleetlens.llm.tokens import pieces

LENGTH = 4096
OPEN_WINDOWS = 64
# Sequences closed in partition p count up from p << PART_BITS, merged ones from 1 << 62.
PART_BITS = 36
MERGED = 1 << 62
WIDTH = 4

_PIECE = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
_FIELDS = [
    ("doc_id", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("part", pa.int32()),
    ("ids", pa.binary()),
]


class Packer:
    """The open windows of one partition; a window is its length and its pieces."""

    def __init__(self, part: int, open_windows: int = OPEN_WINDOWS, length: int = LENGTH) -> None:
        self.part, self.most, self.length = part, open_windows, length
        self.next = part << PART_BITS
        self.windows: list[tuple[int, list]] = []
        self.rows: list[tuple] = []

    def _close(self, window: list) -> None:
        offset = 0
        for doc, start, total, data in window:
            n = len(data) // WIDTH
            self.rows.append((doc, start, n, zlib.crc32(data), total, self.next, offset, self.part, None))
            offset += n
        self.next += 1

    def add(self, doc: int | None, data: bytes) -> None:
        total = len(data) // WIDTH
        full = total - total % self.length
        for start in range(0, full, self.length):
            self._close([(doc, start, total, data[start * WIDTH : (start + self.length) * WIDTH])])
        n = total - full
        if not n:
            return
        piece = (doc, full, total, data[full * WIDTH :])
        best, most = -1, -1
        for i, (used, _) in enumerate(self.windows):
            if most < used <= self.length - n:
                best, most = i, used
        if best < 0 and len(self.windows) == self.most:
            fullest = max(range(len(self.windows)), key=lambda i: self.windows[i][0])
            self._close(self.windows.pop(fullest)[1])
        if best < 0:
            self.windows.append((n, [piece]))
        elif most + n == self.length:
            window = self.windows.pop(best)[1]
            self._close([*window, piece])
        else:
            self.windows[best][1].append(piece)
            self.windows[best] = (most + n, self.windows[best][1])

    def leave(self) -> None:
        """What is still open, with its ids, in the windows' order; offsets count through all of it."""
        offset = 0
        for _, window in self.windows:
            for doc, start, total, data in window:
                n = len(data) // WIDTH
                self.rows.append((doc, start, n, None, total, None, offset, self.part, data))
                offset += n
        self.windows = []

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(_FIELDS)
        self.rows = []
        arrays = [pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)]
        return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in _FIELDS])


def pack(
    documents: DataFrame,
    vocabulary: str,
    text: str = "text",
    key: str = "doc_id",
    end_id: int = 2,
    length: int = LENGTH,
    open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of the input is a document of its own, also if its key is null or comes again; a null or
    empty text is the end id alone. Each id lies in exactly one piece. Columns other than the key and
    the text are not read.
    """
    small_batches(documents.sparkSession)
    rows = documents.select(
        F.col(key).cast("bigint").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    end = end_id.to_bytes(WIDTH, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = pieces(vocabulary).encode
        packer = Packer(TaskContext.get().partitionId(), open_windows, length)
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc, encode(value.as_py()) + end)
            if packer.rows:
                yield packer.batch()
        packer.leave()
        if packer.rows:
            yield packer.batch()

    packed = stored(rows.mapInArrow(run, f"{_PIECE}, part int, ids binary"), "packed")
    names = [name for name, _ in _FIELDS[:7]]
    closed = packed.where("sequence_id is not null").select(*names)
    merged = _merged(packed.where("sequence_id is null"), length)
    return closed.union(merged).withColumnRenamed("doc_id", key)


def _merged(left: DataFrame, length: int) -> DataFrame:
    """Lay the open windows of all partitions end to end and cut them at the window length."""
    totals = left.groupBy("part").agg(F.sum("length").alias("tokens"))
    # One row per partition of the input.
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = left.join(totals.select("part", before.alias("base")), "part")
    placed = placed.select("doc_id", "start", "ids", "doc_tokens", (F.col("base") + F.col("offset")).alias("at"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, start, data, total, at in zip(*(c.to_pylist() for c in batch.columns)):
                n, done = len(data) // WIDTH, 0
                while done < n:
                    offset = (at + done) % length
                    take = min(n - done, length - offset)
                    ids = data[done * WIDTH : (done + take) * WIDTH]
                    sequence = MERGED + (at + done) // length
                    out.append((doc, start + done, take, zlib.crc32(ids), total, sequence, offset))
                    done += take
            if out:
                arrays = [pa.array(c, t) for c, (_, t) in zip(zip(*out), _FIELDS)]
                yield pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in _FIELDS[:7]])

    return placed.mapInArrow(cut, _PIECE)
