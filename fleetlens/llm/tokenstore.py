"""Token ids of all documents in one concatenated array, its document bounds in Elias-Fano form.

The array is stored in segments, one row of a Parquet table each, in ascending order of the key. A
segment's ``payload`` is a small binary file:

    8 bytes   magic
    u32       bytes per id (2 or 4), then u32 number of documents, u64 number of ids
    u32, i64  number of documents without a key, which come first, and the least key
    keys      the other keys less the least one, a rising sequence
    ends      the documents' ends, a rising sequence
    ids       little-endian unsigned ids

A rising sequence is in Elias-Fano form:

    u32       number of low bits, then u32 sizes of low and high in bytes
    low       the low bits of each value, packed
    high      a bit vector with a one at (value >> low bits) + i for value i
    ranks     u32 number of ones before every 512th byte of the vector

A value costs about 2 + log2(greatest / number) bits instead of 64, keys as well as ends. ``select`` finds the
i-th one through the sampled ranks, and from it a value. Beside the store, ``starts`` holds where each segment begins.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import map_arrow, small_batches
from fleetlens.llm.tokens import pieces

MAGIC = b"EFTOKEN2"
SEGMENT = 1 << 20
BLOCK = 512
_HEAD = struct.Struct("<8sIIQIq")
_SEQUENCE = struct.Struct("<III")
_SCHEMA = "part int, segment int, n_docs bigint, n_tokens bigint, payload binary"


class EliasFano:
    """A rising sequence of numbers in near-minimal space with select."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray) -> None:
        self.n, self.bits, self.low, self.high, self.ranks = n, bits, low, high, ranks

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max((top // n).bit_length() - 1, 0) if n else 0
        each = np.empty((n, bits), dtype=np.uint8)
        for bit in range(bits):
            each[:, bit] = (values >> np.uint64(bit)) & np.uint64(1)
        low = np.packbits(each.ravel(), bitorder="little")
        at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(at[-1]) + 1 if n else 0, dtype=np.uint8)
        flags[at] = 1
        high = np.packbits(flags, bitorder="little")
        return cls(n, bits, low, high, cls._ranks(high))

    @staticmethod
    def _ranks(high: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(high).astype(np.int64)
        return np.concatenate(([0], np.cumsum(ones)))[:-1:BLOCK].astype(np.uint32)

    def select(self, i: int) -> int:
        """The position of the i-th one, counted from 0, in the high vector."""
        block = int(np.searchsorted(self.ranks, i, side="right")) - 1
        part = self.high[block * BLOCK : (block + 1) * BLOCK]
        ones = np.flatnonzero(np.unpackbits(part, bitorder="little"))
        return block * BLOCK * 8 + int(ones[i - int(self.ranks[block])])

    def __getitem__(self, i: int) -> int:
        at = np.arange(i * self.bits, (i + 1) * self.bits)
        low = int((((self.low[at >> 3] >> (at & 7)) & 1).astype(np.int64) << np.arange(self.bits)).sum())
        return ((self.select(i) - i) << self.bits) | low

    def all(self) -> np.ndarray:
        """All values in one pass."""
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n] - np.arange(self.n)
        flags = np.unpackbits(self.low, bitorder="little")[: self.n * self.bits].reshape(self.n, self.bits)
        out = high << self.bits
        for bit in range(self.bits):
            out |= flags[:, bit].astype(np.int64) << bit
        return out

    def dump(self) -> bytes:
        parts = (self.low.tobytes(), self.high.tobytes(), self.ranks.astype("<u4").tobytes())
        return b"".join((_SEQUENCE.pack(self.bits, len(self.low), len(self.high)), *parts))

    @classmethod
    def load(cls, n: int, payload: bytes, at: int) -> tuple[EliasFano, int]:
        """The sequence of ``n`` values that begins at ``at``, and where it ends."""
        bits, n_low, n_high = _SEQUENCE.unpack_from(payload, at)
        parts = []
        at += _SEQUENCE.size
        for kind, count in (("u1", n_low), ("u1", n_high), ("<u4", -(-n_high // BLOCK))):
            parts.append(np.frombuffer(payload, kind, count, at))
            at += parts[-1].nbytes
        return cls(n, bits, *parts), at


def pack_segment(keys: list[int | None], ends: np.ndarray, ids: bytes) -> bytes:
    """Rising keys, those that are null first, rising ends and little-endian 32-bit ids as one payload."""
    array = np.frombuffer(ids, "<u4")
    width = 2 if not len(array) or int(array.max()) < 1 << 16 else 4
    known = np.array([k for k in keys if k is not None], dtype=np.int64)
    least = int(known[0]) if len(known) else 0
    # Unsigned, so that the whole range of keys fits.
    numbers = EliasFano.encode(known.view(np.uint64) - np.int64(least).view(np.uint64))
    head = _HEAD.pack(MAGIC, width, len(keys), len(array), len(keys) - len(known), least)
    data = array.astype(f"<u{width}").tobytes()
    return b"".join((head, numbers.dump(), EliasFano.encode(ends).dump(), data))


def read_segment(payload: bytes) -> tuple[list[int | None], EliasFano, np.ndarray]:
    """Keys, ends and ids of a payload."""
    magic, width, n, n_ids, unknown, least = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    numbers, at = EliasFano.load(n - unknown, payload, _HEAD.size)
    bounds, at = EliasFano.load(n, payload, at)
    keys = [None] * unknown + (numbers.all() + np.int64(least)).tolist()
    return keys, bounds, np.frombuffer(payload, f"<u{width}", n_ids, at)


def write(
    documents: DataFrame,
    path: str,
    vocabulary: str,
    text: str = "text",
    key: str = "doc_id",
    end_id: int = 1,
    segment: int = SEGMENT,
) -> None:
    """Encode all texts and write their segments below ``path`` in ascending order of the key.

    Nulls among the keys come first; equal keys are ordered by text and each is a document. A null or
    empty text is the end id alone. A segment closes at the first document that brings it to ``segment``
    ids, so a task holds that many and one document.
    """
    small_batches(documents.sparkSession)
    rows = documents.select(
        F.col(key).cast("bigint").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    rows = rows.repartitionByRange("doc").sortWithinPartitions("doc", "text")
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = pieces(vocabulary).encode
        part = TaskContext.get().partitionId()
        keys, ends, ids, total, number = [], [], [], 0, 0

        def closed() -> pa.RecordBatch:
            payload = pack_segment(keys, np.array(ends, dtype=np.uint64), b"".join(ids))
            values = (part, number, len(keys), total, payload)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            names = ["part", "segment", "n_docs", "n_tokens", "payload"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = encode(value.as_py()) + end
                keys.append(doc)
                ids.append(data)
                total += len(data) // 4
                ends.append(total)
                if total >= segment:
                    yield closed()
                    keys, ends, ids, total, number = [], [], [], 0, number + 1
        if keys:
            yield closed()

    rows.mapInArrow(run, _SCHEMA).write.parquet(f"{path}/segments")
    _starts(documents.sparkSession.read.schema(_SCHEMA).parquet(f"{path}/segments")).write.parquet(f"{path}/starts")


def _starts(segments: DataFrame) -> DataFrame:
    """How many ids lie before each segment."""
    sizes = segments.select("part", "segment", "n_tokens")
    before = (Window.unboundedPreceding, -1)
    # Two prefix sums: one row per partition, then the segments within each.
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    base = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(*before)), F.lit(0))
    inner = Window.partitionBy("part").orderBy("segment").rowsBetween(*before)
    return sizes.join(totals.select("part", base.alias("base")), "part").select(
        "part",
        "segment",
        (F.col("base") + F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).alias("first"),
    )


def read(documents_path: str, spark) -> DataFrame:
    """One row per document of a written store: doc_id, start, n_tokens and ids_crc32, the unsigned crc32
    of its ids as little-endian unsigned 32-bit numbers.

    Where the starts are below Spark's broadcast size, by that of their files, no payload is shuffled."""
    small_batches(spark)
    segments = spark.read.schema(_SCHEMA).parquet(f"{documents_path}/segments")
    starts = spark.read.schema("part int, segment int, first bigint").parquet(f"{documents_path}/starts")
    rows = segments.join(starts, ["part", "segment"]).select("first", "payload")

    def run(batch: pa.RecordBatch) -> dict:
        out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
        for first, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
            keys, bounds, ids = read_segment(payload.as_py())
            at = 0
            for key, end in zip(keys, bounds.all().tolist()):
                out["doc_id"].append(key)
                out["start"].append(first + at)
                out["n_tokens"].append(end - at)
                out["ids_crc32"].append(zlib.crc32(ids[at:end].astype("<u4").tobytes()))
                at = end
        return out

    return map_arrow(rows, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
