"""SentencePiece ids of whole texts through a table of their distinct marked words.

If no piece of a model crosses from a character to a white-space marker, the ids of a text are those of its marked
words (a run of markers and what follows up to the next one), in order. Documents are gathered into blocks of a task.
A block's distinct words go, in packets by hash, to the tasks that segment each word once; the ids come back
by block and are joined there by position. So a word travels once per block however often the block holds it.
A block is known by the digest of its words, in order; if a lost task's input came back in another order, the job stops
instead of joining wrong ids. Tables read from files keep their order.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import map_arrow, small_batches

MARK = "▁"
# A block closes at the first document that brings it to this many characters or distinct words.
BLOCK_CHARS = 12_000_000
BLOCK_WORDS = 500_000
# Text per packet group, and the least and most groups.
GROUP_CHARS = 64_000_000
LEAST_GROUPS, MOST_GROUPS = 512, 65_536
# Words a segmenting task remembers between packets.
MOST_WORDS = 300_000
# Words of a block whose ids are put together at once.
SLICE_WORDS = 200_000
_MARKED = re.compile(" +[^ ]*")
# Never part of UTF-8.
_BETWEEN = b"\xff"


class _Numbers(dict):
    """Numbers for words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = out = len(self)
        return out


def marked_words(text: str) -> list[str]:
    """The marked words of a text, each without its first marker, which encoding puts back."""
    text = text.replace(MARK, " ")
    if not text:
        return []
    if "  " in text or text[0] == " ":
        return [word[1:] for word in _MARKED.findall(" " + text)]
    return text.split(" ")


_LOADED: dict[str, object] = {}


def model(path: str):
    """The processor of a model file, kept for the life of the Python worker.

    ValueError if its pieces may cross markers or it changes more of a text than its spaces."""
    if path not in _LOADED:
        from sentencepiece import SentencePieceProcessor

        loaded = SentencePieceProcessor(model_file=path)
        pieces = map(loaded.id_to_piece, range(loaded.get_piece_size()))
        probe = "a  ﬁ① Å\n\tb "
        plain = loaded.normalize(probe) == MARK + probe.replace(" ", MARK)
        if not plain or loaded.piece_to_id(MARK) == loaded.unk_id() or any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError(f"the words of {path} can't be segmented one by one")
        _LOADED[path] = loaded
    return _LOADED[path]


def segment(words: list[str], path: str) -> list[list[int]]:
    """The ids of marked words."""
    loaded = model(path)
    out = loaded.encode(words, num_threads=1) if words else []
    lone = [loaded.piece_to_id(MARK)]
    return [ids if word else lone for word, ids in zip(words, out)]


class _Block:
    """Documents with their words numbered by falling frequency."""

    def __init__(self) -> None:
        self.keys: list[pa.Array] = []
        self.counts: list[int] = []
        self.at: list[np.ndarray] = []
        self.numbers, self.chars = _Numbers(), 0

    def add(self, key: pa.Array, text: str) -> None:
        words = marked_words(text)
        self.keys.append(key)
        self.counts.append(len(words))
        self.at.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))
        self.chars += len(text)

    def full(self) -> bool:
        return self.chars >= BLOCK_CHARS or len(self.numbers) >= BLOCK_WORDS

    def closed(self, groups: int) -> tuple[int, list[bytes], np.ndarray, np.ndarray]:
        """Digest of the words, the words and their groups, and each document's numbers, one after the other."""
        at = np.concatenate(self.at)
        order = np.argsort(-np.bincount(at, minlength=len(self.numbers)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        names = list(self.numbers)
        words = [names[i].encode() for i in order.tolist()]
        group = np.fromiter((zlib.crc32(w) % groups for w in words), np.int32, len(words))
        digest = xxhash.xxh3_64_intdigest(_BETWEEN.join(words)) - (1 << 63)
        return digest, words, group, rank[at] if len(order) else at


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    block = _Block()
    for batch in batches:
        for i, text in enumerate(batch.column(1)):
            block.add(batch.column(0).slice(i, 1), text.as_py())
            if block.full():
                yield block
                block = _Block()
    if block.counts:
        yield block


def _flat(lists: list[bytes]) -> bytes:
    """Lists of 32-bit numbers as one compressed string: their sizes, then their numbers."""
    sizes = np.fromiter(map(len, lists), "<u4", len(lists)) // 4
    return zlib.compress(sizes.tobytes() + b"".join(lists), 1)


def _packets(rows: DataFrame, groups: int) -> DataFrame:
    """One row per block and group of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            digest, words, group, _ = block.closed(groups)
            order = np.argsort(group, kind="stable")
            bounds = np.flatnonzero(np.diff(group[order], prepend=-1))
            packed = [
                zlib.compress(_BETWEEN.join([words[i] for i in part.tolist()]), 1)
                for part in np.split(order, bounds[1:])
                if len(part)
            ]
            if packed:
                numbers = pa.array(group[order][bounds], pa.int32())
                arrays = [pa.array([digest] * len(packed), pa.int64()), numbers, pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["block", "group", "words"])

    return rows.mapInArrow(run, "block bigint, group int, words binary")


def _segmented(packets: DataFrame, path: str) -> DataFrame:
    """The packets with ids instead of words. The rows of a group of words meet in one task, one per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bytes] = {}
        for batch in batches:
            out = []
            for packed in batch.column(2):
                words = zlib.decompress(packed.as_py()).decode("utf-8", "surrogateescape").split("\udcff")
                if len(known) > MOST_WORDS:
                    known.clear()
                new = [w for w in words if w not in known]
                known.update((w, array("I", ids).tobytes()) for w, ids in zip(new, segment(new, path)))
                out.append(_flat([known[w] for w in words]))
            arrays = [batch.column(0), batch.column(1), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "group", "ids"])

    return packets.repartition("group").mapInArrow(run, "block bigint, group int, ids binary")


def _documents(rows: DataFrame, groups: int, kind: str) -> DataFrame:
    """One row per block: its documents' keys and numbers of words, the groups of its words, and where they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            digest, _, group, at = block.closed(groups)
            keys = pa.concat_arrays(block.keys)
            arrays = [
                pa.array([digest], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                pa.array([block.counts], pa.list_(pa.int64())),
                pa.array([zlib.compress(group.astype("<i4").tobytes(), 1)], pa.binary()),
                pa.array([zlib.compress(at.astype("<u4").tobytes(), 1)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "keys", "counts", "groups", "at"])

    return rows.mapInArrow(run, f"block bigint, keys array<{kind}>, counts array<bigint>, groups binary, at binary")


def _joined(documents: pa.Table, found: pa.Table, key: str, end_id: int) -> pa.Table:
    """Ids per document of one block, from the ids of its words by position."""
    parts = dict(zip(found.column("group").to_pylist(), found.column("ids").to_pylist()))
    keys, ids = [], []
    for row in range(documents.num_rows):
        group = np.frombuffer(zlib.decompress(documents.column("groups")[row].as_py()), "<i4")
        at = np.frombuffer(zlib.decompress(documents.column("at")[row].as_py()), "<u4")
        if set(np.unique(group).tolist()) != set(parts):
            raise RuntimeError("the input came back in another order; write it to a table first")
        size_of = np.bincount(group) if len(group) else group
        sizes, values = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
        for number in sorted(parts):
            own = np.frombuffer(zlib.decompress(parts[number]), "<u4")
            n = int(size_of[number])
            sizes.append(own[:n])
            values.append(own[n:])
        order = np.argsort(group, kind="stable")
        size = np.zeros(len(group), np.int64)
        size[order] = np.concatenate(sizes)
        start = np.zeros(len(group), np.int64)
        start[order] = np.cumsum(size[order]) - size[order]
        value = np.concatenate(values)
        counts = documents.column("counts")[row].values.to_numpy()
        bounds = np.concatenate(([0], np.cumsum(counts)))
        first = 0
        while first < len(counts):
            # As many documents as have SLICE_WORDS words, one at least.
            last = max(int(np.searchsorted(bounds, bounds[first] + SLICE_WORDS, side="right")) - 1, first + 1)
            words = at[bounds[first] : bounds[last]]
            each = size[words]
            ends = np.cumsum(each)
            place = np.repeat(start[words] - (ends - each), each) + np.arange(int(each.sum()))
            stops = np.concatenate(([0], ends))[bounds[first : last + 1] - bounds[first]]
            # An end id after each document.
            flat = np.insert(value[place].astype(np.int32), stops[1:], end_id)
            stops = (stops + np.arange(len(stops))).astype(np.int32)
            ids.append(pa.ListArray.from_arrays(pa.array(stops), pa.array(flat)))
            first = last
        keys.append(documents.column("keys")[row].values)
    return pa.table({key: pa.concat_arrays(keys), "ids": pa.chunked_array(ids, pa.list_(pa.int32()))})


def encode(documents: DataFrame, path: str, text: str = "text", key: str = "doc_id", end_id: int = 2) -> DataFrame:
    """The key and ``ids`` (array of int, the end id last) of every row's whole text.

    A null text counts as empty and has the end id alone. Repeated rows and equal or null keys are documents of
    their own. A text without spaces is one word, however long, and is segmented by one task. A task holds
    a block: ``BLOCK_CHARS`` characters or ``BLOCK_WORDS`` distinct words and one document more. A word, however
    frequent, sends one row part per block; an empty table gives no rows.
    """
    model(path)
    small_batches(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = min(max(chars // GROUP_CHARS, LEAST_GROUPS), MOST_GROUPS)
    found = _segmented(_packets(rows, groups), path).groupBy("block")
    blocks = _documents(rows, groups, kind).groupBy("block")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _joined(left, right, key, end_id)

    return blocks.cogroup(found).applyInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with the text that the library's decode gives for their ids; null ids give an empty text."""
    model(path)
    columns = encoded.schema.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns) + f", `{name}` string"
    place = [f.name for f in columns].index(ids)

    def run(batch: pa.RecordBatch) -> dict:
        read = model(path).decode
        lists = batch.column(place)
        values, bounds = lists.values.to_numpy(), lists.offsets.to_pylist()
        # Null lists span nothing.
        spans = (values[a:b].tolist() for a, b in zip(bounds, bounds[1:]))
        texts = [read(span) if span else "" for span in spans]
        return {**dict(zip((f.name for f in columns), batch.columns)), name: texts}

    return map_arrow(encoded, run, schema)
