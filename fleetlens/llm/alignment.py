"""Alignment of two tokenizers over the same bytes, and how often their ids meet corpus-wide.

Byte offsets where tokens of both end cut the tokens into groups. A *fragment* is what a byte range knows by
itself: an open prefix (tokens up to its first cut), closed groups, and an open suffix (tokens after its last
cut). Fragments form a monoid: joining two closes the group between the first one's suffix and the second one's prefix,
or lengthens what is open if a side has no cut. Long texts are cut into segments for tokenizing and their tokens
into fixed byte ranges, which know nothing of words; their fragments are joined in rounds of a tree, in tasks of
``FAN`` ranges. Only open ends travel up the tree: closed groups stay where they were found, and a joint is
filed under the range that closes it. A short text is one fragment, its words joined in place.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from fleetlens.llm import wordtable
from fleetlens.llm.common import map_arrow, small_batches, stored

# Bytes of a range; longer texts go through the tree.
RANGE = 1 << 15
# Characters of a segment, which ends at the next safe space.
SEGMENT = 1 << 16
FAN = 16
# Words with their ids that a task remembers, and characters of short texts that it aligns at once.
MOST_WORDS = 300_000
SLICE = 1_500_000
BATCH_BYTES = 16_000_000
# Links of a group that are listed one by one.
MOST_LISTED = 4096
# Id pairs (about 40 bytes each in memory) up to which their counts are broadcast; beyond, they are joined by shuffle.
MOST_BROADCAST = 1_000_000
# Neither tokenizer has a token across a space behind such a character.
_SAFE = re.compile(rf"(?<=[^\s{wordtable.MARK}]) ")
_ODD = re.compile(rf"[\s{wordtable.MARK}] |\A ")
_LINKS = "array<struct<pair:bigint,m:bigint>>"
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")

Ids = tuple[int, ...]


@dataclass(frozen=True)
class Fragment:
    """Open ends of a byte range and its closed groups, (A ids, B ids) each; without a cut all is prefix."""

    prefix: tuple[Ids, Ids] = ((), ())
    cut: bool = False
    suffix: tuple[Ids, Ids] = ((), ())
    groups: list[tuple[Ids, Ids]] = field(default_factory=list)

    def __add__(self, other: Fragment) -> Fragment:
        """Associative; ``Fragment()`` is neutral."""
        if self.cut and other.cut:
            joint = _both(self.suffix, other.prefix)
            return Fragment(self.prefix, True, other.suffix, [*self.groups, joint, *other.groups])
        if self.cut:
            return Fragment(self.prefix, True, _both(self.suffix, other.prefix), self.groups)
        prefix = _both(self.prefix, other.prefix)
        return Fragment(prefix, other.cut, other.suffix, other.groups)


# The start of a text is a cut with nothing before it.
START = Fragment(cut=True)


def _both(left: tuple[Ids, Ids], right: tuple[Ids, Ids]) -> tuple[Ids, Ids]:
    return left[0] + right[0], left[1] + right[1]


def fragment(a: Sequence[int], a_ends: Sequence[int], b: Sequence[int], b_ends: Sequence[int]) -> Fragment:
    """The fragment of tokens whose ends, rising byte offsets, lie in one range."""
    parts, i, j, i0, j0 = [], 0, 0, 0, 0
    while i < len(a_ends) and j < len(b_ends):
        x, y = a_ends[i], b_ends[j]
        i += x <= y
        j += y <= x
        if x == y:
            parts.append((tuple(a[i0:i]), tuple(b[j0:j])))
            i0, j0 = i, j
    rest = tuple(a[i0:]), tuple(b[j0:])
    return Fragment(parts[0], True, rest, parts[1:]) if parts else Fragment(rest)


def written(groups: list[tuple[Ids, Ids]]) -> str:
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def links(groups: list[tuple[Ids, Ids]]) -> dict[int, int]:
    """Id pairs (A id << 32 | B id) and how many token occurrences of the groups each links."""
    out: dict[int, int] = {}
    for a, b in groups:
        # Many tokens on both sides are counted, not listed pair by pair.
        several = len(a) * len(b) > MOST_LISTED
        left, right = (Counter(x).items() if several else [(i, 1) for i in x] for x in (a, b))
        for x, n in left:
            for y, m in right:
                pair = x << 32 | y
                out[pair] = out.get(pair, 0) + n * m
    return out


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the sums of their times. Most times are one."""
    once = times == 1
    found, sums = np.unique(keys[once], return_counts=True)
    if once.all():
        return found, sums
    keys, times = np.concatenate((found, keys[~once])), np.concatenate((sums, times[~once]))
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(times, first)


def _counts(groups: list[tuple[Ids, Ids]]) -> tuple[int, int, int, int]:
    sizes = [(len(a), len(b)) for a, b in groups]
    return sum(a for a, _ in sizes), sum(b for _, b in sizes), len(sizes), sum(a * b for a, b in sizes)


def safe_words(text: str) -> list[str]:
    """A text cut at its safe spaces, which belong to neither word; each word stands behind one space."""
    return text.split(" ") if not _ODD.search(text) else _SAFE.split(text)


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself and the n-th other one as character 256 + n."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers and, per id, the bytes it stands for.

    ValueError if the byte-level file would change a text or split it in a way of its own."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(byte_level, encoding="utf-8") as file:
            told = json.load(file)
        split = told["pre_tokenizer"] or {}
        if told["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split["use_regex"]:
            raise ValueError(f"the words of {byte_level} can't be encoded one by one")
        self.a = Tokenizer.from_file(byte_level)
        # Names of special tokens within a text are plain text.
        self.a.encode_special_tokens = True
        self.pieces, b = pieces, wordtable.model(pieces)
        letter = _byte_letters()
        self.a_bytes = {i: bytes(letter.get(c, 0) for c in t) for t, i in self.a.get_vocab().items()}
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(wordtable.MARK, " ").encode()
            for i, p in enumerate(map(b.id_to_piece, range(b.get_piece_size())))
        ]
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, t in self.a_bytes.items():
            self.a_size[i] = len(t)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)

    def encode(self, words: list[str]) -> list[tuple[list[int], list[int], bool]]:
        """A ids, B ids, and whether the bytes of both are a space and the word."""
        batch = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        left = [e.ids for e in batch([" " + w for w in words], add_special_tokens=False)]
        right = wordtable.segment(words, self.pieces)
        given = [b" " + w.encode() for w in words]
        sides = ((left, self.a_bytes), (right, self.b_bytes))
        # One comparison for all words; they are looked at one by one only if it fails.
        if all(b"".join([of[i] for ids in side for i in ids]) == b"".join(given) for side, of in sides):
            return [(a, b, True) for a, b in zip(left, right)]
        back = [[b"".join([of[i] for i in ids]) for ids in side] for side, of in sides]
        return [(a, b, x == y == z) for a, b, x, y, z in zip(left, right, *back, given)]


class _Words(dict):
    """A and B ids per word, as bytes of unsigned 32-bit numbers; None if its bytes differ."""

    def __init__(self, tokenizers: Tokenizers) -> None:
        self.tokenizers = tokenizers

    def learn(self, words: set[str]) -> None:
        if len(self) > MOST_WORDS:
            self.clear()
        new = [w for w in words if w not in self]
        for word, (a, b, same) in zip(new, self.tokenizers.encode(new)):
            self[word] = (array("I", a).tobytes(), array("I", b).tobytes()) if same else None


_LOADED: dict[tuple[str, str], _Words] = {}


def _words(byte_level: str, pieces: str) -> _Words:
    """The words of two files, kept for the life of the Python worker."""
    if (byte_level, pieces) not in _LOADED:
        _LOADED[byte_level, pieces] = _Words(Tokenizers(byte_level, pieces))
    return _LOADED[byte_level, pieces]


def _laid(words: list[bytes], at: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words of all texts, in order, and the texts they belong to."""
    flat = np.frombuffer(b"".join(words), "<u4").astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) // 4
    starts = np.cumsum(sizes) - sizes
    many = sizes[at]
    place = np.repeat(starts[at] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    return flat[place], np.repeat(owner, many)


def _linked(p: np.ndarray, q: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Group, A id, B id and times of the links of groups with p and q tokens."""
    a_first, b_first = np.cumsum(p) - p, np.cumsum(q) - q
    listed = np.flatnonzero(p * q <= MOST_LISTED)
    n = (p * q)[listed]
    group = np.repeat(listed, n)
    k = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    parts = [(group, a[a_first[group] + k // q[group]], b[b_first[group] + k % q[group]], np.ones(len(group), np.int64))]
    for g in np.flatnonzero(p * q > MOST_LISTED).tolist():
        # Many tokens on both sides are counted, not listed pair by pair.
        x, n_x = np.unique(a[a_first[g] : a_first[g] + p[g]], return_counts=True)
        y, n_y = np.unique(b[b_first[g] : b_first[g] + q[g]], return_counts=True)
        parts.append((np.full(len(x) * len(y), g), np.repeat(x, len(y)), np.tile(y, len(x)), np.outer(n_x, n_y).ravel()))
    return tuple(np.concatenate(one) for one in zip(*parts))


@cache
def _digits(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digits of the numbers below n with room for one character more, which bytes count, and how many."""
    width = len(str(n - 1))
    values, tens = np.arange(n)[:, None], 10 ** np.arange(width - 1, -1, -1)
    digits = np.hstack((48 + values // tens % 10, np.zeros((n, 1), np.int64))).astype(np.uint8)
    # Leading zeros go, all but the last digit.
    shown = np.hstack((values >= tens, np.ones((n, 1), bool)))
    shown[:, width - 1] = True
    return digits, shown, shown.sum(axis=1)


def _decimal(ids: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below n in decimal, each followed by its character of ``ends``; the bytes and where each number stops."""
    digits, shown, sizes = _digits(n)
    lines = digits[ids]
    lines[:, -1] = ends
    return lines[shown[ids]], np.cumsum(sizes[ids])


def _cuts(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each token of both sides: how many cuts lie before its end."""
    place = np.searchsorted(b_ends, a_ends)
    a_cut = np.zeros(len(a_ends), np.int64)
    inside = place < len(b_ends)
    a_cut[inside] = b_ends[place[inside]] == a_ends[inside]
    b_cut = np.zeros(len(b_ends), np.int64)
    b_cut[place[a_cut == 1]] = 1
    return np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut


@dataclass(frozen=True)
class _Measured:
    """Of closed groups, per text: n_a, n_b, n_groups, n_links; the groups as bytes; links."""

    counts: list[np.ndarray]
    said: list[bytes]
    links: pa.Array


def _measured(
    a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, text: np.ndarray, n: int, t: Tokenizers
) -> _Measured:
    """Measure closed groups of ``n`` texts; ``text`` is each group's text, rising."""
    p, q = (np.bincount(g, minlength=len(text)) for g in (a_group, b_group))
    counts = [np.bincount(text, weights=w, minlength=n).astype(np.int64) for w in (p, q, np.ones(len(text)), p * q)]
    # Both sides of all groups in one line, A tokens of a group before its B tokens.
    a_at = np.arange(len(a)) + (np.cumsum(q) - q)[a_group]
    b_at = np.arange(len(b)) + np.cumsum(p)[b_group]
    ids, ends = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[a_at], ids[b_at] = a, b
    ends[a_at[np.cumsum(p) - 1]], ends[b_at[np.cumsum(q) - 1]] = ord("|"), ord(";")
    line, stops = _decimal(ids, ends, max(len(t.a_size), len(t.b_size)))
    bounds = np.concatenate(([0], stops))[np.concatenate(([0], np.cumsum(counts[0] + counts[1])))].tolist()
    # Without the last semicolon.
    said = [line[x : max(x, y - 1)].tobytes() for x, y in zip(bounds, bounds[1:])]
    group, left, right, times = _linked(p, q, a, b)
    n_a, n_b = len(t.a_size), len(t.b_size)
    keys, m = _summed((text[group] * n_a + left) * n_b + right, times)
    of, left, right = keys // (n_a * n_b), keys // n_b % n_a, keys % n_b
    items = pa.StructArray.from_arrays([pa.array(left << 32 | right), pa.array(m)], names=["pair", "m"])
    starts = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
    return _Measured(counts, said, pa.ListArray.from_arrays(pa.array(starts), items))


def _sliced(rows: DataFrame, run: Callable[[list[list], list[list[str]], _Words], dict], files: tuple, schema: str) -> DataFrame:
    """Apply a function of columns, the last one text, their words (none if their bytes differ) and
    all words' ids, to a few rows at a time."""
    spark = rows.sparkSession
    small_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _words(*files)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            given, first = columns[-1], 0
            while first < len(given):
                last, chars = first, 0
                while last < len(given) and chars < SLICE:
                    chars += len(given[last] or "")
                    last += 1
                texts = [safe_words(t) if t else [] for t in given[first:last]]
                used = set().union(*texts)
                known.learn(used)
                odd = {w for w in used if known[w] is None}
                texts = [t if odd.isdisjoint(t) else [] for t in texts]
                out = run([c[first:last] for c in columns], texts, known)
                arrays = [pa.array(out[f.name], f.type) if not isinstance(out[f.name], pa.Array) else out[f.name] for f in fields]
                arrays = [x.cast(f.type) for x, f in zip(arrays, fields)]
                yield pa.RecordBatch.from_arrays(arrays, schema=fields)
                first = last

    return rows.mapInArrow(each, schema)


def _end_to_end(texts: list[list[str]], known: _Words) -> tuple[tuple[np.ndarray, ...], ...]:
    """For A and B: ids of all texts, the text of each, and their ends when the texts lie end to end."""
    number = {w: i for i, w in enumerate(set().union(*texts))}
    lengths = np.array([len(t) for t in texts], np.int64)
    at = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, int(lengths.sum()))
    owner = np.repeat(np.arange(len(texts)), lengths)
    out = []
    for side, size in ((0, known.tokenizers.a_size), (1, known.tokenizers.b_size)):
        ids, own = _laid([known[w][side] for w in number], at, owner)
        out.append((ids, own, np.cumsum(size[ids])))
    return tuple(out)


def _short(rows: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """``row``, ``key``, counts, digest and links of each text, which is one fragment."""

    def run(columns: list[list], texts: list[list[str]], known: _Words) -> dict:
        (a, a_text, a_ends), (b, _, b_ends) = _end_to_end(texts, known)
        a_group, b_group = _cuts(a_ends, b_ends)
        text = a_text[np.flatnonzero(np.diff(a_group, append=len(a) + 1))]
        found = _measured(a, a_group, b, b_group, text, len(texts), known.tokenizers)
        digests = [hashlib.sha256(said).hexdigest() if said else "" for said in found.said]
        head = {"row": columns[0], "key": columns[1], "groups_sha256": digests, "links": found.links}
        return {**head, **dict(zip(_COUNTS, found.counts))}

    kind = rows.schema["key"].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    schema = f"row bigint, key {kind}, {counts}, groups_sha256 string, links {_LINKS}"
    return _sliced(rows.select("row", "key", "text"), run, (byte_level, pieces), schema)


def _segments(rows: DataFrame, segment: int) -> DataFrame:
    """Texts in parts that both tokenizers encode like the whole, with their first byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                value, at, start = text.as_py(), 0, 0
                while at <= len(value):
                    found = _SAFE.search(value, min(at + segment, len(value)))
                    end = found.start() if found else len(value)
                    part = value[at:end]
                    arrays = [pa.array([v], t) for v, t in ((row, pa.int64()), (start, pa.int64()), (part, pa.string()))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["row", "start", "text"])
                    start += 1 + len(part.encode())
                    at = end + 1

    return rows.mapInArrow(run, "row bigint, start bigint, text string")


_ENDS = "a0 array<int>, b0 array<int>, cut boolean, a1 array<int>, b1 array<int>"
_FOUND = f"fine boolean, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, said string, links {_LINKS}"


def _part(row: int, at: int, first: int | None, piece: Fragment, fine: bool, joint: bool) -> dict:
    """One row of the tree's tables: open ends, or closed groups of a range or a joint."""
    counts = dict(zip(_COUNTS, _counts(piece.groups)))
    pairs = [{"pair": p, "m": m} for p, m in links(piece.groups).items()]
    ends = {"a0": piece.prefix[0], "b0": piece.prefix[1], "a1": piece.suffix[0], "b1": piece.suffix[1]}
    said = {"fine": fine, "said": written(piece.groups), "links": pairs, "joint": joint}
    return {"row": row, "at": at, "first": first, "cut": piece.cut, **ends, **counts, **said}


_PART = f"row bigint, at bigint, first bigint, joint boolean, {_ENDS}, {_FOUND}"


def _fragments(segments: DataFrame, byte_level: str, pieces: str, width: int) -> DataFrame:
    """A row per segment and byte range. Tokens belong to the range in which they end."""

    def run(columns: list[list], texts: list[list[str]], known: _Words) -> dict:
        rows, start = columns[0], np.array(columns[1], np.int64)
        (a, a_text, a_ends), (b, b_text, b_ends) = _end_to_end(texts, known)
        a_group, b_group = _cuts(a_ends, b_ends)
        # Ends within the whole text say the range; segment and range together are a fragment.
        total = np.bincount(a_text, weights=known.tokenizers.a_size[a], minlength=len(texts)).astype(np.int64)
        shift = start - (np.cumsum(total) - total)
        ranges = [(ends + shift[own] - 1) // width for ends, own in ((a_ends, a_text), (b_ends, b_text))]
        far = 1 + max((int(r.max(initial=0)) for r in ranges), default=0)
        names = np.concatenate([own * far + r for own, r in zip((a_text, b_text), ranges)])
        names, of = np.unique(names, return_inverse=True)
        a_of, b_of = of[: len(a)], of[len(a) :]
        # The fragment of each cut; its first one ends the open prefix.
        at_cut = a_of[np.flatnonzero(np.diff(a_group, append=len(a) + 1))]
        has_cut, first = np.unique(at_cut, return_index=True)
        closed = np.ones(len(at_cut), bool)
        closed[first] = False
        number = np.cumsum(closed) - 1
        a_in, b_in = closed[a_group], closed[b_group]
        inner = [a[a_in], number[a_group[a_in]], b[b_in], number[b_group[b_in]]]
        found = _measured(*inner, at_cut[closed], len(names), known.tokenizers)
        cut = np.zeros(len(names), bool)
        cut[has_cut] = True
        ends = {}
        for ids, group, own, left, right in ((a, a_group, a_of, "a0", "a1"), (b, b_group, b_of, "b0", "b1")):
            after = cut[own] & (at_cut[group] != own)
            before = ~after & ~closed[group]
            low, high = np.searchsorted(own, np.arange(len(names))), np.searchsorted(own, np.arange(len(names)), "right")
            n_before, n_after = (np.bincount(own[x], minlength=len(names)) for x in (before | ~cut[own], after))
            ends[left] = [ids[x : x + n].tolist() for x, n in zip(low.tolist(), n_before.tolist())]
            ends[right] = [ids[y - n : y].tolist() for y, n in zip(high.tolist(), n_after.tolist())]
        owner = names // far
        begin = np.maximum(start[owner], names % far * width)
        said = [x.decode() for x in found.said]
        out = {
            "row": [rows[i] for i in owner.tolist()],
            "at": begin.tolist(),
            "first": [x if y else None for x, y in zip(begin.tolist(), cut.tolist())],
            "joint": [False] * len(names),
            "cut": cut.tolist(),
            "fine": [True] * len(names),
            "said": said,
            **ends,
            **{name: x.tolist() for name, x in zip(_COUNTS, found.counts)},
        }
        # A segment whose bytes differ has one row that says so.
        odd = [i for i, t in enumerate(texts) if not t]
        bare = _part(0, 0, None, Fragment(), False, False)
        rest = {name: [bare[name]] * len(odd) for name in out} | {"row": [rows[i] for i in odd]}
        rest["at"] = start[odd].tolist()
        lists = pa.concat_arrays([found.links, pa.array([[]] * len(odd), found.links.type)])
        return {**{name: out[name] + rest[name] for name in out}, "links": lists}

    return _sliced(segments.select("row", "start", "text"), run, (byte_level, pieces), _PART)


def _joined(parts: DataFrame, span: int) -> DataFrame:
    """Open ends joined within spans of bytes; groups that this closes come out as joints."""

    def run(table: pa.Table) -> pa.Table:
        out, total, first, begin = [], Fragment(), None, None
        for p in sorted(table.to_pylist(), key=lambda p: p["at"]):
            prefix, suffix = (tuple(p["a0"]), tuple(p["b0"])), (tuple(p["a1"]), tuple(p["b1"]))
            total += Fragment(prefix, p["cut"], suffix)
            if total.groups:
                joint = Fragment(groups=total.groups)
                out.append(_part(p["row"], p["first"], None, joint, True, True))
                total = Fragment(total.prefix, True, total.suffix)
            first = p["first"] if first is None else first
            begin = p["at"] if begin is None else begin
        out.append(_part(table.column("row")[0].as_py(), begin, first, total, True, False))
        return pa.Table.from_pylist(out, schema=schema)

    schema = to_arrow_schema(StructType.fromDDL(_PART))
    edges = parts.select("row", "at", "first", "a0", "b0", "cut", "a1", "b1")
    grouped = edges.withColumn("_span", F.expr(f"at div {span}")).groupBy("row", "_span")
    return grouped.applyInArrow(run, _PART)


def _digested(parts: DataFrame) -> DataFrame:
    """sha256 per row of its parts' groups in order, one part at a time."""
    rows = parts.where("n_groups > 0").select("row", "at", "joint", "said")
    rows = rows.repartition("row").sortWithinPartitions("row", "at", F.desc("joint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None

        def closed() -> pa.RecordBatch:
            arrays = [pa.array([current], pa.int64()), pa.array([digest.hexdigest()])]
            return pa.RecordBatch.from_arrays(arrays, names=["row", "groups_sha256"])

        for batch in batches:
            for row, said in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if row != current:
                    if digest:
                        yield closed()
                    current, digest = row, hashlib.sha256(said.encode())
                else:
                    digest.update(b";" + said.encode())
        if digest:
            yield closed()

    return rows.mapInArrow(run, "row bigint, groups_sha256 string")


def long_parts(rows: DataFrame, byte_level: str, pieces: str, width: int = RANGE, segment: int = SEGMENT) -> DataFrame:
    """The closed groups of long texts (columns row, text), a row per range or joint, through the tree."""
    small_batches(rows.sparkSession)
    cut = _segments(rows.select("row", "text"), segment).repartition("row", "start")
    parts = stored(_fragments(cut, byte_level, pieces, width), "alignment-ranges")
    longest = rows.agg(F.max(F.octet_length("text"))).first()[0] or 0
    found, edges, span = [parts], parts, width
    while span <= longest:
        span *= FAN
        joined = stored(_joined(edges, span), "alignment-joints")
        found.append(joined.where("joint"))
        edges = joined.where("NOT joint")
    # What is left of a text is one row: its start closes the first group, and nothing stays open at its end.
    def closed(batch: pa.RecordBatch) -> dict | None:
        out = [
            _part(p["row"], p["first"], None, Fragment(groups=[(tuple(p["a0"]), tuple(p["b0"]))]), True, True)
            for p in batch.to_pylist()
        ]
        return {name: [p[name] for p in out] for name in out[0]}

    roots = edges.where("cut").selectExpr("row", "first", "a0", "b0")
    found.append(map_arrow(roots, closed, _PART))
    keep = ["row", "at", "joint", "fine", *_COUNTS, "said", "links"]
    union = found[0].select(*keep)
    for more in found[1:]:
        union = union.unionByName(more.select(*keep))
    return stored(union, "alignment-parts")


def align(
    documents: DataFrame,
    byte_level: str,
    pieces: str,
    text: str = "text",
    key: str = "doc_id",
    width: int = RANGE,
    segment: int = SEGMENT,
) -> tuple[DataFrame, DataFrame]:
    """Two tables: ``row``, key, n_a, n_b, n_groups, n_links and groups_sha256 of each text; and ``row``, ``pair``
    (A id << 32 | B id) and ``m``, the token occurrences it links there.

    Tokens are those of a space and the text. Texts that are null or empty, or that the tokens of one side don't give back
    byte for byte, have no tokens: zeros and an empty digest. Each input row is a text of its own, whatever its key.
    A group with many tokens on both sides counts its links without listing them one by one.
    """
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text")
    )
    is_long = F.coalesce(F.octet_length("text") > width, F.lit(False))
    short = stored(_short(rows.where(~is_long), byte_level, pieces), "alignment-short")
    # Numbers below zero, so that they differ from those of short texts.
    long = stored(rows.where(is_long).withColumn("row", -1 - F.col("row")), "alignment-long")
    parts = long_parts(long, byte_level, pieces, width, segment)
    bad = stored(parts.where("NOT fine").select("row").distinct(), "alignment-odd")
    parts = parts.join(bad, "row", "left_anti")
    sums = parts.groupBy("row").agg(*(F.sum(c).alias(c) for c in _COUNTS))
    told = long.select("row", "key").join(sums, "row", "left").join(_digested(parts), "row", "left")
    told = told.fillna(0, list(_COUNTS)).fillna("", ["groups_sha256"])
    names = ["row", F.col("key").cast(kind).alias(key), *_COUNTS, "groups_sha256"]
    met = parts.select("row", F.inline("links")).groupBy("row", "pair").agg(F.sum("m").alias("m"))
    met = short.select("row", F.inline("links")).unionByName(stored(met, "alignment-links"))
    return short.select(*names).unionByName(told.select(*names)), met


def pair_counts(met: DataFrame) -> DataFrame:
    """``pair``, ``n`` (texts that hold it linked) and ``best`` (no other pair of its A id is in more texts)."""
    counts = met.groupBy("pair").agg(F.count("*").alias("n"))
    # At most as many rows per A id as the other tokenizer has ids.
    own = Window.partitionBy(F.shiftright("pair", 32))
    return stored(counts.withColumn("best", F.col("n") == F.max("n").over(own)), "alignment-counts")


def agreement(documents: DataFrame, byte_level: str, pieces: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``align`` with, per text, n_best (its links of a pair that is its A id's most common one) and
    count_sum (the sum over its links of the number of texts that hold the pair). An empty table gives no rows."""
    texts, met = align(documents, byte_level, pieces, text, key)
    counts = pair_counts(met)
    if counts.count() <= MOST_BROADCAST:
        counts = F.broadcast(counts)
    best = F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best")
    sums = met.join(counts, "pair").groupBy("row").agg(best, F.sum(F.col("m") * F.col("n")).alias("count_sum"))
    out = texts.join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])
    return out.select(key, *_COUNTS, "n_best", "count_sum", "groups_sha256")
