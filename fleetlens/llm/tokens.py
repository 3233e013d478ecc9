"""Token ids of whole texts by a tokenizer file, word by word with a bounded cache.

The tokenizer splits at white space before anything else, so the ids of a text are those of its pieces
between spaces and line feeds, in order; pieces come back often and are encoded once. Special
tokens are matched as the library does by default.
"""

from __future__ import annotations

import os
import re

MOST_PIECES = 500_000
MOST_CORES = 400_000
# A run of Latin letters, then ASCII punctuation that neither starts a contraction nor a special token.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\[-`{}~]*)")


class _Cores(dict):
    """Ids of runs that the tokenizer never splits before its merges, as little-endian bytes."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.tokenize = tokenizer, tokenizer.model.tokenize
        self.ids = [i.to_bytes(4, "little") for i in range(max(tokenizer.get_vocab().values()) + 1)]

    def __missing__(self, core: str) -> bytes:
        if len(self) > MOST_CORES:
            self.clear()
        if core.isascii():
            ids = self.ids
            out = b"".join([ids[t.id] for t in self.tokenize(core)])
        else:
            out = _bytes(self.tokenizer.encode(core, add_special_tokens=False).ids)
        self[core] = out
        return out


class Pieces(dict):
    """Ids of pieces without spaces and line feeds, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cores = _Cores(self.tokenizer)
        self[""] = b""

    def __missing__(self, piece: str) -> bytes:
        simple = _SIMPLE.fullmatch(piece)
        if simple:
            out = self.cores[simple[1].lower()]
            if simple[2]:
                out += self.cores[simple[2]]
        else:
            out = _bytes(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        self[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        if len(self) > MOST_PIECES:
            self.clear()
            self[""] = b""
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _bytes(ids: list[int]) -> bytes:
    return b"".join(i.to_bytes(4, "little") for i in ids)


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The encoder of a file, kept for the life of the Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_vocabulary() -> str:
    """The place of the public word-level vocabulary that the registered queries use."""
    return _public("word_bpe_49k.json")


def byte_vocabulary() -> str:
    """The place of the public byte-level vocabulary."""
    return _public("byte_bpe_50k.json")


def piece_model() -> str:
    """The place of the public model of marked pieces."""
    return _public("piece_bpe_32k.model")
