"""Token counts and ids by a public tokenizer file, through a bounded memory of white-space separated chunks.

Neither tokenizer joins characters across the start of a run of white space, so a
text's ids are its chunks' ids in order, and a chunk seen before needs no second
encoding. Texts of Latin letters are split here by the tokenizer's own pattern and
their pieces given to the library's merge model; any other text, and any that holds a
special token, goes through the whole library pipeline. Both give the same ids.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache
from operator import attrgetter

import regex

#: Chunks, and pieces of chunks, remembered by one Python worker; beyond it new ones are encoded again.
MEMORY = 400_000
#: All but tab, line feed, carriage return and the visible characters up to Latin Extended-A
#: (without the dotted capital I, which becomes two characters in lower case).
UNUSUAL = re.compile("[^\t\n\r -\x7e\xa1-įı-ſ]").search
#: White space with what follows it; no token of the byte-level tokenizer crosses its start.
LED = re.compile("[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+").findall
#: How the two tokenizer files split a text before merging.
BYTE_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
WORD_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def file_digest(path: str) -> str:
    """The version of a tokenizer: the digest of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def byte_letters() -> dict[int, str]:
    """The letter for each byte: itself where printable, else the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class Memory(dict):
    """Values of keys, computed when first asked for and kept while there is room."""

    def __init__(self, make: Callable[[str], object], room: int):
        super().__init__()
        self.make, self.room = make, room

    def __missing__(self, key: str):
        value = self.make(key)
        if len(self) < self.room:
            self[key] = value
        return value


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The library's tokenizer, loaded once by each Python worker."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Encoder:
    """Chunks of a text, each encoded once while memory lasts; subclasses say what is kept of the tokens."""

    def __init__(self, path: str, memory: int = MEMORY):
        self.tokenizer = _tokenizer(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = Memory(self._piece, memory)
        self.known = Memory(lambda chunk: self.join([self.pieces[p] for p in self.split(chunk)]), memory)

    def encode(self, text: str):
        if UNUSUAL(text) or any(s in text for s in self.special):
            return self.whole(text)
        return self.join(map(self.known.__getitem__, self.chunks(text)))

    def _piece(self, piece: str):
        return self.kept(self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters)))


class TokenCounter(_Encoder):
    """Numbers of tokens of texts by a byte-level file."""

    join = staticmethod(sum)
    kept = staticmethod(len)
    chunks = staticmethod(LED)
    split = staticmethod(BYTE_PATTERN)

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


_ID = attrgetter("id")


def _packed(ids: Iterable[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _ChunkIds(dict):
    """Packed ids of chunks and their pieces, kept while there is room.

    Most chunks of a corpus are new ones, so a new word takes a single call besides the library's.
    """

    def __init__(self, model, letters: dict[int, str], room: int):
        super().__init__()
        self.tokenize, self.letters, self.room = model.tokenize, letters, room

    def __missing__(self, chunk: str) -> bytes:
        pieces = None
        if not chunk.isalpha():
            last = chunk[-1]
            pieces = [chunk[:-1], last] if last in ".,;:!?" and chunk[:-1].isalpha() else WORD_PATTERN(chunk)
        if pieces is not None and len(pieces) > 1:
            ids = b"".join([self[p] for p in pieces])
        else:  # without white space every byte of ASCII is its own letter
            shown = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.letters)
            ids = _packed(map(_ID, self.tokenize(shown)))
        if len(self) < self.room:
            self[chunk] = ids
        return ids


class TokenIds(_Encoder):
    """Ids of texts, as unsigned little-endian 32-bit numbers, by a file that lower-cases and drops white space.

    A piece is a chunk of its own elsewhere, so both share one memory.
    """

    join = staticmethod(b"".join)

    def __init__(self, path: str, memory: int = MEMORY):
        super().__init__(path, memory)
        self.pieces = self.known = _ChunkIds(self.model, self.letters, memory)

    @staticmethod
    def chunks(text: str) -> list[str]:
        return text.lower().split()

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
