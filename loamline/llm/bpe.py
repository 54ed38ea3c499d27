"""Whole-text BPE ids by the tokenizers library, with a bounded cache of chunks.

Merges never cross the pre-tokenizer's pieces, and for the two kinds of tokenizer known here no
piece crosses the place before a single space or around a single line feed. So a text is cut there,
each distinct chunk is encoded once by the library's model, and a document is the concatenation of
its chunks. A text for which this doesn't hold (white space before a space) and a tokenizer of
another kind are encoded whole.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np

CACHE_CHUNKS = 200_000
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[\x21-\x7e\n{_LETTERS}]*")
# Both look for a fixed character first, which a search finds faster than a class.
_SPACE_BEFORE_SPACE = re.compile(r" (?<=\s )")
_SPACE_AT_FEED = re.compile(r"\n(?:(?<=\s\n)|(?=\s))")  # in texts without white space before a space
_LATIN = re.compile(r"[\x00-\xff]*")
_ENDS = ".,;:!?"
# Marks of chunks; noncharacters, so no chunk of a text begins with one (texts that do go whole).
_WHOLE, _BARE, _FEED = "\ufdd0", "\ufdd1", "\ufdd2"
_encoders: dict[tuple, "ChunkEncoder"] = {}


def _marked(text: str) -> bool:
    return _WHOLE in text or _BARE in text or _FEED in text


def encoder(path: str, cache_chunks: int = CACHE_CHUNKS) -> "ChunkEncoder":
    """One encoder per file and Python worker; its cache serves all tasks of the worker."""
    key = (path, cache_chunks)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(path, cache_chunks)
    return _encoders[key]


def _byte_letters() -> dict[int, str]:
    """Byte → the printable character byte-level vocabularies write for it."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Chunks(dict):
    """Chunk → ids. A missing chunk is encoded and kept, and noted in ``new``."""

    def __init__(self, code):
        super().__init__()
        self.code, self.new = code, []

    def __missing__(self, chunk: str) -> bytes:
        self[chunk] = ids = self.code(chunk)
        self.new.append(chunk)
        return ids


class ChunkEncoder:
    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.kind = _kind(self.tokenizer)
        self.limit = cache_chunks
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.letter = "H" if self.dtype.itemsize == 2 else "I"
        self.cache = _Chunks(self._chunk)
        self.letters = _byte_letters()
        contraction = "'s|'t|'re|'ve|'m|'ll|'d"
        if self.kind == "spaced":
            rest = rf" ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+"
        else:
            rest = rf"[{_LETTERS}]+|[0-9]|[^\s0-9{_LETTERS}]+"
        self.pieces = re.compile(f"{contraction}|{rest}")
        self.space = self.letters[32] if self.kind == "spaced" else ""
        self.ends = {c: self._ids(c) for c in _ENDS} if self.kind else {}
        self.packs = [struct.Struct(f"<{n}{self.letter}").pack for n in range(32)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian ids (``dtype``) of each text; null is empty."""
        get = self.cache.__getitem__  # encodes a chunk that is missing
        out = [b"".join(map(get, self._cut(text or ""))) for text in texts]
        new, full = self.cache.new, len(self.cache) > self.limit
        for chunk in new:
            if full or chunk[:1] == _WHOLE:  # what came first is what is frequent
                del self.cache[chunk]
        new.clear()
        return out

    def _cut(self, text: str) -> list[str]:
        """Chunks whose ids, one after the other, are the text's.

        Of a ``spaced`` tokenizer chunks are kept without their leading space: a chunk that has none
        is marked by a preceding ``_BARE``, and ``_WHOLE`` marks a text for the library.
        """
        if self.kind == "bare" and not _marked(text):
            # White space of any kind separates, and case doesn't count.
            text = text.replace("\n", " ")
            if text.isascii() or _LATIN.fullmatch(text):
                text = text.lower()
            return text.split(" ")
        if self.kind is None or _SPACE_BEFORE_SPACE.search(text) or _marked(text):
            return [_WHOLE + text]
        if "\n" not in text or _SPACE_AT_FEED.search(text):
            chunks = text.split(" ")
            chunks[0] = _BARE + chunks[0]
            return chunks
        chunks = []
        for line in text.split("\n"):
            some = line.split(" ")
            some[0] = _BARE + some[0]
            chunks += some
            chunks.append(_FEED)
        chunks.pop()
        return chunks

    def _library(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _pack(self, ids: list[int]) -> bytes:
        n = len(ids)
        return self.packs[n](*ids) if n < 32 else struct.pack(f"<{n}{self.letter}", *ids)

    def _ids(self, word: str) -> list[int]:
        return [t.id for t in self.tokenize(word)]

    def _chunk(self, chunk: str) -> bytes:
        if self.kind is None or chunk[:1] == _WHOLE:
            return self._library(chunk.removeprefix(_WHOLE))
        # Most chunks are one word of ASCII letters, with or without one mark: their pieces are known.
        if chunk.isascii():
            end = self.ends.get(chunk[-1:])
            word = chunk if end is None else chunk[:-1]
            if word.isalpha():
                ids = [t.id for t in self.tokenize(self.space + (word if self.kind == "spaced" else word.lower()))]
                return self._pack(ids if end is None else ids + end)
        if chunk == _FEED:
            bare = chunk = "\n"
        elif chunk[:1] == _BARE:
            bare = chunk = chunk[1:]
        else:
            bare, chunk = chunk, " " + chunk if self.kind == "spaced" else chunk
        if "<|" in bare or not _PLAIN.fullmatch(bare):
            return self._library(chunk)
        if self.kind == "bare":
            chunk = chunk.lower()
        elif bare.isalpha():  # one piece
            return self._pack(self._ids(chunk.encode().decode("latin-1").translate(self.letters)))
        ids: list[int] = []
        for piece in self.pieces.findall(chunk):
            if not piece.isascii() or "\n" in piece:
                word = piece.encode().decode("latin-1").translate(self.letters)
            else:
                word = self.space + piece[1:] if piece[0] == " " else piece
            ids.extend([t.id for t in self.tokenize(word)])
        return self._pack(ids)


def _kind(tokenizer) -> str | None:
    """``spaced``: a piece may begin with one space. ``bare``: white space is dropped, lower case."""
    from tokenizers.models import BPE

    marks = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    if not isinstance(tokenizer.model, BPE) or any(not m.startswith("<|") for m in marks):
        return None
    # Each part's own settings; the vocabulary is not copied.
    state = lambda part: json.loads(part.__getstate__()) if part is not None else None
    pre, norm = state(tokenizer.pre_tokenizer) or {}, state(tokenizer.normalizer)
    if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and norm is None:
        return "spaced"
    steps = [p.get("type") for p in pre.get("pretokenizers", [])]
    norms = [n.get("type") for n in (norm or {}).get("normalizers", [])]
    if steps == ["Split", "ByteLevel"] and pre["pretokenizers"][0]["invert"] and norms == ["NFC", "Replace", "Lowercase"]:
        wanted = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        if pre["pretokenizers"][0]["pattern"].get("Regex") == wanted and not pre["pretokenizers"][1]["use_regex"]:
            return "bare"
    return None
