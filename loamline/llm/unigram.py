"""Unigram encoding and decoding with the pieces of a SentencePiece model.

Pieces lie in a double-array trie over their UTF-8 bytes; the Viterbi path maximises the sum of the
pieces' log scores. A space is written as the marker U+2581, and a text gets one before its first
word. A character that no piece covers falls back to its bytes. A marker that stands in the text
itself also falls back to bytes, so that decoding gives back every text exactly.

No piece holds a marker after another character, so the best path of a text is the concatenation of
the best paths of its words (with the markers before them); each distinct word is solved once.
"""

from __future__ import annotations

import math
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loamline.llm.tables import slices

MARK = "▁"
_MARK_BYTES = MARK.encode()
_LITERAL = 0xFF  # stands for a marker of the text; never a byte of UTF-8
CACHE_WORDS = 300_000
_SHORT = 64  # bytes; longer words are solved one by one
# Bytes of the character that a byte begins.
_CHAR_BYTES = np.array([1] * 0xC0 + [2] * 0x20 + [3] * 0x10 + [4] * 0x0F + [1])
BYTE_PENALTY = 10.0
_workers: dict[int, "Unigram"] = {}


def double_array(pieces: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of the trie: child of node s by byte c is base[s] + c if check there is s.

    value is the piece's number at its node, else -1. Node 0 is the root.
    """
    keys = sorted(pieces)
    size = 4 * sum(map(len, keys)) + 1024  # more than one slot per node; cut to what is used
    base = np.zeros(size, np.int32).tolist()
    check = np.full(size, -1, np.int32).tolist()
    value = np.full(size, -1, np.int32).tolist()
    check[0] = 0
    first_free = crowded = 257  # so that every base is positive
    todo = [(0, 0, len(keys), 0)]
    top = 256
    while todo:
        node, low, high, depth = todo.pop()
        if low < high and len(keys[low]) == depth:
            value[node] = pieces[keys[low]]
            low += 1
        groups = []
        while low < high:
            c, begin = keys[low][depth], low
            while low < high and keys[low][depth] == c:
                low += 1
            groups.append((c, begin, low))
        if not groups:
            continue
        while check[first_free] >= 0:
            first_free += 1
        first = groups[0][0]
        spot = begun = first_free if len(groups) == 1 else crowded
        while any(check[spot + c - first] >= 0 for c, _, _ in groups):
            spot += 1
        if len(groups) > 1 and spot - begun > 32:
            crowded = spot  # nodes with several children no longer look below this
        base[node] = spot - first
        for c, begin, end in groups:
            child = base[node] + c
            check[child] = node
            top = max(top, child)
            todo.append((child, begin, end, depth + 1))
    top += 257
    return tuple(np.array(a[:top], np.int32) for a in (base, check, value))


def load_vocabulary(model_file: str) -> dict:
    """Pieces, log scores and byte pieces of a model file.

    A model whose stored scores are merge ranks (0, -1, -2, ...) has no probabilities: its log
    scores then follow the rank by Zipf's law, -ln(2 + rank). Stored log probabilities stay.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, scores, raw, texts = {}, {}, {}, [b""] * model.get_piece_size()
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            raw[int(piece[3:5], 16)] = i
            texts[i] = bytes([int(piece[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[piece.encode()] = i
            scores[i] = model.get_score(i)
            texts[i] = piece.replace(MARK, " ").encode()
    if all(float(s).is_integer() for s in scores.values()):
        scores = {i: -math.log(2.0 - s) for i, s in scores.items()}
    if len(raw) != 256:
        raise ValueError("byte fallback needs the 256 byte pieces")
    base, check, value = double_array(pieces)
    log = np.full(model.get_piece_size(), -np.inf)
    log[list(scores)] = list(scores.values())
    return {
        "base": base, "check": check, "value": value, "log": log, "texts": texts,
        "raw": [raw[b] for b in range(256)], "fallback": min(scores.values()) - BYTE_PENALTY,
    }


class Unigram:
    def __init__(self, vocabulary: dict, cache_words: int = CACHE_WORDS):
        self.base, self.check, self.value = (vocabulary[k].tolist() for k in ("base", "check", "value"))
        self.log = vocabulary["log"].tolist()
        self.tables = tuple(vocabulary[k] for k in ("base", "check", "value", "log"))
        self.raw, self.texts, self.fallback = vocabulary["raw"], vocabulary["texts"], vocabulary["fallback"]
        self.dtype = np.dtype("<u2" if len(self.texts) <= 1 << 16 else "<u4")
        self.cache: dict[str, bytes] = {}
        self.limit = cache_words

    def best_path(self, data: bytes) -> tuple[list[int], float]:
        """Ids of the best path and its score. Of equal paths, the one with the longer last piece."""
        base, check, value, log = self.base, self.check, self.value, self.log
        n = len(data)
        best = [-math.inf] * (n + 1)
        best[0] = 0.0
        starts, pieces = [0] * (n + 1), [-1] * (n + 1)
        for i in range(n):
            score = best[i]
            if score == -math.inf:
                continue
            node, j, covered = 0, i, False
            end = i + int(_CHAR_BYTES[data[i]])
            while j < n:
                to = base[node] + data[j]
                if check[to] != node or to == 0:
                    break
                node = to
                j += 1
                piece = value[node]
                if piece >= 0:
                    covered |= j == end
                    got = score + log[piece]
                    if got > best[j]:
                        best[j], starts[j], pieces[j] = got, i, piece
            if not covered and score + self.fallback > best[end]:
                best[end], starts[end], pieces[end] = score + self.fallback, i, -1
        return self._trace(data, starts, pieces), best[n]

    def best_paths(self, words: list[bytes]) -> list[list[int]]:
        """``best_path`` of many short words, all words in step: one position, one byte at a time."""
        base, check, value, log = self.tables
        n = np.array([len(w) for w in words])
        width = int(n.max())
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        best = np.full((len(words), width + 1), -np.inf)
        best[:, 0] = 0.0
        start = np.zeros((len(words), width + 1), np.int32)
        chosen = np.full((len(words), width + 1), -1, np.int32)
        for i in range(width):
            rows = np.nonzero((n > i) & (best[:, i] > -np.inf))[0]
            if not len(rows):
                continue
            ends = i + _CHAR_BYTES[data[rows, i]]
            bare, bare_ends, score = rows, ends, best[rows, i]
            covered = np.zeros(len(words), bool)
            node = np.zeros(len(rows), np.int32)
            for j in range(i, width):
                to = base[node] + data[rows, j]
                on = (check[to] == node) & (n[rows] > j)
                rows, node, score, ends = rows[on], to[on], score[on], ends[on]
                if not len(rows):
                    break
                piece = value[node]
                hit = piece >= 0
                covered[rows[hit & (ends == j + 1)]] = True
                got = score + log[piece]
                hit &= got > best[rows, j + 1]
                at = rows[hit]
                best[at, j + 1] = got[hit]
                start[at, j + 1] = i
                chosen[at, j + 1] = piece[hit]
            left = ~covered[bare]
            at, to = bare[left], bare_ends[left]
            got = best[at, i] + self.fallback
            better = got > best[at, to]
            at, to = at[better], to[better]
            best[at, to] = got[better]
            start[at, to] = i
            chosen[at, to] = -1
        starts, pieces = start.tolist(), chosen.tolist()
        return [self._trace(w, starts[k], pieces[k]) for k, w in enumerate(words)]

    def _trace(self, data: bytes, starts: list[int], pieces: list[int]) -> list[int]:
        ids: list[int] = []
        at = len(data)
        while at:
            begin, piece = starts[at], pieces[at]
            if piece >= 0:
                ids.append(piece)
            else:
                char = _MARK_BYTES if data[begin] == _LITERAL else data[begin:at]
                ids.extend(self.raw[b] for b in reversed(char))
            at = begin
        ids.reverse()
        return ids

    def _solve(self, words: list[str]) -> None:
        """Fills the cache. A word is its leading spaces and what follows them."""
        short: list[tuple[bytes, str]] = []
        for word in words:
            bare = word.lstrip(" ")
            marks = len(word) - len(bare) or 1
            data = _MARK_BYTES * marks + bytes([_LITERAL]).join(p.encode() for p in bare.split(MARK))
            if len(data) <= _SHORT:
                short.append((data, word))
            else:
                self.cache[word] = self._pack(self.best_path(data)[0])
        short.sort(key=lambda x: len(x[0]))
        for at in range(0, len(short), 8_192):
            some = short[at : at + 8_192]
            for (_, word), ids in zip(some, self.best_paths([d for d, _ in some])):
                self.cache[word] = self._pack(ids)

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.dtype.itemsize == 2 else 'I'}", *ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian ids of each text; null and empty texts have none."""
        parts = []
        for text in texts:
            if not text:
                parts.append([])
            elif "  " in text or text[0] == " " or text[-1] == " ":
                parts.append(re.findall(" +[^ ]*", " " + text))
            else:
                parts.append(text.split(" "))
        wanted: set[str] = set()
        for words in parts:
            wanted.update(words)
        wanted.difference_update(self.cache)
        cache = self.cache
        self._solve(list(wanted))
        out = [b"".join(map(cache.__getitem__, words)) for words in parts]
        if len(cache) > self.limit:
            for word in wanted:
                del cache[word]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids that ``encode`` made: markers are spaces, the first one is dropped."""
        numbers = np.frombuffer(ids, self.dtype).tolist()
        data = b"".join(map(self.texts.__getitem__, numbers))
        return data[1:].decode(errors="replace")


def encode_documents(docs: DataFrame, vocabulary: dict, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (little-endian unsigned 32 bit), n_pieces, decoded.

    ``vocabulary`` is what ``load_vocabulary`` gives; its size is the model's. ``decoded`` is the
    text that the ids give back. Null text gives no ids and an empty text. An empty table gives no
    rows, repeated rows repeat, other columns are not read.
    """
    plain = docs.select(docs[id_col].alias("id"), docs[text].alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        if id(shared) not in _workers:
            _workers.clear()
            _workers[id(shared)] = Unigram(shared.value)
        model = _workers[id(shared)]
        for batch in batches:
            for part in slices(batch, 500):
                coded = model.encode(part.column(1).to_pylist())
                wide = [np.frombuffer(c, model.dtype).astype("<u4").tobytes() for c in coded]
                sizes = [len(w) // 4 for w in wide]
                columns = [part.column(0), pa.array(wide, pa.binary()), pa.array(sizes, pa.int64())]
                columns.append(pa.array([model.decode(c) for c in coded], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "n_pieces", "decoded"])

    return plain.mapInArrow(run, f"`{id_col}` {kind}, ids binary, n_pieces long, decoded string")
