"""Repeated passages across documents, by common-prefix intervals of suffix arrays.

A byte is removed if a string of ``SPAN`` bytes that covers it also starts in a document with a smaller id.

*Anchors.* Of the ``GRAM``-byte strings within ``SPAN`` bytes, the one with the smallest hash is an anchor. It
depends on these bytes alone, so wherever the ``SPAN`` bytes occur again, so does the anchor. Only anchors that
occur in several documents are followed, each with its context: all bytes that any ``SPAN`` bytes around it may
have. Occurrences with equal contexts form a class. A class's members behind its first document are repeated as
a whole; what is left is how classes that share an anchor overlap.

*Suffix arrays.* The contexts of such classes are dealt into parts of bounded size. In a part, all suffixes of
its contexts are sorted; the lengths of the common prefixes of neighbours are scanned with a stack, which gives
the tree of common-prefix intervals: each one is a string with all its occurrences. Intervals whose occurrences
all continue alike to the left are skipped, since the longer string has the same occurrences. The others are the
maximal repeats: every occurrence behind the one in the first document is removed, neighbours in the
array or not.

*Hot anchors*, those at the edge of a passage that a third of all documents share, have as many classes as
documents. Their classes are dealt over several parts; the parts' intervals meet by the ``SPAN`` bytes they have
in common, one row for each interval and part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.shingles import mix
from loamline.session import tidy_shuffles
from loamline.staging import Scope, stage

SPAN = 50
GRAM = 24
STARTS = SPAN - GRAM + 1  # places of an anchor within SPAN bytes
BEFORE = SPAN - GRAM  # context in front of an anchor
CONTEXT = BEFORE + SPAN
BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 4_096
SEGMENT = 1 << 18
PART = 2_048  # contexts of a part, about
LAST = (1 << 63) - 1  # the order of documents without id

_U = np.uint64


# --- anchors and contexts -------------------------------------------------------------


class Texts:
    """Byte texts side by side, with room around them for contexts."""

    def __init__(self, texts: list[bytes]):
        self.bounds = np.cumsum([0] + [len(t) for t in texts])
        self.room = np.frombuffer(bytes(BEFORE) + b"".join(texts) + bytes(CONTEXT + 8), np.uint8)
        self.data = self.room[BEFORE:]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of all anchors, ascending."""
        total = int(self.bounds[-1])
        # Starts of SPAN bytes that would run over the end of their text.
        cut = np.zeros(total + 1, bool)
        for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist()):
            cut[max(a, b - SPAN + 1) : b] = True
        places, hashes = [], []
        for at in range(0, total, SEGMENT):
            end = min(at + SEGMENT, total)
            h = self._grams(at, end + STARTS - 1)
            least = _sliding(h, STARTS, np.minimum)
            least[cut[at:end]] = 0
            # The smallest hash of some window that holds the place is its own.
            most = _sliding(np.concatenate([np.zeros(STARTS - 1, _U), least, np.zeros(STARTS - 1, _U)]), STARTS, np.maximum)
            found = np.flatnonzero(most == h)
            places.append(found + at)
            hashes.append(h[found])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        place, first = np.unique(np.concatenate(places), return_index=True)
        return place, np.concatenate(hashes)[first]

    def _grams(self, begin: int, end: int) -> np.ndarray:
        """A hash of the GRAM bytes at each place; never 0."""
        words = np.ndarray((end - begin + GRAM,), "<u8", self.data, begin, (1,))
        n = end - begin
        h = words[:n] * _U(0x9E3779B97F4A7C15)
        for k in range(1, GRAM // 8):
            h ^= h >> _U(29)
            h += words[8 * k : 8 * k + n]
            h *= _U(0xBF58476D1CE4E5B9 + 2 * k)
        h ^= h >> _U(32)
        h *= _U(0x94D049BB133111EB)
        h ^= h >> _U(31)
        return h | _U(1)

    def contexts(self, places: np.ndarray) -> np.ndarray:
        """A hash of each anchor's context and of how much of it lies in the text."""
        doc = np.searchsorted(self.bounds, places, side="right") - 1
        left = np.minimum(places - self.bounds[doc], BEFORE)
        right = np.minimum(self.bounds[doc + 1] - places, SPAN)
        out = np.empty(len(places), _U)
        width = -(-CONTEXT // 8) * 8
        windows = np.lib.stride_tricks.sliding_window_view(self.room, width)
        columns = np.arange(width)
        for at in range(0, len(places), 1 << 15):
            some = slice(at, at + (1 << 15))
            rows = windows[places[some]]  # room starts BEFORE bytes early: the context begins at the place
            rows[:, CONTEXT:] = 0
            short = np.flatnonzero((left[some] < BEFORE) | (right[some] < SPAN))
            lows, highs = BEFORE - left[some][short], BEFORE + right[some][short]
            rows[short] *= (columns >= lows[:, None]) & (columns < highs[:, None])
            words = rows.view("<u8")
            h = mix((left[some] * 64 + right[some]).astype(_U) + _U(1))
            for k in range(words.shape[1]):
                h = (h ^ (h >> _U(29))) * _U(0x9E3779B97F4A7C15) + words[:, k]
            out[some] = mix(h)
        return out


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """The least or most of each ``width`` neighbours."""
    reach, out = 1, x
    while 2 * reach <= width:
        out = best(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return best(out[:-rest], out[rest:]) if rest else out.copy()


# --- suffix arrays ---------------------------------------------------------------------


class SuffixArray:
    """All suffixes of at least ``shortest`` bytes of several byte strings, sorted, with common prefixes."""

    def __init__(self, strings: list[bytes], shortest: int = SPAN):
        self.shortest = shortest
        lengths = np.array([len(s) for s in strings], np.int64)
        width = max(int(lengths.max(initial=0)), 1)
        grid = np.frombuffer(b"".join(s.ljust(2 * width, b"\0") for s in strings), np.uint8).reshape(len(strings), 2 * width)
        # Padding must sort before every byte. UTF-8 has no byte 255; other data take two bytes a symbol.
        filled = np.arange(2 * width) < lengths[:, None]
        kind = np.uint8 if grid.max(initial=0) < 255 else ">u2"
        symbols = (grid.astype(kind) + 1).astype(kind) * filled.astype(kind)
        counts = np.maximum(lengths - shortest + 1, 0)
        self.owner = np.repeat(np.arange(len(strings)), counts)
        self.start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        rows = np.lib.stride_tricks.sliding_window_view(symbols, width, axis=1)[self.owner, self.start]
        rows = np.ascontiguousarray(rows.astype(kind))
        order = np.argsort(rows.view(f"S{rows.dtype.itemsize * width}").ravel(), kind="stable")
        self.owner, self.start = self.owner[order], self.start[order]
        left = symbols[self.owner, np.maximum(self.start - 1, 0)].astype(np.int64)
        # A string's first byte continues to the left like no other.
        self.left = np.where(self.start > 0, left, -1 - np.arange(len(left)))
        self.lengths = lengths
        self.common = np.zeros(len(order) + 1, np.int64)  # with the suffix before
        for at in range(1, len(order), 1 << 14):
            a, b = order[at - 1 : at - 1 + (1 << 14)], order[at : at + (1 << 14)]
            a = a[: len(b)]
            differ = rows[a] != rows[b]
            self.common[at : at + len(b)] = np.where(differ.any(1), differ.argmax(1), width)
        size = lengths[self.owner] - self.start
        if len(order):
            self.common[1:-1] = np.minimum(self.common[1:-1], np.minimum(size[:-1], size[1:]))

    def groups(self) -> Iterator[tuple[int, int]]:
        """(begin, end) of the runs of suffixes that share at least ``shortest`` bytes; single ones too."""
        cuts = np.flatnonzero(self.common[:-1] < self.shortest).tolist()
        return zip(cuts, cuts[1:] + [len(self.owner)])

    def maximal_repeats(self) -> Iterator[tuple[int, int, int]]:
        """(length, begin, end): the suffixes begin ... end - 1 are all occurrences of a string of this length,
        which is repeated, and followed and preceded by different bytes. Inner intervals come first."""
        stack: list[list] = []  # open intervals: length, first suffix, the byte to the left or None if several
        left, common = self.left.tolist(), self.common.tolist()
        for at in range(1, len(left) + 1):
            length = common[at] if common[at] >= self.shortest else 0
            first, byte = at - 1, left[at - 1]
            while stack and stack[-1][0] > length:
                top = stack.pop()
                if top[2] != byte:
                    top[2] = None
                if top[2] is None:
                    yield top[0], top[1], at
                first, byte = top[1], top[2]
            if not length:
                continue
            if stack and stack[-1][0] == length:
                if stack[-1][2] != byte:
                    stack[-1][2] = None
            else:
                stack.append([length, first, byte])


def repeated_starts(array: SuffixArray, order: np.ndarray) -> np.ndarray:
    """For each string and start, whether its ``shortest`` bytes also occur in one of smaller ``order``."""
    width = int(array.lengths.max(initial=0)) + 1
    change = np.zeros((len(array.lengths), width + 1), np.int32)
    for length, begin, end in array.maximal_repeats():
        owner = array.owner[begin:end]
        later = order[owner] > order[owner].min()
        if later.any():
            start = array.start[begin:end][later]
            np.add.at(change, (owner[later], start), 1)
            np.add.at(change, (owner[later], start + length - array.shortest + 1), -1)
    return np.cumsum(change, axis=1)[:, :width] > 0


def _span_hashes(strings: list[bytes], owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the SPAN bytes at each start."""
    width = -(-SPAN // 8) * 8
    room = max((len(s) for s in strings), default=0) + width
    grid = np.frombuffer(b"".join(s.ljust(room, b"\0") for s in strings), np.uint8).reshape(len(strings), room)
    rows = np.lib.stride_tricks.sliding_window_view(grid, width, axis=1)[owner, start]
    rows[:, SPAN:] = 0
    words = np.ascontiguousarray(rows).view("<u8")
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707345):
        h = np.full(len(rows), salt, _U)
        for k in range(words.shape[1]):
            h = mix((h ^ words[:, k]) * _U(0x9E3779B97F4A7C15) + _U(k + salt % 97))
        out.append(h.view(np.int64))
    return tuple(out)


def _bits(starts: np.ndarray) -> np.ndarray:
    """Rows of booleans as numbers, column n as bit n."""
    return (starts[:, :STARTS].astype(np.int64) << np.arange(min(STARTS, starts.shape[1]))).sum(1)


# --- Spark -------------------------------------------------------------------------------


def _blocks(docs: DataFrame) -> DataFrame:
    """Documents with the block they belong to: neighbours of up to BLOCK_BYTES or one longer text; written."""

    def run(batches):
        block, rows, size = None, 0, 0
        for batch in batches:
            lengths = pc.binary_length(batch.column("_text")).to_pylist()
            own = []
            for row, length in zip(batch.column("_row").to_pylist(), lengths):
                if block is None or rows >= BLOCK_ROWS or size + length > BLOCK_BYTES:
                    block, rows, size = row, 0, 0
                own.append(block)
                rows, size = rows + 1, size + length
            yield pa.record_batch([*batch.columns, pa.array(own, pa.int64())], [*batch.schema.names, "_block"])

    return stage(docs.mapInArrow(run, "_row long, _id long, _order long, _text binary, _block long"), "repeats-blocks", "zstd")


def _pieces(batches) -> Iterator[tuple[int, np.ndarray, np.ndarray, Texts]]:
    """(block, rows, orders, texts) of the documents of one block within a batch, by ascending order."""
    for batch in batches:
        block = batch.column("_block").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                part = batch.slice(a, b - a)
                order = part.column("_order").to_numpy()
                by = np.argsort(order, kind="stable")
                texts = part.column("_text").take(pa.array(by)).to_pylist()
                yield int(block[a]), part.column("_row").to_numpy()[by], order[by], Texts(texts)


def _firsts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, begins): rows sorted by the keys, stable, and where each distinct key begins."""
    order = np.lexsort(keys[::-1])
    if not len(order):
        return order, order
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return order, np.flatnonzero(new)


def _anchor_bounds(batches):
    """(_h, _block, _lo, _hi): each anchor of a block once, with its first and last document."""
    for block, _, order, texts in _pieces(batches):
        place, h = texts.anchors()
        doc = order[np.searchsorted(texts.bounds, place, side="right") - 1]
        by, begins = _firsts(h)
        low = doc[by][begins]  # places ascend with the order of their documents
        high = np.maximum.reduceat(doc[by], begins) if len(by) else doc
        columns = [h[by][begins].view(np.int64), np.full(len(low), block), low, high]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["_h", "_block", "_lo", "_hi"])


_OCCURRENCES = "_h long, _c long, _order long, _block long, _row long, _pos long"


def _occurrences(docs: pa.Table, shared: pa.Table) -> pa.Table:
    """Each shared anchor of a block with each of its contexts once, where it occurs first."""
    names = ["_h", "_c", "_order", "_block", "_row", "_pos"]
    out = [np.zeros(0, np.int64)] * len(names)
    if docs.num_rows and shared.num_rows:
        docs = docs.combine_chunks()
        ((block, rows, order, texts),) = _pieces(docs.to_batches())
        place, h = texts.anchors()
        known = np.sort(shared.column("_h").to_numpy().view(_U))
        kept = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
        place, h = place[kept], h[kept]
        c = texts.contexts(place)
        by, begins = _firsts(h, c)
        first = by[begins]
        doc = np.searchsorted(texts.bounds, place[first], side="right") - 1
        at = place[first] - texts.bounds[doc]
        out = [h[first].view(np.int64), c[first].view(np.int64), order[doc], np.full(len(doc), block), rows[doc], at]
    return pa.table([pa.array(x, pa.int64()) for x in out], names)


_FLAGS = "_block long, _h long, _c long, _first long, _mask long"
_HEADS = "_part int, _g1 long, _g2 long, _least long"


def _masks(part: pa.Table, masks: np.ndarray) -> pa.Table:
    kept = np.flatnonzero(masks)
    first = pa.array([LAST] * len(kept), pa.int64())
    own = [part.column(c).take(pa.array(kept)) for c in ("_block", "_h", "_c")]
    return pa.table([*own, first, pa.array(masks[kept], pa.int64())], ["_block", "_h", "_c", "_first", "_mask"])


def _search_part(part: pa.Table) -> pa.Table:
    """Which starts of a part's contexts are repeated from a smaller document of the part."""
    strings, order = part.column("_context").to_pylist(), part.column("_order").to_numpy()
    return _masks(part, _bits(repeated_starts(SuffixArray(strings), order)))


def _heads(part: pa.Table) -> pa.Table:
    """One row for each distinct SPAN bytes of a part: its hash and the first document."""
    strings, order = part.column("_context").to_pylist(), part.column("_order").to_numpy()
    array = SuffixArray(strings)
    groups = list(array.groups())
    begin = np.array([a for a, _ in groups], np.int64)
    least = np.minimum.reduceat(order[array.owner], begin) if len(begin) else begin
    g = _span_hashes(strings, array.owner[begin], array.start[begin])
    number = pa.array([part.column("_part")[0].as_py()] * len(begin), pa.int32())
    return pa.table([number, *[pa.array(x, pa.int64()) for x in (*g, least)]], ["_part", "_g1", "_g2", "_least"])


def _search_heads(part: pa.Table, heads: pa.Table) -> pa.Table:
    """Which starts of a part's contexts are repeated from a smaller document of another part."""
    if not part.num_rows or not heads.num_rows:
        return _masks(part, np.zeros(part.num_rows, np.int64))
    strings, order = part.column("_context").to_pylist(), part.column("_order").to_numpy()
    counts = np.maximum(np.array([len(s) for s in strings]) - SPAN + 1, 0)
    owner = np.repeat(np.arange(len(strings)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    g1, g2 = _span_hashes(strings, owner, start)
    known = {(a, b): d for a, b, d in zip(*[heads.column(c).to_pylist() for c in ("_g1", "_g2", "_least")])}
    least = np.array([known.get(k, LAST) for k in zip(g1.tolist(), g2.tolist())], np.int64)
    masks = np.zeros(len(strings), np.int64)
    np.bitwise_or.at(masks, owner, np.where(least < order[owner], np.int64(1) << start, 0))
    return _masks(part, masks)


def _cut(docs: pa.Table, flags: pa.Table) -> pa.Table:
    """A block's documents without their repeated bytes."""
    docs = docs.combine_chunks()
    out: list[list] = [[], [], [], [], []]
    names = ["_id", "n_bytes", "n_removed", "n_spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    order = docs.column("_order").to_numpy()
    by = np.argsort(order, kind="stable")
    order, raw = order[by], docs.column("_text").take(pa.array(by)).to_pylist()
    ids = docs.column("_id").take(pa.array(by)).to_pylist()
    texts = Texts(raw)
    place, h = texts.anchors()
    doc = np.searchsorted(texts.bounds, place, side="right") - 1
    own = order[doc]
    n, column = len(place), lambda name: flags.column(name).to_numpy()
    hs = np.concatenate([h, column("_h").view(_U)])
    cs = np.concatenate([texts.contexts(place), column("_c").view(_U)])
    sort, begins = _firsts(hs, cs)
    begin, end = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(sort):
        group = np.empty(len(sort), np.int64)
        group[sort] = np.cumsum(np.isin(np.arange(len(sort)), begins)) - 1
        first = np.minimum.reduceat(np.concatenate([own, column("_first")])[sort], begins)[group[:n]]
        mask = np.bitwise_or.reduceat(np.concatenate([np.zeros(n, np.int64), column("_mask")])[sort], begins)[group[:n]]
        low = np.maximum(place - BEFORE, texts.bounds[doc])  # the first start of SPAN bytes around the anchor
        high = np.minimum(place, texts.bounds[doc + 1] - SPAN)
        whole = own > first
        begin, end = low[whole], high[whole] + SPAN
        # The class's own first document: the starts that its part found in a smaller one.
        some = np.flatnonzero(~whole & (mask != 0))
        bits = (mask[some][:, None] >> np.arange(STARTS)) & 1
        which, t = np.nonzero(bits)
        begin = np.concatenate([begin, low[some][which] + t])
        end = np.concatenate([end, low[some][which] + t + SPAN])
    runs = np.argsort(begin, kind="stable")
    begin, end = begin[runs], np.maximum.accumulate(end[runs]) if len(runs) else end
    if len(begin):
        # Runs of overlapping or touching pieces. Pieces of different documents may touch: those are cut.
        piece = np.searchsorted(texts.bounds, begin, side="right") - 1
        fresh = np.concatenate([[True], (begin[1:] > end[:-1]) | (piece[1:] != piece[:-1])])
        last = np.append(np.flatnonzero(fresh)[1:] - 1, len(begin) - 1)
        begin, end, piece = begin[fresh], end[last], piece[fresh]
    else:
        piece = begin
    spans: dict[int, list] = {}
    for d, a, b in zip(piece.tolist(), begin.tolist(), end.tolist()):
        spans.setdefault(d, []).append((a - int(texts.bounds[d]), b - int(texts.bounds[d])))
    for d, text in enumerate(raw):
        mine, kept, at = spans.get(d, []), [], 0
        for a, b in mine:
            kept.append(text[at:a])
            at = b
        kept.append(text[at:])
        removed = sum(b - a for a, b in mine)
        for values, v in zip(out, (ids[d], len(text), removed, len(mine), b"".join(kept))):
            values.append(v)
    return pa.table([pa.array(c, k) for c, k in zip(out, kinds)], names)


def _find(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks, flags): the documents in blocks, and what each block must know to cut its repeats."""
    spark = rows.sparkSession
    blocks = _blocks(rows)

    # Anchors that occur in several documents go back to their blocks. Each block gives an anchor once, so
    # the commonest one has no more rows than there are blocks.
    with Scope(spark) as tables:
        bounds = blocks.mapInArrow(_anchor_bounds, "_h long, _block long, _lo long, _hi long").repartition("_h")
        anchor = Window.partitionBy("_h")
        least, most = F.min("_lo").over(anchor), F.max("_hi").over(anchor)
        shared = bounds.select("_h", "_block", least.alias("_least"), most.alias("_most")).where("_least < _most")
        shared = stage(shared.select("_h", "_block"), "repeats-anchors")
    met = blocks.groupBy("_block").cogroup(shared.groupBy("_block")).applyInArrow(_occurrences, _OCCURRENCES)
    # (anchor, context) is the key: a common anchor with many contexts spreads over the tasks.
    same = Window.partitionBy("_h", "_c")
    met = stage(met.withColumn("_first", F.min("_order").over(same)), "repeats-classes")
    tables.drop()
    first = met.where(F.col("_order") == F.col("_first"))
    several = first.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    several = stage(several, "repeats-several")

    # Contexts of the classes that share an anchor with others, cut out of the texts.
    salts = F.ceil(F.col("_n") / F.lit(2 * PART)).cast("long")
    opened = first.join(several, "_h").select(
        "_h", "_c", "_order", "_block", "_row", "_pos", (salts > 1).alias("_hot"), F.pmod(F.xxhash64("_c"), salts).alias("_salt")
    )
    opened = stage(opened, "repeats-open")
    parts = max(1, -(-opened.count() // PART))
    begin, size = F.greatest(F.col("_pos") - BEFORE, F.lit(0)), F.least(F.col("_pos"), F.lit(BEFORE)) + SPAN
    context = F.substring(F.col("_text"), (begin + 1).cast("int"), size.cast("int"))
    contexts = opened.join(blocks.select("_row", "_text"), "_row").select(
        F.pmod(F.xxhash64("_h", "_salt"), F.lit(parts)).cast("int").alias("_part"),
        "_block", "_h", "_c", "_order", "_hot", context.alias("_context"),
    )
    contexts = stage(contexts, "repeats-contexts", "zstd")
    masks = contexts.groupBy("_part").applyInArrow(_search_part, _FLAGS)

    # Hot anchors: their parts' intervals meet by the bytes they share.
    hot = contexts.where("_hot")
    heads = stage(hot.groupBy("_part").applyInArrow(_heads, _HEADS), "repeats-heads")
    best = heads.groupBy("_g1", "_g2").agg(F.min("_least").alias("_best")).join(heads, ["_g1", "_g2"])
    better = best.where(F.col("_best") < F.col("_least")).select("_part", "_g1", "_g2", F.col("_best").alias("_least"))
    across = hot.groupBy("_part").cogroup(better.groupBy("_part")).applyInArrow(_search_heads, _FLAGS)

    later = met.where(F.col("_first") < F.col("_order")).select("_block", "_h", "_c", "_first", F.lit(0).cast("long").alias("_mask"))
    return blocks, stage(later.unionByName(masks).unionByName(across), "repeats-flags")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every document without the bytes repeated from smaller ids.

    A byte goes if it is covered by SPAN bytes of its text that also start in a document with a smaller id, as
    the input has them; matches never cross documents. ``n_spans`` counts the maximal removed runs, ``kept`` are
    the other bytes of the UTF-8 text. Nulls are empty texts; texts below SPAN bytes stay whole. A null id counts
    as the largest. Rows that share an id are judged one by one and remove nothing from each other. Other columns,
    whatever their names, take no part; an empty table gives no rows.
    """
    order = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(doc_id).cast("long").alias("_id"), order.alias("_order"), raw.alias("_text")
    )
    with tidy_shuffles(docs.sparkSession):
        blocks, flags = _find(rows)
    result = "_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    cut = blocks.groupBy("_block").cogroup(flags.groupBy("_block")).applyInArrow(_cut, result)
    return cut.withColumnRenamed("_id", doc_id)
