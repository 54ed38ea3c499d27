"""Document quality by Bradley-Terry pairwise ranking.

A document's strength is linear in binned text statistics. It is learned from preference pairs (a
good document beats a bad one) by the logistic loss on the difference of their features. The
threshold is a quantile of the training scores: the share of bad documents among them.

The statistics of a text are computed once, in its own task. Every labelled row takes part in all that is
learned: bins and threshold come from counts of all rows, and the rows are dealt into blocks, each of which
learns weights from pairs that hold every row of it; the model is the mean of the blocks.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamline.llm.tables import crc_bucket, slices
from loamline.staging import stage

BLOCK_ROWS = 16_000  # labelled rows that one task learns from
BLOCK_CLASS = 64  # rows of the rarer class that a block needs; rarer ones go to several blocks
PAIRS = 60_000  # of a block, at least
BINS = 16
HASHED = 64
CUT = 0.7
STATISTICS = (
    "log_chars", "upper", "digit", "punctuation", "symbol", "accented", "newline", "word_length", "distinct_words",
    "symbol_words", "repeated_lines", "top_word", "log_words", "short_words", "longest_word", "line_length", "zlib",
    "capital_words", "stops", "distinct_letters", "pipes",
)
_PUNCTUATION = frozenset(b".,;:!?'\"()-")
_CLASS = {
    "upper": [b for b in range(256) if 65 <= b <= 90],
    "digit": [b for b in range(256) if 48 <= b <= 57],
    "punctuation": sorted(_PUNCTUATION),
    "symbol": [b for b in range(33, 127) if not chr(b).isalnum() and b not in _PUNCTUATION],
    "accented": list(range(128, 256)),
    "newline": [10],
    "pipes": [124],
}


def statistics(text: str | None) -> np.ndarray:
    """``STATISTICS`` of a whole text, then the shares of hashed byte classes; zeros if empty."""
    out = np.zeros(len(STATISTICS) + HASHED, np.float32)
    raw = (text or "").encode("utf-8", "replace")
    if not raw:
        return out
    n = len(raw)
    data = np.frombuffer(raw, np.uint8)
    count = np.bincount(data, minlength=256)
    share = {k: count[v].sum() / n for k, v in _CLASS.items()}
    words = raw.split()
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int32, len(words)) if words else np.zeros(1, np.int32)
    tally: dict[bytes, int] = {}
    for x in words:
        tally[x] = tally.get(x, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    values = {
        "log_chars": np.log1p(n),
        **share,
        "word_length": lengths.mean(),
        "distinct_words": len(tally) / w,
        "symbol_words": sum(c for x, c in tally.items() if x[-1] in _TAIL) / w,
        "repeated_lines": 1 - len(set(lines)) / max(1, len(lines)),
        "top_word": max(tally.values(), default=0) / w,
        "log_words": np.log1p(w),
        "short_words": (lengths <= 3).mean(),
        "longest_word": lengths.max(),
        "line_length": n / max(1, len(lines)),
        "zlib": len(zlib.compress(raw, 1)) / n,
        "capital_words": sum(c for x, c in tally.items() if 65 <= x[0] <= 90) / w,
        "stops": count[46] / w,
        "distinct_letters": (count > 0).sum(),
    }
    out[: len(STATISTICS)] = [values[k] for k in STATISTICS]
    pairs = (data[:-1].astype(np.uint32) * 31 + data[1:]) % HASHED
    out[len(STATISTICS) :] = np.bincount(pairs, minlength=HASHED) / n
    return out


_TAIL = frozenset(_CLASS["symbol"]) | frozenset(b"!")


@dataclass
class Ranking:
    """Bins of each statistic, the weight of each bin, and the score that the threshold stands for."""

    edges: np.ndarray
    weights: np.ndarray
    threshold: float

    def indicators(self, x: np.ndarray) -> np.ndarray:
        """The bin of each value, as a number among all bins."""
        found = np.stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)], 1)
        return found + np.arange(x.shape[1]) * BINS

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.indicators(x)].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; ``CUT`` where the strength is the threshold."""
        z = self.strength(x) - self.threshold + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _learned(model: Ranking, x: np.ndarray, quality: np.ndarray, pairs: int, epochs: int, seed: int) -> np.ndarray:
    """Weights from random preference pairs. Every row is in a pair if both classes are there, else all are 0."""
    w = np.zeros(BINS * x.shape[1])
    good, bad = np.nonzero(quality == 1)[0], np.nonzero(quality == 0)[0]
    if not len(good) or not len(bad):
        return w
    rng = np.random.default_rng(seed)
    bins = model.indicators(x)
    pairs = max(pairs, len(good), len(bad))
    # One random order after the other, so that no row is left out.
    deal = lambda rows: np.concatenate([rng.permutation(rows) for _ in range(-(-pairs // len(rows)))])[:pairs]
    first, second = deal(good), deal(bad)
    squares = np.full_like(w, 1e-8)
    for _ in range(epochs):
        order = rng.permutation(pairs)
        for at in range(0, pairs, 256):
            rows = order[at : at + 256]
            a, b = bins[first[rows]], bins[second[rows]]
            z = w[a].sum(1) - w[b].sum(1)
            g = -1 / (1 + np.exp(np.clip(z, -40, 40)))  # of log(1 + exp(-z)) by z
            step = np.bincount(a.ravel(), np.repeat(g, a.shape[1]), len(w))
            step -= np.bincount(b.ravel(), np.repeat(g, b.shape[1]), len(w))
            step = step / len(rows) + 1e-4 * w
            squares += step * step
            w -= 0.1 * step / np.sqrt(squares)
    return w


def train(x: np.ndarray, quality: np.ndarray, pairs: int = PAIRS, epochs: int = 8, seed: int = 7) -> Ranking:
    """A ranking from rows in memory. Without both classes every document has strength 0."""
    edges = np.quantile(x, _QUANTILES, axis=0).T if len(x) else np.zeros((x.shape[1], BINS - 1))
    model = Ranking(edges.astype(np.float32), np.zeros(BINS * x.shape[1]), 0.0)
    model.weights = _learned(model, x, quality, pairs, epochs, seed)
    if len(x):
        model.threshold = float(np.quantile(model.strength(x), np.mean(quality == 0)))
    return model


_QUANTILES = np.linspace(0, 1, BINS + 1)[1:-1]
_WIDTH = len(STATISTICS) + HASHED


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, _WIDTH)


def described(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(_id, x): the :func:`statistics` of each row's whole text, as bytes."""
    plain = docs.select(docs[id_col].alias("_id"), docs[text].alias("_text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, 500):
                values = [statistics(t).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values, pa.binary())], ["_id", "x"])

    return plain.mapInArrow(run, f"_id {plain.schema['_id'].dataType.simpleString()}, x binary")


def labelled(rows: DataFrame, labels: DataFrame, id_col: str, held_out: int, of: int) -> DataFrame:
    """(_id, x, quality) of every labelled document that is not held out, as a staged table."""
    usable = labels.where(F.col("quality").isin(0, 1) & (crc_bucket(id_col, of) != held_out))
    marks = usable.groupBy(F.col(id_col).alias("_lid")).agg(F.max("quality").cast("int").alias("quality"))
    found = rows.join(marks, F.col("_id") == F.col("_lid"))
    return stage(found.groupBy("_id").agg(F.min("x").alias("x"), F.max("quality").alias("quality")), "quality-labelled")


def _at_ranks(cells: DataFrame, ranks: list[int]) -> list:
    """(feature, rank, lo): the smallest value of the cell that holds each rank, by feature and rank."""
    upto = F.sum("c").over(W.partitionBy("feature").orderBy("cell"))
    wanted = F.explode(F.array(*[F.lit(r).cast("bigint") for r in sorted(set(ranks))])).alias("rank")
    found = cells.withColumn("upto", upto).select("feature", "lo", "c", "upto", wanted)
    return found.where((F.col("upto") - F.col("c") <= F.col("rank")) & (F.col("rank") < F.col("upto"))).collect()


def _cells(rows: DataFrame, values, cell) -> DataFrame:
    """(feature, cell, c, lo): how many values fall into each cell, and the smallest; no more cells than ``cell`` has."""

    def counted(x):
        for i, column in enumerate(values(x).T):
            order = np.sort(column)
            found, at, count = np.unique(cell(order), return_index=True, return_counts=True)
            columns = [np.full(len(found), i, np.int32), found.astype(np.int64), count.astype(np.int64), order[at].astype(np.float64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["feature", "cell", "c", "lo"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(_matrix(batch.column(0)))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield from counted(np.concatenate(held))
                held, n = [], 0
        if n:
            yield from counted(np.concatenate(held))

    counts = rows.select("x").mapInArrow(run, "feature int, cell long, c long, lo double")
    return counts.groupBy("feature", "cell").agg(F.sum("c").alias("c"), F.min("lo").alias("lo"))


def _edges(rows: DataFrame, n: int) -> np.ndarray:
    """Quantiles of each statistic, to twelve bits of the fraction: of equal cells the smallest value.

    Statistics are not negative, so their bits are in their order.
    """
    ranks = [int(q * (n - 1)) for q in _QUANTILES]
    cells = _cells(rows, lambda x: x, lambda v: v.view(np.uint32) >> np.uint32(11))
    found = {(r.feature, r.rank): r.lo for r in _at_ranks(cells, ranks)}
    return np.array([[found[i, r] for r in ranks] for i in range(_WIDTH)], np.float32)


def _blocks(rows: DataFrame, good: int, bad: int) -> DataFrame:
    """(block, x, quality): every row in a block, those of a rare class in as many as need them."""
    blocks = -(-(good + bad) // BLOCK_ROWS)
    copies = [min(blocks, -(-BLOCK_CLASS * blocks // n)) for n in (bad, good)]
    times = F.when(F.col("quality") == 1, F.lit(copies[1])).otherwise(F.lit(copies[0]))
    dealt = rows.select("x", "quality", F.xxhash64(F.lit(12), "_id").alias("h"), F.explode(F.sequence(F.lit(1), times)).alias("i"))
    return dealt.select(F.pmod(F.pmod("h", F.lit(blocks)) + F.col("i"), F.lit(blocks)).alias("block"), "x", "quality")


def _mean_weights(rows: DataFrame, model: Ranking, good: int, bad: int) -> np.ndarray:
    """The mean of the blocks' weights. They are summed as whole numbers, so their order doesn't matter."""
    scale = 1 << 32

    def run(block: pa.Table) -> pa.Table:
        x, y = _matrix(block.column("x").combine_chunks()), block.column("quality").to_numpy()
        order = np.lexsort([*x.T, y])  # the same order in every run
        w = _learned(model, x[order], y[order], PAIRS, 8, 7)
        if y.min() == y.max():
            return pa.table({"at": pa.array([], pa.int32()), "w": pa.array([], pa.int64())})
        return pa.table({"at": np.arange(len(w), dtype=np.int32), "w": np.rint(w * scale).astype(np.int64)})

    learned = _blocks(rows, good, bad).groupBy("block").applyInArrow(run, "at int, w long")
    out = np.zeros_like(model.weights)
    for r in learned.groupBy("at").agg(F.sum("w").alias("w"), F.count("w").alias("n")).collect():
        out[r["at"]] = r["w"] / r["n"] / scale
    return out


def learn(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", held_out: int = 2, of: int = 4) -> Ranking:
    """A ranking fitted on all labelled rows of :func:`described` whose crc32(id) mod ``of`` is not ``held_out``.

    Null ids and labels other than 0 and 1 are left out; of repeated ids one text counts.
    """
    known = labelled(rows, labels, id_col, held_out, of)
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    model = Ranking(np.zeros((_WIDTH, BINS - 1), np.float32), np.zeros(BINS * _WIDTH), 0.0)
    if not good or not bad:
        return model
    n = good + bad
    model.edges = _edges(known, n)
    model.weights = _mean_weights(known, model, good, bad)
    strengths = _cells(known, lambda x: model.strength(x)[:, None], lambda v: np.floor(v * 4096))
    model.threshold = float(_at_ranks(strengths, [int(bad / n * (n - 1))])[0].lo)
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", held_out: int = 2, of: int = 4) -> Ranking:
    """:func:`learn` from the texts of ``docs``."""
    return learn(described(docs, id_col, text), labels, id_col, held_out, of)


def scored(rows: DataFrame, model: Ranking, id_col: str = "doc_id") -> DataFrame:
    """One row per row of :func:`described`: id, score, predicted (1 if score >= 0.7)."""
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            score = model.score(_matrix(batch.column(1)))
            columns = [batch.column(0), pa.array(score), pa.array((score >= CUT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "score", "predicted"])

    return rows.select("_id", "x").mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")


def rank(docs: DataFrame, model: Ranking, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score, predicted (1 if score >= 0.7).

    Null and empty texts are scored too. Repeated rows repeat; an empty table gives no rows.
    """
    return scored(described(docs, id_col, text), model, id_col)
