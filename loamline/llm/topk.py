"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors become integers, floor(1024 x). Rows are dealt into blocks; a block holds, for every
dimension, its postings sorted by value and cut into segments of equal quantised impact (value
divided by ``STEP``). For a query, a dimension's contribution is shifted so that its smallest in the
block is 0; then segments are processed by descending impact for this query, whatever dimension they
are of, each adding its lower bound to its documents' scores. A document can gain at most the
segments' widths plus what the open dimensions can still give, so with the k-th best lower bound it
is proven which documents cannot be among the k best (ties included). Once few possible members are left they
are rescored exactly.

Queries meet every block in blocks of ``QUERIES`` queries: tasks are even whatever the data, each pair
of blocks gives k rows per query, and the best k of these are merged with map-side pruning.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.staging import stage

SCALE = 1024
STEP = 16  # width of a quantised impact
ROWS = 8_192  # vectors of a block
QUERIES = 4_096
EXACT = 2.0**52  # bounds are sums of doubles, whole up to here
CHECK = 0.125  # share of the postings processed between two tries of the proof


class ImpactIndex:
    """Impact-ordered postings of one block of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order].astype(np.int64)
        rows = np.argsort(self.vectors, axis=0, kind="stable")  # ascending, by dimension
        values = np.take_along_axis(self.vectors, rows, 0)
        self.postings = rows.T.astype(np.int32).ravel()
        dims, begins, ends, lows, highs = [], [], [], [], []
        for j in range(values.shape[1]):
            level = values[:, j] // STEP
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(level)) + 1, [len(level)]])
            dims.append(np.full(len(cuts) - 1, j))
            begins.append(cuts[:-1])
            ends.append(cuts[1:])
            lows.append(values[cuts[:-1], j])
            highs.append(values[cuts[1:] - 1, j])
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.dims, self.begins, self.ends = join(dims), join(begins), join(ends)
        self.lows, self.highs = join(lows), join(highs)

    def search(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows other than ``own``; ties to the smaller id."""
        n, d = self.vectors.shape
        allowed = self.ids != own
        candidates = np.flatnonzero(allowed)
        if n and d:
            candidates = candidates[self._possible(query.astype(np.int64), k, allowed)[candidates]]
        scores = self.vectors[candidates] @ query.astype(np.int64)
        best = np.lexsort((self.ids[candidates], -scores))[:k]
        return self.ids[candidates[best]], scores[best]

    def _possible(self, query: np.ndarray, k: int, allowed: np.ndarray) -> np.ndarray:
        """Which rows may be among the k best."""
        n, d = self.vectors.shape
        if allowed.sum() <= 4 * k:
            return allowed
        ends = np.stack([query[self.dims] * self.lows, query[self.dims] * self.highs])
        least, most = ends.min(0), ends.max(0)  # of a segment's contribution
        base = np.full(d, np.iinfo(np.int64).max)
        np.minimum.at(base, self.dims, least)
        least, most = least - base[self.dims], most - base[self.dims]
        order = np.lexsort((self.dims, -most))
        sizes = (self.ends - self.begins)[order]
        done = np.cumsum(sizes)
        width = (most - least)[order]
        score = np.zeros(n)
        slack = np.zeros(d)  # widest segment processed of each dimension
        at, total = 0, done[-1]
        while at < len(order):
            stop = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + CHECK * total)))
            part = order[at:stop]
            some = sizes[at:stop]
            begin = self.dims[part] * n + self.begins[part]
            places = np.repeat(begin - np.cumsum(some) + some, some) + np.arange(some.sum())
            score += np.bincount(self.postings[places], np.repeat(least[part].astype(float), some), n)
            np.maximum.at(slack, self.dims[part], width[at:stop].astype(float))
            at = stop
            # What a row may gain: the widths of its segments, or an open dimension's next segment.
            rest = np.zeros(d)
            if at < len(order):
                np.maximum.at(rest, self.dims[order[at:]], most[order[at:]].astype(float))
            bound = np.maximum(slack, rest).sum()
            mark = np.partition(score[allowed], -k)[-k]
            possible = allowed & (score + bound >= mark)
            if possible.sum() <= max(4 * k, n // 64):
                break
        return possible


def integers(embedding: str):
    """floor(1024 x) of each component as an array of longs; null where a component is no number."""
    usable = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return F.when(F.col(embedding).isNotNull() & usable, scaled)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k rows of highest integer inner product.

    Every row but those with the query's own id is a candidate; ties go to the smaller id; fewer
    than k rows if there are no more. Rows without id, and vectors that are null or hold a null or
    non-finite component, take no part. Vectors of another length than the query count as padded with zeros.
    Components so large that an inner product could reach 2 ** 52 are refused with an error, not rounded.
    Rows that repeat an id are candidates of their own; repeated queries are asked once per id and
    vector. Empty tables give no rows.
    """

    def prepared(df):
        clean = df.select(F.col(id_col).cast("long").alias("_id"), integers(embedding).alias("_v"))
        return clean.where("_id IS NOT NULL AND _v IS NOT NULL")

    rows = stage(prepared(vectors).withColumn("_block_key", F.xxhash64("_id", F.monotonically_increasing_id())), "topk-rows")
    asked = stage(prepared(queries).distinct(), "topk-queries")
    n_rows, n_asked = rows.count(), asked.count()
    row_blocks, query_blocks = max(1, -(-n_rows // ROWS)), max(1, -(-n_asked // QUERIES))
    # Every block of rows meets every block of queries: the smaller side is sent to each.
    left = rows.select(
        F.pmod("_block_key", F.lit(row_blocks)).cast("int").alias("rb"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"),
        "_id",
        "_v",
    )
    right = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"),
        F.pmod(F.xxhash64("_id"), F.lit(query_blocks)).cast("int").alias("qb"),
        "_id",
        "_v",
    )

    def search(own: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if own.num_rows and asked.num_rows:
            width = max(_width(own), _width(asked))
            vectors, wanted = _matrix(own, width), _matrix(asked, width)
            largest = width * _largest(vectors) * _largest(wanted)
            if largest >= EXACT:
                raise OverflowError(f"inner products of up to {largest:.3g} are not exact; scale the vectors down")
            index = ImpactIndex(own.column("_id").to_numpy(), vectors)
            for query_id, query in zip(asked.column("_id").to_pylist(), wanted):
                ids, scores = index.search(query, k, query_id)
                out[0] += [query_id] * len(ids)
                out[1] += ids.tolist()
                out[2] += scores.tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"])

    found = left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _largest(grid: np.ndarray) -> float:
    return float(np.abs(grid.astype(float)).max(initial=0.0))


def _width(table: pa.Table) -> int:
    lengths = table.column("_v").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    return int(lengths.max()) if len(lengths) else 0


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    lists = table.column("_v").combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width)[None] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out
