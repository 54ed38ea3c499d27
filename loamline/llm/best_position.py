"""Ranked lexical search by the Best Position Algorithm over impact lists.

A term has one list per shard of documents: the documents that hold it, by descending impact. For a
query the lists of its terms are read in parallel from their fronts. A document met for the first time
is looked up in every other list by direct access, which gives its whole score and marks its place in
each list as seen. A list's best position is the end of the seen places that have no gap before
them, however few of them were read in order: a document not seen yet lies behind it in every list, so
the sum of the impacts right behind the best positions bounds its score. The search stops when this
bound is strictly below the k-th best score, so that ties are never lost.

Documents are dealt into shards by a hash, so a term that every document holds is spread like any
other; each shard gives its k best of each query, and the best of these are the answer. Scores are whole
numbers, computed with statistics of all documents.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.tables import slices
from loamline.staging import stage

SHARD_POSTINGS = 400_000  # postings of a shard
ITEMS = 2_048  # queries that meet a shard at once
FIRST_STEP = 32  # places read of each list before the first test

# Terms: A-Z in lower case; every other ASCII character but digits and lower-case letters separates.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# No term is empty, so the empty one can mark the row that stands for a whole document.
WHOLE = ""


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TERMS).split()


# --- one shard ---------------------------------------------------------------------


@dataclass
class ImpactList:
    """Documents by descending impact, and the same by document for direct access."""

    docs: np.ndarray
    impacts: np.ndarray

    def __post_init__(self):
        self.places = np.argsort(self.docs, kind="stable")
        self.sorted_docs = self.docs[self.places]

    def look_up(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``docs`` are in the list, and the places of those."""
        at = np.minimum(np.searchsorted(self.sorted_docs, docs), len(self.docs) - 1)
        there = self.sorted_docs[at] == docs
        return there, self.places[at[there]]


def best_positions(lists: list[ImpactList], k: int, n_docs: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, places read in order): the k best by (score descending, document ascending)."""
    known = np.zeros(n_docs, bool)
    seen = [np.zeros(len(x.docs) + 1, bool) for x in lists]  # the place behind the end is never seen
    best = [0] * len(lists)
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth, step = 0, FIRST_STEP
    longest = max((len(x.docs) for x in lists), default=0)
    while depth < longest:
        read = np.unique(np.concatenate([x.docs[depth : depth + step] for x in lists]))
        new = read[~known[read]]
        known[new] = True
        total = np.zeros(len(new), np.int64)
        for n, x in enumerate(lists):
            there, places = x.look_up(new)
            total[there] += x.impacts[places]
            seen[n][places] = True
            best[n] += int(seen[n][best[n] :].argmin())
        docs, scores = np.concatenate([docs, new]), np.concatenate([scores, total])
        order = np.lexsort((docs, -scores))[:k]
        docs, scores = docs[order], scores[order]
        depth, step = depth + step, step * 2
        bound = sum(int(x.impacts[b]) for x, b in zip(lists, best) if b < len(x.docs))
        if len(docs) == k and bound < scores[-1]:
            break
    return docs, scores, min(depth, longest)


# --- Spark ---------------------------------------------------------------------------


def _term_rows(docs: DataFrame) -> DataFrame:
    """(_row, _doc, _n, _term, _tf): a row for each term of a document, and one with the term WHOLE."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 100):
                found = [Counter(terms_of(t)) for t in part.column("_text").to_pylist()]
                sizes = np.array([len(c) + 1 for c in found])
                term = pa.array([t for c in found for t in (b"", *c)], pa.binary()).cast(pa.string())
                tf = pa.array([t for c in found for t in (0, *c.values())], pa.int64())
                n = np.repeat([sum(c.values()) for c in found], sizes)
                at = pa.array(np.repeat(np.arange(len(found)), sizes))
                own = [part.column(c).take(at) for c in ("_row", "_doc")]
                yield pa.record_batch([*own, pa.array(n, pa.int64()), term, tf], ["_row", "_doc", "_n", "_term", "_tf"])

    return docs.mapInArrow(run, "_row long, _doc long, _n long, _term string, _tf long")


def weight(n_docs: int, df: Column) -> Column:
    return F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * df + 1))).cast("long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def impact(w: Column, tf: Column, n: Column, n_docs: int, n_terms: int) -> Column:
    m = 10 + _div(90 * n * F.lit(n_docs), F.lit(n_terms))
    return w * _div(1_000_000_000 * tf, 1000 * tf + 8 * m)


_LISTS = "_shard int, _term string, _rows array<long>, _docs array<long>, _impacts array<long>"


def _lists(postings: pa.Table) -> pa.Table:
    """A shard's postings as one row for each term, by descending impact."""
    rows = postings.sort_by([("_term", "ascending"), ("_impact", "descending"), ("_row", "ascending")]).combine_chunks()
    term = rows.column("_term").combine_chunks().dictionary_encode()
    codes = term.indices.to_numpy()
    cuts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    offsets = pa.array(np.append(cuts, len(codes)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, rows.column(c).combine_chunks()) for c in ("_row", "_doc", "_impact")]
    shard = pa.array([rows.column("_shard")[0].as_py()] * len(cuts), pa.int32())
    return pa.table([shard, rows.column("_term").take(pa.array(cuts)), *lists], ["_shard", "_term", "_rows", "_docs", "_impacts"])


def _items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(_item, _id, _term): the distinct terms of each item; repeated items are one."""
    named = items.select(F.col(item_id).alias("_id"), F.col(text).alias("_text")).distinct()
    named = stage(named.withColumn("_item", F.monotonically_increasing_id()), "search-items")
    spelled = _term_rows(named.select(F.col("_item").alias("_row"), F.lit(0).cast("long").alias("_doc"), "_text"))
    terms = spelled.where(F.col("_term") != WHOLE).select(F.col("_row").alias("_item"), "_term")
    return stage(terms.join(named.select("_item", "_id"), "_item"), "search-terms")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """(item id, rank, doc id, score): the ``k`` documents of highest score above 0 for each item.

    All documents take part. Ties go to the smaller doc id, a null id last; then to either. A null or empty text
    has no terms: as a document it is never found and does not count, as an item it has no rows. Rows that
    repeat a doc id are documents of their own; items that repeat id and text are asked once, other texts under
    one item id are items of their own. Empty tables give no rows; other columns may have any names.
    """
    asked = _items(items, item_id, text)
    wanted = asked.select("_term").distinct().unionByName(asked.sparkSession.range(1).select(F.lit(WHOLE).alias("_term")))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("_text"))
    # Only terms that are asked for are written, beside one row for each document. Written terms have a
    # measured size, so they are broadcast exactly when they are few.
    postings = stage(_term_rows(rows).join(stage(wanted, "search-wanted"), "_term", "left_semi"), "search-postings")
    whole = postings.where(F.col("_term") == WHOLE)
    counts = whole.agg(F.count_if(F.col("_n") > 0).alias("n"), F.sum("_n").alias("l")).first()
    n_docs, n_terms = counts.n or 0, counts.l or 0

    held = postings.where(F.col("_term") != WHOLE)
    df = held.groupBy("_term").agg(F.count(F.lit(1)).alias("_df"))
    weights = stage(df.select("_term", "_df", weight(n_docs, F.col("_df")).alias("_w")), "search-weights")
    total = weights.agg(F.sum("_df")).first()[0] or 0
    shards = max(1, -(-total // SHARD_POSTINGS))
    scored = held.join(weights.select("_term", "_w"), "_term").select(
        F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("int").alias("_shard"),
        "_term", "_row", "_doc",
        impact(F.col("_w"), F.col("_tf"), F.col("_n"), n_docs, max(n_terms, 1)).alias("_impact"),
    )
    lists = stage(scored.where(F.col("_impact") > 0).groupBy("_shard").applyInArrow(_lists, _LISTS), "search-lists")

    # Queries meet a shard in blocks; a list goes only to the blocks that ask for its term.
    blocks = max(1, -(-asked.select("_item").distinct().count() // ITEMS))
    block = F.pmod(F.xxhash64("_item"), F.lit(blocks)).cast("int")
    asked = asked.withColumn("_part", block)
    needed = stage(asked.select("_part", "_term").distinct(), "search-needed")
    left = lists.join(needed, "_term")
    right = asked.withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    kinds = pa.schema([("_item", pa.int64()), ("_doc", pa.int64()), ("_row", pa.int64()), ("score", pa.int64())])

    def run(own: pa.Table, items: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if own.num_rows and items.num_rows:
            rows = own.column("_rows").combine_chunks()
            row, doc = rows.flatten().to_numpy(), own.column("_docs").combine_chunks().flatten()
            absent, doc = doc.is_null().to_numpy(zero_copy_only=False), doc.fill_null(0).to_numpy()
            # Documents are numbered in the order that decides ties.
            order = np.lexsort((row, doc, absent))
            fresh = np.concatenate([[True], row[order][1:] != row[order][:-1]])
            number = np.empty(len(row), np.int64)
            number[order] = np.cumsum(fresh) - 1
            first = order[fresh]
            impacts = own.column("_impacts").combine_chunks().flatten().to_numpy()
            ends = np.cumsum(rows.value_lengths().to_numpy())
            terms = own.column("_term").to_pylist()
            lists = {t: ImpactList(number[e - c : e], impacts[e - c : e]) for t, e, c in zip(terms, ends, np.diff(ends, prepend=0))}
            by_item: dict[int, list] = {}
            for item, term in zip(items.column("_item").to_pylist(), items.column("_term").to_pylist()):
                if term in lists:
                    by_item.setdefault(item, []).append(lists[term])
            for item, some in by_item.items():
                found, scores, _ = best_positions(some, k, len(first))
                at = first[found]
                out[0] += [item] * len(found)
                out[1] += [None if a else d for a, d in zip(absent[at].tolist(), doc[at].tolist())]
                out[2] += row[at].tolist()
                out[3] += scores.tolist()
        return pa.table([pa.array(c, f.type) for c, f in zip(out, kinds)], kinds.names)

    keys = ["_shard", "_part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "_item long, _doc long, _row long, score long")
    best = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col("_doc").asc_nulls_last(), "_row")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    names = asked.select("_item", "_id").distinct()
    return ranked.join(names, "_item").select(
        F.col("_id").alias(item_id), "rank", F.col("_doc").alias(doc_id), "score"
    )
