"""Exact duplicates by an extendible-hash index on shared files.

Documents are equal when their texts are identical after the white space is deleted.

1. *Entries*: one small row per document (row number, id, length, two 64-bit hashes), written once.
2. *Texts*: a grouping on (hashes, text) compares bytes. Copies collapse in the map tasks, so a
   text that a third of the rows share reaches its owner once per map task.
3. *Directory*: the leading hash bits address slots. It doubles until no bucket holds more than
   ``capacity`` keys; a bucket that fits keeps its shorter prefix and spans several slots.
4. *Index*: one row per distinct text, range-partitioned by (bucket, hash), so that each owner
   task holds a range of keys; texts of equal hash are chained by number. It is written as files.
5. *Lookup*: every entry finds its key. Keys with more than 1/``HEAVY_SHARE`` of all rows, of which
   there are fewer than ``HEAVY_SHARE``, are broadcast; all others have bounded groups and shuffle.

Only DataFrame functions are used; nothing is gathered per group or on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.tables import SPACES, fresh
from loamline.staging import stage

CAPACITY = 16_384
MAX_DEPTH = 20
HEAVY_SHARE = 1_000
KEY = ["_h", "_tail"]


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


def directory(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(slot, depth, bucket) for every occupied slot of the directory over ``_h``.

    The global depth is the number of doublings the key count asks for, plus slack for uneven
    buckets, at most ``max_depth``: the directory has at most 2 ** max_depth rows. A slot's local
    depth is the shortest prefix whose bucket is not overfull. ``bucket`` is the first slot of it.
    """
    total = keys.count()
    depth = min(max_depth, max(0, math.ceil(math.log2(max(1, total / capacity)))) + 2)
    filled = keys.groupBy(slot_of(F.col("_h"), depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    tried = filled.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    width = F.expr(f"shiftleft(1L, {depth} - depth)")
    prefix = tried.withColumn("first", F.col("slot") - F.col("slot") % width)
    size = F.sum("n").over(Window.partitionBy("depth", "first"))
    fits = prefix.withColumn("size", size).where((F.col("size") <= capacity) | (F.col("depth") == depth))
    found = fits.groupBy("slot").agg(F.min(F.struct("depth", "first")).alias("leaf"))
    return found.select(
        "slot",
        F.col("leaf.depth").alias("depth"),
        F.col("leaf.first").alias("bucket"),
        F.lit(depth).alias("global_depth"),
    )


def slot_of(h: Column, depth: int) -> Column:
    return F.shiftrightunsigned(h, 64 - depth) if depth else F.lit(0).cast("long")


def _hashed(docs: DataFrame, text: str, hash64: Callable[[Column], Column]) -> DataFrame:
    norm = normalised(F.col(text))
    return docs.withColumn("_norm", norm).withColumns(
        {"_h": hash64(F.col("_norm")), "_tail": F.xxhash64(F.lit(0x5EED), F.col("_norm"))}
    )


def exact_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    hash64: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with the most code points stays, then the smallest id (null ids last).
    Null texts equal empty ones. Of repeated rows (same id, text and length) exactly one is kept.
    An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    plain = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    entries = stage(
        _hashed(plain, "_text", hash64).select(
            "_id",
            F.char_length(F.coalesce("_text", F.lit(""))).alias("_len"),
            *KEY,
            F.monotonically_increasing_id().alias("_row"),
        ),
        "exact-entries",
    )
    # The bytes: one row per distinct text.
    texts = stage(
        _hashed(plain, "_text", hash64)
        .groupBy(*KEY, "_norm")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*KEY, F.sha2("_norm", 256).alias("_sha")),
        "exact-texts",
    )
    index = stage(_index(entries, texts, capacity), "exact-index")
    # Two texts behind one pair of hashes: their documents are told apart by the text itself.
    mixed = index.where(F.col("_texts") > 1).select(*KEY).distinct()
    result = _lookup(entries, index.where(F.col("_texts") == 1))
    if not mixed.isEmpty():
        result = result.unionByName(_by_text(_hashed(plain, "_text", hash64), mixed))
    return result.select(
        F.col("_id").alias(id_col),
        F.col("_best._id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_best._row") == F.col("_row")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def _best() -> list[Column]:
    order = F.struct(-F.col("_len"), F.col("_id").isNull().alias("_none"), F.col("_id"), F.col("_row"))
    return [F.count(F.lit(1)).alias("_size"), F.min(order).alias("_best")]


def _index(entries: DataFrame, texts: DataFrame, capacity: int) -> DataFrame:
    sizes = entries.groupBy(*KEY).agg(*_best())
    counted = texts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_texts"), F.min("_sha").alias("_sha"))
    keys = counted.join(sizes, KEY)
    slots = directory(counted, capacity)
    depth = slots.agg(F.max("global_depth")).first()[0] or 0
    return (
        keys.withColumn("slot", slot_of(F.col("_h"), depth))
        .join(F.broadcast(slots.select("slot", "bucket")), "slot")
        .drop("slot")
        .repartitionByRange("bucket", "_h")
        .withColumn("chain", F.row_number().over(Window.partitionBy("bucket", "_h").orderBy("_tail")))
    )


def _lookup(entries: DataFrame, index: DataFrame) -> DataFrame:
    limit = max(1, entries.count() // HEAVY_SHARE)
    found = index.select(*KEY, "_size", "_best", "_sha")
    heavy = F.broadcast(found.where(F.col("_size") > limit))
    light = found.where(F.col("_size") <= limit)
    rest = entries.join(heavy.select(*KEY), KEY, "left_anti")
    return entries.join(heavy, KEY).unionByName(rest.join(light, KEY))


def _by_text(hashed: DataFrame, mixed: DataFrame) -> DataFrame:
    rows = stage(
        hashed.join(mixed, KEY, "left_semi").select(
            "_id",
            F.char_length(F.coalesce("_text", F.lit(""))).alias("_len"),
            "_norm",
            F.monotonically_increasing_id().alias("_row"),
        ),
        "exact-mixed",
    )
    best = rows.groupBy("_norm").agg(*_best()).withColumn("_sha", F.sha2("_norm", 256))
    return rows.join(best, "_norm").select(
        "_id", "_len", "_row", "_size", "_best", "_sha", *[F.lit(None).cast("long").alias(k) for k in KEY]
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are matched by id, text digest and length; identical repeated rows stay once.
    """
    classes = stage(exact_classes(docs, id_col, text, **options), "exact-classes")
    sha, own_id, own_sha, rank = (fresh(docs, n) for n in ("_text_sha", "_kept_id", "_kept_sha", "_rank"))
    kept = classes.where("kept").select(F.col(id_col).alias(own_id), F.col("text_sha256").alias(own_sha))
    marked = docs.withColumn(sha, F.sha2(normalised(F.col(text)), 256))
    match = marked[id_col].eqNullSafe(F.col(own_id)) & (F.col(sha) == F.col(own_sha))
    stays = marked.join(kept, match, "left_semi")
    # Only where an id has the same text more than once do several rows match.
    repeated = classes.groupBy(id_col, "text_sha256").count().where("count > 1")
    if not repeated.isEmpty():
        longest = Window.partitionBy(sha, id_col).orderBy(F.char_length(F.coalesce(F.col(text), F.lit(""))).desc())
        stays = stays.withColumn(rank, F.row_number().over(longest)).where(F.col(rank) == 1)
    return stays.select(*docs.columns)
