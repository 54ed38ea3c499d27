"""Near-duplicate documents: banded MinHash, odd sketches, exact confirmation, components.

1. *Signatures*: one pass over the texts gives each document's shingle-set size, a 128-bit digest of
   the set, 32 band keys of 4 MinHash samples each, and an odd sketch (128 samples folded into a
   512-bit parity bitmap). Documents with equal sets form one class and go on as one.
2. *Stars*: in each bucket of a band the smallest id is the hub; every other member is paired with
   it. So a bucket of any size gives a row per member, never all pairs.
3. *Candidates*: the popcount of the XOR of two odd sketches estimates the similarity; pairs that
   cannot reach it (five standard deviations away) go. So do pairs whose odd sketches of the whole
   sets prove that too many shingles are not in common.
4. *Confirmation*: what remains is compared on the full shingle sets, built again from the texts.
5. *Rest*: where a bucket's members are still in several components, members outside of its main
   component are compared, by sketches, with all members of the bucket, in pairs of blocks; first the best
   partner of each is confirmed, then every candidate that still joins two components.

A pair of similarity 0.8 misses all bands with probability (1 - 0.8 ** 4) ** 32 = 5e-8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm import shingles
from loamline.llm.components import connected_components
from loamline.llm.tables import fresh, slices
from loamline.staging import stage

WORDS = 5
PERCENT = 80
BLOCK = 2_048
HEAVY_SHARE = 1_000
BROADCAST_IDS = 500_000  # ids sent to every executor at most; more are joined by a shuffle
SET = ["_s1", "_s2", "_n"]


def signatures(docs: DataFrame, id_col: str, text: str, words: int) -> DataFrame:
    """(_id, _n, _s1, _s2, _sketch, _parity, _bands) for each row; no bands for an empty set."""
    plain = docs.select(docs[id_col].cast("long").alias("_id"), docs[text].alias("_text"))
    schema = "_id long, _n long, _s1 long, _s2 long, _sketch binary, _parity binary, _bands array<long>"

    def run(batches):
        for batch in batches:
            for part in slices(batch, 100):
                sets = shingles.shingle_sets(part.column(1).to_pylist(), words)
                s1, s2 = shingles.digests(sets)
                samples = shingles.minhash(sets)
                sketches = [row.tobytes() for row in shingles.odd_sketches(samples)]
                parity = [row.tobytes() for row in shingles.parity_bitmaps(sets)]
                keys = shingles.band_keys(samples)
                used = sets.sizes > 0
                offsets = np.concatenate([[0], np.cumsum(used * shingles.BANDS)]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[used].ravel()))
                columns = [part.column(0), *map(pa.array, (sets.sizes, s1, s2)), pa.array(sketches, pa.binary())]
                columns += [pa.array(parity, pa.binary()), bands]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_n", "_s1", "_s2", "_sketch", "_parity", "_bands"])

    return plain.mapInArrow(run, schema)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    Two documents are linked when 100 * |intersection| >= percent * |union| of their shingle sets;
    component_id is the smallest id reachable over links, kept tells whether it is the own one.
    Documents without words (null, empty, blank) are linked with nothing. Rows that share an id are
    one document. A row without id is linked with nothing, has no component and is kept. An empty
    table gives no rows; other columns are not read. Ids must be integers.
    """
    signed = stage(signatures(docs, id_col, text, words), "near-signatures")
    usable = signed.where("_n > 0 AND _id IS NOT NULL")
    # Equal sets are one class; the smallest id stands for it.
    classes = stage(
        usable.groupBy(*SET).agg(
            F.min("_id").alias("_rep"),
            F.count(F.lit(1)).alias("_size"),
            F.first("_sketch").alias("_sketch"),
            F.first("_parity").alias("_parity"),
            F.first("_bands").alias("_bands"),
        ),
        "near-classes",
    )
    shared = usable.select("_id", "_s1").distinct().groupBy("_id").count().where("count > 1")
    same_id = shared.select("_id").join(usable.select("_id", *SET).distinct(), "_id")
    same_id = same_id.join(classes.select(*SET, "_rep"), SET).select(F.col("_id").alias("a"), F.col("_rep").alias("b"))
    links = same_id.where("a <> b")

    member = classes.select("_rep", F.explode("_bands").alias("_key"))
    buckets = member.groupBy("_key").agg(F.min("_rep").alias("_hub"), F.max("_rep").alias("_top"))
    buckets = stage(buckets.where("_hub <> _top").select("_key", "_hub"), "near-buckets")
    members = stage(member.join(buckets, "_key"), "near-members")
    stars = members.where("_rep <> _hub").select(F.col("_hub").alias("a"), F.col("_rep").alias("b")).distinct()
    confirmed = _confirm(docs, id_col, text, words, percent, _candidates(stars, classes, percent))
    links = stage(links.unionByName(confirmed), "near-links")
    labels = stage(connected_components(links), "near-labels")
    for best_only in (True, False):
        rest = stage(_rest(members, classes, labels, percent, best_only), "near-rest")
        if rest.isEmpty():
            continue
        more = stage(_confirm(docs, id_col, text, words, percent, rest), "near-links")
        if more.isEmpty():
            continue
        # The components so far are stars; the new links join some of them.
        links = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
        labels = stage(connected_components(links), "near-labels")

    found = (
        classes.select(*SET, "_size", F.col("_rep").alias("node"))
        .join(labels, "node", "left")
        .select(*SET, "_size", F.coalesce("component", "node").alias("_component"))
    )
    found = stage(found, "near-components")
    limit = max(1, signed.count() // HEAVY_SHARE)
    heavy = F.broadcast(found.where(F.col("_size") > limit).drop("_size"))
    light = found.where(F.col("_size") <= limit).drop("_size")
    rows = signed.select("_id", *SET)
    linked = rows.where("_n > 0 AND _id IS NOT NULL")
    others = rows.where("_n = 0 OR _id IS NULL").withColumn("_component", F.col("_id"))
    rare = linked.join(heavy.select(*SET), SET, "left_anti").join(light, SET)
    every = linked.join(heavy, SET).unionByName(rare).unionByName(others)
    return every.select(
        F.col("_id").cast(docs.schema[id_col].dataType).alias(id_col),
        F.col("_n").alias("n_shingles"),
        F.col("_component").alias("component_id"),
        F.coalesce(F.col("_id") == F.col("_component"), F.lit(True)).alias("kept"),
    )


def _with_classes(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        own = classes.select(
            F.col("_rep").alias(side),
            F.col("_s1").alias(f"{side}_s1"),
            F.col("_n").alias(f"{side}_n"),
            F.col("_sketch").alias(f"{side}_sketch"),
            F.col("_parity").alias(f"{side}_parity"),
        )
        pairs = pairs.join(own, side)
    return pairs


def _candidates(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, a_s1, b, b_s1) whose sizes and sketches allow the similarity."""
    allowed = shingles.bits_allowed(percent / 100)
    sizes = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2_000):
                bits = [np.frombuffer(b"".join(part.column(k).to_pylist()), np.uint8) for k in range(6, 10)]
                a, b, a_all, b_all = (x.reshape(part.num_rows, -1) for x in bits)
                a_n, b_n = part.column(4).to_numpy(), part.column(5).to_numpy()
                fit = np.bitwise_count(a ^ b).sum(1) <= allowed
                fit &= shingles.may_link(np.bitwise_count(a_all ^ b_all).sum(1, dtype=int), a_n, b_n, percent)
                yield part.select([0, 1, 2, 3]).filter(pa.array(fit))

    names = ["a", "a_s1", "b", "b_s1", "a_n", "b_n", "a_sketch", "b_sketch", "a_parity", "b_parity"]
    wide = _with_classes(pairs, classes).where(sizes).select(*names)
    return wide.mapInArrow(run, "a long, a_s1 long, b long, b_s1 long")


def _confirm(docs: DataFrame, id_col: str, text: str, words: int, percent: int, candidates: DataFrame) -> DataFrame:
    """Links (a, b) among the candidates, by the full sets."""
    pairs = stage(candidates.distinct(), "near-candidates")
    wanted = pairs.select(F.col("a").alias("_want")).unionByName(pairs.select(F.col("b").alias("_want"))).distinct()
    wanted = stage(wanted, "near-wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    plain = docs.select(docs[id_col].cast("long").alias("_id"), docs[text].alias("_text"))
    needed = plain.join(wanted, F.col("_id") == F.col("_want"), "left_semi")

    def build(batches):
        for batch in batches:
            for part in slices(batch, 100):
                sets = shingles.shingle_sets(part.column(1).to_pylist(), words)
                cuts = sets.starts.tolist()
                values = [sets.values[i:j].tobytes() for i, j in zip(cuts, cuts[1:])]
                columns = [part.column(0), pa.array(shingles.digests(sets)[0]), pa.array(values, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_s1", "_set"])

    # Repeated rows give equal sets for (id, digest): a pair confirmed twice is still one link.
    sets = stage(needed.mapInArrow(build, "_id long, _s1 long, _set binary"), "near-sets")

    def compare(batches):
        for batch in batches:
            for part in slices(batch, 1_000):
                linked = []
                for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = np.concatenate([x, y])
                    both.sort()
                    common = int((both[1:] == both[:-1]).sum())
                    linked.append(100 * common >= percent * (len(both) - common))
                yield part.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    for side in ("b", "a"):
        own = sets.select(F.col("_id").alias(side), F.col("_s1").alias(f"{side}_s1"), F.col("_set").alias(f"{side}_set"))
        pairs = pairs.join(own, [side, f"{side}_s1"])
    return pairs.select("a", "b", "a_set", "b_set").mapInArrow(compare, "a long, b long")


def _rest(members: DataFrame, classes: DataFrame, labels: DataFrame, percent: int, best_only: bool) -> DataFrame:
    """Candidate pairs (a, a_s1, b, b_s1) that share a bucket but no component yet.

    A bucket's main component is its hub's. Members outside of it, in blocks of their own, are
    compared with every block of the bucket; a block on either side holds about ``BLOCK`` members,
    so a pair of blocks is bounded. With ``best_only`` each of them gives its best candidate of the
    block, else all.
    """
    allowed = shingles.bits_allowed(percent / 100)
    known = labels.select(F.col("node").alias("_rep"), F.col("component").alias("_component"))
    now = members.join(known, "_rep", "left").withColumn("_component", F.coalesce("_component", "_rep"))
    now = stage(now.select("_key", "_rep", "_component", "_hub"), "near-now")
    # A bucket of two has been compared: one of them is the hub.
    open_ = now.groupBy("_key").agg(
        F.min("_component").alias("_low"),
        F.max("_component").alias("_high"),
        F.count(F.lit(1)).alias("_members"),
        F.max(F.when(F.col("_rep") == F.col("_hub"), F.col("_component"))).alias("_main"),
    )
    open_ = open_.where("_low <> _high AND _members > 2").select("_key", "_main", F.ceil(F.col("_members") / BLOCK).cast("int").alias("_blocks"))
    open_ = stage(open_, "near-open")
    minor = F.col("_component") != F.col("_main")
    sides = now.join(open_, "_key").where(minor).groupBy("_key").count()
    sides = sides.select("_key", F.ceil(F.col("count") / BLOCK).cast("int").alias("_sides"))
    open_ = stage(open_.join(sides, "_key"), "near-open")
    rows = now.where("_rep <> _hub").drop("_hub").join(open_, "_key")
    salt = F.xxhash64("_rep")
    rows = rows.select(
        "_key", "_rep", "_component", "_blocks", "_sides", minor.alias("_minor"),
        F.pmod(salt, F.col("_blocks")).cast("int").alias("_home"), F.pmod(salt, F.col("_sides")).cast("int").alias("_own"),
    )
    # Every member stands in its block against all sides; one outside of the main component also in
    # its side against all blocks.
    place = lambda side, block: F.struct(side.alias("_side"), block.alias("_block"))
    numbers = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    here = F.transform(numbers("_sides"), lambda s: place(s, F.col("_home")))
    others = F.filter(numbers("_blocks"), lambda b: b != F.col("_home"))
    there = F.transform(others, lambda b: place(F.col("_own"), b))
    places = F.when(F.col("_minor"), F.concat(here, there)).otherwise(here)
    columns = ["_key", "_rep", "_component", "_minor", "_home", "_own"]
    spread = rows.select(*columns, F.explode(places).alias("_place")).select(*columns, "_place.*")
    own = classes.select("_rep", "_s1", "_n", "_sketch", "_parity")

    def compare(table: pa.Table) -> pa.Table:
        rep, comp, minor, own_side, side, home, block, s1, n = (
            table.column(k).to_numpy()
            for k in ("_rep", "_component", "_minor", "_own", "_side", "_home", "_block", "_s1", "_n")
        )
        sketch, parity = (
            np.frombuffer(b"".join(table.column(k).to_pylist()), np.uint64).reshape(len(rep), -1)
            for k in ("_sketch", "_parity")
        )
        left, right = np.flatnonzero(minor & (own_side == side)), np.flatnonzero(home == block)
        found = [np.zeros(0, np.int64)]
        for at in range(0, len(left), 16):
            i = left[at : at + 16]
            apart = np.zeros((len(i), len(right)), np.int32)
            for w in range(sketch.shape[1]):
                apart += np.bitwise_count(sketch[i, w][:, None] ^ sketch[right, w][None])
            x, y = np.nonzero((apart <= allowed) & (comp[i][:, None] != comp[right][None]))
            x, y = i[x], right[y]
            far = np.bitwise_count(parity[x] ^ parity[y]).sum(1, dtype=np.int64)
            fit = shingles.may_link(far, n[x], n[y], percent)
            fit &= np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent
            x, y, far = x[fit], y[fit], far[fit]
            if best_only:
                order = np.lexsort((far, x))
                x, y = x[order], y[order]
                first = np.flatnonzero(np.diff(x, prepend=-1))
                x, y = x[first], y[first]
            swap = rep[x] > rep[y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            found.append(x * len(rep) + y)
        x, y = np.divmod(np.unique(np.concatenate(found)), max(1, len(rep)))
        return pa.table({"a": rep[x], "a_s1": s1[x], "b": rep[y], "b_s1": s1[y]})

    # As many tasks as shuffles have: the rows are few, the comparisons may not be.
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = spread.join(own, "_rep").repartition(tasks, "_key", "_side", "_block").groupBy("_key", "_side", "_block")
    return grouped.applyInArrow(compare, "a long, a_s1 long, b long, b_s1 long").distinct()


def keep_representatives(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` whose document stands for its component, with all columns."""
    own = fresh(docs, "_kept_id")
    found = near_duplicates(docs, id_col, text, words, percent)
    kept = found.where("kept").select(F.col(id_col).alias(own)).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(F.col(own)), "left_semi")
