"""A Merkle manifest of a table, stored in van Emde Boas blocks.

Every row is a leaf: a hash over its columns. The rows of one tree (one source, say) ascend by a key;
every three consecutive nodes are hashed into one until a single node is left, the tree's root, and
the roots of all trees form one more tree the same way.

A tree is stored in blocks of up to ``3 ** HEIGHT`` leaves, built by one task each: the roots of the
blocks are the leaves of the next round, so a tree of any size takes few rounds and no task sees more
than a block. Within a block the nodes lie in van Emde Boas order: a tree of L levels is cut at half
height, the top part is stored first and then each bottom subtree, all by the same rule. Addresses
come from arithmetic alone (:func:`addresses`); they serve the construction, which builds the bottom
subtrees first and then the top over their roots, and the retrieval of a leaf's siblings.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.staging import stage

ARITY = 3
HEIGHT = 8  # hashing levels of a full block: 6,561 leaves
DIGEST = 32

BLOCK_SCHEMA = "_tree string, _block long, _n long, _leaves long, _nodes binary, _root string"


# --- layout of a block ---------------------------------------------------------------


def size(levels: int) -> int:
    """Nodes of a complete tree."""
    return (ARITY**levels - 1) // (ARITY - 1)


@lru_cache(maxsize=None)
def addresses(levels: int, depth: int) -> np.ndarray:
    """Where the nodes of one depth (0: the root) of a complete tree lie, from left to right."""
    if levels == 1:
        return np.zeros(1, np.int64)
    top = levels // 2
    if depth < top:
        return addresses(top, depth)
    roots = size(top) + np.arange(ARITY**top) * size(levels - top)
    return (roots[:, None] + addresses(levels - top, depth - top)).ravel()


def hash_of(parts: list[bytes]) -> bytes:
    return sha256(b"".join(parts)).hexdigest().encode()


def levels_over(leaves: int) -> int:
    """Hashing levels until one node is left."""
    out = 0
    while leaves > 1:
        leaves, out = -(-leaves // ARITY), out + 1
    return out


def build(leaves: list[bytes], levels: int) -> list[bytes | None]:
    """All nodes of a block, in their places; None where the tree has no node."""
    nodes: list[bytes | None] = [None] * size(levels)
    for at, leaf in zip(addresses(levels, levels - 1).tolist(), leaves):
        nodes[at] = leaf
    _fill(nodes, np.zeros(1, np.int64), levels, None)
    return nodes


def _fill(nodes: list, bases: np.ndarray, levels: int, children: np.ndarray | None) -> None:
    """Hash the subtrees of ``levels`` levels at ``bases``; ``children`` are those of their lowest nodes.

    Subtrees without children end in leaves, which are there already.
    """
    if levels == 1:
        if children is not None:
            for at, below in zip(bases.tolist(), children.tolist()):
                present = [nodes[c] for c in below if nodes[c] is not None]
                if present:
                    nodes[at] = hash_of(present)
        return
    top = levels // 2
    roots = bases[:, None] + size(top) + np.arange(ARITY**top) * size(levels - top)
    _fill(nodes, roots.ravel(), levels - top, children)
    _fill(nodes, bases, top, roots.reshape(-1, ARITY))


def siblings(nodes: list[bytes | None], levels: int, leaf: int) -> list[tuple[bytes, bytes]]:
    """For each level from the leaf up, the other nodes of its run: those before and those after it."""
    out = []
    for depth in range(levels - 1, 0, -1):
        places = addresses(levels, depth)
        own = leaf % ARITY
        run = [nodes[c] or b"" for c in places[leaf - own : leaf - own + ARITY].tolist()]
        out.append((b"".join(run[:own]), b"".join(run[own + 1 :])))
        leaf //= ARITY
    return out


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    for before, after in path:
        leaf = hash_of([before, leaf, after])
    return leaf


def _pack(nodes: list[bytes | None]) -> bytes:
    return b"".join(bytes.fromhex(n.decode()) if n else bytes(DIGEST) for n in nodes)


def _unpack(stored: bytes, leaves: int, levels: int) -> list[bytes | None]:
    """The nodes of a stored block; which of them exist follows from the number of leaves."""
    hexed = stored.hex().encode()
    nodes: list[bytes | None] = [None] * size(levels)
    for depth in range(levels - 1, -1, -1):
        for at in addresses(levels, depth)[:leaves].tolist():
            nodes[at] = hexed[2 * DIGEST * at : 2 * DIGEST * (at + 1)]
        leaves = -(-leaves // ARITY)
    return nodes


# --- Spark ---------------------------------------------------------------------------


def record_hash(columns: list[Column]) -> Column:
    """Hex SHA-256 over the values: ``-`` for a null, else byte count, colon, value as text."""
    text = [c.cast("string") for c in columns]
    marked = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.sha2(F.concat(*marked), 256)


def positions(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``_pos``, the place within its tree, and ``_n``, the tree's size.

    One range partitioning on (tree, order) deals even a single large tree over all tasks; a place is
    the one within the slice plus the sizes of the slices before. Rows that tie in all of ``order`` get
    places in no particular order.
    """
    ranged = rows.repartitionByRange(F.col(tree), *order).sortWithinPartitions(tree, *order)
    # Written, because the cuts come from sampling: every later read must see the same ones.
    placed = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "merkle-sorted")
    placed = placed.withColumn("_slice", F.shiftright("_at", 33))
    sizes = placed.groupBy(tree, "_slice").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(tree)
    before = F.sum("_c").over(whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(
        tree, "_slice", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_c").over(whole).alias("_n")
    )
    joined = placed.join(stage(sizes, "merkle-slices"), [tree, "_slice"])
    return joined.withColumn("_pos", F.col("_at") + F.col("_shift")).drop("_at", "_slice", "_shift")


@dataclass(frozen=True)
class Manifest:
    """``leaves`` are the rows with ``_tree``, ``_pos``, ``_n`` and ``_leaf``; ``rounds`` the stored blocks of
    the trees from the leaves up, ``top`` those of the tree over their roots, ``order`` the trees' places in it.
    """

    leaves: DataFrame
    rounds: list[DataFrame]
    top: list[DataFrame]
    order: DataFrame
    height: int = HEIGHT


def build_manifest(rows: DataFrame, leaf: Column, tree: str, order: str, height: int = HEIGHT) -> Manifest:
    """The manifest of ``rows``: one tree for each value of ``tree`` (null is one), ascending by ``order``.

    A null key comes first; rows that share a key ascend by their hash. An empty table has no tree and no
    root. Blocks have ``height`` hashing levels. Columns of ``rows`` are kept as they are and may have any names but those that the result adds.
    """
    named = F.coalesce(F.concat(F.lit("s"), F.col(tree).cast("string")), F.lit(""))
    marked = rows.withColumns({"_tree": named, "_leaf": leaf})
    leaves = stage(positions(marked, "_tree", [order, "_leaf"]), "merkle-leaves")
    rounds = _rounds(leaves.select("_tree", "_pos", "_n", F.col("_leaf").alias("_digest")), height)
    roots = None
    for blocks in rounds:
        done = blocks.where(F.col("_n") <= ARITY**height).select("_tree", F.col("_root").alias("_digest"))
        roots = done if roots is None else roots.unionByName(done)
    named_roots = roots.select(F.lit("").alias("_all"), "_tree", "_digest")
    order_of = stage(positions(named_roots, "_all", ["_tree"]), "merkle-roots")
    top = _rounds(order_of.select(F.col("_all").alias("_tree"), "_pos", "_n", "_digest"), height)
    return Manifest(leaves, rounds, top, order_of.select("_all", "_tree", "_pos", "_digest"), height)


def _rounds(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The blocks over (_tree, _pos, _n, _digest), then those over their roots, until all trees are done."""
    span = ARITY**height

    def block(rows: pa.Table) -> pa.Table:
        return _block(rows, height)

    largest = nodes.agg(F.max("_n")).first()[0] or 1
    out = []
    while True:
        keyed = nodes.withColumn("_block", F.call_function("div", F.col("_pos"), F.lit(span)))
        blocks = stage(keyed.groupBy("_tree", "_block").applyInArrow(block, BLOCK_SCHEMA), "merkle-blocks")
        out.append(blocks)
        if largest <= span:
            return out
        # Only trees that are not done go on.
        nodes = blocks.where(F.col("_n") > span).select(
            "_tree",
            F.col("_block").alias("_pos"),
            F.ceil(F.col("_n") / F.lit(span)).cast("long").alias("_n"),
            F.col("_root").alias("_digest"),
        )
        largest = -(-largest // span)


def _block_levels(n: int, height: int) -> int:
    """Levels of nodes in a block of a tree of ``n``; all blocks of a larger tree have full height."""
    return 1 + (height if n > ARITY**height else levels_over(n))


def _block(rows: pa.Table, height: int) -> pa.Table:
    rows = rows.sort_by("_pos")
    n = rows.column("_n")[0].as_py()
    leaves = [d.encode() for d in rows.column("_digest").to_pylist()]
    nodes = build(leaves, _block_levels(n, height))
    head = [rows.column(c)[0].as_py() for c in ("_tree", "_block")]
    values = [*head, n, len(leaves), _pack(nodes), nodes[0].decode()]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
    names = ["_tree", "_block", "_n", "_leaves", "_nodes", "_root"]
    return pa.table([pa.array([v], k) for v, k in zip(values, kinds)], names)


_UP = "_tree string, _pos long, _up string"


def _write_path(path: list[tuple[bytes, bytes]]) -> str:
    return "/".join(f"{a.decode()}.{b.decode()}" for a, b in path)


def _read_path(text: str) -> list[tuple[bytes, bytes]]:
    return [tuple(part.encode().split(b".")) for part in text.split("/")] if text else []


def _paths_down(blocks: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """(_tree, _pos, _up) of every leaf of the blocks: its siblings in its block, then those above."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                levels = _block_levels(row["_n"], height)
                nodes = _unpack(row["_nodes"], row["_leaves"], levels)
                first = row["_block"] * ARITY**height
                inside = [_write_path(siblings(nodes, levels, i)) for i in range(row["_leaves"])]
                ups = ["/".join(p for p in (path, row["_up"]) if p) for path in inside]
                places = pa.array(range(first, first + row["_leaves"]), pa.int64())
                trees = pa.array([row["_tree"]] * row["_leaves"], pa.string())
                yield pa.record_batch([trees, places, pa.array(ups, pa.string())], ["_tree", "_pos", "_up"])

    return blocks.join(above, ["_tree", "_block"]).mapInArrow(run, _UP)


def _above(paths: DataFrame) -> DataFrame:
    return paths.withColumnRenamed("_pos", "_block")


def verify(manifest: Manifest, claimed: str) -> DataFrame:
    """The manifest's rows with ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    ``proof_sha256`` hashes the siblings of the row's leaf, level by level up to the root. ``folded_root`` is
    recomputed from the digest in column ``claimed`` and these siblings; ``verified`` says whether it is the root.
    """
    height, span = manifest.height, ARITY**manifest.height
    # From the root down: what lies above the blocks of each round.
    last = manifest.top[-1]
    paths = last.select("_tree", "_block", F.lit("").alias("_up"))
    for blocks in reversed(manifest.top):
        paths = stage(_paths_down(blocks, _above(paths) if "_pos" in paths.columns else paths, height), "merkle-paths")
    root = last.select(F.col("_tree").alias("_all"), F.col("_root").alias("_whole"))  # one row
    heads = manifest.order.join(paths.select("_pos", "_up"), "_pos").join(root, "_all")
    heads = stage(heads.select("_tree", F.col("_digest").alias("_subroot"), "_whole", "_up"), "merkle-heads")
    # A tree is done in the round where its nodes fit one block; its path starts there.
    ups = None
    for blocks in reversed(manifest.rounds):
        done = blocks.where(F.col("_n") <= span).select("_tree", "_block").join(heads.select("_tree", "_up"), "_tree")
        ups = done if ups is None else done.unionByName(_above(ups))
        if blocks is not manifest.rounds[0]:
            ups = stage(_paths_down(blocks, ups, height), "merkle-paths")
    stored = manifest.rounds[0].join(ups, ["_tree", "_block"]).join(heads.drop("_up"), "_tree")

    leaves = manifest.leaves.withColumn("_block", F.call_function("div", F.col("_pos"), F.lit(span)))
    own = [c for c in manifest.leaves.columns if c not in ("_tree", "_pos", "_n")]
    told = ["subroot", "root", "proof_sha256", "folded_root"]

    def check(rows: pa.Table, block: pa.Table) -> pa.Table:
        (row,) = block.to_pylist()
        levels = _block_levels(row["_n"], height)
        nodes = _unpack(row["_nodes"], row["_leaves"], levels)
        above = _read_path(row["_up"])
        first = row["_block"] * span
        proofs, folded = [], []
        for at, digest in zip(rows.column("_pos").to_pylist(), rows.column(claimed).to_pylist()):
            path = siblings(nodes, levels, at - first) + above
            proofs.append(hash_of([part for pair in path for part in pair]).decode())
            folded.append(fold(digest.encode(), path).decode())
        same = [pa.array([row[c]] * len(proofs), pa.string()) for c in ("_subroot", "_whole")]
        new = [*same, pa.array(proofs, pa.string()), pa.array(folded, pa.string())]
        return pa.table([rows.column(c) for c in own] + new, own + told)

    kinds = {f.name: f.dataType.simpleString() for f in manifest.leaves.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in own] + [f"{c} string" for c in told])
    keys = ["_tree", "_block"]
    proven = leaves.groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInArrow(check, schema)
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


def verified_documents(docs: DataFrame, tampered: Column, changed: Column, columns: list[str], key: str, tree: str, text: str, height: int = HEIGHT) -> DataFrame:
    """Every row's proof, checked after ``text`` became ``changed`` in the rows where ``tampered`` holds.

    Columns: the key, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of the unchanged rows), ``folded_root``
    and ``verified``. A null in any column is hashed as such; rows without a key come first in their tree and are
    never tampered with if ``tampered`` is null for them. Repeated rows are leaves of their own. Other columns,
    whatever their names, take no part. An empty table gives no rows.
    """
    own = [F.col(c) for c in columns]
    other = [changed if c == text else F.col(c) for c in columns]
    again = F.when(F.coalesce(tampered, F.lit(False)), record_hash(other))
    rows = docs.select(F.col(key), F.col(tree).alias("_of"), record_hash(own).alias("_h"), again.alias("_claim"))
    rows = rows.withColumn("_claim", F.coalesce("_claim", "_h"))
    manifest = build_manifest(rows, F.col("_h"), "_of", key, height)
    out = verify(manifest, "_claim")
    return out.select(key, F.col("_leaf").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", "verified")
