"""The Merkle manifest against a plain one."""

import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.llm import merkle, queries
from tests.llm.frames import DDL, clashing, empty

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return hashed(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([hashed(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path(levels, i):
    for nodes in levels[:-1]:
        run = nodes[i - i % 3 : i - i % 3 + 3]
        yield "".join(run[: i % 3]), "".join(run[i % 3 + 1 :])
        i //= 3


def brute(rows):
    """``rows`` as tuples of COLUMNS."""
    trees = {}
    for row in rows:
        i, text = row[0], row[4]
        tampered = i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and text is not None
        other = (*row[:4], text.replace("\n", "")) if tampered else row
        trees.setdefault(row[1], []).append((i, leaf(row), leaf(other)))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {}
    for name in names:
        trees[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        levels[name] = levels_of([x[1] for x in trees[name]])
    top = levels_of([levels[n][-1][0] for n in names])
    for j, name in enumerate(names):
        for i, (doc, own, claimed) in enumerate(trees[name]):
            steps = [*path(levels[name], i), *path(top, j)]
            folded = claimed
            for before, after in steps:
                folded = hashed(before, folded, after)
            root = top[-1][0]
            yield doc, own, levels[name][-1][0], root, hashed(*[p for s in steps for p in s]), folded, folded == root


def run(df, height):
    out = merkle.verified_documents(
        df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")),
        list(COLUMNS), "doc_id", "source", "text", height,
    )
    return sorted(map(tuple, out.collect()), key=repr)


def odd_documents():
    rows = [(i, f"line {i}\nmore", "en", "a", i) for i in range(40)]
    rows += [(i, "x\n\ny", None, "b", None) for i in (7, 9, 9, 9, 11)]
    rows += [(None, "no id\n", "en", "a", 3), (None, None, None, None, None), (5, "", "de", "é", 0), (6, None, "de", "", 1)]
    rows += [(100, "long " * 40_000 + "\n", "en", None, 200_001), (101, "\n", "en", "single", 1)]
    return rows


@pytest.mark.parametrize("height", [1, 2, merkle.HEIGHT])
def test_every_row_against_a_plain_tree(spark, height):
    rows = odd_documents()
    df = clashing(spark.createDataFrame(rows, DDL).repartition(5)).withColumns({c: F.lit("clash") for c in ("root", "_tree", "_leaf")})
    expected = sorted(brute([(r[0], r[3], r[2], r[4], r[1]) for r in rows]), key=repr)
    assert run(df, height) == expected
    assert not all(r[-1] for r in expected) and any(r[-1] for r in expected)


def test_small_tables(spark):
    assert run(empty(spark), 2) == []
    one = [(4, "a\nb", "en", "s", 3)]
    (row,) = run(spark.createDataFrame(one, DDL), 2)
    assert row == next(brute([(4, "s", "en", 3, "a\nb")])) and row[1] == row[2] == row[3]


def test_columns_the_hash_is_over():
    assert leaf((None, "é", "")) == hashed("-", "2:é", "0:")


@pytest.mark.parametrize("levels", range(1, 8))
def test_addresses_fill_a_block_and_keep_subtrees_together(levels):
    places = [merkle.addresses(levels, d) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range(merkle.size(levels)))
    top = levels // 2
    if levels > 1:
        # The top part comes first; each bottom subtree is one stretch laid out by the same rule.
        assert max(p.max() for p in places[:top]) < merkle.size(top) if top else True
        size = merkle.size(levels - top)
        for j in range(3**top):
            own = np.concatenate([p.reshape(3**top, -1)[j] for p in places[top:]])
            assert own.min() == merkle.size(top) + j * size and own.max() - own.min() == size - 1
            inner = np.concatenate([merkle.addresses(levels - top, d) for d in range(levels - top)])
            assert (own - own.min() == inner).all()


def test_siblings_of_partial_blocks():
    for n in (1, 2, 3, 4, 9, 10, 26, 27):
        leaves = [hashed(str(i)).encode() for i in range(n)]
        levels = 1 + merkle.levels_over(n)
        nodes = merkle.build(leaves, levels)
        plain = levels_of([x.decode() for x in leaves])
        assert nodes[0].decode() == plain[-1][0]
        assert merkle._unpack(merkle._pack(nodes), n, levels) == nodes
        for i in range(n):
            steps = merkle.siblings(nodes, levels, i)
            assert [(a.decode(), b.decode()) for a, b in steps] == list(path(plain, i))
            assert merkle.fold(leaves[i], steps) == nodes[0]


def test_query_is_the_operator(spark):
    rows = queries.op11_merkle_manifest(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*COLUMNS)
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(brute([tuple(r) for r in docs.collect()]), key=repr)
