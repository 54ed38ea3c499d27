"""Exact and near duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.llm import exact_dedup, near_dedup, shingles
from loamline.llm.components import connected_components
from tests.llm.frames import clashing, documents, empty, odd_rows, prose


def brute_exact(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, k))
    out = []
    for norm, members in groups.items():
        best = min(members)
        for m in members:
            sha = hashlib.sha256(norm.encode()).hexdigest()
            out.append((None if m[1] else m[2], None if best[1] else best[2], len(members), m[:3] == best[:3], sha))
    return out


def check_exact(spark, rows, **options):
    got = exact_dedup.exact_classes(clashing(documents(spark, rows)), **options).collect()
    want = brute_exact(rows)
    strip = lambda r: (str(r[0]), str(r[1]), r[2], r[4])
    assert sorted(map(strip, map(tuple, got))) == sorted(map(strip, want))
    by_group = {}
    for r in got:
        by_group.setdefault(r.text_sha256, []).append(r)
    for members in by_group.values():
        assert sum(r.kept for r in members) == 1
        assert next(r for r in members if r.kept).doc_id == members[0].keep_id


def test_exact_odd_rows(spark):
    check_exact(spark, odd_rows())


def test_exact_with_colliding_hashes_compares_bytes(spark):
    rows = odd_rows() + [(i, prose(random.Random(i % 50), 5)) for i in range(100, 220)]
    check_exact(spark, rows, hash64=lambda c: F.lit(1).cast("long"))
    check_exact(spark, rows, hash64=lambda c: F.xxhash64(F.substring(c, 1, 1)), capacity=2)


def test_texts_behind_equal_hashes_are_told_apart(spark, monkeypatch):
    def weak(docs, text, hash64):
        norm = exact_dedup.normalised(F.col(text))
        return docs.withColumn("_norm", norm).withColumns({"_h": F.lit(3).cast("long"), "_tail": F.char_length("_norm").cast("long")})

    monkeypatch.setattr(exact_dedup, "_hashed", weak)
    check_exact(spark, odd_rows() + [(i, "ab"[i % 2] * 4) for i in range(50, 70)])


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(2_000).select(F.xxhash64("id").alias("_h"))
    slots = exact_dedup.directory(keys, capacity=100).collect()
    depth = slots[0].global_depth
    sizes = {}
    for r in keys.select(exact_dedup.slot_of(F.col("_h"), depth).alias("s")).collect():
        bucket = next(x for x in slots if x.slot == r.s)
        assert bucket.bucket == r.s - r.s % (1 << (depth - bucket.depth))
        sizes[bucket.bucket] = sizes.get(bucket.bucket, 0) + 1
    assert max(sizes.values()) <= 100 and len(sizes) > 20


def test_exact_empty_and_keep_first(spark):
    assert exact_dedup.exact_classes(empty(spark)).count() == 0
    docs = documents(spark, odd_rows())
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len({r[4] for r in brute_exact(odd_rows())})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id in (8, 1, 2, 3)) == [1, 8]


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def set_of(text, n):
    w = words_of(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute_near(rows, n):
    rows = [r for r in rows if r[0] is not None]
    sets = [set_of(t, n) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (i, _) in enumerate(rows):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and 100 * both >= 80 * len(sets[x] | sets[y]):
                a, b = sorted((root(i), root(rows[y][0])))
                parent[b] = a
    return sorted({(i, len(s), root(i), root(i) == i) for (i, _), s in zip(rows, sets)})


def corpus(seed, groups=12, size=9):
    """Groups of near copies on both sides of the threshold, chains included."""
    rng = random.Random(seed)
    rows, i = [], 1
    for g in range(groups):
        words = prose(rng, rng.choice([4, 12, 40, 120])).split(" ")
        for _ in range(size):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, max(1, len(words) // 18)])):
                copy[rng.randrange(len(copy))] = rng.choice(["alpha", "beta", "gamma", "delta"])
            if rng.random() < 0.4:
                words = copy  # the next copies follow this one
            rows.append((i, (" " if rng.random() < 0.7 else "\n").join(copy)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_equal_brute_force(spark, n):
    rows = corpus(n) + [(1_000 + (i or 0), t) for i, t in odd_rows() if i is not None]
    got = near_dedup.near_duplicates(clashing(documents(spark, rows)), words=n).collect()
    assert len(got) == len(rows)
    assert sorted({tuple(r) for r in got}) == brute_near(rows, n)


def test_near_rows_without_id_and_empty_table(spark):
    got = near_dedup.near_duplicates(documents(spark, odd_rows()), words=2).collect()
    none = [r for r in got if r.doc_id is None]
    assert len(none) == 2 and all(r.kept and r.component_id is None for r in none)
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


def test_blocks_of_large_buckets_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "BROADCAST_IDS", 0)
    rows = corpus(11, groups=5, size=14)
    got = near_dedup.near_duplicates(documents(spark, rows), words=2).collect()
    assert sorted({tuple(r) for r in got}) == brute_near(rows, 2)


def test_buckets_of_a_shared_passage_are_compared_in_bounded_groups(spark, monkeypatch):
    block = 8
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    grouped = type(spark.range(1).groupBy())
    apply = grouped.applyInArrow

    def bounded(self, function, schema):
        def checked(table):
            if table.num_rows > 5 * block:
                raise ValueError(f"group of {table.num_rows} rows")
            return function(table)

        return apply(self, checked, schema)

    monkeypatch.setattr(grouped, "applyInArrow", bounded)
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(80))
    rows = [(i, f"{passage} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(17))) for i in range(1, 121)]
    # Two links that no hub shows.
    rows += [(201, rows[70][1] + " more"), (202, rows[90][1] + " more")]
    got = near_dedup.near_duplicates(documents(spark, rows), words=2).collect()
    assert sorted({tuple(r) for r in got}) == brute_near(rows, 2)


def test_keep_representatives(spark):
    rows = corpus(4, groups=4)
    kept = near_dedup.keep_representatives(documents(spark, rows), words=2)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, _, k in brute_near(rows, 2) if k)


def test_shingle_sets_equal_plain_python():
    texts = [t for _, t in odd_rows()]
    for n in (1, 2, 5):
        sets = shingles.shingle_sets(texts, n)
        plain = [set_of(t, n) for t in texts]
        assert sets.sizes.tolist() == [len(s) for s in plain]
        values = [set(sets.values[a:b].tolist()) for a, b in zip(sets.starts, sets.starts[1:])]
        for x in range(len(texts)):
            for y in range(len(texts)):
                assert len(values[x] & values[y]) == len(plain[x] & plain[y])
        d1, d2 = shingles.digests(sets)
        for x in range(len(texts)):
            for y in range(len(texts)):
                assert ((d1[x], d2[x]) == (d1[y], d2[y])) == (plain[x] == plain[y])


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    errors, rejected = [], 0
    for true in (0.8, 0.9, 0.95):
        for _ in range(60):
            n = 400
            common = int(2 * n * true / (1 + true))
            x = rng.integers(0, 1 << 63, 2 * n - common).astype(np.uint64)
            a, b = np.sort(x[:n]), np.sort(x[n - common :])
            sets = shingles.Sets(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            sketch = shingles.odd_sketches(shingles.minhash(sets))
            apart = int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())
            errors.append(shingles.estimate(apart) - true)
            rejected += apart > shingles.bits_allowed(0.8)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06 and rejected == 0


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(300, 400)]
    ring = [(500 + i, 500 + (i + 1) % 9) for i in range(9)]
    links = spark.createDataFrame(chain + star + ring + [(9, 9), (None, 4)], "a long, b long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(300, 400)]} | {i: 500 for i in range(500, 509)}
    assert got == want
