"""Ranked search against scoring every document."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.llm import best_position as bp
from tests.llm.frames import DDL, clashing, empty, odd_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    spelled = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in spelled), sum(len(t) for _, t in spelled)
    df = {}
    for _, t in spelled:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    out = []
    for item, text in set(items):
        scores = []
        for i, t in spelled:
            score = 0
            for term in set(terms(text)):
                tf = t.count(term)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 10 + 90 * len(t) * n_docs // n_terms
                    score += w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def documents():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["The", "of", "ÉTÉ", "naïve", "x2"]
    weights = [1 / (i + 1) for i in range(60)] + [5, 4, 0.1, 0.1, 1]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 60)))) for i in range(300)]
    rows += [(1_000 + i, "of the copies w7 w7") for i in range(40)]  # ties
    return rows + odd_rows() + [(2_000, "w3-w5_w3\x00W3 w9 " * 3_000)]


@pytest.mark.parametrize("sizes", [(400_000, 2_048), (50, 2)])
def test_all_items_against_all_documents(spark, monkeypatch, sizes):
    monkeypatch.setattr(bp, "SHARD_POSTINGS", sizes[0])
    monkeypatch.setattr(bp, "ITEMS", sizes[1])
    docs = documents()
    items = [(1, "The w3 of w40"), (2, "w59"), (3, None), (4, ""), (5, "absent"), (6, "été ÉTÉ x2 naïve w1 w2"), (6, "w1"), (7, "of the"), (7, "of the")]
    items += [(None, "w7 copies"), (8, "w3 " * 5_000)]
    left = clashing(spark.createDataFrame([(i, t, None, None, None) for i, t in docs], DDL).repartition(4))
    left = left.withColumns({c: F.lit("x") for c in ("_doc", "_term", "_text", "rank", "item_id")})
    right = spark.createDataFrame(items, "item_id long, text string").withColumn("_term", F.lit(1))
    got = bp.search(left, right, k=10).collect()
    # Two texts under one id are two items, each with its own ranks.
    assert sorted(map(tuple, got), key=repr) == brute(docs, items, 10)


def test_small_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    one = spark.createDataFrame([(1, "b", None, None, None), (2, "", None, None, None)], DDL)
    assert bp.search(empty(spark), some).count() == 0 and bp.search(one, none).count() == 0
    assert [tuple(r) for r in bp.search(one, some).collect()] == brute([(1, "b"), (2, "")], [(1, "a b")], 10)


def lists_of(rng, n, m):
    out = []
    for _ in range(m):
        docs = np.sort(rng.choice(n, rng.integers(1, n), replace=False))
        impacts = rng.integers(1, 50, len(docs)) ** 2
        order = np.lexsort((docs, -impacts))
        out.append(bp.ImpactList(docs[order], impacts[order]))
    return out


def test_best_positions_stop_early_and_lose_nothing():
    rng = np.random.default_rng(3)
    early = 0
    for trial in range(60):
        n = int(rng.integers(5, 3_000))
        lists = lists_of(rng, n, int(rng.integers(1, 5)))
        whole = np.zeros(n, np.int64)
        for x in lists:
            whole[x.docs] += x.impacts
        best = sorted((-s, d) for d, s in enumerate(whole.tolist()) if s)[:10]
        docs, scores, read = bp.best_positions(lists, 10, n)
        assert [(-s, d) for d, s in zip(docs.tolist(), scores.tolist())] == best
        early += read < max(len(x.docs) for x in lists)
    assert early > 20


def test_terms_are_those_of_the_pattern():
    for text in ("Ab-cD_9 é ß\U0001F600x\x00y\x7fz", "", None, "[a]{b}@`c/:;0"):
        assert [t.decode() for t in bp.terms_of(text)] == terms(text)
