"""Repeated passages against a table of all strings of 50 bytes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.llm import repeats
from tests.llm.frames import DDL, clashing, empty, odd_rows

LAST = repeats.LAST


def brute(rows, span=repeats.SPAN):
    least = {}
    texts = [(i, LAST if i is None else i, (t or "").encode()) for i, t in rows]
    for _, order, b in texts:
        for p in range(len(b) - span + 1):
            g = b[p : p + span]
            least[g] = min(least.get(g, LAST), order)
    for i, order, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - span + 1):
            if least[b[p : p + span]] < order:
                gone[p : p + span] = b"\1" * span
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        yield i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)


def rows():
    rng = random.Random(1)
    base = "".join(rng.choice("abc ") for _ in range(3_000))
    line = "".join(rng.choice("qwertyuiop") for _ in range(100))
    noise = lambda n: "".join(rng.choice("asdfghjkl") for _ in range(rng.randrange(n)))
    out = [(1, base), (2, base[100:400] + "x" * 80 + base[500:560]), (3, "x" * 300), (4, "x" * 60 + "y"), (5, base[:49])]
    out += [(6, base[:50]), (6, base[:50]), (7, base[:50]), (None, base), (None, base[5:90]), (9, "ab" * 200), (10, "ba" * 100)]
    out += [(11, "é" * 120), (12, "zé" + "é" * 40), (13, "\0" * 70 + base[:70]), (14, "q\0" * 40), (15, "\0" * 55)]
    # A common line within different texts: its edges have as many contexts as there are documents.
    out += [(100 + i, noise(90) + line[rng.randrange(3) : 100 - rng.randrange(3)] + noise(90)) for i in range(80)]
    out += [(300 - i, base[20 * i : 20 * i + 200] + noise(60) + base[-300:]) for i in range(20)]
    return out + [(i if i is None else i + 1_000, t) for i, t in odd_rows()]


@pytest.mark.parametrize("sizes", [(2_048, 4 << 20, 1 << 18), (4, 900, 1 << 18)])
def test_every_document_against_all_strings(spark, monkeypatch, sizes):
    # Tiny parts make every anchor of the line hot; tiny blocks cut the table into many.
    monkeypatch.setattr(repeats, "PART", sizes[0])
    monkeypatch.setattr(repeats, "BLOCK_BYTES", sizes[1])
    data = rows()
    df = clashing(spark.createDataFrame([(i, t, None, None, None) for i, t in data], DDL).repartition(4))
    df = df.withColumns({c: F.lit("clash") for c in ("_block", "_order", "_h", "kept", "n_bytes")})
    got = repeats.remove_repeats(df).collect()
    names = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got]
    assert sorted(names, key=repr) == sorted(brute(data), key=repr)
    assert sum(r.n_removed for r in got) > 10_000


def test_empty_table(spark):
    assert repeats.remove_repeats(empty(spark)).count() == 0


def test_anchors_do_not_depend_on_segments_or_neighbours(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(n)).encode() for n in (700, 49, 50, 0, 3_000)]
    together = repeats.Texts(texts)
    place, h = together.anchors()
    alone = [repeats.Texts([t]).anchors() for t in texts]
    starts = together.bounds[:-1]
    assert place.tolist() == [p + s for (ps, _), s in zip(alone, starts.tolist()) for p in ps.tolist()]
    assert h.tolist() == [x for _, hs in alone for x in hs.tolist()]
    monkeypatch.setattr(repeats, "SEGMENT", 64)
    again = together.anchors()
    assert again[0].tolist() == place.tolist() and again[1].tolist() == h.tolist()
    # Every 50 bytes of a text hold an anchor.
    for (ps, _), t in zip(alone, texts):
        for p in range(len(t) - repeats.SPAN + 1):
            assert ((ps >= p) & (ps <= p + repeats.BEFORE)).any()


def plain_repeats(strings, shortest):
    """{(string, occurrences)} of all maximal repeats; a string's first byte has a left neighbour of its own."""
    found = {}
    for n, s in enumerate(strings):
        for a in range(len(s)):
            for z in range(a + shortest, len(s) + 1):
                found.setdefault(s[a:z], set()).add((n, a))
    out = set()
    for text, where in found.items():
        left = {strings[n][a - 1 : a] if a else (n, "begin") for n, a in where}
        right = {strings[n][a + len(text) : a + len(text) + 1] or (n, a, "end") for n, a in where}
        if len(where) > 1 and len(left) > 1 and len(right) > 1:
            out.add((text, frozenset(where)))
    return out


@pytest.mark.parametrize("letters", ["ab", "abcd", "\0a", "\xff\xfeb"])
def test_maximal_repeats_with_all_occurrences(letters):
    rng = random.Random(5)
    for trial in range(40):
        strings = ["".join(rng.choice(letters) for _ in range(rng.randrange(14))).encode("latin-1") for _ in range(rng.randrange(1, 7))]
        shortest = rng.randrange(2, 5)
        array = repeats.SuffixArray(strings, shortest)
        got = set()
        for length, begin, end in array.maximal_repeats():
            where = frozenset(zip(array.owner[begin:end].tolist(), array.start[begin:end].tolist()))
            n, a = next(iter(where))
            got.add((strings[n][a : a + length], where))
        # Suffixes shorter than the limit are no part of the array, and no repeat needs them.
        assert got == plain_repeats(strings, shortest)
        order = np.array([rng.randrange(4) for _ in strings])
        starts = repeats.repeated_starts(array, order)
        for n, s in enumerate(strings):
            for a in range(len(s) - shortest + 1):
                g = s[a : a + shortest]
                wanted = any(order[m] < order[n] and g in t for m, t in enumerate(strings))
                assert starts[n, a] == wanted
