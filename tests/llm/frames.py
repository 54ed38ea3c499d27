"""Small document tables with the odd cases every operator must handle."""

from __future__ import annotations

import random

DDL = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in that was with be by wenn der und die le la une été ñandú él ühr straße".split()


def documents(spark, rows, ddl: str = DDL):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], ddl).repartition(3)


def prose(rng: random.Random, n: int) -> str:
    parts = []
    for k in range(n):
        w = rng.choice(WORDS) if rng.random() < 0.5 else "".join(rng.choice("aeioubcdfgl") for _ in range(rng.randrange(2, 9)))
        parts.append(w.capitalize() if k % 11 == 0 else w)
    return " ".join(parts)


def odd_rows() -> list[tuple]:
    """Nulls, empty and blank texts, long texts, ties and repeated rows."""
    rng = random.Random(3)
    base = prose(rng, 60)
    long = prose(rng, 6_000)
    words = base.split(" ")
    near = " ".join(["changed", *words[1:]])
    return [
        (1, base), (2, base), (3, base.replace(" ", "\n")), (4, near), (5, None), (6, ""), (7, " \t\n"),
        (8, long), (8, long), (9, long + " end"), (10, "One"), (11, "one"), (12, base.upper()), (None, base),
        (None, None), (13, "x  y ▁ \U0001F600 é́\xa0z <|endoftext|> \x00"), (14, "!!! 123"), (15, prose(rng, 30)),
    ]


def empty(spark, ddl: str = DDL):
    return spark.createDataFrame([], ddl)


def clashing(docs):
    """The same rows with columns named as the operators' own."""
    from pyspark.sql import functions as F

    names = "_id _text _h _row _n _s1 _key _page id start length ids file position score kept text_sha256 a b".split()
    return docs.withColumns({n: F.lit("clash") for n in names})
