"""The pipeline's stages on small tables, against what each of them should keep."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from loamline.llm import html_text, language_id, pii, queries, unigram
from tests.llm.frames import clashing, documents, prose
from tests.llm.test_dedup import brute_near
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = list(queries.QUERIES)
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(names) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    assert compare(spark, connect(SF_DIR), queries.QUERIES[name], queries.SQL[name], SF_DIR) is None


@pytest.mark.parametrize("name", ["op7_unigram", "op10_quality"])
def test_query_covers_its_table(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    ids = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id")
    assert ids.subtract(df.select("doc_id")).count() == 0


def test_stages_keep_clean_documents_and_drop_copies(spark):
    rng = random.Random(8)
    clean = [(i, prose(rng, 80)) for i in range(1, 40)]
    words = clean[0][1].split(" ")
    words[40] = "changed"
    rows = clean + [(100, clean[1][1].replace(" ", "  ")), (101, " ".join(words)), (102, "123 !!"), (103, None), (104, clean[2][1])]
    rows.append((105, prose(rng, 60) + " mail ann@x.example.com"))
    docs = clashing(documents(spark, rows).fillna({"lang": "aa", "source": "s", "n_chars": 1}))
    docs = docs.withColumns({n: F.lit("clash") for n in ("lang_pred", "_kept_id", "_text_sha", "n_email", "_rank")})
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "pii", "packing"]
    known = stages["language_id"](spark, docs, None)
    assert {r.doc_id for r in known.collect()} == {i for i, _ in rows} - {102, 103} and known.columns == docs.columns
    single = stages["exact_dedup"](spark, known, None)
    got = {r.doc_id for r in single.collect()}
    assert got == {i for i, _ in rows} - {2, 102, 103, 104} and single.columns == docs.columns
    far = stages["near_dedup"](spark, single, None)
    texts = [(r.doc_id, r.text) for r in single.collect()]
    assert {r.doc_id for r in far.collect()} == {i for i, _, _, k in brute_near(texts, 5) if k}
    safe = stages["pii"](spark, far, None)
    new = {r.doc_id: r for r in safe.collect()}
    assert "ann@x" not in new[105].text and all(new[i].text == t for i, t in clean if i in new)
    assert {r.score for r in new.values()} == {"clash"}
    assert all(r.n_chars == len(r.text) for r in new.values()) and safe.columns == docs.columns
    pieces = stages["packing"](spark, safe, None)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(new)


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def checked_pieces(pieces, texts):
    """The pieces of a packing against the library's ids of every (doc_id, text)."""
    coded = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json")).encode_batch([t or "" for _, t in texts], add_special_tokens=False)
    ids = {i: e.ids + [0] for (i, _), e in zip(texts, coded)}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == ids.keys()
    for i, mine in by_doc.items():
        at = 0
        for p in sorted(mine, key=lambda p: p.start):
            digest = p.ids_crc32 if "ids_crc32" in p else zlib.crc32(p.ids)
            assert p.start == at and digest == crc(ids[i][at : at + p.length]) and p.doc_tokens == len(ids[i])
            at += p.length
        assert at == len(ids[i])
    for mine in by_sequence.values():
        ends = np.cumsum([p.length for p in sorted(mine, key=lambda p: p.offset)]).tolist()
        assert [p.offset for p in sorted(mine, key=lambda p: p.offset)] == [0, *ends[:-1]] and ends[-1] <= 1024


def documents_of(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_queries_without_sql_row_by_row(spark):
    texts = [(r.doc_id, r.text) for r in documents_of(spark).collect()]
    changed = {r.doc_id: r for r in queries.op2_pii_pseudonyms(spark, SF_DIR).collect()}
    assert len(changed) == len(texts)
    for i, t in texts:
        new, counts = pii.pseudonymise(t, queries.DEMO_KEY)
        assert changed[i].text == new and changed[i].n_replaced == sum(counts.values())
    checked_pieces(queries.op3_packing(spark, SF_DIR).collect(), texts)
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    found = {r.page_id: r for r in queries.op4_html_text(spark, SF_DIR).collect()}
    assert len(found) == len(pages)
    for page in pages:
        text = html_text.main_text(page.html)
        assert (found[page.page_id].text, found[page.page_id].url, found[page.page_id].n_chars) == (text, page.url, len(text))
    library = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    at, files = 0, {r.doc_id: r for r in queries.op5_token_files(spark, SF_DIR).collect()}
    for i, t in sorted(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert (files[i].start, files[i].n_tokens, files[i].ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)
    network = language_id.fit(documents_of(spark))
    told = {r.doc_id: r for r in queries.op6_language_id(spark, SF_DIR).collect()}
    for (i, _), (lang, score) in zip(texts, network.predict([t for _, t in texts])):
        assert told[i].lang_pred == lang and abs(told[i].score - score) < 1e-4
        assert told[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)


def by_hand(spark, docs):
    """What the stages before packing keep, in plain Python: (doc_id, text)."""
    network = language_id.fit(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    least = 1 / len(network.languages) + 0.05 * (1 - 1 / len(network.languages))
    told = network.predict([t for _, t in rows])
    rows = [r for r, (lang, score) in zip(rows, told) if lang != "und" and score >= least]
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i, t))
    rows = [(i, t) for _, i, t in (min(g) for g in groups.values())]
    kept = {i for i, _, _, k in brute_near(rows, 5) if k}
    return [(i, pii.pseudonymise(t, queries.DEMO_KEY)[0]) for i, t in rows if i in kept]


def test_pipeline_row_by_row(spark, folder):
    rng = random.Random(12)
    scripts = {"aa": {}, "bb": dict(zip(map(ord, "abcdefgil"), "αβγδεζηθι")), "cc": dict(zip(map(ord, "abcdefgil"), "абвгдежзи"))}
    spelled = lambda lang, n: prose(rng, n).translate(scripts[lang])
    rows = [(i, spelled(lang, rng.randrange(1, 150)), lang) for i in range(70) for lang in [("aa", "bb", "cc")[i % 3]]]
    rows += [(100 + i, rows[i][1].replace(" ", "\n"), "aa") for i in range(5)] + [(200, rows[7][1] + " end", None), (201, "12 !", None)]
    rows += [(202, None, None), (203, "", "aa"), (204, spelled("bb", 40) + " mail ann@x.example.com or 4111 1111 1111 1111", "bb"), (205, spelled("cc", 9_000), "cc")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder)
    expected = by_hand(spark, spark.read.parquet(f"{folder}/documents.parquet"))
    assert 60 < len(expected) < 74 and all("ann@x" not in t for _, t in expected)
    checked_pieces(out.collect(), expected)


def test_pipeline_of_tables_without_labels_or_rows(spark, folder):
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "no language is told here", None, None, 24), (1, "no language is told here", None, None, 24), (2, "!!", None, None, 2), (None, None, None, None, None)]
    spark.createDataFrame(rows, ddl).write.parquet(f"{folder}/some/documents.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, f"{folder}/some").collect()} == {1}
    spark.createDataFrame([], ddl).write.parquet(f"{folder}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0


def test_vocabulary_has_pieces_and_bytes():
    vocabulary = unigram.load_vocabulary(queries.tokenizer_path("piece_bpe_32k.model"))
    assert len(vocabulary["raw"]) == 256 and vocabulary["fallback"] < -10
