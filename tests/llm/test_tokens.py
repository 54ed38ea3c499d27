"""Packing, token files and unigram encoding against the libraries and exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loamline.llm import bpe, packing, token_files, unigram
from loamline.staging import new_path, stage
from tests.llm.frames import clashing, documents, empty, odd_rows, prose

GPT = public_tokenizers.path("byte_bpe_50k.json")
CLIP = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def library(path, texts, end):
    t = Tokenizer.from_file(path)
    return [e.ids + [end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path", [GPT, CLIP])
def test_chunks_give_the_librarys_ids(path):
    rng = random.Random(1)
    alphabet = "ab Z'ñß\n\t \xa0\x85\x1c0½,.<|>́é日\U0001F600ΣİÅ"
    texts = [t or "" for _, t in odd_rows()] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(600)]
    texts += ["it's we'll I'M 'S", "a <|startoftext|> b", "<|endoftext|>", "x\n  y", "a  ", " a"]
    small = bpe.ChunkEncoder(path, cache_chunks=50)  # evicts between calls
    got = [b for i in range(0, len(texts), 20) for b in small.encode(texts[i : i + 20])]
    want = [e.ids for e in small.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, small.dtype).tolist() for b in got] == want


@pytest.mark.parametrize("path", [GPT, CLIP])
def test_plain_words_need_no_search_for_pieces(path):
    texts = ["Hello world, yes. No? A b; C: d! Zz", "the The THE the."]
    coder = bpe.ChunkEncoder(path)
    first = coder.encode(["Hello the A"])  # with the marks of a text's first chunk
    coder.pieces = None
    got = [coder._chunk(c) for t in texts for c in t.split(" ")]
    space = " " if coder.kind == "spaced" else ""
    want = [coder.tokenizer.encode(space + c, add_special_tokens=False).ids for t in texts for c in t.split(" ")]
    assert [np.frombuffer(b, coder.dtype).tolist() for b in got] == want
    assert np.frombuffer(first[0], coder.dtype).tolist() == coder.tokenizer.encode("Hello the A", add_special_tokens=False).ids


def test_packing_cuts_every_document_gaplessly(spark):
    docs = clashing(documents(spark, odd_rows()))
    pieces = packing.pack_documents(docs, GPT).collect()
    texts = [t for _, t in odd_rows()]
    want = sorted((i is None, i or 0, len(ids), ids) for (i, _), ids in zip(odd_rows(), library(GPT, texts, 0)))
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, ids))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length, p.sequence_length))
    have = []
    for (doc, total), parts in by_doc.items():
        parts.sort()
        copies = sum(start == 0 for start, _ in parts)
        assert sum(len(ids) for _, ids in parts) == total * copies
        if copies == 1:
            joined = [x for _, ids in parts for x in ids]
            have.append((doc is None, doc or 0, total, joined))
    assert sorted(have) == [w for w in want if sum(w[:3] == o[:3] for o in want) == 1]
    for parts in by_sequence.values():
        parts.sort()
        at = 0
        for offset, length, total in parts:
            assert offset == at
            at += length
        assert at == parts[0][2] <= 1024 and at & (at - 1) == 0  # no padding at all


def test_packing_fills_windows_from_shorter_tiers():
    rng = random.Random(5)
    packer = packing.Packer(64, 2)
    docs = [(i, bytes(2 * rng.choice([1, 3, 7, 20, 33, 50, 64, 150]))) for i in range(300)]
    done = []
    for i, ids in docs:
        packer.add(i, ids)
        if i % 40 == 0:
            done += packer.flush(False)
    assert all(sum(len(p[3]) for p in w) // 2 in (1, 2, 4, 8, 16, 32, 64) for w in done)
    done += packer.flush(True)
    assert sum(len(p[3]) for w in done for p in w) == sum(len(ids) for _, ids in docs)
    long = [w for w in done if sum(len(p[3]) for p in w) == 128]
    assert len(long) > len(done) / 2 and any(len(w) > 2 for w in long)


def test_steps_are_balanced():
    steps = packing.balanced_steps([1024] * 20 + [512] * 9 + [64] * 5, 4096)
    totals = np.bincount(steps, [1024] * 20 + [512] * 9 + [64] * 5)
    assert totals.max() - totals.min() <= 1024


def test_token_files_round_trip(spark):
    rows = odd_rows() + [(i, prose(random.Random(i), 50 + i)) for i in range(100, 160)]
    folder = new_path(spark, "test-tokens")
    docs = clashing(documents(spark, rows))
    index = stage(token_files.write_token_files(docs, folder, CLIP, width=64, rows=8), "test-index")
    got = token_files.read_token_files(token_files.with_starts(spark, index), folder).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = {}
    for (i, t), ids in zip(order, library(CLIP, [t for _, t in order], 2)):
        want.setdefault(i, []).append(ids)
    stream = {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.n_tokens and ids in want[r.doc_id]
        stream[r.start] = ids
    assert len(got) == len(rows)
    at = 0
    for start in sorted(stream):
        assert start == at
        at += len(stream[start])
    assert at == sum(len(x) for v in want.values() for x in v)
    ids_in_order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids_in_order == [i for i, _ in order]


def test_token_file_gives_views_of_equal_length(tmp_path):
    path = str(tmp_path / "x.arrow")
    with open(path, "wb") as sink:
        writer = token_files.SequenceWriter(sink, np.dtype("<u2"), width=16, rows=4)
        writer.append(np.arange(150, dtype="<u2").tobytes())
        writer.close()
    reader = token_files.SequenceReader(path)
    ids, mask = reader.sequence(9)
    assert ids.tolist() == [*range(144, 150), *[0] * 10] and mask.sum() == 6 and not ids.flags.owndata
    assert reader.sequence(3)[1].all() and reader.span(60, 80).tolist() == list(range(60, 140))


def brute_force(model, data: bytes) -> float:
    """Best score over all cuts of a whole text, by the pieces' definition."""
    pieces = {}
    for i, text in enumerate(model.texts):
        if model.log[i] > -np.inf:
            pieces[text.replace(b" ", "▁".encode())] = model.log[i]
    best = [0.0] + [-np.inf] * len(data)
    for j in range(1, len(data) + 1):
        for i in range(max(0, j - 48), j):
            if data[i:j] in pieces:
                best[j] = max(best[j], best[i] + pieces[data[i:j]])
            elif len(data[i:j].decode(errors="replace")) == 1 and "�" not in data[i:j].decode(errors="replace"):
                best[j] = max(best[j], best[i] + model.fallback)
    return best[-1]


def test_unigram_is_the_best_path_of_the_whole_text(spark):
    vocabulary = unigram.load_vocabulary(MODEL)
    model = unigram.Unigram(vocabulary, cache_words=20)
    rng = random.Random(2)
    for text in [prose(rng, 12), "the device  and   more ", "日本 naïve \U0001F600 x", " lead", "a" * 70]:
        data = (" " + text).replace(" ", "▁").encode()
        ids = np.frombuffer(model.encode([text])[0], model.dtype).tolist()
        score, n_bytes = 0.0, 0
        for i in ids:
            if model.log[i] > -np.inf:
                score += model.log[i]
        chars = [c for c in text if c.encode() not in {t for k, t in enumerate(model.texts) if model.log[k] > -np.inf} and c != " "]
        n_bytes = len(chars)
        assert score + n_bytes * model.fallback == pytest.approx(brute_force(model, data), abs=1e-6)


def test_vector_and_single_word_paths_agree():
    model = unigram.Unigram(unigram.load_vocabulary(MODEL))
    words = [("▁" + w).encode() for w in (prose(random.Random(9), 300) + " 日本 \U0001F600é x").split(" ")]
    assert model.best_paths(words) == [model.best_path(w)[0] for w in words]


def test_unigram_decodes_every_text(spark):
    vocabulary = unigram.load_vocabulary(MODEL)
    rows = odd_rows()
    got = unigram.encode_documents(clashing(documents(spark, rows)), vocabulary).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in got) == sorted((str(i), t or "") for i, t in rows)
    assert all(len(r.ids) == 4 * r.n_pieces for r in got)


def test_empty_tables(spark):
    nothing = empty(spark)
    assert packing.pack_documents(nothing, GPT).count() == 0
    folder = new_path(spark, "test-empty")
    index = stage(token_files.write_token_files(nothing, folder, CLIP), "test-index")
    assert token_files.read_token_files(token_files.with_starts(spark, index), folder).count() == 0
    assert unigram.encode_documents(nothing, unigram.load_vocabulary(MODEL)).count() == 0


def test_crc_of_little_endian_ids(spark):
    from pyspark.sql import functions as F

    row = spark.sql("SELECT X'0100000002000000' AS x").select(F.crc32("x").alias("c")).first()
    assert row.c == zlib.crc32(np.array([1, 2], "<u4").tobytes())


def test_white_space_and_word_shapes_are_encoded_as_the_library_does():
    words = ["plain", "Häuser", "é", "x9", "12-ab", "don't", "(a)", "naïve,", "ÀÉ'll", "$5.00", ""]
    gaps = [" ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\t ", "\t\n", "\n\t", "  ", "　\n", "\n ", "\r\n"]
    texts = [f"{a}{gap}{b}{gap}{a} {b}" for a in words for b in words for gap in gaps]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        coder = bpe.ChunkEncoder(public_tokenizers.path(name))
        expected = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(c, coder.dtype).tolist() for c in coder.encode(texts)] == expected
