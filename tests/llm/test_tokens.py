import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, documents
from tokenizers import Tokenizer

from revtide.llm import token_counts, token_store

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n\n \t", "a", "don't  stop\n\n  now ", "x<|endoftext|>y <|endoftext|> <|endoftext", "<|startoftext|>Hi",
    "é é ﬁ Ǆ İstanbul ΣΑΣ", "a\x1cb!\x1c\x1d c", "a\x85b\xa0c  d 　", "\U0001f600\U0001f468‍\U0001f469 ok", "1234567 89",
    "word" * 9000, " " * 5000, "!?" * 3000, "a\x00b \x7f", "it's I'LL we've 'S", "e ́ x", "가 한",
]


def texts():
    rng = random.Random(6)
    alphabet = [*"abcdeéüñ ABC'.,!?\n\t0123", "  ", "<|endoftext|>", " the", " ", "\U0001f600", "ing"]
    return [*ODD, *("".join(rng.choices(alphabet, k=rng.randint(1, 300))) for _ in range(300))]


@pytest.fixture(scope="module")
def byte_tokens():
    return Tokenizer.from_file(BYTES)


def test_pieces_count_as_the_whole(byte_tokens):
    counter = token_counts.Counter(BYTES, huge=10**9)
    counter.memory = token_counts.piece_lengths(byte_tokens, half=40)  # both halves of the memory turn over
    for some in (texts()[:60], texts()[60:200], texts()):
        expected = [len(byte_tokens.encode(text, add_special_tokens=False).ids) for text in some]
        assert counter.counts(some) == expected


@pytest.mark.parametrize("chunk, overlap", [(64, 4), (100, 40), (257, 32)])
def test_chunks_count_as_the_whole(byte_tokens, chunk, overlap):
    for text in [*texts()[::4], " ".join(texts()[20:80]), "z" * 700 + " " + "q" * 300, " \n" * 400 + "end"]:
        expected = len(byte_tokens.encode(text, add_special_tokens=False).ids)
        assert token_counts.count_in_chunks(byte_tokens, text, chunk, overlap) == expected, text


def test_overlaps_widen_when_no_cuts_meet(byte_tokens):
    starts = []

    def watched(tokenizer, text, start, end):
        starts.append(start)
        return token_counts.chunk_cuts(tokenizer, text, start, end)

    text = "word " * 30 + "y" * 400 + " word" * 30
    got = token_counts.count_in_chunks(byte_tokens, text, 128, 16, watched)
    assert got == len(byte_tokens.encode(text, add_special_tokens=False).ids)
    assert len(starts) > len(set(range(0, len(text), 112)))


def test_token_counts(spark):
    frame = documents(spark, [*enumerate(texts()), (1000, None)])
    tokenizer = Tokenizer.from_file(BYTES)
    for options in ({}, {"huge": 200, "chunk": 90, "overlap": 8}):
        got = {r.doc_id: r for r in token_counts.token_counts(frame, BYTES, limit=100, **options).collect()}
        for k, text in [*enumerate(texts()), (1000, "")]:
            n = len(tokenizer.encode(text, add_special_tokens=False).ids)
            assert (got[k].n_bytes, got[k].n_tokens, got[k].over_limit) == (len(text.encode()), n, n > 100)


def test_store_round_trip(spark, tmp_path):
    rows = [*enumerate(texts(), 5), (2000, None), (3, "low id"), (3, "low id"), (3, "other")]
    token_store.write_tokens(documents(spark, rows), f"{tmp_path}/ids", WORDS)
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows}
    back = token_store.read_tokens(spark, f"{tmp_path}/ids").collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in back) == sorted((d, tuple(ids[t])) for d, t in rows)
    index = sorted(token_store.token_index(spark, f"{tmp_path}/ids").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in index] == sorted(d for d, _ in rows)
    at = 0
    for r in index:
        assert r.start == at
        at += r.n_tokens
    expected = sorted((d, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for d, t in rows)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in index) == expected


def test_metadata_prunes(spark, tmp_path):
    token_store.write_tokens(documents(spark, [(i, f"text {i}") for i in range(300)]), f"{tmp_path}/ids", WORDS)
    some = token_store.read_tokens(spark, f"{tmp_path}/ids", [7, 250])
    assert sorted(r.doc_id for r in some.collect()) == [7, 250]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan
    from pyarrow import orc

    files = sorted((tmp_path / "ids").glob("part-*.orc"))
    assert files and all(orc.ORCFile(f).nstripes >= 1 for f in files)


def test_awkward_rows(spark, tmp_path):
    frame = awkward(spark)
    assert token_counts.token_counts(frame, BYTES).count() == frame.count()
    assert token_counts.token_counts(frame.limit(0), BYTES).count() == 0
    token_store.write_tokens(frame, f"{tmp_path}/a", WORDS)
    assert token_store.token_index(spark, f"{tmp_path}/a").count() == frame.count()
    token_store.write_tokens(frame.limit(0), f"{tmp_path}/none", WORDS)
    assert token_store.token_index(spark, f"{tmp_path}/none").count() == 0


ODD = [
    "Hello, World!! it's don't  we'll 'S", "naïve Café É́ é.", "İstanbul ß ǅ ͅ", "123 4.5,6;7 a1b2 x_y", "日本語。テスト, ok",
    "ſo Kelvin K...", "a.b.c. ... .,;", " nbsp　x y", "<|endoftext|> w</w> \x00 x\x1cy", "ª. µ, º; ×! ÷? ŉ",
    "ΑΣ. ΑΣ", "'s, 'T; l'm.", "", " \n\t", "x" * 5000 + "!?",
]


@pytest.mark.parametrize("most_parts", [2_000_000, 5])
def test_columnar_ids_are_the_librarys(most_parts):
    from tokenizers import Tokenizer

    from revtide.llm.columnar_tokens import ColumnarEncoder

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encoder = ColumnarEncoder(tokenizer, most_parts)
    for texts in (ODD, ODD[::-1] * 2, [None, "plain words, again plain words."]):
        ids, sizes = encoder.encode([t and t.encode() for t in texts])
        expected = [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert sizes.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]
