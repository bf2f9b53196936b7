"""Tokenizer operators against the libraries."""

import hashlib
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import pieces, tokencount, tokenfile

PIECES, BYTES, WORDS = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"))
STRANGE = st.text(st.sampled_from("ab E'sré.,\n\t \x1c\x85 ▁<|>😀9Σİ中"), max_size=60) | st.text(max_size=30)


@pytest.fixture(scope="module")
def byte_tok():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def word_tok():
    return Tokenizer.from_file(WORDS)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(STRANGE)
def test_pieces_equal_the_library(text):
    codec, library = pieces.codec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = codec.encode(text)
    assert ids == library.encode(text)
    assert codec.decode(ids) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(STRANGE)
def test_counts_equal_the_library(text):
    tok = Tokenizer.from_file(BYTES) if not hasattr(test_counts_equal_the_library, "tok") else test_counts_equal_the_library.tok
    test_counts_equal_the_library.tok = tok
    count = getattr(test_counts_equal_the_library, "count", None) or tokencount.counter(BYTES)
    test_counts_equal_the_library.count = count
    assert count([text]) == [len(tok.encode(text, add_special_tokens=False).ids)]


@settings(max_examples=300, deadline=None)
@given(STRANGE)
def test_word_ids_equal_the_library(text):
    tok = getattr(test_word_ids_equal_the_library, "tok", None) or Tokenizer.from_file(WORDS)
    test_word_ids_equal_the_library.tok = tok
    assert np.frombuffer(tokenfile.encoder(WORDS)(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=9), min_size=1, max_size=5))
def test_packing_round_trip(texts):
    packed = [tokenfile.pack(np.array(t, np.uint64)) for t in texts]
    back = tokenfile.unpack(b"".join(p[0] for p in packed), b"".join(p[1] for p in packed), np.array([len(t) for t in texts]))
    assert back.tolist() == [i for t in texts for i in t]


def test_packing_is_byte_aligned():
    control, data = tokenfile.pack(np.array([1, 256, 65536, 1 << 24, 7]))
    assert control == bytes([0b11100100, 0]) and len(data) == 1 + 2 + 3 + 4 + 1


def test_encode_documents(hard, empty, docs, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for source, want in ((hard, [(r.doc_id, r.text) for r in hard.collect()]), (docs, list(texts.items()))):
        expected = []
        for i, text in want:
            ids = library.encode(text or "")
            expected.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
        got = [tuple(r) for r in pieces.encode_documents(source, PIECES).collect()]
        assert sorted(got, key=str) == sorted(expected, key=str)
    assert pieces.encode_documents(empty, PIECES).count() == 0


def test_token_counts_and_cache(spark, hard, empty, docs, texts, byte_tok, tmp_path):
    cache = str(tmp_path / "cache")
    assert tokencount.count_tokens(empty, BYTES, cache).count() == 0
    for source, want in ((docs, list(texts.items())), (hard, [(r.doc_id, r.text) for r in hard.collect()])):
        expected = []
        for i, text in want:
            n = len(byte_tok.encode(text or "", add_special_tokens=False).ids)
            expected.append((i, len((text or "").encode()), n, n > 1024))
        got = [tuple(r) for r in tokencount.count_tokens(source, BYTES, cache).collect()]
        assert sorted(got, key=str) == sorted(expected, key=str)
    entries = spark.read.parquet(cache).count()
    assert entries == len({t or "" for t in texts.values()} | {r.text or "" for r in hard.collect()})
    tokencount.count_tokens(hard, BYTES, cache).count()
    assert spark.read.parquet(cache).count() == entries  # nothing was encoded again


def test_cache_is_used(spark, tmp_path):
    cache, one = str(tmp_path / "cache"), spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    tokencount.open_cache(spark, cache)
    digest = hashlib.sha256(b"some text").digest()
    spark.createDataFrame([(digest, tokencount.version(BYTES), 77), (digest, "another version", 5)], tokencount.CACHE).write.mode("append").parquet(cache)
    assert tokencount.count_tokens(one, BYTES, cache).first().n_tokens == 77
    assert tokencount.count_tokens(one, PIECES, cache).first().n_tokens == len(
        sentencepiece.SentencePieceProcessor(model_file=PIECES).encode("some text"))


def test_token_file(spark, hard, empty, docs, texts, word_tok, tmp_path):
    for name, source, want in (("a", docs, list(texts.items())), ("b", hard, [(r.doc_id, r.text) for r in hard.collect()])):
        path = str(tmp_path / name)
        tokenfile.write(source, WORDS, path)
        back = tokenfile.read_back(spark, path)
        got = sorted(back.collect(), key=lambda r: r.start)
        assert [r.doc_id for r in got] == sorted([i for i, _ in want], key=lambda i: (i is not None, i))
        at = 0
        for r in got:
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert (r.start, r.n_tokens) == (at, len(ids))
            assert ids in [word_tok.encode(t or "", add_special_tokens=False).ids + [tokenfile.END] for i, t in want if i == r.doc_id]
            at += len(ids)
        crc = {r.doc_id: r.ids_crc32 for r in tokenfile.digest(back).collect()}
        assert all(crc[r.doc_id] == zlib.crc32(r.ids) for r in got)
        ranks = tokenfile.ranks_of(spark, path)
        assert ranks[0] in (END_OR_MOST(got))
    path = str(tmp_path / "none")
    tokenfile.write(empty, WORDS, path)
    assert tokenfile.read_back(spark, path).count() == 0


def END_OR_MOST(rows):
    ids, n = np.unique(np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows]), return_counts=True)
    return ids[n == n.max()].tolist()


def test_encoded_rows_hold_ids_and_text(spark, hard, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = [(r.doc_id, len(ids := library.encode(r.text or "")), ids, library.decode(ids)) for r in hard.collect()]
    got = [tuple(r) for r in corpus_pipeline.encoding(spark, hard, "").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert corpus_pipeline.encoding(spark, empty, "").count() == 0


SPECIALS = ["a <|ENDOFTEXT|> b", "<|EndOfText|>", "x<|StartOfText|>y", "<|endoftext|> <|ENDOFTEXT|>", "É <|ENDOFTEXT|>", "Σ <|ENDOFTEXT|> b"]


@pytest.mark.parametrize("text", SPECIALS)
def test_special_strings_in_upper_case(text, word_tok):
    ids = word_tok.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokenfile.encoder(WORDS)(text), "<u4").tolist() == ids
