"""Operators 1 and 8 against the tokenizers library, and Elias-Fano against plain lists."""

import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, op1_bpe, op8_token_files
from ledgerloom.llm.eliasfano import Sequence, pack

from .helpers import edge_documents, edge_texts, no_documents, rows


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def test_every_token_is_valid_and_pairs_agree_with_merging():
    b = bpe.load()
    assert b.valid.all()
    rnd = random.Random(3)
    words = ["".join(rnd.choice("aeinrtshld'") for _ in range(rnd.randint(1, 90))) for _ in range(400)]
    assert b.encode_words(words) == [b.merge(w.encode()) for w in words]


@settings(max_examples=150, derandomize=True, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="abeht' .,\n<|>endoftxsrÀéß0½²Σİ日😀́", max_size=60))
def test_encoding_and_decoding_equal_the_library(text):
    t, b = Tokenizer.from_file(P.path("word_bpe_49k.json")) if not hasattr(test_encoding_and_decoding_equal_the_library, "t") else test_encoding_and_decoding_equal_the_library.t, bpe.load()
    test_encoding_and_decoding_equal_the_library.t = t
    ids = t.encode(text, add_special_tokens=False).ids
    assert b.encode([text]) == [ids]
    assert b.decode(ids) == t.decode(ids, skip_special_tokens=False)


def test_digests_of_edge_documents(spark, library):
    got = sorted(rows(op1_bpe.round_trip_digests(edge_documents(spark))), key=lambda r: (r["doc_id"] or 0, r["ids_sha256"]))
    want = []
    for i, t in edge_texts():
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append({"doc_id": i, "n_tokens": len(ids), "ids_sha256": sha(" ".join(map(str, ids))), "decoded_sha256": sha(library.decode(ids, skip_special_tokens=False))})
    assert got == sorted(want, key=lambda r: (r["doc_id"] or 0, r["ids_sha256"]))
    assert rows(op1_bpe.round_trip_digests(no_documents(spark))) == []


def test_encode_then_decode_frames(spark, library):
    coded = op1_bpe.encode(edge_documents(spark))
    back = {(r["doc_id"], r["decoded"]) for r in rows(op1_bpe.decode(coded))}
    assert back == {(i, library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, t in edge_texts()}


@settings(max_examples=80, derandomize=True, deadline=None)
@given(st.lists(st.integers(0, 1 << 40) | st.integers(0, 50), max_size=300))
def test_elias_fano(values):
    values = sorted(values)
    s = Sequence(b"xx" + pack(np.array(values, dtype=np.uint64)), 2)
    assert s.all().tolist() == values
    assert [s.get(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(100, 900, 100_000))
    assert len(pack(values)) < 100_000 * 1.7  # a 64-bit table takes 8 bytes each


@pytest.mark.parametrize("parts", [1, 3])
def test_token_files(spark, library, tmp_path, parts, monkeypatch):
    monkeypatch.setattr(op8_token_files, "SEGMENT_IDS", 500)
    at = str(tmp_path / "files")
    op8_token_files.write(edge_documents(spark), at, parts=parts)
    got = sorted(rows(op8_token_files.documents(spark, at, digest=True)), key=lambda r: r["start"])
    texts = sorted(edge_texts(), key=lambda x: -1 if x[0] is None else x[0])
    assert [r["doc_id"] for r in got] == [i for i, _ in texts]
    start = 0
    for r, (_, t) in zip(got, texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    whole = {r["start"]: r["ids"] for r in rows(op8_token_files.documents(spark, at))}
    assert whole[0] == library.encode(texts[0][1], add_special_tokens=False).ids + [2]
    image = op8_token_files.TokenFile(op8_token_files.read(spark, at).where("start = 0").first()["image"])
    assert image.document(0).tolist() == whole[0]


def test_token_files_of_nothing(spark, tmp_path):
    op8_token_files.write(no_documents(spark), str(tmp_path / "none"))
    assert rows(op8_token_files.documents(spark, str(tmp_path / "none"))) == []


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "a", "acgt", "éàüß日本", "#*$%&|<>"])
def test_long_words_take_time_in_proportion(letters):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    own = bpe.load()
    for n in (513, 3000, 400_000):
        text = "".join(random.Random(n).choices(letters, k=n))
        began = time.perf_counter()
        got = own.encode([text, "short words", None, text[:600]])
        assert time.perf_counter() - began < 10
        assert got == [library.encode(t or "", add_special_tokens=False).ids for t in (text, "short words", None, text[:600])]


def test_long_words_of_several_parts(monkeypatch):
    monkeypatch.setattr(bpe, "PLACES", 100)
    own = bpe.load()
    for k in range(40):
        rnd = random.Random(k)
        word = "".join(rnd.choices(rnd.choice(["abc", "etaoin", "xyz", "hello"]), k=rnd.randrange(513, 1200))).encode()
        assert own.long_word(word) == own.merge(word)
