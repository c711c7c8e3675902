import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mergeweave.llm import tokens
from mergeweave.llm.queries import VOCABULARY, tokenizer_path

from .helpers import ODD, ODD_IDS, SCHEMA, docs


@pytest.fixture(scope="module")
def plain():
    """The library's tokenizer as it comes."""
    return Tokenizer.from_file(tokenizer_path())


@pytest.mark.parametrize("width", [1, 3, 13, 16, 17, 31, 32])
def test_round_trip_and_random_access(width):
    draw = np.random.default_rng(width)
    for n in (0, 1, 7, 1024, 1025, 70_001):
        ids = draw.integers(0, 2**width, n, dtype=np.uint64).astype(np.uint32)
        image = tokens.pack(ids, width)
        shard = tokens.Shard(image)
        assert (shard.read(0, n + 5) == ids).all()
        for a, k in ((0, 1), (1000, 50), (n - 3, 9)):
            if 0 <= a < n:
                assert (shard.read(a, k) == ids[a : a + k]).all()
        assert len(shard.payload) == -(-n * width // 8)


def test_too_large_an_id():
    with pytest.raises(ValueError):
        tokens.pack(np.array([8]), 3)


ALPHABET = st.sampled_from(list("ab '1.\n\t é ́\U0001f600|<>") + ["  ", "'s", " ", "\r\n", "<|endoftext|>", "\x1c", "\x85"])


@settings(max_examples=400, deadline=None)
@given(st.lists(ALPHABET, max_size=14).map("".join))
def test_parts_encode_as_the_whole(text):
    t = test_parts_encode_as_the_whole.__dict__.setdefault("t", Tokenizer.from_file(tokenizer_path()))
    assert np.frombuffer(tokens.encoder(tokenizer_path()).encode([text])[0], dtype="<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_documents_encode_as_the_whole(spark, plain):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    own = tokens.Encoder(tokenizer_path(), cache=500)
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in own.encode(texts)] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_letters_alone_are_not_cut_into_pieces(plain, monkeypatch):
    seen = []
    real = tokens.regex.compile(tokens.PIECES)

    class Pieces:
        def findall(self, part):
            seen.append(part)
            return real.findall(part)

    monkeypatch.setattr(tokens.regex, "compile", lambda _: Pieces())
    text = "plain Words don't été x1\nline s t"
    own = tokens.Encoder(tokenizer_path()).encode([text])[0]
    assert np.frombuffer(own, dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert seen == ["\nplain", " don't", " été", " x1", "\nline"]


def brute(pairs, plain):
    out, at = [], 0
    signed = lambda t: (xxhash.xxh64_intdigest((t or "").encode(), 42) ^ 1 << 63) - (1 << 63)
    for i, t in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, signed(p[1]))):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def test_read_back(spark, plain, tmp_path):
    table = tokens.shards(docs(spark, ODD, ODD_IDS), tokenizer_path(), VOCABULARY, shard=64)
    got = sorted(map(tuple, tokens.read_back(table).collect()), key=lambda r: r[1])
    assert got == brute(list(zip(ODD_IDS, ODD)), plain)
    tokens.dump(table, str(tmp_path))
    images = [tokens.Shard(p.read_bytes()) for p in sorted(tmp_path.iterdir())]
    assert sum(i.ids for i in images) == got[-1][1] + got[-1][2] and len(images) > 1


def test_special_tokens_as_the_library_has_them(spark, plain):
    text = "hello <|endoftext|> world"
    assert 50256 in plain.encode(text, add_special_tokens=False).ids
    got = tokens.read_back(tokens.shards(docs(spark, [text]), tokenizer_path(), VOCABULARY)).collect()
    assert [tuple(r) for r in got] == brute([(0, text)], plain)


def test_empty(spark):
    assert tokens.read_back(tokens.shards(spark.createDataFrame([], SCHEMA), tokenizer_path(), VOCABULARY)).count() == 0
