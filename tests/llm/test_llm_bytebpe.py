"""The byte-level encoder against the tiktoken library."""

import base64
import hashlib
import time

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shoreline.llm import bytebpe

SF = "/root/testdata/sf0.001"
FILES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")


def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=FILES)
def both(request):
    codec = bytebpe.Codec(public_tokenizers.path(request.param), public_tokenizers.PATTERN)
    return codec, library(codec.ranks)


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_query_equals_library(spark):
    with open(public_tokenizers.path(FILES[0]), "rb") as f:
        own = library({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = own.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids)).encode()), sha(own.decode_bytes(ids))))
    got = entry.queries()["op13_byte_bpe"](spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=120), st.text(alphabet="ab ", max_size=300), st.text(alphabet="the -=\n\t's1²éä中\U0001f600", max_size=120)))
def test_random_texts(both, text):
    codec, own = both
    ids = codec.encode(text)
    assert ids == own.encode_ordinary(text) and codec.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=200))
def test_any_bytes(both, raw):
    """Bytes that are no UTF-8 too, by the plain rule: merge the lowest rank, leftmost first."""
    codec, _ = both
    parts = [raw[i:i + 1] for i in range(len(raw))]
    while len(parts) > 1:
        rank, i = min((codec.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    assert codec.encoder.encode(raw) == [codec.ranks[p] for p in parts]


def test_unreachable_tokens():
    """A listed token that no merges make stands only for a piece that equals it."""
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abcd": 257, b"cc": 258}
    enc, own = bytebpe.BacktrackEncoder(ranks), library(ranks)
    for text in ("abcd", "abcde", "abcdabcd", "cabcd", "ccc", "ccabcc", "cccccab"):
        assert enc.encode(text.encode()) == own.encode_ordinary(text), text
    with pytest.raises(ValueError):
        bytebpe.BacktrackEncoder({b"a": 0})


def test_classes_follow_the_library():
    """Every code point is cut as the library cuts it, in and out of Latin-1."""
    single = {bytes([i]): i for i in range(256)}
    cut = bytebpe.Splitter(public_tokenizers.PATTERN)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    own = tiktoken.Encoding("c", pat_str=public_tokenizers.PATTERN, mergeable_ranks=single, special_tokens={})
    shown = every.translate(cut.swaps)
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        asked = tiktoken.Encoding("c", pat_str=name, mergeable_ranks=single, special_tokens={})
        theirs = set(bytes(asked.encode_ordinary(every)).decode())
        assert {a for a, b in zip(every, shown) if regex.match(name, b)} == theirs, name
    latin = every[:256]
    assert cut.latin.findall(latin) == [m.group() for m in cut.general.finditer(latin.translate(cut.swaps))]
    assert bytes(own.encode_ordinary(every)) == "".join(cut.split(every)).encode()


@pytest.mark.parametrize("text", [" " * 2_000_000 + "a", "\n" * 2_000_000, "a" * 2_000_000, "中" * 2_000_000, "ab" * 1_000_000 + "!"])
def test_very_long(both, text):
    codec, _ = both
    began = time.time()
    ids = codec.encode(text)
    assert codec.decode(ids) == text.encode() and time.time() - began < 60
    assert text not in codec.known


@pytest.mark.parametrize("text", ["a" * 3000, " " * 3000 + "x", "\n" * 3000, "ab" * 1500, "-" * 3000 + "=" * 3000])
def test_long_runs_equal_library(both, text):
    codec, own = both
    assert codec.encode(text) == own.encode_ordinary(text)


def test_memory_is_bounded(both, monkeypatch):
    codec, own = both
    monkeypatch.setattr(bytebpe, "REMEMBERED", 5)
    monkeypatch.setattr(bytebpe, "PAIRS", 5)
    for k in range(40):
        text = f"unheard{k} wordings{k * 7} xyzzy{k}"
        assert codec.encode(text) == own.encode_ordinary(text)
        assert len(codec.known) < 20 and len(codec.encoder.pairs) < 10


def test_rows(spark):
    rows = [(1, "same"), (1, "same"), (None, None), (2, ""), (3, None), (None, " \t\n\x0b ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(0) for c in ("id", "n_tokens", "ids", "a.b")})
    path = public_tokenizers.path(FILES[0])
    out = bytebpe.encode_documents(df, path, with_ids=True)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    got = sorted(((r.doc_id, r.n_tokens, len(r.ids), bytes(r.decoded).decode()) for r in out.collect()), key=str)
    assert got == sorted([(1, 1, 1, "same")] * 2 + [(None, 0, 0, ""), (2, 0, 0, ""), (3, 0, 0, ""), (None, 5, 5, " \t\n\x0b ")], key=str)
    assert bytebpe.encode_documents(df.limit(0), path).count() == 0
