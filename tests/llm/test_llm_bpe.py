from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import awkward, empty, with_clashes

from tidemark.llm import bpe
from tidemark.llm.queries import QUERIES, rank_file

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(*rank_file(), bpe.newer_characters())


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=rank_file()[1], mergeable_ranks=encoder.ranks.rank, special_tokens={})


@pytest.fixture(scope="module")
def check(encoder, library):
    def same(text):
        ids = encoder.encode([text.encode()])[0]
        assert ids.tolist() == library.encode_ordinary(text)
        assert bpe.decoded(ids, rank_file()[0]) == text.encode()

    return same


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(st.text(st.characters(exclude_categories=["Cs"])), st.text("ab \n'tsé1", max_size=300), st.text("ABCabc", min_size=60, max_size=200)))
def test_any_text_is_encoded_as_by_the_library(check, text):
    check(text)


def test_letters_the_library_does_not_know_yet(check):
    check("a\U00010940b ࢏3 \U00010ee7 c" + bpe.newer_characters())


@pytest.mark.parametrize("piece", ["=" * 5000, "ab" * 3000, "x" * 63, "x" * 64, "x" * 65, "é" * 700, " " * 4000 + "x", "\n" * 900])
def test_long_pieces(check, piece):
    check(piece)


def test_both_trees_agree(encoder):
    draw = np.random.default_rng(2)
    pieces = [bytes(draw.integers(97, 105, n, dtype=np.uint8)) for n in range(2, 65) for _ in range(20)]
    for width in (2, 4, 8, 16, 32, 64):
        own = [p for p in pieces if len(p) <= width]
        assert [x.tolist() for x in bpe.merge_short(own, encoder.ranks, width)] == [bpe.merge_long(p, encoder.ranks) for p in own]


def test_the_held_pieces_are_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "HELD_PIECES", 10)
    for start in range(5):
        text = " ".join(f"q{start}z{i}" for i in range(30))
        assert encoder.encode([text.encode(), None, b""])[0].tolist() == library.encode_ordinary(text)


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return len(ids), digest(np.array(ids, "<u4").tobytes()), digest((text or "").encode())


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in QUERIES["op8_byte_level_bpe"](spark, SF).collect()}
    assert got == {(r["doc_id"], *expected(library, r["text"])) for r in docs}


def test_awkward_rows(spark, library):
    ranks, pattern = rank_file()
    docs = with_clashes(awkward(spark))
    out = bpe.decode(bpe.encode(docs, ranks, pattern, unassigned=bpe.newer_characters()), ranks)
    rows = out.collect()
    assert len(rows) == docs.count() and set(out.columns) == set(docs.columns)
    for r in rows:
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(r["text"] or "")
    assert sorted(map(str, bpe.round_trip(docs, ranks, pattern, unassigned=bpe.newer_characters()).select(out.columns).collect())) == sorted(map(str, rows))
    assert bpe.encode(empty(spark), ranks, pattern).count() == 0


def test_an_id_without_a_token_is_an_error():
    with pytest.raises(KeyError):
        bpe.decoded(np.array([60000], np.uint32), rank_file()[0])


def test_a_rank_file_needs_every_byte():
    with pytest.raises(ValueError):
        bpe.Ranks(b"YQ== 0\n")


def test_a_long_piece_costs_few_bytes_a_byte():
    """One piece without a break against the library, and the memory that its arrays take."""
    ranks, pattern = rank_file()
    known = bpe.Ranks(ranks)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=known.rank, special_tokens={})
    draw = random.Random(3)
    for n in (1, 2, 3, 5, 8, 65, 1000, 4097):
        piece = "".join(draw.choice("abcdefghei") for _ in range(n))
        assert bpe.merge_long(piece.encode(), known) == library.encode_ordinary(piece)
    piece = "".join(draw.choice("abcdefghei") for _ in range(400_000)).encode()
    tracemalloc.start()
    ids = bpe.merge_long(piece, known)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert b"".join(bpe._tokens(ranks)[i] for i in ids) == piece
    assert most < 60 * len(piece) + (32 << 20)
