from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from clinspark.llm import bpe
from clinspark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def machines(ranks):
    return bpe.Encoder(ranks, public.PATTERN), bpe.Decoder(ranks)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(text=st.text() | st.text(alphabet="aes th=' \n1é中", max_size=200))
def test_equals_library_and_round_trip(machines, library, text):
    encoder, decoder = machines
    packed = encoder.encode(text)
    assert ids(packed) == library.encode_ordinary(text)
    assert decoder.decode(packed) == text
    assert "".join(decoder.stream(ids(packed))) == text


@pytest.mark.parametrize("text", ["a" * 30_000, "=" * 9_001, "ab" * 9_000, " " * 5_000, "thethe" * 4_000, "é" * 9_999])
def test_long_pieces_leave_before_their_end(machines, library, text):
    encoder, _ = machines
    assert ids(encoder.encode(text)) == library.encode_ordinary(text)


def test_forgetting_changes_nothing(ranks, library):
    machine = bpe.Encoder(ranks, public.PATTERN)
    machine.fst.max_states = 50
    text = "The transducer starts anew when it has too many states; nothing else changes. " * 5
    assert ids(machine.encode(text)) == library.encode_ordinary(text)


def test_incomplete_characters(machines):
    _, decoder = machines
    euro = "€".encode()
    numbers = {token: rank for rank, token in decoder.token_bytes.items()}
    parts = [numbers[bytes([b])] for b in euro]
    assert list(decoder.stream(parts)) == ["", "", "€"]
    assert "".join(decoder.stream(parts[:2])) == "�"


def test_edges(spark, edge_docs, no_docs, ranks):
    found = bpe.bpe_round_trip(edge_docs, ranks, public.PATTERN)
    assert found.columns.count("tokens") == 1 and found.schema["tokens"].dataType.typeName() == "binary"
    rows = found.collect()
    assert len(rows) == edge_docs.count()
    assert all(r["decoded"] == (r["text"] or "") for r in rows)
    assert bpe.bpe_round_trip(no_docs, ranks, public.PATTERN).collect() == []
    apart = bpe.bpe_decode(bpe.bpe_encode(edge_docs, ranks, public.PATTERN), ranks)
    assert sorted(map(str, apart.collect())) == sorted(map(str, found.select(apart.columns).collect()))
    over = bpe.bpe_encode(edge_docs.select("doc_id", "text"), ranks, public.PATTERN, out="text")
    assert over.columns == ["doc_id", "text"]


def test_query(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op8_bpe_round_trip"](spark, sf_dir).collect():
        want = np.array(library.encode_ordinary(texts[r["doc_id"]]), "<u4").tobytes()
        assert (r["n_tokens"], r["ids_sha256"]) == (len(want) // 4, hashlib.sha256(want).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
