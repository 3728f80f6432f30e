"""Token files against the tokenizer library, document by document."""

from __future__ import annotations

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from clinspark.llm import token_files
from clinspark.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
END = 2


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder(spark):
    return token_files.word_encoder(spark, PATH)


def ids_of(library, text: str | None) -> list[int]:
    return [*library.encode(text or "", add_special_tokens=False).ids, END]


def test_query(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    rows = {r["doc_id"]: r for r in QUERIES["op12_token_files"](spark, sf_dir).collect()}
    start = 0
    assert len(rows) == len(docs)
    for d in docs:
        ids, row = ids_of(library, d["text"]), rows[d["doc_id"]]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_words_alone_and_in_texts(encoder, library):
    signs = ["a", "B", "é", "É", "ß", "ẞ", "İ", "Σ", "σ", "ς", "'s", "'LL", "'", "1", "²", "½", " ", "  ", "\n", "\t", " ",
             " ", "　", "\x85", "\x1c", "́", "é", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "中", "ﬁ", "\U0001f600",
             ".", ",", "...", "​", "\x00", "word", "Ångström", "K", "Ω", "×", "÷"]
    rng = random.Random(3)
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(3000)] + [None, "", " "]
    ids, counts = encoder()(pa.array(texts, pa.string()))
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_a_small_memory_forgets_and_still_encodes(library):
    from clinspark.llm.pieces import Memo, flat

    memo = Memo(lambda texts: flat([library.encode(t, add_special_tokens=False).ids for t in texts]), limit=5)
    for words in (["one", "two", "one"], ["three", "four", "five", "six"], ["one"], [], [f"w{i}" for i in range(20)]):
        ids, counts = memo(pa.array(words, pa.string()))
        assert ids.tolist() == [i for w in words for i in library.encode(w, add_special_tokens=False).ids]
        assert len(counts) == len(words)


@pytest.mark.parametrize("texts", [[], [""], [None], ["", None, ""], [" "], [None, " \n", ""]])
def test_texts_without_words(encoder, texts):
    ids, counts = encoder()(pa.array(texts, pa.string()))
    assert ids.tolist() == [] and counts.tolist() == [0] * len(texts)


def test_plain_runs_are_not_normalized_and_cut_again(library):
    own = token_files.WordEncoder(open(PATH, encoding="utf-8").read())
    texts = ["Ångström's naïve façade, ÀÉÍÕÜ ßþÿ ÷× don't", "plain WORDS 1234 'll ... x's"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    given, whole = [], own.tokenizer

    class Watched:
        def encode_batch_fast(self, some, **options):
            given.extend(some)
            return whole.encode_batch_fast(some, **options)

    own.tokenizer = Watched()
    ids, counts = own(pa.array(texts, pa.string()))
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]
    assert given == ["÷×"]


def test_known_pieces_cost_less_than_a_scalar_each():
    from clinspark.llm.pieces import Memo

    words = pa.array([f"word{i:x}" for i in range(100_000)])
    memo = Memo(lambda texts: (np.arange(len(texts), dtype=np.int32), np.ones(len(texts), np.int64)), limit=300_000)
    memo(words)

    def least(work) -> float:
        times = []
        for _ in range(5):
            start = time.process_time()
            work()
            times.append(time.process_time() - start)
        return min(times)

    assert least(lambda: memo(words)) < least(words.to_pylist)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files(spark, staging, sf_dir, encoder, encoding):
    path = staging.path("tokens")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    token_files.write_tokens(
        docs.repartition(7), path, encoder, encoding=encoding, row_group_bytes=1 << 16, page_bytes=1 << 12, page_rows=20,
        partitions=3)
    files = sorted(pq.ParquetDataset(path).files)
    assert len(files) == 3
    groups = last = -1
    for file in files:
        meta = pq.ParquetFile(file).metadata
        groups = max(groups, meta.num_row_groups)
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i) for i in range(meta.num_columns)}
            tokens = columns["tokens.list.element"]
            assert ("DELTA_BINARY_PACKED" in tokens.encodings) == (encoding == "delta")
            assert any("DICTIONARY" in e for e in tokens.encodings) == (encoding == "dictionary")
            for name in ("doc_id", "first", "n_tokens"):
                assert "DELTA_BINARY_PACKED" in columns[name].encodings and columns[name].has_offset_index
            assert tokens.has_offset_index and tokens.has_column_index
            assert columns["doc_id"].statistics.min > last
            last = columns["doc_id"].statistics.max
    assert groups > 1
    stored = token_files.TokenFiles(spark, path)
    rows = stored.documents().orderBy("doc_id").collect()
    stream = [i for r in rows for i in r["tokens"]]
    assert stored.n_tokens == len(stream) and [r["lang"] for r in rows] == [
        r["lang"] for r in docs.orderBy("doc_id").collect()]
    some = stored.between(100, 120).orderBy("doc_id").collect()
    assert [tuple(r) for r in some] == [tuple(r) for r in rows if 100 <= r["doc_id"] <= 120]
    for begin, end in ((0, 5), (1000, 1001), (len(stream) // 2, len(stream) // 2 + 9000), (len(stream) - 3, len(stream) + 50), (0, len(stream))):
        cut = stored.span(begin, end).orderBy("start").collect()
        assert [i for r in cut for i in r["tokens"]] == stream[begin:end]
        assert all(r["n_tokens"] == len(r["tokens"]) for r in cut) and cut[0]["start"] == begin
    assert stored.span(len(stream), len(stream) + 5).count() == 0


def test_reads_only_what_is_asked_for(spark, staging, sf_dir, encoder):
    from helpers import plan

    path = staging.path("tokens")
    token_files.write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, encoder)
    stored = token_files.TokenFiles(spark, path)
    assert "tokens" not in plan(stored.documents(tokens=False)).split("ReadSchema")[1].split("\n")[0].replace("n_tokens", "")
    assert "GreaterThanOrEqual(doc_id,5)" in plan(stored.between(5, 9))


def test_edges(spark, staging, edge_docs, no_docs, encoder, library):
    path = staging.path("edges")
    docs = edge_docs.withColumnRenamed("source", "start").withColumnRenamed("lang", "part")
    token_files.write_tokens(docs, path, encoder)
    rows = token_files.TokenFiles(spark, path).documents().orderBy("start").collect()
    texts = {(r["doc_id"], r["n_chars"]): r["text"] for r in docs.collect()}
    start = 0
    assert [r["doc_id"] for r in rows] == sorted([r["doc_id"] for r in docs.collect()], key=lambda i: (i is not None, i or 0))
    for r in rows:
        assert r["tokens"] == ids_of(library, texts[r["doc_id"], r["n_chars"]])
        assert r["start"] == start
        start += r["n_tokens"]
    none = staging.path("none")
    token_files.write_tokens(no_docs, none, encoder)
    empty = token_files.TokenFiles(spark, none)
    assert empty.documents().count() == 0 and empty.span(0, 10).count() == 0
    assert token_files.with_checksum(empty.documents(), "crc").count() == 0
    with pytest.raises(ValueError):
        token_files.write_tokens(no_docs, none, encoder, encoding="other")


def test_a_hot_id_fills_several_files(spark, staging, encoder):
    docs = spark.range(4000).selectExpr("if(id % 3 = 0, 7L, id) as doc_id", "concat('text ', id % 50) as text")
    path = staging.path("hot")
    token_files.write_tokens(docs, path, encoder, partitions=8)
    rows = spark.read.parquet(path)
    assert rows.where("doc_id = 7").select("part").distinct().count() > 1
    assert rows.groupBy("part").count().agg({"count": "max"}).first()[0] < 1500
