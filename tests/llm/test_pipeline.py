from __future__ import annotations

import public_tokenizers as public
import pytest
from test_fm_index import brute as leaks
from test_line_dedup import brute as deleted
from test_simhash import classes, fingerprint

import corpus_pipeline
from clinspark.llm import bpe, line_dedup


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_each_stage_equals_brute_force(spark, sf_dir, staging):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    outs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        outs.append(staging.table(stage(spark, outs[-1], sf_dir), name))
    assert all(df.schema == docs.schema for df in outs[1:-1])
    start, clean, lines, single, left, tokens = map(rows, outs)

    assert 0 < len(start) - len(clean) < 100 and set(clean) < set(start)

    gone = deleted([(i, r["text"]) for i, r in clean.items()], line_dedup.RARE, line_dedup.MIN_WORDS)
    want = {}
    for i, r in clean.items():
        text = "\n".join(x for n, x in enumerate(r["text"].split("\n")) if n not in gone.get(i, ()))
        if text.strip() or i not in gone:
            want[i] = text
    assert {i: r["text"] for i, r in lines.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for i, r in lines.items() if i in gone)

    prints = {i: fingerprint(r["text"]) for i, r in lines.items()}
    groups = classes(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for i in sorted(prints):
        first.setdefault(groups[prints[i]], i)
    assert set(single) == set(first.values())

    assert set(left) == set(single)
    for i, r in single.items():
        hit = leaks(r["text"], bench)[1] if i < 300 or left[i]["text"] != r["text"] else 0
        assert (left[i]["text"] != r["text"]) == (hit > 0)
        assert left[i]["n_chars"] == (len(left[i]["text"]) if hit else r["n_chars"])

    ranks = bpe.read_ranks(public.path("byte_bpe_50k.tiktoken"))
    decoder = bpe.Decoder(ranks)
    assert all(tokens[i]["text"] == r["text"] == decoder.decode(tokens[i]["tokens"]) for i, r in left.items())


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_edges(spark, sf_dir, edge_docs, no_docs, stage):
    found = stage(spark, edge_docs, sf_dir)
    got = found.collect()
    assert stage(spark, no_docs, sf_dir).collect() == []
    if stage is not corpus_pipeline.encode:
        assert found.columns == edge_docs.columns
    if stage is not corpus_pipeline.drop_near_duplicates:
        kept = {r["doc_id"] for r in got}
        assert {1, 3, 4, 5, 6, 8, 9, 10} <= kept
