from __future__ import annotations

import hashlib

import numpy as np
import pytest
import regex

from clinspark.llm import fm_index
from clinspark.llm.queries import QUERIES

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=10):
    own = words(text)
    hit, found = [False] * len(own), set()
    for item, item_text in items:
        w = words(item_text)
        for at in range(max(1, len(w) - window + 1) if w else 0):
            phrase = w[at:at + window]
            for i in range(len(own) - len(phrase) + 1):
                if own[i:i + len(phrase)] == phrase:
                    hit[i:i + len(phrase)] = [True] * len(phrase)
                    found.add(item)
    return len(own), sum(hit), sorted(i for i in found if i is not None)


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array_and_index(seed):
    random = np.random.default_rng(seed)
    text = np.append(random.integers(1, 2 + seed, 700), 0)
    order = fm_index.suffix_array(text)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    index = fm_index.FMIndex(text, 8)
    for length in (1, 2, 5):
        patterns = random.integers(1, 3 + seed, (20, length))
        low, high = index.search(patterns)
        for pattern, a, b in zip(patterns, low, high):
            want = [i for i in range(len(text) - length + 1) if (text[i:i + length] == pattern).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_against_brute_force(spark):
    items = [("7", "One two three four five six seven eight nine ten eleven twelve"), ("10", "short Item"), ("3", ""),
             ("4", None), (None, "words of a nameless item"), ("7", "short item"), ("b", "é 中文 x")]
    texts = [
        "x one Two three, four five six seven eight nine ten! eleven twelve y", "a short item and a short item", None, "",
        "short\nitem", "one two three four five six seven eight nine", "words of a nameless item", "Short", "É 中文 x é 中文 X",
        "one two three four five six seven eight nine ten " * 40, "shortitem short", "item short item",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    for options in ({}, {"shard_words": 20}, {"block_chars": 30}):
        rows = {r["doc_id"]: r["leak"] for r in fm_index.find_leaks(docs, bench, **options).collect()}
        for i, text in enumerate(texts):
            leak = rows[i]
            assert (leak["n_words"], leak["n_hit"], leak["items"]) == brute(text, items), (text, options)
            if leak["n_hit"]:
                kept = leak["clean"]
                assert len(kept) == len(text) - sum(s["stop"] - s["start"] for s in leak["spans"])
                assert all(words(text[s["start"]:s["stop"]]) for s in leak["spans"])
            else:
                assert leak["clean"] is None


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "a second line"), (None, None)], "item_id long, text string")
    found = fm_index.find_leaks(edge_docs.withColumnRenamed("deleted", "leak"), bench)
    assert found.columns.count("leak") == 1
    rows = found.collect()
    assert len(rows) == edge_docs.count() and sum(r["leak"]["n_hit"] for r in rows) == 9
    assert fm_index.find_leaks(no_docs, bench).collect() == []
    none = fm_index.find_leaks(edge_docs, bench.where("false")).collect()
    assert all(r["leak"]["n_hit"] == 0 for r in none)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60 or doc_id % 37 = 0").collect()
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = {r["doc_id"]: r for r in QUERIES["op3_fm_index"](spark, sf_dir).collect()}
    assert any(r["contaminated"] for r in found.values())
    for doc in docs:
        n, hit, own = brute(doc["text"], items)
        r = found[doc["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(own), hit > 0)
        assert r["items_sha256"] == hashlib.sha256(",".join(own).encode()).hexdigest()
