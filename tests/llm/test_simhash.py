from __future__ import annotations

import random
import re

import pytest
import xxhash

from clinspark.llm import simhash
from clinspark.llm.common import components
from clinspark.llm.queries import QUERIES
from clinspark.staging import Staging


def fingerprint(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not own:
        return 0
    runs = [" ".join(own[i:i + 3]) for i in range(max(1, len(own) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(values, near):
    """Smallest member of each value's component, by comparing all pairs."""
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    values = sorted(values)
    for i, a in enumerate(values):
        for b in values[:i]:
            if near(a, b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {v: root(v) for v in values}


@pytest.mark.parametrize("shard", [simhash.SHARD, 4])
def test_links_equal_all_pairs(spark, staging, shard):
    source = random.Random(3)
    values = {source.getrandbits(64) for _ in range(150)}
    for centre in list(values)[:5]:
        for _ in range(60):
            near = centre
            for _ in range(source.randint(1, 6)):
                near ^= 1 << source.randrange(64)
            values.add(near)
    want = classes(values, lambda a, b: (a ^ b).bit_count() <= 2)
    rows = spark.createDataFrame([(simhash.signed(v),) for v in values], "fingerprint long")
    links = simhash.fingerprint_links(rows, staging, shard=shard).collect()
    mask = (1 << 64) - 1
    assert all(((r["a"] ^ r["b"]) & mask).bit_count() <= 2 * 64 for r in links)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for r in links:
        parent[root(r["a"] & mask)] = root(r["b"] & mask)
    groups = {}
    for v in values:
        groups.setdefault(root(v), set()).add(v)
    assert {frozenset(g) for g in groups.values()} == {
        frozenset(v for v in values if want[v] == r) for r in set(want.values())}


def test_components_of_chains_and_stars(spark, staging):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (300, 200), (200, 300)]
    found = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), staging).collect()}
    assert found == {**{i: 1 for i in range(2, 41)}, **{i: 100 for i in range(101, 160)}, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long"), staging).collect() == []


def test_edges(spark, staging, edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs, staging).collect()
    assert len(rows) == edge_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["component_id"] == by[2]["component_id"] == 1
    assert by[3]["component_id"] == by[4]["component_id"] == by[5]["component_id"] == 3 and by[3]["fingerprint"] == 0
    assert simhash.near_duplicates(no_docs, staging).collect() == []
    kept = simhash.drop_near_duplicates(edge_docs, staging)
    assert kept.columns == edge_docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids[:2] == [1, 1] and not {2, 4, 5} & set(ids)


def test_query(spark, sf_dir):
    rows = QUERIES["op1_bk_trees"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    own = {i: fingerprint(t) for i, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{v:016x}" for i, v in own.items()}
    groups = classes(set(own.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for i in sorted(own):
        first.setdefault(groups[own[i]], i)
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: first[groups[v]] for i, v in own.items()}
