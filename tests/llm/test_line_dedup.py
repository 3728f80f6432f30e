from __future__ import annotations

import random
import time

import pytest

from clinspark.llm import line_dedup
from clinspark.llm.queries import QUERIES


def align(a, b):
    """Patience alignment, written plainly: equal ends, anchors that are unique in both, ranges between them."""
    if not a or not b:
        return []
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = [(i, i) for i in range(head)] + [(len(a) - 1 - i, len(b) - 1 - i) for i in range(tail)]
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    if not x or not y:
        return sorted(found)
    once = [(x.index(v), y.index(v)) for v in x if x.count(v) == 1 and y.count(v) == 1]
    anchors = line_dedup.longest_rising(once)
    if anchors:
        edges = [(-1, -1), *anchors, (len(x), len(y))]
        found += [(head + i, head + j) for i, j in anchors]
        for (i, j), (k, m) in zip(edges, edges[1:]):
            found += [(head + i + 1 + p, head + j + 1 + q) for p, q in align(x[i + 1:k], y[j + 1:m])]
    return sorted(found)


def brute(docs, rare, least):
    """Deleted line numbers of each document, from all documents at once."""
    lines = {i: [(n, t.strip()) for n, t in enumerate((text or "").split("\n")) if t.strip()] for i, text in docs}
    holders = {}
    for i in sorted(lines):
        for place, (_, t) in enumerate(lines[i]):
            holders.setdefault(t, {}).setdefault(i, place)
    out = {}
    for i, own in lines.items():
        gone = set()
        partners = {min(holders[t]) for _, t in own if 1 < len(holders[t]) <= rare} - {i}
        for p in partners:
            pairs = align([t for _, t in lines[p]], [t for _, t in own])
            blocks, block = [], []
            for at, pair in enumerate(pairs):
                if at and (pair[0] - 1, pair[1] - 1) != pairs[at - 1]:
                    blocks.append(block)
                    block = []
                block.append(pair[1])
            for b in [*blocks, block]:
                if sum(len(own[j][1].split()) for j in b) >= least:
                    gone |= {own[j][0] for j in b}
        common = {}
        for place, (n, t) in enumerate(own):
            if len(holders[t]) > rare and min(holders[t]) != i:
                first = min(holders[t])
                common.setdefault((first, place - holders[t][first]), []).append((place, n, len(t.split())))
        for run in common.values():
            for at, (place, _, _) in enumerate(run):
                lo = hi = at
                while lo and run[lo - 1][0] == run[lo][0] - 1:
                    lo -= 1
                while hi + 1 < len(run) and run[hi + 1][0] == run[hi][0] + 1:
                    hi += 1
                if sum(w for _, _, w in run[lo:hi + 1]) >= least:
                    gone.add(run[at][1])
        if gone:
            out[i] = sorted(gone)
    return out


@pytest.mark.parametrize("seed", range(50))
def test_longest_rising(seed):
    source = random.Random(seed)
    pairs = list(enumerate(source.sample(range(30), source.randrange(12))))
    best = [1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        best[n] = 1 + max((best[m] for m in range(n) if pairs[m][1] < j), default=0)
    found = line_dedup.longest_rising(pairs)
    assert len(found) == max(best, default=0) and set(found) <= set(pairs)
    assert all(a < b and x < y for (a, x), (b, y) in zip(found, found[1:]))


@pytest.mark.parametrize("seed", range(300))
def test_patience(seed):
    source = random.Random(seed)
    a = [source.randrange(12) for _ in range(source.randrange(14))]
    b = [source.randrange(12) for _ in range(source.randrange(14))]
    if seed % 2:
        b = a[:3] + [99] + a[2:]
    assert line_dedup.patience(a, b) == align(a, b)


@pytest.mark.parametrize("rare", [2, 4, 50])
def test_against_brute_force(spark, staging, rare):
    source = random.Random(rare)
    pool = [" ".join(f"w{source.randrange(500)}" for _ in range(source.choice([1, 3, 8, 25]))) for _ in range(40)]
    blocks = [[source.choice(pool) for _ in range(4)] for _ in range(6)]
    docs = []
    for i in range(60):
        own = [f"unique {i} {n} line of this document" for n in range(3)]
        for _ in range(source.randrange(3)):
            at = source.randrange(len(own) + 1)
            own[at:at] = source.choice(blocks)
        docs.append((i, "\n".join(source.choice(["", " "]) + line for line in own) + source.choice(["", "\n\n"])))
    docs += [(100 + i, docs[5][1]) for i in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = line_dedup.deleted_lines(df, staging, rare=rare, min_words=10).collect()
    assert {r["doc_id"]: r["deleted"] for r in found} == brute(docs, rare, 10)
    texts = dict(docs)
    for r in found:
        lines = texts[r["doc_id"]].split("\n")
        assert r["words_deleted"] == sum(len(lines[n].split()) for n in r["deleted"])
    left = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df, staging, rare=rare, min_words=10).collect()}
    gone = {r["doc_id"]: set(r["deleted"]) for r in found}
    assert left == {i: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(i, ())) for i, t in docs}


def repeated(docs, least):
    """Lines in any run of neighbouring lines with enough words that any earlier document has, by trying all runs."""
    lines = {i: [(n, t.strip()) for n, t in enumerate((text or "").split("\n")) if t.strip()] for i, text in docs}
    held, out = set(), {}
    for i in sorted(lines):
        own, gone, runs = lines[i], set(), set()
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                run = tuple(t for _, t in own[a:b])
                if sum(len(t.split()) for t in run) >= least:
                    runs.add(run)
                    if run in held:
                        gone |= {n for n, _ in own[a:b]}
        held |= runs
        if gone:
            out[i] = sorted(gone)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_blocks_of_all_earlier_documents(spark, staging, seed):
    """Lines that stood alone before, blocks of common and rare lines, and lines that a holder has twice."""
    source = random.Random(seed)
    pool = [" ".join(f"w{source.randrange(500)}" for _ in range(source.choice([1, 3, 8, 12]))) for _ in range(12)]
    docs = [(i, "\n".join(source.choice(pool) for _ in range(source.randrange(9)))) for i in range(60)]
    a, b, c = (f"line {x} of eight words that stand here" for x in "abc")
    docs += [(100, f"{a}\nother 1"), (101, f"{b}\nother 2"), (102, f"{c}\nother 3"), (103, f"x\n{a}\n{b}\n{c}"),
             (104, f"{a}\n\n{b}\n {c}\ny")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r["doc_id"]: r["deleted"] for r in line_dedup.deleted_lines(df, staging, rare=5).collect()}
    assert found == repeated(docs, line_dedup.MIN_WORDS) and found[104] == [0, 2, 3]


def test_lines_go_by_alignment_only(spark, staging, monkeypatch):
    """What runs name is deleted because it is aligned: in order, moved, or repeated."""
    source = random.Random(1)
    a, b, c = ([" ".join(f"w{source.randrange(900)}" for _ in range(9)) for _ in range(3)] for _ in range(3))
    docs = [(1, [*a, "one", *b, "two", *c]), (2, [*c, "three", *b, "four", *a]), (3, [*b, *b, "five", *a])]
    docs = [(i, "\n".join(lines)) for i, lines in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for rare in (0, line_dedup.RARE):
        found = {r["doc_id"]: r["deleted"] for r in line_dedup.deleted_lines(df, staging, rare=rare).collect()}
        assert found == repeated(docs, line_dedup.MIN_WORDS)
        assert found == {2: [0, 1, 2, 4, 5, 6, 8, 9, 10], 3: [0, 1, 2, 3, 4, 5, 7, 8, 9]}
    keys, words, _ = line_dedup.line_keys(docs[2][1])
    firsts = {run: at for run, at, _ in reversed(line_dedup.shortest_runs(line_dedup.line_keys(docs[0][1])[0], [9] * 3 + [1] + [9] * 3 + [1] + [9] * 3, 20))}
    hits = [(1, firsts[run], start, stop) for run, start, stop in line_dedup.shortest_runs(keys, words, 20) if run in firsts]
    assert sorted(line_dedup.align_runs(hits, keys, words, 20)) == found[3]
    monkeypatch.setattr(line_dedup, "patience", lambda a, b: [])
    assert line_dedup.align_runs(hits, keys, words, 20) == set()


@pytest.mark.parametrize("line", ["{} of seven words that stand in line", "the same seven words again and again"])
def test_very_long_copies(spark, staging, line):
    text = "\n".join(line.format(n) for n in range(100_000))
    df = spark.createDataFrame([(1, text), (2, text + "\nend")], "doc_id long, text string")
    start = time.monotonic()
    assert [r["text"] for r in line_dedup.dedup_lines(df, staging).orderBy("doc_id").collect()] == [text, "end"]
    assert time.monotonic() - start < 60


def test_edges(spark, staging, edge_docs, no_docs):
    found = line_dedup.dedup_lines(edge_docs, staging, min_words=5, report="deleted")
    assert found.columns.count("deleted") == 1
    rows = found.collect()
    assert len(rows) == edge_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["deleted"] is None and by[2]["text"] == "" and by[2]["deleted"]["deleted"] == [0, 1]
    assert by[3]["text"] is None and by[4]["text"] == "" and by[10]["deleted"] is None
    assert line_dedup.dedup_lines(no_docs, staging).collect() == []


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = brute(docs, line_dedup.RARE, line_dedup.MIN_WORDS)
    found = {r["doc_id"]: r["n_deleted"] for r in QUERIES["op6_patience_lines"](spark, sf_dir).collect()}
    assert want and found == {i: len(want.get(i, [])) for i, _ in docs}
