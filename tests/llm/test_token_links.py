"""Alignment of two tokenizers against the libraries and a plain count of overlaps."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clinspark.llm import token_links
from clinspark.llm.queries import QUERIES

LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(LEVEL)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        self.letters = {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}

    def tokens(self, text):
        """Ids and bytes of both sides, or None."""
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        bytes_a = [bytes(self.letters[c] for c in self.a.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in zip(b, map(self.b.id_to_piece, b))]
        whole = (" " + text).encode()
        return (a, b, bytes_a, bytes_b) if b"".join(bytes_a) == whole == b"".join(bytes_b) else None

    def spans(self, parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return list(zip([0, *ends], ends))

    def document(self, text):
        found = self.tokens(text)
        if not found:
            return 0, 0, 0, "", Counter()
        a, b, bytes_a, bytes_b = found
        sa, sb = self.spans(bytes_a), self.spans(bytes_b)
        links, j = Counter(), 0
        for i, (s, e) in enumerate(sa):
            while sb[j][1] <= s:
                j += 1
            k = j
            while k < len(sb) and sb[k][0] < e:
                links[a[i], b[k]] += 1
                k += 1
        common = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, i, j = [], 0, 0
        for end in common:
            x, y = [], []
            while i < len(sa) and sa[i][1] <= end:
                x.append(str(a[i]))
                i += 1
            while j < len(sb) and sb[j][1] <= end:
                y.append(str(b[j]))
                j += 1
            groups.append(",".join(x) + "|" + ",".join(y))
        return len(a), len(b), len(groups), ";".join(groups), links

    def corpus(self, texts):
        found = [self.document(t) for t in texts]
        counts = Counter(p for *_, links in found for p in links)
        most = Counter()
        for (a, _), n in counts.items():
            most[a] = max(most[a], n)
        rows = []
        for n_a, n_b, n_groups, groups, links in found:
            best = sum(n for p, n in links.items() if counts[p] == most[p[0]])
            total = sum(n * counts[p] for p, n in links.items())
            rows.append((n_a, n_b, n_groups, sum(links.values()), best, total, groups))
        return rows, counts


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def encoders(spark):
    return token_links.encoders(spark, LEVEL, PIECES)


def aligned(docs, encoders, staging, key="doc_id"):
    found = token_links.align(docs, encoders, staging)
    rows = found.with_contributions(found.documents).collect()
    return [(r[key], (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"])) for r in rows], found


def test_query(spark, sf_dir, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want, _ = plain.corpus([d["text"] for d in docs])
    rows = {r["doc_id"]: r for r in QUERIES["op11_spilled_links"](spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    for d, (*numbers, groups) in zip(docs, want):
        r = rows[d["doc_id"]]
        assert [r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] == numbers
        assert r["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def strange_texts(n, seed):
    signs = ["a", "word", "Wörter", "é", "é", "ﬁ", " ", "  ", "   ", "\n", "\t", "\r\n", "\xa0", " ", "　", "\x85", " ",
             "'s", "'", "12", "½", "<|endoftext|>", "<s>", "<unk>", "<0x41>", "▁", "中文", "\U0001f600", ".", "...", "​", "\x00", "x" * 20]
    rng = random.Random(seed)
    return ["".join(rng.choices(signs, weights=[6, 6, 2, 2] + [1] * 2 + [9, 2] + [1] * 25, k=rng.randint(1, 25))) for _ in range(n)]


def test_strange_texts(spark, staging, plain, encoders):
    texts = strange_texts(1500, 4) + [" ", "  ", "\n", " a", "a ", " a ", "a  b", "  a  ", None, "", "▁", "a ▁b"]
    want, counts = plain.corpus(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got, found = aligned(docs, encoders, staging)
    assert sorted(got) == list(enumerate(want))
    assert {(r["a"], r["b"]): r["n_docs"] for r in found.pairs.collect()} == counts


def test_slices_and_salts_change_nothing(spark, staging, plain, encoders, monkeypatch):
    monkeypatch.setattr(token_links, "SALT_BYTES", 200)
    texts = strange_texts(300, 5) + ["the same hot words " * 3] * 300
    want, _ = plain.corpus(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(16)
    got, _ = aligned(docs, encoders, staging)
    assert sorted(got) == list(enumerate(want))


def test_edges(staging, edge_docs, no_docs, plain, encoders):
    docs = edge_docs.withColumnRenamed("source", "n_a").withColumnRenamed("lang", "groups")
    texts = [r["text"] for r in docs.collect()]
    want, _ = plain.corpus(texts)
    got, _ = aligned(docs, encoders, staging)
    ids = [r["doc_id"] for r in docs.collect()]
    assert sorted(got, key=str) == sorted(zip(ids, want), key=str)
    assert aligned(no_docs, encoders, staging)[0] == []


def test_runs_and_merge():
    rng = np.random.default_rng(1)
    total, blocks = Counter(), {r: [] for r in range(token_links.RADIXES)}
    for _ in range(5):
        docs, a, b = rng.integers(0, 50, 40_000), rng.integers(0, 300, 40_000) ** 2 % 50_000, rng.integers(0, 400, 40_000)
        total.update((x, y) for _, x, y in {*zip(docs.tolist(), a.tolist(), b.tolist())})
        back = Counter()
        for radix, pairs, documents in token_links.runs_of(docs, a, b):
            blocks[radix].append(pairs)
            (steps, n), (moves, times) = token_links.unpack(pairs), token_links.unpack(documents)
            x, y = token_links._pair(radix, np.repeat(np.cumsum(steps.astype(np.int64)), n))
            at = 0
            for i, count in enumerate(n.tolist()):
                for d, t in zip(np.cumsum(moves[at:at + count]).tolist(), times[at:at + count].tolist()):
                    back[d, int(x[at]), int(y[at])] += t
                at += count
        assert back == Counter(zip(docs.tolist(), a.tolist(), b.tolist()))
    got = Counter()
    for radix, own in blocks.items():
        last = -1
        for pairs, counts in token_links.merged(own):
            assert pairs[0] > last and (np.diff(pairs) > 0).all()
            last = pairs[-1]
            got.update(dict(zip(zip(*(v.tolist() for v in token_links._pair(radix, pairs))), counts.tolist())))
    assert got == total


def test_large_blocks_leave_in_order(monkeypatch):
    monkeypatch.setattr(token_links, "FENCE", 3)
    rng = np.random.default_rng(2)
    runs, total = [], Counter()
    for _ in range(7):
        pairs = np.unique(rng.integers(0, 60, rng.integers(0, 30)))
        if len(pairs):
            runs.append(token_links.pack(np.diff(pairs, prepend=0), np.ones(len(pairs), np.int64)))
            total.update(pairs.tolist())
    parts = list(token_links.merged(runs))
    assert len(parts) > 3 and (np.diff(np.concatenate([p for p, _ in parts])) > 0).all()
    assert {p: c for ps, cs in parts for p, c in zip(ps.tolist(), cs.tolist())} == total
