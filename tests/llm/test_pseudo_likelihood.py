from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from clinspark.llm import pseudo_likelihood as pl
from clinspark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def network():
    random = np.random.default_rng(4)
    own = pl.Network.start(["the", "cat", "sat", "on", "mat"], [9, 5, 4, 4, 2], 40)
    return pl.Network(own.words, own.weights + random.normal(0, 0.2, len(own.weights)).astype(np.float32))


def plain(network, text):
    """Every word's log-probability from a full softmax over classes and places, one word at a time."""
    words = (text or "").lower().split()
    known = network.words.to_pylist()
    line = [known.index(w) if w in known else pl.SYMBOLS - pl.BUCKETS + pl.xxhash.xxh64_intdigest(w.encode()) % pl.BUCKETS
            for w in words]
    embed, bias, kinds, kind_bias, places, place_bias = (v.astype(float) for v in network.views())
    total = 0.0
    for i, target in enumerate(line):
        h = bias.copy()
        for k, o in enumerate(pl.OFFSETS):
            h += embed[k][line[i + o] if 0 <= i + o < len(line) else pl.SYMBOLS]
        h = np.tanh(h)
        for logits, at in ((h @ kinds + kind_bias, target // pl.CLASSES),
                           (h @ places[target // pl.CLASSES] + place_bias[target // pl.CLASSES], target % pl.CLASSES)):
            total += logits[at] - np.log(np.exp(logits).sum())
    return len(words), total


TEXTS = ["The cat sat on the mat", "unknown words here", "", None, "the", "Éa " * 50, "on on on\ncat\tx"]


def test_scores_equal_definition(network):
    counts, line, places = network.symbols(TEXTS)
    found = network.log_probabilities(line, places)
    ends = np.cumsum(counts)
    for text, n, end in zip(TEXTS, counts, ends):
        assert (n, pytest.approx(found[end - n:end].sum(), abs=1e-3)) == plain(network, text)


def test_probabilities_sum_to_one(network):
    line = np.full(7, pl.SYMBOLS)
    line[2:5] = [1, 0, 3]
    total = 0.0
    for start in range(0, pl.SYMBOLS, 512):
        lines = np.tile(line, (512, 1))
        lines[:, 3] = np.arange(start, start + 512)
        total += np.exp(network.log_probabilities(lines.ravel(), np.arange(512) * 7 + 3)).sum()
    assert total == pytest.approx(1, abs=1e-3)


def test_gradient(network):
    """A step against the gradient lowers the loss on its own words."""
    _, line, places = network.symbols(["the cat sat on the mat " * 50])
    before = network.log_probabilities(line, places).mean()
    trainer = pl.Trainer(network)
    for _ in range(30):
        trainer.step(line, places)
    assert trainer.network.log_probabilities(line, places).mean() > before + 0.5 and trainer.masked == 30 * len(places)


def test_one_softmax_for_all_classes(network, monkeypatch):
    """A step takes two softmaxes, not one a class, and moves all weights as those of each class by themselves."""
    _, line, places = network.symbols(["the cat sat on the mat some other words of many buckets " * 30])
    trainer, views = pl.Trainer(network), [v.astype(float) for v in network.views()]
    calls, error = [], pl.softmax_error
    monkeypatch.setattr(pl, "softmax_error", lambda logits, target: calls.append(len(target)) or error(logits, target))
    trainer.step(line, places)
    assert calls == [len(places)] * 2
    kind, inner = line[places] // pl.CLASSES, line[places] % pl.CLASSES
    h = np.tanh(views[1] + sum(views[0][k][line[places + o]] for k, o in enumerate(pl.OFFSETS)))
    for c in set(kind.tolist()):
        own = kind == c
        p = np.exp(h[own] @ views[4][c] + views[5][c])
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(own.sum()), inner[own]] -= 1
        for part, gradient in ((4, h[own].T @ p / len(places)), (5, p.sum(axis=0) / len(places))):
            want = views[part][c] - pl.RATE * gradient / np.sqrt(1e-3 + gradient ** 2)
            assert trainer.views[part][c] == pytest.approx(want, abs=1e-4)
    unmoved = [c for c in range(pl.CLASSES) if c not in kind]
    assert unmoved and all((trainer.views[4][c] == network.views()[4][c]).all() for c in unmoved)


def test_steps_use_kept_arrays(network):
    """Neither a step nor a score takes new memory of the size of its softmaxes."""
    _, line, places = network.symbols(["the cat sat on the mat some other words of many buckets " * 400])
    places = places[:pl.BATCH]
    trainer, size = pl.Trainer(network), 4 * pl.CLASSES * pl.BATCH
    trainer.step(line, places)
    tracemalloc.start()
    trainer.step(line, places)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(places) == pl.BATCH and peak < 3 * size


def test_large_weights(network):
    """Logits that overflow as powers are shifted."""
    large = pl.Network(network.words, network.weights * 20)
    counts, line, places = large.symbols(["the cat sat on the mat"])
    found = large.log_probabilities(line, places)
    assert found.sum() == pytest.approx(plain(large, "the cat sat on the mat")[1], rel=1e-4)
    trainer = pl.Trainer(large)
    trainer.step(line, places)
    assert np.isfinite(trainer.network.weights).all()


@pytest.mark.parametrize("most", [1, 5, 400])
def test_sums_by(most):
    random = np.random.default_rng(most)
    values = random.normal(size=(1000, pl.WIDTH)).astype(np.float32)
    keys = random.integers(0, 4000 // most, 4000)
    found, sums = pl.sums_by(keys.copy(), values)
    want = np.zeros((4000, pl.WIDTH))
    np.add.at(want, keys, np.tile(values, (4, 1)))
    assert sorted(found) == sorted(set(keys.tolist())) and sums == pytest.approx(want[found], abs=1e-4)


def test_split_words():
    texts = [None, "", " \t ", "a", "  A\x0bb\x0cc\r\nd ", "\u00c9a\u00a0b \u3000", "x" * 9, "\ud800 q", "\x1c y\x85z"]
    counts, words = pl.split_words(texts)
    plainly = [(t or "").lower().encode("utf-8", "replace").split() for t in texts]
    assert counts.tolist() == [len(p) for p in plainly]
    assert words.to_pylist() == [w.decode() for p in plainly for w in p]
    assert pl.word_hash(words.slice(1)).tolist() == [pl.xxhash.xxh64_intdigest(w) for p in plainly for w in p][1:]
    assert pl.split_words([])[0].tolist() == [] and not len(pl.split_words([None])[1])


def test_words_are_looked_up_once(spark, staging, tmp_path):
    """Training and scoring together read stored symbols, not the texts, and give what they give one after the other."""
    texts = [*TEXTS, *(f"r{i} a b c r{i % 50} d" for i in range(5000)), "r1 a b c r1 d"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = pl.train_and_score(docs, staging)
    assert not [f for f in found.inputFiles() if str(tmp_path / "docs") in f]
    assert found.columns == ["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"]
    one = {r["doc_id"]: tuple(r)[1:] for r in found.collect()}
    other = {r["doc_id"]: tuple(r)[2:] for r in pl.score(docs, pl.train(docs, staging)).collect()}
    assert len(one) == len(texts) and one.keys() == other.keys()
    assert all(one[i] == pytest.approx(other[i], abs=1e-6) for i in one)


def test_average_of_parts():
    a, b = np.arange(5, dtype=np.float32), np.ones(5, np.float32)
    rows = [*pl._parts(a, 1, 0), *pl._parts(b, 3, 0)]
    found = list(pl._average(iter(rows)))
    assert len(found) == 1
    assert np.frombuffer(found[0].column("weights")[0].as_py(), "<f4") == pytest.approx((a + 3 * b) / 4)


@pytest.mark.parametrize("rounds", [1, 2, 3, 8, 11])
def test_rounds_predict_every_word(network, monkeypatch, rounds):
    """Also those of texts that are shorter than the distance of masked words."""
    texts = ["the cat", "sat", None, "on the mat " * 7, "cat"]
    batch = pl.pa.RecordBatch.from_arrays([pl.pa.array(texts)], names=["text"])
    _, _, places = network.symbols(texts)
    seen = []
    monkeypatch.setattr(pl.Trainer, "step", lambda self, line, at: seen.extend(at.tolist()))
    for turn in range(rounds):
        list(pl._train(iter([batch]), lambda: network, offsets=pl.offsets_of(turn, rounds)))
    assert set(seen) == set(places.tolist()) and (rounds > pl.MASK or len(seen) == len(places))


def test_context_is_learnt_and_edges(spark, staging, edge_docs, no_docs):
    docs = spark.createDataFrame([(i, "a b c d e f " * 200) for i in range(40)], "doc_id long, text string").repartition(4)
    network = pl.train(docs, staging, rounds=2)
    ordered, mixed = pl.score(
        spark.createDataFrame([(1, "a b c d e f " * 5), (2, "f d b e a c " * 5)], "doc_id long, text string"), network).collect()
    assert ordered["mean_log_likelihood"] > mixed["mean_log_likelihood"] + 0.5
    rows = pl.score(edge_docs.withColumnRenamed("tokens", "n_tokens"), network).collect()
    assert len(rows) == edge_docs.count()
    assert all((r["mean_log_likelihood"] is None) == (r["n_tokens"] == 0) for r in rows)
    assert pl.score(no_docs, pl.train(no_docs, staging)).collect() == []


def test_words_in_a_bucket_are_told_apart(spark, staging):
    """A document's score holds the share of each word in its bucket; one of an unseen word is that of one more word."""
    common = [f"w{i}" for i in range(pl.SYMBOLS - pl.BUCKETS)]
    rare = [f"r{i}" for i in range(600)]
    docs = [(i, " ".join(common)) for i in range(9)] + [(10, " ".join(r for i, r in enumerate(rare) for _ in range(1 + i % 7)))]
    network = pl.train(spark.createDataFrame(docs, "doc_id long, text string"), staging)
    counts = {r: 1 + i % 7 for i, r in enumerate(rare)}
    totals = {}
    for r, n in counts.items():
        totals[pl.bucket_of(r)] = totals.get(pl.bucket_of(r), 0) + n
    texts = ["r1 w3 r5 r5", "w1 w2", "r5", "r6 never seen before r6", None, "r1 w3 r5 r5"]
    found = pl.score(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), network)
    plainly = pl.score(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), network.alone())
    base = {r["doc_id"]: r["log_likelihood"] for r in plainly.collect()}
    rows = {r["doc_id"]: r["log_likelihood"] for r in found.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        want = 0.0
        for w in (text or "").split():
            if w not in common:
                total = totals.get(pl.bucket_of(w), 0)
                want += np.log(counts[w] / total) if w in counts else -np.log(total + 1)
        assert rows[i] - base[i] == pytest.approx(want, abs=1e-6)


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op7_masked_window"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(t.split()) for i, t in texts.items()}
    mean = sum(r["log_likelihood"] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert -8 < mean < -5 and all(r["log_likelihood"] < 0 for r in rows)
