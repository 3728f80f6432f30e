from __future__ import annotations

import time

import numpy as np

from clinspark.llm import lattice
from clinspark.llm.queries import QUERIES

KIND = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows, threshold=0.93):
    """Links and components by all cosines."""
    good = []
    for i, v, label, *_ in rows:
        ok = i is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v)
        good.append(ok and any(v))
    parent = {r[0]: r[0] for r in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if good[a] and good[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], np.float32).astype(float), np.array(rows[b][1], np.float32).astype(float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    p, q = sorted((root(rows[a][0]), root(rows[b][0])))
                    parent[q] = p
    return [(r[0], n, root(r[0])) for r, n in zip(rows, links)]


def test_lattice_points():
    x = np.random.default_rng(1).normal(size=(300, 8)) * 2
    point = lattice.nearest_e8(x)
    double = np.rint(2 * point).astype(int)
    assert (np.abs(2 * point - double) < 1e-9).all() and ((double % 2 == double[:, :1] % 2).all())
    assert (np.rint(point.sum(axis=1)).astype(int) % 2 == 0).all()
    around = lattice.minimal_vectors()
    assert len(around) == 240 and np.allclose((around ** 2).sum(axis=1), 2)
    best = ((x - point) ** 2).sum(axis=1)
    assert (best <= ((x[:, None] - point[:, None] - around) ** 2).sum(axis=2).min(axis=1) + 1e-9).all()


def test_tiny_and_huge_components(spark, staging):
    """Squares of these vanish or overflow; links are those of the scaled vectors."""
    rows = [(i, [f * x for x in v], 1) for i, (f, v) in enumerate(
        [(1e-200, [1.0, 2.0]), (1e200, [1.0, 2.01]), (1e200, [-2.0, 1.0]), (5e-324, [1.0, 2.0]), (1.0, [2.0, -1.0])])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = lattice.near_vectors(df, staging)
    assert sorted(map(tuple, found.collect())) == [(0, 2, 0), (1, 2, 0), (2, 0, 2), (3, 2, 0), (4, 0, 4)]


def test_recall_at_the_threshold():
    random = np.random.default_rng(2)
    a = random.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = random.normal(size=a.shape)
    o -= (o * a).sum(axis=1, keepdims=True) * a
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93 ** 2) * o
    x, s, _ = lattice.cells(a, lattice.TABLES, lattice.PROBES, lattice.SCALE)
    y, t, _ = lattice.cells(b, lattice.TABLES, lattice.PROBES, lattice.SCALE)
    met = (x == y[:, :, :1]).any(axis=(1, 2)) | (y == x[:, :, :1]).any(axis=(1, 2))
    met &= np.bitwise_count((s ^ t).view(np.uint64)) <= lattice.SIGNS
    assert met.mean() > 0.97


def test_against_brute_force_and_edges(spark, staging):
    random = np.random.default_rng(3)
    rows = []
    for group in range(12):
        centre = random.normal(size=16)
        for _ in range(8):
            rows.append([len(rows), (centre + random.normal(size=16) * 0.15).tolist(), group % 3, "x"])
    rows += [[len(rows) + i, rows[0][1], 0, None] for i in range(20)]
    n = len(rows)
    rows += [[n, None, 0, "x"], [n + 1, [0.0] * 16, 0, "x"], [n + 2, [float("nan")] + [1.0] * 15, 0, "x"],
             [n + 3, [None] + [1.0] * 15, 0, "x"], [n + 4, rows[0][1], None, "x"], [n + 5, [], 0, "x"],
             [n + 6, [float("inf")] + [1.0] * 15, 0, "x"], [n + 7, rows[0][1][:8], 0, "x"], [n + 8, [1e-30] * 16, 1, "x"],
             [n + 9, [1.0] * 16, 1, "x"]]
    df = spark.createDataFrame(rows, KIND)
    found = lattice.near_vectors(df, staging)
    assert sorted(map(tuple, found.collect())) == sorted(brute(rows))
    nameless = spark.createDataFrame([(None, [1.0, 2.0], 1, None)], KIND)
    assert [tuple(r) for r in lattice.near_vectors(nameless, staging).collect()] == [(None, 0, None)]
    assert lattice.near_vectors(df.where("false"), staging).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    vectors = np.array([r[1] for r in rows])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows])
    near = (vectors @ vectors.T >= 0.93) & (labels[:, None] == labels)
    want = {r[0]: int(n) - 1 for r, n in zip(rows, near.sum(axis=1))}
    found = QUERIES["op2_e8_lattice"](spark, folder).collect()
    got = sum(r["n_links"] for r in found)
    assert all(r["n_links"] <= want[r["vec_id"]] for r in found) and got >= 0.99 * sum(want.values())
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_wide_near_copies_in_bounded_time(spark, staging):
    """A pair costs as much as its vectors are long, not its square."""
    random = np.random.default_rng(5)
    centre = random.normal(size=1024)
    rows = [(i, (centre + random.normal(size=1024) * 0.1).tolist(), 1, None) for i in range(90)]
    df = spark.createDataFrame(rows, KIND)
    start = time.monotonic()
    found = lattice.near_vectors(df, staging).collect()
    assert time.monotonic() - start < 20
    assert sorted(map(tuple, found)) == [(i, 89, 0) for i in range(90)]
