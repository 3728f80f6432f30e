"""Near-duplicate embeddings by lattice hashing.

Vectors of length 1 are projected to 8 dimensions at random and decoded to the nearest point of the lattice E8, in
``TABLES`` tables of their own projection. A vector is stored in the cell of its point and asks that cell and the
``PROBES - 1`` nearest of the 240 cells around it. Vectors that meet in a cell are candidates if their sketches of 64
random signs differ in at most ``SIGNS`` (at the threshold 8 are expected), and links if their labels are equal and their
cosine, in double precision, reaches the threshold. The measured share of links found is in the tests.

Equal vectors of one label are one class with a count, so a group of copies costs as much as one vector. Cells are joined
by a sort-merge join whose skewed cells Spark splits; it moves ids and sketches, and vectors only for the pairs left.

Vectors that are null, zero, or hold null or non-finite components, and rows whose label or id is null, link with nothing;
their component is their id. Vectors of different lengths do not link. An id should name one vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.llm.common import components
from clinspark.staging import Staging

THRESHOLD = 0.93
TABLES = 4
PROBES = 16
#: Standard deviation of a projected coordinate of a vector of length 1; a cell has volume 1.
SCALE = 0.7
SIGNS = 18
SEED = 20240607
#: Components of pairs that a task works on at a time.
BLOCK = 1 << 18


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    found = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            found.append(v)
    found += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(found)


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of an even sum."""
    point = np.rint(x)
    error = x - point
    odd = np.flatnonzero(point.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(error[odd]).argmax(axis=1)
    point[odd, worst] += np.where(error[odd, worst] >= 0, 1, -1)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def cells(unit: np.ndarray, tables: int, probes: int, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of vectors of length 1: numbers of the cells asked (own cell first) by table, and sketches."""
    n, width = unit.shape
    random = np.random.default_rng(SEED + width)
    around = minimal_vectors()
    mix = random.integers(1, 1 << 62, size=(tables, 8), dtype=np.int64) | 1
    asked = np.zeros((n, tables, probes), np.int64)
    for t in range(tables):
        x = unit @ (random.normal(size=(width, 8)) * scale) + random.random(8)
        point = nearest_e8(x)
        order = np.argsort(-((x - point) @ around.T), axis=1, kind="stable")[:, :probes - 1]
        near = np.concatenate([point[:, None], point[:, None] + around[order]], axis=1)
        with np.errstate(over="ignore"):
            asked[:, t] = (np.rint(2 * near).astype(np.int64) * mix[t]).sum(axis=2) + t
    signs = unit @ random.normal(size=(width, 64)) > 0
    return asked, np.packbits(signs, axis=1, bitorder="little").view("<i8")[:, 0], mix[0]


def _cell_rows(batches: Iterator[pa.RecordBatch], tables: int, probes: int, scale: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        labels = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
        lists = batch.column("embedding")
        widths = lists.value_lengths().to_numpy(zero_copy_only=False)
        for width in np.unique(widths).tolist():
            mine = np.flatnonzero(widths == width)
            flat = lists.take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = flat.reshape(len(mine), width)
            x = x / np.abs(x).max(axis=1, keepdims=True)  # else squares of tiny numbers vanish
            x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
            asked, sketch, mix = cells(x, tables, probes, scale)
            with np.errstate(over="ignore"):
                asked = asked ^ ((labels[mine] + 1) * mix[0] + width * mix[1])[:, None, None]
            each = tables * probes
            own = np.zeros((tables, probes), bool)
            own[:, 0] = True
            yield pa.RecordBatch.from_arrays([
                pa.array(asked.reshape(-1)), pa.array(np.tile(own.reshape(-1), len(mine))),
                pa.array(np.repeat(ids[mine], each)), pa.array(np.repeat(sketch, each)),
            ], names=["cell", "own", "id", "sketch"])


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of the rows of two matrices, in double precision."""
    def scaled(v: np.ndarray) -> np.ndarray:
        """By the power of two of the largest component, which changes no digit: no square vanishes or overflows."""
        return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])

    def dot(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", p, q)

    x, y = scaled(x), scaled(y)
    return dot(x, y) / (np.sqrt(dot(x, x)) * np.sqrt(dot(y, y)))


def _linked(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """The pairs of vectors of one length whose cosine reaches the threshold; some ``BLOCK`` numbers at a time."""
    def matrix(lists: pa.Array, width: int) -> np.ndarray:
        return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), width)

    for batch in batches:
        widths = batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
        for width in np.unique(widths).tolist():
            mine = np.flatnonzero(widths == width)
            rows = max(1, BLOCK // width)
            for start in range(0, len(mine), rows):
                part = batch.take(pa.array(mine[start:start + rows]))
                near = cosines(matrix(part.column("x"), width), matrix(part.column("y"), width)) >= threshold
                yield part.select(["a", "b"]).filter(pa.array(near))


def near_vectors(
    vectors: DataFrame, staging: Staging, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    threshold: float = THRESHOLD, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, signs: int = SIGNS,
) -> DataFrame:
    """``vec_id``, ``n_links`` (other vectors linked directly) and ``component_id`` (smallest id reachable) of each row."""
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).alias("label"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda v: v != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    classes = staging.table(
        rows.where("usable").groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))

    hashed = classes.select("id", F.xxhash64("label").alias("label"), "embedding")
    asked = staging.table(hashed.mapInArrow(
        partial(_cell_rows, tables=tables, probes=probes, scale=scale), "cell bigint, own boolean, id bigint, sketch bigint"))
    stored = asked.where("own").select("cell", F.col("id").alias("b"), F.col("sketch").alias("other"))
    met = asked.join(stored, "cell").where(F.col("id") != F.col("b")).where(
        F.bit_count(F.col("sketch").bitwiseXOR(F.col("other"))) <= signs)
    pairs = met.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()

    left = classes.select(F.col("id").alias("a"), F.col("label").alias("a_label"), F.col("embedding").alias("x"))
    right = classes.select(F.col("id").alias("b"), F.col("label").alias("b_label"), F.col("embedding").alias("y"))
    asked_pairs = pairs.join(left, "a").join(right, "b").where(F.col("a_label") == F.col("b_label")).where(
        F.size("x") == F.size("y")).select("a", "b", "x", "y")
    links = staging.table(asked_pairs.mapInArrow(partial(_linked, threshold=threshold), "a bigint, b bigint"))

    both = links.union(links.select("b", "a"))
    counts = both.join(classes.select(F.col("id").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    named = (
        classes.join(counts, F.col("id") == F.col("a"), "left")
        .join(components(links, staging), F.col("id") == F.col("vertex"), "left")
        .select("label", "embedding",
                (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                F.coalesce("root", "id").alias("component_id"))
    )
    found = rows.where("usable").join(staging.table(named), ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    return found.union(rows.where("not usable").select(
        "vec_id", F.lit(0).cast("bigint"), F.col("vec_id")))
