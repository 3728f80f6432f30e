"""Near-duplicates by SimHash, found with BK-trees.

**Fingerprints.** A-Z are lower-cased, words are split at ASCII white space, and every run of ``width`` words
(repeats included; a text of fewer words is one run) is hashed by XXH64 with seed 42. A bit is set if more than half
of the hashes have it. A text without words, empty or null has fingerprint zero and links like any other.

**Links.** Fingerprints link at ``radius`` or fewer differing bits. Two that link agree in at least one of
``radius + 1`` blocks of bits, so a shard is what has one value in one block. Each shard has a BK-tree, whose
children are keyed by their Hamming distance to the parent; a search follows only the edges within the radius.
A tree is sent only to the task that asks it, by a shuffle, and not through the driver, since all trees together
hold all fingerprints. A shard of more than ``SHARD`` fingerprints is split again by blocks of the bits that it
does not fix, so no tree outgrows a task; the bits run out before the levels do.

**Groups.** Exact copies meet as one fingerprint before anything is compared. A shard gives one link for each member
that is joined to another, not all pairs. Components are then found over all shards.

Rows with one id are one document. A null id never names a component; it takes the name of what it is joined to.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.llm.common import Work, append_columns, components, sorted_groups
from clinspark.staging import Staging

WIDTH = 3
RADIUS = 2
BITS = 64
#: Most fingerprints in one BK-tree.
SHARD = 4096
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < width:
        runs = iter([b" ".join(words)])
        n = 1
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(width))))
        n = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(run, 42) for run in runs), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, n, 1 << 16):
        part = hashes[start:start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def _fingerprints(width: int) -> Work:
    return lambda texts: [[fingerprint(t, width) for t in texts]]


def add_fingerprint(docs: DataFrame, *, text: str = "text", width: int = WIDTH, out: str = "fingerprint") -> DataFrame:
    """``docs`` with the bigint column ``out``."""
    return append_columns(docs, text, [T.StructField(out, T.LongType())], partial(_fingerprints, width))


def split_bits(mask: int, parts: int) -> list[int]:
    """Masks that fix the bits of ``mask`` and one of ``parts`` blocks of the others."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:])]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


class BKTree:
    """Fingerprints by their Hamming distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> Iterator[int]:
        """Numbers of the nodes within ``radius``."""
        todo = [0] if self.values else []
        while todo:
            node = todo.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                yield node
            below = self.children[node]
            for edge in range(max(1, distance - radius), distance + radius + 1):
                if edge in below:
                    todo.append(below[edge])

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        node, new = 0, len(self.values) - 1
        while node != new:
            distance = (self.values[node] ^ value).bit_count()
            node = self.children[node].setdefault(distance, new)


def local_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """One link for each of the distinct values that is joined to an earlier one, directly or through others."""
    tree, parent = BKTree(), list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    plain = values.view(np.uint64).tolist()
    for i, value in enumerate(plain):
        for j in tree.near(value, radius):
            parent[root(i)] = root(j)
        tree.add(value)
    return [(int(values[i]), int(values[r])) for i in range(len(plain)) if (r := root(i)) != i]


def _shard_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for groups in sorted_groups(batches, ["mask", "value"]):
        found = [link for own in groups(["fingerprint"]) for link in local_links(own[0], radius)]
        if found:
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def fingerprint_links(values: DataFrame, staging: Staging, *, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links ``a, b`` that join all of the distinct, not null ``fingerprint`` within ``radius`` of each other."""
    spark = values.sparkSession
    masks = split_bits(0, radius + 1)
    rows = values.select("fingerprint", F.explode(F.array(*[F.lit(signed(m)) for m in masks])).alias("mask"))
    done = []
    while True:
        rows = rows.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "value").count()
        large = staging.table(sizes.where(F.col("count") > shard).select("mask", "value"))
        if large.isEmpty():
            break
        done.append(rows.join(large, ["mask", "value"], "left_anti"))
        # One row per mask and block of its free bits: at most 3 ** 6 of them for a radius of 2.
        finer = [(signed(m), signed(f)) for m in masks for f in split_bits(m, radius + 1)]
        level = F.broadcast(spark.createDataFrame(finer, "mask bigint, finer bigint"))
        rows = staging.table(
            rows.join(large, ["mask", "value"], "left_semi").join(level, "mask")
            .select("fingerprint", F.col("finer").alias("mask")).distinct()
        )
        masks = list({f & ((1 << BITS) - 1) for _, f in finer})
    for other in done:
        rows = rows.select("mask", "value", "fingerprint").unionByName(other)
    sharded = rows.select("mask", "value", "fingerprint").repartition("mask", "value")
    return sharded.sortWithinPartitions("mask", "value", "fingerprint").mapInArrow(
        partial(_shard_links, radius=radius), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, staging: Staging, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
    radius: int = RADIUS, shard: int = SHARD,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (bigint) and ``component_id`` (the smallest id reachable) of every document."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    own = staging.table(add_fingerprint(source, width=width).drop("text"))
    values = staging.table(own.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    joined = components(fingerprint_links(values.select("fingerprint"), staging, radius=radius, shard=shard), staging)
    grouped = values.join(joined, F.col("fingerprint") == F.col("vertex"), "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    names = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = staging.table(grouped.join(names, "root").select("fingerprint", "component_id"))
    return own.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, staging: Staging, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """The document of each component whose id names it, with all its columns.

    Rows that repeat an id stay or go together. Documents without an id stay only if a component has nothing else.
    """
    found = near_duplicates(docs, staging, doc_id=doc_id, **options)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept_id")).distinct()
    return docs.join(kept, F.col(doc_id).eqNullSafe(F.col("__kept_id")), "left_semi")


def as_hex(value) -> F.Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
