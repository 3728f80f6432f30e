"""Hard negatives of anchors: for each positive, the best rows of other labels in a window below the positive's score.

Scores are integer inner products of vectors whose components are ``floor(256 * x)``. The windows of an anchor's positives
overlap, but the upper limits of all of them cut the scores into disjoint slots. Every task keeps the best rows of
each (anchor, slot) that it has seen, a small sort merges those of all tasks, and the first rows below a limit are those of
its slot followed by the slots further down: one descending merge answers every window.

All rows meet all anchors, as matrix products: rows stay where they are stored, and anchors come to them in waves of at most
``wave_bytes``, each a job of its own. Neither label nor score is a shuffle key of rows, so a frequent label or a
group of copies costs nothing extra, and a task's output is bounded by the wave.

A row without an id, label or vector, or with a null, infinite or undefined component, takes no part. Vectors are only
compared with those of their length. Repeated rows count as often as they occur, as candidates; an anchor is
one, however often its row is repeated, and "other rows" are those with another id. Scores are exact up to the range
of a long and are held at its ends beyond. Of an empty table nothing is returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.llm.common import PerWorker
from clinspark.operators.surrogate import number_rows
from clinspark.staging import Staging

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is at least 30 and at most 90 hundredths of the positive's.
LOWER, UPPER = 30, 90
#: Bytes of anchors that all tasks get at a time.
WAVE_BYTES = 16 << 20
#: Rows and anchors of one matrix product.
BLOCK = 1024

_LONG = np.iinfo(np.int64)
_FOUND = "anchor int, slot int, score bigint, id bigint"
_NONE = _LONG.min


def share(score: int, hundredths: int) -> int:
    """The largest whole number that is at most so many hundredths of ``score``."""
    return score * hundredths // 100


@dataclass(frozen=True)
class Anchors:
    """A wave of anchors of one vector length, and the limits of their slots, highest first; ``limits`` may hold none.

    Slot ``j`` of an anchor holds scores above ``limits[j + 1]`` and up to ``limits[j]``, the last one down to ``floors``.
    """

    numbers: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    limits: np.ndarray | None = None
    floors: np.ndarray | None = None


def _scaled(values: np.ndarray) -> np.ndarray:
    """Whole components; what a double can't hold is held at its end."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * values), -np.finfo(np.float64).max, np.finfo(np.float64).max)


def _products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of all rows with all anchors (rows x anchors), exact; held near the ends of a long."""
    with np.errstate(all="ignore"):
        most_r, most_a = np.abs(rows).max(axis=1, initial=0), np.abs(anchors).max(axis=1, initial=0)
        fits = lambda x, y: np.nan_to_num(x * y, nan=np.inf) * max(1, rows.shape[1]) < 2.0**52
        scores = (rows @ anchors.T).astype(np.int64)
    if fits(most_r.max(initial=0), most_a.max(initial=0)):
        return scores
    large_r = ~fits(most_r, 2.0**12)
    large_a = ~fits(most_a, most_r[~large_r].max(initial=0))
    scores[large_r] = _exact(rows[large_r], anchors)
    scores[:, large_a] = _exact(rows, anchors[large_a])
    rest = np.ix_(~large_r, ~large_a)
    scores[rest] = (rows[~large_r] @ anchors[~large_a].T).astype(np.int64)
    return scores


def _exact(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    whole = lambda values: np.array([[int(x) for x in v] for v in values], object).reshape(values.shape)
    held = [[min(max(int(x), _LONG.min + 2), _LONG.max - 1) for x in row] for row in whole(rows) @ whole(anchors).T]
    return np.array(held, np.int64).reshape(len(rows), len(anchors))


class Best:
    """The ``k`` best rows of each anchor and slot so far: higher scores first, then smaller ids."""

    def __init__(self, anchors: int, slots: int, k: int) -> None:
        self.scores = np.full((anchors, slots, k), _NONE, np.int64)
        self.ids = np.full((anchors, slots, k), _LONG.max, np.int64)
        self.k = k

    def add(self, at: slice, slot: int, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Scores (rows x anchors of ``at``) of the ``allowed`` pairs; rows stand in ascending order of their ids."""
        kept, held = self.scores[at, slot], self.ids[at, slot]
        # Rows with the score of the last one kept may still have a smaller id.
        allowed = allowed & (scores >= kept[:, -1])
        busy = np.flatnonzero(allowed.any(axis=0))
        if not len(busy):
            return
        scores = np.where(allowed[:, busy], scores[:, busy], _NONE)
        n = min(self.k, len(scores))
        bound = max(abs(int(scores[scores != _NONE].max())), abs(int(scores[scores != _NONE].min()))) + 1
        if bound * len(scores) < 1 << 62:
            # Score and place in one number, so that ties fall to the smaller id.
            ranked = scores * len(scores) - np.arange(len(scores))[:, None]
            ranked[scores == _NONE] = _NONE
            top = np.argpartition(-(ranked + 1), n - 1, axis=0)[:n] if n < len(scores) else np.tile(
                np.arange(n)[:, None], (1, len(busy)))
        else:
            top = np.argsort(-(scores + 1), axis=0, kind="stable")[:n]
        found = np.take_along_axis(scores, top, 0).T
        found_ids = np.where(found == _NONE, _LONG.max, ids[top.T])
        both, both_ids = np.hstack([kept[busy], found]), np.hstack([held[busy], found_ids])
        order = np.lexsort((both_ids, -(both + 1)), axis=1)[:, : self.k]
        rows = np.arange(at.start, at.stop)[busy]
        self.scores[rows, slot] = np.take_along_axis(both, order, 1)
        self.ids[rows, slot] = np.take_along_axis(both_ids, order, 1)


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and scaled vectors of a batch, by length of the vectors, in ascending order of the ids."""
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    labels = batch.column("label").to_numpy(zero_copy_only=False)
    lists = batch.column("vector")
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for length in np.unique(lengths):
        chosen = np.flatnonzero(lengths == length)
        chosen = chosen[np.argsort(ids[chosen], kind="stable")]
        for start in range(0, len(chosen), BLOCK):
            part = chosen[start:start + BLOCK]
            yield ids[part], labels[part], _scaled(values[offsets[part][:, None] + np.arange(length)])


def _search(
    batches: Iterator[pa.RecordBatch], wave: PerWorker, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """The best rows of this task for every anchor: of its own label where it has no limits yet, else by slot."""
    groups = wave()
    k = [POSITIVES if a.limits is None else NEGATIVES for a in groups]
    best = [Best(len(a.ids), 1 if a.limits is None else a.limits.shape[1], n) for a, n in zip(groups, k)]
    for batch in batches:
        for ids, labels, vectors in _vectors(batch):
            for anchors, kept in zip(groups, best):
                if anchors.vectors.shape[1] == vectors.shape[1]:
                    _meet(ids, labels, vectors, anchors, kept)
    for anchors, kept in zip(groups, best):
        a, slot, place = np.nonzero(kept.scores != _NONE)
        yield pa.RecordBatch.from_arrays([
            pa.array(anchors.numbers[a], pa.int32()), pa.array(slot, pa.int32()), pa.array(kept.scores[a, slot, place]),
            pa.array(kept.ids[a, slot, place])], names=schema.names)


def _meet(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, anchors: Anchors, kept: Best) -> None:
    for start in range(0, len(anchors.ids), BLOCK):
        at = slice(start, min(start + BLOCK, len(anchors.ids)))
        scores = _products(vectors, anchors.vectors[at])
        same = labels[:, None] == anchors.labels[at]
        if anchors.limits is None:
            kept.add(at, 0, scores, same & (ids[:, None] != anchors.ids[at]), ids)
            continue
        limits = anchors.limits[at]
        allowed = ~same & (scores >= anchors.floors[at])
        for slot in range(limits.shape[1]):
            inside = allowed & (scores <= limits[:, slot])
            if slot + 1 < limits.shape[1]:
                inside &= scores > limits[:, slot + 1]
            kept.add(at, slot, scores, inside, ids)


def _searched(rows: DataFrame, wave: list[Anchors], k: int) -> DataFrame:
    """The ``k`` best rows of every anchor and slot over all tasks."""
    schema = pa.schema([("anchor", pa.int32()), ("slot", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])
    sent = PerWorker(rows.sparkSession, wave, _same)
    found = rows.mapInArrow(partial(_search, wave=sent, schema=schema), _FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _same(value):
    return value


def _anchor_groups(rows: list, lists: dict[int, list[int]] | None) -> list[Anchors]:
    """The anchors of a wave by length of their vectors; ``lists`` has the scores of the positives of each."""
    by_length: dict[int, list] = {}
    for r in rows:
        if lists is None or lists.get(r["anchor"]):
            by_length.setdefault(len(r["vector"]), []).append(r)
    groups = []
    for length, own in by_length.items():
        vectors = _scaled(np.array([r["vector"] for r in own], np.float64).reshape(len(own), length))
        limits = floors = None
        if lists is not None:
            cuts = [sorted({share(s, UPPER) for s in lists[r["anchor"]]}, reverse=True) for r in own]
            limits = np.full((len(own), max(map(len, cuts))), _NONE, np.int64)
            for i, cut in enumerate(cuts):
                limits[i, : len(cut)] = cut
            floors = np.array([min(-share(-s, LOWER) for s in lists[r["anchor"]]) for r in own], np.int64)
        groups.append(Anchors(
            np.array([r["anchor"] for r in own], np.int32), np.array([r["id"] for r in own], np.int64),
            np.array([r["label"] for r in own], np.int64), vectors, limits, floors))
    return groups


def _mine(rows: DataFrame, wave: DataFrame, staging: Staging) -> DataFrame:
    """Positives, then negatives, of one wave of anchors, whose number the wave's size bounds."""
    spark = rows.sparkSession
    anchors = wave.collect()
    positives = staging.table(_searched(rows, _anchor_groups(anchors, None), POSITIVES))
    scores: dict[int, list[int]] = {}
    for p in positives.select("anchor", "score").collect():  # at most POSITIVES for each anchor of the wave
        scores.setdefault(p["anchor"], []).append(p["score"])
    found = _searched(rows, _anchor_groups(anchors, scores), NEGATIVES)
    slots = found.groupBy("anchor", "slot").agg(
        F.sort_array(F.collect_list(F.struct("place", "score", "id"))).alias("rows"))
    merged = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "rows"))).alias("slots"))
    # A positive's slot is the place of its limit among the anchor's limits.
    cuts = {a: sorted({share(s, UPPER) for s in found_}, reverse=True) for a, found_ in scores.items()}
    names = spark.createDataFrame([(r["anchor"], r["id"]) for r in anchors], "anchor int, anchor_id bigint")
    windows = spark.createDataFrame(
        [(a, s, cuts[a].index(share(s, UPPER)), -share(-s, LOWER)) for a, found_ in scores.items() for s in set(found_)],
        "anchor int, score bigint, slot int, floor bigint")
    asked = positives.select("anchor", F.col("id").alias("positive_id"), "score").join(windows, ["anchor", "score"])
    # The slots from the window's own downwards, one after another, are its rows in their order.
    below = F.flatten(F.transform(
        F.filter("slots", lambda s: s["slot"] >= F.col("slot")), lambda s: s["rows"]))
    inside = F.filter(F.slice(below, 1, NEGATIVES), lambda r: r["score"] >= F.col("floor"))
    ranked = asked.join(merged, "anchor").select(
        "anchor", "positive_id", F.col("score").alias("positive_score"), F.posexplode(inside).alias("rank", "negative"))
    return ranked.join(names, "anchor").select(
        "anchor_id", "positive_id", (F.col("rank") + 1).alias("rank"), F.col("negative.id").alias("negative_id"),
        "positive_score", F.col("negative.score").alias("negative_score"))


def mine_negatives(
    df: DataFrame, is_anchor: Column, staging: Staging, *, id: str = "vec_id", vector: str = "embedding",
    label: str = "label", wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of the rows that ``is_anchor`` names.

    An anchor's positives are its ``POSITIVES`` best other rows of its label. Of each the ``NEGATIVES`` best rows of other
    labels with a score between ``LOWER`` and ``UPPER`` hundredths of the positive's are returned.
    """
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = F.col(id).isNotNull() & F.col(label).isNotNull() & F.forall(F.col(vector).cast("array<double>"), fine)
    columns = [F.col(id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
               F.col(vector).cast("array<double>").alias("vector")]
    rows = df.where(whole).select(*columns)
    chosen = staging.table(df.where(whole & is_anchor).select(*columns).distinct())
    longest = chosen.agg(F.max(F.size("vector"))).first()[0]
    kind = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if longest is None:
        return df.sparkSession.createDataFrame([], kind)
    in_wave = max(1, wave_bytes // (8 * (longest + 4)))
    numbered = staging.table(number_rows(chosen, ["id", "label", "vector"], "_number", staging))
    path = staging.path("negatives")
    for w in range(math.ceil(numbered.count() / in_wave)):
        own = numbered.where(F.col("_number").between(w * in_wave + 1, (w + 1) * in_wave))
        own = own.select("id", "label", "vector", (F.col("_number") - 1 - w * in_wave).cast("int").alias("anchor"))
        _mine(rows, own, staging).write.mode("overwrite").parquet(f"{path}/wave={w}")
    return df.sparkSession.read.schema(kind).parquet(f"{path}/wave=*")
