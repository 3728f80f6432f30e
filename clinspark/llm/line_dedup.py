"""Line deduplication by pairwise alignment.

Documents that share a *rare* line (in at most ``RARE`` documents) are aligned by patience diff, and the common
blocks, runs of neighbouring lines that stand together in both, are deleted from the later document if they have
at least ``MIN_WORDS`` words. Lines are compared without the white space around them; blank lines are skipped and
stay. The earlier document is the one of smaller id (null first), for equal ids of the smaller hash of its text.

A document is aligned with the first holder of each rare line, not with all. Its other partners are named by *runs*: the
shortest runs of neighbouring lines with ``MIN_WORDS`` words, from each line on and up to each line. Any block of that
many words is the union of such runs, so whatever block any earlier document has, however common its lines are, names the
first holders of its runs. With those a document is aligned on the stretches that their runs cover, once on all of them in
order, and what is left then (blocks that were moved or repeated) stretch by stretch. Each run has one first holder, so one
that a third of all documents share only meets a table with one row for each run, and an earlier document's stretches are
known from the places of the runs: its lines are not sent to every later one. Only hashes of lines and runs, places and
numbers of words are shuffled, and the texts once, at the end.

Rows that repeat an id and a text are one document. Null and empty texts have no lines and stay as they are.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.llm.common import Work, append_columns
from clinspark.staging import Staging

#: Most documents that may have a line for it to be rare.
RARE = 50
#: Least words of a block that is deleted; shorter ones recur by chance.
MIN_WORDS = 20

LINES = [
    T.StructField("keys", T.ArrayType(T.LongType())),
    T.StructField("words", T.ArrayType(T.IntegerType())),
    T.StructField("numbers", T.ArrayType(T.IntegerType())),
]


def line_keys(text: str | None) -> tuple[list[int], list[int], list[int]]:
    """Hash, words and line number of each line that is not blank."""
    keys, words, numbers = [], [], []
    for number, line in enumerate((text or "").split("\n")):
        line = line.strip()
        if line:
            keys.append(xxhash.xxh64_intdigest(line.encode("utf-8", "replace")) - (1 << 63))
            words.append(len(line.split()))
            numbers.append(number)
    return keys, words, numbers


def _line_keys() -> Work:
    return lambda texts: list(zip(*map(line_keys, texts))) if texts else [[], [], []]


def longest_rising(pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence with rising second values, by sorting into piles."""
    from bisect import bisect_left

    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        before.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            piles.append(n)
        else:
            tops[pile], piles[pile] = j, n
    found, n = [], piles[-1] if piles else -1
    while n >= 0:
        found.append(pairs[n])
        n = before[n]
    return found[::-1]


def patience(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Aligned places of ``a`` and ``b``, rising in both.

    Within a range, lines that stand there once in both are the anchors, as many as rise in both; equal lines next
    to the ends of the range or to anchors are aligned too, and the ranges between anchors are treated alike.
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once: dict[int, list[int]] = {}
        for i in range(a0, a1):
            once.setdefault(a[i], [0, 0, i, 0])[0] += 1
        for j in range(b0, b1):
            if a_line := once.get(b[j]):
                a_line[1] += 1
                a_line[3] = j
        anchors = longest_rising([(i, j) for x, y, i, j in once.values() if x == y == 1])
        if not anchors:
            continue
        found += anchors
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)]):
            todo.append((i + 1, k, j + 1, m))
    return sorted(found)


def common_blocks(pairs: Sequence[tuple[int, int]], words: Sequence[int], least: int) -> list[int]:
    """Places in the later document of the aligned blocks with at least ``least`` words."""
    kept: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*pairs, (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words[k] for k in block) >= least:
                kept += block
            block = []
        block.append(j)
        last = (i, j)
    return kept


def shortest_runs(keys: Sequence[int], words: Sequence[int], least: int) -> list[tuple[int, int, int]]:
    """Hash, first place and last place of the shortest runs with ``least`` words from each line on and up to each line."""
    ends = [0]
    for n in words:
        ends.append(ends[-1] + n)
    found, stop = set(), 0
    for start in range(len(keys)):
        stop = max(stop, start + 1)
        while stop < len(keys) and ends[stop] - ends[start] < least:
            stop += 1
        if ends[stop] - ends[start] < least:
            break
        found.add((start, stop))
    start = 0
    for stop in range(1, len(keys) + 1):
        while start + 1 < stop and ends[stop] - ends[start + 1] >= least:
            start += 1
        if ends[stop] - ends[start] >= least:
            found.add((start, stop))
    raw = array("q", keys).tobytes()
    return [(xxhash.xxh64_intdigest(raw[8 * a:8 * b]) - (1 << 63), a, b - 1) for a, b in sorted(found)]


def _runs(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, found = [], []
        for row, (keys, words) in enumerate(zip(batch.column("keys").to_pylist(), batch.column("words").to_pylist())):
            own = shortest_runs(keys, words, least)
            rows += [row] * len(own)
            found += own
        taken = pa.array(rows, pa.int64())
        run, start, stop = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(taken), batch.column("version").take(taken), pa.array(run, pa.int64()),
             pa.array(start, pa.int32()), pa.array(stop, pa.int32())], names=["doc_id", "version", "run", "start", "stop"])


def _stretch(places: Sequence[int], keys: dict[int, int], side: str) -> tuple[list[int], list]:
    """Places in order and their keys, with something that equals nothing else wherever places are missing."""
    at: list[int] = []
    row: list = []
    for place in places:
        if at and place != at[-1] + 1:
            at.append(at[-1])
            row.append((side, place))
        at.append(place)
        row.append(keys[place])
    return at, row


def _aligned_runs(hits: Sequence[tuple[int, int, int]], keys: Sequence[int], words: Sequence[int], least: int) -> list[int]:
    """Places of the later document in blocks aligned with the earlier one that has its runs ``start .. stop`` at ``at``."""
    theirs, own = {}, {}
    for at, start, stop in hits:
        for k in range(start, stop + 1):
            theirs[at + k - start] = own[k] = keys[k]
    first, a = _stretch(sorted(theirs), theirs, "earlier")
    later, b = _stretch(sorted(own), own, "later")
    return common_blocks([(first[i], later[j]) for i, j in patience(a, b)], words, least)


def align_runs(hits: Sequence[tuple[int, int, int, int]], keys: Sequence[int], words: Sequence[int], least: int) -> set[int]:
    """Places in the aligned blocks of a document with all earlier ones, from its runs ``(earlier, at, start, stop)``."""
    by: dict[int, list[tuple[int, int, int]]] = {}
    for earlier, at, start, stop in hits:
        by.setdefault(earlier, []).append((at, start, stop))
    gone: set[int] = set()
    for own in by.values():
        gone.update(_aligned_runs(own, keys, words, least))
    for own in by.values():
        # Blocks in another order or repeated: neighbouring runs that are as far apart in both, each for itself.
        left = [hit for hit in own if any(k not in gone for k in range(hit[1], hit[2] + 1))]
        stretch: list[tuple[int, int, int]] = []
        for hit in [*sorted(left, key=lambda x: (x[0] - x[1], x[1])), None]:
            if stretch and (hit is None or hit[0] - hit[1] != stretch[-1][0] - stretch[-1][1]
                            or hit[1] > max(x[2] for x in stretch[-2:]) + 1):
                gone.update(_aligned_runs(stretch, keys, words, least))
                stretch = []
            if hit:
                stretch.append(hit)
    return gone


def _align(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first, own, words = (batch.column(c).to_pylist() for c in ("first_keys", "keys", "words"))
        aligned = [common_blocks(patience(a, b), w, least) for a, b, w in zip(first, own, words)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("version"), pa.array(aligned, pa.list_(pa.int32()))],
            names=["doc_id", "version", "aligned"])


FOUND = "doc_id bigint, version bigint, n_lines int, deleted array<int>, words_deleted bigint, cut array<boolean>"


def _delete(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, deleted, total, cuts = [], [], [], []
        for row in range(batch.num_rows):
            keys, words, numbers, aligned, hits = (
                batch.column(c)[row].as_py() for c in ("keys", "words", "numbers", "aligned", "hits"))
            places = align_runs(list(zip(hits[0::4], hits[1::4], hits[2::4], hits[3::4])), keys, words, least)
            places.update(aligned)
            gone = sorted(places)
            cut = bytearray(numbers[gone[-1]] + 1) if gone else bytearray()
            for place in gone:
                cut[numbers[place]] = 1
            counts.append(len(keys))
            deleted.append([numbers[place] for place in gone])
            total.append(sum(words[place] for place in gone))
            cuts.append([x == 1 for x in cut])
        made = [(counts, pa.int32()), (deleted, pa.list_(pa.int32())), (total, pa.int64()), (cuts, pa.list_(pa.bool_()))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("version"), *[pa.array(v, t) for v, t in made]],
            names=["doc_id", "version", "n_lines", "deleted", "words_deleted", "cut"])


def _same(a: str, b: str) -> F.Column:
    return F.col(f"{a}_id").eqNullSafe(F.col(f"{b}_id")) & (F.col(f"{a}_version") == F.col(f"{b}_version"))


def deleted_lines(
    docs: DataFrame, staging: Staging, *, doc_id: str = "doc_id", text: str = "text", rare: int = RARE,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``doc_id``, ``version`` (hash of the text), ``n_lines`` (not blank), ``deleted`` (line numbers from 0, sorted) and
    ``words_deleted`` of each document from which something is deleted, and ``cut``: for each line up to the last of them
    whether it is."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    source = source.withColumn("version", F.coalesce(F.xxhash64("text"), F.lit(0)))
    lines = staging.table(append_columns(source, "text", LINES, _line_keys).drop("text").where(F.size("keys") > 0))
    lines = staging.table(lines.dropDuplicates(["doc_id", "version"]))

    places = lines.select("doc_id", "version", F.posexplode("keys").alias("place", "key"))
    seen = places.groupBy("doc_id", "version", "key").agg(F.min("place").alias("place"))
    shared = staging.table(
        seen.groupBy("key").agg(F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "version", "place")).alias("first"))
        .where("n_docs > 1")
        .select("key", "n_docs", F.col("first.doc_id").alias("first_id"), F.col("first.version").alias("first_version"),
                F.col("first.place").alias("first_place"))
    )
    known = staging.table(
        lines.select("doc_id", "version", F.posexplode(F.arrays_zip("keys", "words", "numbers")).alias("place", "line"))
        .select("doc_id", "version", "place", "line.*").withColumnRenamed("keys", "key").join(shared, "key")
        .withColumnsRenamed({"doc_id": "own_id", "version": "own_version"}).where(~_same("own", "first"))
    )

    # Rare lines name the pairs to align.
    pairs = known.where(F.col("n_docs") <= rare).select("first_id", "first_version", "own_id", "own_version").distinct()
    first = lines.select(F.col("doc_id").alias("x_id"), F.col("version").alias("x_version"), F.col("keys").alias("first_keys"))
    own = lines.withColumnsRenamed({"doc_id": "y_id", "version": "y_version"})
    aligned = pairs.join(first, _same("first", "x")).join(own, _same("own", "y")).select(
        F.col("own_id").alias("doc_id"), F.col("own_version").alias("version"), "first_keys", "keys", "words",
    ).mapInArrow(partial(_align, least=min_words), "doc_id bigint, version bigint, aligned array<int>")

    # Runs that an earlier document has.
    every = lines.mapInArrow(
        partial(_runs, least=min_words), "doc_id bigint, version bigint, run bigint, start int, stop int")
    holders = staging.table(
        every.groupBy("run").agg(F.min(F.struct("doc_id", "version", "start")).alias("first"), F.max(F.struct("doc_id", "version")).alias("last"))
        .where(~(F.col("first.doc_id").eqNullSafe(F.col("last.doc_id")) & (F.col("first.version") == F.col("last.version"))))
        .select("run", F.col("first.doc_id").alias("first_id"), F.col("first.version").alias("first_version"),
                F.col("first.start").alias("first_start"))
    )
    # Only places that the hash of an earlier document's name tells apart: two of one hash would be aligned as one.
    hit = F.array(F.xxhash64("first_id", "first_version"), *[F.col(c).cast("bigint") for c in ("first_start", "start", "stop")])
    runs = (
        every.withColumnsRenamed({"doc_id": "own_id", "version": "own_version"}).join(holders, "run").where(~_same("own", "first"))
        .groupBy("own_id", "own_version").agg(F.flatten(F.collect_list(hit)).alias("hits"))
        .select(F.col("own_id").alias("doc_id"), F.col("own_version").alias("version"),
                F.lit(None).cast("array<int>").alias("aligned"), "hits")
    )

    found = (
        aligned.withColumn("hits", F.lit(None).cast("array<bigint>")).unionByName(runs).groupBy("doc_id", "version")
        .agg(F.flatten(F.collect_list("aligned")).alias("aligned"), F.flatten(F.collect_list("hits")).alias("hits"))
        .where((F.size("aligned") > 0) | (F.size("hits") > 0))
    )
    one = found.select(F.col("doc_id").alias("own_id"), F.col("version").alias("own_version"), "aligned", "hits")
    return one.join(own, _same("own", "y")).select(
        F.col("own_id").alias("doc_id"), F.col("own_version").alias("version"), "keys", "words", "numbers", "aligned", "hits",
    ).mapInArrow(partial(_delete, least=min_words), FOUND).where(F.size("deleted") > 0)


def dedup_lines(
    docs: DataFrame, staging: Staging, *, doc_id: str = "doc_id", text: str = "text", report: str = "line_dedup", **options
) -> DataFrame:
    """``docs`` with shared blocks cut from ``text``, and the column ``report``: a struct of ``n_lines``, ``deleted`` and
    ``words_deleted``, null where nothing was deleted."""
    found = staging.table(deleted_lines(docs, staging, doc_id=doc_id, text=text, **options))
    found = found.select(F.col("doc_id").alias("__later_id"), F.col("version").alias("__later_version"),
                         F.struct("n_lines", "deleted", "words_deleted").alias(report), F.col("cut").alias("__later_cut"))
    # The same join at every size: deletions grow with the documents.
    joined = docs.drop(report).join(
        found.hint("merge"), F.col(doc_id).eqNullSafe(F.col("__later_id")) & (F.xxhash64(text) == F.col("__later_version")), "left")
    left = F.array_join(F.filter(
        F.split(text, "\n", -1), lambda line, n: ~F.coalesce(F.get("__later_cut", n), F.lit(False))), "\n")
    columns = [F.when(F.col(report).isNull(), F.col(text)).otherwise(left).alias(text) if c == text else F.col(c)
               for c in docs.columns if c != report]
    return joined.select(*columns, report)
