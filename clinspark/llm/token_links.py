"""Alignment of two tokenizers over the bytes of the same texts, with corpus-wide counts of the links.

Both sides cut a text's bytes into tokens. Where a token of each ends, a group ends; two tokens whose bytes overlap are a
link. How many documents hold an (A id, B id) link decides which B id is an A id's most common partner.

Counting is external. Tasks read slices of documents, and a slice's records (id pair, document, occurrences) are sorted with
the A id's lowest bits in front, so that they fall into ``RADIXES`` runs, each in side-major order: by A id, then B id, then
document. A run is stored as two zstd blocks, pairs and documents. To count, the runs of a radix are merged over
a heap of their next blocks; only blocks of pairs are moved for that. Each pair's count meets its A id's others in side-major
order, which gives the maxima; then the runs pass by their radix's counts, and each gives back what its documents
gain, a bounded row for each slice and radix. A radix with many records (an A id that is everywhere) is dealt to as many
salts as its stored size asks for; counts of different salts have different documents, so they add up.

A null or empty text, or one that either side does not give back byte by byte, has no tokens: zeros, and empty groups.
Ids may be null or repeated, as rows are told apart by their slice and place in it. Other columns pass through, but
those of the names used here are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clinspark.llm.common import PerWorker, slices
from clinspark.llm.pieces import Memo, flat, string_array, sums
from clinspark.staging import Staging

#: Bytes of text of a slice; also bounds its documents, whose places have 16 bits.
SLICE_BYTES = 6 << 20
#: Bytes of text that are encoded at a time; what a worker holds grows with both.
PART_BYTES = 1 << 20
SLICE_DOCS = 1 << 16
RADIX_BITS = 6
RADIXES = 1 << RADIX_BITS
#: Stored bytes of runs that one task of a radix reads.
SALT_BYTES = 24 << 20
#: Pairs of a run that a heap entry holds.
FENCE = 1 << 14

KEY = "_clinspark_doc"
_TEXT = "_clinspark_text"
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
MADE = (KEY, *_COUNTS, "n_best", "count_sum", "groups")


# ---- tokens


#: White space besides the plain space and the ASCII controls, which a split of words may treat like a space.
OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


ALPHANUMERIC = np.array([chr(i).isalnum() and i < 128 for i in range(256)])


def neighbours(names: Sequence[bytes]) -> np.ndarray:
    """Which byte stands before which within any token: between two others every text is cut."""
    found = np.zeros((256, 256), bool)
    joined = np.frombuffer(b"".join(names), np.uint8)
    if len(joined):
        last = np.zeros(len(joined), bool)
        last[np.cumsum([len(n) for n in names if n]) - 1] = True
        inner = np.flatnonzero(~last)
        found[joined[inner], joined[inner + 1]] = True
    return found


def sign_starts(data: np.ndarray, inside: np.ndarray, runs: bool) -> np.ndarray:
    """Where a character begins that no token joins with the byte before; both are no white space.

    Without ``runs``, an apostrophe begins a contraction only behind a letter or digit; else it belongs to the signs before.
    """
    before, this = data[:-1], data[1:]
    cut = np.zeros(len(data), bool)
    cut[1:] = ~inside[before, this] & (before > 0x20) & (this > 0x20) & ((this < 0x80) | (this >= 0xC0))
    if not runs:
        cut[1:] &= (this != ord("'")) | ALPHANUMERIC[before]
    return cut


def word_starts(data: np.ndarray) -> np.ndarray:
    """Where a single space or line feed stands between two signs, and behind such a line feed.

    A split by runs of letters, digits or signs, each with at most one space before it, always cuts there.
    """
    cut = np.zeros(len(data), bool)
    between = (data[:-2] > 0x20) & (data[2:] > 0x20)
    feed = between & (data[1:-1] == 0x0A)
    cut[1:-1] = between & (data[1:-1] == 0x20) | feed
    cut[2:] |= feed
    return cut


def space_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where a row of spaces begins that another sign of the same text follows; ``begins`` marks first bytes of texts."""
    space = data == 0x20
    before = np.concatenate([[False], space[:-1]])
    rows = np.flatnonzero(space & (~before | begins))
    stops = np.flatnonzero(before & (~space | begins))
    if len(stops) < len(rows):
        rows = rows[:-1]  # the last row ends with the data
    cut = np.zeros(len(data), bool)
    cut[rows[~begins[stops]]] = True
    return cut


@dataclass
class Side:
    """One tokenizer: how chunks are encoded, and the bytes of its ids."""

    memo: Memo
    lengths: np.ndarray
    bytes_of: list[bytes]
    inside: np.ndarray
    runs: bool
    whole: Callable[[str], Sequence[int]]

    def encode(self, spaced: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that begin with a space, one after another, and how many each has."""
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in spaced])]).astype(np.int64)
        data = np.frombuffer(b"".join(spaced), np.uint8)
        begins = np.zeros(len(data), bool)
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        spaces = space_starts(data, begins) if self.runs else word_starts(data)
        starts = np.flatnonzero(spaces | sign_starts(data, self.inside, self.runs) | begins)
        ids, counts = self.memo(string_array(data, starts))
        return ids, sums(counts, np.searchsorted(starts, offsets))

    def gives_back(self, ids: np.ndarray, counts: np.ndarray, spaced: list[bytes]) -> np.ndarray:
        """Which texts the bytes of their ids make up."""
        made = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        ends = np.concatenate([[0], np.cumsum(self.lengths[ids])])[np.concatenate([[0], np.cumsum(counts)])]
        if len(made) == sum(map(len, spaced)) and made == b"".join(spaced):
            return np.diff(ends) == np.array([len(t) for t in spaced])
        bounds = ends.tolist()
        return np.array([made[a:b] == t for a, b, t in zip(bounds, bounds[1:], spaced)], bool)


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself where it is visible, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoders:
    """Both tokenizers of a worker."""

    LEAD = "\n"

    def __init__(self, files: tuple[str, bytes]) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        level, pieces = files
        a = Tokenizer.from_str(level)
        a.encode_special_tokens = True
        letters = _byte_letters()
        if a.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        names = [a.id_to_token(i) for i in range(a.get_vocab_size(with_added_tokens=True))]
        bytes_a = [bytes(letters[c] for c in n) if n is not None and all(c in letters for c in n) else b"" for n in names]
        encode_a = lambda texts: [e.ids for e in a.encode_batch_fast(texts, add_special_tokens=False)]
        b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        bytes_b = [self._piece(b, i) for i in range(len(b))]
        lead = len(b.encode(self.LEAD))

        def encode_b(texts: list[str]) -> list[list[int]]:
            # The tokenizer puts a space before each text itself. Where there is none, a line feed, which joins with
            # nothing, stands between.
            spaced = [t[0] == " " for t in texts]
            found = b.encode([t[1:] if own else self.LEAD + t for t, own in zip(texts, spaced)], num_threads=1)
            return [ids if own else ids[lead:] for ids, own in zip(found, spaced)]

        self.a = self._side(encode_a, bytes_a, runs=False)
        self.b = self._side(encode_b, bytes_b, runs=True)
        if self.b.inside[:, 0x20][np.arange(256) != 0x20].any() or self.b.inside[0x0A].any():
            raise ValueError("pieces with an inner space or line feed: chunks of this vocabulary depend on each other")

    @staticmethod
    def _piece(b, i: int) -> bytes:
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    @staticmethod
    def _side(encode, bytes_of: list[bytes], runs: bool) -> Side:
        lengths = np.array([len(x) for x in bytes_of], np.int64)
        return Side(Memo(lambda texts: flat(encode(texts))), lengths, bytes_of, neighbours(bytes_of), runs, lambda text: encode([text])[0])

    def __call__(self, texts: list[str | None]) -> Aligned:
        spaced = [b" " + t.encode() if t else b"" for t in texts]
        found = [self._encoded(side, spaced) for side in (self.a, self.b)]
        good = np.array([bool(t) for t in spaced], bool)
        for side, (ids, counts) in zip((self.a, self.b), found):
            good &= side.gives_back(ids, counts, spaced)
        kept = [(ids[np.repeat(good, counts)], np.where(good, counts, 0)) for ids, counts in found]
        return Aligned(*kept[0], *kept[1], self.a.lengths, self.b.lengths)

    def _encoded(self, side: Side, spaced: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = side.encode(spaced)
        if side.runs:
            return ids, counts
        # Texts with other kinds of white space are encoded whole.
        odd = [i for i, t in enumerate(spaced) if not t.isascii() and OTHER_SPACE.search(t.decode())]
        if odd:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i in odd:
                parts[i] = np.array(side.whole(spaced[i].decode()), np.int32)
            counts = np.array([len(p) for p in parts], np.int64)
            ids = np.concatenate(parts)
        return ids, counts


class Aligned:
    """Groups and links of some texts, from the ids of both sides and the length of each id."""

    def __init__(self, a, counts_a, b, counts_b, lengths_a, lengths_b) -> None:
        self.a, self.b, self.counts_a, self.counts_b = a, b, counts_a, counts_b
        ends_a, ends_b = np.cumsum(lengths_a[a]), np.cumsum(lengths_b[b])
        n = len(counts_a)
        # Both sides of a text end at the same byte, so one running count of bytes serves all texts.
        common_a = np.isin(ends_a, ends_b, assume_unique=True)
        self.last_a, self.last_b = common_a, np.isin(ends_b, ends_a, assume_unique=True)
        docs = np.repeat(np.arange(n), counts_a)
        self.n_groups = np.bincount(docs[common_a], minlength=n)
        segments = np.concatenate([ends_a, ends_b[~self.last_b]])
        segments.sort()
        at_a = np.searchsorted(ends_a, segments)
        self.links_a, self.links_b = a[at_a], b[np.searchsorted(ends_b, segments)]
        self.docs = docs[at_a] if len(docs) else np.zeros(0, np.int64)
        self.n_links = np.bincount(self.docs, minlength=n)

    def groups(self, texts_a: list[str], texts_b: list[str]) -> list[str]:
        """Every text's groups: its A ids, then its B ids, in order.

        ``texts_a`` holds each id with a comma, then each with a bar; ``texts_b`` with a comma, then with a semicolon.
        """
        group_a = np.cumsum(self.last_a) - self.last_a
        group_b = np.cumsum(self.last_b) - self.last_b
        n_groups = int(self.n_groups.sum())
        per_a, per_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        before_a, before_b = np.cumsum(per_a) - per_a, np.cumsum(per_b) - per_b
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + before_b[group_a]] = self.a + np.where(self.last_a, len(texts_a) // 2, 0)
        shift = len(texts_a) + np.where(self.last_b, len(texts_b) // 2, 0)
        codes[np.arange(len(self.b)) + (before_a + per_a)[group_b]] = self.b + shift
        texts = texts_a + texts_b
        written, ends = codes.tolist(), np.cumsum(self.counts_a + self.counts_b).tolist()
        return ["".join(map(texts.__getitem__, written[s:e]))[:-1] for s, e in zip([0, *ends], ends)]


def encoders(spark: SparkSession, byte_level: str, pieces: str) -> PerWorker:
    """The tokenizers of two vocabulary files, read on the driver (their size is fixed), for the tasks."""
    with open(byte_level, encoding="utf-8") as level, open(pieces, "rb") as model:
        return PerWorker(spark, (level.read(), model.read()), Encoders, keep=1)


# ---- runs


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers below 2**32 as one zstd block; bytes of one weight stand together."""
    planes = [x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for x in arrays]
    head = np.array([len(arrays), *map(len, arrays)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def unpack(block: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    sizes = np.frombuffer(raw, "<u4", n, 4).tolist()
    at, out = 4 * (n + 1), []
    for size in sizes:
        out.append(np.frombuffer(raw, np.uint8, 4 * size, at).reshape(4, size).T.copy().view("<u4").reshape(-1))
        at += 4 * size
    return out


def _pair(radix: int, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A and B ids of a run's pairs, in which the A id's lowest bits are left out."""
    return ((high >> 16) << RADIX_BITS) | radix, high & 0xFFFF


def runs_of(aligned_docs: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Radix, block of pairs and block of documents for every radix that a slice's links fall into.

    Pairs are differences in side-major order with their number of documents; documents are differences
    within a pair, with the number of occurrences. A and B ids have 16 bits.
    """
    a, b = a.astype(np.uint64), b.astype(np.uint64)
    key = ((a & np.uint64(RADIXES - 1)) << np.uint64(58)) | ((a >> np.uint64(RADIX_BITS)) << np.uint64(32)) | (b << np.uint64(16))
    key |= aligned_docs.astype(np.uint64)
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(key)))
    key = key[first]
    radix = (key >> np.uint64(58)).astype(np.int64)
    bounds = np.searchsorted(radix, np.arange(RADIXES + 1))
    for r in np.flatnonzero(np.diff(bounds)):
        own = slice(bounds[r], bounds[r + 1])
        high = ((key[own] >> np.uint64(16)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        doc = (key[own] & np.uint64(0xFFFF)).astype(np.int64)
        new = np.concatenate([[True], high[1:] != high[:-1]])
        starts = np.flatnonzero(new)
        step = np.diff(doc, prepend=0)
        step[starts] = doc[starts]
        yield int(r), pack(np.diff(high[starts], prepend=0), np.diff(np.append(starts, len(high)))), pack(step, times[own])


def merged(runs: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs in side-major order with their number of documents in all runs, block after block.

    A heap holds every run's next block by its last pair: what lies up to the least of these can't come again.
    """
    sources = [_blocks(block) for block in runs]
    heap: list[tuple[int, int]] = []
    held_pairs, held_counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for i, source in enumerate(sources):
        heap.append((-1, i))
    heapq.heapify(heap)
    arrived: list[tuple[np.ndarray, np.ndarray]] = []
    while heap:
        reached, i = heapq.heappop(heap)
        block = next(sources[i], None)
        if block is not None:
            arrived.append(block)
            heapq.heappush(heap, (int(block[0][-1]), i))
        bound = heap[0][0] if heap else None
        if arrived and (bound is None or bound > reached):
            pairs = np.concatenate([held_pairs, *[p for p, _ in arrived]])
            counts = np.concatenate([held_counts, *[c for _, c in arrived]])
            arrived = []
            pairs, counts = _summed(pairs, counts)
            done = len(pairs) if bound is None else int(np.searchsorted(pairs, bound, side="right"))
            if done:
                yield pairs[:done], counts[:done]
            held_pairs, held_counts = pairs[done:], counts[done:]
    if arrived or len(held_pairs):
        pairs = np.concatenate([held_pairs, *[p for p, _ in arrived]])
        yield _summed(pairs, np.concatenate([held_counts, *[c for _, c in arrived]]))


def _blocks(block: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    steps, counts = unpack(block)
    pairs = np.cumsum(steps.astype(np.int64))
    for start in range(0, len(pairs), FENCE):
        yield pairs[start:start + FENCE], counts[start:start + FENCE].astype(np.int64)


def _summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    return pairs[starts], np.add.reduceat(counts, starts)


# ---- jobs


def _aligned(
    batches: Iterator[pa.RecordBatch], make: Callable[[], Encoders], others: list[str], schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """A row for every document and a row for every run of a slice, told apart by ``_radix``."""
    encode = make()
    texts_a = [f"{i}{c}" for c in ",|" for i in range(len(encode.a.lengths))]
    texts_b = [f"{i}{c}" for c in ",;" for i in range(len(encode.b.lengths))]
    slice_id = TaskContext.get().partitionId() << 24
    links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = place = 0

    def runs() -> pa.RecordBatch:
        found = list(runs_of(*[np.concatenate(x) for x in zip(*links)]))
        values = {
            KEY: pa.array([slice_id << 16] * len(found), pa.int64()),
            "_radix": pa.array([r for r, _, _ in found], pa.int32()),
            "_pairs": pa.array([p for _, p, _ in found], pa.binary()), "_docs": pa.array([d for _, _, d in found], pa.binary()),
        }
        columns = [values.get(f.name, pa.nulls(len(found), f.type)) for f in schema]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for batch in batches:
        for part in (p.slice(i, SLICE_DOCS) for p in slices(batch, _TEXT, PART_BYTES) for i in range(0, p.num_rows, SLICE_DOCS)):
            bytes_ = pc.sum(pc.binary_length(part.column(_TEXT))).as_py() or 0
            if place and (size + bytes_ > SLICE_BYTES or place + part.num_rows > SLICE_DOCS):
                if links:
                    yield runs()
                slice_id, links, size, place = slice_id + 1, [], 0, 0
            found = encode(part.column(_TEXT).to_pylist())
            values = {
                KEY: pa.array((slice_id << 16) + place + np.arange(part.num_rows), pa.int64()),
                "n_a": pa.array(found.counts_a, pa.int64()), "n_b": pa.array(found.counts_b, pa.int64()),
                "n_groups": pa.array(found.n_groups, pa.int64()), "n_links": pa.array(found.n_links, pa.int64()),
                "groups": pa.array(found.groups(texts_a, texts_b), pa.string()),
            }
            columns = [
                values[f.name] if f.name in values else part.column(f.name) if f.name in others
                else pa.nulls(part.num_rows, f.type) for f in schema
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
            if len(found.docs):
                links.append((found.docs + place, found.links_a, found.links_b))
            size, place = size + bytes_, place + part.num_rows
    if links:
        yield runs()


_LOCAL = "a int, b int, n bigint"


def _counted(key: tuple, runs: pa.Table) -> pa.Table:
    """Pairs of one radix and salt with their number of documents."""
    found = list(merged(runs.column("_pairs").to_pylist()))
    pairs, counts = (np.concatenate(x) for x in zip(*found))
    a, b = _pair(key[0].as_py(), pairs)
    return pa.table({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "n": pa.array(counts, pa.int64())})


_GAINS = "slice bigint, block binary"


def _gained(key: tuple, runs: pa.Table, counts: pa.Table) -> pa.Table:
    """What the documents of each run gain by its radix: links that are best, and the sum of the links' counts."""
    a, b = counts.column("a").to_numpy().astype(np.int64), counts.column("b").to_numpy().astype(np.int64)
    known = ((a >> RADIX_BITS) << 16) | b
    order = np.argsort(known)
    known, count = known[order], counts.column("n_docs").to_numpy()[order]
    best = counts.column("best").to_numpy(zero_copy_only=False)[order]
    blocks = []
    for pairs, docs in zip(runs.column("_pairs").to_pylist(), runs.column("_docs").to_pylist()):
        (steps, n), (moves, times) = unpack(pairs), unpack(docs)
        at = np.repeat(np.searchsorted(known, np.cumsum(steps.astype(np.int64))), n)
        place = np.cumsum(moves.astype(np.int64))
        # Each pair's documents begin anew.
        starts = np.cumsum(n.astype(np.int64)) - n
        place -= np.repeat(np.where(starts > 0, place[starts - 1], 0), n)
        times = times.astype(np.int64)
        gains = np.bincount(place, times * count[at]).astype(np.int64)
        bests = np.bincount(place, times * best[at]).astype(np.int64)
        own = np.flatnonzero(np.bincount(place))
        gain = gains[own]
        blocks.append(pack(np.diff(own, prepend=0), bests[own], gain & 0xFFFFFFFF, gain >> 32))
    return pa.table({"slice": runs.column("slice"), "block": pa.array(blocks, pa.binary())})


_SCORES = f"{KEY} bigint, n_best bigint, count_sum bigint"


def _scored(key: tuple, gains: pa.Table) -> pa.Table:
    """The documents of one slice, from at most a block for each radix."""
    best, total = np.zeros(SLICE_DOCS, np.int64), np.zeros(SLICE_DOCS, np.int64)
    seen = np.zeros(SLICE_DOCS, bool)
    for block in gains.column("block").to_pylist():
        steps, bests, low, high = (x.astype(np.int64) for x in unpack(block))
        own = np.cumsum(steps)
        best[own] += bests
        total[own] += low | (high << 32)
        seen[own] = True
    own = np.flatnonzero(seen)
    return pa.table({
        KEY: pa.array((key[0].as_py() << 16) + own, pa.int64()), "n_best": pa.array(best[own]),
        "count_sum": pa.array(total[own])})


@dataclass(frozen=True)
class Alignment:
    """``documents``: their columns without the text, a key, ``n_a``, ``n_b``, ``n_groups``, ``n_links`` and ``groups``.

    ``pairs``: ``a``, ``b``, ``n_docs`` and whether no other pair of the A id has more (``best``). ``contributions``: by
    document key, ``n_best`` and ``count_sum``.
    """

    documents: DataFrame
    pairs: DataFrame
    contributions: DataFrame

    def with_contributions(self, rows: DataFrame) -> DataFrame:
        """Rows with the key of a document and what its links are worth."""
        gains = self.contributions.withColumnRenamed(KEY, "_gains_of")
        found = rows.join(gains, F.col(KEY) == F.col("_gains_of"), "left").drop("_gains_of")
        return found.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")})


def align(docs: DataFrame, encoders: PerWorker, staging: Staging, *, text: str = "text") -> Alignment:
    """Alignment of every text under both tokenizers, and the corpus-wide counts of their links."""
    others = [c for c in docs.columns if c != text and c not in MADE]
    schema = T.StructType([
        *[T.StructField(c, docs.schema[c].dataType) for c in others], T.StructField(KEY, T.LongType()),
        *[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("groups", T.StringType()),
        T.StructField("_radix", T.IntegerType()), T.StructField("_pairs", T.BinaryType()), T.StructField("_docs", T.BinaryType()),
    ])
    rows = docs.select(*others, F.col(text).alias(_TEXT))
    work = partial(_aligned, make=encoders, others=others, schema=to_arrow_schema(schema))
    path = staging.path("aligned")
    rows.mapInArrow(work, schema).write.mode("overwrite").option("compression", "zstd").parquet(path)
    stored = docs.sparkSession.read.schema(schema).parquet(path)
    documents = stored.where(F.col("_radix").isNull()).select(*others, KEY, *_COUNTS, "groups")
    runs = stored.where(F.col("_radix").isNotNull()).select(
        "_radix", F.shiftright(KEY, 16).alias("slice"), "_pairs", "_docs")
    sizes = runs.groupBy("_radix").agg(F.sum(F.octet_length("_pairs") + F.octet_length("_docs"))).collect()  # RADIXES rows
    salts = {r: max(1, math.ceil((n or 0) / SALT_BYTES)) for r, n in sizes}
    n_salts = F.element_at(F.array(*[F.lit(salts.get(r, 1)) for r in range(RADIXES)]), F.col("_radix") + 1)
    runs = runs.withColumn("salt", F.pmod(F.xxhash64("slice"), n_salts))
    local = runs.select("_radix", "salt", "_pairs").groupBy("_radix", "salt").applyInArrow(_counted, _LOCAL)
    summed = staging.table(local.groupBy("a", "b").agg(F.sum("n").alias("n_docs")))
    most = summed.groupBy("a").agg(F.max("n_docs").alias("_most"))
    pairs = staging.table(summed.join(most, "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("_most")).alias("best")))
    radix = F.col("a").bitwiseAND(RADIXES - 1)
    spread = pairs.withColumn("_radix", radix).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), n_salts.cast("bigint") - 1)))
    gains = runs.withColumn("salt", F.col("salt").cast("bigint")).groupBy("_radix", "salt").cogroup(
        spread.groupBy("_radix", "salt")).applyInArrow(_gained, _GAINS)
    scores = staging.table(gains.groupBy("slice").applyInArrow(_scored, _SCORES))
    return Alignment(documents, pairs, scores)
