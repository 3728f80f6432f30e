"""Masked pseudo-likelihood of documents under a bidirectional window network.

Words (lower case, split at ASCII white space) become symbols: the most frequent words of the whole corpus have one each,
all others share ``BUCKETS`` by their hash and are told apart in their bucket by their counts. The network predicts a symbol from the two symbols on either side of it,
never from itself: embeddings by side and distance are summed, pass tanh, and give the symbol's class and its place in
the class (a softmax in two levels). The probability of a word in a bucket is that of the bucket times the word's share of
the bucket's words, which Spark joins from the counts of all words. A document's score is the sum of the log-probabilities of all of its words, each
given its neighbours; where a document ends, a symbol of its own stands in.

**Training** is spread over the cluster and reads every document. In each round every task starts from the round's
network, passes over its documents once and gives its network and the number of words it masked. A pass masks every
``MASK``-th word at a time, from the offsets of its round; the rounds share the ``MASK`` offsets, so that together they
predict every word of every document. Networks are averaged by those numbers, part by part, in two levels, so that no task and not the driver
sees more than one network at a time. Word counts are summed over all documents by Spark. A word that training has not seen
counts as one more word of its bucket.

Null and empty texts have no words, a sum of 0 and no mean. Rows are scored one by one; ids are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.llm.common import PerWorker, Work, append_columns, slices
from clinspark.staging import Staging

CLASSES = 64
SYMBOLS = CLASSES * CLASSES
BUCKETS = 256
WIDTH = 24
OFFSETS = (-2, -1, 1, 2)
MASK = 8
ROUNDS = 2
RATE = 0.3
BATCH = 4096
_EDGE = SYMBOLS
#: The columns of stored symbols (two bytes a word), of the hashes of words in buckets, and of the bytes of the text.
_STORED, _RARE, _SIZE = "__symbols", "__rare", "__size"
_ONES = np.ones((CLASSES, 1), np.float32)
#: Logits up to this size need no shift to be exponentiated in 32 bits.
_SAFE = 60.0
#: Rows of a key that are added without a reduction of its own.
_FEW = 8
#: Numbers of a network that are averaged together.
_PART = 1 << 14
#: Networks that the first level of averaging brings together.
_FAN = 64


def split_words(texts: list[str | None]) -> tuple[np.ndarray, pa.Array]:
    """Words per text, and the words of all texts in one array."""
    raw = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    joined = np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)
    space = (joined == 32) | (joined - np.uint8(9) < 5)
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    firsts = np.cumsum([1, *(len(r) + 1 for r in raw)])
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined[~space])])
    return np.diff(np.searchsorted(starts, firsts)), words


def bucket_of(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode()) % BUCKETS


def known_and_rare(words: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.DictionaryArray]:
    """The place of each word among the known ones (-1 without one), where the others stand, and these with a dictionary."""
    number = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    rare = number < 0
    return number, np.flatnonzero(rare), words.filter(pa.array(rare)).dictionary_encode()


def word_hash(words: pa.Array) -> np.ndarray:
    """The hash that names a word in joins; its remainder is the word's bucket."""
    words = words.cast(pa.large_string())
    if not len(words):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1].tolist()
    raw = memoryview(words.buffers()[2] or b"")
    return np.fromiter((xxhash.xxh64_intdigest(raw[a:b]) for a, b in zip(ends, ends[1:])), np.uint64, len(words))


@dataclass
class Network:
    """Symbols of words and all weights as one vector of 32-bit numbers.

    ``shares`` holds ``word, bucket, n`` (the word's hash) of every word in a bucket (without it a bucket counts as one word), and
    ``totals`` the words of each bucket; workers get the network without them.
    """

    words: pa.Array
    weights: np.ndarray
    shares: DataFrame | None = field(default=None, repr=False, compare=False)
    totals: dict[int, int] = field(default_factory=dict, repr=False, compare=False)

    def alone(self) -> Network:
        return Network(self.words, self.weights)

    @staticmethod
    def shapes() -> list[tuple[int, ...]]:
        """Of the blocks of the vector; the last row of a softmax holds its biases."""
        return [(len(OFFSETS), SYMBOLS + 1, WIDTH), (WIDTH,), (WIDTH + 1, CLASSES), (CLASSES, WIDTH + 1, CLASSES)]

    @classmethod
    def start(cls, words: list[str], counts: list[int], total: int) -> Network:
        """Small random weights; the biases are the frequencies of the symbols."""
        random = np.random.default_rng(1)
        network = cls(pa.array(words, pa.large_string()), np.zeros(sum(int(np.prod(s)) for s in cls.shapes()), np.float32))
        parts = network.views()
        for i in (0, 2, 4):
            parts[i][:] = random.normal(0, 0.1, parts[i].shape).astype(np.float32)
        often = np.full(SYMBOLS, 0.5)
        often[:len(words)] += counts
        often[-BUCKETS:] += (total - sum(counts)) / BUCKETS
        often = often.reshape(CLASSES, CLASSES)
        parts[3][:], parts[5][:] = np.log(often.sum(axis=1) / often.sum()), np.log(often / often.sum(axis=1, keepdims=True))
        return network

    def blocks(self, weights: np.ndarray | None = None) -> list[np.ndarray]:
        weights, found, at = self.weights if weights is None else weights, [], 0
        for shape in self.shapes():
            size = int(np.prod(shape))
            found.append(weights[at:at + size].reshape(shape))
            at += size
        return found

    def views(self) -> list[np.ndarray]:
        """Embeddings and their bias, the classes' weights and biases, and those of the places in each class."""
        embed, bias, kinds, places = self.blocks()
        return [embed, bias, kinds[:-1], kinds[-1], places[:, :-1], places[:, -1]]

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words per text, the symbols of the words of all texts, and the hashes of those words that share buckets."""
        counts, words = split_words(texts)
        number, rare, coded = known_and_rare(words, self.words)
        hashes = word_hash(coded.dictionary).take(coded.indices.to_numpy(zero_copy_only=False))
        number[rare] = SYMBOLS - BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64)
        return counts, number, hashes

    def symbols(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words per text; the symbols of all texts with two edges around each; the places of the words in them."""
        return with_edges(*self.numbers(texts)[:2])

    def log_probabilities(self, line: np.ndarray, places: np.ndarray, block: int = BATCH) -> np.ndarray:
        """Of the symbol at each place, given those around it."""
        out, forward = np.zeros(len(places)), Forward(self, block)
        for start in range(0, len(places), block):
            at = places[start:start + block]
            order = by_class(line, at)
            kind, _, inner, _ = forward.run(line, at[order])
            out[start + order] = log_softmax_at(forward.outer, kind) + log_softmax_at(forward.inner, inner)
        return out


def with_edges(counts: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    places = np.arange(len(number)) + np.repeat(2 * (np.arange(len(counts)) + 1), counts)
    line = np.full(len(number) + 2 * len(counts) + 2, _EDGE, np.int64)
    if len(places):
        line[places] = number
    return counts, line, places


def stored_symbols(stored: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``Network.symbols``, from what ``encode`` made of the texts."""
    counts = np.fromiter(map(len, stored), np.int64, len(stored)) // 2
    return with_edges(counts, np.frombuffer(b"".join(stored), "<u2"))


def by_class(line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Order that brings classes together, for whole products."""
    return np.argsort((line.take(at) // CLASSES).astype(np.uint8), kind="stable")


def kind_slices(kind: np.ndarray) -> list[tuple[int, slice]]:
    """The classes among sorted ones, and their rows."""
    ends = np.cumsum(np.bincount(kind, minlength=CLASSES)).tolist()
    return [(c, slice(a, b)) for c, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]


class Forward:
    """From places to the logits of both softmaxes, in arrays that are used again and again.

    Fresh arrays of this size cost more than what is computed in them, since their pages come from the system each time.
    """

    def __init__(self, network: Network, rows: int) -> None:
        self.blocks = network.blocks()
        self.held: dict[str, np.ndarray] = {}
        self.rows = rows

    def array(self, name: str, rows: int, width: int, kind: type = np.float32) -> np.ndarray:
        held = self.held.get(name)
        if held is None or len(held) < rows:
            held = self.held[name] = np.empty((max(rows, self.rows), width), kind)
        return held[:rows]

    def run(self, line: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, slice]]]:
        """Classes, symbols around (by offset), places in the classes, and rows of each class; ``at`` is sorted by class."""
        embed, bias, kinds, places = self.blocks
        n, target = len(at), line.take(at)
        kind = target // CLASSES
        around = np.stack([line.take(at + o) for o in OFFSETS])
        total, more = self.array("total", n, WIDTH), self.array("more", n, WIDTH)
        embed[0].take(around[0], axis=0, out=total, mode="clip")
        total += bias
        for k in range(1, len(OFFSETS)):
            embed[k].take(around[k], axis=0, out=more, mode="clip")
            total += more
        self.h = self.array("h", n, WIDTH + 1)  # with a 1 for the biases
        np.tanh(total, out=self.h[:, :-1])
        self.h[:, -1] = 1
        self.outer, self.inner = self.array("outer", n, CLASSES), self.array("inner", n, CLASSES)
        np.matmul(self.h, kinds, out=self.outer)
        classes = kind_slices(kind)
        for c, own in classes:
            np.matmul(self.h[own], places[c], out=self.inner[own])
        bounded(self.outer, kinds)
        bounded(self.inner, places)
        return kind, around, target % CLASSES, classes


def bounded(logits: np.ndarray, weights: np.ndarray) -> None:
    """Shifts rows, in place, unless the weights tell that no power overflows: hidden values are at most 1."""
    if not np.abs(weights).sum(axis=-2).max() <= _SAFE:
        logits -= logits.max(axis=1, keepdims=True)


def log_softmax_at(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    chosen = logits[np.arange(len(target)), target]
    np.exp(logits, out=logits)
    return chosen - np.log(logits @ _ONES)[:, 0]


def softmax_error(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Mean over the rows of the loss, derived by the logits, in their place but for the factors of rows that it returns."""
    np.exp(logits, out=logits)
    sums = logits @ _ONES
    logits[np.arange(len(target)), target] -= sums[:, 0]
    return 1 / (np.float32(len(target)) * sums)


def sums_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, and the sum of its rows of ``values``, which are repeated for every ``len(values)`` keys.

    Few rows are added one place at a time for all keys together, since a reduction by itself for a key takes longer than they do.
    """
    order = np.argsort(keys.astype(np.uint16), kind="stable")
    keys = keys.take(order)
    order %= len(values)
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    lengths = np.diff(starts, append=len(keys))
    by = np.argsort(np.minimum(lengths, _FEW + 1).astype(np.uint8), kind="stable")[::-1]
    starts, lengths = starts.take(by), lengths.take(by)
    many = int(np.count_nonzero(lengths > _FEW))
    found = np.empty((len(starts), values.shape[1]), values.dtype)
    if many:
        ends = np.cumsum(lengths[:many])
        at = np.arange(ends[-1]) + np.repeat(starts[:many] - ends + lengths[:many], lengths[:many])
        # Pairs of numbers are added as one complex number: half as many reductions.
        rows = values.take(order.take(at), axis=0).view(np.complex64)
        found[:many] = np.add.reduceat(rows, ends - lengths[:many]).view(values.dtype)
    few, at = found[many:], starts[many:]
    few[:] = values.take(order.take(at), axis=0)
    for place in range(1, _FEW):
        more = int(np.count_nonzero(lengths[many:] > place))
        few[:more] += values.take(order.take(at[:more] + place), axis=0)
    return keys.take(starts), found


class Trainer:
    """One pass of adaptive gradient steps over masked words."""

    def __init__(self, network: Network, rate: float = RATE) -> None:
        self.network = Network(network.words, network.weights.copy())
        self.views, self.blocks = self.network.views(), self.network.blocks()
        self.square_blocks = self.network.blocks(np.full(len(network.weights), 1e-3, np.float32))
        self.rate, self.masked = np.float32(rate), 0
        self.forward = Forward(self.network, BATCH)
        self.inner, self.spare = np.zeros_like(self.blocks[3]), np.empty_like(self.blocks[3])

    def move(self, block: int, gradient: np.ndarray) -> None:
        squares, spare = self.square_blocks[block], self.spare.reshape(-1)[:gradient.size].reshape(gradient.shape)
        np.multiply(gradient, gradient, out=spare)
        squares += spare
        np.sqrt(squares, out=spare)
        np.divide(gradient, spare, out=spare)
        spare *= self.rate
        self.blocks[block] -= spare

    def move_rows(self, rows: np.ndarray, gradient: np.ndarray) -> None:
        """Of the embeddings, those of all offsets counted on."""
        weights, squares = (b[0].reshape(-1, WIDTH) for b in (self.blocks, self.square_blocks))
        own = squares.take(rows, axis=0)
        own += gradient * gradient
        squares[rows] = own
        np.sqrt(own, out=own)
        np.divide(gradient, own, out=own)
        own *= self.rate
        weights[rows] = weights.take(rows, axis=0) - own

    def step(self, line: np.ndarray, at: np.ndarray) -> None:
        at, forward = at[by_class(line, at)], self.forward
        kind, around, inner, classes = forward.run(line, at)
        n, h, outside, inside = len(at), forward.h, forward.outer, forward.inner
        scaled, back, more = forward.array("scaled", n, WIDTH + 1), forward.array("back", n, WIDTH), forward.array("more", n, WIDTH)
        factor = softmax_error(outside, kind)
        np.matmul(outside, self.blocks[2][:-1].T, out=back)
        back *= factor
        np.multiply(h, factor, out=scaled)
        outer_gradient = scaled.T @ outside
        factor = softmax_error(inside, inner)
        np.multiply(h, factor, out=scaled)
        if len(classes) < CLASSES:
            self.inner[:] = 0
        for c, own in classes:
            np.matmul(inside[own], self.blocks[3][c, :-1].T, out=more[own])
            np.matmul(scaled[own].T, inside[own], out=self.inner[c])
        more *= factor
        back += more
        self.move(3, self.inner)
        self.move(2, outer_gradient)
        np.multiply(h[:, :-1], h[:, :-1], out=more)
        np.subtract(1, more, out=more)
        back *= more
        self.move(1, np.ones(n, np.float32) @ back)
        around += (np.arange(len(OFFSETS)) * (SYMBOLS + 1))[:, None]
        self.move_rows(*sums_by(around.ravel(), back))
        self.masked += n

    def learn(self, line: np.ndarray, places: np.ndarray, batch: int = BATCH) -> None:
        for start in range(0, len(places), batch):
            self.step(line, places[start:start + batch])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            _, words = split_words(part.column("text").to_pylist())
            found = words.value_counts()
            yield pa.RecordBatch.from_arrays(
                [found.field("values").cast(pa.string()), found.field("counts")], names=["word", "n"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = word_hash(batch.column("word"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array((found % np.uint64(BUCKETS)).astype(np.int64)), batch.column("n")],
            names=["word", "bucket", "n"])


def offsets_of(turn: int, rounds: int) -> range:
    """What a round masks; the rounds mask each offset once, or again if there are more rounds than offsets."""
    return range(turn % MASK, MASK, rounds)


def _train(batches: Iterator[pa.RecordBatch], sent: PerWorker, offsets: range) -> Iterator[pa.RecordBatch]:
    trainer = Trainer(sent())
    for batch in batches:
        # Steps come in the same order from texts and from what is stored of them.
        column, size, read = ("text", "text", trainer.network.symbols) if "text" in batch.schema.names else (
            _STORED, _SIZE, stored_symbols)
        for part in slices(batch, size):
            _, line, places = read(part.column(column).to_pylist())
            for offset in offsets:
                trainer.learn(line, places[offset::MASK])
    if trainer.masked:
        yield from _parts(trainer.network.weights, trainer.masked, TaskContext.get().partitionId() // _FAN)


def _parts(weights: np.ndarray, masked: float, group: int) -> Iterator[pa.RecordBatch]:
    cuts = range(0, len(weights), _PART)
    yield pa.RecordBatch.from_arrays([
        pa.array([group] * len(cuts), pa.int64()), pa.array(range(len(cuts)), pa.int64()),
        pa.array([float(masked)] * len(cuts)),
        pa.array([weights[c:c + _PART].astype("<f4").tobytes() for c in cuts], pa.binary()),
    ], names=["level", "part", "masked", "weights"])


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weighted mean of each part; rows come sorted and one is added at a time."""
    def emit() -> pa.RecordBatch:
        mean = (total / masked).astype("<f4").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0] // _FAN], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([masked]),
             pa.array([mean], pa.binary())], names=["level", "part", "masked", "weights"])

    key, total, masked = None, None, 0.0
    for batch in batches:
        for level, part, n, raw in zip(*(batch.column(c).to_pylist() for c in ("level", "part", "masked", "weights"))):
            weights = np.frombuffer(raw, "<f4").astype(np.float64)
            if key != (level, part):
                if key is not None:
                    yield emit()
                key, total, masked = (level, part), np.zeros(len(weights)), 0.0
            total += n * weights
            masked += n
    if key is not None:
        yield emit()


_PARTS = "level bigint, part bigint, masked double, weights binary"


def vocabulary(docs: DataFrame, staging: Staging, *, text: str = "text") -> Network:
    """The network before training: its symbols, and the counts of all words."""
    counts = docs.select(F.col(text).alias("text")).mapInArrow(_count, "word string, n bigint").groupBy("word").agg(
        F.sum("n").alias("n"))
    counts = staging.table(counts)
    # A vocabulary of fixed size.
    known = counts.orderBy(F.desc("n"), "word").limit(SYMBOLS - BUCKETS).collect()
    total = counts.agg(F.sum("n")).first()[0] or 0
    network = Network.start([r["word"] for r in known], [r["n"] for r in known], total)
    rest = counts
    if known:  # the words that come after the last one
        last, word = known[-1]["n"], known[-1]["word"]
        rest = counts.where((F.col("n") < last) | ((F.col("n") == last) & (F.col("word") > word)))
    shares = staging.table(rest.mapInArrow(_hashed, "word bigint, bucket bigint, n bigint"))
    totals = shares.groupBy("bucket").agg(F.sum("n").alias("total"))
    totals = {r["bucket"]: r["total"] for r in totals.collect()}  # at most BUCKETS rows
    return Network(network.words, network.weights, shares, totals)


def _encoded(sent: PerWorker) -> Work:
    network = sent()

    def work(texts: list[str | None]) -> list:
        counts, number, hashes = network.numbers(texts)
        raw, ends = number.astype("<u2").tobytes(), np.cumsum(counts)
        rare = np.concatenate([[0], np.cumsum(number >= SYMBOLS - BUCKETS)])[np.concatenate([[0], ends])]
        return [[raw[2 * a:2 * b] for a, b in zip([0, *ends.tolist()], ends.tolist())],
                pa.ListArray.from_arrays(pa.array(rare, pa.int32()), pa.array(hashes.view(np.int64)))]

    return work


def encode(docs: DataFrame, network: Network, *, text: str = "text") -> DataFrame:
    """``docs`` with three columns in the place of the text: its symbols, the hashes of its words in buckets, and its size."""
    sent = PerWorker(docs.sparkSession, network.alone(), _same)
    fields = [T.StructField(text, T.BinaryType()), T.StructField(_RARE, T.ArrayType(T.LongType(), False))]
    sized = docs.withColumn(_SIZE, F.octet_length(text).cast("long"))
    return append_columns(sized, text, fields, partial(_encoded, sent)).withColumnRenamed(text, _STORED)


def learn(encoded: DataFrame, network: Network, staging: Staging, rounds: int = ROUNDS) -> Network:
    """The network after ``rounds`` passes over all stored symbols."""
    shares, totals, lines = network.shares, network.totals, encoded.select(_STORED, _SIZE)
    for turn in range(rounds):
        sent = PerWorker(encoded.sparkSession, network.alone(), _same)
        found = lines.mapInArrow(partial(_train, sent=sent, offsets=offsets_of(turn, rounds)), _PARTS)
        for level in ("group", "all"):
            key = F.col("level") if level == "group" else F.lit(0)
            found = found.withColumn("level", key).repartition("level", "part").sortWithinPartitions(
                "level", "part", "masked", F.xxhash64("weights")).mapInArrow(_average, _PARTS)
        parts = {r["part"]: r["weights"] for r in staging.table(found).collect()}  # one network
        if parts:
            weights = np.frombuffer(b"".join(parts[p] for p in sorted(parts)), "<f4").copy()
            network = Network(network.words, weights)
    return Network(network.words, network.weights, shares, totals)


def train(docs: DataFrame, staging: Staging, *, text: str = "text", rounds: int = ROUNDS) -> Network:
    """The network after ``rounds`` passes over all documents, which together predict each word at least once."""
    network = vocabulary(docs, staging, text=text)
    return learn(staging.table(encode(docs.select(text), network, text=text).drop(_RARE)), network, staging, rounds)


def train_and_score(docs: DataFrame, staging: Staging, *, text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``score`` of the documents that the network is trained on, but without their texts: words are looked up once and stored."""
    network = vocabulary(docs, staging, text=text)
    # The numbers of rows are stored with them, so that they stay.
    encoded = staging.table(encode(docs.withColumn("__row", F.monotonically_increasing_id()), network, text=text))
    network = learn(encoded, network, staging, rounds)
    return _with_shares(_scored(encoded.drop(_RARE, _SIZE), _STORED, network).drop(_STORED), word_shares(encoded, network, ["__row"]))


def _same(network: Network) -> Network:
    return network


def _scores(sent: PerWorker, stored: bool) -> Work:
    network = sent()

    def work(texts: list[str | None] | list[bytes]) -> list[list]:
        counts, line, places = (stored_symbols if stored else network.symbols)(texts)
        sums, rare = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        full = np.flatnonzero(counts)
        if len(full):
            starts = (np.cumsum(counts) - counts)[full]
            sums[full] = np.add.reduceat(network.log_probabilities(line, places), starts)
            rare[full] = np.add.reduceat((line[places] >= SYMBOLS - BUCKETS).astype(np.int64), starts)
        return [counts.tolist(), sums.tolist(), rare.tolist()]

    return work


def word_shares(encoded: DataFrame, network: Network, keys: list[str]) -> DataFrame:
    """``keys`` and ``__share``: the mean, over the words in buckets of the rows with these keys, of the logarithm of their shares."""
    # One row a bucket: a bounded table.
    logs = F.broadcast(encoded.sparkSession.createDataFrame(
        [(b, float(np.log(n)), float(np.log(n + 1))) for b, n in sorted(network.totals.items())],
        "bucket bigint, log_total double, log_more double"))
    known = network.shares.join(logs, "bucket").select("word", (F.log("n") - F.col("log_total")).alias("log_share"))
    # Each word is known once, so a partition of them is hashed and the many rows are not sorted. BUCKETS divides 2 ** 64,
    # so the remainder of the signed hash is the bucket too.
    joined = encoded.select(*keys, F.explode(_RARE).alias("word")).join(known.hint("shuffle_hash"), "word", "left").withColumn(
        "bucket", F.pmod("word", F.lit(BUCKETS))).join(logs, "bucket", "left")
    return joined.groupBy(*keys).agg(F.avg(F.coalesce("log_share", -F.col("log_more"), F.lit(0.0))).alias("__share"))


def _scored(docs: DataFrame, text: str, network: Network) -> DataFrame:
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("log_likelihood", T.DoubleType()),
              T.StructField("__n_rare", T.LongType())]
    sent = PerWorker(docs.sparkSession, network.alone(), _same)
    return append_columns(docs.drop("mean_log_likelihood"), text, fields, partial(_scores, sent, text == _STORED))


def _with_shares(scored: DataFrame, shares: DataFrame) -> DataFrame:
    keys = shares.columns[:-1]
    return _with_mean(scored.join(shares, keys, "left").withColumn(
        "log_likelihood", F.col("log_likelihood") + F.col("__n_rare") * F.coalesce("__share", F.lit(0.0))
    ).drop(*keys, "__n_rare", "__share"))


def _with_mean(found: DataFrame) -> DataFrame:
    return found.withColumn("mean_log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))


def score(docs: DataFrame, network: Network, *, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``log_likelihood`` (the sum) and ``mean_log_likelihood`` (null without words)."""
    if network.shares is None:
        return _with_mean(_scored(docs, text, network).drop("__n_rare"))
    # The hashes of a text stand for it: copies have the same mean.
    hashes = [F.xxhash64(text).alias("__text_h"), F.xxhash64(F.lit("g"), F.col(text)).alias("__text_g")]
    encoded = encode(docs.where(F.col(text).isNotNull()).select(*hashes, text), network, text=text)
    return _with_shares(_scored(docs.select("*", *hashes), text, network), word_shares(encoded, network, ["__text_h", "__text_g"]))
