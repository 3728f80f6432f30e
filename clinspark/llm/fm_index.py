"""Benchmark decontamination with an FM-index for each shard of the training documents.

A task joins the words of its documents into shards of about ``SHARD_WORDS`` words, builds an FM-index of
each (suffix array by prefix doubling, Burrows-Wheeler transform in a wavelet matrix, every
``SAMPLE``-th suffix position), searches all test phrases backwards at once, locates their occurrences by
walking to the next sampled position, and merges them into removal spans.

Words are maximal runs of ASCII letters and digits and of all characters beyond ASCII, in lower case as far
as A-Z go. A phrase is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
phrase. A word is hit if it lies in any occurrence of any phrase. An occurrence lies within one document.

Null texts have no words and give a row; null or empty items give no phrase; items with one id count once, and
a null id is not listed, though its phrases are removed. Documents are never joined to phrases by a shuffle,
so copies and hot sources need no care. A document's words are indexed together, however long it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.llm.common import SLICE_BYTES, PerWorker, slices

SHARD_WORDS = 800_000
SAMPLE = 16
WINDOW = 10
#: Characters of benchmark text that are sent to the executors at once; more is sent in more blocks.
BLOCK_CHARS = 16_000_000

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
_UPPER = {i: i + 32 for i in range(65, 91)}

LEAK = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()),
    ]))),
    T.StructField("clean", T.StringType()),
])


def split_words(texts: list[str | None]) -> tuple[np.ndarray, pa.Array]:
    """Words per text, and the words of all texts in one array."""
    folded = [(t or "").encode("utf-8", "replace").translate(_FOLD).strip() for t in texts]
    counts = np.zeros(len(texts), np.int64)
    full = [i for i, f in enumerate(folded) if f]
    lists = pc.ascii_split_whitespace(pa.array([folded[i] for i in full], pa.large_binary()).cast(pa.large_string()))
    counts[full] = lists.value_lengths().to_numpy(zero_copy_only=False) if full else 0
    return counts, lists.flatten()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order, by prefix doubling over those that are not unique yet."""
    n = len(text)
    bits = max(n, int(text.max(initial=0)) + 1).bit_length()
    rank = np.zeros(2 * n + 1, np.int64)  # what lies beyond the end is lowest
    rank[:n] = text.astype(np.int64) + 1
    order = np.arange(n, dtype=np.int64)
    places, step = order.copy(), 1
    while len(places):
        todo = order[places]
        first, second = rank[todo], rank[np.minimum(todo + step, n)]
        if 3 * bits + 1 <= 63:
            packed = np.sort((first << (2 * bits + 1)) | (second << bits) | todo)
            todo = packed & ((1 << bits) - 1)
            key = packed >> bits
            new = np.flatnonzero(np.diff(key)) + 1
        else:
            by = np.lexsort((todo, second, first))
            todo, first, second = todo[by], first[by], second[by]
            new = np.flatnonzero((np.diff(first) != 0) | (np.diff(second) != 0)) + 1
        order[places] = todo
        starts = np.concatenate(([0], new))
        sizes = np.diff(np.append(starts, len(todo)))
        rank[todo] = np.repeat(places[starts], sizes) + 1
        places, step = places[np.repeat(sizes > 1, sizes)], step * 2
    return order


class Bits:
    """A bit vector with constant-time counts of its ones."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.ones = int(ones.sum())

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before ``i``."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class Wavelet:
    """Wavelet matrix of symbols: ranks of any symbol, and the symbol at any place."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        self.height = max(1, (sigma - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for level in reversed(range(self.height)):
            bit = ((symbols >> level) & 1).astype(bool)
            self.levels.append((Bits(bit), int(len(bit) - np.count_nonzero(bit))))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for at, (bits, zeros) in enumerate(self.levels):
            ones = bits.rank(i)
            i = np.where((symbol >> (self.height - 1 - at)) & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before place ``i``."""
        return self.down(symbol, i) - self.down(symbol, np.zeros_like(i))

    def access(self, i: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(i)
        for bits, zeros in self.levels:
            bit, ones = bits.get(i), bits.rank(i)
            symbol = symbol << 1 | bit
            i = np.where(bit, zeros + ones, i - ones)
        return symbol


class FMIndex:
    """Counts and locates patterns of symbols; symbol 0 is kept for the ends of documents."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = SAMPLE) -> None:
        order = suffix_array(text)
        self.n = len(text)
        self.wavelet = Wavelet(text[order - 1], sigma)
        counts = np.bincount(text, minlength=sigma)
        self.smaller = np.concatenate(([0], np.cumsum(counts)))
        marked = order % sample == 0
        self.marks, self.samples = Bits(marked), order[marked]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ``patterns`` the range of its suffixes, found from its last symbol to its first."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        alive = np.arange(len(patterns))
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, column]
            start = self.smaller[symbol]
            a, b = self.wavelet.rank(symbol, low[alive]), self.wavelet.rank(symbol, high[alive])
            low[alive], high[alive] = start + a, start + b
            alive = alive[a < b]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps to the left until a sampled one."""
        found, steps = np.zeros(len(rows), np.int64), 0
        todo, at = np.arange(len(rows)), rows
        while len(todo):
            marked = self.marks.get(at).astype(bool)
            found[todo[marked]] = self.samples[self.marks.rank(at[marked])] + steps
            todo, at = todo[~marked], at[~marked]
            symbol = self.wavelet.access(at)
            at = self.smaller[symbol] + self.wavelet.rank(symbol, at)
            steps += 1
        return found


@dataclass
class Phrases:
    """Distinct phrases by length, as numbers of ``words``, and the items each belongs to."""

    words: pa.Array
    by_length: list[tuple[np.ndarray, list[tuple[int, ...]]]]
    ids: list[str | None]


def phrases(items: list[tuple[str | None, str | None]], window: int) -> Phrases:
    counts, words = split_words([text for _, text in items])
    coded = words.dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ids = list(dict.fromkeys(item for item, _ in items))
    of = {item: n for n, item in enumerate(ids)}
    found: dict[tuple[int, ...], set[int]] = {}
    start = 0
    for (item, _), count in zip(items, counts.tolist()):
        own = numbers[start:start + count].tolist()
        start += count
        for at in range(max(1, count - window + 1) if count else 0):
            found.setdefault(tuple(own[at:at + window]), set()).add(of[item])
    lengths: dict[int, list[tuple[int, ...]]] = {}
    for phrase in found:
        lengths.setdefault(len(phrase), []).append(phrase)
    return Phrases(coded.dictionary, [
        (np.array(group, np.int64), [tuple(sorted(found[p])) for p in group]) for group in lengths.values()
    ], ids)


def occurrences(index: FMIndex, number: np.ndarray, sought: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray, list, int]]:
    """By length of the phrases: text positions, the phrase of each, the phrases' items, the length."""
    for group, items in sought.by_length:
        symbols = number[group]
        there = np.flatnonzero((symbols > 0).all(axis=1))
        low, high = index.search(symbols[there])
        sizes = high - low
        if sizes.sum():
            within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield index.locate(np.repeat(low, sizes) + within), np.repeat(there, sizes), items, group.shape[1]


def merged_spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def cut(text: str, spans: list[tuple[int, int]]) -> tuple[list[dict[str, int]], str]:
    """Spans of words as spans of characters, and the text without them."""
    words = [m.span() for m in WORD.finditer(text.translate(_UPPER))]
    chars, kept, at = [], [], 0
    for first, stop in spans:
        start, end = words[first][0], words[stop - 1][1]
        chars.append({"start": start, "stop": end})
        kept.append(text[at:start])
        at = end
    return chars, "".join(kept) + text[at:]


def search_shard(texts: list[str | None], counts: np.ndarray, words: pa.Array, sought: list[PerWorker]) -> list[dict]:
    """What each document of one shard shares with the phrases."""
    n = len(texts)
    out = [{"n_words": int(c), "n_hit": 0, "items": [], "spans": [], "clean": None} for c in counts]
    if not len(words):
        return out
    coded = words.dictionary_encode()
    starts = np.cumsum(counts) - counts + np.arange(n)  # each document ends with a symbol 0
    total = int(counts.sum()) + n
    symbols = np.zeros(total, np.int64)
    inside = np.ones(total, bool)
    inside[starts + counts] = False
    symbols[inside] = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    index = FMIndex(symbols, len(coded.dictionary) + 1)
    edge = np.zeros(total + 1, np.int64)
    pairs: set[tuple[int, str | None]] = set()
    for block in sought:
        found = block()
        number = pc.index_in(found.words.cast(pa.large_string()), value_set=coded.dictionary)
        number = pc.fill_null(number, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        for at, phrase, items, length in occurrences(index, number, found):
            np.add.at(edge, at, 1)
            np.add.at(edge, at + length, -1)
            doc = np.searchsorted(starts, at, side="right") - 1
            for key in np.unique(doc * len(items) + phrase).tolist():
                pairs.update((key // len(items), found.ids[i]) for i in items[key % len(items)])
    hit = np.cumsum(edge)[:total] > 0
    for doc, item in pairs:
        if item is not None:
            out[doc]["items"].append(item)
    for doc in {doc for doc, _ in pairs}:
        own = hit[starts[doc]:starts[doc] + counts[doc]]
        spans, clean = cut(texts[doc], merged_spans(own))
        out[doc] |= {"n_hit": int(own.sum()), "items": sorted(out[doc]["items"]), "spans": spans, "clean": clean}
    return out


def search_batches(
    batches: Iterator[pa.RecordBatch], sought: list[PerWorker], text: str, shard_words: int
) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([
        ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("clean", pa.string()),
    ])

    def searched(held: list) -> Iterator[pa.RecordBatch]:
        texts = [t for batch, _, _ in held for t in batch.column(text).to_pylist()]
        leaks = search_shard(texts, np.concatenate([c for _, c, _ in held]),
                             pa.concat_arrays([w for _, _, w in held]), sought)
        for batch, counts, _ in held:
            own, leaks = leaks[:len(counts)], leaks[len(counts):]
            yield batch.append_column("leak", pa.array(own, kind))

    held, size = [], 0
    for batch in batches:
        for part in slices(batch, text, min(SLICE_BYTES, shard_words)):
            counts, words = split_words(part.column(text).to_pylist())
            held.append((part, counts, words))
            size += int(counts.sum())
            if size >= shard_words:
                yield from searched(held)
                held, size = [], 0
    if held:
        yield from searched(held)


def benchmark_blocks(benchmark: DataFrame, window: int, item: str, text: str, block_chars: int) -> list[PerWorker]:
    """The phrases in blocks of a bounded number of characters; only one block passes the driver at a time."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + chars // block_chars
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n)) if n > 1 else F.lit(0)
    return [
        PerWorker(benchmark.sparkSession, [tuple(r) for r in items.where(block == i).collect()],
                  partial(phrases, window=window))
        for i in range(n)
    ]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, text: str = "text", item: str = "item_id",
    item_text: str = "text", shard_words: int = SHARD_WORDS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with the column ``leak`` (replaces one of that name), a struct of

    ``n_words``, ``n_hit``, ``items`` (ids with an occurring phrase, sorted), ``spans`` (of characters, merged,
    ends excluded) and ``clean`` (the text without its spans; null if there are none).
    """
    docs = docs.drop("leak")
    sought = benchmark_blocks(benchmark, window, item, item_text, block_chars)
    schema = T.StructType([*docs.schema.fields, T.StructField("leak", LEAK)])
    return docs.mapInArrow(partial(search_batches, sought=sought, text=text, shard_words=shard_words), schema)
