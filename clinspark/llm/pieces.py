"""Encoding of pieces of text, each distinct piece once while it is remembered."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

#: Pieces that a worker remembers; beyond these it keeps the most used third.
REMEMBERED = 150_000

#: Pieces that a tokenizer gets at a time.
AT_ONCE = 8192

#: From distinct pieces to the ids of all, one after another, and how many each has.
Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def flat(lists: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(counts.sum())), counts


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``values[start : start + count]`` for every start and count, one after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - counts), counts) + np.arange(total)]


class Memo:
    """Ids of pieces in flat arrays. A piece's ids must not depend on what stands around it."""

    def __init__(self, encode: Encode, limit: int = REMEMBERED) -> None:
        self.encode, self.limit = encode, limit
        self.places: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.starts, self.counts, self.uses = (np.zeros(1 << 14, np.int64) for _ in range(3))
        self.used = 0

    def _forget(self) -> None:
        """Keeps the most used third, whose uses count half from now on."""
        n = len(self.places)
        kept = np.sort(np.argsort(-self.uses[:n], kind="stable")[: self.limit // 3])
        names = list(self.places)
        ids, counts = gather(self.ids, self.starts[kept], self.counts[kept]), self.counts[kept]
        self.places = dict(zip([names[i] for i in kept.tolist()], range(len(kept))))
        self.used = len(ids)
        self.ids[: self.used] = ids
        self.starts[: len(kept)], self.counts[: len(kept)] = np.cumsum(counts) - counts, counts
        self.uses[: len(kept)] = self.uses[kept] // 2
        self.uses[len(kept):] = 0

    def places_of(self, pieces: list[str]) -> np.ndarray:
        """Place of each of some distinct pieces; those not yet known are encoded."""
        if self.places and len(self.places) + len(pieces) > self.limit:
            self._forget()
        places = np.fromiter(map(self.places.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(places < 0)
        places[new] = len(self.places) + np.arange(len(new))
        self._add([pieces[i] for i in new.tolist()])
        return places

    def _add(self, pieces: list[str]) -> None:
        for start in range(0, len(pieces), AT_ONCE):
            some = pieces[start:start + AT_ONCE]
            ids, counts = self.encode(some)
            begin, end, stop = len(self.places), len(self.places) + len(some), self.used + int(counts.sum())
            self.ids = _room(self.ids, stop)
            self.starts, self.counts, self.uses = (_room(x, end) for x in (self.starts, self.counts, self.uses))
            self.ids[self.used:stop] = ids
            self.counts[begin:end] = counts
            self.starts[begin:end] = self.used + np.cumsum(counts) - counts
            self.used = stop
            self.places.update(zip(some, range(begin, end)))

    def __call__(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after another, and how many each has."""
        found = pieces.dictionary_encode()
        # Strings made all at once; ``to_pylist`` makes a scalar of each first.
        places = self.places_of(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        self.uses[places] += 1
        places = places[found.indices.to_numpy(zero_copy_only=False)] if len(found) else np.zeros(0, np.int64)
        counts = self.counts[places]
        return gather(self.ids, self.starts[places], counts), counts


def _room(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    grown = np.zeros(max(size, 2 * len(values)), values.dtype)
    grown[: len(values)] = values
    return grown


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between each two offsets."""
    upto = np.concatenate([[0], np.cumsum(values)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def string_array(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Consecutive strings of UTF-8 bytes; each begins at a start and the first start is 0."""
    offsets = np.append(starts, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
