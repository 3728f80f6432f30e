"""Byte-level BPE as a finite-state transducer, and its streaming decoder.

**Encoding.** A token sequence is the BPE encoding of its bytes exactly when each two neighbours are the
encoding of theirs. That makes the encodings a local language, read by a transducer over bytes: a
*hypothesis* is the last complete token and the node of the vocabulary's trie that the bytes after it have
reached. A state of the determinised transducer is the set of all hypotheses (the subset construction); its
output is the one token that would end at this byte. A token is emitted when all hypotheses agree on it,
which takes a bounded lookahead. States and transitions are made when a text first needs them, and all are
dropped when there are more than ``MAX_STATES``; that changes no result.

**Decoding.** An automaton over tokens: its state is the incomplete UTF-8 sequence (at most three bytes)
at the end of what was read, its output the characters that became complete.

Texts: null counts as empty. Very long texts are linear. Every row of the input gives one row.
"""

from __future__ import annotations

import base64
import codecs
import gc
from array import array
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import partial
from itertools import filterfalse, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clinspark.llm.common import PerWorker, Work, append_columns
from clinspark.llm.pieces import Memo, gather, string_array

#: More states than this and all are made anew; with more pieces than this the most used third is kept. Neither
#: changes a result.
MAX_STATES = 200_000
MAX_PIECES = 300_000
#: Pieces of more bytes are not remembered.
LONG = 64
#: Pieces that are held at a time.
AT_ONCE = 1 << 16
#: Bytes of one piece after which the tokens that are certain leave the transducer.
LOOKAHEAD = 1024
_NODE_BITS = 20
_NODES = (1 << _NODE_BITS) - 1

Ranks = dict[bytes, int]
_NEVER = 1 << 40


def read_ranks(path: str) -> Ranks:
    """Token bytes to rank from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(ranks: Ranks, piece: bytes, below: int = _NEVER) -> list[int]:
    """The definition of BPE: join the neighbours of lowest rank, leftmost first, until none can be joined.

    Only merges of a rank lower than ``below`` count.
    """
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= below:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Lazily determinised transducer from the bytes of one piece to tokens."""

    def __init__(self, ranks: Ranks, max_states: int = MAX_STATES) -> None:
        self.ranks, self.max_states = ranks, max_states
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.size_of = {rank: len(token) for token, rank in ranks.items()}
        self.child: dict[int, int] = {}  # node * 256 + byte
        self.token_at: dict[int, int] = {}
        self.depth = [0]
        for token, rank in ranks.items():
            node = 0
            for depth, byte in enumerate(token, 1):
                key = node << 8 | byte
                node = self.child.get(key, 0)
                if not node:
                    node = self.child[key] = len(self.depth)
                    self.depth.append(depth)
            self.token_at[node] = rank
        # How merging its own bytes makes a token: its first and last parts, smallest first, each with the
        # rank of the merge that takes the part up. A token that its bytes don't give is only ever a whole piece.
        self.whole: Ranks = {}
        self.first: dict[int, list[tuple[bytes, int]]] = {}
        self.last: dict[int, list[tuple[bytes, int]]] = {}
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            parts = merge(ranks, token, below=rank)
            if len(token) == 1:
                self.first[rank], self.last[rank] = [(token, _NEVER)], [(token, _NEVER)]
            elif len(parts) == 2 and not set(parts) & set(self.whole.values()):
                self.first[rank] = self.first[parts[0]][:-1] + [(self.token_bytes[parts[0]], rank), (token, _NEVER)]
                self.last[rank] = self.last[parts[1]][:-1] + [(self.token_bytes[parts[1]], rank), (token, _NEVER)]
            else:
                self.whole[token] = rank
        self.follows: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        self.states: list[tuple[int, ...]] = []
        self.ends: list[int] = []  # by state: the last token of what was read, should it end here
        self.number: dict[tuple[int, ...], int] = {}
        self.step: dict[int, int] = {}  # state * 256 + byte
        self.state_of((), -1)

    def state_of(self, state: tuple[int, ...], end: int) -> int:
        n = self.number.get(state)
        if n is None:
            n = self.number[state] = len(self.states)
            self.states.append(state)
            self.ends.append(end)
        return n

    def may_follow(self, a: int, b: int) -> bool:
        """Whether ``a, b`` is the encoding of the bytes of both; ``a`` is -1 at the start."""
        key = a + 1 << 32 | b
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) > 8 * self.max_states:
                self.follows.clear()
            known = self.follows[key] = b in self.first and (a < 0 or not self.joined(a, b))
        return known

    def joined(self, a: int, b: int) -> bool:
        """Whether merging the bytes of both joins a part of ``a`` with a part of ``b``.

        Parts have lower ranks than what is made of them, so merges happen in the order of their ranks: two
        parts that meet are joined if that has a lower rank than what else takes up either of them. On a tie
        the left one goes first.
        """
        rank_of = self.ranks.get
        for left, left_goes in self.last[a]:
            for right, right_goes in self.first[b]:
                rank = rank_of(left + right, _NEVER)
                if rank < left_goes and rank <= right_goes and rank != _NEVER:
                    return True
        return False

    def move(self, n: int, byte: int) -> int:
        """One step of the subset construction: the next state."""
        child, token_at, follows, end, state = self.child, self.token_at, self.follows, -2, []
        for known in (*self.states[n], (self.ends[n] + 1) << _NODE_BITS):
            node = child.get((known & _NODES) << 8 | byte)
            if node:
                before = known >> _NODE_BITS
                state.append(before << _NODE_BITS | node)
                if end == -2 and (token := token_at.get(node)) is not None:
                    may = follows.get(before << 32 | token)
                    if self.may_follow(before - 1, token) if may is None else may:
                        end = token
        if end == -2:
            raise ValueError("the vocabulary lacks a single byte")
        made = self.step[n << 8 | byte] = self.state_of(tuple(state), end)
        return made

    def certain(self, state: int, ends: list[int], start: int) -> int:
        """Up to where the tokens are the same in all hypotheses: their chains of last tokens meet there."""
        at = start + len(ends)
        places = {at} | {at - self.depth[known & _NODES] for known in self.states[state]}
        while len(places) > 1:
            latest = max(places)
            places.remove(latest)
            places.add(latest - self.size_of[ends[latest - start - 1]])
        return places.pop()

    def encode(self, piece: bytes, lookahead: int = LOOKAHEAD) -> list[int]:
        """The tokens of one piece; with more than ``lookahead`` bytes undecided, those that are certain are emitted."""
        if piece in self.whole:
            return [self.whole[piece]]
        if len(self.states) > self.max_states:
            self.forget()
        out: list[int] = []
        start, state, step, end_of, ends = 0, 0, self.step, self.ends, []
        for part in range(0, len(piece), lookahead):
            for byte in piece[part:part + lookahead]:
                state = step.get(state << 8 | byte) or self.move(state, byte)
                ends.append(end_of[state])
            last = part + lookahead >= len(piece)
            stop = len(piece) if last else self.certain(state, ends, start)
            tokens, at = [], stop
            while at > start:
                tokens.append(ends[at - start - 1])
                at -= self.size_of[tokens[-1]]
            out += reversed(tokens)
            del ends[:stop - start]
            start = stop
        return out

    def encode_all(self, pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all pieces, one after another, and how many each has.

        Pieces are read in the order of their bytes, so that a common beginning goes through the transducer once.
        """
        coded = [p.encode() for p in pieces]
        order = sorted(range(len(coded)), key=coded.__getitem__)
        found, counts = array("i"), np.zeros(len(coded), np.int64)
        step, end_of, size_of, whole, longest = self.step, self.ends, self.size_of, self.whole, LOOKAHEAD
        before, path, ends = b"", [0], []  # the last piece read, its states, and the tokens that end at its bytes
        for at in order:
            piece = coded[at]
            if len(piece) > longest or piece in whole or len(self.states) > self.max_states:
                tokens = self.encode(piece)
                step, end_of, before, path, ends = self.step, self.ends, b"", [0], []
            else:
                same, most = 0, min(len(before), len(piece))
                while same < most and before[same] == piece[same]:
                    same += 1
                del path[same + 1:], ends[same:]
                state = path[-1]
                for byte in piece[same:]:
                    state = step.get(state << 8 | byte) or self.move(state, byte)
                    path.append(state)
                    ends.append(end_of[state])
                tokens, stop, before = [], len(piece), piece
                while stop:
                    tokens.append(ends[stop - 1])
                    stop -= size_of[tokens[-1]]
                tokens.reverse()
            found.extend(tokens)
            counts[at] = len(tokens)
        by_order = counts[order]
        starts = np.zeros(len(coded), np.int64)
        starts[order] = np.cumsum(by_order) - by_order
        return gather(np.frombuffer(found, np.int32) if found else np.zeros(0, np.int32), starts, counts), counts


class Encoder:
    """Whole texts to packed tokens: little-endian unsigned 32-bit integers.

    Each distinct piece goes through the transducer once while it is remembered; long ones are not remembered.
    """

    def __init__(self, ranks: Ranks, pattern: str) -> None:
        self.pattern, self.fst = regex.compile(pattern), Transducer(ranks)
        self.memo = Memo(self.fst.encode_all, MAX_PIECES)

    def cut(self, text: str) -> Iterator[str]:
        """The pieces of a text; those of a long one are not all held."""
        if len(text) <= AT_ONCE:
            return iter(self.pattern.findall(text))
        return map(regex.Match.group, self.pattern.finditer(text))

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all pieces, one after another, and how many each has."""
        memo = self.memo
        new = set(filterfalse(memo.places.__contains__, pieces))
        long = [p for p in new if len(p) > LONG]
        new.difference_update(long)
        if len(memo.places) + len(new) > memo.limit:  # some will be forgotten
            new = {p for p in pieces if len(p) <= LONG}
        memo.places_of(list(new))
        known, ids, starts, counts = memo.places, memo.ids, memo.starts, memo.counts
        if long:
            n = len(known)
            known = known | dict(zip(long, range(n, n + len(long))))
            more, n_more = self.fst.encode_all(long)
            ids = np.concatenate([ids[:memo.used], more])
            starts = np.concatenate([starts[:n], memo.used + np.cumsum(n_more) - n_more])
            counts = np.concatenate([counts[:n], n_more])
        at = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        memo.uses[:len(memo.places)] += np.bincount(at, minlength=len(known))[:len(memo.places)]
        return gather(ids, starts[at], counts[at]), counts[at]

    def encode_all(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts, one after another, and how many each has; pieces are held ``AT_ONCE`` at a time."""
        done: list[np.ndarray] = []
        n_tokens = np.zeros(len(texts), np.int64)
        pieces: list[str] = []
        owners: list[tuple[int, int]] = []  # text, end of its pieces

        def end() -> None:
            if pieces:
                ids, counts = self._ids(pieces)
                done.append(ids.astype("<u4"))
                upto, before = np.concatenate([[0], np.cumsum(counts)]), 0
                for text, stop in owners:
                    n_tokens[text] += upto[stop] - upto[before]
                    before = stop
            pieces.clear()
            owners.clear()

        for at, text in enumerate(texts):
            found = self.cut(text or "")
            while True:
                pieces += islice(found, AT_ONCE - len(pieces))
                owners.append((at, len(pieces)))
                if len(pieces) < AT_ONCE:
                    break
                end()
        end()
        return np.concatenate(done) if done else np.zeros(0, "<u4"), n_tokens

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0].tobytes()


class Decoder:
    """Packed tokens to bytes and text, token by token."""

    def __init__(self, ranks: Ranks) -> None:
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.step: dict[tuple[bytes, int], tuple[str, bytes]] = {}
        size = max(self.token_bytes, default=-1) + 1
        tokens = [self.token_bytes.get(rank, b"") for rank in range(size)]
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.fromiter(map(len, tokens), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        #: Tokens that add their own bytes and leave nothing pending, if nothing is pending before them.
        self.whole = np.zeros(size, bool)
        for rank, token in self.token_bytes.items():
            text, pending = self.move(b"", rank)
            self.whole[rank] = not pending and text.encode() == token

    def move(self, pending: bytes, token: int) -> tuple[str, bytes]:
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        machine.setstate((pending, 0))
        text = machine.decode(self.token_bytes[token])
        if len(self.step) > MAX_STATES:
            self.step.clear()
        made = self.step[pending, token] = (text, machine.getstate()[0])
        return made

    def stream(self, tokens: Iterable[int]) -> Iterator[str]:
        """The characters that each token completes; what is still incomplete at the end becomes U+FFFD."""
        pending, step = b"", self.step
        for token in tokens:
            text, pending = step.get((pending, token)) or self.move(pending, token)
            yield text
        if pending:
            yield "\ufffd"

    def decode_all(self, ids: np.ndarray, n_tokens: np.ndarray) -> pa.Array:
        """Texts of consecutive token sequences.

        While the automaton is in its first state, whole tokens are gathered as bytes; it is stepped only from a token
        that leaves a character incomplete to where nothing is pending. A text whose characters are not the bytes
        of its tokens is streamed.
        """
        ends = np.cumsum(n_tokens)
        data = gather(self.data, self.starts[ids], self.lengths[ids])
        ends_of = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        text_of = np.searchsorted(ends, odd := np.flatnonzero(~self.whole[ids]), side="right")
        streamed: dict[int, bytes] = {}
        step, upto = self.step, 0  # tokens before upto are done
        for at, text in zip(odd.tolist(), text_of.tolist()):
            if at < upto or text in streamed:
                continue
            pending, made, upto, stop = b"", [], at, int(ends[text])
            while upto == at or pending and upto < stop:
                token = int(ids[upto])
                part, pending = step.get((pending, token)) or self.move(pending, token)
                made.append(part)
                upto += 1
            if pending or "".join(made).encode() != data[ends_of[at]:ends_of[upto]].tobytes():
                begin = stop - int(n_tokens[text])
                streamed[text], upto = "".join(self.stream(ids[begin:stop].tolist())).encode(), stop
        starts = ends_of[ends - n_tokens]
        if streamed:
            parts = [streamed.get(i) if i in streamed else data[a:b].tobytes()
                     for i, (a, b) in enumerate(zip(starts.tolist(), ends_of[ends].tolist()))]
            return pa.array([p.decode() for p in parts], pa.string())
        return string_array(data, starts) if len(n_tokens) else pa.array([], pa.string())

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        return self.decode_all(ids, np.array([len(ids)]))[0].as_py()


def _packed(ids: np.ndarray, n_tokens: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], 4 * np.cumsum(n_tokens)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n_tokens), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


@contextmanager
def no_collection() -> Iterator[None]:
    """No search for reference cycles meanwhile: states are many small tuples, and none is in a cycle."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


def _encoding(machine: PerWorker) -> Work:
    encode = machine().encode_all

    def work(texts: list[str | None]) -> list[pa.Array]:
        with no_collection():
            return [_packed(*encode(texts))]

    return work


def _decoding(machine: PerWorker) -> Work:
    decode = machine().decode_all

    def work(packed: list[bytes | None]) -> list[pa.Array]:
        sizes = np.fromiter((len(p or b"") // 4 for p in packed), np.int64, len(packed))
        return [decode(np.frombuffer(b"".join(p or b"" for p in packed), "<u4"), sizes)]

    return work


def _both(machine: PerWorker) -> Work:
    encoder, decoder = machine()

    def work(texts: list[str | None]) -> list[pa.Array]:
        with no_collection():
            ids, n_tokens = encoder.encode_all(texts)
        return [_packed(ids, n_tokens), decoder.decode_all(ids, n_tokens)]

    return work


def _pair(ranks: Ranks, pattern: str) -> tuple[Encoder, Decoder]:
    return Encoder(ranks, pattern), Decoder(ranks)


def bpe_encode(docs: DataFrame, ranks: Ranks, pattern: str, *, text: str = "text", out: str = "tokens") -> DataFrame:
    """``docs`` with the binary column ``out``: the packed tokens of each whole text."""
    machine = PerWorker(docs.sparkSession, ranks, partial(Encoder, pattern=pattern))
    return append_columns(docs, text, [T.StructField(out, T.BinaryType())], partial(_encoding, machine))


def bpe_decode(tokens: DataFrame, ranks: Ranks, *, packed: str = "tokens", out: str = "decoded") -> DataFrame:
    """``tokens`` with the string column ``out``: the packed tokens decoded as a stream."""
    machine = PerWorker(tokens.sparkSession, ranks, Decoder)
    return append_columns(tokens, packed, [T.StructField(out, T.StringType())], partial(_decoding, machine))


def bpe_round_trip(
    docs: DataFrame, ranks: Ranks, pattern: str, *, text: str = "text", tokens: str = "tokens", out: str = "decoded"
) -> DataFrame:
    """``bpe_decode`` after ``bpe_encode``, in one pass over the texts."""
    machine = PerWorker(docs.sparkSession, ranks, partial(_pair, pattern=pattern))
    fields = [T.StructField(tokens, T.BinaryType()), T.StructField(out, T.StringType())]
    return append_columns(docs, text, fields, partial(_both, machine))
