"""Toxicity by a support vector machine on a gap-weighted subsequence kernel.

**Units.** A text is read as words without punctuation and digits, in lower case; letters that stand alone in a row
("i d i o t") are one unit, and a unit of more than ``LONGEST`` characters is read in windows that overlap by half.

**Kernel.** Two units are alike as far as they share subsequences of ``LENGTH`` characters (the edges of a unit count as
characters) that span at most ``SPAN``; each skipped character weighs a subsequence down by ``DECAY``. An insult with a
character put in or left out therefore keeps most of its likeness. The kernel is normalised.

**Training.** Each sentence of a labelled document has the document's label, but of a toxic document only its strongest
units are held to it (multiple instances). A unit's features are its likenesses to the landmarks, whitened (Nystroem);
a linear machine with squared hinge loss is fitted on them, and the strongest units are chosen anew by it. The machine
of the landmarks is one weight for each subsequence, which is what tasks apply to whole texts. Units that were
chosen also teach with one character put in. The highest score of a text gives its probability.

Only ``labels.toxic`` of rows that are not held out teaches, on at most ``SAMPLE`` documents of each label, chosen by a
hash of their ids. A null or empty text scores like one without any unit known to be toxic. Ids may be null or repeated.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.llm.common import PerWorker, Work, append_columns

LENGTH = 3
SPAN = 5
DECAY = 0.7
LONGEST = 24
LANDMARKS = 256
#: Most labelled documents of each label that the machine is fitted on.
SAMPLE = 1500
THRESHOLD = 0.7
_TABLE_BITS = 18
_NOISE = bytes(b for b in range(33, 127) if not chr(b).isalpha())
_ALONE = re.compile(rb"(?<!\S)(?:[a-z]|[\xc0-\xf7][\x80-\xbf]+)(?: (?:[a-z]|[\xc0-\xf7][\x80-\xbf]+))+(?!\S)")
#: Offsets of the characters of a subsequence, and its weight.
_SHAPES = [((0, *rest), DECAY ** (rest[-1] + 1 - LENGTH)) for rest in combinations(range(1, SPAN), LENGTH - 1)]


def split_units(texts: list[str | None]) -> tuple[np.ndarray, pa.Array]:
    """Units per text, and the units of all texts in one array."""
    cleaned = []
    for text in texts:
        raw = (text or "").lower().encode("utf-8", "replace").translate(None, _NOISE)
        cleaned.append(b" ".join(_ALONE.sub(lambda m: m[0].replace(b" ", b""), raw).split()))
    counts = np.zeros(len(texts), np.int64)
    full = [i for i, c in enumerate(cleaned) if c]
    lists = pc.ascii_split_whitespace(pa.array([cleaned[i] for i in full], pa.large_binary()).cast(pa.large_string()))
    counts[full] = lists.value_lengths().to_numpy(zero_copy_only=False) if full else 0
    return counts, lists.flatten()


def windows(unit: str) -> list[str]:
    half = LONGEST // 2
    if len(unit) <= LONGEST:
        return [unit]
    return [unit[i:i + LONGEST] for i in range(0, len(unit) - half, half)]


def subsequences(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and weights of the subsequences of each unit (of at most ``LONGEST`` characters), normalised to length 1.

    Numbers are sorted; a number that occurs again has weight 0 there and is summed at its first place.
    """
    width = max(map(len, units), default=0) + 2 + SPAN
    codes = np.zeros((len(units), width), np.uint64)
    for i, unit in enumerate(units):
        codes[i, :len(unit) + 2] = np.frombuffer(f"\x02{unit}\x03".encode("utf-32-le"), "<u4")
    found, weights = [], []
    for shape, weight in _SHAPES:
        stop = width - SPAN
        number = np.zeros((len(units), stop), np.uint64)
        for offset in shape:
            number = number * np.uint64(1_000_003) + codes[:, offset:offset + stop]
        number ^= number >> np.uint64(29)
        number = number * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _TABLE_BITS)
        found.append(number.astype(np.int64))
        weights.append(np.where(codes[:, shape[-1]:shape[-1] + stop] > 0, np.float32(weight), np.float32(0)))
    numbers, values = np.concatenate(found, axis=1), np.concatenate(weights, axis=1)
    order = np.argsort(numbers, axis=1, kind="stable")
    numbers, values = np.take_along_axis(numbers, order, 1), np.take_along_axis(values, order, 1)
    new = np.ones(numbers.shape, bool)
    new[:, 1:] = numbers[:, 1:] != numbers[:, :-1]
    starts = np.flatnonzero(new.ravel())
    sums = np.zeros(numbers.size, np.float32)
    if len(starts):
        sums[starts] = np.add.reduceat(values.ravel(), starts)
    sums = sums.reshape(numbers.shape)
    length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
    return numbers, sums / np.maximum(length, 1e-9)


@dataclass
class Machine:
    """One weight for each subsequence, a bias, and the map from a text's highest score to a probability."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, units: list[str], block: int = 4096) -> np.ndarray:
        out = np.full(len(units), self.bias)
        short = sorted((i for i, u in enumerate(units) if len(u) <= LONGEST), key=lambda i: len(units[i]))
        for start in range(0, len(short), block):
            part = short[start:start + block]
            numbers, values = subsequences([units[i] for i in part])
            out[part] += np.einsum("ij,ij->i", self.weights[numbers], values)
        for i, unit in enumerate(units):
            if len(unit) > LONGEST:
                out[i] = self.margins(windows(unit)).max()
        return out

    def highest(self, texts: list[str | None]) -> np.ndarray:
        """The highest margin of each text; without units that of a unit that is like nothing known."""
        counts, units = split_units(texts)
        out = np.full(len(texts), min(self.bias, 0.0))
        if len(units):
            coded = units.dictionary_encode()
            margins = self.margins(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
            full = np.flatnonzero(counts)
            out[full] = np.maximum.reduceat(margins, (np.cumsum(counts) - counts)[full])
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.highest(texts) + self.shift, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, steps: int = 30) -> np.ndarray:
    """Squared hinge loss by Newton steps; the last column of ``x`` is 1 and is the bias."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        margin = 1 - y * (x @ w)
        on = margin > 0
        xo = x[on] * weight[on, None]
        step = np.linalg.solve(xo.T @ x[on] + np.diag(ridge), xo.T @ (y[on] * margin[on]) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of a probability, with targets drawn in from 0 and 1 so that they stay finite."""
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    design, w = np.stack([x, np.ones(len(x))], 1), np.array([1.0, 0.0])

    def loss(v: np.ndarray) -> float:
        z = design @ v
        return float((np.logaddexp(0, z) - target * z).sum() + 5e-4 * v @ v)

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (target - p) - 1e-3 * w)
        while loss(w + step) > now and np.abs(step).max() > 1e-9:
            step /= 2
        w, before, now = w + step, now, loss(w + step)
        if before - now < 1e-9:
            break
    return float(w[0]), float(w[1])


def _bags(texts: list[str | None]) -> list[list[str]]:
    counts, units = split_units(texts)
    ends = np.cumsum(counts)
    coded = units.dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    parts = [windows(u) for u in coded.dictionary.to_pylist()]  # one string for all texts
    return [sorted({w for u in np.unique(numbers[e - c:e]) for w in parts[u]})
            for c, e in zip(counts.tolist(), ends.tolist())]


def variants(unit: str) -> list[str]:
    """The unit with one character put in, at each place between its first and last."""
    return [unit[:i] + "xoznk"[i % 5] + unit[i:] for i in range(1, len(unit))]


def fit(texts: list[str | None], toxic: list[bool], landmarks: int = LANDMARKS, rounds: int = 3) -> Machine:
    """The machine from labelled texts; without two texts of each label it knows nothing and scores all alike.

    Its probabilities are fitted on the scores that each half of the texts gets from the other half's machine.
    """
    label = np.array(toxic, bool)
    nothing = Machine(np.zeros(1 << _TABLE_BITS, np.float32), -1.0, 1.0, -3.0)
    half = np.arange(len(texts)) % 2 == 0
    if any(not (label & on).any() or not (~label & on).any() for on in (half, ~half)):
        return nothing
    bags = _bags(texts)
    highest = np.zeros(len(texts))
    for on in (half, ~half):
        machine = fit_bags([b for b, x in zip(bags, on) if x], label[on], landmarks, rounds) or nothing
        other = [t for t, x in zip(texts, on) if not x]
        highest[~on] = machine.highest(other)
    machine = fit_bags(bags, label, landmarks, rounds) or nothing
    machine.slope, machine.shift = fit_logistic(highest, label)
    return machine


def not_copies(bags: list[list[str]], least: int = 16) -> list[int]:
    """Places of the bags that share less than half of their ``least`` smallest hashes with every earlier one.

    Copies of one toxic text would make all of its words look toxic.
    """
    kept: list[int] = []
    holders: dict[int, list[int]] = {}
    for i, bag in enumerate(bags):
        own = sorted(xxhash.xxh64_intdigest(u.encode("utf-8", "replace")) for u in bag)[:least]
        shared: dict[int, int] = {}
        for value in own:
            for j in holders.get(value, ()):
                shared[j] = shared.get(j, 0) + 1
        if not own or max(shared.values(), default=0) * 2 < len(own):
            kept.append(i)
            for value in own:
                holders.setdefault(value, []).append(i)
    return kept


def fit_bags(bags: list[list[str]], own: np.ndarray, landmarks: int, rounds: int) -> Machine | None:
    """The machine without its probabilities, from the distinct units of each text."""
    single = not_copies(bags)
    bags, own = [bags[i] for i in single], own[single]
    number: dict[str, int] = {}
    rows = [np.array([number.setdefault(u, len(number)) for u in bag], np.int64) for bag in bags]
    units = list(number)
    seen = np.zeros((2, len(units)))
    for row, y in zip(rows, own):
        seen[int(y), row] += 1
    if not units or own.all() or not own.any():
        return None
    rate = (seen + 0.5) / (np.array([(~own).sum(), own.sum()])[:, None] + 1)
    odds = np.log(rate[1]) - np.log(rate[0])
    strength = (rate[1] - rate[0]) / np.sqrt(rate[1] / own.sum() + rate[0] / (~own).sum())
    chosen = np.argsort(-strength, kind="stable")[:landmarks // 2].tolist()
    others = [i for i in np.argsort(-seen[0], kind="stable") if i not in set(chosen)]
    chosen += others[::max(1, min(len(others), 4000) // (landmarks // 2))][:landmarks // 2]

    # Likeness to the landmarks: a product of sparse rows.
    marks = [units[i] for i in chosen]
    numbers, values = subsequences(marks)
    there = np.unique(numbers[values > 0])
    place = np.full(1 << _TABLE_BITS, len(there), np.int64)
    place[there] = np.arange(len(there))
    dense = np.zeros((len(there) + 1, len(marks)), np.float32)
    which = np.broadcast_to(np.arange(len(marks))[:, None], numbers.shape)
    np.add.at(dense, (place[numbers], which), np.where(values > 0, values, 0))
    dense[-1] = 0
    values_, vectors = np.linalg.eigh(dense.T @ dense)
    white = vectors[:, values_ > 1e-3] / np.sqrt(values_[values_ > 1e-3])

    def features(of: list[str]) -> np.ndarray:
        out = np.zeros((len(of), len(marks)))
        for start in range(0, len(of), 256):
            n, v = subsequences(of[start:start + 256])
            row, column = np.nonzero((place[n] < len(there)) & (v > 0))
            by = np.flatnonzero(np.diff(row, prepend=-1))
            if len(row):
                out[start + row[by]] = np.add.reduceat(dense[place[n[row, column]]] * v[row, column][:, None], by)
        return np.hstack([out @ white, np.ones((len(of), 1))])

    clean = np.flatnonzero(seen[0] > 0)
    negative = clean[np.argsort(-seen[0, clean], kind="stable")][:16_000]
    base = features([units[i] for i in negative])
    tox_rows = [row for row, y in zip(rows, own) if y and len(row)]
    clear = rate[1] > 20 * rate[0]
    candidates = np.unique(np.concatenate(tox_rows)) if tox_rows else np.array([], np.int64)
    candidates = candidates[odds[candidates] > 0]
    # All occurrences in toxic texts, and too many for chance.
    sure = np.flatnonzero(clear & ((seen[1] - 5 * seen[0]) * np.log(own.mean()) < np.log(1e-4))).tolist()
    positive, w, table = set(sure), np.zeros(base.shape[1]), np.zeros(1 << _TABLE_BITS, np.float32)
    for _ in range(rounds):
        good = np.array(sorted(positive), np.int64)
        if not len(good):
            break
        # A unit counts as often as it was seen, its variants together twice as much, either label as the other.
        up, down = np.log1p(seen[1, good]), np.log1p(seen[0, negative])
        disguised = [(v, 2 * a / (len(units[g]) - 1)) for g, a in zip(good, up) for v in variants(units[g])
                     if v not in number and len(v) <= LONGEST]
        up = np.concatenate([up, [a for _, a in disguised]])
        x = np.vstack([features([units[g] for g in good] + [v for v, _ in disguised]), base])
        y = np.concatenate([np.ones(len(up)), -np.ones(len(base))])
        weight = np.concatenate([up / up.sum(), down / down.sum()]) * len(y)
        w = fit_linear(x, y, weight, penalty=1e-5 * len(y))
        # Rare clean units that come close to a toxic one teach too.
        table = np.zeros(1 << _TABLE_BITS, np.float32)
        table[there] = (dense[:-1] @ (white @ w[:-1])).astype(np.float32)
        rest = np.setdiff1d(clean, negative)
        machine = Machine(table, float(w[-1]))
        close = machine.margins([units[i] for i in rest])
        hard = rest[np.argsort(-close, kind="stable")[:2000]]
        negative = np.concatenate([negative, hard])
        base = np.vstack([base, features([units[i] for i in hard])])
        margin = np.full(len(units), -9.0)
        margin[candidates] = machine.margins([units[i] for i in candidates])
        positive = {*sure, *np.flatnonzero((margin > 0.3) & clear & (seen[1] > 1)).tolist()}
        for row in tox_rows:  # a text that nothing explains yet is held to its strongest unit, unless that is far off
            if len(row) and not positive.intersection(row.tolist()) and margin[row].max() > -0.5:
                positive.add(int(row[margin[row].argmax()]))
    return Machine(table, float(w[-1]))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether a row's label may not teach; false where the id is null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Machine:
    """The machine from at most ``sample`` labelled documents of each label that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id))
    known = known.groupBy(doc_id).agg(F.max("toxic").alias("toxic"))
    picked = [
        known.where(F.col("toxic") == y).orderBy(F.xxhash64(doc_id), doc_id).limit(sample).select(doc_id, "toxic")
        for y in (0, 1)
    ]
    # At most 2 * sample ids: a bounded table.
    ids = F.broadcast(picked[0].union(picked[1]).withColumnRenamed(doc_id, "_id"))
    rows = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).join(ids, F.col("_doc") == F.col("_id"))
    rows = rows.select("_doc", "_text", "toxic").limit(2 * sample).collect()
    rows.sort(key=lambda r: (r["toxic"], r["_doc"], r["_text"] or ""))
    return fit([r["_text"] for r in rows], [r["toxic"] == 1 for r in rows])


def _scores(machine: PerWorker) -> Work:
    own = machine()
    return lambda texts: [own.scores(texts)]


def _same(machine: Machine) -> Machine:
    return machine


def score(docs: DataFrame, machine: Machine, *, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with the double column ``out``, from 0 to 1."""
    sent = PerWorker(docs.sparkSession, machine, _same)
    return append_columns(docs, text, [T.StructField(out, T.DoubleType())], partial(_scores, sent))
