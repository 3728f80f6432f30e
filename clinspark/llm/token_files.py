"""Token ids in Parquet files: list columns in document order, readable by document, by token span, or without tokens.

Every document's ids, and an end id behind them, are one list. Documents stand in ascending order of their id over all
files; a file keeps its number (``part``), each document's first place within it (``first``) and its length, so the place
in the whole corpus needs one row per file besides, and tokens are written once. Ids are dictionary-encoded (few
distinct values) or delta-encoded; the order columns are delta-encoded. Row groups and pages have a set size, and the
writer adds page indexes, so that a filter on documents or places reads the pages it needs.

Nulls and empty texts give a document of one end id. Documents without an id come first. Rows that share an id are
ordered by a hash of their text; rows equal in both may take each other's place. An empty table gives empty
files. Other columns pass through, but those of the names used here are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clinspark.llm.common import PerWorker, slices
from clinspark.llm.pieces import Memo, flat, gather, string_array, sums

#: Bytes of text that are encoded at a time; what a worker holds grows with it.
SLICE_BYTES = 1 << 20
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 1000

_TEXT, _PLACE, _HASH = "_clinspark_text", "_clinspark_place", "_clinspark_hash"
MADE = ("part", "first", "start", "n_tokens", "tokens")

#: From texts to the ids of all texts, one after another, and how many each has.
Encoder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


class WordEncoder:
    """A tokenizer that drops white space and cuts words into runs before it merges, so that each distinct run is encoded once.

    Words of Latin letters, digits and ASCII signs are lower-cased and cut here, over whole slices of bytes, as the
    vocabulary file says: a contraction, letters, one digit, or other signs. A word with any other character, or the
    opening of a special token, goes to the tokenizer whole.
    """

    # Kinds of ASCII bytes, and the contractions that are runs of their own.
    SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
    SPACES = b"\t\n\v\f\r "
    CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")
    SPECIAL = "<|"
    PLAIN = re.compile(r"'(?:s|t|m|d|re|ve|ll)|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
    WORD_END = "</w>"
    JOINED = 64
    REMEMBERED = 350_000

    def __init__(self, model: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.merger = Tokenizer.from_str(model), Tokenizer.from_str(model)
        # Plain runs are normalized and cut already: what is left are the spaces between them, their bytes and the merges.
        self.merger.normalizer = None
        self.merger.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith(self.WORD_END)]] = True
        self.runs = Memo(self._encode, self.REMEMBERED)
        kinds = np.full(256, self.OTHER, np.uint8)
        kinds[0x21:0x7F] = self.SIGN
        for chars, kind in ((self.SPACES, self.SPACE), (b"0123456789", self.DIGIT)):
            kinds[list(chars)] = kind
        kinds[ord("A"):ord("Z") + 1] = kinds[ord("a"):ord("z") + 1] = self.LETTER
        self.kinds = kinds.tobytes()

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Plain runs go in rows of ``JOINED``, with a space between, as a call costs more than a run: a run's last id ends it."""
        plain = np.fromiter((bool(self.PLAIN.fullmatch(t)) and self.SPECIAL not in t for t in texts), bool, len(texts))
        some = [t for t, joined in zip(texts, plain.tolist()) if joined]
        rows = [" ".join(some[i:i + self.JOINED]) for i in range(0, len(some), self.JOINED)]
        ids, _ = flat(self._ids(self.merger, rows))
        stops = np.flatnonzero(self.ends[ids])
        if len(stops) != len(some):
            raise ValueError("the vocabulary's words don't end as stated")
        own, lengths = flat(self._ids(self.tokenizer, [t for t, joined in zip(texts, plain.tolist()) if not joined]))
        counts, starts = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        counts[plain], counts[~plain] = np.diff(stops, prepend=-1), lengths
        starts[plain] = stops + 1 - counts[plain]
        starts[~plain] = len(ids) + np.cumsum(lengths) - lengths
        return gather(np.concatenate([ids, own]), starts, counts), counts

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        if not pc.any(pc.greater(pc.binary_length(texts), 0)).as_py():
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        data, starts, kept = self._runs(data, offsets)
        ids, counts = self.runs(string_array(data, starts))
        # Texts begin where their first bytes would stand among those that are kept.
        return ids, sums(counts, np.searchsorted(starts, kept[offsets]))

    def _runs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes without white space, where runs start in them, and how many bytes are kept before each place."""
        n = len(data)
        begins = np.zeros(n + 1, bool)
        begins[offsets] = True
        begins = begins[:n]
        # Letters of two bytes in the Latin-1 range; all other bytes beyond ASCII make a word odd.
        after = np.append(data[1:], np.uint8(0))
        lead = (data == 0xC3) & (after >= 0x80) & (after != 0x97) & (after != 0xB7)
        kind = np.frombuffer(bytearray(data).translate(self.kinds), np.uint8)
        kind[lead] = self.LETTER
        trail = np.append(False, lead[:-1])
        kind[trail] = self.LETTER
        space = kind == self.SPACE
        word = ~space & (np.append(True, space[:-1]) | begins)
        odd = (kind == self.OTHER) | ((data == ord("<")) & (after == ord("|")))
        plain = np.ones(n, bool)
        if odd.any():
            words = np.cumsum(word, dtype=np.int32)
            strange = np.zeros(int(words[-1]) + 1, bool)
            strange[words[odd]] = True
            plain = ~strange[words]
        capital = plain & (((data >= 0x41) & (data <= 0x5A)) | (trail & (data < 0x9F)))
        lower = data | (capital.view(np.uint8) << np.uint8(5))
        before = np.append(np.uint8(self.SPACE), kind[:-1])
        change = (kind != before) | (kind == self.DIGIT) | begins
        cut = word | (plain & ~space & change)
        self._contractions(lower, cut, plain & (kind == self.SIGN) & change & (data == ord("'")), kind, begins)
        kept = np.zeros(n + 1, np.int32)
        np.cumsum(~space, dtype=np.int32, out=kept[1:])
        # Runs start at bytes that are kept, so that their places follow from how many are.
        left = np.frombuffer(lower.tobytes().translate(None, self.SPACES), np.uint8)
        return left, kept[np.flatnonzero(cut)], kept

    def _contractions(
        self, data: np.ndarray, cut: np.ndarray, opens: np.ndarray, kind: np.ndarray, begins: np.ndarray
    ) -> None:
        """Joins an apostrophe that begins a run with the letters of a contraction, and cuts behind them."""
        at = np.flatnonzero(opens)
        padded = np.append(data, np.zeros(3, np.uint8))
        ends = np.append(begins, np.ones(3, bool))
        left = np.ones(len(at), bool)
        for letters in self.CONTRACTIONS:
            size = len(letters)
            fits = left.copy()
            for i, letter in enumerate(letters, 1):
                fits &= (padded[at + i] == ord(letter)) & ~ends[at + i]
            left &= ~fits
            found = at[fits]
            cut[found + 1] = False
            behind = found + size + 1
            behind = behind[behind < len(data)]
            cut[behind[kind[behind] != self.SPACE]] = True


def word_encoder(spark: SparkSession, path: str) -> PerWorker:
    """The tokenizer of a vocabulary file, read on the driver (its size is fixed), for the tasks."""
    with open(path, encoding="utf-8") as file:
        return PerWorker(spark, file.read(), WordEncoder, keep=1)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` behind each text's, and the new counts."""
    counts = counts + 1
    out = np.full(int(counts.sum()), end, np.int32)
    own = np.ones(len(out), bool)
    own[np.cumsum(counts) - 1] = False
    out[own] = ids
    return out, counts


def _encoded(batches: Iterator[pa.RecordBatch], make: Callable[[], Encoder], end: int, schema: pa.Schema):
    encode, first = make(), 0
    for batch in batches:
        for part in slices(batch, _TEXT, SLICE_BYTES):
            ids, counts = with_end(*encode(part.column(_TEXT)), end)
            offsets = np.concatenate([[0], np.cumsum(counts)])
            values = {
                "first": pa.array(first + offsets[:-1], pa.int64()), "n_tokens": pa.array(counts, pa.int64()),
                "tokens": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())),
            }
            first += int(offsets[-1])
            columns = [values[f.name] if f.name in values else part.column(f.name) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)


def write_tokens(
    docs: DataFrame, path: str, encoder: PerWorker, *, id: str = "doc_id", text: str = "text", end: int = 2,
    encoding: str = "dictionary", row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS, partitions: int | None = None,
) -> None:
    """Write the ids of every text to ``path`` in ascending order of ``id``; ``encoding`` is dictionary or delta.

    Texts are dealt to ranges of the id, and a hash of the text and the row's place stand behind it, so that an id of very
    many rows fills many files.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding: {encoding}")
    others = [c for c in docs.columns if c != text and (c == id or c not in MADE)]
    rows = docs.select(*others, F.col(text).alias(_TEXT), F.xxhash64(text).alias(_HASH),
                       F.monotonically_increasing_id().alias(_PLACE))
    keys = [F.asc_nulls_first(id), F.col(_HASH), F.col(_PLACE)]
    ranged = rows.repartitionByRange(*([partitions] if partitions else []), *keys).sortWithinPartitions(*keys)
    ranged = ranged.select(*others, F.spark_partition_id().alias("part"), _TEXT)
    schema = T.StructType([
        *[docs.schema[c] for c in others], T.StructField("part", T.IntegerType()), T.StructField("first", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("tokens", T.ArrayType(T.IntegerType(), False)),
    ])
    stored = ranged.mapInArrow(
        partial(_encoded, make=encoder, end=end, schema=to_arrow_schema(schema)), schema)
    options = {
        # Version 2 pages hold deltas wherever there is no dictionary.
        "parquet.writer.version": "PARQUET_2_0", "compression": "zstd",
        "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes, "parquet.page.row.count.limit": page_rows,
        "parquet.enable.dictionary": "true",
        **{f"parquet.enable.dictionary#{c}": "false" for c in (id, "first", "n_tokens")},
        "parquet.enable.dictionary#tokens.list.element": str(encoding == "dictionary").lower(),
    }
    stored.write.mode("overwrite").options(**{k: str(v) for k, v in options.items()}).parquet(path)


class TokenFiles:
    """What ``write_tokens`` wrote. Reads are lazy and take only the columns and pages they need."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.rows = spark, spark.read.parquet(path)
        counts = self.rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # a row per file
        self.parts, total = [], 0
        for row in counts:
            self.parts.append((row["part"], total, total + row["n"]))
            total += row["n"]
        self.n_tokens = total

    def _placed(self, rows: DataFrame) -> DataFrame:
        starts = self.spark.createDataFrame([p[:2] for p in self.parts], "part int, _part_start bigint")
        # One row per file, so its size is that of the file list and not of the data.
        placed = rows.join(F.broadcast(starts), "part")
        others = [c for c in rows.columns if c not in ("part", "first")]
        return placed.select(*others, (F.col("_part_start") + F.col("first")).alias("start"))

    def documents(self, *, tokens: bool = True) -> DataFrame:
        """Every document with its ``start`` among all ids; without ``tokens`` their column isn't read."""
        return self._placed(self.rows if tokens else self.rows.drop("tokens"))

    def between(self, first_id, last_id, *, id: str = "doc_id") -> DataFrame:
        """Documents of a range of ids: files, row groups and pages without any are skipped."""
        return self._placed(self.rows.where(F.col(id).between(first_id, last_id)))

    def span(self, begin: int, end: int) -> DataFrame:
        """The ids from ``begin`` to before ``end`` of the whole corpus, as the cut lists of the documents that hold them."""
        files = [(p, start) for p, start, stop in self.parts if start < end and stop > begin]
        if not files:
            return self.documents().limit(0)
        (lead, lead_start), (last, last_start) = files[0], files[-1]
        # Plain comparisons of stored columns, which files, row groups and pages are skipped by.
        rows = self.rows.where(F.col("part").between(lead, last))
        rows = rows.where((F.col("part") > lead) | (F.col("first") + F.col("n_tokens") > begin - lead_start))
        rows = self._placed(rows.where((F.col("part") < last) | (F.col("first") < end - last_start)))
        skipped = F.greatest(F.lit(begin) - F.col("start"), F.lit(0))
        length = F.least(F.lit(end) - F.col("start"), F.col("n_tokens")) - skipped
        return rows.withColumns({
            "tokens": F.slice("tokens", (skipped + 1).cast("int"), length.cast("int")),
            "start": F.col("start") + skipped, "n_tokens": length,
        })


def _checksums(batches: Iterator[pa.RecordBatch], tokens: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(tokens)
        offsets = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        sums_ = [zlib.crc32(values[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
        kept = batch.drop_columns([tokens])
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sums_, pa.int64())], names=schema.names)


def with_checksum(df: DataFrame, out: str, *, tokens: str = "tokens") -> DataFrame:
    """``df`` with the unsigned CRC-32 of each list, its ids as little-endian 32-bit integers, in place of the list."""
    kept = df.select(*[c for c in df.columns if c not in (tokens, out)], tokens)
    schema = T.StructType([*kept.drop(tokens).schema.fields, T.StructField(out, T.LongType())])
    return kept.mapInArrow(partial(_checksums, tokens=tokens, schema=to_arrow_schema(schema)), schema)
