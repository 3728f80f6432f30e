"""Licence scan: sparse TF-IDF cosine to templates, and inheritance from the nearest directory with a licence.

A file is read as lines, paragraphs and as a whole; each is compared with every template by the cosine of TF-IDF vectors.
The document frequencies of the templates' words are counted over all files; other words weigh as much as a word that one
file has. The best unit of at least ``THRESHOLD`` is the file's own licence. A file is a *licence file* of its directory if
its name says so or that unit has at least half of its words. A file without a licence of its own inherits that of the
licence file in its directory or else in the nearest directory above.

Directories, not files, are joined to the directories above them, so a directory that holds a third of all files is one
row until the end. Null and empty texts have no licence of their own; a null path has no directory and inherits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.llm.common import PerWorker, Work, append_columns, slices
from clinspark.llm.fm_index import split_words
from clinspark.staging import Staging

THRESHOLD = 0.8
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|copyright|unlicense)([.-][^/]*)?$"

#: Short notices by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
                   " compliance with the License. You may obtain a copy of the License at"
                   " http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            ' documentation files (the "Software"), to deal in the Software without restriction'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
                " Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
                     " that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
            " granted"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)

OWN = T.StructType([
    T.StructField("licence", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("share", T.DoubleType()),
])


class Templates:
    """Weighted, normalised templates over the words that occur in any of them."""

    def __init__(self, given: tuple[tuple, dict[str, int], int]) -> None:
        templates, df, files = given
        words = [split_words([text])[1].to_pylist() for _, text in templates]
        self.names = [name for name, _ in templates]
        vocabulary = sorted({w for own in words for w in own})
        self.vocabulary = pa.array(vocabulary, pa.large_string())
        place = {w: i for i, w in enumerate(vocabulary)}
        self.idf = np.log((files + 1) / (np.array([df.get(w, 0) for w in vocabulary]) + 1)) + 1
        self.other = np.log((files + 1) / 2) + 1
        vectors = np.zeros((len(templates), len(vocabulary)))
        for row, own in zip(vectors, words):
            for w in own:
                row[place[w]] += self.idf[place[w]]
        self.vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)

    def best(self, counts: np.ndarray, known: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """The highest cosine of each run of ``counts`` words, and its template; 0 where it can't reach ``floor``."""
        score, name = np.zeros(len(counts)), np.zeros(len(counts), np.int64)
        run = np.repeat(np.arange(len(counts)), counts)
        inside = known >= 0
        foreign = np.bincount(run[~inside], minlength=len(counts))
        own = np.bincount(run[inside], weights=self.idf[known[inside]], minlength=len(counts))
        # The words of the templates weigh at most this much together, the others at least that much.
        able = np.flatnonzero((own > 0) & (own * np.sqrt(1 - floor * floor) >= floor * self.other * np.sqrt(foreign)))
        place = np.full(len(counts), -1)
        for start in range(0, len(able), 1024):
            part = able[start:start + 1024]
            place[:] = -1
            place[part] = np.arange(len(part))
            mine = inside & (place[run] >= 0)
            vectors = np.zeros((len(part), len(self.idf)))
            np.add.at(vectors, (place[run[mine]], known[mine]), self.idf[known[mine]])
            length = np.sqrt((vectors * vectors).sum(axis=1) + foreign[part] * self.other ** 2)
            found = vectors @ self.vectors.T / length[:, None]
            name[part], score[part] = found.argmax(axis=1), found.max(axis=1)
        return score, name


def _own(sent: PerWorker, floor: float) -> Work:
    templates = sent()

    def work(texts: list[str | None]) -> list[list]:
        lines = [(t or "").split("\n") for t in texts]
        counts, words = split_words([line for own in lines for line in own])
        coded = words.dictionary_encode()
        known = pc.fill_null(pc.index_in(coded.dictionary, value_set=templates.vocabulary), -1).to_numpy(zero_copy_only=False)
        known = known.astype(np.int64)[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(texts)), [len(own) for own in lines])
        total = np.bincount(of, weights=counts, minlength=len(texts))
        blank = counts == 0
        first = np.diff(of, prepend=-1) != 0
        paragraph = np.cumsum(first | blank | np.concatenate(([False], blank[:-1])))
        best: list[tuple[float, float, str] | None] = [None] * len(texts)
        for unit in (np.arange(len(counts)), paragraph - 1, of):
            sizes = np.bincount(unit, weights=counts, minlength=int(unit.max()) + 1).astype(np.int64)
            owner = np.zeros(len(sizes), np.int64)
            owner[unit] = of
            score, name = templates.best(sizes, known, floor)
            for i in np.flatnonzero(score >= floor).tolist():
                doc = owner[i]
                found = (round(float(score[i]), 6), float(sizes[i] / total[doc]), templates.names[name[i]])
                if best[doc] is None or found > best[doc]:
                    best[doc] = found
        return [[b and {"licence": b[2], "score": b[0], "share": b[1]} for b in best]]

    return work


def _frequencies(batches: Iterator[pa.RecordBatch], vocabulary: list[str]) -> Iterator[pa.RecordBatch]:
    sought = pa.array(vocabulary, pa.large_string())
    seen, files = np.zeros(len(vocabulary), np.int64), 0
    for batch in batches:
        for part in slices(batch, "text"):
            counts, words = split_words(part.column("text").to_pylist())
            files += part.num_rows
            if len(words):
                coded = words.dictionary_encode()
                known = pc.fill_null(pc.index_in(coded.dictionary, value_set=sought), -1).to_numpy(zero_copy_only=False)
                known = known.astype(np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
                owner = np.repeat(np.arange(len(counts)), counts)[known >= 0]
                pairs = np.unique(owner * len(vocabulary) + known[known >= 0])
                seen += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
    yield pa.RecordBatch.from_arrays(
        [pa.array([*vocabulary, None], pa.string()), pa.array([*seen.tolist(), files], pa.int64())], names=["word", "n"])


def document_frequencies(files: DataFrame, templates=TEMPLATES, *, text: str = "text") -> tuple[dict[str, int], int]:
    """In how many files each word of the templates occurs, and the number of files."""
    vocabulary = sorted({w for _, t in templates for w in split_words([t])[1].to_pylist()})
    rows = (
        files.select(F.col(text).alias("text")).mapInArrow(partial(_frequencies, vocabulary=vocabulary), "word string, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n")).collect()  # one row for each word of the templates
    )
    found = {r["word"]: r["n"] for r in rows}
    return found, found.pop(None, 0)


def directory(path: str) -> F.Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def above(folder: str) -> F.Column:
    """A directory and all above it, with their depths; the root is the empty path."""
    parts = F.split(folder, "/", -1)
    return F.concat(F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("holder"))), F.when(
        F.col(folder) != "", F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(
            i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("holder")))).otherwise(F.array()))


def scan_licences(
    files: DataFrame, staging: Staging, *, path: str = "path", text: str = "text", templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``files`` without ``text``, with ``own_licence, own_score, inherited_licence, inherited_from, licence``."""
    df, n = document_frequencies(files, templates, text=text)
    sent = PerWorker(files.sparkSession, (tuple(templates), df, n), Templates)
    new = ["own", "own_licence", "own_score", "inherited_licence", "inherited_from", "licence", "folder"]
    rows = append_columns(files.drop(*new), text, [T.StructField("own", OWN)], partial(_own, sent, threshold))
    rows = staging.table(rows.drop(text).withColumn("folder", directory(path)))

    says = F.col(path).rlike(LICENCE_FILE) | (F.col("own.share") >= 0.5)
    best = F.max(F.struct(F.col("own.score").alias("score"), F.col("own.licence").alias("licence")))
    holders = rows.where(F.col("own").isNotNull() & F.col("folder").isNotNull() & says).groupBy(
        F.col("folder").alias("holder")).agg(best.alias("best"))
    folders = rows.select("folder").where("folder is not null").distinct()
    inherited = (
        folders.select("folder", F.inline(above("folder"))).join(holders, "holder")
        .groupBy("folder").agg(F.max(F.struct("depth", "holder", F.col("best.licence").alias("licence"))).alias("found"))
        .select("folder", F.col("found.licence").alias("inherited_licence"), F.col("found.holder").alias("inherited_from"))
    )
    kept = [c for c in rows.columns if c not in new]
    none = F.col("own").isNull()
    return rows.join(staging.table(inherited), "folder", "left").select(
        *kept, F.col("own.licence").alias("own_licence"), F.col("own.score").alias("own_score"),
        F.when(none, F.col("inherited_licence")).alias("inherited_licence"),
        F.when(none, F.col("inherited_from")).alias("inherited_from"),
        F.coalesce("own.licence", "inherited_licence").alias("licence"))
