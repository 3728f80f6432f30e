from __future__ import annotations

import math
import re

from clinspark.llm import licenses
from clinspark.llm.queries import QUERIES


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def brute(texts, threshold=licenses.THRESHOLD):
    """Best licence of each text by plain cosines of all lines, paragraphs and the whole."""
    df, n = {}, len(texts)
    for t in texts:
        for w in set(words(t)):
            df[w] = df.get(w, 0) + 1
    known = {w for _, t in licenses.TEMPLATES for w in words(t)}

    def vector(own):
        out, foreign = {}, 0
        for w in own:
            if w in known:
                out[w] = out.get(w, 0) + math.log((n + 1) / (df.get(w, 0) + 1)) + 1
            else:
                foreign += (math.log((n + 1) / 2) + 1) ** 2
        return out, math.sqrt(sum(v * v for v in out.values()) + foreign)

    templates = [(name, *vector(words(t))) for name, t in licenses.TEMPLATES]
    found = []
    for text in texts:
        best = None
        lines = (text or "").split("\n")
        paragraphs = re.split(r"\n(?:[^\n\w]*\n)+", text or "")
        for unit in {*lines, *paragraphs, text or ""}:
            v, length = vector(words(unit))
            if not v:
                continue
            score, name = max((round(sum(x * t.get(w, 0) for w, x in v.items()) / (length * size), 6), -i, name)
                              for i, (name, t, size) in enumerate(templates))[::2]
            if score >= threshold:
                best = max(best or (0,), (score, len(words(unit)) / len(words(text)), name))
        found.append(best and best[2])
    return found


def test_notices_and_inheritance(spark, staging):
    rows = [
        ("a/LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
                      " associated documentation files\n(the \"Software\"), to deal in the Software without restriction", 1),
        ("a/b/c/x.py", "import this", 2), ("a/b/COPYING", "Licensed under CC BY-NC 4.0.", 3),
        ("a/b/y.py", "# Licensed under the Apache License, Version 2.0.\ncode code code code\nmore of it", 4),
        ("z/w.py", "nothing here", 5), ("top.py", "nothing", 6), ("a/b/c/e.txt", None, 7), (None, "All rights reserved.", 8),
        (None, "no path", 9), ("a/bb/q", "", 10), ("a/b/c/x.py", "import this", 11),
    ]
    df = spark.createDataFrame([(*r, "own") for r in rows], "path string, text string, id int, licence string")
    found = {r["id"]: (r["own_licence"], r["licence"], r["inherited_from"])
             for r in licenses.scan_licences(df, staging).collect()}
    assert found == {
        1: ("MIT", "MIT", None), 2: (None, "CC-BY-NC-4.0", "a/b"), 3: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None),
        4: ("Apache-2.0", "Apache-2.0", None), 5: (None, None, None), 6: (None, None, None), 7: (None, "CC-BY-NC-4.0", "a/b"),
        8: ("Proprietary", "Proprietary", None), 9: (None, None, None), 10: (None, "MIT", "a"), 11: (None, "CC-BY-NC-4.0", "a/b")}


def test_edges(spark, staging, edge_docs, no_docs):
    named = edge_docs.withColumnRenamed("source", "path")
    assert len(licenses.scan_licences(named, staging).collect()) == edge_docs.count()
    assert licenses.scan_licences(no_docs.withColumnRenamed("source", "path"), staging).collect() == []


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    want = dict(zip((r["doc_id"] for r in docs), brute([r["text"] for r in docs])))
    rows = QUERIES["op10_licence_scan"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["own_licence"] for r in rows} == want and any(want.values())
    for r in rows:
        if r["inherited_from"] is not None:
            assert (r["path"] + "/").startswith(r["inherited_from"] + "/") and r["own_licence"] is None
