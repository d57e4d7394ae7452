"""License scan: MinHash bands over overlapping text windows retrieve templates, shingles verify.

Words are runs of letters and digits, lower-cased; shingles are five consecutive words.  A
template of fewer words is one shingle of all its words, in a group of its own length, and is
found as that sequence of words; one without words is an error.  The
shingles of the texts lie in windows of three blocks, one block apart, so that every stretch of
up to two blocks is inside a window.  Templates are grouped by length; a group's block is
its longest template (``MIN_BLOCK`` at least).  A window that holds c = ceil(least * s) of the s
shingles of a template has a Jaccard similarity with it of at least

    J = c / (window + s - c)

and bands of one row collide with probability 1 - (1 - J)^bands; ``bands_for`` takes the number of
bands that brings this to ``PROBABILITY`` for the shortest template of the group.  (More rows in a
band would need far more bands for the short notices that are scanned for.)

A window that collides with a template in any band is then verified: the exact containment of the
template's shingles, as words, in the window.  A document has a license when a window
contains at least ``least`` of the template.

A task works on the texts of an Arrow batch, part by part; templates are a fixed list.
Defined results: NULL or empty texts, and texts shorter than a template's shingle, do not have
that license.  Repeated rows each get their rows, NULL doc_id included.  Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.llm.text import WordHash, gram_hashes, in_arrow, read_table, schema_of, with_id

SHINGLE_WORDS = 5
LEAST = 0.8
PROBABILITY = 0.9999
MIN_BLOCK = 8
TOGETHER = 200_000
TOKEN = re.compile(r"[^\W_]+")

# Short license statements and the opening notices of common public licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                         "with the License. You may obtain a copy of the License at",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                  "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                  "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                  "conditions are met",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                  "as published by the Free Software Foundation",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


class TextHash(WordHash):
    """Word hashes of ``str`` words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode())
        return h


def words_of(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def shingles(words: list[str], gram: int = SHINGLE_WORDS) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + gram]) for i in range(len(words) - gram + 1)}


def bands_for(s: int, window: int, least: float = LEAST, probability: float = PROBABILITY) -> int:
    """Bands of one row that make a template of s shingles collide with such a window often enough."""
    j = min(1.0, math.ceil(least * s) / (window + s - math.ceil(least * s)))
    return 1 if j == 1 else math.ceil(math.log(1 - probability) / math.log(1 - j))


class Group:
    """Templates of similar length, by shingles of ``gram`` words, with their MinHash signatures."""

    def __init__(self, templates: dict[str, list[str]], least: float, gram: int = SHINGLE_WORDS):
        self.gram = gram
        self.sets = {name: shingles(words, gram) for name, words in templates.items()}
        sizes = [len(s) for s in self.sets.values()]
        self.block = max(MIN_BLOCK, *sizes)
        self.bands = bands_for(min(sizes), 3 * self.block, least)
        memory = TextHash()
        own = [base_hash(gram_hashes(np.fromiter(map(memory.__getitem__, w), np.uint64, len(w)), gram)) for w in templates.values()]
        self.names = list(templates)
        signatures = np.array([[(h * m).min() for h in own] for m in multipliers(self.bands)], np.uint32)     # bands x templates
        # Per band its buckets: ascending values, and the templates in each.
        self.buckets: list[tuple[np.ndarray, list[list[int]]]] = []
        for signature in signatures:
            values, at = np.unique(signature, return_inverse=True)
            self.buckets.append((values, [np.flatnonzero(at == i).tolist() for i in range(len(values))]))


def multipliers(n: int) -> np.ndarray:
    """``n`` odd multipliers; the first ones are the same for every ``n``."""
    return (np.random.default_rng(20).integers(0, 1 << 31, max(n, 4096), dtype=np.uint32)[:n] << np.uint32(1)) | np.uint32(1)


def base_hash(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(32)).astype(np.uint32)


def grouped(templates: dict[str, str], least: float = LEAST) -> list[Group]:
    """Templates by length: a group's longest has at most four times the shingles of its shortest, or fits MIN_BLOCK.

    Templates of fewer than ``SHINGLE_WORDS`` words are grouped by their number of words.
    """
    words_by = {n: words_of(t) for n, t in templates.items()}
    if empty := sorted(n for n, words in words_by.items() if not words):
        raise ValueError(f"license templates without a word: {', '.join(empty)}")
    by_size = sorted((len(shingles(words)), n, words) for n, words in words_by.items() if len(words) >= SHINGLE_WORDS)
    groups: list[list] = []
    for size, name, words in by_size:
        if groups and size <= max(MIN_BLOCK, 4 * groups[-1][0][0]):
            groups[-1].append((size, name, words))
        else:
            groups.append([(size, name, words)])
    short = [Group({n: words for n, words in words_by.items() if len(words) == gram}, least, gram)
             for gram in sorted({len(words) for words in words_by.values() if len(words) < SHINGLE_WORDS})]
    return short + [Group({n: w for _, n, w in g}, least) for g in groups]


def colliding(hashes: np.ndarray, group: Group) -> list[tuple[int, str]]:
    """(first shingle, template) of the windows of a stream of shingle hashes that collide in a band."""
    blocks = -(-len(hashes) // group.block)
    padded = np.full(blocks * group.block, hashes[-1], np.uint32)
    padded[: len(hashes)] = hashes
    columns = np.ascontiguousarray(padded.reshape(blocks, group.block).T)
    hit: set[tuple[int, int]] = set()
    for m, (values, members) in zip(multipliers(group.bands), group.buckets):
        lowest = (columns * m).min(axis=0)
        window = lowest.copy()
        window[:-1] = np.minimum(window[:-1], lowest[1:])
        window[:-2] = np.minimum(window[:-2], lowest[2:])
        bucket = np.minimum(np.searchsorted(values, window), len(values) - 1)      # looked up, however many templates there are
        for w in np.flatnonzero(values[bucket] == window).tolist():
            hit.update((k, w) for k in members[bucket[w]])
    return [(w * group.block, group.names[k]) for k, w in sorted(hit)]


def found_in(texts: list[list[str]], groups: list[Group], memory: TextHash, least: float) -> list[dict[str, list]]:
    """Per text {license: [shingles found, first word, windows]}, of its best window."""
    out: list[dict[str, list]] = [{} for _ in texts]
    hashes = [np.fromiter(map(memory.__getitem__, w), np.uint64, len(w)) for w in texts]
    for gram in sorted({group.gram for group in groups}):
        long = [i for i, w in enumerate(texts) if len(w) >= gram]
        if not long:
            continue
        streams = [base_hash(gram_hashes(hashes[i], gram)) for i in long]
        begins = np.cumsum([0, *map(len, streams)])
        stream = np.concatenate(streams)
        for group in groups:
            if group.gram != gram:
                continue
            for first, name in colliding(stream, group):
                # the part of the window in each text it lies in
                last = min(first + 3 * group.block, len(stream))
                k = int(np.searchsorted(begins, first, side="right")) - 1
                while k < len(long) and begins[k] < last:
                    low, high = max(first, begins[k]) - begins[k], min(last, begins[k + 1]) - begins[k]
                    words = texts[long[k]][low : high + gram - 1]
                    wanted = group.sets[name]
                    common = len(wanted & shingles(words, gram))
                    if common >= least * len(wanted):
                        got = out[long[k]].setdefault(name, [0, int(low), 0])
                        got[2] += 1
                        if common > got[0]:
                            got[0], got[1] = common, int(low)
                    k += 1
    return out


def scanned(docs: DataFrame, templates: dict[str, str] = TEMPLATES, text: str = "text", doc_id: str = "doc_id", least: float = LEAST) -> DataFrame:
    """(doc_id, license, n_template, n_found, containment, first_word, n_windows) of every license in a row of ``docs``."""
    grouped(templates, least)               # templates without words fail here, not in a task
    out = with_id(docs, doc_id, "license string, n_template long, n_found long, containment double, first_word long, n_windows long")
    schema = schema_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, memory = grouped(templates, least), TextHash()
        sizes = {n: len(s) for g in groups for n, s in g.sets.items()}
        for b in batches:
            rows, texts, n = [], [], 0
            for i in range(b.num_rows + 1):
                if i < b.num_rows:
                    words = words_of(b.column(1)[i].as_py())
                    rows.append(i)
                    texts.append(words)
                    n += len(words)
                if texts and (n > TOGETHER or i == b.num_rows):
                    made = [(r, name, sizes[name], c, c / sizes[name], first, k)
                            for r, found in zip(rows, found_in(texts, groups, memory, least)) for name, (c, first, k) in sorted(found.items())]
                    cols = list(zip(*made)) or [[]] * 7
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(cols[0], pa.int64())),
                                                      *[pa.array(c, f.type) for c, f in zip(cols[1:], list(schema)[1:])]], schema=schema)
                    rows, texts, n = [], [], 0

    return in_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, out)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses found in all documents."""
    return scanned(read_table(spark, sf_dir, "documents")).drop("n_windows")
