"""License scan: TF-IDF cosine to templates, then inheritance from the nearest directory that has a licence file.

A file's units are its lines (a header may stand anywhere), windows of consecutive lines of about a template's length
(the most lines that have no more words than it, and one more) and its whole text.  Lines are compared with the short
notices, windows and whole text with all templates, which are those and the headers and full texts in ``licences``.
Unit and template become sparse TF-IDF vectors over words; document frequencies of the templates' words are counted
over all files, any other word weighs as if no file had it, so a unit's cosine is never too high (for the
notices, any word that is in none of them).  Windows are made for
a template only where a file's words hold THRESHOLD squared of its squared weight: no window can reach THRESHOLD
without.  A file is a licence file if its whole text reaches THRESHOLD, and has a header if a line or window does.
Licence files give their directory a licence; a file without one of its own takes that of the nearest directory above
it, by joins of directories.

Cases: a null text, or one without words, has no licence of its own.  A null path is in no directory.  Equal cosines go
to the template that sorts first, equal licence files of a directory too.  Rows that repeat are judged alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaxmart.llm.common import cut, prepare

#: Short notices by licence name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LicenseRef-Reserved": "All rights reserved.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: Headers and full texts, several a licence: (licence, text).
TEXTS = [(p.name.rsplit(".", 2)[0], p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "licences").glob("*.txt"))]
THRESHOLD = 0.9
REMEMBERED = 50_000  # lines a task remembers
_WORD = re.compile(r"[^\W_]+")


def terms(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Matcher:
    """Cosines to the templates under given document frequencies."""

    def __init__(self, templates: dict[str, str], df: dict[str, int], n_files: int, texts: list[tuple[str, str]] = ()):
        self.idf = {t: math.log((1 + n_files) / (1 + c)) + 1 for t, c in df.items()}
        self.unknown = math.log(1 + n_files) + 1
        # The notices weigh every word but their own as unknown, whatever the longer texts hold.
        known = {t for text in templates.values() for t in terms(text)}
        self.notice_idf = {t: w for t, w in self.idf.items() if t in known}
        self.lists: dict[str, list[tuple[str, float]]] = {}
        for name in sorted(templates):
            vector = self._vector(terms(templates[name]), self.notice_idf)
            for t, w in vector.items():
                self.lists.setdefault(t, []).append((name, w))
        every = [(*x, self.notice_idf) for x in sorted(templates.items())] + [(*x, self.idf) for x in texts]
        self.all = [(name, len(terms(t)), self._vector(terms(t), idf), idf) for name, t, idf in every]
        self.row = {t: i for i, t in enumerate(df)}
        self.squares = np.zeros((len(self.row), len(self.all)))
        for k, (_, _, vector, _) in enumerate(self.all):
            for t, w in vector.items():
                self.squares[self.row[t], k] = w * w
        self.memory: dict[str, tuple[str | None, float]] = {}

    def _vector(self, found: list[str], idf: dict[str, float]) -> dict[str, float]:
        weights = {t: n * idf.get(t, self.unknown) for t, n in Counter(found).items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        return {t: w / norm for t, w in weights.items()} if norm else {}

    def best(self, unit: str) -> tuple[str | None, float]:
        if unit in self.memory:
            return self.memory[unit]
        found = terms(unit)
        cosines: dict[str, float] = {}
        # A cosine of THRESHOLD needs most of the weight on template words, hence some of them.
        if sum(t in self.lists for t in found) > 0:
            for t, w in self._vector(found, self.notice_idf).items():
                for name, v in self.lists.get(t, ()):
                    cosines[name] = cosines.get(name, 0.0) + w * v
        best = min(cosines, key=lambda name: (-round(cosines[name], 9), name), default=None)
        result = (best, min(1.0, cosines[best])) if best is not None else (None, 0.0)
        if len(unit) < 300:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            self.memory[unit] = result
        return result

    def window(self, lines: list[list[str]], size: int, vector: dict[str, float], idf: dict[str, float], over: bool) -> float:
        """Best cosine of consecutive lines of up to ``size`` words (``over``: of the first that have as many)."""
        counts: Counter = Counter()
        dot = square = best = 0.0
        end = words = 0
        for begin in range(len(lines)):
            while end < len(lines) and (words < size if over else words + len(lines[end]) <= size):
                for t in lines[end]:
                    w = idf.get(t, self.unknown)
                    square += w * w * (2 * counts[t] + 1)
                    counts[t] += 1
                    dot += w * vector.get(t, 0.0)
                words += len(lines[end])
                end += 1
            if end == begin:
                end += 1
                continue
            if square > 0:
                best = max(best, dot / math.sqrt(square))
            for t in lines[begin]:
                w = idf.get(t, self.unknown)
                counts[t] -= 1
                square -= w * w * (2 * counts[t] + 1)
                dot -= w * vector.get(t, 0.0)
            words -= len(lines[begin])
            if not words:
                dot = square = 0.0
        return min(1.0, best)

    def file(self, text: str | None) -> tuple[str | None, float, str | None, float]:
        """Best template of a line or window, and of the whole text; None below the threshold."""
        text = text or ""
        line = max((self.best(x) for x in text.splitlines()), key=lambda r: r[1], default=(None, 0.0))
        every = self.best(text)
        found = terms(text)
        held = self.squares[[self.row[t] for t in set(found) if t in self.row]].sum(axis=0)
        near = [self.all[k] for k in np.flatnonzero(held >= THRESHOLD ** 2 - 1e-9)]
        if near:
            lines = [x for x in map(terms, text.splitlines()) if x]
            for name, size, vector, idf in near:
                line = max(line, *((name, self.window(lines, size, vector, idf, over)) for over in (False, True)), key=lambda r: round(r[1], 9))
                whole = min(1.0, sum(w * vector.get(t, 0.0) for t, w in self._vector(found, idf).items()))
                every = max(every, (name, whole), key=lambda r: round(r[1], 9))
        return *(line if line[1] >= THRESHOLD else (None, line[1])), *(every if every[1] >= THRESHOLD else (None, every[1]))


def frequencies(files: DataFrame, templates: list[str]) -> dict[str, int]:
    """Files that hold each template word, over all files; one short row for each word and task, summed by Spark."""
    vocabulary = {t for text in templates for t in terms(text)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(vocabulary.intersection(terms(text or "")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    rows = files.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "term string, n long")
    found = {r["term"]: r["n"] for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return {t: found.get(t, 0) for t in vocabulary}


def scan(files: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per row of ``files`` (doc_id, path, text): doc_id, path, licence, cosine, how (header, file, inherited)."""
    prepare(files.sparkSession)
    texts = TEXTS if templates is None else []
    templates = TEMPLATES if templates is None else templates
    df, n_files = frequencies(files, [*templates.values(), *(t for _, t in texts)]), files.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, df, n_files, texts)
        for batch in batches:
            out = [matcher.file(t) for t in batch.column(2).to_pylist()]
            kinds = (pa.string(), pa.float64(), pa.string(), pa.float64())
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns],
                                             names=["doc_id", "path", "header", "header_cosine", "file", "file_cosine"])

    rows = files.select("doc_id", F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    own = cut(rows.mapInArrow(
        run, f"doc_id {id_type}, path string, header string, header_cosine double, file string, file_cosine double"), "licences")
    own = own.withColumn("dir", F.regexp_replace("path", "/?[^/]*$", ""))

    # Directories of files without a licence of their own, each with all directories above it; the deepest licence wins.
    given = own.where("file IS NOT NULL").groupBy("dir").agg(
        F.min(F.struct((-F.col("file_cosine")).alias("rank"), F.col("file").alias("licence")))["licence"].alias("inherited"))
    steps = F.split("dir", "/")
    above = own.where("file IS NULL AND header IS NULL AND dir IS NOT NULL").select("dir").distinct().select(
        "dir", F.explode(F.sequence(F.lit(0), F.size(steps))).alias("depth")).withColumn(
        "above", F.array_join(F.slice(steps, 1, F.col("depth")), "/"))
    nearest = above.join(given.withColumnRenamed("dir", "above"), "above").groupBy("dir").agg(
        F.max(F.struct("depth", "inherited"))["inherited"].alias("inherited"))
    best = own.join(nearest, "dir", "left")
    return best.select(
        "doc_id", "path",
        F.coalesce("file", "header", "inherited").alias("licence"),
        F.when(F.col("file").isNotNull(), F.col("file_cosine")).otherwise(F.col("header_cosine")).alias("cosine"),
        F.when(F.col("file").isNotNull(), "file").when(F.col("header").isNotNull(), "header")
        .when(F.col("inherited").isNotNull(), "inherited").alias("how"))
