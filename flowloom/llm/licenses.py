"""Licence scans: TF-IDF cosine to licence templates, then inheritance from the nearest directory.

Units are the file as a whole, runs of its lines, runs of its paragraphs and its comments; templates are
header sentences and whole licence texts.  Weights of terms come from the number of
documents of the whole corpus that hold them.  Units that cannot reach the threshold even if all terms
outside the templates had the least weight are dropped; the others are compared, each distinct unit once,
with the counted weights of all their terms.  A unit close enough to a template gives the file that licence.  Licence files (by name,
or by the whole text) declare the licence of their directory, and files without a licence of their own
take the one of the nearest directory above that declares one, found by joins on paths.

Defined cases: null and empty texts hold no licence; a null path is a file of no directory and inherits
nothing; equal cosines go to the first name in order; several declarations in a directory are decided by
cosine, then name; rows that repeat are each reported; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.sized import keep, lookup_join

# Header lines of public licences.  Fixed values.
TEMPLATES = {
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    "mit": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "bsd-3-clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Use of this source code is governed by a BSD-style license."),
    "gpl-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "This work is licensed under the GNU General Public License, version 3."),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "cc-by-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "proprietary": ("All rights reserved.",),
}
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$"
#: Whole licence texts, without the lines that name a holder.  The Creative Commons texts are not among them.
TEXTS = {p.stem: p.read_text() for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
ALL = {name: (*lines, *([TEXTS[name]] if name in TEXTS else [])) for name, lines in TEMPLATES.items()}
#: A statement that other licences come with; it counts only where no other licence is found.
WEAK = "proprietary"
#: Lines of a block, and blocks, that may form a unit; whole comments do without this bound.
LINES, BLOCKS = 12, 8
COMMENT = re.compile(r"(?i)\s*(//|/\*|\*|#|<!--|--|;|%|\"{3}|'{3}|\.\.\s|dnl\b|rem\b)")
OPENING = re.compile(r"\s*(/\*|<!--|\"{3}|'{3})")
CLOSING = {"/*": "*/", "<!--": "-->", '"""': '"""', "'''": "'''"}
#: Terms a task counts before it passes them on.
HELD = 1 << 18
TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


@dataclass
class Index:
    """Template vectors of unit length, the weight of each template term, and the weight of a term that one document holds."""

    weight: dict[str, float]
    unseen: float
    names: list[str]
    postings: dict[str, list[tuple[int, float]]]
    required: frozenset[str]
    squares: list[dict[str, float]]
    threshold: float

    def alive(self, words: list[str]) -> list[int]:
        """The templates of which the words hold enough for a part of them to reach the threshold."""
        if self.required.isdisjoint(words):
            return []
        held = set(words)
        return [t for t, square in enumerate(self.squares) if math.fsum(square[w] for w in square.keys() & held) >= self.threshold**2 - 1e-9]

    def best(self, words: list[str], threshold: float, others: Mapping[str, float] | None = None, other: float | None = None) -> tuple[float, str] | None:
        """Highest cosine of at least the threshold and the licence's name.

        ``others`` are weights of terms outside the templates; ``other`` is the weight of any that have none.
        """
        if self.required.isdisjoint(words):
            return None
        counts, others, other = Counter(words), others or {}, self.unseen if other is None else other
        square = math.fsum((self.weight.get(w) or others.get(w, other)) ** 2 * n * n for w, n in counts.items())
        dots: Counter[int] = Counter()
        for w, n in counts.items():
            for t, value in self.postings.get(w, ()):
                dots[t] += self.weight[w] * n * value
        scored = [(dot / math.sqrt(square), self.names[t]) for t, dot in dots.items()]
        good = [x for x in scored if x[0] >= threshold]
        return min(good, key=lambda x: (-round(x[0], 12), x[1])) if good else None

    def may_match(self, words: list[str], threshold: float) -> bool:
        """Whether the cosine can reach the threshold: no term of the corpus weighs less than 1."""
        return self.best(words, threshold - 1e-9, other=1.0) is not None


def build_index(templates: Mapping[str, tuple[str, ...]], counts: Mapping[str, int], n_docs: int, threshold: float) -> Index:
    """Vectors of the templates.

    ``required`` are terms of which a unit must hold one: the common terms of a template alone cannot
    reach the threshold, so texts without any required term need no vector.
    """
    weight = {w: math.log((n_docs + 1) / (counts.get(w, 0) + 1)) + 1 for lines in templates.values() for x in lines for w in terms(x)}
    names, postings, required, squares = [], {}, set(), []
    for name, lines in sorted(templates.items()):
        for line in lines:
            vector = {w: weight[w] * n for w, n in Counter(terms(line)).items()}
            norm = math.sqrt(math.fsum(v * v for v in vector.values()))
            left = 0.0
            for w in sorted(vector, key=lambda w: (weight[w], w)):
                left += (vector[w] / norm) ** 2
                if math.sqrt(left) >= threshold - 1e-9:
                    required.add(w)
                postings.setdefault(w, []).append((len(names), vector[w] / norm))
            names.append(name)
            squares.append({w: (v / norm) ** 2 for w, v in vector.items()})
    return Index(weight, math.log((n_docs + 1) / 2) + 1, names, postings, frozenset(required), squares, threshold)


def document_counts(files: DataFrame) -> DataFrame:
    """``term, n``: documents of the corpus that hold each term; the empty term stands for all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen[""] += 1
                seen.update(set(terms(text or "")))
                if len(seen) > HELD:
                    yield pa.RecordBatch.from_pydict({"term": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
                    seen.clear()
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    return files.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def directory(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def blocks(text: str) -> list[list[tuple[int, list[str], bool]]]:
    """Runs of consecutive lines with terms (number, terms, whether it is a comment), cut where comments begin or end."""
    out: list[list[tuple[int, list[str], bool]]] = [[]]
    closing = ""
    for k, line in enumerate(text.splitlines(), 1):
        words, comment = terms(line), bool(closing) or COMMENT.match(line) is not None
        mark = OPENING.match(line)
        if closing or mark:
            closing = closing or CLOSING[mark[1]]
            if closing in line[0 if not mark else mark.end() :]:
                closing = ""
        if not words or (out[-1] and out[-1][-1][2] != comment):
            out.append([])
        if words:
            out[-1].append((k, words, comment))
    return [b for b in out if b]


def units(text: str, index: Index, alive: list[int]) -> Iterator[tuple[int, list[str]]]:
    """Number of the first line and terms of what may be a licence.

    These are the whole text (number 0), runs of up to ``LINES`` lines of a block, and runs of blocks: up to
    ``BLOCKS`` of any kind, and whole comments.  Lines or blocks without a term of a template that is
    ``alive`` are at no end of a run.
    """
    yield 0, terms(text)
    parts = blocks(text)
    for block in parts:
        yield from runs([(k, words) for k, words, _ in block], LINES, index, alive)
    whole = [(b[0][0], [w for _, words, _ in b for w in words]) for b in parts]
    yield from runs(whole, BLOCKS, index, alive)
    at = 0
    while at < len(parts):
        end = at + 1
        while end < len(parts) and parts[end][0][2] == parts[at][0][2]:
            end += 1
        if parts[at][0][2] and end - at > BLOCKS:
            yield whole[at][0], [w for _, words in whole[at:end] for w in words]
        at = end


def runs(pieces: list[tuple[int, list[str]]], most: int, index: Index, alive: list[int]) -> Iterator[tuple[int, list[str]]]:
    """Runs of up to ``most`` pieces that begin and end with a term of a template that is alive."""
    wanted = [any(not index.squares[t].keys().isdisjoint(words) for t in alive) for _, words in pieces]
    for i, (k, _) in enumerate(pieces):
        run: list[str] = []
        for j in range(i, min(len(pieces), i + most) if wanted[i] else i):
            run = run + pieces[j][1]
            if wanted[j]:
                yield k, run


def candidates(files: DataFrame, index: Broadcast, threshold: float) -> DataFrame:
    """``id, path, units``: per file the units whose cosine can reach the threshold, as number, key and terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index_here = index.value
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                found = {}
                alive = index_here.alive(terms(text or ""))
                if alive:
                    for k, words in units(text, index_here, alive):
                        joined = " ".join(words)
                        if joined not in found and index_here.may_match(words, threshold):
                            found[joined] = {"line": k, "key": hashlib.sha256(joined.encode()).hexdigest(), "words": joined}
                out.append(list(found.values()))
            kind = pa.list_(pa.struct([("line", pa.int32()), ("key", pa.string()), ("words", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("path"), pa.array(out, kind)], names=["id", "path", "units"])

    return files.mapInArrow(run, "id long, path string, units array<struct<line:int,key:string,words:string>>")


def judged_units(distinct: DataFrame, counted: DataFrame, index: Broadcast, n_docs: int, threshold: float) -> DataFrame:
    """``key, own, cosine`` of the distinct units (``key, words``) that reach the threshold under the weights of the corpus."""

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, w) for k, words in zip(batch.column("key").to_pylist(), batch.column("words").to_pylist(), strict=True) for w in sorted(set(words.split(" ")) - index.value.weight.keys())]
            yield pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in found], pa.string()), "term": pa.array([w for _, w in found], pa.string())})

    outside = keep(distinct.mapInArrow(others, "key string, term string"))
    weight = (F.log((n_docs + 1) / (F.col("n") + 1)) + 1).alias("weight")
    weights = counted.join(outside.select("term").distinct(), "term", "left_semi").select("term", weight)
    per_unit = lookup_join(outside, weights, ["term"], ["key"], "inner").groupBy("key").agg(F.collect_list("term").alias("terms"), F.collect_list("weight").alias("weights"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                others = dict(zip(row["terms"] or (), row["weights"] or (), strict=True))
                found = index.value.best(row["words"].split(" "), threshold, others)
                if found:
                    out.append({"key": row["key"], "cosine": found[0], "own": found[1]})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("key", pa.string()), ("cosine", pa.float64()), ("own", pa.string())]))

    return distinct.join(per_unit, "key", "left").select("key", "words", "terms", "weights").mapInArrow(run, "key string, cosine double, own string")


def own_licences(files: DataFrame, threshold: float, templates: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """``id, path, own, cosine, line`` (the first line of the best unit, 0 for the whole text), ``whole`` (the whole text is a licence)."""
    vocabulary = sorted({w for lines in templates.values() for x in lines for w in terms(x)})
    counted = keep(document_counts(files))
    counts = {r["term"]: r["n"] for r in counted.filter(F.col("term").isin(["", *vocabulary])).collect()}  # bounded by the templates
    n_docs = counts.pop("", 0)
    index = files.sparkSession.sparkContext.broadcast(build_index(templates, counts, n_docs, threshold))
    rows = keep(candidates(files, index, threshold).select(F.monotonically_increasing_id().alias("row"), "*"))
    each = rows.select("row", F.explode("units").alias("u")).select("row", "u.*")
    distinct = keep(each.select("key", "words").distinct())
    judged = judged_units(distinct, counted, index, n_docs, threshold)
    found = lookup_join(each.drop("words"), judged, ["key"], ["row", "line"], "inner")
    best = F.min(F.struct((F.col("own") == WEAK).alias("weak"), (-F.round("cosine", 12)).alias("c"), "own", "line", "cosine")).alias("b")
    per_row = found.groupBy("row").agg(best, F.max(F.col("line") == 0).alias("whole"))
    out = rows.drop("units").join(per_row, "row", "left")
    return out.select("id", "path", F.col("b.own").alias("own"), F.col("b.cosine").alias("cosine"), F.col("b.line").alias("line"), F.coalesce("whole", F.lit(False)).alias("whole"))


def scan(files: DataFrame, threshold: float = 0.8, templates: Mapping[str, tuple[str, ...]] = ALL) -> DataFrame:
    """``id, path, own, cosine, line, licence, origin`` per file of ``id, path, text``.

    ``licence`` is the file's own or the inherited one, ``origin`` the directory it came from (null if own).
    """
    files = files.select(F.col("id").cast("long").alias("id"), F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    found = keep(own_licences(files, threshold, templates))
    name = F.regexp_extract("path", "[^/]*$", 0)
    declaring = found.filter(F.col("own").isNotNull() & F.col("path").isNotNull() & (name.rlike(LICENCE_FILE) | F.col("whole")))
    best = F.min(F.struct((F.col("own") == WEAK).alias("weak"), (-F.round("cosine", 12)).alias("c"), "own")).alias("b")
    declared = keep(declaring.groupBy(directory(F.col("path")).alias("dir")).agg(best).select("dir", F.col("b.own").alias("licence")))
    dirs = found.filter("own IS NULL AND path IS NOT NULL").select(directory(F.col("path")).alias("home")).distinct()
    parts = F.split("home", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("dir")))
    chain = dirs.select("home", F.explode(F.array_distinct(above)).alias("a")).select("home", "a.depth", "a.dir")
    nearest = chain.join(declared, "dir").groupBy("home").agg(F.max(F.struct("depth", "dir", "licence")).alias("n"))
    nearest = keep(nearest.select("home", F.col("n.licence").alias("inherited"), F.col("n.dir").alias("origin")))
    joined = found.withColumn("home", F.when(F.col("own").isNull(), directory(F.col("path")))).join(nearest, "home", "left")
    return joined.select("id", "path", "own", "cosine", "line", F.coalesce("own", "inherited").alias("licence"), "origin")
