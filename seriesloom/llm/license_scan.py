"""Licence scans: TF-IDF cosine of lines to licence templates, and inheritance along directories.

Every line of a text is a possible header.  The weights of the template terms come
from the number of lines of the whole corpus that hold them; a term of no template weighs as
one seen once.  Files without a licence of their own inherit that of the licence
files of their nearest ancestor directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.llm.common import raw_texts, text_slices
from seriesloom.staging import stage

# Public licence notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Proprietary", "All rights reserved."),
]
THRESHOLD = 0.75
LICENSE_FILE = r"(?i)^(?:licen[cs]e|copying|notice)"
_FIND = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+").findall


def terms_of(line: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of characters beyond ASCII."""
    return _FIND(line.lower())


def line_frequencies(texts: DataFrame, vocabulary: frozenset[bytes]) -> tuple[int, dict[bytes, int]]:
    """Number of lines with a term in all texts, and of those that hold each template term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, holding = 0, Counter()
        for batch in batches:
            for part in text_slices(batch):
                for text in raw_texts(part):
                    for line in text.split(b"\n"):
                        terms = terms_of(line)
                        lines += bool(terms)
                        holding.update(vocabulary.intersection(terms))
        found = [(b"", lines), *holding.items()]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64())], names=["term", "n"])

    rows = texts.mapInArrow(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # one row per template term
    counts = {bytes(row["term"]): row["n"] for row in rows}
    return counts.pop(b"", 0), counts


class Matcher:
    """Cosines of one line to all templates."""

    def __init__(self, lines: int, frequencies: dict[bytes, int], templates=TEMPLATES, threshold: float = THRESHOLD):
        weight = lambda n: math.log((1 + lines) / (1 + n)) + 1
        self.names, self.threshold, self.unknown = [name for name, _ in templates], threshold, weight(1)
        counts = [Counter(terms_of(text.encode())) for _, text in templates]
        self.weights = {term: weight(frequencies.get(term, 0)) for one in counts for term in one}
        self.vectors = [{term: n * self.weights[term] for term, n in one.items()} for one in counts]
        self.norms = [math.sqrt(sum(x * x for x in vector.values())) for vector in self.vectors]

    def best(self, line: bytes) -> tuple[float, int] | None:
        """Largest cosine and its template, the first of equal ones; None below the threshold."""
        terms = terms_of(line)
        known = Counter(filter(self.weights.__contains__, terms))
        if not known:
            return None
        inside = {term: n * self.weights[term] for term, n in known.items()}
        size = sum(x * x for x in inside.values())
        others = len(set(terms)) - len(known)
        if size < self.threshold**2 * (size + others * self.unknown**2) * (1 - 1e-9):
            return None  # no template can reach the threshold, however the other terms repeat
        size += sum((n * self.unknown) ** 2 for term, n in Counter(terms).items() if term not in known)
        found = max(((sum(x * vector.get(term, 0.0) for term, x in inside.items()) / (norm * math.sqrt(size)), -i) for i, (vector, norm) in enumerate(zip(self.vectors, self.norms, strict=True))))
        return (found[0], -found[1]) if found[0] >= self.threshold else None


def headers(
    files: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD, keep: Sequence[str] = ()
) -> DataFrame:
    """``key``, the columns ``keep``, license, cosine, last_line of every row: its best line, the first of equal ones.

    ``last_line`` tells whether that line is the last one with a term.  NULL and empty texts, and texts without a
    line that is similar enough, have a NULL license and cosine.  Repeated rows are scanned each; NULL keys
    stay; other columns are not read.
    """
    kept = [f"c{i}" for i in range(len(keep))]
    frame = files.select(F.col(key).alias("key"), F.col(text).alias("text"), *[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)])
    vocabulary = frozenset(term for _, template in templates for term in terms_of(template.encode()))
    matcher = Matcher(*line_frequencies(frame.select("text"), vocabulary), templates, threshold)
    schema = frame.select("key", *kept).schema.add("license", "string").add("cosine", "double").add("last_line", "boolean")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                names, cosines, last = [], [], []
                for text in raw_texts(part):
                    lines = [line for line in text.split(b"\n") if _FIND(line)]
                    best, at = (0.0, 0), -1
                    for i, line in enumerate(lines):
                        found = matcher.best(line)
                        if found and found[0] > best[0]:
                            best, at = found, i
                    names.append(matcher.names[best[1]] if at >= 0 else None)
                    cosines.append(best[0] if at >= 0 else None)
                    last.append(at == len(lines) - 1 if at >= 0 else None)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("key", *kept)), pa.array(names, pa.string()), pa.array(cosines, pa.float64()), pa.array(last, pa.bool_())], names=schema.names
                )

    return frame.mapInArrow(scan, schema).toDF(key, *keep, "license", "cosine", "last_line")


def directory_of(path: Column) -> Column:
    """Everything before the last slash; empty for a file at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherit(files: DataFrame, path: Column, license_file: str = LICENSE_FILE) -> DataFrame:
    """All rows of ``files`` (with license, cosine) with effective_license and origin ('own', 'inherited' or NULL).

    A directory has the licence of its licence files; of several the one with the largest cosine, then the first by name.
    Ancestors are joined once per directory, not per file.  A NULL path inherits nothing; the top is an
    ancestor of every path.
    """
    names = files.columns
    rows = files.select("*", path.alias("_path")).withColumn("_dir", directory_of(F.col("_path")))
    base = F.regexp_extract("_path", r"([^/]*)$", 1)
    given = rows.where(F.col("license").isNotNull() & base.rlike(license_file)).groupBy("_dir", "license").agg(F.max("cosine").alias("cosine"))
    best = W.partitionBy("_dir").orderBy(F.col("cosine").desc(), "license")
    declared = stage(given.withColumn("_n", F.row_number().over(best)).where("_n = 1").select(F.col("_dir").alias("ancestor"), F.col("license").alias("granted")), "declared")
    parts = F.split("_dir", "/")
    depth = F.when(F.col("_dir") == "", F.lit(0)).otherwise(F.size(parts))
    up = F.transform(F.sequence(F.lit(0), depth), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("ancestor")))
    ancestors = rows.select("_dir").where(F.col("_dir").isNotNull()).distinct().select("_dir", F.explode(up).alias("up")).select("_dir", "up.*")
    nearest = ancestors.join(declared, "ancestor").groupBy("_dir").agg(F.max(F.struct("depth", "granted")).alias("near"))
    nearest = stage(nearest.select(F.col("_dir").alias("_same_dir"), F.col("near.granted").alias("granted")), "nearest")
    joined = rows.join(nearest, F.col("_dir") == F.col("_same_dir"), "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("granted").isNotNull(), "inherited")
    return joined.select(*names, F.coalesce("license", "granted").alias("effective_license"), origin.alias("origin"))
