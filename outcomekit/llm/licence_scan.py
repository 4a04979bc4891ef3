"""Licence scan (operator 2): normalised text against licence templates by the
Dice coefficient over word bigrams.

Text is normalised to lower-case runs of letters and digits.  With a and b
bigrams the coefficient is at most 2 min(a, b) / (a + b), so a passage must
hold a fixed share of a template's bigrams within a bounded length.  The places
of the template's bigrams in a text are found first; where enough of them are
close together, every passage that begins and ends on one of them is compared
(a passage with other ends has a shorter one inside it that scores higher).
The result is the best passage of any place and length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.llm.common import table

LEAST_DICE = 0.8

# Notices by which texts commonly name their licence.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "You may not use this file except in compliance with the License."),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted",
                     "Licensed under the BSD 3-Clause License."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC0-1.0": ("Released under CC0 1.0.", "This work is dedicated to the public domain."),
    "Proprietary": ("All rights reserved.",),
}
RUN = re.compile(r"[^\W_]+")


def normalise(text: str) -> list[str]:
    return RUN.findall(text.lower())


def bigrams(words: list[str]) -> Counter[tuple[str, str]]:
    return Counter(zip(words, words[1:]))


def dice(a: Counter, b: Counter) -> float:
    size = a.total() + b.total()
    return 2 * (a & b).total() / size if size else 0.0


class Templates:
    def __init__(self, templates: dict[str, tuple[str, ...]], least: float):
        self.least = least
        self.all = [(name, grams) for name, texts in templates.items() for t in texts if (grams := bigrams(normalise(t)))]
        self.by_bigram: dict[tuple[str, str], list[int]] = {}
        for k, (_, grams) in enumerate(self.all):
            for g in grams:
                self.by_bigram.setdefault(g, []).append(k)
        # per template: common bigrams that a passage needs, bigrams that it has at most
        self.bounds = [(math.ceil(m * least / (2 - least) - 1e-9), math.floor(m * (2 / least - 1) + 1e-9))
                       for _, grams in self.all for m in [grams.total()]]

    def best(self, k: int, places: list[int], pairs: list[tuple[str, str]]) -> tuple[float, int]:
        """(coefficient, first word) of the best passage, (0, 0) if none reaches
        the least one; ``places`` are those of template ``k``'s bigrams."""
        grams = self.all[k][1]
        m, (needed, longest) = grams.total(), self.bounds[k]
        best = (0.0, 0)
        for i in range(len(places) - needed + 1):
            lo = places[i]
            if places[i + needed - 1] - lo >= longest:
                continue
            left, common = dict(grams), 0
            for j in range(i, len(places)):
                n = places[j] - lo + 1
                if n > longest:
                    break
                g = pairs[places[j]]
                if left[g]:
                    left[g] -= 1
                    common += 1
                    d = 2 * common / (n + m)
                    if d >= self.least and d > best[0]:
                        best = (d, lo)
        return best

    def matches(self, text: str) -> dict[str, tuple[float, int]]:
        """Licence -> (best coefficient, first word of the passage)."""
        found: dict[str, tuple[float, int]] = {}
        words = normalise(text)
        pairs = list(zip(words, words[1:]))
        places: dict[int, list[int]] = {}
        for at, ks in enumerate(map(self.by_bigram.get, pairs)):
            if ks:
                for k in ks:
                    places.setdefault(k, []).append(at)
        for k in sorted(places):
            name = self.all[k][0]
            d, at = self.best(k, places[k], pairs)
            if d > found.get(name, (0.0, 0))[0]:
                found[name] = (d, at)
        return found


def _scan(templates: dict[str, tuple[str, ...]], least: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, least)
        kind = pa.list_(pa.struct([("licence", pa.string()), ("dice", pa.float64()), ("first_word", pa.int64())]))
        for b in batches:
            out = []
            for text in b.column("t").to_pylist():
                hits = known.matches(text)
                out.append([{"licence": n, "dice": d, "first_word": at}
                            for n, (d, at) in sorted(hits.items(), key=lambda x: (-x[1][0], x[0]))])
            yield pa.record_batch([b.column("id"), pa.array(out, kind)], names=["id", "hits"])
    return scan


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, tuple[str, ...]] = TEMPLATES, least: float = LEAST_DICE) -> DataFrame:
    """``id, hits``: per row, the licences whose notice it holds, best first
    (ties by name).  Null and empty texts have none; repeated rows repeat."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    return src.mapInArrow(_scan(templates, least),
                          "id long, hits array<struct<licence:string,dice:double,first_word:bigint>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licences(table(spark, sf_dir, "documents"))
    best = F.get("hits", F.lit(0))
    return out.select(F.col("id").alias("doc_id"), best["licence"].alias("licence"), best["dice"].alias("dice"),
                      best["first_word"].alias("first_word"), F.size("hits").alias("n_licences"),
                      F.array_join(F.transform("hits", lambda h: h["licence"]), ",").alias("licences"))
