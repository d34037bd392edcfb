"""License scan: TF-IDF cosine of headers and licence files to templates, then inheritance by directory.

DataFrame functions only. A header is a line with one of the templates' anchor words, alone and with its
neighbours, wherever it stands in the text; a text with a header may as a whole be a licence file. A
template asks for terms besides its cosine: a name, a version, the elements of a Creative Commons licence; a text that
gives another version or one more element is not that licence, however near. The anchors are the names,
so texts without any are read by one pattern and go no further. A file without a licence of its own takes that of the nearest directory
above it that holds a licence file. A notice that reserves all rights is a licence of its own, too, but
goes behind any that grants some.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm.common import stored, text_key

THRESHOLD = 0.6
RESERVED = "LicenseRef-All-Rights-Reserved"
SETS = 6  # sets of terms in which the words of a text are looked up
BEFORE, AFTER = 1, 2  # lines taken with a line that has an anchor
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([.\-_][^/]*)?$"

# Short notices of public licences, by SPDX identifier, and what a text must have to be one of them:
# a term of each group (a|b), the first of which names the licence, and none behind an exclamation mark.
_NOTICES = [
    ("Apache-2.0", "apache 2.0|2", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "apache 2.0|2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
     "file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "apache 2.0|2", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND "
     "CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("MIT", "mit !0|attribution", "Released under the MIT License."),
    ("MIT", "mit !0|attribution", "Licensed under the MIT License."),
    ("MIT", "hereby deal|restriction", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "mozilla|mpl 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
     "copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-1.1", "mozilla|mpl 1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("BSD-3-Clause", "bsd 3|three|new|revised", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "bsd 2|two|simplified", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "endorse promote", "Neither the name of the copyright holder nor the names of its contributors may be "
     "used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "redistributions disclaimer damages !endorse|advertising", "Redistribution and use in source and binary "
     "forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of "
     "source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
     "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
     "disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY "
     "THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED. IN NO EVENT "
     "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DAMAGES"),
    ("LicenseRef-BSD", "redistribution forms", "Redistribution and use in source and binary forms, with or without "
     "modification, are permitted provided that the following conditions are met"),
    ("CC0-1.0", "cc0|waived 1.0|cc0", "To the extent possible under law, the author has waived all copyright and related "
     "rights to this work under CC0 1.0."),
    ("Unlicense", "unencumbered|unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "fee provided|appear", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("EPL-1.0", "eclipse|epl 1.0|v1.0", "made available under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "eclipse|epl 2.0|v2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("BSL-1.0", "boost|bsl 1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "zlib", "Licensed under the zlib License."),
    (RESERVED, "reserved", "All rights reserved."),
    (RESERVED, "reserved", "Copyright (c). All rights reserved. All rights reserved."),  # twice: names and years may come too
]
# Families of one wording: the GNU licences by name and version, Creative Commons by elements and version.
_GNU = {
    "GPL": ("General", "gnu|gpl", "!lesser|library|affero|lgpl|agpl", ("2", "3")),
    "LGPL": ("Lesser General", "lesser|lgpl", "!affero|agpl", ("2.1", "3")),
    "AGPL": ("Affero General", "affero|agpl", "", ("3",)),
}
_CC_PARTS = {
    "NC": ("NonCommercial", "nc|noncommercial|non"), "ND": ("NoDerivatives", "nd|noderivatives|noderivs|derivatives"),
    "SA": ("ShareAlike", "sa|sharealike|alike"),
}
_CC_KINDS = ("", "SA", "NC", "ND", "NC SA", "NC ND")
_CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}
#: Licences that go behind those that say more about the same text.
_RANK = {RESERVED: 0, "LicenseRef-BSD": 1}
_BARRED = 1 << 30


def _gnu():
    for short, (name, named, barred, versions) in _GNU.items():
        for v in versions:
            spdx, low = f"{short}-{v if '.' in v else v + '.0'}", short.lower()
            needs = f"{named}|{low}v{v}|{low}{v} {v}|{v}.0|v{v}|{low}v{v}|{low}{v} {barred}"
            notice = f"This work is licensed under the GNU {name} Public License, version {v}."
            for text in (notice, f"SPDX-License-Identifier: {spdx}-only", spdx):
                yield spdx, f"{needs} !later", text
            program = (
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                f"{name} Public License as published by the Free Software Foundation, either version {v} of the License, "
                "or (at your option) any later version."
            )
            for text in (program, f"{notice[:-1]} or any later version.", f"SPDX-License-Identifier: {spdx}-or-later"):
                yield f"{spdx}-or-later", f"{needs} later", text


def _creative_commons():
    for kind in _CC_KINDS:
        own = kind.split()
        spdx = "-".join(["BY", *own])
        words = "-".join(["Attribution", *(_CC_PARTS[p][0] for p in own)])
        rules = " ".join(terms if p in own else f"!{terms}" for p, (_, terms) in _CC_PARTS.items())
        for v, edition in _CC_VERSIONS.items():
            needs = f"cc|creative|creativecommons.org|creativecommons by|attribution {v}|{v.removesuffix('.0')} {rules}"
            yield f"CC-{spdx}-{v}", needs, f"Licensed under CC {spdx} {v}."
            yield f"CC-{spdx}-{v}", needs, (
                f"This work is licensed under a Creative Commons {words} {v} {edition} License."
            )


def _spdx():
    first = {}
    for name, needs, _ in _NOTICES:
        if not name.startswith("LicenseRef"):
            first.setdefault(name, needs)
    for name, needs in first.items():
        named, *rest = needs.split()
        tag = name.lower().split("-")[0]
        own = " ".join([named if tag in named.split("|") else f"{named}|{tag}", *rest])
        if name in ("ISC", "CC0-1.0", "Unlicense"):  # the notice's other words are not in the identifier
            own = tag
        yield name, own, f"SPDX-License-Identifier: {name}"


_FAMILIES = [_NOTICES, list(_gnu()), list(_creative_commons()), list(_spdx())]
TEMPLATES = tuple((name, text) for family in _FAMILIES for name, _, text in family)
NEEDS = tuple(needs.split() for family in _FAMILIES for _, needs, _ in family)
_NO_TERM = r"[^a-z0-9.]+"


def terms(text: str) -> list[str]:
    """Words, numbers and versions in lower case."""
    lower = "".join(c.lower() if c.isascii() else c for c in text)
    return [t for t in (w.strip(".") for w in re.split(_NO_TERM, lower)) if t]


def _weights() -> tuple[dict[str, float], float, list[dict[str, float]]]:
    """idf by term, idf of a term in no template, and each template as a unit vector.

    A family of one wording counts like a few templates, however many versions it has.
    """
    counts = [Counter(terms(text)) for _, text in TEMPLATES]
    df: Counter[str] = Counter()
    at = n = 0
    for family in _FAMILIES:
        share = 1 if family is _NOTICES else FAMILY / len(family)
        for c in counts[at:at + len(family)]:
            df.update({t: share for t in c})
        at, n = at + len(family), n + share * len(family)
    idf = {t: math.log((1 + n) / (1 + k)) + 1 for t, k in df.items()}
    vectors = []
    for c in counts:
        raw = {t: k * idf[t] for t, k in c.items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        vectors.append({t: w / norm for t, w in raw.items()})
    return idf, math.log(1 + n) + 1, vectors


FAMILY = 4
IDF, IDF_ELSE, VECTORS = _weights()

#: Terms of which a text must have one to be any licence: each template's first group.
ANCHORS = tuple(sorted({term for needs in NEEDS for term in needs[0].split("|")}))
_ANCHOR = r"(?i)(?<![a-z0-9])(" + "|".join(map(re.escape, ANCHORS)) + r")(?![a-z0-9])"


def _bits(template: int) -> tuple[dict[str, int], int]:
    """What each term says about a template's needs, as bits, and the bits that a text must have together."""
    bits: dict[str, int] = {}
    full = 0
    for n, group in enumerate(g for g in NEEDS[template] if g[0] != "!"):
        full |= 1 << n
        for term in group.split("|"):
            bits[term] = bits.get(term, 0) | 1 << n
    for group in (g[1:] for g in NEEDS[template] if g[0] == "!"):
        for term in group.split("|"):
            bits[term] = bits.get(term, 0) | _BARRED
    return bits, full


def _table(spark: SparkSession) -> DataFrame:
    """A row per term of the templates and their needs: idf, and by template its weight and bits. Fixed size."""
    bits = [_bits(i)[0] for i in range(len(TEMPLATES))]
    rows = [
        (term, IDF.get(term, IDF_ELSE), [
            (i, v.get(term, 0.0), bits[i].get(term, 0)) for i, v in enumerate(VECTORS) if term in v or term in bits[i]
        ])
        for term in sorted(IDF.keys() | {t for b in bits for t in b})
    ]
    return spark.createDataFrame(
        rows, "term string, idf double, in array<struct<template: int, weight: double, bits: int>>"
    )


def _terms(text: Column) -> Column:
    parts = F.split(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), _NO_TERM)
    return F.filter(F.transform(parts, lambda w: F.btrim(w, F.lit("."))), lambda w: w != "")


def _reachable(text: Column, threshold: float) -> Column:
    """False for texts whose cosine to every template is under the threshold, seen without counting terms.

    The product with a template is at most the sum, over the text's words, of idf times the greatest weight
    in any template; the squared norm is at least the sum of the words' squared idf. Words are looked up in a few sets
    by that product, each taken for its set's greatest.
    """
    top = sorted(((IDF[t] * max(v.get(t, 0.0) for v in VECTORS), t) for t in IDF), reverse=True)
    size = -(-len(top) // SETS)
    weight = F.when(F.lit(False), F.lit(0.0))

    def weigh(w: Column) -> Column:
        found = weight
        for at in range(0, len(top), size):
            found = found.when(w.isin(*[t for _, t in top[at:at + size]]), F.lit(top[at][0]))
        return found.otherwise(F.lit(0.0))

    least, most = F.lit(min(IDF.values()) ** 2), F.lit(IDF_ELSE**2)
    return F.aggregate(
        F.transform(_terms(text), weigh), F.struct(F.lit(0.0).alias("dot"), F.lit(0.0).alias("norm2")),
        lambda a, x: F.struct((a["dot"] + x).alias("dot"), (a["norm2"] + F.when(x > 0, least).otherwise(most)).alias("norm2")),
        lambda a: a["dot"] * a["dot"] >= a["norm2"] * F.lit((threshold - 1e-6) ** 2),
    )


def _best(units: DataFrame) -> DataFrame:
    """``file, unit, rank, score, template``: of ``file, unit, text``, the template with the greatest cosine among those
    whose needs the text meets, for each rank of licences."""
    spark = units.sparkSession
    counted = (
        # Placed by text once: terms, norms and products are then summed where they are.
        units.repartition("file", "unit").select("file", "unit", F.explode(_terms(F.col("text"))).alias("term"))
        .groupBy("file", "unit", "term").agg(F.count("*").alias("n"))
    )
    weighed = counted.join(F.broadcast(_table(spark)), "term", "left").withColumn(
        "w", F.col("n") * F.coalesce("idf", F.lit(IDF_ELSE))
    )
    norms = weighed.groupBy("file", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # A text that meets a template's needs and no more has each bit that is asked for and none that is barred.
    met = F.array(*[F.lit(_bits(i)[1]) for i in range(len(TEMPLATES))])
    dots = (
        weighed.where("in IS NOT NULL").select("file", "unit", "w", F.explode("in").alias("t"))
        .groupBy("file", "unit", F.col("t.template").alias("template"))
        .agg(F.sum(F.col("w") * F.col("t.weight")).alias("dot"), F.bit_or("t.bits").alias("bits"))
        .where(F.col("bits") == F.element_at(met, F.col("template") + 1))
    )
    score = F.round(F.col("dot") / F.col("norm"), 9)
    ranks = F.array(*[F.lit(_RANK.get(name, 2)) for name, _ in TEMPLATES])
    return (
        dots.join(norms, ["file", "unit"])
        .groupBy("file", "unit", F.element_at(ranks, F.col("template") + 1).alias("rank"))
        .agg(F.max(F.struct(score.alias("score"), (-F.col("template")).alias("t"))).alias("b"))
        .select("file", "unit", "rank", "b.score", (-F.col("b.t")).alias("template"))
    )


def parent(path: Column) -> Column:
    """The directory of a path; the root is the empty string."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per file of ``file, path, text``: ``file, path, license, found, score, directory``.

    ``found`` is 'header' for a licence in the text itself, 'inherited' for that of the nearest directory
    above (its own included) with a licence file, with that ``directory``; else all three are null. A licence
    file is one named so, or one whose whole text reaches the threshold. A notice that reserves all rights
    (``RESERVED``) counts only where the text, or the directory's files, grant none; it keeps a file from
    inheriting, and speaks for a directory only from a file named as licence file. The sentence that all BSD licences
    share is ``LicenseRef-BSD`` unless the text tells which. A notice of a licence or version without template is none. Of equal scores the
    template listed first wins; of several licence files in a directory the best, then the first
    licence by name. ``file`` names a file: rows that share it are one, and return one row. A null text has no licence of its own, a null
    path inherits nothing. Other columns are not read.
    """
    pattern = _ANCHOR
    licences = F.array(*[F.lit(name) for name, _ in TEMPLATES])
    named = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    hits = stored(
        files.where(F.col("text").rlike(pattern)).select("file", "path", "text", named.alias("named"))
        .dropDuplicates(["file"]), "anchored",
    )
    split = hits.select("file", F.split("text", "\n", -1).alias("lines"))
    at = split.select("file", "lines", F.posexplode("lines").alias("i", "line")).where(F.col("line").rlike(pattern))
    first = F.greatest(F.col("i") - BEFORE, F.lit(0))
    around = F.concat_ws(" ", F.slice("lines", first + 1, F.col("i") + AFTER - first + 1))
    units = (
        at.select("file", F.concat_ws(":", F.lit("line"), "i").alias("unit"), F.col("line").alias("text"))
        .union(at.select("file", F.concat_ws(":", F.lit("around"), "i"), around))
        .union(hits.select("file", F.lit("whole"), "text"))
    ).where(_reachable(F.col("text"), threshold))
    best = stored(_best(units).where(F.col("score") >= threshold), "scores")
    own = best.groupBy("file").agg(
        F.max(F.struct("rank", "score", (-F.col("template")).alias("t"))).alias("b")
    ).select("file", "b.rank", "b.score", F.element_at(licences, (1 - F.col("b.t")).cast("int")).alias("license"))

    licence_files = own.join(
        hits.where("named").select("file").union(best.where("unit = 'whole' AND rank > 0").select("file")).distinct(), "file"
    ).join(hits.select("file", "path"), "file").where("path IS NOT NULL")
    of_directory = stored(
        licence_files.select(parent(F.col("path")).alias("directory"), "rank", "score", "license")
        .groupBy("directory").agg(
            F.min(F.struct((-F.col("rank")).alias("r"), (-F.col("score")).alias("s"), "license")).alias("b")
        ).select("directory", F.col("b.license").alias("given")), "directories",
    )
    placed = files.select("file", "path").dropDuplicates(["file"]).select("file", "path", parent(F.col("path")).alias("dir"))
    # All directories above a directory, the root included, by cutting its path after each part.
    parts = F.split("dir", "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    nearest = (
        placed.where("path IS NOT NULL").select("dir").distinct()
        .select("dir", F.explode(F.array_union(F.array(F.lit("")), above)).alias("directory"))
        .join(of_directory, "directory")
        .groupBy("dir").agg(F.max_by(F.struct("directory", "given"), F.length("directory")).alias("n"))
        .select("dir", F.col("n.directory").alias("directory"), "n.given")
    )
    return (
        placed.join(nearest, "dir", "left").join(own, "file", "left")
        .select(
            "file", "path", F.coalesce("license", "given").alias("license"),
            F.when(F.col("license").isNotNull(), "header").when(F.col("given").isNotNull(), "inherited").alias("found"),
            "score", F.when(F.col("license").isNull(), F.col("directory")).alias("directory"),
        )
    )


def scan_documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the columns of ``scan``, one row per row of documents.

    Documents are filed as source/language/hundred/doc_id, 'unknown' for a null part. Rows that repeat a
    doc_id and its text are scanned once and returned each.
    """
    part = lambda c: F.coalesce(F.regexp_replace(F.col(c).cast("string"), "/", "_"), F.lit("unknown"))
    path = F.concat_ws(
        "/", part("source"), part("lang"),
        F.coalesce(F.floor(F.col("doc_id") / 100).cast("string"), F.lit("unknown")), part("doc_id"),
    )
    rows = docs.select(
        "doc_id", path.alias("path"),
        F.concat_ws(":", part("doc_id"), text_key("text"), part("source"), part("lang")).alias("file"), "text",
    )
    return rows.select("doc_id", "file").join(scan(rows), "file").drop("file")
