"""License scan against a plain Python version, inheritance, corner cases."""

from __future__ import annotations

import math
import re
from collections import Counter

from anaquel.llm import licenses as L
from tests.llm.conftest import CLASHING, prose

FILES = "file string, path string, text string"


def meets(i, words):
    asked = [g for g in L.NEEDS[i] if g[0] != "!"]
    barred = {t for g in L.NEEDS[i] if g[0] == "!" for t in g[1:].split("|")}
    return all(words & set(g.split("|")) for g in asked) and not words & barred


def cosine(text):
    """Rank, score and template (negative) of the best of those whose needs are met."""
    raw = {t: n * L.IDF.get(t, L.IDF_ELSE) for t, n in Counter(L.terms(text)).items()}
    norm = math.sqrt(sum(w * w for w in raw.values()))
    found = [
        (L._RANK.get(name, 2), round(sum(w * L.VECTORS[i].get(t, 0.0) for t, w in raw.items()) / norm, 9), -i)
        for i, (name, _) in enumerate(L.TEMPLATES) if meets(i, raw.keys())
    ]
    return max((f for f in found if f[1] >= L.THRESHOLD), default=(-1, 0.0, 0))


def own(text):
    """Best score and template of the headers and of the whole text."""
    lines = (text or "").split("\n")
    found = []
    for i, line in enumerate(lines):
        if re.search(L._ANCHOR, line):
            found += [cosine(line), cosine(" ".join(lines[max(0, i - L.BEFORE):i + L.AFTER + 1]))]
    if found:
        found.append(cosine(text))
    return max(found, default=(-1, 0.0, 0))


def scan(spark, files):
    return {r.file: r for r in L.scan(spark.createDataFrame(files, FILES)).collect()}


def test_each_template_is_its_own_licence(spark):
    files = [(str(i), f"d{i}/f.c", f"// {prose(i, 20)}\n * {text}\nint main()") for i, (_, text) in enumerate(L.TEMPLATES)]
    for name, row in scan(spark, files).items():
        assert row.license == L.TEMPLATES[int(name)][0] and row.found == "header"


def test_scores_match_plain_python(spark):
    texts = [
        "Licensed under CC BY-NC 4.0.\n" + prose(1, 9), prose(2, 30) + " license " + prose(3, 9),
        "released under the mit licence", "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0!",
        f"{prose(4, 5)}\nThis work is licensed\nunder the GNU General Public\nLicense, version 3.\n{prose(5, 40)}",
        prose(6, 50), "copyright", "", None,
    ]
    got = scan(spark, [(str(i), f"d{i}/f", t) for i, t in enumerate(texts)])
    for i, text in enumerate(texts):
        _, score, template = own(text)
        row = got[str(i)]
        if score >= L.THRESHOLD:
            assert (row.license, row.found) == (L.TEMPLATES[-template][0], "header")
            assert abs(row.score - score) < 1e-8
        else:
            assert (row.license, row.found, row.score) == (None, None, None)
    assert sum(r.found == "header" for r in got.values()) >= 3


def test_nearest_directory_gives_its_licence(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [
        ("root", "LICENSE", f"{mit}\n{prose(1, 300)}"), ("deep", "a/b/COPYING.txt", apache), ("x", "a/x.py", "code"),
        ("y", "a/b/c/d/y.py", "code"), ("z", "a/bb/z.py", None), ("own", "a/b/own.py", f"# {mit}\ncode"),
        ("header", "q/one.py", f"# {mit}\n{prose(2, 200)}"), ("beside", "q/two.py", "code"),
    ]
    got = scan(spark, files)
    assert {k: (r.license, r.found, r.directory) for k, r in got.items()} == {
        "root": ("MIT", "header", None), "deep": ("Apache-2.0", "header", None), "x": ("MIT", "inherited", ""),
        "y": ("Apache-2.0", "inherited", "a/b"), "z": ("MIT", "inherited", ""), "own": ("MIT", "header", None),
        # A header speaks for its own file, not for the directory.
        "header": ("MIT", "header", None), "beside": ("MIT", "inherited", ""),
    }


def test_reserved_rights(spark):
    mit, reserved = "Released under the MIT License.", "All rights reserved."
    files = [
        ("root", "LICENSE", mit), ("plain", "a/one.txt", f"{prose(1, 80)}\n{reserved}\n{prose(2, 90)}"),
        ("named", "a/two.txt", "Copyright (c) 2020 Acme Corp. All rights reserved."), ("beside", "a/three.txt", "code"),
        ("both", "a/four.txt", f"{reserved}\n{prose(3, 50)}\n{prose(4, 50)}\n{prose(5, 50)}\n# {mit} Details inside."),
        ("closed", "b/LICENSE", reserved), ("below", "b/c/x.py", "code"),
        ("grant", "d/COPYING", "# " + mit + " See inside."), ("notice", "d/NOTICE", reserved), ("mixed", "d/x.py", "code"),
    ]
    got = {k: (r.license, r.found, r.directory) for k, r in scan(spark, files).items()}
    none = L.RESERVED
    assert got == {
        "root": ("MIT", "header", None), "plain": (none, "header", None), "named": (none, "header", None),
        "beside": ("MIT", "inherited", ""), "both": ("MIT", "header", None), "closed": (none, "header", None),
        "below": (none, "inherited", "b"), "grant": ("MIT", "header", None), "notice": (none, "header", None),
        "mixed": ("MIT", "inherited", "d"),
    }


def test_short_notices(spark):
    notices = {"CC BY 4.0": "CC-BY-4.0", "GPL-3.0": "GPL-3.0", "Apache 2.0": "Apache-2.0", "CC BY-SA 4.0": "CC-BY-SA-4.0"}
    got = scan(spark, [(n, f"{i}/f", f"{prose(i, 40)}\n{n}\n{prose(9 + i, 40)}") for i, n in enumerate(notices)])
    assert {n: r.license for n, r in got.items()} == notices


def test_what_reaches_the_threshold_is_never_left_out(spark):
    from pyspark.sql import functions as F

    texts = [text for _, text in L.TEMPLATES] + [f"{text} {prose(i, n)}" for i, (_, text) in enumerate(L.TEMPLATES)
                                                 for n in (2, 5, 9, 20)]
    texts += [" ".join(text.split()[:n]) for _, text in L.TEMPLATES for n in (1, 2, 3, 6)] + [prose(77, 200) + " mit"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    kept = {r.text for r in rows.where(L._reachable(F.col("text"), L.THRESHOLD)).collect()}
    assert {t for t in texts if cosine(t)[1] >= L.THRESHOLD} <= kept and texts[-1] not in kept


def test_templates_meet_their_own_needs():
    for i, (_, text) in enumerate(L.TEMPLATES):
        words = set(L.terms(text))
        assert meets(i, words), text
        assert words & set(L.ANCHORS) and set(L.NEEDS[i][0].split("|")) <= set(L.ANCHORS)
        assert sum(g[0] != "!" for g in L.NEEDS[i]) < 30


def test_versions_and_elements_are_told_apart(spark):
    gpl2 = next(t for n, t in L.TEMPLATES if n == "GPL-2.0-or-later")
    notices = {
        gpl2: "GPL-2.0-or-later", "\n".join(re.findall(r".{1,60}(?:\s|$)", gpl2)): "GPL-2.0-or-later",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "SPDX-License-Identifier: AGPL-3.0-only": "AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later": "AGPL-3.0-or-later",
        "SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1-or-later", "SPDX-License-Identifier: GPL-3.0": "GPL-3.0",
        "BSD 2-Clause": "BSD-2-Clause", "BSD 3-Clause License": "BSD-3-Clause", "Released under the BSD License.": None,
        "CC BY-ND 4.0": "CC-BY-ND-4.0", "CC BY 3.0": "CC-BY-3.0", "CC BY-NC-SA 2.5": "CC-BY-NC-SA-2.5", "CC BY 4.0": "CC-BY-4.0",
        "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0", "Licensed under CC BY 9.0.": None,
        "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.": "CC-BY-SA-3.0",
        "SPDX-License-Identifier: EPL-2.0": "EPL-2.0", "SPDX-License-Identifier: OSL-3.0": None,
        "SPDX-License-Identifier: BSL-1.0": "BSL-1.0", "SPDX-License-Identifier: Zlib": "Zlib", "SPDX-License-Identifier: ISC": "ISC",
        "Licensed under the Apache License, Version 1.1.": None, "SPDX-License-Identifier: CC0-1.0": "CC0-1.0",
        "This program is free software under the GNU General Public License.": None, "SPDX-License-Identifier: MIT-0": None,
    }
    got = scan(spark, [(n, f"{i}/f", f"{prose(i, 40)}\n\n\n{n}\n\n\n{prose(9 + i, 40)}") for i, n in enumerate(notices)])
    assert {n: r.license for n, r in got.items()} == notices


def test_clauses_decide_between_bsd_licences(spark):
    two = next(t for n, t in L.TEMPLATES if n == "BSD-2-Clause" and "damages" in t.lower())
    sentence = next(t for n, t in L.TEMPLATES if n == "LicenseRef-BSD")
    third = next(t for n, t in L.TEMPLATES if n == "BSD-3-Clause" and "endorse" in t)
    broken = lambda text: "\n".join(re.findall(r".{1,70}(?:\s|$)", text))
    files = [
        ("two", "a/LICENSE", "Copyright (c) 2020, Some One\n\n" + broken(two)), ("head", "b/x", f"{prose(1, 50)}\n{sentence}:"),
        ("three", "c/LICENSE", "Copyright (c) 2020, Some One\n\n" + broken(two.replace("THIS SOFTWARE", third + " THIS SOFTWARE"))),
    ]
    got = {k: r.license for k, r in scan(spark, files).items()}
    assert got == {"two": "BSD-2-Clause", "head": "LicenseRef-BSD", "three": "BSD-3-Clause"}


def test_odd_rows(odd_docs, spark, with_clashes):
    assert L.scan_documents(with_clashes(odd_docs)).count() == odd_docs.count()
    files = [("a", None, "Released under the MIT License."), ("b", None, None), ("b", None, None), ("c", "", "x")]
    got = L.scan(with_clashes_keep(spark.createDataFrame(files, FILES))).collect()
    assert sorted((r.file, r.license) for r in got) == [("a", "MIT"), ("b", None), ("c", None)]


def with_clashes_keep(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("own") for c in (*CLASHING, "license", "score") if c not in df.columns})


def test_empty_table(docs_of, spark):
    assert L.scan_documents(docs_of([])).collect() == []


def test_no_python_in_the_plan(docs_of):
    plan = L.scan_documents(docs_of([(1, "x")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
