import math
import random
import re
from collections import Counter

from roadlens.llm import licenses

FILES = [
    ("a/LICENSE", "MIT License\nReleased under the MIT License."),
    ("a/x.py", "no notice here"),
    ("a/b/y.py", "# Licensed under the Apache License, Version 2.0.\n" + "code " * 100),
    ("a/b/z.py", "plain"),
    ("a/c/COPYING.txt", "some words\n  This work is licensed under the GNU General Public License, version 3.  "),
    ("a/c/d/e/f.py", ""),
    ("a/c/d/g.py", None),
    ("top.py", "released by the author under no license at all, mit or without"),
    ("b/only.txt", "Licensed under CC BY-NC 4.0."),
    ("b/deep/er.txt", "text " * 50_000),
    ("c/long.txt", "word " * 200 + "\nReleased under the MIT License."),
    ("c/other.txt", "x"),
    (None, "Released under the MIT License."),
    (None, None),
    ("b/only.txt", "Licensed under CC BY-NC 4.0."),
    ("README", "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0!"),
]


def brute(files, threshold=licenses.THRESHOLD):
    notices = licenses.Notices(licenses.TEMPLATES, threshold)

    def vector(text):
        return {t: n * notices.idf.get(t, notices.unknown) for t, n in Counter(re.findall("[a-z0-9]+", text.lower())).items()}

    def cosine(a, b):
        dot = sum(w * b.get(t, 0) for t, w in a.items())
        return round(dot / math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values())), 6)

    templates = [(name, vector(text)) for name, text in licenses.TEMPLATES]
    own, share = {}, {}
    for path, text in files:
        if path is None or not text:
            continue
        chars = 0
        for line in text.split("\n"):
            v = vector(line)
            hits = [(-cosine(v, t), name) for name, t in templates if v and cosine(v, t) >= threshold]
            if hits:
                chars += len(line)
                own[path] = min(own.get(path, (0, "")), min(hits))
        share[path] = chars / len(text)
    giving = {}
    for path, (s, name) in own.items():
        if re.search(licenses.FILE_NAME, path.split("/")[-1]) or share[path] >= licenses.FILE_SHARE:
            folder = path.rpartition("/")[0]
            giving[folder] = min(giving.get(folder, (0, "", "")), (s, path, name))
    out = []
    for path, _ in files:
        if path in own:
            out.append((path, own[path][1], -own[path][0], "own", path))
            continue
        folder = path.rpartition("/")[0] if path else None
        while folder is not None and folder not in giving and folder:
            folder = folder.rpartition("/")[0]
        found = giving.get(folder) if path else None
        out.append((path, found[2], -found[0], "inherited", found[1]) if found else (path, None, None, "none", None))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(p, t, i, "x") for i, (p, t) in enumerate(rows)],
                                 "path string, text string, size int, origin string").repartition(3)


def test_scan_equals_brute_force(spark):
    found = licenses.licence_scan(table(spark, FILES))
    assert found.columns == ["path", "size", "licence", "similarity", "origin", "licence_from"]
    rows = [(r.path, r.licence, r.similarity, r.origin, r.licence_from) for r in found.collect()]
    assert sorted(rows, key=str) == brute(FILES)
    by_path = {r[0]: r for r in rows}
    assert by_path["a/x.py"][1] == by_path["a/b/z.py"][1] == "MIT"
    assert by_path["a/c/d/e/f.py"][1] == by_path["a/c/d/g.py"][1] == "GPL-3.0"
    assert by_path["c/other.txt"][3] == "inherited" and by_path["c/other.txt"][4] == "README"
    assert by_path["c/long.txt"][3] == "own" and by_path["top.py"][3] == "inherited"


MIT_FILE = """MIT License

Copyright (c) 2020 Foo Bar

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = [text for name, text in licenses.TEXTS if name.startswith("BSD")]
GPL_HEADER = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
import os
"""


def test_licence_files_headers_and_wrapped_notices(spark):
    wrapped = [text.replace(". ", ".\n\n").replace(", ", ",\n") for text in BSD]
    files = [("mit/LICENSE", MIT_FILE), ("mit/x.py", "x = 1"), ("titleless/TERMS", MIT_FILE.partition("\n\n")[2]),
             ("titleless/x.py", "x = 1"), ("bsd2/LICENSE", wrapped[0]), ("bsd3/LICENSE", wrapped[1]),
             ("gpl/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n"
              " Copyright (C) 2007 Free Software Foundation, Inc.\n Everyone is permitted to copy"),
             ("header/x.py", GPL_HEADER + "print(os.name)\n" * 200),
             ("two/x.py", "# Licensed under the Apache\n# License, Version 2.0.\n" + "code = 1\n" * 90),
             ("inside/x.py", "Copyright 2020 Foo Bar. Released under the MIT License. See below."),
             ("none/x.py", "The licence of this software is a matter of copyright, and permission to copy is not given.")]
    found = {r.path: (r.licence, r.origin) for r in licenses.licence_scan(table(spark, files)).collect()}
    assert found == {"mit/LICENSE": ("MIT", "own"), "mit/x.py": ("MIT", "inherited"), "titleless/TERMS": ("MIT", "own"),
                     "titleless/x.py": ("MIT", "inherited"), "bsd2/LICENSE": ("BSD-2-Clause", "own"),
                     "bsd3/LICENSE": ("BSD-3-Clause", "own"), "gpl/COPYING": ("GPL-3.0", "own"),
                     "header/x.py": ("GPL-3.0", "own"), "two/x.py": ("Apache-2.0", "own"), "inside/x.py": ("MIT", "own"),
                     "none/x.py": (None, "none")}


def test_different_texts_under_one_path(spark):
    # a notice on line 2 of one text, other words on line 2 of the other
    files = [("p/x", "code\nReleased under the MIT License.\ncode"), ("p/x", "code\nsome other line that shares nothing here\n" * 9),
             ("p/y", "plain")]
    found = {(r.path, r.licence, r.similarity, r.origin) for r in licenses.licence_scan(table(spark, files)).collect()}
    assert found == {("p/x", "MIT", 1.0, "own"), ("p/y", "MIT", 1.0, "inherited")}


def brute_runs(text, anchors, most):
    parts = re.split(licenses.PARAGRAPH_END, text)
    anchored = [bool(re.search(anchors, p.lower())) for p in parts]
    out = set()
    for i in range(len(parts)):
        kept = 0
        for j in range(i, len(parts)):
            run = "\n".join(parts[i:j + 1])
            if anchored[i] and anchored[j] and len(run) <= most and (j - i < 8 or len(run) + 1 >= 1.25 * kept):
                out.add(run)
                kept = len(run) + 1
    return out


def test_runs_of_paragraphs_by_stretches(spark):
    rng = random.Random(8)
    words = ["software", "permission", "x", "yy", "zzz", "é€"]
    texts = [rng.choice(["\n\n", "\n  \n", "\n--\n\n"]).join(
        " ".join(rng.choice(words) for _ in range(rng.choice([1, 1, 2, 5, 40]))) for _ in range(rng.randint(1, 120)))
        for _ in range(12)] + ["software", "software\n\n", "\n\nsoftware"]
    notices = licenses.Notices([("a", "permission software")], 0.75)
    anchors = notices.anchor_pattern()
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, text string")
    for stretch, most in ((37, 60), (200, 30), (100_000, 60)):
        runs = licenses.paragraph_runs(licenses._texts(rows, notices), anchors, most, stretch).collect()
        for i, t in enumerate(texts):
            assert {r.words for r in runs if r.path == str(i)} == brute_runs(t, anchors, most), (stretch, i)


def test_a_licence_of_many_paragraphs_and_a_long_text(spark):
    clauses = [text for name, text in licenses.TEXTS if name == "BSD-3-Clause"][0]
    spread = re.sub(r"\b((?i:and|or|of)) ", r"\1\n\n", clauses)
    assert len(re.split(licenses.PARAGRAPH_END, spread)) > 20
    long = ("some ordinary text about this and that, without end.\n\n" * 4_000) + spread
    files = [("many/LICENSE", spread), ("long/notes.txt", long), ("long/x.py", "x")]
    found = {r.path: (r.licence, r.origin) for r in licenses.licence_scan(table(spark, files)).collect()}
    assert found == {"many/LICENSE": ("BSD-3-Clause", "own"), "long/notes.txt": ("BSD-3-Clause", "own"), "long/x.py": (None, "none")}


def test_lines_without_an_anchor_cannot_match():
    for threshold in (0.5, 0.75, 0.9):
        notices = licenses.Notices(licenses.TEMPLATES, threshold)
        for number in {n for _, n, _, _ in notices.terms}:
            rest = sum(w * w for _, n, t, w in notices.terms if n == number and t not in notices.anchors)
            assert math.sqrt(rest) < threshold


def test_empty_table(spark):
    assert licenses.licence_scan(table(spark, FILES).limit(0)).count() == 0
