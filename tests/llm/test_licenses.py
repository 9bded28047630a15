import math
import re

from playline.llm.licenses import HINTS, LEAST, TEMPLATES, licenses

NAMED = re.compile(r"(?i)(^|/)(licen[cs]e|copying)([.][a-z]+)?$")


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    own = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return set(own) | {f"{a} {b}" for a, b in zip(own, own[1:])}


def nearest(line):
    sets = [terms(t) for _, t in TEMPLATES]
    weight = lambda t: math.log(len(sets) / (sum(t in s for s in sets) or 1)) + 1
    own = terms(line)
    length = math.sqrt(sum(weight(t) ** 2 for t in own))
    out = []
    for (name, _), s in zip(TEMPLATES, sets):
        norm = math.sqrt(sum(weight(t) ** 2 for t in s))
        if own & s:
            cosine = round(sum(weight(t) ** 2 for t in own & s) / norm / length, 9)
            out.append((-cosine, name))
    best = min(out, default=(0, None))
    return (-best[0], best[1]) if -best[0] >= LEAST else None


def brute(rows):
    own = []
    for key, path, text in rows:
        lines = {x for x in (text or "").split("\n") if any(h in x for h in HINTS)}
        found = sorted((-n[0], n[1]) for x in lines if (n := nearest(x)))
        own.append((key, path, len(lines), found[0] if found else None))
    given = {}
    for _, path, _, best in own:
        if best and NAMED.search(path or ""):
            folder = path.rpartition("/")[0]
            given[folder] = min(given.get(folder, best), best)
    out = []
    for key, path, count, best in own:
        folder = (path or "").rpartition("/")[0]
        above = [folder]
        while above[-1]:
            above.append(above[-1].rpartition("/")[0])
        near = next((a for a in above if a in given), None)
        out.append(
            (
                key, path, count, best[1] if best else None, round(-best[0], 6) if best else None,
                best[1] if best else (given[near][1] if near is not None else None),
                None if best else near,
            )
        )
    return sorted(out, key=str)


ROWS = [
    (1, "LICENSE", "Released under the MIT License."),
    (2, "a/b/c/file.py", "x = 1"),
    (3, "a/LICENSE.txt", "été\nLicensed under the Apache License, Version 2.0.\nmore"),
    (4, "a/b/x.py", "# All rights reserved.\ncode"),
    (5, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    (6, "z/file", None),
    (7, None, ""),
    (None, "q/r", "licensed and licensing of things that nobody has heard of, in a long line of prose"),
    (8, "a/b/c/LICENSE", "nothing"),
    (9, "a/d/e/f", "y"),
    (9, "a/d/e/f", "y"),
    (10, "both/LICENSE", "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0."),
    (11, "both/LICENCE", "Licensed under CC BY-NC 4.0."),
    (12, "both/sub/x", "SPDX-License-Identifier: MIT"),
    (13, "both/sub/y", "prose " * 100_000),
]


def test_equals_brute_force(spark):
    rows = [(k, p, t, "x", 1) for k, p, t in ROWS]
    frame = spark.createDataFrame(
        rows, "doc_id long, path string, text string, license string, folder int"
    )
    assert sorted(map(tuple, licenses(frame).collect()), key=str) == brute(ROWS)


def test_empty_table(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, path string, text string")
    assert licenses(frame.limit(0)).collect() == []
    assert sorted(map(tuple, licenses(frame.where("doc_id = 6")).collect())) == brute([ROWS[5]])
