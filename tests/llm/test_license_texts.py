from playline.llm.licenses import licenses, texts

FULL = dict(reversed(texts()))
HEADER = dict(texts())["Apache-2.0"]


def wrapped(text, mark, width=60):
    out, line = [], mark
    for word in text.split():
        if len(line) + len(word) > width:
            out, line = [*out, line], mark
        line += " " + word
    return "\n".join([*out, line])


def test_notices_outside_the_hinted_lines(spark):
    mit, bsd = FULL["MIT"], FULL["BSD-3-Clause"]
    rows = [
        ("All Rights Reserved.", "Proprietary"),
        ("ALL RIGHTS RESERVED", "Proprietary"),
        ("x\nDedicated to the Public Domain under CC0 1.0.\ny", "CC0-1.0"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy", "MIT"),
        (f"Copyright (c) 2020 Ann Other\n\n{mit}", "MIT"),
        ("\n".join(f"# {x}".rstrip() for x in mit.split("\n")) + "\nimport os\n\nos.x()\n" * 200, "MIT"),
        ("/*\n" + "\n".join(f" * {x}" for x in bsd.split("\n")) + "\n */\nint x;\n" * 50, "BSD-3-Clause"),
        ("Released under\nthe MIT License.", "MIT"),
        *[(wrapped(HEADER, m) + "\ncode = 1\n" * 90, "Apache-2.0") for m in ("#", "//", " *")],
        *[(FULL[n], n) for n in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0")],
        ("any person may use the software and the work of others without a notice " * 40, None),
    ]
    frame = spark.createDataFrame(
        [(i, f"d{i}/f", t) for i, (t, _) in enumerate(rows)], "doc_id long, path string, text string"
    )
    got = sorted((r.file_id, r.own_license, r.n_notices > 0) for r in licenses(frame).collect())
    assert got == [(i, name, name is not None) for i, (_, name) in enumerate(rows)]
