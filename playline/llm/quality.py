"""Quality rules on repetition: characters inside repeated n-grams and lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from playline.llm.spans import (
    chunks,
    id_and_text,
    in_rows,
    owner,
    span_hashes,
    sums,
    window_hashes,
    words,
)

#: Largest share of the characters in words that may lie in n-grams found twice or more, by n.
GRAM_LIMITS = {5: 0.30, 7: 0.27, 10: 0.25}
#: Largest share that may lie in lines equal to an earlier line.
LINE_LIMIT = 0.20
FEWEST_WORDS = 50

SYMBOL = np.zeros(256, np.int64)
SYMBOL[list(b"#*$%&|<>")] = 1


def repeated(keys) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which of those are not the first of their kind."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice | later, later


def covered(hashes, rows, size) -> np.ndarray:
    """Words inside windows of ``size`` words that their row has twice or more."""
    windows, at = window_hashes(hashes, rows, size)
    marks = np.zeros(len(hashes) + 1, np.int64)
    twice, _ = repeated(in_rows(windows, rows[at]))
    marks[at[twice]] += 1
    marks[at[twice] + size] -= 1
    return np.cumsum(marks[:-1]) > 0


def measure(data, offsets, grams) -> dict[str, np.ndarray]:
    count = len(offsets) - 1
    starts, ends, rows = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    # Bytes that begin a code point; those of white space lie outside words.
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    chars = heads[ends] - heads[starts]

    def per_row(values):
        return np.bincount(rows, values, count).astype(np.int64)

    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    line_rows = owner(offsets, begin)
    stop = np.minimum(
        np.append(breaks, len(data))[np.searchsorted(breaks, begin)], offsets[line_rows + 1]
    )
    word_before = np.searchsorted(starts, np.stack([begin, stop]))
    spoken = word_before[1] > word_before[0]
    begin, stop, line_rows = begin[spoken], stop[spoken], line_rows[spoken]
    _, later = repeated(in_rows(span_hashes(data, begin, stop), line_rows))
    total = np.zeros(len(chars) + 1, np.int64)
    np.cumsum(chars, out=total[1:])
    line_chars = total[word_before[1][spoken]] - total[word_before[0][spoken]]

    out = {
        "n_words": per_row(np.ones(len(rows))),
        "word_chars": per_row(chars),
        "n_symbols": sums(SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(line_rows, later, count).astype(np.int64),
        "n_repeat_words": per_row(covered(hashes, rows, 3)),
        "dup_line_chars": np.bincount(line_rows, later * line_chars, count).astype(np.int64),
    }
    for size in grams:
        out[f"dup_{size}gram_chars"] = per_row(covered(hashes, rows, size) * chars)
    return out


def quality(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    gram_limits: dict[int, float] | None = None,
    line_limit: float = LINE_LIMIT,
    fewest_words: int = FEWEST_WORDS,
) -> DataFrame:
    """Repetition counts of every whole text, and whether the text is kept.

    Words are runs without white space (space, U+0009 to U+000D), compared as written. A text fails
    the base rule with fewer than ``fewest_words`` words or with over half of them in repeated
    3-word windows. Of the others, one is rejected if the characters of words inside repeated
    n-grams exceed the limit of that n, or those in repeated lines exceed ``line_limit``.

    A null or empty text has no words and fails the base rule. A null key stays null, repeated rows
    are each judged alone, other columns are not read. One pass without a shuffle.
    """
    limits = dict(GRAM_LIMITS if gram_limits is None else gram_limits)

    def judge(batches):
        for batch in batches:
            for first, stop, data, offsets in chunks(batch.column(1)):
                m = measure(data, offsets, limits)
                failed = (m["n_words"] < fewest_words) | (
                    100 * m["n_repeat_words"] > 50 * m["n_words"]
                )
                kept = ~failed & (m["dup_line_chars"] <= line_limit * m["word_chars"])
                for size, limit in limits.items():
                    kept &= m[f"dup_{size}gram_chars"] <= limit * m["word_chars"]
                named = {"base_failed": failed, "kept": kept}
                ids = batch.column(0).slice(first, stop - first)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": ids, **{n: (m | named)[n] for n in columns[1:]}}
                )

    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    extra = ["dup_line_chars", *(f"dup_{size}gram_chars" for size in limits)]
    columns = ["doc_id", *longs, "base_failed", "kept", *extra]
    kinds = {"base_failed": "boolean", "kept": "boolean"}
    schema = ", ".join(f"{name} {kinds.get(name, 'long')}" for name in columns)
    return id_and_text(docs, key, text).mapInArrow(judge, schema)
