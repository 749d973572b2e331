"""Counts of one text, for the quality operators.

Everything is counted over the whole text, as bytes of UTF-8.  A null text counts
as an empty one: all counts are 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from offerquarry.llm.common import BLANKS, WordHashes, utf8

COUNTS = [
    "n_words",
    "word_chars",  # code points in words
    "n_symbols",
    "n_marks",
    "n_upper",  # A to Z
    "n_digits",
    "n_lines",  # lines with a word
    "n_dup_lines",  # of these, equal to an earlier one
    "n_repeat_words",  # words in windows of 8 that occur twice or more
    "n_distinct_words",
    "n_top_word",  # how often the most frequent word occurs
]
TYPE = StructType([StructField(name, LongType()) for name in COUNTS])

SYMBOLS = b"#*$%&|<>"
MARKS = b".,;:!?"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = b"0123456789"
_NOT_COUNTED = BLANKS + bytes(range(0x80, 0xC0))  # blanks, and all but first bytes
WINDOW = 8


def _count(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def repeated_words(numbers: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a run of ``window`` words (a power of 2) found twice.

    ``numbers`` holds a number for each word, from 0 and less than their count.
    Runs of double length are numbered from pairs of runs, so equal numbers mean
    equal words; memory is a few integers a word.
    """
    n, size, runs = len(numbers), 1, numbers.astype(np.int64)
    counts = np.empty(0, np.int64)
    while size < window:
        if len(runs) <= size:
            return 0
        pairs = runs[:-size] * n + runs[size:]
        _, runs, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(counts) == len(runs):
            return 0
        size *= 2
    edges = np.zeros(n + 1, np.int64)
    places = np.flatnonzero(counts[runs] > 1)
    edges[places] += 1
    edges[places + window] -= 1
    return int(np.count_nonzero(np.cumsum(edges)))


def text_counts(text: bytes, hashes: WordHashes) -> tuple[int, ...]:
    """The values of COUNTS for one text."""
    words = hashes.of_text(text)
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    _, numbers, counts = np.unique(words, return_inverse=True, return_counts=True)
    return (
        len(words),
        len(text.translate(None, _NOT_COUNTED)),
        _count(text, SYMBOLS),
        _count(text, MARKS),
        _count(text, UPPER),
        _count(text, DIGITS),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(numbers),
        len(counts),
        int(counts.max(initial=0)),
    )


def stats_column(text: str = "text") -> Column:
    """A struct of all COUNTS of a text column."""

    @F.arrow_udf(TYPE)
    def counts(texts: pa.Array) -> pa.Array:
        hashes = WordHashes()
        rows = [text_counts(t.as_py() or b"", hashes) for t in texts]
        columns = np.array(rows, np.int64).reshape(-1, len(COUNTS)).T
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], COUNTS)

    return counts(utf8(text))
