"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these; ``bytes.split()`` cuts at the same bytes.
BLANKS = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_PIECE = 1 << 20
_KNOWN_WORDS = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str) -> Column:
    """A text column as bytes, so Python need not decode it; null stays null."""
    return F.col(column).cast("string").cast("binary")


def split_words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about a megabyte each.

    However long the text is, only one such list exists at a time.
    """
    start = 0
    while start < len(text):
        end = start + _PIECE
        while end < len(text) and text[end] not in BLANKS:
            end += 1
        yield text[start:end].split()
        start = end


class WordHashes(dict):
    """64-bit hashes by word, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < _KNOWN_WORDS and len(word) <= 64:
            self[word] = value
        return value

    def of_text(self, text: bytes) -> np.ndarray:
        """The hashes of all words of a text, in order."""
        parts = [
            np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
            for words in split_words(text)
        ]
        if len(parts) == 1:
            return parts[0]
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finalizer of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def joined(first: np.ndarray, second: np.ndarray, kind: int = 0) -> np.ndarray:
    """Hashes of ordered pairs."""
    odd = np.uint64(0x9E3779B97F4A7C15)
    return mixed(mixed(first + np.uint64(kind)) * odd + second)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of all runs of ``size`` words, sorted.

    Fewer words count as one run; no words have none.
    """
    if len(words) == 0:
        return words
    size = min(size, len(words))
    runs = mixed(words[: len(words) - size + 1])
    for shift in range(1, size):
        runs = joined(runs, words[shift : len(words) - size + 1 + shift])
    return np.unique(runs)
