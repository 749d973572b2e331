"""Fill-in-the-middle documents from seekable compressed frames (operator 11).

A text is stored as independent zstandard frames, each with the units, characters and
bytes that lie before it.  A unit is a run of letters or one other character; a run that
crosses into the next frame counts where it starts.  A cut after some number of units is
found from the cumulative counts: only the frame that holds it is decompressed.  The
pieces are then streamed frame by frame into the new text, which is itself kept as
frames, and the digests are taken on the way.  So a task holds compressed frames and one
open frame, however long the text is.  The frames are a stored table of their own
(``store_frames``); texts are cut from that table.

The draws are the first groups of digits of a SHA-256 of the seed and the document's id,
so reruns agree.  A text that holds one of the marks, or is drawn to, stays as it is
(``plain``).

Special cases: a null text is an empty one, and an empty one is plain; a null id draws
like the empty text; rows with equal ids draw alike and are cut each by its own text; no
rows give no rows.  Columns that clash with the new ones are replaced in
``fill_in_middle``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerquarry.llm.common import read_table, utf8
from offerquarry.sources.shared import ship_code, write_and_read

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 1
FRAME = 1 << 16  # bytes of text in a frame
MOST_FILLED = 90  # percent of the texts that are cut
SUFFIX_FIRST = 20  # percent of these

_LETTER = np.zeros(256, bool)
_LETTER[list(range(ord("A"), ord("Z") + 1)) + list(range(ord("a"), ord("z") + 1))] = True


def unit_starts(data: bytes, in_run: bool) -> np.ndarray:
    """Where units start in UTF-8; ``in_run``: a letter stands right before."""
    codes = np.frombuffer(data, np.uint8)
    letters = _LETTER[codes]
    before = np.empty_like(letters)
    before[:1], before[1:] = in_run, letters[:-1]
    return np.flatnonzero(((codes & 0xC0) != 0x80) & ~(letters & before))


def characters(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


@dataclass
class Frame:
    """What lies before a frame, and its compressed bytes."""

    units: int
    chars: int
    bytes: int
    in_run: bool
    data: bytes


class Frames:
    """A text as independent frames; appended to at its end, read from anywhere."""

    def __init__(self):
        self.frames: list[Frame] = []
        self.units = self.chars = self.bytes = 0
        self._in_run, self._pending = False, bytearray()
        self._open: tuple[int, bytes] | None = None  # the frame read last

    @classmethod
    def of(cls, text: bytes) -> Frames:
        result = cls()
        result.append(text)
        return result.closed()

    def append(self, data: bytes) -> None:
        for start in range(0, len(data), FRAME):
            self._pending += data[start : start + FRAME]
            while len(self._pending) >= FRAME:
                self._store(self._whole(FRAME))

    def closed(self) -> Frames:
        """After the last byte has been appended."""
        if self._pending:
            self._store(len(self._pending))
        return self

    def _whole(self, end: int) -> int:
        """The nearest end of a character at or before a byte."""
        while end < len(self._pending) and self._pending[end] & 0xC0 == 0x80:
            end -= 1
        if end == len(self._pending):  # the character may go on in what comes next
            end -= 1
            while self._pending[end] & 0xC0 == 0x80:
                end -= 1
        return end

    def _store(self, size: int) -> None:
        data = bytes(self._pending[:size])
        del self._pending[:size]
        packed = _COMPRESSOR.compress(data)
        self.frames.append(Frame(self.units, self.chars, self.bytes, self._in_run, packed))
        self.units += len(unit_starts(data, self._in_run))
        self.chars += characters(data)
        self.bytes += len(data)
        self._in_run = bool(_LETTER[data[-1]])

    def read(self, number: int) -> bytes:
        if self._open is None or self._open[0] != number:
            self._open = number, _DECOMPRESSOR.decompress(self.frames[number].data)
        return self._open[1]

    def _holding(self, field: str, value: int) -> int:
        """The last frame with at most ``value`` before it."""
        low, high = 0, len(self.frames) - 1
        while low < high:
            middle = (low + high + 1) // 2
            if getattr(self.frames[middle], field) <= value:
                low = middle
            else:
                high = middle - 1
        return low

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and characters of the first ``units`` units; opens one frame."""
        if units >= self.units:
            return self.bytes, self.chars
        number = self._holding("units", units)
        frame = self.frames[number]
        # Frames without a unit of their own share their count with the next one.
        data = self.read(number)
        at = int(unit_starts(data, frame.in_run)[units - frame.units])
        return frame.bytes + at, frame.chars + characters(data[:at])

    def slice(self, start: int, end: int) -> Iterator[bytes]:
        """The bytes from ``start`` to ``end``, a frame at a time."""
        number = self._holding("bytes", start) if start < end else len(self.frames)
        while number < len(self.frames) and self.frames[number].bytes < end:
            frame = self.frames[number]
            yield self.read(number)[max(0, start - frame.bytes) : end - frame.bytes]
            number += 1

    def find(self, mark: bytes, start: int = 0) -> int:
        """Where ``mark`` first stands at or after a byte, or -1."""
        tail, at = b"", start
        for data in self.slice(start, self.bytes):
            joined = tail + data
            found = joined.find(mark)
            if found >= 0:
                return at - len(tail) + found
            at += len(data)
            tail = joined[-(len(mark) - 1) :]
        return -1


_COMPRESSOR = zstandard.ZstdCompressor(level=1, write_content_size=True)
_DECOMPRESSOR = zstandard.ZstdDecompressor()


def draws(seed: int, doc_id: int | None) -> list[int]:
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


@dataclass
class Filled:
    """A document's new text, and how it was cut."""

    units: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: Frames


def filled(text: Frames, doc_id: int | None, seed: int = SEED) -> Filled:
    h1, h2, h3, h4 = draws(seed, doc_id)
    n = text.units
    marked = any(text.find(mark) >= 0 for mark in (PREFIX, SUFFIX, MIDDLE))
    if n == 0 or marked or h3 % 100 >= MOST_FILLED:
        return Filled(n, "plain", None, None, text)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_chars), (b, b_chars) = text.cut(first), text.cut(second)
    prefix = (PREFIX, 0, a)
    suffix = (SUFFIX, b, text.bytes)
    form = "spm" if h4 % 100 < SUFFIX_FIRST else "psm"
    output = Frames()
    for mark, start, end in (*((suffix, prefix) if form == "spm" else (prefix, suffix)), (MIDDLE, a, b)):
        output.append(mark)
        for data in text.slice(start, end):
            output.append(data)
    return Filled(n, form, a_chars, b_chars - a_chars, output.closed())


def restored(output: Frames, form: str) -> Iterator[bytes]:
    """The original text in pieces, from a new text and its form alone."""
    if form == "plain":
        yield from output.slice(0, output.bytes)
        return
    second = output.find(SUFFIX if form == "psm" else PREFIX)
    middle = output.find(MIDDLE, second)
    one, two = (len(PREFIX), second), (second + len(SUFFIX), middle)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    for start, end in (prefix, (middle + len(MIDDLE), output.bytes), suffix):
        yield from output.slice(start, end)


def _digest(pieces: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


_FRAME = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("in_run", pa.bool_()), ("data", pa.binary())])
_STORED = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("frames", pa.list_(_FRAME))])


def packed(text: str = "text") -> Column:
    """Struct of a text's frames and of its units, characters and bytes in all."""

    @F.arrow_udf(
        "units long, chars long, bytes long, "
        "frames array<struct<units: long, chars: long, bytes: long, in_run: boolean, data: binary>>"
    )
    def pack(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            t = Frames.of(text.as_py() or b"")
            frames = [vars(frame) for frame in t.frames]
            rows.append({"units": t.units, "chars": t.chars, "bytes": t.bytes, "frames": frames})
        return pa.array(rows, _STORED)

    return pack(utf8(text))


def opened(stored: dict) -> Frames:
    """A stored text; its frames are decompressed only when they are read."""
    result = Frames()
    result.frames = [Frame(**frame) for frame in stored["frames"]]
    result.units, result.chars, result.bytes = (stored[k] for k in ("units", "chars", "bytes"))
    return result


def filled_column(kind: str, doc_id: str = "doc_id", stored: str = "stored", seed: int = SEED) -> Column:
    """Struct ``n, form, prefix_chars, middle_chars`` of stored frames, with the new text
    (``kind`` is ``text``) or digests of it and of what is rebuilt from it (``digests``)."""
    tail = [("output", pa.string())] if kind == "text" else [("output_sha256", pa.string()), ("restored_sha256", pa.string())]
    fields = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), *tail]
    names = {pa.int64(): "long", pa.string(): "string"}

    @F.arrow_udf(", ".join(f"{name} {names[of]}" for name, of in fields))
    def fill(ids: pa.Array, texts: pa.Array) -> pa.Array:
        rows = []
        for doc, text in zip(ids.to_pylist(), texts):
            done = filled(opened(text.as_py()), doc, seed)
            out = done.output
            if kind == "text":
                more = [b"".join(out.slice(0, out.bytes)).decode()]
            else:
                more = [_digest(out.slice(0, out.bytes)), _digest(restored(out, done.form))]
            rows.append((done.units, done.form, done.prefix_chars, done.middle_chars, *more))
        columns = list(zip(*rows)) or [()] * len(fields)
        arrays = [pa.array(c, of) for c, (_, of) in zip(columns, fields)]
        return pa.StructArray.from_arrays(arrays, [name for name, _ in fields])

    return fill(F.col(doc_id).cast("long"), F.col(stored))


def store_frames(docs: DataFrame) -> DataFrame:
    """``docs`` as a stored table with ``stored`` (frames) in place of ``text``."""
    ship_code(docs.sparkSession)
    return write_and_read(docs.withColumn("stored", packed()).drop("text"), "frames")


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with the new text in place of ``text``, and ``fim_form`` and ``fim_units``."""
    made = store_frames(docs).withColumn("fim", filled_column("text", seed=seed))
    made = made.withColumns({"text": F.col("fim.output"), "fim_form": F.col("fim.form"), "fim_units": F.col("fim.n")})
    return made.select(*docs.columns, *[c for c in ("fim_form", "fim_units") if c not in docs.columns])


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``."""
    stored = store_frames(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return stored.select("doc_id", filled_column("digests").alias("f")).select("doc_id", "f.*")


ORACLE = f"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), cut AS (
    SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
           [('0x' || substr(h, 1 + 8 * i, 8))::BIGINT FOR i IN range(4)] AS d
    FROM hashed
), placed AS (
    SELECT *, len(units) AS n, least(d[1] % (len(units) + 1), d[2] % (len(units) + 1)) AS a,
           greatest(d[1] % (len(units) + 1), d[2] % (len(units) + 1)) AS b,
           text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
               OR d[3] % 100 >= {MOST_FILLED} AS plain
    FROM cut
), pieces AS (
    SELECT *, array_to_string(units[1 : a], '') AS p, array_to_string(units[a + 1 : b], '') AS m,
           array_to_string(units[b + 1 :], '') AS s FROM placed
)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN d[4] % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(p) END AS prefix_chars, CASE WHEN NOT plain THEN length(m) END AS middle_chars,
       sha256(CASE WHEN plain THEN text WHEN d[4] % 100 < {SUFFIX_FIRST}
              THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces"""
