"""Language-model scoring by Katz backoff (operator 12).

An n-gram is a context (the n-gram of the tokens before) and a token.  With c(h, w) its
count in the training texts and d the Good-Turing discount of that count,

    p(w | h) = d * c(h, w) / c(h)          if c(h, w) > 0
             = alpha(h) * p(w | shorter h)  if it is 0, and c(h) is not
             = p(w | shorter h)             if c(h) is 0, too

and alpha(h) = (mass taken from h's followers) / (1 - sum of p(w | shorter h) over them),
so the probabilities of all known words and of one class of unknown words add up to 1.
Counts above ``KEPT`` are not discounted.  Where the counts of counts give no discount
between 0 and 1, (r - 0.5) / r stands in; where no follower of a context is discounted,
one more count is shared out.

How it runs.  Tasks turn texts into blocks of about ``BLOCK`` tokens (whole documents)
with local word numbers, stored once; the words' hashes are a table of their own that
only order 1 needs.  For each order, a block sends its distinct n-grams with their
training counts to shards; a shard adds them up, stores the training n-grams
(``kind=model``, a row of packed columns per shard) and answers every block with the
total counts, ids and followers' sums of what it asked for.  So each n-gram of a block
travels once, however often it occurs, and nothing is looked up token by token.  The
answers are joined with the blocks, which then know the probabilities of this order, and
ask for the next.  All n-grams of a context lie in one shard, in order to sum up its
followers; a context with more tokens than an average shard is spread over all shards by
its words, and its sums (fewer than there are shards) are added up and sent to all tasks.

Words and contexts are compared by 64-bit hashes and ids; two of a billion different
words share a hash with a chance of 3 %.

Special cases: a null or empty text has one token, its end; a very long text makes a
long block; a row without an id is training text; rows that repeat an id count each by
its own text; no training text at all leaves all words unknown, with the probability 1
for their class; no rows give no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerquarry.llm.common import WordHashes, mixed, read_table, utf8
from offerquarry.sources.shared import drop_stored, new_path, ship_code

ORDER = 2
KEPT = 5  # counts above this are not discounted
BLOCK = 1 << 21  # tokens
SHARD = 1 << 21  # n-grams, about
PARTS, HELD_OUT = 7, 2  # of crc32(doc_id)

_END = np.uint64(WordHashes().__missing__(b"\n"))  # no word holds a line end
_START = 0  # id of the context before the first token
_SCHEMA = "block long, level int, shard int, a binary, b binary, c binary, d binary, numbers array<long>"
_NAMES = ["block", "level", "shard", "a", "b", "c", "d", "numbers"]
_KINDS = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.list_(pa.int64())]


# --- packed arrays ---------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Numbers in as few bytes as the largest needs, byte planes apart, compressed."""
    if values.dtype == np.float64:
        mark, short = 9, np.ascontiguousarray(values).view(np.uint64)
    else:
        values = values.astype(np.int64).view(np.uint64)
        width = next(w for w in (1, 2, 4, 8) if w == 8 or int(values.max(initial=0)) >> (8 * w) == 0)
        mark, short = width, values.astype(f"<u{width}")
    planes = short.view(np.uint8).reshape(len(short), short.itemsize).T
    return bytes([mark]) + zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    width = min(data[0], 8)
    raw = np.frombuffer(zstandard.decompress(data[1:]), np.uint8)
    whole = np.ascontiguousarray(raw.reshape(width, len(raw) // width).T)
    if data[0] == 9:
        return whole.view(np.float64).ravel()
    return whole.view(f"<u{width}").ravel().astype(np.uint64).view(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.int64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.int64)


def pack_few(values: np.ndarray) -> bytes:
    """Doubles with few distinct values."""
    distinct, places = np.unique(values, return_inverse=True)
    first = pack(distinct)
    return len(first).to_bytes(4, "little") + first + pack(places)


def unpack_few(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:4], "little")
    return unpack(data[4 : 4 + size])[unpack(data[4 + size :])]


# --- the model -------------------------------------------------------------------------


@dataclass
class Level:
    """What all tasks know about one order."""

    shards: int
    discounts: np.ndarray | None = None  # by count, 0 to KEPT + 1
    counts: np.ndarray | None = None  # n-grams that occur once, twice, ... KEPT times
    types: int = 0
    hot: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None  # contexts, followers, sums


@dataclass
class Model:
    """A trained model: its stored tables and the numbers that tasks need besides.

    ``tables[n - 1]`` holds the n-grams of order n, partitioned by ``kind``.
    """

    tokens: int
    documents: int
    most: int  # the order it has, or will have
    levels: list[Level] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)


def discounts(counts: np.ndarray) -> np.ndarray:
    """Katz's discounts of the counts 0 to KEPT + 1, from the numbers of n-grams that
    occur 1 to KEPT + 1 times."""
    result = np.ones(KEPT + 2)
    n = [0.0, *map(float, counts)]
    common = (KEPT + 1) * n[KEPT + 1] / n[1] if n[1] else 1.0
    for r in range(1, KEPT + 1):
        value = 0.0
        if n[r] and common != 1.0:
            value = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
        result[r] = value if 0.0 < value < 1.0 else (r - 0.5) / r
    return result


def probabilities(
    count: np.ndarray, context: np.ndarray, followers: np.ndarray, sums: np.ndarray, lower: np.ndarray, discount: np.ndarray
) -> np.ndarray:
    """p(w | h) of n-grams: their counts, their contexts' counts, how many followers of
    the context occur 1 to KEPT times, the followers' sum of lower probabilities (both
    needed only for counts of 0 or above KEPT), and the lower probability of the n-gram."""
    taken = followers @ (np.arange(1, KEPT + 1) * (1 - discount[1 : KEPT + 1]))
    none = (taken <= 0) & ((count == 0) | (count > KEPT))  # else a follower is discounted
    total = np.maximum(context + none, 1).astype(np.float64)
    taken = np.where(none, 1.0, taken)
    seen = discount[np.minimum(count, KEPT + 1)] * count / total
    rest = np.maximum(1 - sums, np.finfo(float).tiny)
    backed = np.where(context > 0, taken / total / rest, 1.0) * lower
    return np.where(count > 0, seen, backed)


def first_probabilities(count: np.ndarray, model: Model) -> np.ndarray:
    """p of single words by their counts; all unknown ones are one class."""
    n, level = len(count), model.levels[0]
    followers = np.broadcast_to(level.counts, (n, KEPT))
    return probabilities(count, np.full(n, model.tokens), followers, np.zeros(n), np.ones(n), level.discounts)


# --- texts to blocks -------------------------------------------------------------------


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, the most frequent first, and the place of each value there."""
    codes, distinct = pd.factorize(values)
    order = np.argsort(-np.bincount(codes, minlength=len(distinct)), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], place[codes]


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds for each block: its documents and tokens, and its words."""
    first, made = TaskContext.get().partitionId() << 24, 0
    hashes, texts, ids, held, total = WordHashes(), [], [], [], 0

    def block() -> Iterator[list]:
        words, tokens = _numbered(mixed(np.concatenate(texts)))
        flags, lengths = np.array(held, bool), np.array([len(t) for t in texts])
        order = np.argsort(words)
        train = np.bincount(tokens[~np.repeat(flags, lengths)], minlength=len(words))
        numbers = [len(tokens), int(lengths[~flags].sum()), int((~flags).sum()), len(words)]
        columns = [pack(order), pack(tokens), pack(lengths), pack(flags)]
        yield [first + made, 0, 0, *columns, numbers, ids, "block"]
        yield [first + made, 0, 0, words[order].tobytes(), None, pack(train[order]), None, numbers, None, "words"]

    def rows() -> Iterator[list]:
        nonlocal texts, ids, held, total, made
        for batch in batches:
            for doc, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                tokens = np.append(hashes.of_text((text.as_py() or b"").lower()), _END)
                ids.append(doc)
                held.append(out)
                texts.append(tokens)
                total += len(tokens)
                if total >= size:
                    yield from block()
                    texts, ids, held, total, made = [], [], [], 0, made + 1
        if texts:
            yield from block()

    return _batched(rows(), [*_NAMES, "ids", "kind"], [*_KINDS, pa.list_(pa.int64()), pa.string()])


def in_blocks(docs: DataFrame, held: Column, size: int = BLOCK) -> str:
    """A stored table, partitioned by ``kind``, with two rows per block; ``numbers``:
    tokens, training tokens, training documents, words."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(held, F.lit(False)), utf8("text"))
    made = rows.mapInArrow(lambda batches: _blocks(batches, size), f"{_SCHEMA}, ids array<long>, kind string")
    path = new_path(docs.sparkSession, "blocks")
    made.write.partitionBy("kind").parquet(path)
    return path


# --- what a block asks for -------------------------------------------------------------


@dataclass
class Grams:
    """The distinct n-grams of one order in a block, in the order they are asked for."""

    shard: np.ndarray
    context: np.ndarray
    word: np.ndarray
    count: np.ndarray  # in the block's training texts
    lower: np.ndarray
    word_count: np.ndarray
    of_context: np.ndarray  # training count of the context, as far as known
    inverse: np.ndarray  # from tokens

    def slices(self) -> Iterator[tuple[int, slice]]:
        shards, starts = np.unique(self.shard, return_index=True)
        for shard, start, end in zip(shards.tolist(), starts, [*starts[1:], len(self.shard)]):
            yield shard, slice(start, end)


class Block:
    """A block's tokens, with ids, counts and probabilities as far as they are known."""

    def __init__(self, row: dict, model: Model):
        self.model, self.number, self.ids = model, row["block"], row["ids"]
        self.by_hash = unpack(row["a"])  # the words in the order of their hashes
        self.tokens = unpack(row["b"])
        self.lengths = unpack(row["c"])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.train = ~np.repeat(unpack(row["d"]).astype(bool), self.lengths)
        self.level = 0
        self.place = self.tokens  # of each token's n-gram among the distinct ones
        self.id = self.first_id = self.count = self.first_count = self.p = None

    def _before(self, values: np.ndarray, first: int) -> np.ndarray:
        """Values of the token before; ``first`` at the start of a document."""
        moved = np.empty_like(values)
        moved[1:] = values[:-1]
        moved[self.starts] = first
        return moved

    def grams(self) -> Grams:
        """The n-grams of the next order, from 2."""
        level = self.model.levels[self.level]
        # Whatever ids follow, equal contexts have equal places; 0 is the start.
        local = self._before(self.place + 1, 0) * (len(self.by_hash) + 1) + self.tokens
        inverse, distinct = pd.factorize(local)
        at = np.empty(len(distinct), np.int64)
        at[inverse[::-1]] = np.arange(len(local) - 1, -1, -1)
        of_context = self._before(self.count, self.model.documents)[at]
        context, word = self._before(self.id, _START)[at], self.first_id[at]
        key = mixed(context.view(np.uint64))
        spread = of_context > self.model.tokens / level.shards
        shard = np.where(spread, mixed(key + word.view(np.uint64)), key) % np.uint64(level.shards)
        count = np.bincount(inverse[self.train], minlength=len(word))
        order = np.lexsort((word, context, shard))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return Grams(
            shard[order].astype(np.int64), context[order], word[order], count[order],
            self.p[at][order], self.first_count[at][order], of_context[order], place[inverse],
        )

    def questions(self) -> Iterator[list]:
        grams, level = self.grams(), self.model.levels[self.level]
        # The lower probability of a pair follows from the count of its word.
        lower = grams.word_count if self.level == 1 else grams.lower
        for shard, s in grams.slices():
            hot = grams.of_context[s] > self.model.tokens / level.shards
            yield [self.number, self.level + 1, shard, *packed_grams(grams.context[s], grams.word[s], grams.count[s], lower[s], hot), None]

    def _first_answered(self, answers: list[dict]) -> None:
        """Order 1: the shards' answers, one after the other, follow the hashes."""
        level = self.model.levels[0]
        index = np.empty(len(self.by_hash), np.int64)
        count = np.empty_like(index)
        parts = [(unpack(a["a"]) * level.shards + a["shard"] + 1, unpack(a["b"])) for a in answers]
        index[self.by_hash] = np.concatenate([p[0] for p in parts])
        count[self.by_hash] = np.concatenate([p[1] for p in parts])
        self.id, self.count = index[self.tokens], count[self.tokens]
        self.p = first_probabilities(count, self.model)[self.tokens]
        self.first_id, self.first_count = self.id, self.count
        self.level = 1

    def answered(self, answers: list[dict]) -> None:
        """Take in the answers of all shards, in their order."""
        if self.level == 0:
            return self._first_answered(answers)
        grams, level = self.grams(), self.model.levels[self.level]
        rows = {a["shard"]: a for a in answers}
        n = len(grams.word)
        index, count = np.zeros(n, np.int64), np.empty(n, np.int64)
        followers, sums = np.zeros((n, KEPT)), np.zeros(n)
        for shard, s in grams.slices():
            a = rows[shard]
            count[s] = unpack(a["b"])
            if a["a"]:
                index[s] = unpack(a["a"]) * level.shards + shard + 1
            contexts = np.unique(grams.context[s], return_inverse=True)[1]
            followers[s] = unpack(a["c"]).reshape(-1, KEPT)[contexts]
            sums[s] = unpack(a["d"])[contexts]
        at = np.flatnonzero(grams.of_context > self.model.tokens / level.shards)
        known, of, total = level.hot
        if len(at) and len(known):
            place = np.minimum(np.searchsorted(known, grams.context[at]), len(known) - 1)
            right = known[place] == grams.context[at]
            followers[at[right]], sums[at[right]] = of[place[right]], total[place[right]]
        p = probabilities(count, grams.of_context, followers, sums, grams.lower, level.discounts)
        self.place = grams.inverse
        self.id, self.count, self.p = index[self.place], count[self.place], p[self.place]
        self.level += 1

    def scores(self) -> pa.RecordBatch:
        """A row per document."""

        def by_document(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values, self.starts)

        tokens, types = self.model.tokens, self.model.levels[0].types
        base = np.log10((self.first_count + 1) / (tokens + types + 1))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.ids, pa.int64()),
                pa.array(~self.train[self.starts]),
                pa.array(self.lengths),
                pa.array(by_document((self.first_count > 0).astype(np.int64))),
                pa.array(by_document(base)),
                pa.array(by_document(np.log10(self.p))),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )


_NONE = np.zeros(0, np.int64)


def packed_grams(
    context: np.ndarray, word: np.ndarray, count: np.ndarray, lower: np.ndarray, hot: np.ndarray, index: np.ndarray = _NONE
) -> list[bytes]:
    """Sorted n-grams as four binaries; ``hot`` is empty or says which are spread out,
    ``index`` is empty or holds their numbers in a stored shard."""
    starts = np.flatnonzero(np.diff(context, prepend=context[:1] - 1))
    sizes = np.diff(starts, append=len(context))
    heads = [pack_sorted(context[starts]), pack(sizes), pack(hot[starts] if len(hot) else hot), pack_sorted(index)]
    words = pack_sorted(word) if len(starts) == 1 else pack(word)
    return [
        b"".join(len(h).to_bytes(4, "little") + h for h in heads),
        words, pack(count), pack_few(lower),
    ]


def unpacked_grams(row: dict) -> tuple[np.ndarray, ...]:
    """Context, word, count and lower probability of each n-gram, the contexts that are
    spread out, and the numbers."""
    heads, at = [], 0
    while at < len(row["a"]):
        size = int.from_bytes(row["a"][at : at + 4], "little")
        heads.append(row["a"][at + 4 : at + 4 + size])
        at += 4 + size
    contexts, sizes, hot = unpack_sorted(heads[0]), unpack(heads[1]), unpack(heads[2])
    word = unpack_sorted(row["b"]) if len(contexts) == 1 else unpack(row["b"])
    spread = contexts[hot.astype(bool)] if len(hot) else contexts[:0]
    return np.repeat(contexts, sizes), word, unpack(row["c"]), unpack_few(row["d"]), spread, unpack_sorted(heads[3])


# --- what a shard answers --------------------------------------------------------------


def _merged(rows: list[dict], level: int, shard: int, model: Model) -> Iterator[tuple[str, list]]:
    """Add up the n-grams of one shard: answers, sums of spread contexts, the n-grams.

    A row without a block holds the shard of a stored model.  Nobody needs the ids of
    the highest order.
    """
    top = level == model.most
    parts = [unpacked_grams(row) for row in rows]
    context, word, count, lower = (np.concatenate([p[i] for p in parts]) for i in range(4))
    spread = np.unique(np.concatenate([p[4] for p in parts]))
    order = np.lexsort((word, context))
    context, word = context[order], word[order]
    new = np.empty(len(order), bool)
    new[:1], new[1:] = True, (context[1:] != context[:-1]) | (word[1:] != word[:-1])
    starts = np.flatnonzero(new)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    total = np.add.reduceat(count[order], starts)
    sent = lower[order][starts]
    lower = first_probabilities(sent, model) if level == 2 else sent
    context, word = context[starts], word[starts]
    # Of all contexts: how many followers occur 1 to KEPT times, and their lower sum.
    first = np.diff(context, prepend=context[:1] - 1) != 0
    heads, of_context = np.flatnonzero(first), np.cumsum(first) - 1
    followers = np.stack([np.add.reduceat((total == r).astype(np.int64), heads) for r in range(1, KEPT + 1)], 1)
    sums = np.add.reduceat(np.where(total > 0, lower, 0.0), heads)
    asked = np.add.reduceat(((total == 0) | (total > KEPT)).astype(np.int64), heads) > 0
    followers_sent, sums_sent = followers * asked[:, None], np.where(asked, sums, 0.0)

    index, begin = np.arange(len(total)), 0
    for row, p in zip(rows, parts):  # numbers of a stored model stay; new ones follow
        mine = place[begin : begin + len(p[0])]
        begin += len(p[0])
        if row["block"] is None and not top:
            index = np.full(len(total), -1)
            index[mine] = p[5]
            fresh = np.flatnonzero(index < 0)
            index[fresh] = p[5].max(initial=-1) + 1 + np.arange(len(fresh))
        elif row["block"] is not None:
            of = np.unique(of_context[mine])
            tail = [pack(followers_sent[of].ravel()), pack(sums_sent[of])] if level > 1 else [None, None]
            ids = None if top else pack(index[mine])
            yield "answer", [row["block"], level, shard, ids, pack(total[mine]), *tail, None]
    at = np.searchsorted(context[heads], spread)
    fixed = np.round(sums[at] * (1 << 60)).astype(np.int64)  # whole numbers add up exactly
    for number, of, value in zip(spread.tolist(), followers[at].tolist(), fixed.tolist()):
        yield "spread", [None, level, shard, None, None, None, None, [number, *of, value]]
    seen = total > 0
    numbers = [int((total == r).sum()) for r in range(1, KEPT + 2)] + [int(seen.sum())]
    yield "counts", [None, level, shard, None, None, None, None, numbers]
    if seen.any():
        grams = (values[seen] for values in (context, word, total, sent))
        hot = np.isin(context[seen], spread)
        yield "model", [None, level, shard, *packed_grams(*grams, hot, _NONE if top else index[seen]), None]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _batched(rows: Iterator[list], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows with large binaries, a few megabytes at a time."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if size > 1 << 22 or len(held) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


def _answers(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Rows of whole shards, sorted by shard."""

    def found() -> Iterator[list]:
        for shard, rows in groupby(_rows(batches), lambda row: row["shard"]):
            rows = list(rows)
            for kind, row in _merged(rows, rows[0]["level"], shard, model):
                yield [*row, kind]

    return _batched(found(), [*_NAMES, "kind"], [*_KINDS, pa.string()])


# --- the whole -------------------------------------------------------------------------


def _with_blocks(rows: Iterator[dict], model: Model) -> Iterator[Block]:
    """Rows of blocks and of their answers, sorted by block and level."""
    for _, group in groupby(rows, lambda row: row["block"]):
        block = None
        for level, answers in groupby(group, lambda row: row["level"]):
            if level == 0:
                block = Block(next(answers), model)
            else:
                block.answered(list(answers))
        yield block


def _asking_words(shards: int) -> Callable:
    """Order 1: a shard is a range of hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for row in _rows(batches):
            words, count = np.frombuffer(row["a"], np.uint64), unpack(row["c"])
            shard = ((words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            ends = np.searchsorted(shard, np.arange(shards + 1))
            for number in np.unique(shard).tolist():
                s = slice(ends[number], ends[number + 1])
                n = s.stop - s.start
                none = np.zeros(n, np.int64)
                grams = packed_grams(none, words[s].view(np.int64), count[s], none, none[:0])
                yield [row["block"], 1, number, *grams, None]

    return lambda batches: _batched(rows(batches), _NAMES, _KINDS)


def _asking(model: Model) -> Callable:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _with_blocks(_rows(batches), model)
        return _batched((row for block in blocks for row in block.questions()), _NAMES, _KINDS)

    return ask


def _scoring(model: Model) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _with_blocks(_rows(batches), model):
            yield block.scores()

    return score


def _gathered(spark: SparkSession, blocks: DataFrame, model: Model, number: int) -> DataFrame:
    """Blocks with the answers so far, those of one block together and in order."""
    both = blocks
    for path in model.tables:
        both = both.unionByName(_table(spark, path, "answer"), allowMissingColumns=True)
    return both.repartition(max(1, number), "block").sortWithinPartitions("block", "level", "shard")


def _blocks_of(spark: SparkSession, path: str, kind: str) -> DataFrame:
    table = spark.read.schema(f"{_SCHEMA}, ids array<long>, kind string").parquet(path)
    return table.where(F.col("kind") == kind).drop("kind")


def _level(spark: SparkSession, chunks: DataFrame, level: Level, old: str | None, model: Model) -> str:
    """Merge questions by shard, together with a stored model's n-grams."""
    path = new_path(spark, "ngrams")
    if old:
        chunks = chunks.unionByName(_table(spark, old, "model"))
    by_shard = chunks.repartitionById(level.shards, F.col("shard")).sortWithinPartitions("shard", "block")
    merged = by_shard.mapInArrow(lambda batches: _answers(batches, model), f"{_SCHEMA}, kind string")
    merged.write.partitionBy("kind").parquet(path)
    return path


def _table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    table = spark.read.schema(f"{_SCHEMA}, kind string").parquet(path)
    return table.where(F.col("kind") == kind).drop("kind")


def _learn(spark: SparkSession, model: Model, level: Level, path: str) -> None:
    """Counts of counts and sums of spread contexts: fewer numbers than shards."""
    counts = _table(spark, path, "counts")
    row = counts.agg(*[F.sum(F.col("numbers")[i]) for i in range(KEPT + 2)]).first()
    numbers = np.array([v or 0 for v in row], np.int64)
    if level.discounts is None:
        level.discounts, level.counts, level.types = discounts(numbers[: KEPT + 1]), numbers[:KEPT], int(numbers[-1])
    spread = _table(spark, path, "spread").select(*[F.col("numbers")[i].alias(f"n{i}") for i in range(KEPT + 2)])
    found = spread.groupBy("n0").agg(*[F.sum(f"n{i}") for i in range(1, KEPT + 2)]).orderBy("n0").collect()
    table = np.array([list(r) for r in found], np.int64).reshape(len(found), KEPT + 2)
    level.hot = table[:, 0], table[:, 1:-1].astype(np.float64), table[:, -1] / (1 << 60)


def evaluate(docs: DataFrame, held: Column, order: int = ORDER, model: Model | None = None) -> tuple[DataFrame, Model]:
    """``doc_id, held_out, n_tokens, n_known, base_score, score`` for each row, and the
    model: trained on the rows that are not ``held``, or the one that is given."""
    spark = docs.sparkSession
    ship_code(spark)
    path = in_blocks(docs, held if model is None else F.lit(True))
    blocks, words = _blocks_of(spark, path, "block"), _blocks_of(spark, path, "words")
    number, total, tokens, documents, distinct = words.agg(
        F.count("*"), *[F.sum(F.col("numbers")[i]) for i in range(4)]
    ).first()
    given = model
    if given:
        model = Model(given.tokens, given.documents, given.most)
    else:
        model = Model(tokens or 0, documents or 0, order)
    for n in range(1, model.most + 1):
        entries = distinct if n == 1 else total
        level = Level(**vars(given.levels[n - 1])) if given else Level(max(1, -(-(entries or 0) // SHARD)))
        model.levels.append(level)
        if n == 1:
            asked = words.drop("ids").mapInArrow(_asking_words(level.shards), _SCHEMA)
        else:
            asked = _gathered(spark, blocks, model, number).mapInArrow(_asking(model), _SCHEMA)
        model.tables.append(_level(spark, asked, level, given.tables[n - 1] if given else None, model))
        _learn(spark, model, level, model.tables[-1])
        drop_stored(spark, *[f"{path}/kind=words"] * (n == 1))
    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return _gathered(spark, blocks, model, number).mapInArrow(_scoring(model), kinds), model


def held_out(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % PARTS == HELD_OUT


def op12_katz_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    scored, model = evaluate(read_table(spark, sf_dir, "documents"), held_out())
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
