"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass (operator 5).

A text is cut into marked words: runs of the space mark with what follows.  No piece
of the vocabulary reaches over such a cut, so words are encoded one by one, each
distinct word of a slice once.  The words are sorted and walked as a trie, so that the
forward state of a prefix serves all words that begin with it: short words of BPE
vocabularies by depth, all prefixes of one length at once (``Front``), others depth
first (``Walk``), where the states of all prefixes lie on a stack, and the next word
starts from those of the prefix it shares with the word before.

* Unigram vocabularies: the state of a prefix is its best score, and the last piece.
* BPE vocabularies: a prefix has one encoding, whatever follows.  A piece extends the
  encoding of a shorter prefix if the pair of the last two pieces is itself what
  merging yields (checked once per pair); so the state is the last piece alone.  Scores
  of BPE pieces are ranks, and their best sum would not be the encoding.

Characters without a piece fall back to byte pieces, or to the unknown piece if there
are none.  The model file is read by the driver; its vocabulary (fixed by the file, not
by the data) is sent to the tasks.  Nothing is shuffled.

Special cases: a null text encodes to null and decodes to null, an empty one to no
pieces; a very long text is encoded whole, in slices of words; a word of any length takes
memory in proportion to it; rows do not depend on each other.  Decoding returns exactly the text, unless it holds the space mark itself,
which becomes a space, or characters without bytes to fall back to.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from offerquarry.llm.common import read_table
from offerquarry.sources.shared import ship_code

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for a space
# The marks with what follows them; line ends, which no piece joins with letters, apart.
_WORDS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
SLICE = 1 << 20  # characters whose words are encoded together
MOST_KNOWN = 12 << 20  # bytes of words and their encodings that a task remembers
MOST_PAIRS = 300_000  # pairs of pieces that it remembers for long words
PAIR_BITS = 20  # places for the pairs of short words, as a power of two
SHORT = 32  # characters up to which words are walked together
TOGETHER = 1 << 14  # words that are walked together

NO_PIECE = -1
_LOST = -2  # merging reaches no piece here
_NORMAL, _UNKNOWN, _BYTE = 0, 1, 2


class Pairs(dict):
    """For two pieces, may they stand side by side?  Found out when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) >= MOST_PAIRS:
            self.clear()
        self[pair] = self.vocabulary.follows(*pair)
        return self[pair]


@dataclass
class Vocabulary:
    """Pieces of a model by id."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    bpe: bool

    @classmethod
    def load(cls, path: str, bpe: bool = True) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())

        def kind(i: int) -> int:
            if model.is_byte(i):
                return _BYTE
            return _UNKNOWN if model.is_unknown(i) else 3 if model.is_control(i) else _NORMAL

        return cls([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], [kind(i) for i in ids], bpe)

    @cached_property
    def ids(self) -> dict[str, int]:
        return {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == _NORMAL}

    @cached_property
    def trie(self) -> dict:
        """By character: the id of the piece so far (or None), and what may follow."""
        root: dict = {}
        for piece, i in self.ids.items():
            following = root
            for char in piece[:-1]:
                following = following.setdefault(char, [None, {}])[1]
            following.setdefault(piece[-1], [None, {}])[0] = i
        return root

    @cached_property
    def pairs(self) -> Pairs:
        return Pairs(self)

    @cached_property
    def neighbours(self) -> Neighbours:
        return Neighbours(self)

    @cached_property
    def front(self) -> Front:
        return Front(self)

    @cached_property
    def encoder(self) -> Encoder:
        """Lives as long as the vocabulary, so the tasks of a worker share it."""
        return Encoder(self)

    @cached_property
    def bytes(self) -> dict[int, int]:
        """Ids of the byte pieces."""
        return {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == _BYTE}

    @cached_property
    def packed(self) -> list[bytes]:
        """Ids as 32-bit numbers."""
        return [np.array([i], "<i4").tobytes() for i in range(len(self.pieces))]

    @cached_property
    def surfaces(self) -> list[bytes]:
        return [
            bytes([int(p[3:5], 16)]) if kind == _BYTE
            else " ⁇ ".encode() if kind == _UNKNOWN
            else p.replace(MARK, " ").encode() if kind == _NORMAL else b""
            for p, kind in zip(self.pieces, self.kinds)
        ]

    def fallback(self, char: str) -> list[int]:
        if self.bytes:
            return [self.bytes[b] for b in char.encode()]
        return [self.kinds.index(_UNKNOWN)]

    def merged(self, text: str, history: list[tuple[float, str, str]] | None = None) -> list[str]:
        """BPE by its definition: the best pair first, the leftmost of equal ones.

        Possible merges wait in a heap, and parts are linked with their neighbours, so
        time grows hardly more than the text.  ``history`` gets the score of each merge,
        and the first and the last part after it.
        """
        parts: list[str | None] = list(text)
        before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        waiting: list[tuple[float, int, int]] = []
        end = len(parts) - 1

        def propose(left: int) -> None:
            right = after[left] if left >= 0 else len(parts)
            if right < len(parts):
                piece = self.ids.get(parts[left] + parts[right])
                if piece is not None:
                    heappush(waiting, (-self.scores[piece], left, piece))

        for left in range(len(parts) - 1):
            propose(left)
        while waiting:
            _, left, piece = heappop(waiting)
            if parts[left] is None or after[left] == len(parts):
                continue
            right = after[left]
            if self.ids.get(parts[left] + parts[right]) != piece:
                continue  # one of the two has been merged with another part since
            parts[left], parts[right] = self.pieces[piece], None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            else:
                end = left
            if history is not None:
                history.append((self.scores[piece], parts[0], parts[end]))
            propose(before[left])
            propose(left)
        return [part for part in parts if part is not None]

    def follows(self, first: int, second: int) -> bool:
        """May the two pieces stand side by side in a BPE encoding?"""
        pair = [self.pieces[first], self.pieces[second]]
        return self.merged("".join(pair)) == pair

    def as_ids(self, parts: list[str]) -> list[int]:
        """Parts of a merged word; single characters may be without a piece."""
        result = []
        for part in parts:
            piece = self.ids.get(part)
            result += self.fallback(part) if piece is None else [piece]
        return result


class Neighbours:
    """Answers ``Vocabulary.follows`` for many pairs at once.

    Two pieces side by side are merged each in the order in which it is merged alone, the
    better merge of both first, unless the last part of the one and the first part of the
    other are the best merge at some time.  So the merges of each piece alone are kept.
    """

    def __init__(self, vocabulary: Vocabulary):
        size, wide = len(vocabulary.pieces), max(map(len, vocabulary.ids), default=1)
        numbers: dict[str, int] = {}

        def number(part: str) -> int:
            return numbers.setdefault(part, len(numbers))

        self.reached = np.zeros(size, bool)
        self.scores = np.full((size, wide), -np.inf)
        self.first, self.last = np.zeros((size, wide), np.int32), np.zeros((size, wide), np.int32)
        for piece, i in vocabulary.ids.items():
            history: list[tuple[float, str, str]] = []
            self.reached[i] = vocabulary.merged(piece, history) == [piece]
            self.scores[i, : len(history)] = [score for score, _, _ in history]
            self.first[i, : len(history) + 1] = [number(piece[0]), *(number(part) for _, part, _ in history)]
            self.last[i, : len(history) + 1] = [number(piece[-1]), *(number(part) for _, _, part in history)]
        self.parts = len(numbers)
        merges = {
            numbers[piece[:cut]] * self.parts + numbers[piece[cut:]]: vocabulary.scores[i]
            for piece, i in vocabulary.ids.items()
            for cut in range(1, len(piece))
            if piece[:cut] in numbers and piece[cut:] in numbers
        }
        keys = sorted(merges)
        self.keys = np.array([*keys, np.iinfo(np.int64).max])
        self.merges = np.array([*map(merges.__getitem__, keys), -np.inf])

    def follow(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        result = self.reached[first] & self.reached[second]
        left = np.flatnonzero(result)
        a, b = first[left], second[left]
        i, j = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
        while len(left):
            key = self.last[a, i].astype(np.int64) * self.parts + self.first[b, j]
            at = np.searchsorted(self.keys, key)
            across = np.where(self.keys[at] == key, self.merges[at], -np.inf)
            one, other = self.scores[a, i], self.scores[b, j]
            # Of equal merges the leftmost is first: of the first piece, across, of the second.
            joined = (across > one) & (across >= other)
            result[left[joined]] = False
            mine = one >= other
            i, j = i + mine, j + ~mine
            go = np.flatnonzero(~joined & (np.maximum(one, other) > -np.inf))
            left, a, b, i, j = left[go], a[go], b[go], i[go], j[go]
        return result


class Walk:
    """Forward states of all prefixes of a word; the next word starts from shared ones.

    For each depth: the last piece (NO_PIECE for a character without one) and where it
    begins, the score so far, and the open paths into the vocabulary with their starts.
    The encoding is read off backwards when a word is complete.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.pairs = vocabulary, vocabulary.pairs
        self.packed = vocabulary.packed
        self.last, self.begin, self.score = [NO_PIECE], [0], [0.0]
        self.open: list[list[tuple[int, dict]]] = [[]]

    def encode(self, word: str, shared: int) -> bytes | None:
        """Ids of a word whose first ``shared`` characters are those of the one before.

        None if merging reaches no piece at some place (BPE only); the states before it
        stay, so that the next word may share them.
        """
        last, begins, score, open_ = self.last, self.begin, self.score, self.open
        v = self.v
        root, pairs, bpe = v.trie, self.pairs, v.bpe
        for states in (last, begins, score, open_):
            del states[shared + 1 :]
        for at in range(len(last) - 1, len(word)):
            char = word[at]
            paths, best, best_begin, best_score = [], None, at, 0.0
            for begin, following in (*open_[at], (at, root)):
                node = following.get(char)
                if node is None:
                    continue
                piece, following = node
                if following:
                    paths.append((begin, following))
                if piece is None:
                    continue
                if bpe:
                    if best is None:
                        before = last[begin]
                        if before == NO_PIECE or pairs[before, piece]:
                            best, best_begin = piece, begin
                else:
                    total = score[begin] + v.scores[piece]
                    if best is None or total > best_score:
                        best, best_begin, best_score = piece, begin, total
            if best is None:
                if char in v.ids:
                    return None
                best, best_score = NO_PIECE, score[at] - 1e9
            last.append(best)
            begins.append(best_begin)
            score.append(best_score)
            open_.append(paths)
        return self.ids(word)

    def ids(self, word: str) -> bytes:
        """The encoding of a word whose states are complete."""
        found, at = [], len(word)
        while at:
            if self.last[at] == NO_PIECE:
                found.append(b"".join(self.packed[i] for i in self.v.fallback(word[at - 1])))
            else:
                found.append(self.packed[self.last[at]])
            at = self.begin[at]
        return b"".join(reversed(found))


class Front:
    """Forward states of all prefixes of one length at once, for short BPE words.

    The pieces lie as a trie in arrays.  A state is the last piece and the state where
    that piece begins; an open path is a place in the pieces' trie with the state where
    it began, and the paths of a state follow each other, the longest first.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        steps: dict[tuple[int, str], int] = {}
        ends = {}
        for piece, i in vocabulary.ids.items():
            node = 0
            for char in piece:
                node = steps.setdefault((node, char), len(steps) + 1)
            ends[node] = i
        chars = sorted({char for _, char in steps})
        # The number of a character; the last one stands for all that are in no piece.
        self.number = np.full(0x110000, len(chars), np.int32)
        self.number[[ord(char) for char in chars]] = np.arange(len(chars))
        self.known = np.array([*(char in vocabulary.ids for char in chars), False])
        self.width = len(chars) + 1
        keys = np.array([node * self.width + self.number[ord(char)] for node, char in steps], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.nodes = np.append(np.array([*steps.values()], np.int32)[order], np.int32(0))
        self.piece = np.full(len(steps) + 1, NO_PIECE, np.int32)
        self.piece[[*ends]] = [*ends.values()]
        self.inner = np.zeros(len(steps) + 1, bool)
        self.inner[[node for node, _ in steps]] = True
        # Pairs asked for, each with its answer as lowest bit; a later one takes the place.
        self.asked = np.full(1 << PAIR_BITS, -1, np.int64)

    def follow(self, before: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """May the pieces stand side by side?"""
        pairs = before.astype(np.int64) * len(self.v.pieces) + pieces
        places = (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)
        found = self.asked[places]
        new = np.flatnonzero(found >> 1 != pairs)
        if len(new):
            asked, at, back = np.unique(pairs[new], return_index=True, return_inverse=True)
            answers = self.v.neighbours.follow(*np.divmod(asked, len(self.v.pieces)))
            self.asked[places[new[at]]] = asked * 2 + answers
            found[new] = answers[back]
        return (found & 1).astype(bool)

    def choose(self, before: np.ndarray, owner: np.ndarray, pieces: np.ndarray, count: int) -> np.ndarray:
        """For each of ``count`` owners, which of its candidates is the first that may follow.

        Candidates are sorted by owner, the longest first.  -1 for owners without any.
        """
        chosen = np.full(count, -1)
        left = np.arange(len(owner))
        while len(left):
            mine = owner[left]
            first = np.append(True, mine[1:] != mine[:-1])
            tried = left[first]
            fits = before[tried] == NO_PIECE
            asked = np.flatnonzero(~fits)
            fits[asked] = self.follow(before[tried[asked]], pieces[tried[asked]])
            chosen[owner[tried[fits]]] = tried[fits]
            left = left[~first]
            left = left[chosen[owner[left]] < 0]
        return chosen

    def encode(self, words: list[str]) -> list[bytes | None]:
        """Ids of sorted, distinct words; None if merging reaches no piece at some place."""
        sizes = np.array([len(word) for word in words])
        longest = int(sizes.max())
        chars = np.array(words, f"U{longest}").view(np.uint32).reshape(len(words), longest)
        other = chars[1:] != chars[:-1]
        shared = np.where(other.any(axis=1), other.argmax(axis=1), longest)
        shared = np.append(0, np.minimum(shared, np.minimum(sizes[1:], sizes[:-1])))

        total = 1 + int((sizes - shared).sum())
        last, origin = np.full(total, NO_PIECE, np.int32), np.zeros(total, np.int32)
        state = np.zeros(len(words), np.int32)  # of each word's prefix so far
        live = np.arange(len(words))
        # The open paths of the states from ``base`` on: place and beginning, by state.
        base, node, begin = 0, np.zeros(1, np.int32), np.zeros(1, np.int32)
        counts, starts = np.ones(1, np.int64), np.zeros(1, np.int64)
        end = 1
        for depth in range(1, longest + 1):
            live = live[sizes[live] >= depth]
            if not len(live):
                break
            new = shared[live] < depth
            firsts = live[new]
            parent = state[firsts] - base
            char = self.number[chars[firsts, depth - 1]].astype(np.int64)
            state[live] = end + np.cumsum(new) - 1

            many = counts[parent]
            owner = np.repeat(np.arange(len(firsts), dtype=np.int32), many)
            source = np.arange(len(owner)) + np.repeat(starts[parent] - (np.cumsum(many) - many), many)
            keys = node[source].astype(np.int64) * self.width + char[owner]
            places = np.searchsorted(self.keys, keys)
            found = np.flatnonzero(self.keys[places] == keys)
            owner, begin, node = owner[found], begin[source[found]], self.nodes[places[found]]

            ended = np.flatnonzero(self.piece[node] != NO_PIECE)
            pieces = self.piece[node[ended]]
            chosen = self.choose(last[begin[ended]], owner[ended], pieces, len(firsts))
            here = np.arange(end, end + len(firsts), dtype=np.int32)
            none = chosen < 0
            last[here] = np.where(self.known[char], _LOST, NO_PIECE)
            origin[here] = parent + base
            last[here[~none]] = pieces[chosen[~none]]
            origin[here[~none]] = begin[ended][chosen[~none]]

            open_ = np.flatnonzero(self.inner[node])
            owner = np.append(owner[open_], np.arange(len(firsts), dtype=np.int32))
            order = np.argsort(owner, kind="stable")
            begin = np.append(begin[open_], here)[order]
            node = np.append(node[open_], np.zeros(len(firsts), np.int32))[order]
            counts = np.bincount(owner, minlength=len(firsts))
            starts = np.cumsum(counts) - counts
            base, end = end, end + len(firsts)
            live = live[last[state[live]] != _LOST]
        return self.ids(words, state, last, origin)

    def ids(self, words: list[str], state: np.ndarray, last: np.ndarray, origin: np.ndarray) -> list[bytes | None]:
        """The encodings, read off backwards from the states of whole words."""
        lost = last[state] == _LOST
        at, columns = np.where(lost, 0, state), []
        while at.any():
            columns.append(np.where(at > 0, last[at], _LOST))
            at = origin[at]
        table = np.array(columns[::-1], "<i4").T.reshape(len(words), -1)
        numbers = (table != _LOST).sum(axis=1)
        odd = (table == NO_PIECE).any(axis=1)
        packed, wide = table.tobytes(), 4 * table.shape[1]
        found: list[bytes | None] = []
        for i, (number, none) in enumerate(zip(numbers.tolist(), lost.tolist()), 1):
            found.append(None if none else packed[i * wide - 4 * number : i * wide])
        for i in np.flatnonzero(odd).tolist():
            found[i] = self.with_fallback(words[i], table[i, -int(numbers[i]) :].tolist())
        return found

    def with_fallback(self, word: str, pieces: list[int]) -> bytes:
        found, at = [], 0
        for piece in pieces:
            found += self.v.fallback(word[at]) if piece == NO_PIECE else [piece]
            at += 1 if piece == NO_PIECE else len(self.v.pieces[piece])
        return np.array(found, "<i4").tobytes()


def encode_words(words: list[str], vocabulary: Vocabulary) -> Iterator[bytes]:
    """Encodings of sorted, distinct words, as 32-bit numbers."""
    short = []
    if vocabulary.bpe:
        short = [word for word in words if len(word) <= SHORT and not word.startswith(MARK * 2)]
    together: dict[str, bytes | None] = {}
    for start in range(0, len(short), TOGETHER):
        block = short[start : start + TOGETHER]
        together.update(zip(block, vocabulary.front.encode(block)))
    walk, before = Walk(vocabulary), ""
    for word in words:
        found = together.get(word)
        if not (word in together or vocabulary.bpe and word.startswith(MARK * 2)):
            shared = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                shared += 1
            found = walk.encode(word, shared)
            before = word[: len(walk.last) - 1]
        if found is None:
            # Runs of marks have pieces of equal scores, and some pieces cannot be
            # reached by merging: such words are merged by definition.
            found = np.array(vocabulary.as_ids(vocabulary.merged(word)), "<i4").tobytes()
        yield found


class Encoder:
    """Encodes texts; remembers the words of late."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.known, self.size = vocabulary, {}, 0

    def texts(self, texts: Iterable[str | None]) -> Iterator[bytes | None]:
        """The ids of each text as 32-bit numbers, texts in groups of about a slice."""
        group: list[list[list[str] | bytes] | None] = []
        new: set[str] = set()
        size = 0
        for text in texts:
            group.append(None if text is None else [])
            for words, length in _slices(text or ""):
                group[-1].append(words)
                new.update(words)
                size += length
                if size > SLICE:
                    self.learn(new)
                    done, unfinished = group[:-1], group[-1]
                    yield from map(self.joined, done)
                    group, new, size = [[self.joined(unfinished)]], set(), 0
        self.learn(new)
        yield from map(self.joined, group)

    def joined(self, parts: list[list[str] | bytes] | None) -> bytes | None:
        if parts is None:
            return None
        known = self.known.__getitem__
        return b"".join(p if isinstance(p, bytes) else b"".join(map(known, p)) for p in parts)

    def learn(self, words: set[str]) -> None:
        """Encode the words not known; only those of this slice if there are too many."""
        if self.size > MOST_KNOWN:
            self.known = {w: self.known[w] for w in words if w in self.known}
            self.size = sum(map(self._bytes, self.known.items()))
        ordered = sorted(words.difference(self.known))
        fresh = dict(zip(ordered, encode_words(ordered, self.v)))
        self.size += sum(map(self._bytes, fresh.items()))
        self.known.update(fresh)

    @staticmethod
    def _bytes(entry: tuple[str, bytes]) -> int:
        """About what a word and its encoding take, with their place in the table."""
        return 2 * len(entry[0]) + len(entry[1]) + 200


def _slices(text: str) -> Iterator[tuple[list[str], int]]:
    """The marked words of a text, in slices that end where a word does."""
    marked = MARK + text.replace(" ", MARK) if text else ""
    start = 0
    while start < len(marked):
        end = min(start + SLICE, len(marked))
        if end < len(marked):
            at = re.compile(f"(?<!{MARK}){MARK}").search(marked, end)
            end = at.start() if at else len(marked)
        yield _WORDS.findall(marked, start, end), end - start
        start = end


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    text = b"".join(map(vocabulary.surfaces.__getitem__, ids)).decode("utf-8", "replace")
    return text.removeprefix(" ")


def share(spark: SparkSession, model: str = MODEL) -> Broadcast:
    """The vocabulary for all tasks: as large as the model file, whatever the data."""
    ship_code(spark)
    return spark.sparkContext.broadcast(Vocabulary.load(model))


def encoded(vocabulary: Broadcast, text: str = "text") -> Column:
    """Piece ids of a text column."""

    @F.arrow_udf(ArrayType(IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = vocabulary.value.encoder
        for texts in batches:
            rows = list(encoder.texts(t.as_py() for t in texts))
            ends = np.cumsum([0, *(len(r or b"") // 4 for r in rows)], dtype=np.int32)
            nulls = pa.array([r is None for r in rows])
            values = np.frombuffer(b"".join(r or b"" for r in rows), "<i4")
            del rows
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(values), mask=nulls)

    return encode(F.col(text).cast("string"))


def decoded(vocabulary: Broadcast, ids: str) -> Column:
    """The text of a column of piece ids."""

    @F.arrow_udf(StringType())
    def restore(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocabulary.value
        for rows in batches:
            cells = (row.as_py() for row in rows)
            yield pa.array([None if r is None else decode(r, v) for r in cells], pa.string())

    return restore(F.col(ids))


def checked(vocabulary: Broadcast, text: str = "text") -> Column:
    """Struct of a text: number of pieces, digest of the ids, does decoding restore it?"""

    @F.arrow_udf("n_pieces long, ids_sha256 string, restored boolean")
    def check(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = vocabulary.value.encoder
        for batch in batches:
            numbers, digests, restored = [], [], []
            for cell, row in zip(batch, encoder.texts(t.as_py() for t in batch)):
                text = cell.as_py()
                numbers.append(None if row is None else len(row) // 4)
                digests.append(None if row is None else hashlib.sha256(row).hexdigest())
                ids = np.frombuffer(row or b"", "<i4").tolist()
                restored.append(None if row is None else decode(ids, encoder.v) == text)
            columns = [pa.array(numbers, pa.int64()), pa.array(digests, pa.string()), pa.array(restored, pa.bool_())]
            yield pa.StructArray.from_arrays(columns, ["n_pieces", "ids_sha256", "restored"])

    return check(F.col(text).cast("string"))


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``docs`` with ``piece_ids`` added (replacing a column of that name)."""
    return docs.withColumn("piece_ids", encoded(share(docs.sparkSession, model)))


def decode_ids(rows: DataFrame, model: str = MODEL, ids: str = "piece_ids") -> DataFrame:
    """``rows`` with ``decoded_text`` from a column of ids."""
    return rows.withColumn("decoded_text", decoded(share(rows.sparkSession, model), ids))


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, ids_sha256`` (32-bit little-endian ids), ``restored``."""
    docs = read_table(spark, sf_dir, "documents")
    result = docs.select("doc_id", checked(share(spark)).alias("c"))
    return result.select("doc_id", "c.*")
