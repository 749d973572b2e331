"""Katz backoff against a plain version that looks every token up."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerquarry.llm import katz_model

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
KEPT = katz_model.KEPT


def tokens(text):
    return [*WORDS.findall((text or "").encode().lower()), None]


class Plain:
    """Counts in dictionaries, probabilities by the definition.

    The context of a first token is the text's start, in all orders above 1.
    """

    def __init__(self, texts, order):
        self.order, self.counts, self.contexts = order, Counter(), Counter()
        self.followers = defaultdict(set)
        for text in texts:
            for n, context, word in self.grams(text):
                self.counts[n, context, word] += 1
                self.contexts[n, context] += 1
                self.followers[n, context].add(word)
        self.vocabulary = {w for n, _, w in self.counts if n == 1}
        self.total = self.contexts[1, ()]
        self.discount = {}
        for n in range(1, order + 1):
            of = Counter(c for (m, _, _), c in self.counts.items() if m == n)
            common = (KEPT + 1) * of[KEPT + 1] / of[1] if of[1] else 1.0
            for r in range(1, KEPT + 1):
                value = ((r + 1) * of[r + 1] / of[r] / r - common) / (1 - common) if of[r] and common != 1 else 0
                self.discount[n, r] = value if 0 < value < 1 else (r - 0.5) / r

    def grams(self, text):
        words = ["<s>", *tokens(text)]
        for i in range(1, len(words)):
            for n in range(1, self.order + 1):
                yield n, tuple(words[max(0, i - n + 1) : i]), words[i]

    def p(self, n, context, word):
        shorter = () if n == 2 else context[-(n - 2) :] if n > 2 else None
        count, total = self.counts[n, context, word], self.contexts[n, context]
        if not total:
            return self.p(n - 1, shorter, word) if n > 1 else 1.0
        of = {w: self.counts[n, context, w] for w in self.followers[n, context]}
        taken = sum(r * (1 - self.discount[n, r]) for r in of.values() if r <= KEPT)
        if not taken:
            taken, total = 1, total + 1
        if count:
            return self.discount.get((n, count), 1.0) * count / total
        if n == 1:
            return taken / total
        below = sum(self.p(n - 1, shorter, w) for w in of)
        return taken / total / (1 - below) * self.p(n - 1, shorter, word)

    def score(self, text):
        return sum(math.log10(self.p(n, c, w)) for n, c, w in self.grams(text) if n == self.order)


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    words = np.array([f"w{i}" for i in range(60)])
    weights = 1 / np.arange(1, 61)
    weights /= weights.sum()
    return [" ".join(rng.choice(words, rng.integers(0, 60), p=weights)) for _ in range(n)]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def rows_of(texts):
    return [(i, t) for i, t in enumerate(texts)]


@pytest.fixture
def small_shards(monkeypatch):
    """Several blocks and shards on small tables, and contexts spread over shards."""
    monkeypatch.setattr(katz_model, "SHARD", 300)
    evaluate = katz_model.in_blocks
    monkeypatch.setattr(katz_model, "in_blocks", lambda docs, h: evaluate(docs, h, 200))


@pytest.mark.usefixtures("small_shards")
def test_bigrams_equal_the_plain_version(spark):
    data = rows_of(corpus(120, 3)) + [(500, None), (501, ""), (None, "w1 W2 w1"), (3, "w1 w1 w9 unheard"), (502, "new\tW0\nnew W0 " * 40)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    scored, model = katz_model.evaluate(docs, katz_model.held_out())
    plain = Plain([t for i, t in data if not held(i)], 2)
    assert model.tokens == plain.total and model.levels[0].types == len(plain.vocabulary)
    assert len(model.levels[1].hot[0]) > 0  # a context is spread over shards
    expected = []
    for i, text in data:
        known = [plain.counts[1, (), w] for w in tokens(text)]
        base = sum(math.log10((c + 1) / (plain.total + len(plain.vocabulary) + 1)) for c in known)
        expected.append((-1 if i is None else i, held(i), len(known), sum(c > 0 for c in known), round(base, 6), round(plain.score(text), 6)))
    found = [(-1 if r[0] is None else r[0], *r[1:4], round(r[4], 6), round(r[5], 6)) for r in scored.collect()]
    assert sorted(found) == sorted(expected)
    # Known words and the class of unknown ones share a mass of 1.
    for context in [("<s>",), (b"w0",), (b"w59",), (b"never",)]:
        words = [*plain.vocabulary, b"never"]
        assert abs(sum(plain.p(2, context, w) for w in words) - 1) < 1e-9


@pytest.mark.usefixtures("small_shards")
def test_trigrams_equal_the_plain_version(spark):
    texts = corpus(60, 4)
    docs = spark.createDataFrame(rows_of(texts), "doc_id long, text string")
    scored, model = katz_model.evaluate(docs, katz_model.held_out(), order=3)
    assert [level.shards > 1 for level in model.levels[1:]] == [True, True]
    plain = Plain([t for i, t in rows_of(texts) if not held(i)], 3)
    for r in scored.collect():
        assert abs(r.score - plain.score(texts[r.doc_id])) < 1e-6


@pytest.mark.usefixtures("small_shards")
def test_a_stored_model_scores_other_texts(spark):
    texts = corpus(80, 5)
    train = spark.createDataFrame(rows_of(texts), "doc_id long, text string")
    _, model = katz_model.evaluate(train, F.lit(False))
    others = corpus(20, 6) + ["quite other words w1 w2", ""]
    scored, _ = katz_model.evaluate(
        spark.createDataFrame(rows_of(others), "doc_id long, text string"), F.lit(False), model=model
    )
    plain = Plain(texts, 2)
    found = {r.doc_id: r for r in scored.collect()}
    assert all(abs(found[i].score - plain.score(t)) < 1e-6 for i, t in enumerate(others))
    assert all(r.held_out for r in found.values())


def test_no_rows_and_no_training_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert katz_model.evaluate(empty, katz_model.held_out())[0].collect() == []
    row = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    found = katz_model.evaluate(row, F.lit(True))[0].collect()[0]
    assert (found.n_tokens, found.n_known, found.base_score, found.score) == (3, 0, 0.0, 0.0)


def test_discounts():
    found = katz_model.discounts(np.array([100, 40, 20, 12, 8, 5]))
    common = 6 * 5 / 100
    assert abs(found[1] - ((2 * 40 / 100) - common) / (1 - common)) < 1e-12
    assert found[6] == 1.0 and all(0 < d < 1 for d in found[1:6])
    assert katz_model.discounts(np.zeros(6)).tolist() == [1, 0.5, 0.75, 2.5 / 3, 0.875, 0.9, 1]


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for values in (np.array([], np.int64), np.array([5]), np.array([0, 255, 256]), rng.integers(-(2**62), 2**62, 1000)):
        assert katz_model.unpack(katz_model.pack(values)).tolist() == values.tolist()
        ordered = np.sort(values)
        assert katz_model.unpack_sorted(katz_model.pack_sorted(ordered)).tolist() == ordered.tolist()
    doubles = rng.random(50)
    assert (katz_model.unpack(katz_model.pack(doubles)) == doubles).all()
