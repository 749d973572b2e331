"""Personal data found by weak supervision (operator 7).

Candidates are the matches of strict patterns (the base: always kept) and of wider
ones: e-mail addresses spelled with (at) and (dot), telephone numbers without the
international prefix, grouped card numbers whose check digit fails, addresses of six
or eight groups.  Labelers vote on each: the strict pattern with its check, word lists
before the match, and the characters around it.  Expectation-maximisation over the
counts of all vote patterns (at most 3^5 for each kind, whatever the input) estimates
how reliable each labeler is.  Its verdicts train a logistic regression over properties
of the span and its context, which decides about the candidates outside the base.  It is
fitted for each kind on all candidates: they are counted in cells of equal votes and
nearly equal features (a grid of 1/``GRID``, so their number has a bound), and a cell
stands for its candidates by its mean features, its count as weight.

Special cases: a null text is empty and has no spans; very long texts are searched as a
whole, by patterns whose time is linear; rows are judged each by their own text; with no
candidate outside the base, or no rows at all, only base spans are returned; a model that
never saw a kind decides about it by the sum of the votes.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from offerquarry.llm.common import read_table
from offerquarry.sources.shared import ship_code

KINDS = ["email", "ip", "card", "phone"]
GRID = 16  # cells of the features between 0 and 1
EXACT = 1 << 20  # features are summed as whole numbers, so in any order alike
ROUNDS = 50
SURE = 0.9  # least probability of a span outside the base

# The base patterns.  The mail pattern starts at the sign, the local part
# is found backwards from there; possessive repeats and the look-behind change no match
# but keep the search linear on long runs.
_MAIL = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_BASE = {
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_WIDER = {
    "email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}+"
        r"(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63}+)+"
    ),
    "phone": re.compile(r"(?<![0-9+])(?:\([0-9]{2,5}\) ?|[0-9]{3}[-./ ])[0-9]{3,4}[-./ ][0-9]{4}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])"),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])"),
}
# Words that speak for a kind when they stand shortly before a match, and against all.
_FOR = {
    "email": "mail e-mail email contact kontakt write correo courriel adresse address".split(),
    "ip": "ip server host address adresse dirección from login client ping".split(),
    "card": "card visa mastercard amex credit payment karte carte tarjeta kreditkarte".split(),
    "phone": "phone tel telephone call mobile fax cell telefon téléphone teléfono handy".split(),
}
_AGAINST = "isbn issn version doi id no nr order article seed page part build release".split()
_NOT_WORD = re.compile(r"[^\w-]+")
NEAR = 24  # characters of context on either side

LABELERS = ["strict", "words_for", "words_against", "form", "surroundings"]
FEATURES = [
    "base", "words_for", "words_against", "length", "digits", "separators", "letters",
    "at_start", "at_end", "blank_before", "blank_after", "digit_near",
]


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    base: bool
    votes: tuple[int, ...]  # 1 for, -1 against, 0 abstains
    features: tuple[float, ...]


def luhn(digits: str) -> bool:
    """Does the check digit fit?"""
    values = [int(d) for d in reversed(digits)]
    doubled = [2 * d - 9 * (d > 4) for d in values[1::2]]
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    found, last = [], 0
    for m in _MAIL.finditer(text) if "@" in text else ():
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.append((start, m.end()))
            last = m.end()
    return found


def _fits(kind: str, match: str) -> bool:
    digits = "".join(c for c in match if c in "0123456789")
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


_ANY_DIGIT = re.compile("[0-9]")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Per kind: leftmost matches that do not overlap; what fails its check is dropped."""
    spans = {kind: [] for kind in KINDS}
    spans["email"] = _emails(text)
    if _ANY_DIGIT.search(text):
        for kind, pattern in _BASE.items():
            spans[kind] = [m.span() for m in pattern.finditer(text) if _fits(kind, m.group())]
    return spans


def _votes(kind: str, text: str, start: int, end: int, base: bool) -> tuple[tuple, tuple]:
    """Votes of the LABELERS, values of the FEATURES."""
    match = text[start:end]
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    words = set(_NOT_WORD.split(before.lower()))
    digits = sum(c.isdigit() for c in match)
    near = sum(c.isdigit() for c in before + after)
    apart = not (before[-1:].isalnum() or after[:1].isalnum())
    said_for = bool(words.intersection(_FOR[kind]))
    said_against = bool(words.intersection(_AGAINST))
    form = {
        "email": match.lower().rsplit(".", 1)[-1].isalpha(),
        "ip": True,
        "card": 15 <= digits <= 16,
        "phone": 10 <= digits <= 13,
    }[kind]
    votes = (
        1 if base else 0,
        1 if said_for else 0,
        -1 if said_against else 0,
        1 if form else -1,
        1 if apart and near <= 4 else -1,
    )
    letters = sum(c.isalpha() for c in match)
    features = (
        base, said_for, said_against, min(len(match), 40) / 40, digits / len(match),
        (len(match) - digits - letters) / len(match), letters / len(match), start == 0,
        end == len(text), before[-1:].isspace(), after[:1].isspace(), near / NEAR,
    )
    return votes, tuple(map(float, features))


def candidates(text: str) -> list[Candidate]:
    """Base matches, and wider ones that do not overlap with any match before."""
    spans = base_spans(text)
    found = [(k, s, e, True) for k in KINDS for s, e in spans[k]]
    wider = [
        (kind, *m.span(), False)
        for kind, pattern in _WIDER.items()
        if kind != "email" or "at" in text and ("(" in text or "[" in text)
        for m in pattern.finditer(text)
    ]
    if wider:
        # Base matches of different kinds may overlap: joined, all lie apart, in order.
        starts, ends = [], []
        for s, e in sorted((s, e) for _, s, e, _ in found):
            if ends and s < ends[-1]:
                ends[-1] = max(ends[-1], e)
            else:
                starts.append(s)
                ends.append(e)
        for kind in KINDS:  # wider matches of one kind lie apart, too
            fresh = []
            for item in wider:
                at = bisect_left(starts, item[2]) - 1  # the last one that begins before its end
                if item[0] == kind and (at < 0 or ends[at] <= item[1]):
                    fresh.append(item)
            found += fresh
            both = sorted([*zip(starts, ends), *(item[1:3] for item in fresh)])
            starts, ends = [s for s, _ in both], [e for _, e in both]
    return [Candidate(k, s, e, b, *_votes(k, text, s, e, b)) for k, s, e, b in found]


# --- the model -----------------------------------------------------------------------


def reliabilities(kind_votes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns of one kind.

    ``kind_votes`` has a pattern per row.  Returns each pattern's probability of being
    personal data, and per labeler the chance of each vote (-1, 0, 1) given no or yes.
    """
    start = kind_votes.sum(axis=1) + 0.5 * (kind_votes[:, 0] > 0)
    yes = 1 / (1 + np.exp(-start.astype(float)))
    for _ in range(ROUNDS):
        chance = np.empty((2, kind_votes.shape[1], 3))
        for truth, weight in enumerate(((1 - yes) * counts, yes * counts)):
            for vote in (-1, 0, 1):
                chance[truth, :, vote + 1] = weight @ (kind_votes == vote) + 0.1
        chance /= chance.sum(axis=2, keepdims=True)
        # A labeler votes for a class at least as often if it is the true one.
        flip = chance[1, :, 2] * chance[0, :, 0] < chance[0, :, 2] * chance[1, :, 0]
        chance[:, flip] = chance[:, flip].mean(axis=0)
        prior = np.clip(yes @ counts / counts.sum(), 0.05, 0.95)
        log = [np.log([1 - prior, prior][t]) + sum(
            np.log(chance[t, j, kind_votes[:, j] + 1]) for j in range(kind_votes.shape[1])
        ) for t in (0, 1)]
        yes = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return yes, chance


def fit(features: np.ndarray, soft: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Logistic regression on soft labels of rows that stand for ``counts`` each; the last
    weight is the constant."""
    x = np.hstack([features, np.ones((len(features), 1))])
    share = counts / counts.sum()
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ weights))
        weights -= 2.0 * (x.T @ (share * (p - soft)) + 1e-4 * weights)
    return weights


Model = dict[str, list[float]]  # weights by kind

_CANDIDATE = StructType(
    [
        StructField("kind", StringType()),
        StructField("start", IntegerType()),
        StructField("end", IntegerType()),
        StructField("base", BooleanType()),
        StructField("votes", ArrayType(IntegerType())),
        StructField("features", ArrayType(DoubleType())),
    ]
)


def _candidates_column() -> Column:
    @F.arrow_udf(ArrayType(_CANDIDATE))
    def find(texts: pa.Array) -> pa.Array:
        kind = pa.list_(
            pa.struct(
                [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                 ("base", pa.bool_()), ("votes", pa.list_(pa.int32())),
                 ("features", pa.list_(pa.float64()))]
            )
        )
        return pa.array([[vars(c) for c in candidates(t.as_py() or "")] for t in texts], kind)

    return find(F.col("text").cast("string"))


def learn(docs: DataFrame) -> Model:
    """Reliabilities and a classifier for each kind, from all candidates."""
    ship_code(docs.sparkSession)
    found = docs.select(F.inline(_candidates_column()))
    cell = F.transform("features", lambda x: F.floor(x * GRID))
    sums = [
        F.sum(F.round(F.col("features")[i] * EXACT).cast("long")).alias(name) for i, name in enumerate(FEATURES)
    ]
    cells = found.groupBy("kind", "votes", cell.alias("cell")).agg(F.count("*").alias("n"), *sums).collect()
    model = {}
    for kind in KINDS:
        rows = sorted((r for r in cells if r.kind == kind), key=lambda r: (r.votes, r.cell))
        if not rows:
            continue
        counts = np.array([r.n for r in rows], float)
        votes, pattern = np.unique([r.votes for r in rows], axis=0, return_inverse=True)
        yes, _ = reliabilities(votes, np.bincount(pattern, counts))
        features = np.array([[r[name] for name in FEATURES] for r in rows]) / (EXACT * counts[:, None])
        model[kind] = fit(features, yes[pattern], counts).tolist()
    return model


def decided(text: str, model: Model) -> list[Candidate]:
    """The spans of a text: the base, and candidates the classifier is sure of."""
    kept = []
    for c in candidates(text):
        if not c.base:
            weights = model.get(c.kind)
            score = sum(c.votes) if weights is None else float(np.dot(weights[:-1], c.features) + weights[-1])
            if 1 / (1 + np.exp(-score)) < SURE:
                continue
        kept.append(c)
    return sorted(kept, key=lambda c: (KINDS.index(c.kind), c.start))


def _joined(spans: list[Candidate]) -> str:
    return ",".join(f"{c.kind}:{c.start}:{c.end}" for c in spans)


_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def spans_column(model: Model) -> Column:
    """Numbers of spans by kind, a digest of the base spans, and all spans."""

    @F.arrow_udf(_FOUND)
    def spans(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            found = decided(text.as_py() or "", model)
            base = [c for c in found if c.base]
            numbers = [sum(c.kind == kind for c in base) for kind in KINDS]
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            rows.append((*numbers, digest, _joined(found)))
        columns = list(zip(*rows)) or [()] * 6
        types = [pa.int64()] * 4 + [pa.string()] * 2
        return pa.StructArray.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
        )

    return spans(F.col("text").cast("string"))


def redacted_column(model: Model) -> Column:
    """The text with every span replaced by its kind in brackets; null stays null."""

    @F.arrow_udf(StringType())
    def redact(texts: pa.Array) -> pa.Array:
        result = []
        for text in texts.to_pylist():
            spans = sorted((c.start, -c.end, c.kind) for c in decided(text, model)) if text else []
            if spans:
                parts, at = [], 0
                for start, end, kind in spans:
                    if start >= at:
                        parts += [text[at:start], f"[{kind.upper()}]"]
                    at = max(at, -end)
                text = "".join([*parts, text[at:]])
            result.append(text)
        return pa.array(result, pa.string())

    return redact(F.col("text").cast("string"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of base spans, their digest and all spans, per row."""
    model = learn(docs)
    return docs.select("doc_id", spans_column(model).alias("found")).select("doc_id", "found.*")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``, and ``n_chars`` counted anew."""
    model = learn(docs)
    changed = {"text": redacted_column(model)}
    rows = docs.withColumns(changed)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))
    return rows


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read_table(spark, sf_dir, "documents"))
