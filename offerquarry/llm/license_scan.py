"""Licence families of paragraphs (operator 6), with DataFrame functions only.

A paragraph is a line with a word.  Sparse logistic regression over word n-grams tells
the licence families apart, and from an "unknown" class.  It learns from notices (forms
times names, SPDX lines, the usual headers and bodies, and pieces of these), from denied
notices as unknown ones, and from a bounded sample of the corpus' own lines.

A line is judged by its *spans*: runs of overlapping triples of words of some notice.
So the prose around a notice does not count, a line may have several families, and no
list of names decides what is judged.  The classifier reads a span and the ``BEFORE``
words before it ("not licensed under ..." is no notice), and a family is taken only if
its probability passes a limit and if at least ``CONFIRMED`` percent of the span's triples
occur in the notices of that family.  The limit is calibrated on all unknown lines: those
of the whole corpus that hold a telling word, but no triple of any notice.

Only n-grams with a positive weight can speak for a family, so lines without the rarest
word of any such n-gram are set aside first; that loses none.

Special cases: a null text is empty; a document without a licence has an empty list; rows
with the same id are told apart by their texts, and so are rows without id; equal rows
have equal findings; very long lines are scanned whole; with an empty corpus there are no
rows.
"""

from __future__ import annotations

import json
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerquarry.llm.common import read_table
from offerquarry.sources.shared import write_and_read

# Names of licences, as notices give them.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 license"],
    "MIT": ["MIT License", "MIT license", "Expat License"],
    "BSD": ["BSD License", "BSD 3-Clause License", "BSD-3-Clause license", "BSD 2-Clause License", "modified BSD license"],
    "GPL": ["GNU General Public License, version 3", "GNU General Public License", "GNU GPL v3", "GPL-3.0 license",
            "GNU General Public License, version 2"],
    "LGPL": ["GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL-2.1 license",
             "GNU Lesser General Public License"],
    "AGPL": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0 license"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "CC-BY": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY license"],
    "CC-BY-SA": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0": ["CC0 1.0", "CC0 1.0 Universal public domain dedication"],
}
FORMS = [
    "Licensed under {}.",
    "Licensed under the {}.",
    "Released under the {}.",
    "This work is licensed under the {}.",
    "This work is licensed under a {}.",
    "This project is licensed under the terms of the {}; see the LICENSE file for details.",
    "Distributed under the {}.",
    "You may use, copy and modify this under the terms of the {}.",
    "This file is part of a program published under the {} as published by its authors.",
    "License: {}",
    "available under the {}",
    "or the {}",
    "and the {}",
    "{}",
]
# Identifiers in SPDX lines.
SPDX = {
    "Apache-2.0": ["Apache-2.0"],
    "MIT": ["MIT"],
    "BSD": ["BSD-2-Clause", "BSD-3-Clause"],
    "ISC": ["ISC"],
    "GPL": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "AGPL": ["AGPL-3.0-only", "AGPL-3.0-or-later"],
    "MPL-2.0": ["MPL-2.0"],
    "CC-BY": ["CC-BY-4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0"],
    "CC-BY-NC": ["CC-BY-NC-4.0"],
    "CC0": ["CC0-1.0"],
}
SPDX_FORMS = ["SPDX-License-Identifier: {}", "OR {}", "AND {}"]
# Paragraphs of licences and of their usual headers, as published.
BODIES = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
}
# Words before a notice that deny it.
DENIALS = ["not", "were not", "is not", "never", "no longer", "isn't", "wasn't", "rather than"]
FAMILIES = list(dict.fromkeys([*NAMES, *SPDX]))
UNKNOWN = "unknown"
LONGEST = 3  # words in an n-gram
PIECE, PIECE_STEP = 12, 3  # words in the pieces of bodies that are learned from
UNKNOWN_LINES = 4000  # sampled to learn from
COMMON = 0.02  # share of the sampled lines: words found in more tell nothing alone
CONFIRMED = 50  # percent of a span's triples found in the notices of its family
BEFORE = 3  # words before a span that are judged with it
STRAY = 0.001  # share of the unknown lines that the limit may let pass
BINS = 1000
LASSO = 0.0002


def words(text: Column) -> Column:
    """Lower-case words and version numbers."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:\.[0-9]+)*"), F.lit(0))


def _ngrams_sql(of: str) -> str:
    runs = [
        f"transform(sequence(1, greatest(size({of}) - {n - 1}, 1)), "
        f"i -> array_join(slice({of}, i, {n}), ' '))"
        for n in range(1, LONGEST + 1)
    ]
    return f"if(size({of}) > 0, array_distinct(concat({', '.join(runs)})), cast(array() AS array<string>))"


def ngrams(of: str) -> Column:
    """All runs of up to LONGEST words of a column of words, each once."""
    return F.expr(_ngrams_sql(of))


def around(of: str) -> Column:
    """For each word its place: ``BEFORE`` words, and the triple that the word is the
    middle of; "^" and "$" stand for the line's ends."""
    padded = f"concat(array_repeat('', {BEFORE}), array('^'), {of}, array('$'))"
    places = f"transform(sequence(1, greatest(size({of}), 1)), i -> slice({padded}, i, {BEFORE + LONGEST}))"
    return F.expr(places)


def triple(of: str = "around") -> Column:
    return F.array_join(F.slice(of, BEFORE + 1, LONGEST), " ")


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of the driver's, passed as one literal."""
    names = [column.split()[0] for column in schema.split(", ")]
    text = F.lit(json.dumps([dict(zip(names, row)) for row in rows]))
    return spark.range(1).select(F.inline(F.from_json(text, f"array<struct<{schema.replace(' ', ':')}>>".replace(",:", ","))))


def _filled(families: dict[str, list[str]], forms: list[str]) -> list[tuple[str, str]]:
    return [(f, form.replace("{}", name)) for f, several in families.items() for name in several for form in forms]


def notices(spark: SparkSession) -> DataFrame:
    """``family, words`` of all notices."""
    texts = _filled(NAMES, FORMS) + _filled(SPDX, SPDX_FORMS) + _filled(BODIES, ["{}"])
    table = _table(spark, texts, "family string, text string")
    return table.select("family", words(F.col("text")).alias("words"))


def examples(spark: SparkSession) -> DataFrame:
    """``family, words`` to learn from: notices, pieces of the long ones, and denied
    notices as unknown ones."""
    whole = notices(spark)
    starts = F.expr(f"sequence(1, size(words) - {PIECE} + 1, {PIECE_STEP})")
    pieces = whole.where(F.size("words") > PIECE).select("family", "words", F.explode(starts).alias("at"))
    pieces = pieces.select("family", F.slice("words", F.col("at"), F.lit(PIECE)).alias("words"))
    denial = F.explode(F.array(*[words(F.lit(d)) for d in DENIALS])).alias("denial")
    denied = whole.where(F.size("words") <= PIECE).select(denial, "words")
    denied = denied.select(F.lit(UNKNOWN).alias("family"), F.concat("denial", "words").alias("words"))
    return whole.unionByName(pieces).unionByName(denied)


def lines(docs: DataFrame) -> DataFrame:
    """``row, doc_id, digest, line`` (its number from 0) and ``value`` of every line;
    ``row`` tells repeated rows apart, ``digest`` different texts under one id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.md5(text).alias("digest"), text.alias("text")
    )
    return rows.select("row", "doc_id", "digest", F.posexplode_outer(F.split("text", "\n")).alias("line", "value"))


def holds_any(anchors: list[str]) -> Column:
    """Is one of these words among a line's words?

    A pattern that lets at least these lines through spares most lines the split into
    words: no word begins after a letter, and none goes on with a letter or digit, but
    for version numbers, which a letter may follow.
    """
    ends = [re.escape(a) + ("(?![0-9])" if "." in a else "(?![a-z0-9])") for a in anchors]
    likely = F.col("value").rlike(f"(?iu)(?<![a-z])(?:{'|'.join(ends)})")
    return likely & F.arrays_overlap(words(F.col("value")), F.array(*map(F.lit, anchors)))


class LicenseModel:
    """Weights of n-grams by family, and the limit."""

    def __init__(self, spark: SparkSession, docs: DataFrame):
        places = notices(spark).select("family", F.explode(around("words")).alias("around"))
        triples = places.select("family", triple().alias("triple"))
        #: In which families' notices a triple of words occurs; bounded by the notices.
        self.triples = write_and_read(
            triples.groupBy("triple").agg(F.collect_set("family").alias("known")), "templates"
        )
        taught = examples(spark).select("family", "words")
        self.families = [*FAMILIES, UNKNOWN]
        label = F.array_position(F.array(*map(F.lit, self.families)), F.col("family")) - 1
        sample = self._unknown_lines(docs)
        rows = taught.withColumn("sampled", F.lit(False)).unionByName(
            sample.select(F.lit(UNKNOWN).alias("family"), "words", F.lit(True).alias("sampled"))
        )
        # One file, of a bounded size: the fit is many short jobs over it.
        rows = rows.select(label.cast("double").alias("label"), "words", ngrams("words").alias("grams"), "sampled")
        rows = write_and_read(rows.coalesce(1), "training")
        vocabulary = self._vocabulary(rows)
        regression = LogisticRegression(
            family="multinomial", elasticNetParam=1.0, regParam=LASSO, maxIter=80, standardization=False
        ).fit(vocabulary.transform(rows).select("features", "label"))
        matrix = regression.coefficientMatrix.toArray()
        weights = [
            (gram, self.families[i], float(w))
            for j, gram in enumerate(vocabulary.vocabulary)
            for i, w in enumerate(matrix[:, j])
            if w
        ]
        self.table = write_and_read(self._by_gram(spark, weights), "weights")
        self.constants = regression.interceptVector.toArray().tolist()
        speaking = {g for g, f, w in weights if w > 0 and f != UNKNOWN}
        self.anchors = sorted(
            {min(g.split(), key=lambda w: (self.often.get(w, 0), -len(w), w)) for g in speaking}
        )

    def _unknown_lines(self, docs: DataFrame) -> DataFrame:
        """``words`` of at most UNKNOWN_LINES lines, by hash, that are no notices.

        The texts they come from are chosen by hash first, so that few lines are sorted.
        """
        texts, parts = docs.count(), 1 << 30
        share = int(parts * min(1.0, 4 * UNKNOWN_LINES / max(texts, 1)))
        chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) < share)
        order = F.xxhash64("value", "doc_id", "line", F.lit(6))
        sample = lines(chosen).where(F.col("value").rlike("[A-Za-z0-9]")).select("value", order.alias("half"))
        sample = sample.orderBy("half", "value").limit(UNKNOWN_LINES)
        sample = sample.select(F.monotonically_increasing_id().alias("row"), words(F.col("value")).alias("words"))
        sample = write_and_read(sample.where("size(words) > 0"), "lines")
        # A sampled line with two triples of a notice is no example of unknown text.
        places = sample.select("row", F.explode_outer(around("words")).alias("around"))
        hits = places.select("row", triple().alias("triple")).join(F.broadcast(self.triples), "triple")
        own = hits.groupBy("row").count().where("count >= 2")
        return sample.join(own, "row", "left_anti").select("words")

    def _vocabulary(self, rows: DataFrame) -> CountVectorizerModel:
        """The n-grams of the examples that hold a word that is not common in the corpus."""
        grams = CountVectorizer(inputCol="grams", outputCol="features", minDF=2.0, vocabSize=1 << 14)
        found = grams.fit(rows.where("NOT sampled")).vocabulary
        own = _table(rows.sparkSession, sorted({(w,) for g in found for w in g.split()}), "word string")
        sampled = rows.where("sampled")
        seen = sampled.select(F.explode(F.array_distinct("words")).alias("word")).join(F.broadcast(own), "word")
        #: In how many sampled lines each word of the vocabulary occurs.
        self.often = {r.word: r["count"] for r in seen.groupBy("word").count().collect()}
        most = max(1, COMMON * sampled.count())
        telling = [g for g in found if any(self.often.get(w, 0) <= most for w in g.split())]
        return CountVectorizerModel.from_vocabulary(telling, inputCol="grams", outputCol="features", binary=True)

    def _by_gram(self, spark: SparkSession, weights: list[tuple]) -> DataFrame:
        """A row per n-gram with its weight by family (w0, w1, ...); bounded by the notices."""
        weighted = _table(spark, weights, "gram string, family string, weight double")
        return weighted.groupBy("gram").agg(
            *[
                F.sum(F.when(F.col("family") == f, F.col("weight")).otherwise(0)).alias(f"w{i}")
                for i, f in enumerate(self.families)
            ]
        )

    def _likeliest(self, rows: DataFrame) -> DataFrame:
        """Each row's likeliest ``family`` and its ``probability``, in place of ``grams``."""
        carried = [c for c in rows.columns if c != "grams"]
        # Outer: for the inner one a filter on the array would be inferred and moved down to
        # the scan, where the words are split again for each n-gram.  The join drops nulls.
        grams = rows.select(*carried, F.explode_outer("grams").alias("gram"))
        sums = [F.sum(f"w{i}").alias(f"w{i}") for i in range(len(self.families))]
        found = grams.join(F.broadcast(self.table), "gram").groupBy(*carried).agg(*sums)
        scores = F.array(
            *[
                F.struct((F.col(f"w{i}") + F.lit(c)).alias("score"), F.lit(f).alias("family"))
                for i, (f, c) in enumerate(zip(self.families, self.constants))
            ]
        )
        found = found.select(*carried, scores.alias("scores")).withColumn("top", F.array_max("scores"))
        known = F.array_max(F.filter("scores", lambda s: s["family"] != UNKNOWN))
        total = F.aggregate("scores", F.lit(0.0), lambda a, s: a + F.exp(s["score"] - F.col("top.score")))
        found = found.select(*carried, known.alias("best"), "top", total.alias("total"))
        probability = F.exp(F.col("best.score") - F.col("top.score")) / F.col("total")
        return found.select(*carried, "best.family", probability.alias("probability"))

    def _telling(self, docs: DataFrame) -> DataFrame:
        """The lines that hold the rarest word of a telling n-gram, as words."""
        rows = lines(docs).where(holds_any(self.anchors))
        return rows.select("row", "doc_id", "digest", "line", words(F.col("value")).alias("words"))

    def spans(self, docs: DataFrame) -> DataFrame:
        """``doc_id, digest, line, span, family, probability, confirmed`` (percent) of all
        runs of words that notices hold.  What is shuffled is one row per triple found."""
        place = F.posexplode_outer(around("words")).alias("pos", "around")
        places = self._telling(docs).select("row", "doc_id", "digest", "line", place)
        hits = places.withColumn("triple", triple()).join(F.broadcast(self.triples), "triple").drop("triple")
        order = Window.partitionBy("row", "line").orderBy("pos")
        # The words before a span end where the span before it does.
        hits = hits.withColumn("gap", F.col("pos") - F.lag("pos").over(order) - LONGEST)
        hits = hits.withColumn("apart", F.coalesce(F.col("gap") >= 0, F.lit(True)).cast("int"))
        hits = hits.withColumn("free", F.least(F.coalesce("gap", F.lit(BEFORE)), F.lit(BEFORE)))
        hits = hits.withColumn("span", F.sum("apart").over(order))
        start = F.slice("around", F.lit(BEFORE + 1) - F.col("free"), F.lit(LONGEST) + F.col("free"))
        found = hits.groupBy("row", "doc_id", "digest", "line", "span").agg(
            (F.max("pos") - F.min("pos") + 1).alias("n"),
            F.min_by(F.when(F.col("apart") == 1, start), "pos").alias("start"),
            F.collect_set(F.slice("around", BEFORE + 1, LONGEST)).alias("triples"),
            F.array(*[F.count_if(F.array_contains("known", f)) for f in FAMILIES]).alias("known"),
        )
        bare = "w -> w NOT IN ('', '^', '$')"
        grams = F.expr(
            f"array_distinct(flatten(transform(concat(array(start), triples), "
            f"t -> transform(array(filter(t, {bare})), b -> {_ngrams_sql('b')})[0])))"
        )
        found = self._likeliest(found.select("row", "doc_id", "digest", "line", "span", "n", "known", grams.alias("grams")))
        own = F.element_at("known", F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")).cast("int"))
        return found.select("doc_id", "digest", "line", "span", "family", "probability", (100 * own / F.col("n")).alias("confirmed"))

    def limit(self, docs: DataFrame, spans: DataFrame) -> float:
        """A family must be likelier than for all but STRAY of the unknown lines.

        These are all telling lines without a span; their probabilities are counted in
        bins, so the limit covers the whole corpus and the driver gets BINS counts.
        """
        held = spans.select("doc_id", "digest", "line").distinct()
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in held.columns]
        rest = self._telling(docs).alias("a").join(held.alias("b"), same, "left_anti")
        rest = self._likeliest(rest.select("row", "line", ngrams("words").alias("grams")))
        place = F.floor(F.col("probability") * BINS).alias("place")
        counts = {r.place: r["count"] for r in rest.groupBy(place).count().collect()}
        left, at = STRAY * sum(counts.values()), BINS
        while at > 0 and counts.get(at, 0) <= left:
            left -= counts.get(at, 0)
            at -= 1
        return max(0.5, min((at + 1) / BINS, 0.95))

    def scan(self, docs: DataFrame) -> DataFrame:
        """``doc_id, digest, line, family, probability, confirmed`` of licensed lines."""
        found = write_and_read(self.spans(docs), "spans")
        limit = self.limit(docs, found)
        kept = found.where((F.col("probability") >= limit) & (F.col("confirmed") >= CONFIRMED))
        best = [F.max(c).alias(c) for c in ("probability", "confirmed")]
        return kept.groupBy("doc_id", "digest", "line", "family").agg(*best)


def scan_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, licences`` (families, comma-joined) and ``n_paragraphs``, per row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = LicenseModel(docs.sparkSession, texts).scan(texts)
    families = found.groupBy("doc_id", "digest").agg(
        F.array_join(F.sort_array(F.collect_set("family")), ",").alias("licences"),
        F.count_distinct("line").alias("n_paragraphs"),
    )
    families = write_and_read(families.withColumnsRenamed({"doc_id": "id", "digest": "found"}), "licences")
    rows = texts.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("found"))
    return rows.join(families, same, "left").select(
        "doc_id",
        F.coalesce("licences", F.lit("")).alias("licences"),
        F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families of every whole text of ``documents``; see the module's text."""
    return scan_documents(read_table(spark, sf_dir, "documents"))
