"""The training-data operators on small tables, against plain Python versions."""

import base64
import gzip
import hashlib
import re
import time
import tracemalloc

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from offerquarry.llm import (
    license_scan,
    minhash_dedup,
    neighbour_graph,
    personal_data,
    quality_rules,
    rule_ensemble,
    sentence_pieces,
    source_mix,
    toxicity,
    web_archives,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string"
WORDS = [f"{a}{b}" for a in "ba de fi go lu ma ne ri so tu".split() for b in "lan mer tik".split()]


def prose(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n))


def edge_rows():
    """Nulls, empty texts, repeated rows, a long text, and a clashing column."""
    base = prose(200, 1)
    near = base.split()
    near[100] = "changed"
    return [
        (1, base, "en", "a", 5, "x"),
        (2, base, "en", "a", None, None),
        (3, " ".join(near), "en", None, 5, "x"),
        (3, " ".join(near), "en", None, 5, "x"),
        (4, prose(200, 2), None, "b", 5, "x"),
        (5, "", "en", "b", 0, "x"),
        (6, None, None, None, None, None),
        (None, prose(50, 3), "de", "b", 5, "x"),
        (7, prose(40_000, 4), "de", "a", 5, "x"),
        (8, "a@b.example +1 (555) 010-9999", "en", "a", 5, "x"),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_near_duplicates(docs, empty):
    found = {r[:2]: r for r in rows(minhash_dedup.near_duplicates(docs, 2))}
    by_id = {r[0]: r for r in found.values() if r[0] is not None}
    assert [by_id[i][2] for i in (1, 2, 3, 4, 5, 6)] == [1, 1, 1, 4, 5, 6]
    assert [by_id[i][3] for i in (1, 2, 3, 4, 5)] == [True, False, False, True, True]
    assert by_id[6][1] == by_id[5][1] == 0
    assert [r for r in found.values() if r[0] is None][0][2:] == (None, True)
    kept = minhash_dedup.keep_one(docs, 2)
    assert kept.columns == docs.columns
    assert sorted(r[0] or 0 for r in rows(kept)) == [0, 1, 4, 5, 6, 7, 8]
    assert rows(minhash_dedup.keep_one(empty)) == []


def test_near_duplicates_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(5)
    texts = []
    for i in range(12):
        base = prose(120, 100 + i).split()
        for edits in (0, 2, 5, 8, 12):
            words = list(base)
            for at in rng.choice(len(words), edits, replace=False):
                words[at] = f"edit{rng.integers(99)}"
            texts.append(" ".join(words))
    sets = [set(zip(t.split(), t.split()[1:])) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if 100 * len(a & b) >= 80 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r[0]: r[2] for r in rows(minhash_dedup.near_duplicates(table, 2))}
    assert [found[i] for i in range(len(texts))] == label


def test_index_keys_and_signatures_are_not_broadcast(spark, monkeypatch):
    plans, store = [], minhash_dedup.write_and_read

    def stored(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return store(df, name)

    monkeypatch.setattr(minhash_dedup, "write_and_read", stored)
    table = spark.createDataFrame([(i, prose(60, i // 2)) for i in range(8)], "doc_id long, text string")
    found = {r[0]: r[2] for r in rows(minhash_dedup.near_duplicates(table, 2))}
    assert found == {i: i // 2 * 2 for i in range(8)}
    of = {name: [plan for n, plan in plans if n == name] for name in ("shared", "pairs", "described")}
    for plan in (*of["shared"], *of["pairs"], of["described"][-1]):
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    a, b = prose(200, 31), prose(200, 32)

    def near(text):
        words = text.split()
        words[100] = "changed"
        return " ".join(words)

    table = [(1, a), (5, near(a)), (5, b), (9, near(b)), (9, near(b)), (7, b), (11, ""), (11, None)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    found = sorted((r.doc_id, r.component_id) for r in minhash_dedup.near_duplicates(docs, 2).collect())
    assert found == [(1, 1), (5, 1), (5, 5), (7, 5), (9, 5), (9, 5), (11, 11), (11, 11)]
    kept = sorted(((r.doc_id, r.text) for r in minhash_dedup.keep_one(docs, 2).collect()), key=str)
    assert kept == sorted([(1, a), (5, b), (11, ""), (11, None)], key=str)


def test_distances_count_differing_places():
    a = minhash_dedup.signature(np.arange(50, dtype=np.uint64) * np.uint64(977))
    b = a.copy()
    b[0] ^= np.uint64(1)
    b[5] ^= np.uint64(3 << 15)
    assert minhash_dedup.distances(a[None], np.stack([a, b])).tolist() == [[0, 2]]
    assert len(set(minhash_dedup.index_keys(a[None])[0])) == 70


def test_quality_limits_do_not_jump_with_the_size_of_a_source(spark):
    """The same document among 198, 199 and 200 siblings, and a source of its own."""
    odd = " ".join(WORDS[i % 30] + "," for i in range(40))
    verdicts = set()
    for siblings in (0, 198, 199, 200):
        rows_ = [(i, prose(40, i), "en", "a", 1, "x") for i in range(siblings)]
        rows_ += [(1000 + i, prose(40, 1000 + i), "en", "b", 1, "x") for i in range(300)]
        found = quality_rules.rate(spark.createDataFrame([*rows_, (9999, odd, "en", "a", 1, "x")], DOCS))
        verdicts.add(found.where("doc_id = 9999").first().kept)
    assert len(verdicts) == 1


def test_equal_rows_share_the_copies_of_their_source(spark):
    """A third of the rows are one document: its source still comes near its target."""
    table = [(1, "w " * 120, "a")] * 300 + [(100 + i, "w " * (50 + i % 90), "ab"[i % 2]) for i in range(600)]
    docs = spark.createDataFrame(table, "doc_id long, text string, source string").repartition(4)
    planned = source_mix.plan(docs)
    assert planned.count() == 900
    sums = planned.groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("w"), F.max("size").alias("m")).collect()
    for r in sums:
        assert abs(r.t - r.w) <= r.m / 2 + 1e-6
    assert all(r.taken <= 2 * r.size for r in planned.collect())
    counts = {r["doc_id"]: r["count"] for r in source_mix.mix(docs).groupBy("doc_id").count().collect()}
    assert counts[1] * 120 == sum(r.taken for r in planned.collect() if r.doc_id == 1)
    again = source_mix.plan(docs)
    assert sorted(rows(again)) == sorted(rows(planned))


def test_wider_matches_are_found_fast_and_as_before():
    rng = np.random.default_rng(12)
    made = ["".join(rng.choice(list("0123456789 -.+()abc@"), 300)) for _ in range(60)]
    made += ["call 0171 555 0199 or a (at) b.example, 4111 1111 1111 1111, 010.001.002.003 " * 30]
    for text in made:
        spans = [(c.start, c.end) for c in personal_data.candidates(text) if not c.base]
        base = [span for kind in personal_data.base_spans(text).values() for span in kind]
        assert all(e <= s2 or e2 <= s for i, (s, e) in enumerate(spans) for s2, e2 in [*spans[:i], *base])
    text = "call 555 555 0199, " * 20_000
    start = time.perf_counter()
    assert len(personal_data.candidates(text)) > 10_000
    assert time.perf_counter() - start < 15


def test_quality_rules(docs, empty):
    found = {r.doc_id: r for r in quality_rules.rate(docs).collect()}
    assert found[5].base_failed and found[6].n_words == 0 and not found[6].kept
    assert found[1].n_words == 200 and found[7].n_words == 40_000
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and {1, 2, 3, 4} <= {r.doc_id for r in kept.collect()}
    assert rows(quality_rules.keep_good(empty)) == []


def test_quality_rules_equal_their_sql(spark, tmp_path):
    import duckdb

    path = "/root/testdata/sf0.001"
    ours = quality_rules.op10_quality_rules(spark, path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    assert sorted(rows(ours)) == sorted(con.execute(quality_rules.ORACLE).fetchall())


def brute_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and personal_data.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(3)
    pieces = list("01259.-@+ ()ab%_") + ["1.2.3.4", "4111111111111111", "a@b.c", "@", "+49 30 1234567"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces, rng.integers(1, 14)))
        spans = personal_data.base_spans(text)
        assert [(k, s, e) for k in personal_data.KINDS for s, e in spans[k]] == brute_spans(text), text


def test_long_texts_are_searched_in_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000):
        personal_data.candidates(text)


def test_personal_data(docs, empty):
    found = {r.doc_id: r for r in personal_data.find_personal_data(docs).collect()}
    assert (found[8].n_email, found[8].n_phone, found[8].spans) == (1, 1, "email:0:11,phone:12:29")
    assert found[6].spans == "" == found[1].spans
    redacted = personal_data.redact(docs)
    assert redacted.columns == docs.columns
    assert {r.doc_id: r.text for r in redacted.collect()}[8] == "[EMAIL] [PHONE]"
    assert rows(personal_data.redact(empty)) == []


def test_licences_inside_prose_and_two_in_a_line(spark):
    prose = " ".join(["we walked along the river and talked about the weather until it was dark"] * 3)
    texts = [
        f"{prose}. Licensed under the Apache License, Version 2.0. {prose}",
        f"{prose}. Released under the MIT License. {prose}",
        "This project is licensed under the MIT License or the Apache License 2.0.",
        f"{prose}. Distributed under the GNU Lesser General Public License, version 3. {prose}",
        f"{prose} and the driver had no license. {prose}",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.licences for r in license_scan.scan_documents(docs).collect()}
    assert found == {0: "Apache-2.0", 1: "MIT", 2: "Apache-2.0,MIT", 3: "LGPL", 4: ""}


def test_licence_bodies_identifiers_and_denials(spark):
    prose = " ".join(["we walked along the river and talked about the weather until it was dark"] * 3)
    mit, bsd = license_scan.BODIES["MIT"], license_scan.BODIES["BSD"]
    wrapped = "\n".join(mit[0][i : i + 70] for i in range(0, len(mit[0]), 70))
    texts = {
        1: ("\n".join(mit), "MIT"),
        2: ("Copyright (c) 2020 Jane Doe\n" + "\n".join(bsd), "BSD"),
        3: ("# SPDX-License-Identifier: MIT", "MIT"),
        4: ("// SPDX-License-Identifier: GPL-2.0-or-later OR Apache-2.0", "Apache-2.0,GPL"),
        5: ("We were not licensed under the MIT License.", ""),
        6: ("Code here is under the MIT License and nothing else.", "MIT"),
        7: (f"{prose} {bsd[0]} {prose}", "BSD"),
        8: (wrapped, "MIT"),
        9: ("under the terms of the agreement, either version may be used", ""),
        10: ("\n".join(license_scan.BODIES["AGPL"]), "AGPL"),
    }
    table = [(i, text) for i, (text, _) in texts.items()] + [(i, prose) for i in range(100, 200)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    found = {r.doc_id: r.licences for r in license_scan.scan_documents(docs).collect()}
    assert {i: found[i] for i in texts} == {i: wanted for i, (_, wanted) in texts.items()}
    assert not any(found[i] for i in range(100, 200))


def test_licences_of_rows_that_share_an_id(spark):
    notice, plain = "Released under the MIT License.", "a walk along the river"
    table = [(None, notice), (None, plain), (7, notice), (7, plain), (7, notice), (8, None)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.licences, r.n_paragraphs) for r in license_scan.scan_documents(docs).collect())
    assert found == [(0, "", 0), (0, "MIT", 1), (7, "", 0), (7, "MIT", 1), (7, "MIT", 1), (8, "", 0)]


def test_repeated_lines_do_not_crowd_out_a_kind(spark):
    texts = ["mail jane@example.org now", "mail jane (at) example.org now", "call +49 30 12345678 now",
             "call (030) 555-1234 now", "order no 030-555-1234", "server 10.0.0.1", "visa 4111 1111 1111 1111"]
    models = []
    for copies in (1_000, 7_000):
        text = F.element_at(F.array(*map(F.lit, texts)), (F.col("id") % len(texts)).cast("int") + 1)
        docs = spark.range(copies * len(texts)).select(F.col("id").alias("doc_id"), text.alias("text"))
        models.append(personal_data.learn(docs))
    assert list(models[0]) == list(models[1]) == personal_data.KINDS
    # One address among 40,000 equal signatures.
    signed = F.when(F.col("id") == 17, texts[5]).otherwise(" ".join([texts[0], texts[2]]))
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), signed.alias("text"))
    assert set(personal_data.learn(docs)) == {"email", "ip", "phone"}


def test_a_kind_the_model_never_saw_is_not_dropped():
    assert [c.kind for c in personal_data.decided("call (030) 555-1234 now", {})] == ["phone"]


def test_labelers_that_agree_are_believed():
    votes = np.array([[1, 1, 0, 1, 1], [0, 0, -1, -1, -1]])
    yes, _ = personal_data.reliabilities(votes, np.array([80.0, 20.0]))
    assert yes[0] > 0.9 and yes[1] < 0.1


def test_mix(docs, empty):
    plan = source_mix.plan(docs).collect()
    assert len(plan) == docs.count()
    total = sum(r.size for r in plan)
    targets = {r.source: r.target for r in plan}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    for r in plan:
        assert 0 <= r.taken <= 2 * r.size and r.target <= 2 * r.source_size
    mixed = source_mix.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in plan)
    assert rows(source_mix.mix(empty)) == [] == rows(source_mix.plan(empty))


def test_mix_comes_near_its_targets(spark):
    table = [(i, prose(int(5 + i % 60), i), "en", f"s{i % 4}", 1, "") for i in range(400)]
    plan = source_mix.plan(spark.createDataFrame(table, DOCS)).collect()
    again = source_mix.plan(spark.createDataFrame(table, DOCS).repartition(5)).collect()
    assert sorted(plan) == sorted(again)
    for source in {r.source for r in plan}:
        mine = [r for r in plan if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 64 / 2


def test_pieces_equal_the_library():

    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    v = sentence_pieces.Vocabulary.load(sentence_pieces.MODEL)
    texts = [prose(300, 9), "", " ", "  a  b\n c ", "ﬁ é 日本 𝒳\t3", " ▁a", "a" * 200, "\x00 \r\n", "un   deux"]
    texts += ["Größe, naïve; l'été 3.14 http://x.example/y?z=1", "word " * 50]
    for text, ids in zip(texts, sentence_pieces.Encoder(v).texts(texts)):
        ids = np.frombuffer(ids, "<i4").tolist()
        assert ids == library.encode(text)
        assert sentence_pieces.decode(ids, v) == text.replace("▁", " ")


def test_unigram_pieces_have_the_best_score():
    pieces = ["<unk>", "▁a", "▁ab", "b", "bc", "c", "▁", "a"]
    scores = [0, -1.0, -2.5, -2.0, -1.2, -2.0, -3.0, -3.0]
    v = sentence_pieces.Vocabulary(pieces, scores, [1, 0, 0, 0, 0, 0, 0, 0], bpe=False)
    found = [np.frombuffer(w, "<i4").tolist() for w in sentence_pieces.encode_words(["▁a", "▁abc", "▁abx"], v)]
    assert [[pieces[i] for i in ids] for ids in found] == [["▁a"], ["▁a", "bc"], ["▁ab", "<unk>"]]


def test_encode_and_decode(docs, empty):
    back = sentence_pieces.decode_ids(sentence_pieces.encode(docs))
    for r in back.collect():
        assert r.decoded_text == r.text and (r.piece_ids is None) == (r.text is None)
    assert rows(sentence_pieces.encode(empty)) == []


def test_long_words_take_memory_in_proportion():
    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    v = sentence_pieces.Vocabulary.load(sentence_pieces.MODEL)
    rng = np.random.default_rng(9)
    letters = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABC0123+/"), 200_000))
    texts = [letters, " " * 100_000, "a" + " " * 4000 + "b", "é中" * 3000 + " " * 9, "=" * 50_000]
    tracemalloc.start()
    found = list(sentence_pieces.Encoder(v).texts(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(text)


def made_vocabulary(rng):
    """BPE pieces drawn at random: some are never reached by merging, some scores are equal."""
    pieces = ["<unk>", *"▁abc"]
    drawn = {"".join(rng.choice(list("abcd"), n)) for n in (2, 2, 2, 2, 3, 3, 3, 4, 5) for _ in range(6)}
    pieces += sorted(drawn | {"▁" + piece for piece in list(drawn)[::3]} | {"▁a", "▁b"})
    scores = [0.0, *(-rng.integers(1, 30, len(pieces) - 1)).astype(float).tolist()]
    return sentence_pieces.Vocabulary(pieces, scores, [1] + [0] * (len(pieces) - 1), bpe=True)


def test_short_words_are_walked_together(monkeypatch):
    """Words of usual length take neither a walk nor a merge of their own."""
    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    v = sentence_pieces.Vocabulary.load(sentence_pieces.MODEL)
    rng = np.random.default_rng(11)
    letters = list("abcdeiounrstABÈéß019.,'-日本\t𝒳")
    words = ["".join(rng.choice(letters, rng.integers(1, 25))) for _ in range(3000)]
    texts = [" ".join(words), "a\x00 a a\x00\x00", "x" * 31, "", "\n", "Größe, l'été 3.14 http://x.y/?z=1"]

    def refuse(*_):
        raise AssertionError("walked or merged by itself")

    v.neighbours  # merges each piece once
    monkeypatch.setattr(sentence_pieces.Walk, "encode", refuse)
    monkeypatch.setattr(sentence_pieces.Vocabulary, "merged", refuse)
    monkeypatch.setattr(sentence_pieces, "TOGETHER", 700)
    for text, ids in zip(texts, sentence_pieces.Encoder(v).texts(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(text)


def test_words_walked_together_equal_single_walks():
    rng = np.random.default_rng(13)
    none = 0
    for _ in range(30):
        v = made_vocabulary(rng)
        words = {rng.choice(["", "▁"]) + "".join(rng.choice(list("abcde"), rng.integers(1, 12))) for _ in range(200)}
        words = sorted(words)
        walk = sentence_pieces.Walk(v)
        alone = [walk.encode(word, 0) for word in words]
        assert v.front.encode(words) == alone == v.front.encode(words)
        assert [found for word in words for found in v.front.encode([word])] == alone
        none += alone.count(None)
    assert none


def test_pairs_asked_together_equal_merging():
    rng = np.random.default_rng(14)
    for v in [*(made_vocabulary(rng) for _ in range(20)), sentence_pieces.Vocabulary.load(sentence_pieces.MODEL)]:
        first, second = rng.choice(sorted(v.ids.values()), (2, 3000))
        alone = list(map(v.follows, first.tolist(), second.tolist()))
        assert 0 < sum(alone) < 3000
        assert v.neighbours.follow(first, second).tolist() == alone


def test_unigram_texts_have_the_best_sum_of_scores(spark):
    """A model made here; every split of short words is tried."""
    rng = np.random.default_rng(10)
    letters = "▁abcd"
    pieces = ["<unk>", *letters]
    pieces += sorted({"".join(rng.choice(list("abcd"), n)) for n in (2, 2, 2, 3, 3, 4) for _ in range(8)})
    pieces += sorted({"▁" + "".join(rng.choice(list("abcd"), n)) for n in (1, 2, 3) for _ in range(5)})
    scores = [0.0, *(-rng.random(len(pieces) - 1) * 9 - 1).tolist()]
    v = sentence_pieces.Vocabulary(pieces, scores, [1] + [0] * (len(pieces) - 1), bpe=False)

    def best(word):
        if not word:
            return 0.0
        ends = (i for i in range(1, len(word) + 1) if word[:i] in pieces)
        return max(scores[pieces.index(word[:i])] + best(word[i:]) for i in ends)

    texts = [" ".join("".join(rng.choice(list("abcd"), rng.integers(1, 9))) for _ in range(6)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shared = spark.sparkContext.broadcast(v)
    for r in docs.withColumn("ids", sentence_pieces.encoded(shared)).collect():
        total = sum(best("▁" + word) for word in r.text.split())
        assert abs(sum(scores[i] for i in r.ids) - total) < 1e-9
        assert sentence_pieces.decode(r.ids, v) == r.text


def test_archives(spark, tmp_path):
    table = [
        (2, "http://a/ x", "<p>é</p>"), (1, "http://b", "<p>é</p>"), (3, None, None), (4, "u", ""),
        (5, "v", "WARC/1.0\r\n\r\n" * 3), (None, "w", "only"), (6, "x", "y" * 300_000),
    ]
    pages = spark.createDataFrame(table, "page_id long, url string, html string")
    arc, warc = str(tmp_path / "arc"), str(tmp_path / "warc")
    web_archives.write_arc(pages, arc)
    web_archives.write_warc(web_archives.convert(spark, arc), warc)
    found = {r.page_id: r for r in web_archives.read_warc(spark, warc).collect()}
    assert len(found) == len(table)
    for page_id, _, html in table:
        data = (html or "").encode()
        r = found[page_id]
        assert r.payload_bytes == len(data)
        assert r.declared == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r.payload_digest in (None, r.declared)
    assert (found[2].record_type, found[2].refers_to) == ("revisit", 1)
    assert (found[4].record_type, found[4].refers_to) == ("revisit", 3)
    assert found[3].url == "urn:none" and found[2].url == "http://a/%20x"
    nothing = str(tmp_path / "none")
    web_archives.write_arc(pages.limit(0), nothing)
    assert rows(web_archives.convert(spark, nothing)) == []


def test_archives_stay_small_and_packed_ones_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(web_archives, "ARCHIVE_BYTES", 20_000)
    pages = spark.createDataFrame([(i, f"http://a/{i}", prose(100, i)) for i in range(300)], "page_id long, url string, html string")
    plain, packed = tmp_path / "arc", tmp_path / "packed"
    web_archives.write_arc(pages, str(plain), compression="none")
    files = [f for f in plain.iterdir() if f.name.startswith("part")]
    assert len(files) > 8 and max(f.stat().st_size for f in files) < 60_000
    packed.mkdir()
    for f in files:  # a member for each half of a file
        data = f.read_bytes()
        cut = data.index(b"\nhttp://", len(data) // 2) + 1
        (packed / f"{f.name}.arc.gz").write_bytes(gzip.compress(data[:cut]) + gzip.compress(data[cut:]))
    one, other = (web_archives.convert(spark, str(p)).drop("ip") for p in (plain, packed))
    assert one.count() == 300 and one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_broken_archives_are_named():
    with pytest.raises(web_archives.BrokenArchive, match="f.arc"):
        list(web_archives.arc_records(b"http://a 0 20200101000000 text/html 99\nshort", "f.arc"))


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(1500, 16))
    table = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table += [(9001, vectors[3].tolist()), (9002, vectors[3].tolist()), (9003, None), (9004, [0.0] * 16)]
    table += [(9005, [float("nan")] * 16), (9006, [None] * 16), (None, vectors[4].tolist()), (3, vectors[3].tolist())]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    usable = neighbour_graph.usable(df, "vec_id", "embedding")
    queries = usable.where("id % 50 = 0 OR id = 3")
    found = {}
    for r in neighbour_graph.nearest(neighbour_graph.index(usable), queries).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        order = [i for i in np.argsort(-(unit @ unit[q])) if i != q][:5]
        hits += len(set(order) & {v for _, v, _ in found[q]})
    assert hits >= 0.9 * 5 * 30
    assert [v for _, v, _ in sorted(found[3])][:2] == [9001, 9002]
    assert rows(neighbour_graph.nearest(neighbour_graph.index(usable.limit(0)), queries.limit(0))) == []


def test_all_finite_vectors_take_part(spark):
    huge, tiny = [1e200, 1.0, 1e200], [1e-170, 0.0, 1e-170]
    table = [(50, [1.0, 0.0, 1.0]), (1, huge), (2, tiny), (3, [0.0, 1.0, 0.0]), (4, [0.0, 0.0, 0.0])]
    df = neighbour_graph.usable(spark.createDataFrame(table, "v long, e array<double>"), "v", "e")
    found = neighbour_graph.nearest(neighbour_graph.index(df), df.where("id = 50")).orderBy("rank").collect()
    assert sorted(r.vec_id for r in found[:2]) == [1, 2] and [r.vec_id for r in found] == [r.vec_id for r in found[:2]] + [3]
    assert all(abs(r.score - 1) < 1e-12 for r in found[:2]) and abs(found[2].score) < 1e-12


def test_each_graph_has_a_task_of_its_own(spark):
    rng = np.random.default_rng(6)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(9000, 4)))], "v long, e array<double>")
    graphs = neighbour_graph.index(neighbour_graph.usable(table, "v", "e"))
    assert graphs.count() > 2
    assert len(set(graphs.select(F.input_file_name()).toPandas().iloc[:, 0])) == graphs.count()


def test_toxicity_learns_its_words(spark, empty):
    bad = ["grobian", "unhold"]
    table, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = prose(40, i) + (f" {bad[i % 8 // 4]}" if toxic else "")
        table.append((i, text))
        labels.append((i, int(toxic)))
    table += [(1000, None), (1001, "")]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    known = spark.createDataFrame(labels[:300] + [(None, 1), (5000, None)], "doc_id long, label int")
    model = toxicity.learn(docs, known)
    scored = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score_column(model).alias("s")).collect()}
    for i, label in labels[300:]:
        assert (scored[i] >= 0.5) == bool(label)
    assert 0 <= scored[1000] == scored[1001] <= 1
    blank = toxicity.learn(docs, known.limit(0))
    assert docs.select(toxicity.score_column(blank).alias("s")).distinct().collect()[0].s == 0.5


def test_rule_ensemble(spark):
    table = [(i, prose(60, i) if i % 3 else " ".join(w + "###" for w in prose(60, i).split())) for i in range(200)]
    table += [(1000, None), (None, "x")]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)] + [(7, None)], "doc_id long, label int")
    held_out = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    scored = rule_ensemble.learn_and_score(docs, labels, held_out).collect()
    assert len(scored) == len(table)
    for r in scored:
        if r.doc_id is not None and r.doc_id < 200:
            assert (r.score >= 0.5) == (r.doc_id % 3 > 0)
    nothing = rule_ensemble.learn_and_score(docs, labels.limit(0), held_out).collect()
    assert {r.score for r in nothing} == {0.5}


def test_license_scan(spark, empty):
    table = [(i, "\n".join(prose(12, 50 * i + j) for j in range(6))) for i in range(60)]
    table += [
        (100, prose(20, 1) + "\nReleased under the MIT License.\n" + prose(9, 2)),
        (101, "This work is licensed under the GNU General Public License, version 3."),
        (102, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."),
        (103, None), (104, ""), (None, prose(10, 3)),
    ]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    found = {r.doc_id: r.licences for r in license_scan.scan_documents(docs).collect()}
    assert {i: v for i, v in found.items() if v} == {100: "MIT", 101: "GPL", 102: "Apache-2.0,MIT"}
    assert rows(license_scan.scan_documents(empty)) == []


def test_pipeline_stages(spark, docs, empty):
    for table in (docs, empty):
        current = table.drop("kept")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before, current = current, stage(spark, current, "")
            assert current.columns == before.columns, name
            current = spark.createDataFrame(current.collect(), before.schema)
        last = corpus_pipeline.STAGES[-1][1](spark, current, "").collect()
        assert {r.doc_id for r in last} <= {1, 4, 7, None}
