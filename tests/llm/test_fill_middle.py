"""Fill-in-the-middle against plain slices of the text."""

import hashlib
import re

import numpy as np
import pytest

from offerquarry.llm import fill_middle

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text, seed=1):
    text = text or ""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = UNITS.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = np.random.default_rng(8)
    letters = list("abcXYZ 0<>PSM\n\u00e9\u4e2d\U0001f600")
    made = ["".join(rng.choice(letters, rng.integers(0, 400))) for _ in range(200)]
    return [
        *made, None, "", "a<P>b", "\u00e9" * 5000, "x" * 300, "a" * 70_000 + " b", "<" * 50 + "P", "ab " * 40_000,
        "\U0001f600" * 40_000, "q" * 200_000,
    ]


@pytest.mark.parametrize("frame", [7, 64, 1 << 16])
def test_cuts_equal_plain_slices(monkeypatch, frame):
    monkeypatch.setattr(fill_middle, "FRAME", frame)
    for doc_id, text in enumerate(texts()[: 203 if frame == 7 else None]):
        store = fill_middle.Frames.of((text or "").encode())
        done = fill_middle.filled(store, doc_id)
        output = b"".join(done.output.slice(0, done.output.bytes)).decode()
        assert (done.units, done.form, done.prefix_chars, done.middle_chars, output) == plain(doc_id, text)
        assert b"".join(fill_middle.restored(done.output, done.form)).decode() == (text or "")


def test_a_cut_opens_one_frame(monkeypatch):
    store = fill_middle.Frames.of(b"word and more " * 100_000)
    assert len(store.frames) > 20
    read, opened = store.read, []
    monkeypatch.setattr(store, "read", lambda number: (opened.append(number), read(number))[1])
    assert store.cut(300_007)[0] == len("".join(UNITS.findall("word and more " * 100_000)[:300_007]))
    assert len(opened) == 1


def test_query_rows(spark):
    rows = [*enumerate(texts()), (None, "no id here"), (3, "same id, other text")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, fim_form string, n string")
    found = fill_middle.fill_in_middle(docs)
    assert found.columns == ["doc_id", "text", "fim_form", "n", "fim_units"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    expected = sorted(((i, plain(i, t)[4], plain(i, t)[1]) for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.text, r.fim_form) for r in found.collect()), key=key) == expected
    assert fill_middle.fill_in_middle(docs.where("false")).collect() == []
