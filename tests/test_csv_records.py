"""CSV records over splits, encodings and headers, against Python's csv module."""

import csv
import io

import numpy as np
import pyarrow as pa
import pytest

from offerquarry.operators.headers import MissingField
from offerquarry.sources import csv_records, listing_files


def random_table(seed, n):
    """Rows whose cells hold line breaks, quotes, commas and returns."""
    rng = np.random.default_rng(seed)
    letters = list('ab ,"\n\r;üé€') + ["\n\n", '""', "x" * 30]
    return [["".join(rng.choice(letters, rng.integers(1, 8))) for _ in range(3)] for _ in range(n)]


def written(header, rows, line_end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=line_end)
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def cells(rows):
    """As they are read: no cell is empty text; a return before a record's end goes."""
    return sorted(tuple(v or None for v in row) for row in rows)


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
@pytest.mark.usefixtures("small_splits")
def test_records_across_splits(spark, tmp_path, line_end, monkeypatch):
    tables = [random_table(seed, 300) for seed in (1, 2)]
    for i, table in enumerate(tables):
        text = written(["a", "b", "c"], table, line_end)
        (tmp_path / f"{i}.csv").write_bytes(text.encode("utf-8"))
    path = str(tmp_path)
    found = listing_files.read_raw_csv(spark, path, keep_order=True)
    assert found.rdd.getNumPartitions() > 10
    rows = found.orderBy(*listing_files.FILE_ORDER).collect()
    expected = [[v or None for v in row] for table in tables for row in table]
    assert [list(r[:3]) for r in rows] == expected
    monkeypatch.setattr(csv_records, "MOST_SENT", 0)
    assert cells(r[:3] for r in listing_files.read_raw_csv(spark, path).collect()) == cells(expected)


@pytest.mark.usefixtures("small_splits")
def test_splits_know_the_lines_before_them(spark, tmp_path):
    text = written(["a", "b", "c"], random_table(3, 200))
    (tmp_path / "a.csv").write_text(text)
    states = csv_records.split_states(spark, str(tmp_path)).orderBy("block").collect()
    assert len(states) > 5 and {s.header for s in states} == {"a,b,c"}
    odd = [line.count('"') % 2 for line in text.split("\n")]
    assert sum(s.odd for s in states) == sum(odd)
    assert [s.before for s in states] == np.cumsum([0, *[s.odd for s in states[:-1]]]).tolist()


def test_encoding_is_that_of_the_whole_file(spark, tmp_path):
    rows = [["x", "1", "a"]] * 40 + [["Österreich", "2", "ü"]]
    (tmp_path / "a.csv").write_bytes(written(["n", "p", "q"], rows).encode("latin-1"))
    (tmp_path / "b.csv").write_bytes(b"\xef\xbb\xbf" + written(["n", "p", "q"], rows).encode())
    found = listing_files.read_raw_csv(spark, str(tmp_path)).collect()
    assert cells(found) == cells(rows * 2)
    named = listing_files.read_raw_csv(spark, str(tmp_path / "a.csv"), encoding="ISO-8859-1")
    assert cells(named.collect()) == cells(rows)


def test_files_with_different_headers(spark, tmp_path):
    (tmp_path / "1.csv").write_text(" Title ,PREIS,link,Farbe\nA,1,https://a,rot\n")
    (tmp_path / "2.csv").write_text('Preis,"Titel",Herkunft,Farbe\n2,B,"Ch,\nna",\n\n')
    (tmp_path / "3.csv").write_text("price,farbe,LINK,link\n3,blau,https://b,https://c\n")
    (tmp_path / "4.csv").write_text("Preis,titel\n")
    found = listing_files.read_listing_files(spark, str(tmp_path))
    assert found.columns == ["titel", "aktualitaet", "preis", "land", "versand", "link", "Farbe", "link_2"]
    by_price = {r.preis: tuple(r) for r in found.collect()}
    assert len(by_price) == 3
    assert by_price["1"] == ("A", None, "1", None, None, "https://a", "rot", None)
    assert by_price["2"] == ("B", None, "2", "Ch,\nna", None, None, None, None)
    assert by_price["3"][5:] == ("https://b", "blau", "https://c")
    (tmp_path / "5.csv").write_text("name\nx\n")
    with pytest.raises(MissingField, match="name"):
        listing_files.read_listing_files(spark, str(tmp_path))


def test_types(spark):
    rows = [
        ("1", "1", "1.5", "True", "x", None, "1", " 12 "),
        ("-7", None, "NA", "False", "1", "NA", "True", "1e3"),
    ]
    table = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string, `h.i` string")
    found = [(r.column, r.type, r.missing) for r in listing_files.inferred_types(table).orderBy("place").collect()]
    assert found == [
        ("a", "bigint", False), ("b", "double", True), ("c", "double", True), ("d", "boolean", False),
        ("e", "string", False), ("f", "void", True), ("g", "string", False), ("h.i", "double", False),
    ]
    cast = listing_files.cast_inferred(table)
    assert [kind for _, kind in cast.dtypes] == ["bigint", "double", "double", "boolean", "string", "string", "string", "double"]
    assert [tuple(r) for r in cast.collect()][1] == (-7, None, None, False, "1", "NA", "True", 1000.0)
    empty = listing_files.inferred_types(table.limit(0)).collect()
    assert {r.type for r in empty} == {"void"}


def test_lines_go_through_python_without_what_their_split_shares(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n"x\ny",1\nz,2\n')
    raw = listing_files.read_raw_csv(spark, str(tmp_path))
    assert sorted(map(tuple, raw.collect())) == [("x\ny", "1"), ("z", "2")]
    plan = raw._jdf.queryExecution().optimizedPlan().toString().splitlines()
    helper = next(line for line in plan if "MapInArrow" in line)
    assert "split#" in helper and not any(f"{name}#" in helper for name in ("path", "header", "utf8"))


@pytest.mark.parametrize("size", [1, 2, 3, 50])
def test_records_do_not_depend_on_batches(size):
    # Splits: a file's first, with a record that stays open; its second; and another file's.
    first = ["h", "a", '"b', "", 'c"', '""', '"d', 'e""']
    second = ["f", 'g"', "k", '"l', 'm"', "n"]
    lines = [(1, 0, 0, x) for x in first] + [(2, 90, 3, x) for x in second] + [(3, 0, 0, "h"), (3, 0, 0, "z")]
    rows = [
        {"split": s, "block": b, "before": n, "odd": x.count('"') % 2, "row": i, "line": x.encode()}
        for i, (s, b, n, x) in enumerate(lines)
    ]

    def made(torn):
        batches = [pa.RecordBatch.from_pylist(rows[i : i + size]) for i in range(0, len(rows), size)]
        found = [r for b in csv_records._join_lines(iter(batches), torn) for r in b.to_pylist()]
        return [(r["split"], r["row"], r["record"], r["line"].decode()) for r in found]

    whole = [(1, 1, 0, "a"), (1, 2, 0, '"b\n\nc"'), (1, 5, 1, '""')]
    whole += [(2, 10, 2, "k"), (2, 11, 2, '"l\nm"'), (2, 13, 3, "n"), (3, 15, 0, "z")]
    assert made(torn=False) == whole
    assert made(torn=True) == [(1, 6, 1, '"d'), (1, 7, 1, 'e""'), (2, 8, 1, "f"), (2, 9, 1, 'g"')]


def test_only_texts_that_begin_like_numbers_are_tried_as_such(spark):
    kinds = {
        "whole": ["1", " -2", "+3"], "double": [".5", "1e3", "-Inf"], "infinity": ["infinity", "+iNf", "2."],
        "text": [" ", "1", "2"], "word": ["in", "1", "2"], "flag": ["True", "false", "TRUE"], "void": [None, "NA", "n/a"],
        "sign": ["+", "1", "-"], "gaps": ["1", None, "2"],
    }
    raw = spark.createDataFrame(list(zip(*kinds.values())), ", ".join(f"`{k}` string" for k in kinds))
    types = listing_files.inferred_types(raw)
    found = {r.column: r.type for r in types.collect()}
    assert found == {
        "whole": "bigint", "double": "double", "infinity": "double", "text": "string", "word": "string",
        "flag": "boolean", "void": "void", "sign": "string", "gaps": "double",
    }
    plan = types._jdf.queryExecution().optimizedPlan().toString()
    tested = plan[: plan.index("RLIKE")]
    assert "left(" in tested or "substring(" in tested
