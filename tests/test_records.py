"""Records with line breaks inside quotes, files of many dialects and encodings, read in blocks."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.sources import delimited


@pytest.fixture
def small_blocks(spark):
    """Files are split every 300 bytes or so."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_of(seed, n=300):
    draw = random.Random(seed)
    notes = ["plain", "two\nlines", 'a "quoted" word', "x" * 700 + "\n" + "y" * 700, "\n\n", ";", "é\nà", '"', "many\n" * 200]
    return [(str(i), draw.choice(notes), str(draw.randrange(100))) for i in range(n)]


def written(rows, sep=";"):
    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator="\n").writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("encoding, codec", [("UTF-8", "utf-8"), ("ISO-8859-1", "latin-1"), ("UTF-16LE", "utf-16-le"), ("UTF-16BE", "utf-16-be")])
def test_records_over_many_blocks(spark, tmp_path, small_blocks, encoding, codec):
    want = []
    for k in range(3):
        rows = rows_of(k, 100 if k else 300)
        want += rows
        text = ("﻿" if codec.startswith("utf") else "") + written([("id", "note", "n"), *rows])
        (tmp_path / f"{k}.csv").write_bytes(text.encode(codec))
    raw = delimited.read_raw(spark, str(tmp_path), ["id", "note", "n"], encoding=encoding, multi_line=True)
    pieces = delimited._pieces(spark, str(tmp_path), encoding)
    assert pieces.select("file_path", "block").distinct().count() > 100  # blocks that separate tasks read
    assert raw.filter("malformed_line IS NOT NULL").count() == 0
    assert sorted(tuple(r) for r in raw.select("id", "note", "n").collect()) == sorted(want)


def test_bad_lines_and_headers_of_split_files(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text('id;note\r\n1;"x\r\ny"\r\n2;a;b\r\n\r\n3\r\n4;"u;v";"w\nw";z\r\n')
    raw = delimited.read_raw(spark, str(tmp_path), ["id", "note"], multi_line=True)
    assert delimited.count_malformed(raw).first().asDict() == {"good_lines": 2, "malformed_lines": 2}
    assert sorted((r.id, r.note) for r in delimited.good_lines(raw).collect()) == [("1", "x\ny"), ("3", None)] or sorted(
        (r.id, r.note) for r in delimited.good_lines(raw).collect()
    ) == [("1", "x\r\ny"), ("3", None)]
    assert sorted(r.malformed_line for r in delimited.bad_lines(raw).collect()) == ["2;a;b", '4;"u;v";"w\nw";z']
    with pytest.raises(Exception, match="header does not match"):
        delimited.read_raw(spark, str(tmp_path), ["note", "id"], multi_line=True).collect()


def test_typed_read_of_split_files(spark, tmp_path, small_blocks):
    rows = rows_of(5)
    (tmp_path / "a.csv").write_text(written([("id", "note", "n"), *rows]))
    schema = T.StructType.fromDDL("id int, note string, n double")
    got = delimited.read_delimited(spark, str(tmp_path), schema, multi_line=True)
    assert sorted(tuple(r) for r in got.collect()) == sorted((int(a), b, float(c)) for a, b, c in rows)


def test_line_breaks_that_are_halves_of_letters(spark, tmp_path, small_blocks):
    letters = ["ਅĀ", "਀", "\u000aਊਊ", "Ā਀Ā", "ab"]
    draw = random.Random(1)
    rows = [(str(i), "".join(draw.choice(letters) for _ in range(draw.randrange(1, 40)))) for i in range(200)]
    for encoding, codec in (("UTF-16LE", "utf-16-le"), ("UTF-16BE", "utf-16-be")):
        folder = tmp_path / encoding
        folder.mkdir()
        (folder / "a.csv").write_bytes(("﻿" + written([("id", "note"), *rows])).encode(codec))
        raw = delimited.read_raw(spark, str(folder), ["id", "note"], encoding=encoding, multi_line=True)
        assert sorted(tuple(r) for r in raw.select("id", "note").collect()) == sorted(rows)


def test_profiles_by_byte_order_marks(spark, tmp_path, rows):
    text = "nom;ville;é\nRené;Orléans;1\n"
    for name, data in {
        "marked": b"\xef\xbb\xbf" + text.encode(), "little": b"\xff\xfe" + text.encode("utf-16-le"), "big": b"\xfe\xff" + text.encode("utf-16-be"),
        "latin": text.encode("latin-1"), "plain": text.encode(),
    }.items():
        (tmp_path / f"{name}.csv").write_bytes(data)
    found = delimited.profile_files(spark, str(tmp_path), with_header=True).withColumn("file", F.regexp_extract("file_path", "([a-z]+).csv$", 1))
    assert rows(found, "file", "separator", "encoding", "line_count", "header") == [
        ("big", ";", "UTF-16BE", 2, "nom;ville;é"),
        ("latin", ";", "ISO-8859-1", 2, "nom;ville;é"),
        ("little", ";", "UTF-16LE", 2, "nom;ville;é"),
        ("marked", ";", "UTF-8", 2, "nom;ville;é"),
        ("plain", ";", "UTF-8", 2, "nom;ville;é"),
    ]
    table, broken = delimited.load_files(spark, str(tmp_path), ["name"], aliases={"name": ["nom"]})
    assert rows(table, "name", "ville", "é") == [("René", "Orléans", "1")] * 5 and broken.count() == 0


def test_the_plan_does_not_grow_with_the_files(spark, tmp_path):
    def load(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            sep = ";,\t"[i % 3]
            names = [["order_id", "qty"], ["Qte", "Id Commande", f"extra {i % 4}"]][i % 2]
            values = {"order_id": f"o{i}", "Id Commande": f"o{i}", "qty": "2", "Qte": "2"}
            (folder / f"{i}.csv").write_text(sep.join(names) + "\n" + sep.join(values.get(c, "z") for c in names) + "\n")
        return delimited.load_files(spark, str(folder), ["order_id", "quantity"], numbers=["quantity"], aliases={"order_id": ["id_commande"], "quantity": ["qty", "qte"]})[0]

    few, many = load(24), load(240)
    size = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert size(few) == size(many)
    assert many.columns == few.columns
    assert sorted((r.order_id, r.quantity) for r in many.collect()) == sorted((f"o{i}", 2.0) for i in range(240))


def test_no_file_names_a_required_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2\n")
    with pytest.raises(ValueError, match="lacks columns"):
        delimited.load_files(spark, str(tmp_path), ["order_id"], required=["order_id"])
