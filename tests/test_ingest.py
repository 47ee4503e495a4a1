import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.operators import cleaning, quality
from custlens.sources import delimited, headers


def test_typed_read_of_a_file_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_bytes("﻿order_id;quantity;price;order_date\nO1;2;;01/05/2025\nO2;x;3.5;5/5/2025\n".encode())
    schema = T.StructType.fromDDL("order_id string, quantity int, price double, order_date date")
    rows = [tuple(r) for r in delimited.read_delimited(spark, str(path), schema).collect()]
    assert rows == [("O1", 2, None, dt.date(2025, 5, 1)), ("O2", None, 3.5, dt.date(2025, 5, 5))]


def test_other_header_order_is_refused(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("quantity;order_id\n2;O1\n")
    schema = T.StructType.fromDDL("order_id string, quantity int")
    with pytest.raises(Exception):
        delimited.read_delimited(spark, str(path), schema).collect()


def test_raw_read_skips_and_counts_long_lines(spark, tmp_path, rows):
    path = tmp_path / "raw.csv"
    path.write_text('a;b;c\n1;2;3\n4;5\n6;7;8;9\n10;11;12;\n"x;y";;z\n13;14;\n')
    raw = delimited.read_raw(spark, str(path), ["a", "b", "c"])
    assert delimited.count_malformed(raw).first().asDict() == {"good_lines": 4, "malformed_lines": 2}
    assert rows(delimited.bad_lines(raw)) == [("10;11;12;",), ("6;7;8;9",)]
    good = delimited.good_lines(raw).select(F.coalesce("a", F.lit("-")), F.coalesce("b", F.lit("-")), F.coalesce("c", F.lit("-")))
    assert rows(good) == [("1", "2", "3"), ("13", "14", "-"), ("4", "5", "-"), ("x;y", "-", "z")]


def test_file_profiles(spark, tmp_path, rows):
    (tmp_path / "one.csv").write_bytes("a;b;c,d\n1;2;3\n".encode())
    (tmp_path / "two.csv").write_bytes("nom,ville\nRené,Orléans\n".encode("latin-1"))
    (tmp_path / "three.csv").write_bytes("nom\tâge\nZoé\t3\n".encode())
    (tmp_path / "tie.csv").write_bytes(b"a;b,c\n")
    (tmp_path / "late.csv").write_bytes(b"plain\n" + b"x;y;z\n" * 5)
    found = delimited.profile_files(spark, str(tmp_path)).withColumn("file", F.regexp_extract("file_path", "([a-z]+).csv$", 1))
    assert rows(found, "file", "separator", "encoding", "line_count") == [
        ("late", ",", "UTF-8", 6),
        ("one", ";", "UTF-8", 2),
        ("three", "\t", "UTF-8", 2),
        ("tie", ",", "UTF-8", 1),
        ("two", ",", "ISO-8859-1", 2),
    ]
    schema = T.StructType.fromDDL("nom string, ville string")
    latin = delimited.read_delimited(spark, str(tmp_path / "two.csv"), schema, sep=",", encoding="ISO-8859-1")
    assert rows(latin) == [("René", "Orléans")]


def test_headers():
    found = headers.resolve_headers(["montant", "qte", "date_commande"], ["amount", "quantity", "order_date", "customer_id"])
    assert found == {"amount": "montant", "quantity": "qte", "order_date": "date_commande"}
    assert headers.resolve_headers(["total", "amount"], ["amount"]) == {"amount": "amount"}
    assert headers.resolve_headers(["my_price_eur"], ["price"]) == {"price": "my_price_eur"}
    assert headers.resolve_headers(["qty", "quantite"], ["quantity"]) == {"quantity": "quantite"}


def test_canonical_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Montant ` int, ` Qte` int, `Other Thing` int")
    assert headers.canonicalise_columns(df, ["amount", "quantity"]).columns == ["amount", "quantity", "other_thing"]
    one = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError):
        headers.canonicalise_columns(one, ["order_id", "customer_id"])
    assert headers.canonicalise_columns(one, ["order_id", "customer_id"], on_conflict="last").columns == ["customer_id"]


def test_dates(spark):
    df = spark.createDataFrame([("5/5/2025", "2025-05-01", "x"), ("31/02/2025", "01/05/2025", "y")], "a string, b string, c string")
    first, second = quality.coerce_dates(df, ["a", "b", "c", "absent"]).collect()
    assert (first.a, second.a) == (dt.date(2025, 5, 5), None)
    assert (first.b, second.b) == (None, dt.date(2025, 5, 1))  # one format per column
    assert (first.c, second.c) == (None, None)
    mixed = quality.coerce_dates(df, ["b"], per_row=True).collect()
    assert [r.b for r in mixed] == [dt.date(2025, 5, 1), dt.date(2025, 5, 1)]


@pytest.mark.parametrize(
    "text, number",
    [("12,5", 12.5), ("", None), ("nan", None), ("x", None), (" 7 ", 7.0), ("1e3", 1000.0), ("12d", None), ("-.5", -0.5), ("1,2,3", None)],
)
def test_numbers(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert quality.coerce_numeric(df, ["v"]).first().v == number


def test_required_columns(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "order_id int, price double")
    found = {r.column_name: (r.is_present, r.null_count, r.null_pct) for r in quality.validate_required(df, ["order_id", "price", "amount"]).collect()}
    assert found == {"order_id": (True, 0, 0.0), "price": (True, 1, 50.0), "amount": (False, None, None)}
    assert rows(quality.drop_incomplete(df, ["price"])) == [(2, 3.0)]
    assert quality.incomplete_report(df, ["price"]).first().asDict() == {"removed_rows": 1, "remaining_rows": 1}
    assert rows(quality.blocked_analyses(df, ["amount", "price"]), "column_name") == [("amount",)]
    unpriced = df.withColumn("price", F.lit(None).cast("double"))
    assert rows(quality.blocked_analyses(unpriced, ["amount", "price"], empty_too=True), "column_name") == [("amount",), ("price",)]
    assert rows(quality.blocked_analyses(df, ["amount", "price"], empty_too=True), "column_name") == [("amount",)]
    assert quality.missing_tables({"orders": df}, ["orders", "customers"]) == ["customers"]
    with pytest.raises(ValueError):
        quality.drop_incomplete(df, ["nothing"])


def test_partitioned_table(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, dt.date(2025, 1, 31)), (2, dt.date(2025, 2, 1))], "id int, order_date date")
    path = delimited.write_table(df, str(tmp_path / "t"), month_of="order_date")
    assert sorted(p.name for p in (tmp_path / "t").glob("order_month=*")) == ["order_month=2025-01", "order_month=2025-02"]
    assert rows(spark.read.parquet(path), "id", "order_date") == rows(df)


def test_cleaning(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 10.0), (3, 20.0), (3, 20.0), (4, 120.0)], "id int, age double")
    assert rows(cleaning.fill_median(cleaning.dedup_rows(df), "age")) == [(1, 20.0), (2, 10.0), (3, 20.0), (4, 120.0)]
    assert rows(cleaning.filter_range(df, "age", 15, 100)) == [(3, 20.0), (3, 20.0)]
    coded = cleaning.encode_categories(spark.createDataFrame([("b",), (None,), ("z",), ("ba",)], "c string"), ["c"])
    assert rows(coded) == [(0,), (1,), (2,), (3,)]


def test_calendar_windows(spark, rows):
    days = [dt.date(2025, 2, 28), dt.date(2025, 3, 1), dt.date(2025, 5, 31), dt.date(2025, 6, 1), dt.date(2025, 6, 30)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert rows(cleaning.period_filter(df, "d", "2025-05-31", months_back=3)) == [(d,) for d in days[:3]]
    assert rows(cleaning.period_filter(df, "d", "2025-05-31", months_ahead=1)) == [(d,) for d in days[3:]]
    assert rows(cleaning.range_select(df, "d", "1m")) == [(d,) for d in days[2:]]
    assert cleaning.range_select(df, "d", "YTD").count() == 5 and cleaning.range_select(df, "d", "all").count() == 5
    with pytest.raises(ValueError):
        cleaning.range_select(df, "d", "2w")


def test_raw_read_takes_names_from_the_header(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("b;a\n1;2\n")
    raw = delimited.good_lines(delimited.read_raw(spark, str(tmp_path / "a.csv")))
    assert raw.columns == ["b", "a"] and rows(raw) == [("1", "2")]
    with pytest.raises(Exception):
        delimited.read_raw(spark, str(tmp_path / "a.csv"), ["a", "b"]).collect()
    with pytest.raises(ValueError):
        delimited.read_raw(spark, str(tmp_path / "a.csv"), header=False)
    (tmp_path / "c.csv").write_text("a;b\n1;2\n")
    with pytest.raises(ValueError, match="no common header"):
        delimited.read_raw(spark, str(tmp_path))


def test_quoted_line_breaks(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('a;b\n1;"x\ny ""z"""\n2;w\n3;v;u\n')
    raw = delimited.read_raw(spark, str(tmp_path / "a.csv"), multi_line=True)
    assert rows(delimited.good_lines(raw)) == [("1", 'x\ny "z"'), ("2", "w")]
    assert delimited.count_malformed(raw).first().asDict() == {"good_lines": 2, "malformed_lines": 1}


def test_files_of_all_kinds_become_one_table(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_bytes("﻿client;Num Commande;Qte;date\nc1;o1;2,5;01/05/2025\nc2;o2;x;2025-05-02\nc3;o3;1;1/1/2025;9\n".encode())
    (tmp_path / "b.csv").write_bytes('order_id,Quantité,date_commande,qty,customer_id\no4,"é\nè",3-5-2025,4,c4\no5,,,1,c5\n'.encode("latin-1"))
    (tmp_path / "c.csv").write_bytes(b"order_id\tcustomer\n" + b"o6\tc6\n")
    expected = ["order_id", "customer_id", "order_date", "quantity"]
    options = {"dates": ["order_date"], "numbers": ["quantity"], "required": ["order_id", "order_date"], "multi_line": True}
    table, broken = delimited.load_files(spark, str(tmp_path), expected, **options)
    day = lambda d: dt.date(2025, 5, d)
    found = sorted((tuple(r) for r in table.select(expected).collect()), key=str)
    assert found == [
        ("o1", "c1", day(1), 2.5), ("o2", "c2", day(2), None), ("o4", "c4", day(3), 4.0), ("o5", "c5", None, 1.0), ("o6", "c6", None, None)
    ]
    assert [(r.file_path[-5:], r.malformed_line) for r in broken.collect()] == [("a.csv", "c3;o3;1;1/1/2025;9")]
    assert delimited.load_files(spark, str(tmp_path), expected, drop_missing=True, **options)[0].count() == 3
    with pytest.raises(ValueError, match="price"):
        delimited.load_files(spark, str(tmp_path), expected, required=["price"])
