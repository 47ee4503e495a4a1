"""Streams, bucketed tables, monthly upserts, sketches and stored models."""

import datetime as dt
import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from custlens.operators import churn, sketches, stored
from custlens.operators.rfm import customer_aggregate
from custlens.session import scratch_path
from custlens.sources import tables
from custlens.streaming import daily

EVENTS = "ts timestamp, event_type string, value double"


def events(spark, rows):
    return spark.createDataFrame([(dt.datetime(2025, 1, day, hour), kind, float(v)) for day, hour, kind, v in rows], EVENTS)


def test_a_stream_closes_days_and_reads_open_ones_from_the_events(spark, tmp_path, rows):
    inbox, closed, checkpoint = (str(tmp_path / n) for n in ("in", "closed", "checkpoint"))
    schema = events(spark, []).schema

    def deliver(*some):
        events(spark, some).coalesce(1).write.mode("append").parquet(inbox)
        return daily.update_closed_days(spark, inbox, schema, closed, checkpoint, delay="1 day")

    def days():
        return rows(daily.daily_table(spark, inbox, schema, closed), F.dayofmonth("date"), "impressions", "clicks", "spend")

    deliver((1, 5, "view", 2), (1, 7, "click", 3), (2, 1, "view", 1))
    assert days() == [(1, 1, 1, 5.0), (2, 1, 0, 1.0)]
    assert spark.read.schema("date date").parquet(closed).count() == 0  # nothing can be closed yet
    deliver((5, 3, "view", 1), (1, 9, "view", 10))  # the second one is late, but not too late
    assert days() == [(1, 2, 1, 15.0), (2, 1, 0, 1.0), (5, 1, 0, 1.0)]
    deliver((6, 1, "click", 4))
    assert rows(spark.read.schema("date date").parquet(closed), F.dayofmonth("date")) == [(1,), (2,)]
    query = deliver((1, 23, "view", 100), (7, 0, "view", 1))  # the first day is closed
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 1
    assert days() == [(1, 2, 1, 15.0), (2, 1, 0, 1.0), (5, 1, 0, 1.0), (6, 0, 1, 4.0), (7, 1, 0, 1.0)]
    before = days()
    daily.update_closed_days(spark, inbox, schema, closed, checkpoint, delay="1 day")  # nothing new
    assert days() == before


def test_bucketed_tables_need_no_exchange(spark, rows):
    draw = random.Random(3)
    sales = spark.createDataFrame(
        [(draw.randrange(40), i, draw.randrange(5), float(i), dt.date(2025, 1, 1 + i % 28)) for i in range(500)] + [(None, 900, 1, 1.0, dt.date(2025, 1, 1))],
        "customer_id int, order_id int, quantity int, amount double, order_date date",
    )
    people = spark.createDataFrame([(i, f"n{i}", float(i), "f", "x") for i in range(40)], "customer_id int, name string, age double, gender string, city string")
    kept = [tables.write_bucketed(df, f"t_{n}", scratch_path(spark, n), "customer_id", 5) for n, df in (("sales", sales), ("people", people))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = customer_aggregate(kept[0], first=(), customers=kept[1])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert "Exchange" in customer_aggregate(sales, first=(), customers=people)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(got) == rows(customer_aggregate(sales, first=(), customers=people))
    with pytest.raises(ValueError):
        tables.write_bucketed(sales, "t_none", scratch_path(spark, "none"), "customer_id", 0)


def test_upserts_write_only_the_months_they_touch(spark, tmp_path, rows):
    path = str(tmp_path / "orders")
    make = lambda *r: spark.createDataFrame([(k, v, dt.date(2025, m, d)) for k, v, m, d in r], "id int, v string, order_date date")
    read = lambda: [tuple(r) for r in spark.read.parquet(path).select("id", "v", F.month("order_date")).collect()]
    assert tables.upsert_months(make((1, "a", 1, 5), (2, "b", 2, 5), (3, "c", 3, 5), (None, "n", 3, 1)), path, ["id"]) == ["2025-01", "2025-02", "2025-03"]
    untouched = {p: p.stat().st_mtime_ns for p in Path(path).glob("order_month=2025-02/*.parquet")}
    change = make((1, "moved", 3, 9), (3, "old", 3, 6), (3, "new", 3, 7), (4, "d", 5, 1), (None, "m", 3, 2))
    for _ in range(2):
        months = tables.upsert_months(change, path, ["id"])
        assert sorted(read(), key=str) == sorted([(1, "moved", 3), (2, "b", 2), (3, "new", 3), (4, "d", 5), (None, "m", 3)], key=str)
        assert set(months) <= {"2025-01", "2025-03", "2025-05"}
    assert not Path(path, "order_month=2025-01").exists()  # its only row has moved
    assert untouched and all(p.stat().st_mtime_ns == t for p, t in untouched.items())
    with pytest.raises(Exception, match="rows without order_date"):
        tables.upsert_months(spark.createDataFrame([(9, "x", None)], "id int, v string, order_date date"), path, ["id"])


def test_merged_sketches(spark):
    df = spark.range(20_000).select((F.col("id") % 10).alias("day"), (F.col("id") % 7_000).alias("who"), F.col("id").cast("double").alias("amount"))
    df = df.unionByName(spark.createDataFrame([(11, None, None)], "day long, who long, amount double"))
    kept = sketches.sketches(df, ["day"], ["who"], ["amount"])
    row = sketches.estimates(sketches.merged(kept), [0.1, 0.5, 0.9]).first()
    assert abs(row.who_count - 7_000) < 7_000 * 0.05
    assert all(abs(x - q * 20_000) < 20_000 * 0.02 for x, q in zip(row.amount_quantiles, (0.1, 0.5, 0.9)))
    empty = sketches.estimates(kept).filter("day = 11").first()
    assert empty.who_count == 0 and empty.amount_quantiles is None


def test_a_stored_model_scores_alike_in_another_session(spark, tmp_path):
    draw = random.Random(1)
    data = [(i, float(draw.randrange(100)), None if i % 9 == 0 else float(draw.randrange(9)), 3.0) for i in range(300)]
    frame = spark.createDataFrame([(*r, int(r[1] > 60)) for r in data], "customer_id int, recency double, frequency double, monetary double, churn int")
    features = ["recency", "frequency", "monetary"]
    fitted = churn.model_input(frame, features)
    model = churn.train_random_forest(fitted, features, trees=5)
    fresh = {r.customer_id: r.churn_probability for r in churn.churn_scores(model, fitted).collect()}
    path = str(tmp_path / "model")
    kept = stored.remember(model, frame, features)
    kept.save(spark, path)
    kept.save(spark, path)  # replaces
    assert {r.customer_id: r.churn_probability for r in stored.load(spark, path).scores(frame).collect()} == pytest.approx(fresh)
    frame.write.parquet(str(tmp_path / "rows"))
    script = f"""
from custlens.session import build_session
from custlens.operators import stored
spark = build_session("other", **{{"spark.master": "local[2]", "spark.ui.enabled": "false"}})
print("SCORES", sorted((r.customer_id, round(r.churn_probability, 9)) for r in stored.load(spark, {path!r}).scores(spark.read.parquet({str(tmp_path / "rows")!r})).collect()))
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, cwd=Path(__file__).resolve().parents[1], timeout=300).stdout
    assert "SCORES " + str(sorted((k, round(v, 9)) for k, v in fresh.items())) in out
    with pytest.raises(ValueError):
        stored.load(spark, path).scores(frame.drop("recency"))
