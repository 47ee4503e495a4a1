"""Daily marketing figures from a stream of events.

A stream reads the files that have come since its last run, adds events up by day in a window over their time, and writes a
day once, when the watermark has passed it. Days that are still open are added up from the events themselves, of which the
filter on time reads only the tail. Runs are started by a scheduler and end when nothing new is left (available-now trigger).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from custlens.operators.marketing import COUNTERS, daily_marketing
from custlens.sources.retail_views import event_counters


def daily_events(events: DataFrame, delay: str | None = None, time: str = "ts") -> DataFrame:
    """Counters per day of ``events``, a table or, with the ``delay`` that late events may have, a stream.

    Events without a time belong to no day.
    """
    timed = events.withColumn("_time", F.col(time).cast("timestamp")).filter("_time IS NOT NULL")
    if delay is not None:
        timed = timed.withWatermark("_time", delay)
    days = timed.groupBy(F.window("_time", "1 day").alias("day")).agg(*event_counters())
    return days.select(F.col("day.start").cast("date").alias("date"), *COUNTERS)


def update_closed_days(
    spark: SparkSession, events_path: str, schema: T.StructType, table_path: str, checkpoint: str, delay: str = "2 days", time: str = "ts"
) -> StreamingQuery:
    """Take in all new event files, write the days that can get no more events, and return the finished query.

    An event may come ``delay`` after the latest one and still count. Later ones are left out, and the query's progress counts
    them (``numRowsDroppedByWatermark``): a closed day doesn't change. A run that broke off is continued from the checkpoint
    by the next one, and no file or day counts twice.
    """
    events = spark.readStream.schema(schema).parquet(events_path)
    writer = daily_events(events, delay, time).writeStream.format("parquet").outputMode("append")
    query = writer.option("checkpointLocation", checkpoint).option("path", table_path).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def daily_table(spark: SparkSession, events_path: str, schema: T.StructType, table_path: str, time: str = "ts") -> DataFrame:
    """Closed days from the stream's table and open ones from their events, with CTR and CPC as in ``daily_marketing``."""
    columns = "date date, impressions long, clicks long, conversions long, spend double, revenue double"
    closed = spark.read.schema(columns).parquet(table_path)
    last = closed.agg(F.max("date")).scalar()
    events = spark.read.schema(schema).parquet(events_path)
    tail = events.filter(last.isNull() | (F.col(time) >= F.date_add(last, 1)))
    return daily_marketing(closed.select("date", *COUNTERS).unionByName(daily_events(tail, time=time)))
