"""Tables that are kept: bucketed on a key, or brought up to date month by month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custlens.functions.columns import require_columns
from custlens.session import stage

MONTH = "order_month"


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, order: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as the table ``name`` in buckets of ``key``, each sorted by the key (and ``order``), and read it.

    Joins of tables with equal buckets and groupings on the key then need no exchange: the shuffle is paid once, when the table is
    written. Rows are dealt like the buckets before writing, so a bucket is one file. A key with very many rows makes its
    bucket as large, as any grouping on it would.
    """
    if buckets < 1:
        raise ValueError("a table has one bucket at least")
    require_columns(df, [key, *order])
    dealt = df.repartition(buckets, key).sortWithinPartitions(key, *order)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key, *order).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def upsert_months(new: DataFrame, path: str, keys: Sequence[str], date: str = "order_date", newest: Column | None = None) -> list[str]:
    """Bring a table partitioned by month up to date with ``new`` rows; returns the months that were written.

    A new row takes the place of the row with the same ``keys`` (nulls are equal), also where its date moves it to another month. Of
    several new rows with the same keys the one with the greatest ``newest`` counts (default: the greatest date). Only months
    of new rows and of the rows they replace are read and written again, by dynamic partition overwrite. Applying the
    same rows again changes nothing. The table is made where there is none; rows without a date are an error.
    """
    spark = new.sparkSession
    month = F.date_format(date, "yyyy-MM")
    order = F.desc_nulls_last(F.col(date) if newest is None else newest)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order, F.xxhash64(*new.columns)))
    checked = F.when(F.col(date).isNull(), F.raise_error(F.lit(f"rows without {date}")).cast("string")).otherwise(month)
    latest = new.withColumn("_place", place).filter("_place = 1").drop("_place").withColumn(MONTH, checked)
    latest = stage(latest, "new-rows")
    files, folder = _files(spark, path)
    touched = {r[0] for r in latest.select(MONTH).distinct().collect()}  # one row per month
    merged = latest
    if files.exists(folder):
        table = spark.read.schema(latest.schema).option("basePath", path).parquet(path)
        same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
        replaced = table.select(*keys, MONTH).alias("old").join(latest.select(*keys).alias("new"), same, "left_semi")
        touched |= {r[0] for r in replaced.select(MONTH).distinct().collect()}
        kept = table.filter(F.col(MONTH).isin(*touched)).alias("old").join(latest.select(*keys).alias("new"), same, "left_anti")
        merged = kept.select(*latest.columns).unionByName(latest)
    merged = stage(merged, "merged-months")
    filled = {r[0] for r in merged.select(MONTH).distinct().collect()}
    writer = merged.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    for gone in touched - filled:  # all of its rows have moved
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MONTH}={gone}"), True)
    return sorted(touched)
