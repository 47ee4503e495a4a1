"""Queries over tables that are kept up to date: streams, buckets, months, sketches, stored models."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from custlens.functions.columns import one_row
from custlens.operators import boosting, churn, rfm, sketches, stored
from custlens.plans import catalog, retail
from custlens.plans.catalog import query
from custlens.session import scratch_path, stage
from custlens.sources import retail_views as views
from custlens.sources import tables
from custlens.streaming import daily


@query("SELECT * FROM v_daily_marketing", approx=["spend", "campaign_revenue", "CTR", "CPC"])
def daily_marketing_stream(spark, folder):
    """Events arrive in three deliveries, up to a day late; the stream runs after each."""
    events = spark.read.parquet(f"{folder}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.make_dt_interval(hours=F.pmod(F.xxhash64("event_id"), F.lit(24)).cast("int"))
    arrival = (F.col("ts") + late).cast("long")
    span = one_row(events, F.min(arrival).alias("low"), F.max(arrival).alias("high"))
    share = F.least(F.floor(F.try_divide((arrival - span["low"]) * 3, span["high"] - span["low"] + 1)), F.lit(2))
    deliveries = stage(events.withColumn("_delivery", F.coalesce(share, F.lit(0)).cast("int")), "deliveries")
    inbox, closed, checkpoint = (scratch_path(spark, name) for name in ("inbox", "closed-days", "stream"))
    for k in range(3):
        deliveries.filter(F.col("_delivery") == k).select(*events.columns).write.mode("append").parquet(inbox)
        daily.update_closed_days(spark, inbox, events.schema, closed, checkpoint)
    return daily.daily_table(spark, inbox, events.schema, closed)


@query(digits=2, approx=["amount_sum"])
def bucketed_customer_aggregate(spark, folder):
    """Orders and customers in equal buckets: the aggregation and the join read them without an exchange."""
    contact = F.when(F.col("order_id") % 3 != 0, F.concat(F.lit("contact "), (F.col("order_id") % 7).cast("string")))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = uuid.uuid4().hex
    sales = retail.sales(spark, folder).withColumn("contact", contact)
    kept = tables.write_bucketed(sales, f"sales_{name}", scratch_path(spark, "sales-buckets"), "customer_id", buckets, ["order_date"])
    people = tables.write_bucketed(views.customers(spark, folder), f"customers_{name}", scratch_path(spark, "customer-buckets"), "customer_id", buckets)
    return rfm.customer_aggregate(kept, first=["contact"], customers=people)


_DAY = "CAST(o_orderdate AS DATE)"
_MOVED = f"CASE WHEN o_orderkey % 13 = 0 THEN CAST({_DAY} + INTERVAL 40 DAY AS DATE) ELSE {_DAY} END"


@query(
    f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS amount,
               {_MOVED} AS order_date, strftime({_MOVED}, '%Y-%m') AS order_month
        FROM orders""",
    approx=["amount"],
)
def upsert_corrected_months(spark, folder):
    """Corrections of orders, some of which move to another month, and orders that were missing; all applied twice."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").cast("date").alias("order_date")
    )
    path = scratch_path(spark, "orders-by-month")
    tables.upsert_months(orders.filter("order_id % 7 <> 0"), path, ["order_id"])
    moves = F.col("order_id") % 13 == 0
    corrected = orders.filter("order_id % 7 = 0 OR order_id % 11 = 0 OR order_id % 13 = 0").withColumns(
        {
            "amount": F.when(moves | (F.col("order_id") % 11 == 0), F.col("amount") + 1).otherwise(F.col("amount")),
            "order_date": F.when(moves, F.date_add("order_date", 40)).otherwise(F.col("order_date")),
        }
    )
    for _ in range(2):
        tables.upsert_months(corrected, path, ["order_id"])
    return spark.read.schema(orders.schema.add(tables.MONTH, "string")).parquet(path)


@query(
    """SELECT strftime(order_date, '%Y') AS year, count(DISTINCT customer_id) AS customers, count(amount) AS amounts,
              true AS count_is_close, true AS quantiles_are_close
       FROM v_sales GROUP BY 1"""
)
def sketched_years(spark, folder):
    """Customers and amounts of a year from daily sketches, beside the exact figures: a count within 5 % (three standard
    errors), quartiles whose exact rank is within 1.5 % and one row."""
    sales = stage(retail.sales(spark, folder).select("order_date", "customer_id", "amount"), "sales")
    per_day = stage(sketches.sketches(sales, ["order_date"], ["customer_id"], ["amount"]), "daily-sketches")
    year = F.date_format("order_date", "yyyy").alias("year")
    found = sketches.estimates(sketches.merged(per_day, [year]), [0.25, 0.5, 0.75])
    found = stage(found, "yearly-estimates")
    exact = sales.groupBy(year).agg(F.count_distinct("customer_id").alias("customers"), F.count("amount").alias("amounts"))
    below = [F.count_if(F.col("amount") < F.col("amount_quantiles")[i]).alias(f"b{i}") for i in range(3)]
    equal = [F.count_if(F.col("amount") <= F.col("amount_quantiles")[i]).alias(f"e{i}") for i in range(3)]
    ranks = sales.withColumn("year", year).join(found, "year").groupBy("year").agg(*below, *equal)
    room = F.col("amounts") * 0.015 + 1
    close = [(F.col(f"b{i}") <= F.col("amounts") * q + room) & (F.col(f"e{i}") >= F.col("amounts") * q - room) for i, q in enumerate((0.25, 0.5, 0.75))]
    both = exact.join(found, "year").join(ranks, "year")
    return both.select(
        "year",
        "customers",
        "amounts",
        (F.abs(F.col("customer_id_count") - F.col("customers")) <= F.col("customers") * 0.05).alias("count_is_close"),
        (close[0] & close[1] & close[2]).alias("quantiles_are_close"),
    )


@query()
def churn_scores_stored_model(spark, folder):
    """The model is fitted, saved with its statistics, loaded again and applied to rows as they come."""
    rows = catalog.separable(spark, folder)
    features = catalog.FEATURES
    model = churn.train_boosted_trees(churn.model_input(rows, features), features, **catalog.FINE)
    path = scratch_path(spark, "churn-model")
    stored.remember(model, rows, features).save(spark, path)
    return stored.load(spark, path).scores(rows).select("customer_id", "churn_risk")


@query()
def second_order_known_labels(spark, folder):
    """Boosted trees with second-order gains, saved and loaded again, on labels that follow from one measure."""
    rows = stage(catalog.separable(spark, folder), "separable")
    path = scratch_path(spark, "second-order-trees")
    boosting.train(rows, catalog.FEATURES, **catalog.FINE).save(spark, path)
    return boosting.BoostedModel.load(spark, path).score(rows).select("customer_id", "churn", "predicted")


# The same results as of the queries that do without the kept table or model.
catalog.CHECKS["bucketed_customer_aggregate"] = catalog.CHECKS["customer_aggregate"]
catalog.CHECKS["churn_scores_stored_model"] = catalog.CHECKS["churn_scores_known_labels"]
catalog.CHECKS["second_order_known_labels"] = catalog.CHECKS["boosted_trees_known_labels"]
