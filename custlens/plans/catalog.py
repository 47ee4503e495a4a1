"""Every registered query with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.functions.columns import days_between, rounded, safe_ratio
from custlens.functions.order_stats import medians
from custlens.operators import advice, churn, cleaning, clustering, enrich, marketing, metrics, products, quality, rfm, stats, value
from custlens.plans import retail
from custlens.plans.check_sql import check, tie_shift
from custlens.session import scratch_path, spread_rows, stage
from custlens.sources import delimited, headers
from custlens.sources import retail_views as views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None, digits: int = 4, approx: Sequence[str] = ()):
    """Register a query under its function name. ``approx`` columns depend on summation order and are rounded."""

    def register(fn: Query) -> Query:
        name = fn.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(spark, folder)
            return df.withColumns({c: F.round(F.col(c) + float(tie_shift(digits)), digits) for c in approx}) if approx else df

        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = check(sql, digits, approx)
        return fn

    return register


# ---------------------------------------------------------------- files, typing, validation


@query("SELECT * FROM v_orders")
def ingest_read_delimited(spark, folder):
    orders = views.orders(spark, folder)
    path = delimited.write_table(
        orders.withColumn("order_date", F.date_format("order_date", "dd/MM/yyyy")),
        scratch_path(spark, "orders-text"),
        "csv",
        sep=";",
    )
    return delimited.read_delimited(spark, path, orders.schema)


ORDER_FIELDS = ["order_id", "customer_id", "product_id", "quantity", "order_date"]


def _raw_orders(spark, folder):
    """Order lines as text; every 97th has a field too many, every 89th one too few."""
    orders = views.orders(spark, folder)
    fields = [F.col(c).cast("string") for c in ORDER_FIELDS]
    line = (
        F.when(F.col("order_id") % 97 == 0, F.concat_ws(";", *fields, F.lit("")))
        .when(F.col("order_id") % 89 == 0, F.concat_ws(";", *fields[:-1]))
        .otherwise(F.concat_ws(";", *fields))
    )
    path = scratch_path(spark, "raw-orders")
    orders.select(line.alias("value")).write.text(path)
    return delimited.read_raw(spark, path, ORDER_FIELDS, header=False)


@query(
    """SELECT count(*) FILTER (WHERE order_id % 97 <> 0) AS good_lines,
              count(*) FILTER (WHERE order_id % 97 = 0) AS malformed_lines FROM v_orders"""
)
def ingest_count_malformed(spark, folder):
    return delimited.count_malformed(_raw_orders(spark, folder))


@query(
    """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
              CAST(product_id AS VARCHAR) AS product_id, CAST(quantity AS VARCHAR) AS quantity,
              CASE WHEN order_id % 89 <> 0 THEN CAST(order_date AS VARCHAR) END AS order_date
       FROM v_orders WHERE order_id % 97 <> 0"""
)
def ingest_good_lines(spark, folder):
    return delimited.good_lines(_raw_orders(spark, folder))


@query(
    """SELECT CAST(c_custkey % 4 AS INTEGER) AS dialect,
              CASE c_custkey % 4 WHEN 0 THEN ';' WHEN 1 THEN ',' WHEN 2 THEN chr(9) ELSE ';' END AS separator,
              CASE WHEN c_custkey % 4 < 2 THEN 'UTF-8' ELSE 'ISO-8859-1' END AS encoding,
              count(*) AS line_count
       FROM customer GROUP BY 1, 2, 3"""
)
def ingest_profile_files(spark, folder):
    customers = views.customers(spark, folder).withColumn("name", F.concat("name", F.lit(" né à")))
    root = scratch_path(spark, "dialects")
    dialects = [(";", "UTF-8"), (",", "UTF-8"), ("\t", "ISO-8859-1"), (";", "ISO-8859-1")]
    for i, (sep, encoding) in enumerate(dialects):
        part = customers.filter(F.col("customer_id") % 4 == i)
        part.write.option("sep", sep).option("encoding", encoding).csv(f"{root}/dialect-{i}")
    files = delimited.profile_files(spark, [f"{root}/dialect-{i}" for i in range(len(dialects))])
    dialect = F.regexp_extract("file_path", "dialect-([0-9])", 1).cast("int").alias("dialect")
    return files.groupBy(dialect, "separator", "encoding").agg(F.sum("line_count").alias("line_count"))


_FORMATS = [  # separator, encoding, header in the file's own order
    (";", "UTF-8", ["order_id", "customer_id", "quantity", "order_date"]),
    (",", "UTF-8", ["Date Commande", "Id_Client", "Qte", "order_id", "Numéro"]),
    ("\t", "ISO-8859-1", ["Qté note", "client_id", "order_id", "date", "qty"]),
    (";", "ISO-8859-1", ["quantité totale", "num_commande", "customer", "OrderDate", "quantite"]),
]


def _mixed_files(spark, folder):
    """Orders in four formats; every 101st line has a field too many, some notes hold a quoted line break."""
    orders = views.orders(spark, folder)
    root = scratch_path(spark, "mixed")
    note = F.when(F.col("order_id") % 7 == 0, F.lit('"à ""noter""\nsuite"')).otherwise(F.lit("né"))
    number = F.replace((F.col("quantity") + 0.5).cast("string"), F.lit("."), F.lit(","))
    fields = {
        "order_id": F.col("order_id").cast("string"),
        "customer_id": F.col("customer_id").cast("string"),
        "quantity": F.concat(F.lit('"'), number, F.lit('"')),
        "order_date": F.date_format("order_date", "dd/MM/yyyy"),
        "note": note,
    }
    meaning = [
        ["order_id", "customer_id", "quantity", "order_date"],
        ["order_date", "customer_id", "quantity", "order_id", "note"],
        ["note", "customer_id", "order_id", "order_date", "quantity"],
        ["note", "order_id", "customer_id", "order_date", "quantity"],
    ]
    for i, ((sep, encoding, names), order) in enumerate(zip(_FORMATS, meaning)):
        line = F.concat_ws(sep, *[fields[c] for c in order])
        line = F.when(F.col("order_id") % 101 == 0, F.concat(line, F.lit(sep + "extra"))).otherwise(line)
        # A string column may hold any bytes; the text writer puts them down as they are.
        part = F.pmod(F.xxhash64("order_id"), F.lit(3)).cast("int").alias("part")
        lines = orders.filter(F.col("order_id") % 4 == i).select(part, F.lit(1).alias("place"), F.encode(line, encoding).cast("string").alias("line"))
        head = F.encode(F.lit(sep.join(names)), encoding).cast("string")
        heads = spark.range(3).select(F.col("id").cast("int"), F.lit(0), head)
        files = lines.union(heads).repartitionById(3, "part").sortWithinPartitions("part", "place")
        files.select("line").write.text(f"{root}/format-{i}")
    return [f"{root}/format-{i}" for i in range(len(_FORMATS))]


_EXPECTED = ["order_id", "customer_id", "quantity", "order_date"]


def _load_mixed(spark, folder):
    return delimited.load_files(
        spark, _mixed_files(spark, folder), _EXPECTED, ["order_date"], ["quantity"], ["order_id", "order_date"], drop_missing=True, multi_line=True
    )


@query(
    """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, quantity + 0.5 AS quantity, order_date
       FROM v_orders WHERE order_id % 101 <> 0"""
)
def load_mixed_files(spark, folder):
    return _load_mixed(spark, folder)[0].select(*_EXPECTED).withColumn("quantity", F.col("quantity").cast("double"))


@query("SELECT CAST(order_id % 4 AS INTEGER) AS format, count(*) AS malformed_lines FROM v_orders WHERE order_id % 101 = 0 GROUP BY 1")
def load_report(spark, folder):
    broken = _load_mixed(spark, folder)[1]
    return broken.groupBy(F.regexp_extract("file_path", "format-([0-9])", 1).cast("int").alias("format")).agg(F.count("*").alias("malformed_lines"))


@query(
    r"""SELECT CAST(order_id AS VARCHAR) AS order_id,
              CASE WHEN order_id % 3 = 0 THEN 'first; ' || order_id || chr(10) || 'say "yes"' || chr(10) || chr(10) || 'last'
                   WHEN order_id % 5 = 0 THEN '"' || chr(10) ELSE 'plain' END AS note,
              CAST(quantity AS VARCHAR) AS quantity
       FROM v_orders WHERE order_id % 97 <> 0"""
)
def ingest_quoted_parallel(spark, folder):
    """Notes with quotes and line breaks, read by as many tasks as the files have splits."""
    orders = views.orders(spark, folder)
    key = F.col("order_id").cast("string")
    note = F.when(F.col("order_id") % 3 == 0, F.concat(F.lit('"first; '), key, F.lit('\nsay ""yes""\n\nlast"')))
    note = note.when(F.col("order_id") % 5 == 0, F.lit('"""\n"')).otherwise(F.lit("plain"))
    line = F.concat_ws(";", key, note, F.col("quantity").cast("string"))
    line = F.when(F.col("order_id") % 97 == 0, F.concat(line, F.lit(";one;two"))).otherwise(line)
    path = scratch_path(spark, "quoted")
    orders.select(line.alias("value")).write.text(path)
    return delimited.good_lines(delimited.read_raw(spark, path, ["order_id", "note", "quantity"], header=False, multi_line=True))


_ENCODINGS = [  # encoding, separator, byte order mark
    ("UTF-8", ";", True),
    ("UTF-8", ",", False),
    ("UTF-16LE", "\t", True),
    ("UTF-16BE", ";", True),
    ("ISO-8859-1", ",", False),
]


@query(
    """SELECT customer_id, CASE WHEN customer_id % 5 < 4 THEN name || ' né à ' || city || chr(2565) || chr(256) ELSE name || ' né à ' || city END AS name,
              signup_date FROM v_customers"""
)
def ingest_encodings(spark, folder):
    """Customers in files of every encoding; the last two letters hold the bytes of a line break where there is UTF-16."""
    customers = views.customers(spark, folder)
    root = scratch_path(spark, "encodings")
    for i, (encoding, sep, mark) in enumerate(_ENCODINGS):
        letters = F.lit("\u0a05\u0100" if encoding != "ISO-8859-1" else "")
        line = F.concat_ws(sep, F.col("customer_id").cast("string"), F.concat("name", F.lit(" né à "), "city", letters), F.date_format("signup_date", "dd/MM/yyyy"))
        part = F.pmod(F.xxhash64("customer_id"), F.lit(3)).cast("int").alias("part")
        lines = customers.filter(F.col("customer_id") % 5 == i).select(part, F.lit(1).alias("place"), F.encode(line, encoding).cast("string").alias("line"))
        head = F.encode(F.lit(("\ufeff" if mark else "") + sep.join(["Customer", "Full Name", "Signup Date"])), encoding).cast("string")
        files = lines.union(spark.range(3).select(F.col("id").cast("int"), F.lit(0), head)).repartitionById(3, "part").sortWithinPartitions("part", "place")
        files.select("line").write.option("lineSep", {"UTF-16LE": "\n\0", "UTF-16BE": "\0\n"}.get(encoding, "\n")).text(f"{root}/encoding-{i}")
    paths = [f"{root}/encoding-{i}" for i in range(len(_ENCODINGS))]
    table, _ = delimited.load_files(spark, paths, ["customer_id", "name", "signup_date"], dates=["signup_date"], numbers=["customer_id"])
    return table.select(F.col("customer_id").cast("long").alias("customer_id"), "name", "signup_date")


@query(
    """SELECT 'amount' AS column_name, 'revenue' AS blocks
       UNION ALL SELECT column_name, 'revenue when amount is absent' FROM (
           SELECT UNNEST([{'column_name': 'price', 'n': COUNT(CASE WHEN price < 0 THEN price END)},
                          {'column_name': 'quantity', 'n': COUNT(quantity)}], recursive := true) FROM v_orders) WHERE n = 0
       UNION ALL SELECT 'order_date', 'time analyses' FROM v_orders HAVING COUNT(order_date) = 0"""
)
def blocked_analyses(spark, folder):
    orders = views.orders(spark, folder)
    unpriced = orders.withColumn("price", F.when(F.col("price") < 0, F.col("price")))
    return quality.blocked_analyses(unpriced, ["order_date", "amount", "price", "quantity"], empty_too=True)


@query("SELECT * FROM v_orders")
def canonicalise_columns(spark, folder):
    french = views.orders(spark, folder).toDF(" Num Commande", "Client", "Product ID", "Qte", "Prix", "Date Commande ")
    expected = ["order_id", "customer_id", "product_id", "quantity", "price", "order_date"]
    return headers.canonicalise_columns(french, expected)


@query(
    """SELECT order_id, customer_id, quantity, price FROM v_orders
       UNION ALL SELECT order_id, customer_id, NULL, price FROM v_orders"""
)
def union_by_canonical_name(spark, folder):
    orders = views.orders(spark, folder)
    one = orders.select("order_id", F.col("customer_id").alias("id_client"), F.col("quantity").alias("Qty"), "price")
    two = orders.select(F.col("price").alias("unit_price"), F.col("customer_id").alias("Client"), "order_id")
    return headers.union_by_canonical_name([one, two], ["order_id", "customer_id", "quantity", "price"])


@query(
    """SELECT order_id, product_id, CASE WHEN order_id % 50 <> 0 THEN order_date END AS day_first,
              order_date AS year_first, order_date AS mixed FROM v_orders"""
)
def coerce_dates(spark, folder):
    day = F.col("order_date")
    orders = views.orders(spark, folder).select(
        "order_id",
        "product_id",
        F.when(F.col("order_id") % 50 == 0, "n/a").otherwise(F.date_format(day, "dd/MM/yyyy")).alias("day_first"),
        F.date_format(day, "yyyy-MM-dd").alias("year_first"),
        F.when(F.col("order_id") % 2 == 0, F.date_format(day, "d-M-yyyy")).otherwise(F.date_format(day, "yyyy/MM/dd")).alias("mixed"),
    )
    by_column = quality.coerce_dates(orders, ["day_first", "year_first"])
    return quality.coerce_dates(by_column, ["mixed"], per_row=True)


def _text_quantities(spark, folder):
    key = F.col("order_id")
    text = (
        F.when(key % 11 == 0, "nan")
        .when(key % 13 == 0, "")
        .when(key % 17 == 0, "abc")
        .when(key % 19 == 0, "None")
        .otherwise(F.replace((F.col("quantity") + 0.5).cast("string"), F.lit("."), F.lit(",")))
    )
    return views.orders(spark, folder).select("order_id", "product_id", text.alias("quantity"))


_BAD_QUANTITY = "(order_id % 11 = 0 OR order_id % 13 = 0 OR order_id % 17 = 0 OR order_id % 19 = 0)"


@query(f"SELECT order_id, product_id, CASE WHEN NOT {_BAD_QUANTITY} THEN quantity + 0.5 END AS quantity FROM v_orders")
def coerce_numeric(spark, folder):
    return quality.coerce_numeric(_text_quantities(spark, folder), ["quantity"])


@query(
    f"""SELECT 'quantity' AS column_name, CAST(0 AS BIGINT) AS null_before, count(*) FILTER (WHERE {_BAD_QUANTITY}) AS null_after
        FROM v_orders"""
)
def coercion_report(spark, folder):
    text = _text_quantities(spark, folder)
    return quality.coercion_report(text, quality.coerce_numeric(text, ["quantity"]), ["quantity"])


@query(
    """SELECT 'order_id' AS column_name, true AS is_present, count(*) FILTER (WHERE order_id IS NULL) AS null_count,
              count(*) FILTER (WHERE order_id IS NULL) / CAST(count(*) AS DOUBLE) * 100 AS null_pct FROM v_orders
       UNION ALL SELECT 'price', true, count(*) FILTER (WHERE price IS NULL),
              count(*) FILTER (WHERE price IS NULL) / CAST(count(*) AS DOUBLE) * 100 FROM v_orders
       UNION ALL SELECT 'amount', false, NULL, NULL""",
    approx=["null_pct"],
)
def validate_required(spark, folder):
    return quality.validate_required(views.orders(spark, folder), ["order_id", "price", "amount"])


@query("SELECT * FROM v_orders WHERE price IS NOT NULL AND quantity IS NOT NULL")
def drop_incomplete(spark, folder):
    return quality.drop_incomplete(views.orders(spark, folder), ["price", "quantity"])


@query("SELECT count(*) FILTER (WHERE price IS NULL) AS removed_rows, count(price) AS remaining_rows FROM v_orders")
def incomplete_report(spark, folder):
    return quality.incomplete_report(views.orders(spark, folder), ["price", "quantity"])


@query("SELECT *, strftime(order_date, '%Y-%m') AS order_month FROM v_sales")
def write_partitioned_table(spark, folder):
    path = delimited.write_table(retail.sales(spark, folder), scratch_path(spark, "sales"), month_of="order_date")
    return spark.read.parquet(path).withColumn("order_month", F.date_format("order_date", "yyyy-MM"))


def _summary_sql(column: str, kind: str, number: bool) -> str:
    if number:
        parts = f'min({column}), max({column}), avg({column}), stddev_samp({column})'
    else:
        parts = "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)"
    low, high, mean, std = parts.split(", ")
    return (
        f"SELECT '{column}' AS column_name, '{kind}' AS data_type, count(*) AS row_count, "
        f"count(*) - count({column}) AS null_count, CAST({low} AS DOUBLE) AS min_value, CAST({high} AS DOUBLE) AS max_value, "
        f"{mean} AS mean_value, {std} AS std_value FROM v_customers"
    )


_CUSTOMER_COLUMNS = [
    ("customer_id", "bigint", True),
    ("name", "string", False),
    ("age", "double", True),
    ("gender", "string", False),
    ("city", "string", False),
    ("signup_date", "date", False),
]
_SUMMARY = " UNION ALL ".join(_summary_sql(*c) for c in _CUSTOMER_COLUMNS)


@query(_SUMMARY, approx=["mean_value", "std_value"])
def table_summary(spark, folder):
    return quality.table_summary(views.customers(spark, folder))


def _describe_sql(column: str, kind: str, number: bool) -> str:
    none = "CAST(NULL AS DOUBLE)"
    if number:
        text = "CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT)"
        q = [f"(SELECT quantile_cont(CAST({column} AS DOUBLE), {p}) FROM v_customers)" for p in (0.25, 0.5, 0.75)]
        figures = [f"avg({column})", f"stddev_samp({column})", f"CAST(min({column}) AS DOUBLE)", f"CAST(max({column}) AS DOUBLE)", *q]
    else:
        figures = [none] * 7
        ranked = f"(SELECT CAST({column} AS VARCHAR) AS v, count(*) AS n FROM v_customers WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)"
        text = f"count(DISTINCT {column}), (SELECT v FROM {ranked}), (SELECT n FROM {ranked})"
    names = ["mean", "std", "min", "max", "q25", "q50", "q75"]
    unique, top, freq = text.split(", ", 2) if number else (f"count(DISTINCT {column})", f"(SELECT v FROM {ranked})", f"(SELECT n FROM {ranked})")
    return (
        f"SELECT '{column}' AS column_name, '{kind}' AS data_type, count({column}) AS \"count\", count(*) - count({column}) AS null_count, "
        + ", ".join(f'{f} AS "{n}"' for f, n in zip(figures, names))
        + f', {unique} AS "unique", {top} AS top, {freq} AS freq FROM v_customers'
    )


@query(" UNION ALL ".join(_describe_sql(*c) for c in _CUSTOMER_COLUMNS), approx=["mean", "std"])
def describe_columns(spark, folder):
    return quality.describe_columns(views.customers(spark, folder))


@query("SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT order_id, customer_id FROM v_orders)) AS BIGINT) AS duplicate_rows FROM v_orders")
def duplicate_count(spark, folder):
    return quality.duplicate_count(views.orders(spark, folder).select("order_id", "customer_id"))


@query(
    """SELECT 'order_date' AS column_name, min(order_date) AS first_date, max(order_date) AS last_date,
              CAST(max(order_date) - min(order_date) AS INTEGER) AS span_days FROM v_orders"""
)
def date_ranges(spark, folder):
    return quality.date_ranges(views.orders(spark, folder))


# ---------------------------------------------------------------- cleaning and derivation


@query("SELECT DISTINCT customer_id, order_date FROM v_orders")
def dedup_rows(spark, folder):
    return cleaning.dedup_rows(views.orders(spark, folder).select("customer_id", "order_date"))


@query("SELECT * REPLACE (coalesce(age, (SELECT median(age) FROM v_customers)) AS age) FROM v_customers")
def fill_median(spark, folder):
    return cleaning.fill_median(views.customers(spark, folder), "age")


@query("SELECT * REPLACE (coalesce(price, 0) AS price) FROM v_orders")
def fill_constant(spark, folder):
    return cleaning.fill_constant(views.orders(spark, folder), "price")


@query("SELECT * FROM v_customers WHERE age >= 15 AND age <= 100")
def filter_range(spark, folder):
    return cleaning.filter_range(views.customers(spark, folder), "age", 15, 100)


@query("SELECT o.* REPLACE (coalesce(o.price, p.base_price) AS price) FROM v_orders o LEFT JOIN v_products p ON o.product_id = p.product_id")
def fill_price_coalesce(spark, folder):
    return cleaning.fill_price(views.orders(spark, folder), views.products(spark, folder))


@query("SELECT o.* FROM v_orders o")
def fill_price_all_missing(spark, folder):
    return cleaning.fill_price(views.orders(spark, folder), views.products(spark, folder), mode="all_missing", prices=views.prices(spark, folder))


@query("SELECT o.* REPLACE (p.base_price AS price) FROM v_orders o LEFT JOIN v_products p ON o.product_id = p.product_id")
def fill_price_none_known(spark, folder):
    unknown = F.lit(None).cast("double")
    orders = views.orders(spark, folder).withColumn("price", unknown)
    prices = views.prices(spark, folder).withColumn("price", unknown)
    return cleaning.fill_price(orders, views.products(spark, folder), mode="all_missing", prices=prices)


@query("SELECT o.* REPLACE (p.base_price AS price) FROM v_orders o LEFT JOIN v_products p ON o.product_id = p.product_id")
def fill_price_overwrite(spark, folder):
    return cleaning.fill_price(views.orders(spark, folder), views.products(spark, folder), mode="overwrite_if_any", prices=views.prices(spark, folder))


@query("SELECT *, quantity * price AS amount FROM v_orders")
def add_amount(spark, folder):
    return cleaning.add_amount(views.orders(spark, folder))


@query(
    """SELECT o.order_id, o.product_id, CAST(o.order_date - c.signup_date AS INTEGER) AS days_since_signup
       FROM v_orders o JOIN v_customers c ON o.customer_id = c.customer_id"""
)
def days_since_signup(spark, folder):
    orders = enrich.inner_join(views.orders(spark, folder), views.customers(spark, folder), "customer_id", ["signup_date"])
    return orders.select("order_id", "product_id", days_between("order_date", "signup_date").alias("days_since_signup"))


@query("SELECT * FROM v_orders WHERE order_date >= DATE '2000-10-01' AND order_date <= DATE '2001-04-01'")
def period_before(spark, folder):
    return cleaning.period_filter(views.orders(spark, folder), "order_date", retail.CHURN_AS_OF, months_back=6)


@query("SELECT * FROM v_orders WHERE order_date > DATE '2001-04-01' AND order_date <= DATE '2001-07-01'")
def period_after(spark, folder):
    return cleaning.period_filter(views.orders(spark, folder), "order_date", retail.CHURN_AS_OF, months_ahead=3)


def _range(period):
    def run(spark, folder):
        daily = stage(marketing.daily_orders(retail.sales(spark, folder), revenue="amount"), "daily-orders")
        return cleaning.range_select(daily, "date", period)

    return run


_RANGE_STARTS = {
    "1m": "CAST((SELECT max(date) FROM v_daily_orders) - INTERVAL 1 MONTH AS DATE)",
    "6m": "CAST((SELECT max(date) FROM v_daily_orders) - INTERVAL 6 MONTH AS DATE)",
    "1y": "CAST((SELECT max(date) FROM v_daily_orders) - INTERVAL 12 MONTH AS DATE)",
    "ytd": "CAST(date_trunc('year', (SELECT max(date) FROM v_daily_orders)) AS DATE)",
    "all": "DATE '0001-01-01'",
}
for _period, _start in _RANGE_STARTS.items():
    _run = _range(_period.upper() if _period == "ytd" else _period)
    _run.__name__ = f"range_select_{_period}"
    query(f"SELECT * FROM v_daily_orders WHERE date >= {_start}", digits=2, approx=["sales_revenue"])(_run)


@query(
    """SELECT campaign_id, date, 100.0 * clicks / nullif(impressions, 0) AS ctr, spend / nullif(clicks, 0) AS cpc
       FROM v_marketing""",
    approx=["ctr", "cpc"],
)
def safe_ratios(spark, folder):
    return views.marketing(spark, folder).select(
        "campaign_id",
        "date",
        safe_ratio("clicks", "impressions", 100).alias("ctr"),
        safe_ratio("spend", "clicks").alias("cpc"),
    )


@query("SELECT *, churn_probability >= 0.5 AS at_risk FROM v_scores")
def flag_threshold(spark, folder):
    return cleaning.flag_threshold(retail.churn_probabilities(spark, folder), "churn_probability")


@query(
    """SELECT product_id,
              CASE WHEN base_price <= q[2] THEN 1 WHEN base_price <= q[3] THEN 2 WHEN base_price <= q[4] THEN 3
                   WHEN base_price <= q[5] THEN 4 ELSE 5 END AS price_score,
              CASE WHEN size <= s[2] THEN 5 WHEN size <= s[3] THEN 4 WHEN size <= s[4] THEN 3 WHEN size <= s[5] THEN 2 ELSE 1 END AS size_score
       FROM v_products, (SELECT quantile_cont(base_price, [0, 0.2, 0.4, 0.6000000000000001, 0.8, 1.0]) AS q,
                                quantile_cont(CAST(size AS DOUBLE), [0, 0.2, 0.4, 0.6000000000000001, 0.8, 1.0]) AS s FROM v_products)"""
)
def quantile_scores(spark, folder):
    labels = {"base_price": [1, 2, 3, 4, 5], "size": [5, 4, 3, 2, 1]}
    names = {"base_price": "price_score", "size": "size_score"}
    scored = cleaning.quantile_scores(views.products(spark, folder), labels, names)
    return scored.select("product_id", "price_score", "size_score")


@query(
    """SELECT customer_id, CAST(dense_rank() OVER (ORDER BY city) - 1 AS INTEGER) AS city_code,
              CAST(dense_rank() OVER (ORDER BY coalesce(CAST(age AS VARCHAR), 'nan')) - 1 AS INTEGER) AS age_code FROM v_customers"""
)
def encode_category(spark, folder):
    coded = cleaning.encode_categories(views.customers(spark, folder), ["city", "age"], "_code")
    return coded.select("customer_id", "city_code", "age_code")


@query("SELECT CAST(order_id AS VARCHAR) AS id, order_date AS date, CAST(quantity AS INTEGER) AS units FROM v_orders")
def project_columns(spark, folder):
    return cleaning.project(
        views.orders(spark, folder), {"id": ("order_id", "string"), "date": "order_date", "units": ("quantity", "int")}
    )


@query("SELECT customer_id, round_even(churn_probability, 2) AS churn_probability FROM v_scores")
def round_output(spark, folder):
    return rounded(retail.churn_probabilities(spark, folder).select("customer_id", "churn_probability"), 2)


# ---------------------------------------------------------------- joins


@query("SELECT o.*, p.category, p.base_price FROM v_orders o LEFT JOIN v_products p ON o.product_id = p.product_id")
def lookup_join(spark, folder):
    return enrich.lookup_join(views.orders(spark, folder), views.products(spark, folder), "product_id", ["category", "base_price"])


@query("SELECT * EXCLUDE (segment) FROM v_wide")
def denormalise_orders(spark, folder):
    return retail.wide_sales(spark, folder)


@query("SELECT s.*, a.segment FROM v_sales s JOIN v_assigned a ON s.customer_id = a.customer_id WHERE a.segment <> 4")
def inner_join_segments(spark, folder):
    some = retail.assigned_segments(spark, folder).filter("segment <> 4")
    return enrich.inner_join(retail.sales(spark, folder), some, "customer_id", ["segment"])


@query(
    """SELECT o.*, a.segment FROM v_orders o LEFT JOIN (SELECT * FROM v_assigned WHERE segment <> 4) a
       ON o.customer_id = a.customer_id"""
)
def left_join_segments(spark, folder):
    some = retail.assigned_segments(spark, folder).filter("segment <> 4")
    return enrich.lookup_join(views.orders(spark, folder), some, "customer_id", ["segment"])


@query(
    """SELECT customer_id, recency, frequency, monetary, "RFM_Score", segment, age_first, gender_first, city_first
       FROM v_segments""",
    digits=2,
    approx=["monetary"],
)
def segment_table(spark, folder):
    return retail.segment_table(spark, folder)


@query(
    """SELECT r.*, c.name, c.age, c.gender, c.city, c.signup_date, s.segment, s.churn_probability
       FROM v_rfm r LEFT JOIN v_customers c ON r.customer_id = c.customer_id LEFT JOIN v_scores s ON r.customer_id = s.customer_id""",
    digits=2,
    approx=["monetary"],
)
def enrich_customers(spark, folder):
    people = enrich.enrich(retail.rfm_table(spark, folder), views.customers(spark, folder), "customer_id")
    return enrich.enrich(people, retail.churn_probabilities(spark, folder), "customer_id")


@query(
    """SELECT coalesce(m.date, o.date) AS date, m.spend, o.orders FROM v_daily_marketing m
       FULL OUTER JOIN v_daily_orders o ON m.date = o.date""",
    approx=["spend"],
)
def full_outer_daily(spark, folder):
    spend = marketing.daily_marketing(views.marketing(spark, folder)).select("date", "spend")
    orders = marketing.daily_orders(views.orders(spark, folder)).select("date", "orders")
    return enrich.full_outer_by(spend, orders, "date")


_FUTURE = "SELECT customer_id FROM v_orders WHERE order_date > DATE '2001-04-01' AND order_date <= DATE '2001-07-01'"


def _future_buyers(spark, folder):
    return cleaning.period_filter(views.orders(spark, folder), "order_date", retail.CHURN_AS_OF, months_ahead=3)


@query(f"SELECT *, CAST(customer_id NOT IN ({_FUTURE}) AS INTEGER) AS churn FROM v_customers")
def flag_non_members(spark, folder):
    buyers = _future_buyers(spark, folder)
    return enrich.flag_members(views.customers(spark, folder), buyers, "customer_id", "churn", when_member=0)


@query(f"SELECT * FROM v_customers WHERE customer_id IN ({_FUTURE})")
def members_only(spark, folder):
    return enrich.members_only(views.customers(spark, folder), _future_buyers(spark, folder), "customer_id")


@query(f"SELECT * FROM v_customers WHERE customer_id NOT IN ({_FUTURE})")
def non_members(spark, folder):
    return enrich.non_members(views.customers(spark, folder), _future_buyers(spark, folder), "customer_id")


@query("SELECT o.*, p.base_price AS listed_price FROM v_orders o LEFT JOIN v_products p ON o.product_id = p.product_id")
def dictionary_map(spark, folder):
    return enrich.dictionary_map(views.orders(spark, folder), views.products(spark, folder), "product_id", "base_price", "listed_price")


@query(
    """SELECT o.*, CASE WHEN o.product_id % 3 = 0 THEN p.base_price / 2 ELSE p.base_price END AS listed_price
       FROM v_orders o LEFT JOIN v_products p ON o.product_id = p.product_id"""
)
def dictionary_map_latest(spark, folder):
    """Every third product has a second, later and cheaper entry."""
    first = views.products(spark, folder).select("product_id", "base_price", F.lit(1).alias("version"))
    second = first.filter(F.col("product_id") % 3 == 0).select("product_id", F.col("base_price") / 2, F.lit(2))
    return enrich.dictionary_map(views.orders(spark, folder), first.union(second), "product_id", "base_price", "listed_price", ["version"])


@query(
    "SELECT customer_id, monetary, monetary / (SELECT sum(monetary) FROM v_rfm) * 100 AS revenue_pct FROM v_rfm",
    digits=2,
    approx=["monetary", "revenue_pct"],
)
def share_of_total(spark, folder):
    spent = retail.staged_rfm(spark, folder).select("customer_id", "monetary")
    return enrich.share_of_total(spent, "monetary", "revenue_pct")


# ---------------------------------------------------------------- customers and segments


_CONTACT = "CASE WHEN order_id % 3 <> 0 THEN 'contact ' || CAST(order_id % 7 AS VARCHAR) END"


@query(
    f"""SELECT customer_id, min(name) AS name_first, min(age) AS age_first, min(gender) AS gender_first, min(city) AS city_first,
              first({_CONTACT} ORDER BY order_date, order_id) FILTER (WHERE order_id % 3 <> 0) AS contact_first,
              sum(quantity) AS quantity_sum, sum(amount) AS amount_sum, min(order_date) AS order_date_min,
              max(order_date) AS order_date_max, count(order_date) AS order_date_count FROM v_wide GROUP BY 1""",
    digits=2,
    approx=["amount_sum"],
)
def customer_aggregate(spark, folder):
    """The contact differs from order to order and has gaps; the other attributes belong to the customer."""
    contact = F.when(F.col("order_id") % 3 != 0, F.concat(F.lit("contact "), (F.col("order_id") % 7).cast("string")))
    sales = retail.sales(spark, folder).withColumn("contact", contact)
    return rfm.customer_aggregate(sales, first=["contact"], customers=views.customers(spark, folder))


@query("SELECT * FROM v_rfm", digits=2, approx=["monetary"])
def rfm_last_order(spark, folder):
    return retail.rfm_table(spark, folder)


@query(
    """SELECT r.customer_id, r.recency + 1 AS recency, r.frequency, r.monetary AS monetary_value,
              c.name, c.age, c.gender, c.city, c.signup_date
       FROM v_rfm r LEFT JOIN v_customers c ON r.customer_id = c.customer_id""",
    digits=2,
    approx=["monetary_value"],
)
def rfm_next_day(spark, folder):
    return rfm.rfm(
        retail.sales(spark, folder), offset_days=1, monetary="monetary_value", customers=views.customers(spark, folder)
    )


@query(
    """SELECT customer_id, CAST(DATE '2001-04-01' - max(order_date) AS INTEGER) AS recency, count(*) AS frequency, sum(price) AS monetary
       FROM v_sales WHERE order_date >= DATE '2000-10-01' AND order_date <= DATE '2001-04-01' GROUP BY 1""",
    digits=2,
    approx=["monetary"],
)
def rfm_given_date(spark, folder):
    return rfm.rfm(retail.sales(spark, folder), as_of=retail.CHURN_AS_OF, window_months=6, amount="price")


def _undated_sales(spark, folder):
    sales = retail.sales(spark, folder)
    return sales.withColumn("order_date", F.when(F.col("order_id") % 4 != 0, F.col("order_date")))


_UNDATED = """SELECT customer_id, CAST((SELECT max(order_date) FROM v_sales WHERE order_id % 4 <> 0)
                - max(CASE WHEN order_id % 4 <> 0 THEN order_date END) AS INTEGER) AS recency, {} AS frequency, sum(amount) AS monetary
         FROM v_sales GROUP BY 1"""


@query(_UNDATED.format("count(*)"), digits=2, approx=["monetary"])
def rfm_counting_orders(spark, folder):
    return rfm.rfm(_undated_sales(spark, folder))


@query(_UNDATED.format("count(*) FILTER (WHERE order_id % 4 <> 0)"), digits=2, approx=["monetary"])
def rfm_counting_dates(spark, folder):
    return rfm.rfm(_undated_sales(spark, folder), count="dates")


@query(
    """SELECT count(*) AS customers, count(*) FILTER (WHERE monetary < 0) AS negative_monetary,
              count(*) FILTER (WHERE frequency <= 0) AS non_positive_frequency, count(*) FILTER (WHERE recency IS NULL) AS unknown_recency
       FROM v_rfm"""
)
def rfm_checks(spark, folder):
    return rfm.rfm_checks(retail.rfm_table(spark, folder))


@query('SELECT customer_id, recency, frequency, monetary, "R", "F", "M", "RFM_Score" FROM v_scored', digits=2, approx=["monetary"])
def rfm_scores(spark, folder):
    return rfm.rfm_scores(retail.staged_rfm(spark, folder))


@query(
    """SELECT segment, avg(recency) AS avg_recency, avg(frequency) AS avg_frequency, avg(monetary) AS avg_monetary,
              avg("R") AS "avg_R", avg("F") AS "avg_F", avg("M") AS "avg_M", avg("RFM_Score") AS "avg_RFM_Score" FROM v_scored GROUP BY 1""",
    approx=["avg_recency", "avg_frequency", "avg_monetary", "avg_R", "avg_F", "avg_M", "avg_RFM_Score"],
)
def cluster_profile(spark, folder):
    return rfm.cluster_profile(retail.scored(spark, folder))


def _mode_sql(column: str) -> str:
    return (
        f"SELECT segment, arg_min({column}, rank) AS {column}_mode FROM (SELECT segment, {column}, "
        f"row_number() OVER (PARTITION BY segment ORDER BY count(*) DESC, {column}) AS rank "
        f"FROM v_segments WHERE {column} IS NOT NULL GROUP BY segment, {column}) GROUP BY 1"
    )


@query(
    f"""SELECT s.segment, avg(age_first) AS avg_age_first, avg(recency) AS avg_recency, avg(frequency) AS avg_frequency,
               avg(monetary) AS avg_monetary, avg("RFM_Score") AS "avg_RFM_Score", g.gender_first_mode, c.city_first_mode
        FROM v_segments s JOIN ({_mode_sql('gender_first')}) g ON s.segment = g.segment
        JOIN ({_mode_sql('city_first')}) c ON s.segment = c.segment GROUP BY s.segment, g.gender_first_mode, c.city_first_mode""",
    approx=["avg_age_first", "avg_recency", "avg_frequency", "avg_monetary", "avg_RFM_Score"],
)
def segment_profile(spark, folder):
    return rfm.segment_profile(retail.staged_segments(spark, folder))


FEATURES = ["recency", "frequency", "monetary"]


@query(
    "SELECT segment, "
    + ", ".join(
        f"avg({c}) AS {c}_mean, median(CAST({c} AS DOUBLE)) AS {c}_median, stddev_samp({c}) AS {c}_std, count({c}) AS {c}_count"
        for c in FEATURES
    )
    + " FROM v_scored GROUP BY 1",
    approx=[f"{c}_{name}" for c in FEATURES for name in ("mean", "median", "std")],
)
def segment_stats(spark, folder):
    return rfm.segment_stats(retail.scored(spark, folder), FEATURES)


@query(
    """SELECT c.*, g.gender_distribution FROM v_characteristics c JOIN (
         SELECT segment, string_agg(gender_first || '=' || n, ',' ORDER BY gender_first) AS gender_distribution
         FROM (SELECT segment, gender_first, count(*) AS n FROM v_segments WHERE gender_first IS NOT NULL GROUP BY 1, 2) GROUP BY 1) g
       ON c.segment = g.segment""",
    approx=["avg_clv", "avg_purchase_freq", "avg_order_value", "avg_recency", "avg_rfm_score", "avg_age"],
)
def segment_characteristics(spark, folder):
    found = rfm.segment_characteristics(retail.staged_segments(spark, folder))
    entries = F.transform(F.map_entries("gender_distribution"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return found.withColumn("gender_distribution", F.array_join(F.array_sort(entries), ","))


@query(
    "SELECT count(*) AS total_customers, count(DISTINCT segment) AS segment_count, avg(monetary) AS avg_clv FROM v_segments",
    approx=["avg_clv"],
)
def segment_overview(spark, folder):
    return rfm.segment_overview(retail.segment_table(spark, folder))


@query(
    """SELECT segment, count(*) AS customers, avg(monetary) AS avg_clv, avg(frequency) AS avg_frequency, avg(recency) AS avg_recency
       FROM v_segments GROUP BY 1""",
    approx=["avg_clv", "avg_frequency", "avg_recency"],
)
def segment_detail(spark, folder):
    return rfm.segment_detail(retail.segment_table(spark, folder))


# ---------------------------------------------------------------- marketing


@query(
    """SELECT *, 100.0 * clicks / nullif(impressions, 0) AS "CTR", spend / nullif(clicks, 0) AS "CPC",
              1000 * spend / nullif(impressions, 0) AS "CPM", 100.0 * conversions / nullif(clicks, 0) AS conversion_rate,
              (revenue - spend) / nullif(spend, 0) * 100 AS "ROI" FROM v_campaigns""",
    approx=["spend", "revenue", "CTR", "CPC", "CPM", "conversion_rate", "ROI"],
)
def campaign_kpis(spark, folder):
    return marketing.campaign_kpis(views.marketing(spark, folder))


@query("SELECT * FROM v_campaign_performance", digits=2, approx=["spend", "revenue", "roi", "amount", "cpa"])
def campaign_performance(spark, folder):
    return marketing.campaign_performance(views.marketing(spark, folder), retail.campaign_sales(spark, folder))


@query(
    """SELECT sum(spend) AS total_spend, avg(roi) AS avg_roi, CAST(sum(orders) AS BIGINT) AS total_orders, sum(revenue) AS total_revenue
       FROM v_campaign_performance""",
    digits=2,
    approx=["total_spend", "avg_roi", "total_revenue"],
)
def campaign_totals(spark, folder):
    performance = marketing.campaign_performance(views.marketing(spark, folder), retail.campaign_sales(spark, folder))
    return marketing.campaign_totals(performance)


def _segment_performance(spark, folder, spending=None):
    spending = views.marketing(spark, folder) if spending is None else spending
    return marketing.segment_performance(retail.sales(spark, folder), retail.assigned_segments(spark, folder), spending, revenue="amount")


@query(
    "SELECT * FROM v_segment_performance",
    digits=2,
    approx=["revenue", "avg_order_value", "conversion_rate", "spend", "ROI"],
)
def segment_performance(spark, folder):
    return _segment_performance(spark, folder)


@query("SELECT * FROM v_daily_marketing", approx=["spend", "campaign_revenue", "CTR", "CPC"])
def daily_marketing(spark, folder):
    return marketing.daily_marketing(views.marketing(spark, folder))


@query("SELECT * FROM v_daily_orders", digits=2, approx=["sales_revenue"])
def daily_orders(spark, folder):
    return marketing.daily_orders(retail.sales(spark, folder), revenue="amount")


def _daily(spark, folder, spending=None):
    spending = views.marketing(spark, folder) if spending is None else spending
    return marketing.temporal_trends(spending, retail.sales(spark, folder), revenue="amount")


@query(
    "SELECT * FROM v_daily",
    digits=2,
    approx=["spend", "campaign_revenue", "CTR", "CPC", "sales_revenue", "total_revenue"],
)
def temporal_trends(spark, folder):
    return _daily(spark, folder)


_TOTALS_SQL = """SELECT CAST(sum(impressions) AS BIGINT) AS total_impressions, CAST(sum(clicks) AS BIGINT) AS total_clicks,
              sum(spend) AS total_spend, CAST(sum(conversions) AS BIGINT) AS total_conversions, sum(revenue) AS total_revenue,
              coalesce(100.0 * sum(clicks) / nullif(sum(impressions), 0), 0) AS avg_ctr,
              coalesce((sum(revenue) - sum(spend)) / nullif(sum(spend), 0) * 100, 0) AS avg_roi FROM v_campaigns"""


@query(_TOTALS_SQL, approx=["total_spend", "total_revenue", "avg_ctr", "avg_roi"])
def kpi_totals(spark, folder):
    return marketing.kpi_totals(marketing.campaign_kpis(views.marketing(spark, folder)))


@query(
    """SELECT arg_max(segment, "ROI") AS best_segment, max("ROI") AS "best_ROI", arg_min(segment, "ROI") AS worst_segment,
              min("ROI") AS "worst_ROI" FROM v_segment_performance""",
    digits=2,
    approx=["best_ROI", "worst_ROI"],
)
def best_worst_segment(spark, folder):
    return marketing.best_worst(_segment_performance(spark, folder), "segment", "ROI")


_TREND_SQL = """SELECT days, overall_mean, recent_mean, (recent_mean / overall_mean - 1) * 100 AS pct_above,
              days > 30 AND recent_mean > overall_mean * 1.2 AS is_rising FROM (
         SELECT count(*) AS days, avg(total_revenue) AS overall_mean,
                (SELECT avg(total_revenue) FROM (SELECT total_revenue FROM v_daily ORDER BY date DESC LIMIT 7)) AS recent_mean
         FROM v_daily)"""


@query(_TREND_SQL, digits=2, approx=["overall_mean", "recent_mean", "pct_above"])
def trend_signal(spark, folder):
    return marketing.trend_signal(stage(_daily(spark, folder), "daily"), "total_revenue")


# ---------------------------------------------------------------- products and value


@query("SELECT category, count(*) AS count FROM v_wide GROUP BY 1")
def value_counts(spark, folder):
    return products.value_counts(retail.product_sales(spark, folder), "category")


@query(
    "SELECT gender, 100.0 * count(*) / (SELECT count(gender) FROM v_customers) AS pct FROM v_customers WHERE gender IS NOT NULL GROUP BY 1",
    approx=["pct"],
)
def value_shares(spark, folder):
    return products.value_counts(views.customers(spark, folder), "gender", normalize=True)


@query("SELECT segment, gender_first, count(*) AS count FROM v_segments GROUP BY 1, 2")
def group_size_gender(spark, folder):
    return products.group_size(retail.segment_table(spark, folder), "segment", "gender_first")


@query(
    """SELECT segment, city_first, count, CAST(rank AS INTEGER) AS rank FROM (
         SELECT segment, city_first, count(*) AS count, row_number() OVER (PARTITION BY segment ORDER BY count(*) DESC, city_first) AS rank
         FROM v_segments GROUP BY 1, 2) WHERE rank <= 3"""
)
def top_cities(spark, folder):
    return products.top_per_group(retail.segment_table(spark, folder), "segment", "city_first")


@query(
    " UNION ALL ".join(
        f"SELECT segment, '{a}' AS attribute, CAST({a} AS VARCHAR) AS value, count(order_id) AS orders FROM v_wide WHERE {a} IS NOT NULL GROUP BY 1, 3"
        for a in ("category", "style", "size", "color")
    )
)
def product_preferences(spark, folder):
    return products.product_preferences(retail.product_sales(spark, folder))


@query("SELECT segment, avg(price) AS mean, median(price) AS median, count(price) AS count FROM v_wide GROUP BY 1", approx=["mean"])
def basket_stats(spark, folder):
    return products.basket_stats(retail.with_segment(retail.sales(spark, folder)))


@query(
    """SELECT segment, sum(spent) AS total_revenue, avg(spent) AS avg_revenue, median(spent) AS median_revenue,
              count(*) AS customer_count, sum(spent) / (SELECT sum(amount) FROM v_sales) * 100 AS revenue_pct
       FROM (SELECT a.segment, coalesce(r.monetary, 0) AS spent FROM v_assigned a LEFT JOIN v_rfm r ON a.customer_id = r.customer_id)
       GROUP BY 1""",
    digits=2,
    approx=["total_revenue", "avg_revenue", "median_revenue", "revenue_pct"],
)
def segment_value(spark, folder):
    return products.segment_value(retail.assigned_segments(spark, folder), retail.sales(spark, folder))


@query(
    """SELECT CAST(customer_id % 5 AS INTEGER) AS segment,
              avg(CAST((SELECT max(signup_date) FROM v_customers) - signup_date AS INTEGER)) AS avg_tenure_days FROM v_customers GROUP BY 1""",
    approx=["avg_tenure_days"],
)
def segment_tenure(spark, folder):
    return products.segment_tenure(retail.with_segment(views.customers(spark, folder)))


@query("SELECT DISTINCT price FROM v_orders")
def distinct_prices(spark, folder):
    return products.distinct_values(views.orders(spark, folder), "price")


@query("SELECT count(DISTINCT customer_id) AS customer_id_distinct, count(DISTINCT product_id) AS product_id_distinct FROM v_orders")
def count_distinct(spark, folder):
    return products.count_distinct(views.orders(spark, folder), "customer_id", "product_id")


@query(
    """SELECT v.*, c.name, c.age, c.gender, c.city, c.signup_date, a.segment FROM v_clv v
       LEFT JOIN v_customers c ON v.customer_id = c.customer_id LEFT JOIN v_assigned a ON v.customer_id = a.customer_id""",
    digits=2,
    approx=["total_margin", "avg_order_value", "clv"],
)
def clv_margin(spark, folder):
    return value.clv_margin(
        retail.sales(spark, folder),
        customers=views.customers(spark, folder),
        segments=retail.assigned_segments(spark, folder),
    )


@query(
    """SELECT customer_id, avg(amount) AS avg_order_value, count(order_date) AS total_orders,
              count(order_date) / (SELECT greatest(CAST(max(order_date) - min(order_date) AS INTEGER) / CAST(365 AS DOUBLE), 0.1) FROM v_sales) AS purchase_frequency,
              avg(amount) * (count(order_date) / (SELECT greatest(CAST(max(order_date) - min(order_date) AS INTEGER) / CAST(365 AS DOUBLE), 0.1) FROM v_sales))
                * (1 / CAST(0.3 AS DOUBLE)) * 3 AS clv
       FROM v_sales GROUP BY 1""",
    digits=2,
    approx=["avg_order_value", "purchase_frequency", "clv"],
)
def clv_projected(spark, folder):
    return value.clv_projected(retail.sales(spark, folder), date="order_date")


@query(
    "SELECT customer_id, clv, purchase_freq, avg_order_value FROM v_clv ORDER BY clv DESC, customer_id LIMIT 10",
    digits=2,
    approx=["clv", "avg_order_value"],
)
def top_customers(spark, folder):
    clv = value.clv_margin(retail.sales(spark, folder))
    return value.top_customers(clv).select("customer_id", "clv", "purchase_freq", "avg_order_value")


# ---------------------------------------------------------------- distributions


def _box_sql(source: str, column: str, measure: str) -> str:
    return f"""SELECT b.segment, '{measure}' AS measure, q[1] AS "min", q[2] AS q1, q[3] AS median, q[4] AS q3, q[5] AS "max",
               min(CAST({column} AS DOUBLE)) FILTER (WHERE {column} >= q[2] - 1.5 * (q[4] - q[2])) AS whisker_low,
               max(CAST({column} AS DOUBLE)) FILTER (WHERE {column} <= q[4] + 1.5 * (q[4] - q[2])) AS whisker_high
        FROM {source} s JOIN (SELECT segment, quantile_cont(CAST({column} AS DOUBLE), [0, 0.25, 0.5, 0.75, 1]) AS q FROM {source} GROUP BY 1) b
        ON s.segment = b.segment GROUP BY b.segment, q"""


_BOX = ["min", "q1", "median", "q3", "max", "whisker_low", "whisker_high"]


@query(
    " UNION ALL ".join(_box_sql("v_segments", c, c) for c in ("recency", "frequency", "monetary", "age_first")),
    approx=_BOX,
)
def box_stats(spark, folder):
    return stats.box_stats(retail.staged_segments(spark, folder), ["recency", "frequency", "monetary", "age_first"], "segment")


@query(_box_sql("v_scores", "churn_probability", "churn_probability"))
def churn_spread(spark, folder):
    return stats.box_stats(retail.churn_probabilities(spark, folder), ["churn_probability"], "segment")


def _histogram_sql(source: str, column: str, by: str | None) -> str:
    groups, bins = (f"g.{by}, ", f"(SELECT DISTINCT {by} FROM {source}) g, ") if by else ("", "")
    match = f"AND s.{by} = g.{by}" if by else ""
    return f"""SELECT {groups}CAST(b.bin AS INTEGER) AS bin, low + b.bin * (high - low) / 20 AS bin_low, low + (b.bin + 1) * (high - low) / 20 AS bin_high,
               count(s.{column}) AS count, mean, median
        FROM {bins}(SELECT unnest(range(20)) AS bin) b
        JOIN (SELECT min({column}) AS low, max({column}) AS high, avg({column}) AS mean, median({column}) AS median FROM {source}) e ON true
        LEFT JOIN {source} s ON least(floor(20 * (s.{column} - low) / (high - low)), 19) = b.bin {match}
        GROUP BY {groups}b.bin, low, high, mean, median"""


@query(_histogram_sql("v_scores", "churn_probability", None), approx=["bin_low", "bin_high", "mean"])
def histogram(spark, folder):
    return stats.histogram(retail.churn_probabilities(spark, folder), "churn_probability")


@query(_histogram_sql("v_customers", "age", "gender"), approx=["bin_low", "bin_high", "mean"])
def histogram_by_gender(spark, folder):
    return stats.histogram(views.customers(spark, folder), "age", by="gender")


_NUMBERS = ["recency", "frequency", "monetary", "age"]


def _matrix_sql(pair) -> str:
    parts = []
    for i, a in enumerate(_NUMBERS):
        parts.append(f"SELECT '{a}' AS row_name, '{a}' AS column_name, CAST(1 AS DOUBLE) AS correlation")
        for b in _NUMBERS[i + 1 :]:
            parts.append(
                f"SELECT unnest(['{a}', '{b}']) AS row_name, unnest(['{b}', '{a}']) AS column_name, correlation FROM ({pair(a, b)})"
            )
    return " UNION ALL ".join(parts)


def _spearman_sql(a: str, b: str) -> str:
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / CAST(2 AS DOUBLE) AS r{c}" for c in (a, b))
    return f"SELECT corr(r{a}, r{b}) AS correlation FROM (SELECT {ranks} FROM v_facts WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"


def _kendall_sql(a: str, b: str) -> str:
    known = f"(SELECT customer_id, {a}, {b} FROM v_facts WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    return f"""SELECT sum(sign(p.{a} - q.{a}) * sign(p.{b} - q.{b}))
                 / sqrt(CAST(sum(abs(sign(p.{a} - q.{a}))) AS DOUBLE) * sum(abs(sign(p.{b} - q.{b})))) AS correlation
               FROM {known} p JOIN {known} q ON p.customer_id < q.customer_id"""


@query(_matrix_sql(lambda a, b: f"SELECT corr({a}, {b}) AS correlation FROM v_facts"), approx=["correlation"])
def correlation_pearson(spark, folder):
    return stats.correlation(retail.numeric_facts(spark, folder), _NUMBERS)


@query(_matrix_sql(_spearman_sql), approx=["correlation"])
def correlation_spearman(spark, folder):
    return stats.correlation(retail.numeric_facts(spark, folder), _NUMBERS, "spearman")


@query(_matrix_sql(_kendall_sql), approx=["correlation"])
def correlation_kendall(spark, folder):
    return stats.correlation(retail.numeric_facts(spark, folder), _NUMBERS, "kendall")


# ---------------------------------------------------------------- clusters and models


@query(
    "SELECT customer_id, "
    + ", ".join(f"({c} - (SELECT avg({c}) FROM v_rfm)) / (SELECT stddev_pop({c}) FROM v_rfm) AS {c}_z" for c in FEATURES)
    + " FROM v_rfm",
    approx=[f"{c}_z" for c in FEATURES],
)
def standardise(spark, folder):
    scaled = clustering.standardise(retail.staged_rfm(spark, folder), FEATURES)
    return scaled.select("customer_id", *[f"{c}_z" for c in FEATURES])


@query()
def kmeans_segments(spark, folder):
    segmented, _ = clustering.kmeans_segments(rfm.rfm_scores(retail.staged_rfm(spark, folder)))
    return segmented


@query()
def kmeans_quality(spark, folder):
    """One row: inertia of the best start and silhouette."""
    segmented, model = clustering.kmeans_segments(retail.staged_rfm(spark, folder), k=4)
    scaled = clustering.standardise(segmented, FEATURES)
    found = clustering.silhouette(scaled, [f"{c}_z" for c in FEATURES])
    return found.select(F.lit(clustering.inertia(model)).alias("inertia"), "silhouette")


@query(
    f"""WITH distances AS (
          SELECT a.customer_id, a.segment AS own, b.segment AS other, sum({' + '.join(f'(a.{c} - b.{c}) ** 2' for c in FEATURES)}) AS d,
                 count(*) AS n
          FROM v_scored a, v_scored b GROUP BY 1, 2, 3),
        parts AS (
          SELECT customer_id, max(CASE WHEN own = other THEN d / nullif(n - 1, 0) END) AS inside,
                 min(CASE WHEN own <> other THEN d / n END) AS outside
          FROM distances GROUP BY 1)
        SELECT avg(CASE WHEN inside IS NULL OR outside IS NULL THEN 0
                        ELSE coalesce((outside - inside) / nullif(greatest(outside, inside), 0), 0) END) AS silhouette FROM parts""",
    approx=["silhouette"],
)
def silhouette(spark, folder):
    return clustering.silhouette(retail.scored(spark, folder), FEATURES)


# Four groups of customers, far apart: 1000 in each measure against less than 10 inside a group.
_GROUPED = """SELECT c_custkey AS customer_id, CAST(c_custkey % 4 * 1000 + c_custkey % 7 AS DOUBLE) AS recency,
                     CAST(c_custkey % 4 * 1000 + c_custkey % 5 AS DOUBLE) AS frequency,
                     CAST(c_custkey % 4 * 1000 + c_custkey % 3 AS DOUBLE) AS monetary FROM customer"""


def _grouped(spark, folder):
    key = F.col("c_custkey")
    value = {c: (key % 4 * 1000 + key % n).cast("double") for c, n in zip(FEATURES, (7, 5, 3))}
    people = spark.read.parquet(f"{folder}/customer.parquet")
    return people.select(key.alias("customer_id"), *[v.alias(c) for c, v in value.items()])


@query(f"SELECT *, CAST(customer_id % 4 AS VARCHAR) AS segment FROM ({_GROUPED})")
def kmeans_known_groups(spark, folder):
    segmented, _ = clustering.kmeans_segments(_grouped(spark, folder), FEATURES, k=4)
    return segmented


@query(
    "SELECT CAST(customer_id % 4 AS VARCHAR) AS segment, "
    + ", ".join(
        f"avg({c}) AS {c}_mean, median({c}) AS {c}_median, stddev_samp({c}) AS {c}_std, count({c}) AS {c}_count, avg({c}) AS {c}_center"
        for c in FEATURES
    )
    + f" FROM ({_GROUPED}) GROUP BY 1",
    approx=[f"{c}_{n}" for c in FEATURES for n in ("mean", "std", "center")],
)
def segment_report(spark, folder):
    return clustering.segment_and_report(_grouped(spark, folder), FEATURES, k=4)[2]


_SCALED = (
    "SELECT segment, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in FEATURES)
    + f" FROM (SELECT *, customer_id % 4 AS segment FROM ({_GROUPED}))"
)


@query(
    f"""WITH scaled AS ({_SCALED}),
        centres AS (SELECT segment, count(*) AS n, {', '.join(f'avg({c}) AS m_{c}' for c in FEATURES)} FROM scaled GROUP BY 1)
        SELECT count(*) AS rows, count(DISTINCT s.segment) AS clusters,
               sum({' + '.join(f'(s.{c} - k.m_{c}) ** 2' for c in FEATURES)}) AS inertia
        FROM scaled s JOIN centres k ON s.segment = k.segment""",
    approx=["inertia"],
)
def segment_report_quality(spark, folder):
    return clustering.segment_and_report(_grouped(spark, folder), FEATURES, k=4)[1].select("rows", "clusters", "inertia")


_CENTRES = "SELECT segment, count(*) AS n, " + ", ".join(f"avg({c}) AS m_{c}" for c in FEATURES) + " FROM v_scored GROUP BY 1"


@query(
    f"""SELECT rows, clusters, inertia, between_ * (rows - clusters) / (inertia * (clusters - 1)) AS calinski_harabasz FROM (
          SELECT count(*) AS rows, count(DISTINCT s.segment) AS clusters,
                 sum({' + '.join(f'(s.{c} - k.m_{c}) ** 2' for c in FEATURES)}) AS inertia,
                 sum({' + '.join(f'(k.m_{c} - (SELECT avg({c}) FROM v_scored)) ** 2' for c in FEATURES)}) AS between_
          FROM v_scored s JOIN ({_CENTRES}) k ON s.segment = k.segment)""",
    digits=3,
    approx=["inertia", "calinski_harabasz"],
)
def cluster_dispersion(spark, folder):
    found = clustering.cluster_dispersion(retail.scored(spark, folder), FEATURES)
    return found


@query(
    f"""WITH centres AS ({_CENTRES}), spreads AS (
          SELECT s.segment, avg(sqrt({' + '.join(f'(s.{c} - k.m_{c}) ** 2' for c in FEATURES)})) AS spread
          FROM v_scored s JOIN centres k ON s.segment = k.segment GROUP BY 1)
        SELECT avg(worst) AS davies_bouldin FROM (
          SELECT a.segment, max((x.spread + y.spread) / sqrt({' + '.join(f'(a.m_{c} - b.m_{c}) ** 2' for c in FEATURES)})) AS worst
          FROM centres a JOIN centres b ON a.segment <> b.segment JOIN spreads x ON x.segment = a.segment
          JOIN spreads y ON y.segment = b.segment GROUP BY 1)""",
    approx=["davies_bouldin"],
)
def davies_bouldin(spark, folder):
    return clustering.davies_bouldin(retail.scored(spark, folder), FEATURES)


@query(
    "SELECT segment, " + ", ".join(f"avg({c}) AS {c}_center" for c in FEATURES) + " FROM v_scored GROUP BY 1",
    approx=[f"{c}_center" for c in FEATURES],
)
def cluster_centers(spark, folder):
    return clustering.cluster_centers(retail.scored(spark, folder), FEATURES)


@query("SELECT * FROM v_churn_rows", digits=2, approx=["monetary"])
def churn_dataset(spark, folder):
    return retail.churn_rows(spark, folder)


@query("SELECT churn, count(*) AS count, 100.0 * count(*) / (SELECT count(*) FROM v_churn) AS pct FROM v_churn GROUP BY 1", approx=["pct"])
def label_distribution(spark, folder):
    return churn.label_distribution(churn.churn_labels(retail.sales(spark, folder), retail.CHURN_AS_OF))


@query(
    """WITH classes AS (SELECT churn, count(*) AS n FROM v_churn GROUP BY 1),
            shares AS (SELECT churn, n, n * t / s AS fair, t FROM classes,
                       (SELECT CAST(sum(n) AS DOUBLE) AS s, ceil(sum(n) * CAST(0.3 AS DOUBLE)) AS t FROM classes)),
            quotas AS (SELECT churn, n, floor(fair) + CASE WHEN row_number() OVER (ORDER BY fair - floor(fair) DESC, churn)
                         <= t - sum(floor(fair)) OVER () THEN 1 ELSE 0 END AS quota FROM shares)
       SELECT churn, 'test' AS split, CAST(quota AS BIGINT) AS count FROM quotas
       UNION ALL SELECT churn, 'train', CAST(n - quota AS BIGINT) FROM quotas"""
)
def stratified_split(spark, folder):
    rows = stage(churn.churn_labels(retail.sales(spark, folder), retail.CHURN_AS_OF), "churn-labels")
    return churn.stratified_split(rows).groupBy("churn", "split").agg(F.count("*").alias("count"))


def _split_rows(spark, folder, test_fraction):
    """Training and test rows as model input, from a stored split so that models do not recompute it."""
    rows = stage(retail.churn_rows(spark, folder), "churn-rows")
    features = churn.churn_features(rows)
    path = scratch_path(spark, "churn-split")
    churn.stratified_split(rows, test_fraction=test_fraction).write.parquet(path)
    split = spark.read.parquet(path)
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    return churn.model_input(train, features), churn.model_input(test, features, train), split, features


@query()
def random_forest_scores(spark, folder):
    train, test, _, features = _split_rows(spark, folder, 0.3)
    scored = churn.score(churn.train_random_forest(train, features), test)
    return scored.select("customer_id", "churn", "predicted", "churn_probability")


@query()
def boosted_trees_scores(spark, folder):
    train, test, _, features = _split_rows(spark, folder, 0.2)
    scored = churn.score(churn.train_boosted_trees(train, features), test)
    return scored.select("customer_id", "churn", "predicted", "churn_probability")


@query()
def feature_importance(spark, folder):
    train, _, _, features = _split_rows(spark, folder, 0.3)
    return churn.feature_importance(churn.train_random_forest(train, features), train, features, top=20)


@query()
def churn_scores(spark, folder):
    """Scores for all customers, written and read back as the table other reports join."""
    train, _, split, features = _split_rows(spark, folder, 0.3)
    everyone = churn.model_input(split, features, split.filter("split = 'train'"))
    scores = churn.churn_scores(churn.train_random_forest(train, features), everyone)
    return spark.read.parquet(delimited.write_table(scores, scratch_path(spark, "churn-scores")))


@query(
    """SELECT count(*) AS customers, count(*) FILTER (WHERE churn_probability >= 0.5) AS at_risk_count,
              100.0 * count(*) FILTER (WHERE churn_probability >= 0.5) / count(*) AS at_risk_pct, avg(churn_probability) * 100 AS avg_risk_pct
       FROM v_scores""",
    approx=["at_risk_pct", "avg_risk_pct"],
)
def churn_risk_summary(spark, folder):
    return churn.churn_risk_summary(retail.churn_probabilities(spark, folder))


# Churn that follows from one measure alone, with a gap around the threshold: models must find it for every customer.
_SEPARABLE = """SELECT c_custkey AS customer_id, CAST(c_custkey * 7919 % 1000 + CASE WHEN c_custkey * 7919 % 1000 >= 600 THEN 500 ELSE 0 END AS DOUBLE) AS recency,
                       CAST(c_custkey % 13 AS DOUBLE) AS frequency, CAST(c_custkey % 29 AS DOUBLE) AS monetary,
                       CAST(c_custkey * 7919 % 1000 >= 600 AS INTEGER) AS churn FROM customer"""


FINE = {"max_bins": 512}  # quantiles close enough that one falls into the gap


def separable(spark, folder):
    key, late = F.col("c_custkey"), F.col("c_custkey") * 7919 % 1000
    return spark.read.parquet(f"{folder}/customer.parquet").select(
        key.alias("customer_id"),
        (late + F.when(late >= 600, 500).otherwise(0)).cast("double").alias("recency"),
        (key % 13).cast("double").alias("frequency"),
        (key % 29).cast("double").alias("monetary"),
        (late >= 600).cast("int").alias("churn"),
    )


def _separable_input(spark, folder):
    rows = stage(separable(spark, folder), "separable")
    return stage(spread_rows(churn.model_input(rows, FEATURES), churn.TASK_ROWS, rows.count()), "separable-input")


@query(f"SELECT customer_id, churn, churn AS predicted FROM ({_SEPARABLE})")
def random_forest_known_labels(spark, folder):
    rows = _separable_input(spark, folder)
    return churn.score(churn.train_random_forest(rows, FEATURES, **FINE), rows).select("customer_id", "churn", "predicted")


@query(f"SELECT customer_id, churn, churn AS predicted FROM ({_SEPARABLE})")
def boosted_trees_known_labels(spark, folder):
    """With the deeper trees and the faster rate of the second parameter set."""
    rows = _separable_input(spark, folder)
    model = churn.train_boosted_trees(rows, FEATURES, max_depth=6, rate=0.3, **FINE)
    return churn.score(model, rows).select("customer_id", "churn", "predicted")


@query("SELECT 'recency' AS feature")
def leading_feature(spark, folder):
    rows = _separable_input(spark, folder)
    return churn.feature_importance(churn.train_random_forest(rows, FEATURES, **FINE), rows, FEATURES, top=1).select("feature")


@query(f"SELECT customer_id, CASE WHEN churn = 1 THEN 'high' ELSE 'low' END AS churn_risk FROM ({_SEPARABLE})")
def churn_scores_known_labels(spark, folder):
    rows = _separable_input(spark, folder)
    model = churn.train_boosted_trees(rows, FEATURES, **FINE)
    return churn.churn_scores(model, rows).select("customer_id", "churn_risk")


_TEST_SHARE = f"""SELECT sum(CASE WHEN churn = 1 THEN n ELSE 0 END) AS churned, sum(n) AS n FROM (
    SELECT churn, floor(fair) + CASE WHEN row_number() OVER (ORDER BY fair - floor(fair) DESC, churn) <= t - sum(floor(fair)) OVER () THEN 1 ELSE 0 END AS n
    FROM (SELECT churn, count(*) * any_value(t) / any_value(s) AS fair, any_value(t) AS t FROM ({_SEPARABLE}),
          (SELECT CAST(count(*) AS DOUBLE) AS s, ceil(count(*) * CAST(0.3 AS DOUBLE)) AS t FROM customer) GROUP BY churn))"""


@query(
    f"""SELECT model, CAST(n AS BIGINT) AS rows, CAST(1 AS DOUBLE) AS accuracy, CAST(1 AS DOUBLE) AS f1, CAST(1 AS DOUBLE) AS roc_auc
        FROM (VALUES ('forest'), ('boosted')) m(model), ({_TEST_SHARE})""",
    approx=["accuracy", "f1", "roc_auc"],
)
def train_and_compare(spark, folder):
    rows = stage(separable(spark, folder), "separable")
    _, measured, _, _ = churn.train_and_compare(rows, FEATURES, forest=FINE, boosted=FINE)
    return measured.select("model", "rows", "accuracy", "f1", "roc_auc")


@query(
    f"""SELECT model, actual, predicted, CAST(CASE WHEN actual <> predicted THEN 0 WHEN actual = 1 THEN churned ELSE n - churned END AS BIGINT) AS count
        FROM (VALUES ('forest'), ('boosted')) m(model), (VALUES (0), (1)) a(actual), (VALUES (0), (1)) p(predicted), ({_TEST_SHARE})"""
)
def compared_confusion(spark, folder):
    rows = stage(separable(spark, folder), "separable")
    return churn.train_and_compare(rows, FEATURES, forest=FINE, boosted=FINE)[2]


_METRICS = ["accuracy", "precision", "recall", "f1", "weighted_precision", "weighted_recall", "weighted_f1"]


@query("SELECT * FROM v_metrics", approx=_METRICS)
def classification_metrics(spark, folder):
    return metrics.classification_metrics(retail.predictions(spark, folder))


@query("SELECT * FROM v_classes", approx=["precision", "recall", "f1"])
def per_class_metrics(spark, folder):
    return metrics.per_class_metrics(retail.predictions(spark, folder))


@query("SELECT arg_max(model, f1) AS model, max(f1) AS f1 FROM v_metrics", approx=["f1"])
def best_model(spark, folder):
    return metrics.best_model(metrics.classification_metrics(retail.predictions(spark, folder)))


@query(
    """SELECT p.model, sum(p.k * n.k * CASE WHEN p.score > n.score THEN 1 WHEN p.score = n.score THEN CAST(0.5 AS DOUBLE) ELSE 0 END) / sum(p.k * n.k) AS roc_auc
       FROM (SELECT model, score, count(*) AS k FROM v_predictions WHERE label = 1 GROUP BY 1, 2) p
       JOIN (SELECT model, score, count(*) AS k FROM v_predictions WHERE label = 0 GROUP BY 1, 2) n ON p.model = n.model GROUP BY 1""",
    approx=["roc_auc"],
)
def roc_auc(spark, folder):
    return metrics.roc_auc(retail.predictions(spark, folder))


_CONFUSION = """SELECT m.model, c.actual, c.predicted, count(p.label) AS count
       FROM (SELECT a AS actual, b AS predicted FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b)) c
       CROSS JOIN (SELECT DISTINCT model FROM v_predictions) m
       LEFT JOIN v_predictions p ON p.model = m.model AND p.label = c.actual AND p.predicted = c.predicted GROUP BY 1, 2, 3"""


@query(_CONFUSION)
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(retail.predictions(spark, folder), by="model")


@query("SELECT model, avg(label) AS actual_rate, avg(predicted) AS predicted_rate FROM v_predictions GROUP BY 1", approx=["actual_rate", "predicted_rate"])
def churn_rates(spark, folder):
    return metrics.churn_rates(metrics.confusion_matrix(retail.predictions(spark, folder), by="model"), by="model")


# ---------------------------------------------------------------- rules


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(
    f"""SELECT segment, CASE WHEN specific <> '' THEN specific ELSE
                replace({_quote('|'.join(advice.GENERIC))}, '%s', CAST(segment AS VARCHAR)) END AS recommendations
        FROM (SELECT segment, concat_ws('|', CASE WHEN median(recency) > 180 THEN {_quote(advice.REACTIVATE)}
                                                  WHEN median(frequency) > 10 THEN {_quote(advice.LOYALTY)} END,
                                        CASE WHEN median(monetary) > (SELECT quantile_cont(monetary, 0.75) FROM v_segments) THEN {_quote(advice.VIP)} END) AS specific
              FROM v_segments GROUP BY 1)"""
)
def segment_recommendations(spark, folder):
    found = advice.segment_recommendations(retail.staged_segments(spark, folder))
    return found.withColumn("recommendations", F.array_join("recommendations", "|"))


def _strategy_sql(part: str) -> str:
    rare = f"CASE WHEN avg_purchase_freq < 1 THEN {_quote(advice.RARE_BUYERS[part])} END"
    weak = f"CASE WHEN avg_rfm_score < 5 THEN {_quote(advice.LOW_SCORE[part])} END"
    if part == "kpi":
        return f"concat_ws('|', {rare}, {weak})"
    lead = f"CASE WHEN valuable THEN {_quote(advice.HIGH_VALUE[part])} ELSE {_quote(advice.LOWER_VALUE[part])} END"
    return f"concat_ws('|', {lead}, {rare}, {weak})"


@query(
    f"""SELECT segment, {_strategy_sql('objective')} AS objectives,
               CASE WHEN valuable THEN {_quote('|'.join(advice.HIGH_VALUE['channels']))} ELSE {_quote('|'.join(advice.LOWER_VALUE['channels']))} END AS channels,
               {_strategy_sql('action')} AS actions, avg_clv * CASE WHEN valuable THEN CAST(0.2 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END AS budget,
               {_strategy_sql('kpi')} AS kpis
        FROM (SELECT *, avg_clv > (SELECT avg(avg_clv) FROM v_characteristics) AS valuable FROM v_characteristics)""",
    approx=["budget"],
)
def segment_strategies(spark, folder):
    found = advice.segment_strategies(rfm.segment_characteristics(retail.staged_segments(spark, folder)))
    return found.withColumns({c: F.array_join(c, "|") for c in ("objectives", "channels", "actions", "kpis")})


def _rule_sql(position: int, rule: str, source: str, subject: str, amount: str, applies: str) -> str:
    return (
        f"SELECT {position} AS position, '{rule}' AS rule, {_quote(advice.CAMPAIGN_TITLES[rule])} AS title, "
        f"CAST({subject} AS VARCHAR) AS subject, {amount} AS value FROM ({source}) WHERE {applies}"
    )


_ENDS_SQL = """SELECT arg_max(segment, "ROI") AS best, max("ROI") AS high, arg_min(segment, "ROI") AS worst, min("ROI") AS low
               FROM v_segment_performance"""


@query(
    " UNION ALL ".join(
        [
            _rule_sql(1, "low_roi", _TOTALS_SQL, "NULL", "avg_roi", "avg_roi < 100"),
            _rule_sql(2, "low_ctr", _TOTALS_SQL, "NULL", "avg_ctr", "avg_ctr < 2"),
            _rule_sql(3, "best_segment", _ENDS_SQL, "best", "high", "true"),
            _rule_sql(4, "worst_segment", _ENDS_SQL, "worst", "low", "true"),
            _rule_sql(5, "rising_sales", _TREND_SQL, "NULL", "pct_above", "is_rising"),
        ]
    ),
    digits=2,
    approx=["value"],
)
def campaign_recommendations(spark, folder):
    spending = stage(views.marketing(spark, folder), "marketing")  # one row per campaign and day
    campaigns = stage(marketing.campaign_kpis(spending), "campaigns")
    segments = stage(_segment_performance(spark, folder, spending), "segment-performance")
    return advice.campaign_recommendations(campaigns, segments, stage(_daily(spark, folder, spending), "daily"))


@query(
    "SELECT s.segment, p.objective, p.actions, p.channels FROM (SELECT DISTINCT segment FROM v_assigned) s LEFT JOIN (VALUES "
    + ", ".join(f"({n}, {_quote(o)}, {_quote('|'.join(a))}, {_quote('|'.join(c))})" for n, o, a, c in advice.PLAYBOOK)
    + ") p(number, objective, actions, channels) ON s.segment = p.number"
)
def segment_playbook(spark, folder):
    found = advice.segment_playbook(retail.assigned_segments(spark, folder))
    return found.withColumns({c: F.array_join(c, "|") for c in ("actions", "channels")})


@query("SELECT CAST(customer_id % 5 AS INTEGER) AS segment, median(monetary) AS monetary_median FROM v_rfm GROUP BY 1", digits=2, approx=["monetary_median"])
def median_by_segment(spark, folder):
    return medians(retail.with_segment(retail.staged_rfm(spark, folder)), ["monetary"], ["segment"])
