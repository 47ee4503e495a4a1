"""SQL views shared by the check queries (DuckDB dialect)."""

from __future__ import annotations

import re
from collections.abc import Sequence

VIEWS: dict[str, str] = {
    "v_products": """
        SELECT p_partkey AS product_id, p_type AS category, p_brand AS style, p_size AS size,
               split_part(p_name, ' ', 1) AS color, p_retailprice AS base_price
        FROM part""",
    "v_orders": """
        SELECT l.l_orderkey * 10 + l.l_linenumber AS order_id, o.o_custkey AS customer_id, l.l_partkey AS product_id,
               l.l_quantity AS quantity,
               CASE WHEN l.l_linenumber <> 3 THEN l.l_extendedprice / l.l_quantity END AS price,
               CAST(o.o_orderdate AS DATE) AS order_date
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "v_customers": """
        SELECT c_custkey AS customer_id, c_name AS name,
               CASE WHEN c_custkey % 17 <> 0 THEN CAST(10 + c_custkey % 95 AS DOUBLE) END AS age,
               c_mktsegment AS gender, n_name AS city,
               CAST(DATE '1994-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS DATE) AS signup_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_marketing": """
        SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 20 AS campaign_id, CAST(ts AS DATE) AS date,
               CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS impressions,
               CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
               CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS conversions,
               sum(CASE WHEN event_type <> 'purchase' THEN value ELSE 0 END) AS spend,
               sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS revenue
        FROM events GROUP BY 1, 2""",
    "v_sales": """
        SELECT o.order_id, o.customer_id, o.product_id, o.quantity, coalesce(o.price, p.base_price) AS price, o.order_date,
               o.quantity * coalesce(o.price, p.base_price) AS amount
        FROM v_orders o LEFT JOIN v_products p ON o.product_id = p.product_id""",
    "v_rfm": """
        SELECT customer_id, CAST((SELECT max(order_date) FROM v_sales) - max(order_date) AS INTEGER) AS recency,
               count(*) AS frequency, sum(amount) AS monetary
        FROM v_sales GROUP BY customer_id""",
    "v_edges": """
        SELECT quantile_cont(CAST(recency AS DOUBLE), [0, 0.2, 0.4, 0.6000000000000001, 0.8, 1.0]) AS r,
               quantile_cont(CAST(frequency AS DOUBLE), [0, 0.2, 0.4, 0.6000000000000001, 0.8, 1.0]) AS f,
               quantile_cont(monetary, [0, 0.2, 0.4, 0.6000000000000001, 0.8, 1.0]) AS m
        FROM v_rfm""",
    "v_scored": """
        SELECT *, CAST("R" + "F" + "M" AS INTEGER) AS "RFM_Score", CAST(customer_id % 5 AS INTEGER) AS segment FROM (
          SELECT customer_id, recency, frequency, monetary,
                 CASE WHEN len(list_distinct(r)) < 6 THEN 3 WHEN recency <= r[2] THEN 5 WHEN recency <= r[3] THEN 4
                      WHEN recency <= r[4] THEN 3 WHEN recency <= r[5] THEN 2 ELSE 1 END AS "R",
                 CASE WHEN len(list_distinct(f)) < 6 THEN 3 WHEN frequency <= f[2] THEN 1 WHEN frequency <= f[3] THEN 2
                      WHEN frequency <= f[4] THEN 3 WHEN frequency <= f[5] THEN 4 ELSE 5 END AS "F",
                 CASE WHEN len(list_distinct(m)) < 6 THEN 3 WHEN monetary <= m[2] THEN 1 WHEN monetary <= m[3] THEN 2
                      WHEN monetary <= m[4] THEN 3 WHEN monetary <= m[5] THEN 4 ELSE 5 END AS "M"
          FROM v_rfm, v_edges)""",
    "v_segments": """
        SELECT s.customer_id, s.segment, s.recency, s.frequency, s.monetary, s."RFM_Score",
               c.age AS age_first, c.gender AS gender_first, c.city AS city_first
        FROM v_scored s JOIN v_customers c ON s.customer_id = c.customer_id""",
    "v_assigned": "SELECT customer_id, CAST(customer_id % 5 AS INTEGER) AS segment FROM v_customers",
    "v_wide": """
        SELECT o.order_id, o.customer_id, o.product_id, o.quantity, o.price, o.order_date, o.amount,
               p.category, p.style, p.size, p.color, p.base_price,
               c.name, c.age, c.gender, c.city, c.signup_date, CAST(o.customer_id % 5 AS INTEGER) AS segment
        FROM v_sales o LEFT JOIN v_products p ON o.product_id = p.product_id
        LEFT JOIN v_customers c ON o.customer_id = c.customer_id""",
    "v_campaigns": """
        SELECT campaign_id, CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
               sum(spend) AS spend, CAST(sum(conversions) AS BIGINT) AS conversions, sum(revenue) AS revenue
        FROM v_marketing GROUP BY 1""",
    "v_campaign_performance": """
        SELECT m.campaign_id, m.spend, m.revenue, (m.revenue - m.spend) / nullif(m.spend, 0) * 100 AS roi,
               s.orders, s.quantity, s.amount, m.spend / nullif(s.orders, 0) AS cpa
        FROM v_campaigns m LEFT JOIN (
          SELECT CAST(order_id % 20 AS INTEGER) AS campaign_id, count(DISTINCT order_id) AS orders,
                 sum(quantity) AS quantity, sum(amount) AS amount
          FROM v_sales GROUP BY 1) s ON m.campaign_id = s.campaign_id""",
    "v_segment_performance": """
        SELECT segment, customers, orders, revenue, revenue / nullif(orders, 0) AS avg_order_value,
               100.0 * orders / nullif(buyers, 0) AS conversion_rate, spend, (revenue - spend) / nullif(spend, 0) * 100 AS "ROI"
        FROM (
          SELECT a.segment, n.customers, count(o.order_id) AS orders, coalesce(sum(o.amount), 0) AS revenue,
                 count(DISTINCT o.customer_id) AS buyers,
                 (SELECT sum(spend) FROM v_marketing) * (n.customers / CAST((SELECT count(*) FROM v_assigned) AS DOUBLE)) AS spend
          FROM v_sales o JOIN v_assigned a ON o.customer_id = a.customer_id
          JOIN (SELECT segment, count(*) AS customers FROM v_assigned GROUP BY 1) n ON a.segment = n.segment
          GROUP BY a.segment, n.customers)""",
    "v_daily_marketing": """
        SELECT date, CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
               sum(spend) AS spend, CAST(sum(conversions) AS BIGINT) AS conversions, sum(revenue) AS campaign_revenue,
               100.0 * sum(clicks) / nullif(sum(impressions), 0) AS "CTR", sum(spend) / nullif(sum(clicks), 0) AS "CPC"
        FROM v_marketing GROUP BY 1""",
    "v_daily_orders": """
        SELECT order_date AS date, count(order_id) AS orders, sum(amount) AS sales_revenue FROM v_sales GROUP BY 1""",
    "v_daily": """
        SELECT coalesce(m.date, o.date) AS date, impressions, clicks, spend, conversions, campaign_revenue, "CTR", "CPC",
               orders, sales_revenue, coalesce(campaign_revenue, 0) + coalesce(sales_revenue, 0) AS total_revenue
        FROM v_daily_marketing m FULL OUTER JOIN v_daily_orders o ON m.date = o.date""",
    "v_facts": """
        SELECT r.customer_id, CAST(r.recency AS DOUBLE) AS recency, CAST(r.frequency AS DOUBLE) AS frequency, r.monetary,
               c.age, c.gender
        FROM v_rfm r LEFT JOIN v_customers c ON r.customer_id = c.customer_id""",
    "v_predictions": """
        SELECT customer_id, 'forest' AS model, CAST(customer_id % 3 = 0 AS INTEGER) AS label,
               CAST(customer_id * 7 % 10 < 4 AS INTEGER) AS predicted, CAST(customer_id * 37 % 101 AS DOUBLE) / 101 AS score
        FROM v_customers
        UNION ALL
        SELECT customer_id, 'boosted', CAST(customer_id % 3 = 0 AS INTEGER),
               CAST(customer_id * 11 % 10 < 6 AS INTEGER), CAST(customer_id * 53 % 101 AS DOUBLE) / 101
        FROM v_customers""",
    "v_classes": """
        SELECT model, class, support, coalesce(hits / nullif(CAST(claimed AS DOUBLE), 0), 0) AS precision,
               coalesce(hits / nullif(CAST(support AS DOUBLE), 0), 0) AS recall,
               coalesce(2 * hits / nullif(CAST(claimed + support AS DOUBLE), 0), 0) AS f1
        FROM (
          SELECT p.model, c.class, count(*) FILTER (WHERE label = class) AS support,
                 count(*) FILTER (WHERE predicted = class) AS claimed,
                 count(*) FILTER (WHERE label = class AND predicted = class) AS hits
          FROM v_predictions p CROSS JOIN (VALUES (0), (1)) c(class) GROUP BY 1, 2)""",
    "v_metrics": """
        SELECT model, CAST(sum(support) AS BIGINT) AS rows, sum(support * recall) / sum(support) AS accuracy,
               max(CASE WHEN class = 1 THEN precision END) AS precision, max(CASE WHEN class = 1 THEN recall END) AS recall,
               max(CASE WHEN class = 1 THEN f1 END) AS f1,
               sum(support * precision) / sum(support) AS weighted_precision,
               sum(support * recall) / sum(support) AS weighted_recall, sum(support * f1) / sum(support) AS weighted_f1
        FROM v_classes GROUP BY 1""",
    "v_churn": """
        SELECT customer_id, CAST(DATE '2001-04-01' - max(CASE WHEN order_date <= DATE '2001-04-01' THEN order_date END) AS INTEGER) AS recency,
               count(CASE WHEN order_date <= DATE '2001-04-01' THEN order_id END) AS frequency,
               coalesce(sum(CASE WHEN order_date <= DATE '2001-04-01' THEN price END), 0) AS monetary,
               min(CASE WHEN order_date > DATE '2001-04-01' THEN 0 ELSE 1 END) AS churn
        FROM v_sales WHERE order_date >= DATE '2000-10-01' AND order_date <= DATE '2001-07-01'
        GROUP BY 1 HAVING min(order_date) <= DATE '2001-04-01'""",
    "v_churn_rows": """
        SELECT h.customer_id, h.recency, h.frequency, h.monetary, h.churn, c.name, c.age, c.signup_date,
               CAST(DATE '2001-04-01' - c.signup_date AS INTEGER) AS tenure,
               CAST(dense_rank() OVER (ORDER BY c.gender) - 1 AS INTEGER) AS gender,
               CAST(dense_rank() OVER (ORDER BY c.city) - 1 AS INTEGER) AS city,
               CAST(dense_rank() OVER (ORDER BY h.customer_id % 5) - 1 AS INTEGER) AS segment
        FROM v_churn h LEFT JOIN v_customers c ON h.customer_id = c.customer_id""",
    "v_clv": """
        SELECT customer_id, min(order_date) AS first_purchase, max(order_date) AS last_purchase, count(order_date) AS purchase_count,
               sum(amount * 0.3) AS total_margin, count(order_date) / CAST(12 AS DOUBLE) AS purchase_freq,
               sum(amount * 0.3) / count(order_date) AS avg_order_value,
               sum(amount * 0.3) / count(order_date) * (count(order_date) / CAST(12 AS DOUBLE)) * 12 AS clv
        FROM v_sales
        WHERE order_date >= CAST((SELECT max(order_date) FROM v_sales) - INTERVAL 12 MONTH AS DATE)
        GROUP BY 1""",
    "v_scores": """
        SELECT customer_id, CAST(customer_id % 5 AS INTEGER) AS segment, CAST(customer_id * 29 % 97 AS DOUBLE) / 97 AS churn_probability
        FROM v_customers""",
    "v_characteristics": """
        SELECT segment, count(*) AS customers, avg(monetary) AS avg_clv, avg(frequency) AS avg_purchase_freq,
               avg(monetary) AS avg_order_value, avg(recency) AS avg_recency, avg("RFM_Score") AS avg_rfm_score,
               avg(age_first) AS avg_age
        FROM v_segments GROUP BY 1""",
}



def tie_shift(digits: int) -> str:
    """Added before rounding on both sides, so that values half way between two decimals do not depend on
    the order of summation."""
    return f"{3.7 * 10.0 ** -(digits + 4):.12f}"


_NAME = re.compile(r"\bv_\w+\b")


def check(body: str, digits: int = 4, rounded: Sequence[str] = ()) -> str:
    """``body`` with the views it needs in front, and the named columns rounded."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if rounded:
        columns = ", ".join(f'round("{c}" + {tie_shift(digits)}, {digits}) AS "{c}"' for c in rounded)
        body = f"SELECT * REPLACE ({columns}) FROM ({body})"
    if not needed:
        return body
    if body.lstrip().startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    # Views that are read more than once are computed once.
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in needed) + "\n" + body
