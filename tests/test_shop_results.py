"""Known results of the small shop."""

import pytest
import shop

from custlens.functions.columns import rounded
from custlens.operators import cleaning, clustering, enrich, marketing, products, rfm, value


@pytest.fixture(scope="module")
def sales(spark):
    return cleaning.price_orders(shop.orders(spark), shop.products(spark)).persist()


def test_price_completion_and_amount(sales):
    found = {r.order_id: (r.price, r.amount) for r in sales.collect()}
    assert len(found) == 24
    for i, (_, quantity) in enumerate(shop.ORDERS):
        assert found[f"O{1001 + i}"] == (30000, 30000 * quantity)


@pytest.mark.parametrize("mode", ["coalesce", "all_missing", "overwrite_if_any"])
def test_three_orders_without_price(spark, mode):
    orders = spark.createDataFrame(
        [("O1", "T1", 2, None), ("O2", "T2", 1, None), ("O3", "T3", 3, None)],
        "order_id string, product_id string, quantity int, price double",
    )
    listed = spark.createDataFrame([(f"T{i}", 30000) for i in (1, 2, 3)], "product_id string, base_price int")
    done = cleaning.price_orders(orders, listed, mode=mode).orderBy("order_id")
    assert [r.amount for r in done.collect()] == [60000, 30000, 90000]


def test_price_modes_with_some_prices(spark):
    orders = spark.createDataFrame([("O1", "T1", 5.0), ("O2", "T1", None)], "order_id string, product_id string, price double")
    listed = spark.createDataFrame([("T1", 9.0)], "product_id string, base_price double")

    def prices(mode):
        return [r.price for r in cleaning.fill_price(orders, listed, mode=mode).orderBy("order_id").collect()]

    assert prices("coalesce") == [5.0, 9.0]
    assert prices("all_missing") == [5.0, None]
    assert prices("overwrite_if_any") == [9.0, 9.0]
    without = cleaning.fill_price(orders.drop("price"), listed).orderBy("order_id")
    assert [r.price for r in without.collect()] == [9.0, 9.0]
    with pytest.raises(ValueError):
        cleaning.fill_price(orders, listed, mode="other")


def test_rfm_and_scores(sales):
    scored = {r.customer_id: r for r in rfm.rfm_scores(rfm.rfm(sales)).collect()}
    for i, (_, quantity) in enumerate(shop.ORDERS):
        row = scored[f"C{i + 1:03d}"]
        assert (row.recency, row.frequency, row.monetary) == (23 - i, 1, 30000 * quantity)
        assert (row.R, row.F, row.RFM_Score) == (shop.R_SCORES[i], 3, row.R + row.F + row.M)


def test_all_scores_are_three_when_quintiles_coincide(spark):
    same = spark.createDataFrame([(i, i, 1, 5.0) for i in range(10)], "customer_id int, recency int, frequency int, monetary double")
    assert {(r.F, r.M) for r in rfm.rfm_scores(same).collect()} == {(3, 3)}


def test_reference_dates(sales):
    shifted = {r.customer_id: r.recency for r in rfm.rfm(sales, offset_days=1).collect()}
    assert shifted["C024"] == 1 and shifted["C001"] == 24
    given = {r.customer_id: r.recency for r in rfm.rfm(sales, as_of="2025-05-10", window_months=6).collect()}
    assert len(given) == 10 and given["C010"] == 0 and given["C001"] == 9


def test_text_dates_and_amounts(spark, rows):
    text = spark.createDataFrame(
        [("a", "01/05/2025", "10"), ("a", "03/05/2025", "x"), (None, "04/05/2025", "1")],
        "customer_id string, order_date string, amount string",
    )
    assert rows(rfm.rfm(text, as_of="2025-05-04")) == [("a", 1, 2, 10.0)]
    with pytest.raises(ValueError):
        rfm.rfm(text.drop("amount"))


def test_campaign_kpis(spark):
    kpis = rounded(marketing.campaign_kpis(shop.marketing(spark))).orderBy("campaign_id").collect()
    assert [r.CTR for r in kpis] == [154.0, 300.0, 300.0, 136.67, 56.0, 75.0, 180.0]
    assert [r.CPC for r in kpis] == [155.84, 266.67, 666.67, 731.71, 535.71, 466.67, 333.33]
    assert [r.conversion_rate for r in kpis] == [6.49, 6.67, 20.0, 17.07, 3.57, 6.67, 8.33]
    assert [r.ROI for r in kpis] == [-66.67, -56.25, -25.0, -73.33, -79.33, -64.29, -16.67]


def test_kpi_totals(spark):
    row = marketing.kpi_totals(marketing.campaign_kpis(shop.marketing(spark))).first()
    assert (row.total_impressions, row.total_clicks, row.total_conversions, row.total_revenue) == (220, 302, 28, 52100)
    assert round(row.avg_ctr, 2) == 137.27 and round(row.avg_roi, 1) == -56.2


def test_segment_performance_without_prices(spark):
    found = rounded(marketing.segment_performance(shop.orders(spark), shop.segments(spark), shop.marketing(spark)))
    rows = [tuple(r) for r in found.orderBy("segment").collect()]
    assert rows == [
        (0, 6, 6, 0.0, 0.0, 100.0, 29750.0, -100.0),
        (1, 4, 4, 0.0, 0.0, 100.0, 19833.33, -100.0),
        (2, 7, 7, 0.0, 0.0, 100.0, 34708.33, -100.0),
        (3, 4, 4, 0.0, 0.0, 100.0, 19833.33, -100.0),
        (4, 3, 3, 0.0, 0.0, 100.0, 14875.0, -100.0),
    ]


def test_segment_value_on_prices(spark, sales):
    found = rounded(products.segment_value(shop.segments(spark), sales, revenue="price")).orderBy("segment").collect()
    assert [r.total_revenue for r in found] == [180000, 120000, 210000, 120000, 90000]
    assert [r.revenue_pct for r in found] == [25.0, 16.67, 29.17, 16.67, 12.5]
    assert {(r.avg_revenue, r.median_revenue) for r in found} == {(30000.0, 30000.0)}
    assert sum(r.total_revenue for r in found) == 720000


def test_preferences_and_basket(spark, sales, rows):
    wide = enrich.enrich(enrich.enrich(sales, shop.products(spark), "product_id"), shop.segments(spark), "customer_id")
    found = products.product_preferences(wide)
    assert rows(found.filter("segment = 0 and attribute = 'category'"), "value", "orders") == [
        ("Casual", 1), ("Sport", 2), ("Streetwear", 3),
    ]
    assert rows(found.filter("segment = 2 and attribute = 'size'"), "value", "orders") == [("L", 2), ("M", 3), ("S", 1), ("XL", 1)]
    assert rows(found.filter("segment = 4 and attribute = 'color'"), "value") == [("Gris",), ("Noir",), ("Vert",)]
    assert found.count() == 17 + 24 + 14 + 22
    assert rows(products.basket_stats(wide)) == [(s, 30000.0, 30000.0, n) for s, n in enumerate((6, 4, 7, 4, 3))]


def test_lifetime_value(spark, sales):
    clv = value.clv_margin(sales, amount="price", customers=shop.customers(spark), segments=shop.segments(spark))
    top = value.top_customers(clv).collect()
    assert [r.customer_id for r in top] == [f"C{i:03d}" for i in range(1, 11)]
    assert {(round(r.clv, 6), round(r.avg_order_value, 6), round(r.purchase_freq, 2)) for r in top} == {(9000.0, 9000.0, 0.08)}


def test_segment_profile_takes_the_smallest_mode(spark, sales):
    wide = enrich.enrich(sales, shop.customers(spark), "customer_id")
    facts = rfm.customer_aggregate(wide)
    scored = enrich.enrich(rfm.rfm_scores(rfm.rfm(sales)), shop.segments(spark), "customer_id")
    table = rfm.segment_table(scored, facts)
    profile = {r.segment: r for r in rfm.segment_profile(table).collect()}
    assert profile[2].city_first_mode == "Fianarantsoa" and profile[2].gender_first_mode == "M"
    assert profile[4].city_first_mode == "Antananarivo" and profile[4].gender_first_mode == "F"
    assert profile[0].avg_recency == 10.5
    found = {r.segment: r.gender_distribution for r in rfm.segment_characteristics(table).collect()}
    assert found[2] == {"F": 1, "M": 6}


def test_tenure_may_be_negative(spark, sales):
    wide = enrich.enrich(sales, shop.customers(spark), "customer_id")
    days = {r.customer_id: r.d for r in wide.selectExpr("customer_id", "datediff(order_date, signup_date) AS d").collect()}
    assert days["C022"] == -48
    tenure = products.add_tenure(shop.customers(spark)).orderBy("customer_id").collect()
    assert tenure[21].tenure_days == 0 and tenure[0].tenure_days == 72


def test_kmeans_finds_segments_of_known_sizes(sales):
    segmented, model = clustering.kmeans_segments(rfm.rfm(sales), k=5)
    sizes = sorted(r["count"] for r in segmented.groupBy("segment").count().collect())
    assert sum(sizes) == 24 and len(sizes) == 5
    quality = clustering.cluster_dispersion(
        clustering.standardise(segmented, ["recency", "frequency", "monetary"]), ["recency_z", "frequency_z", "monetary_z"]
    ).first()
    assert quality.inertia == pytest.approx(clustering.inertia(model), rel=1e-6)
    known = enrich.enrich(clustering.standardise(rfm.rfm(sales), ["recency", "frequency", "monetary"]), shop.segments(sales.sparkSession), "customer_id")
    best_known = clustering.cluster_dispersion(known, ["recency_z", "frequency_z", "monetary_z"]).first()
    assert quality.inertia <= best_known.inertia * 1.05
    with pytest.raises(ValueError):
        clustering.kmeans_segments(rfm.rfm(sales), method="dbscan")
