"""A small T-shirt shop: 24 customers with one order each, 8 products, 7 campaigns. Fixed values."""

import datetime as dt

# age, gender, city, signup (day, month) of customers C001..C024
CUSTOMERS = [
    (22, "M", "Fianarantsoa", (28, 4)), (22, "M", "Fianarantsoa", (28, 4)), (23, "M", "Fianarantsoa", (28, 4)),
    (22, "F", "Fianarantsoa", (28, 4)), (22, "M", "Fianarantsoa", (28, 4)), (26, "M", "Fianarantsoa", (28, 4)),
    (34, "M", "Fianarantsoa", (5, 5)), (19, "F", "Antananarivo", (24, 4)), (31, "M", "Antsirabe", (24, 4)),
    (24, "F", "Fianarantsoa", (10, 5)), (25, "F", "Antananarivo", (3, 6)), (39, "M", "Toliara", (10, 6)),
    (28, "F", "Diego", (10, 5)), (33, "M", "Nosy Be", (23, 4)), (21, "F", "Antananarivo", (26, 6)),
    (40, "M", "Morondava", (26, 6)), (29, "M", "Antsirabe", (10, 5)), (38, "M", "Fianarantsoa", (20, 4)),
    (24, "F", "Antsirabe", (1, 5)), (22, "M", "Antananarivo", (25, 5)), (30, "F", "Antananarivo", (6, 5)),
    (41, "M", "Toliara", (9, 7)), (26, "F", "Mahajanga", (30, 4)), (25, "M", "Antsirabe", (26, 5)),
]
# product and quantity of the orders; customer C00n orders on the n-th of May 2025
ORDERS = [
    ("T101", 2), ("T105", 1), ("T103", 3), ("T102", 2), ("T104", 1), ("T106", 1), ("T108", 1), ("T107", 4),
    ("T101", 3), ("T104", 5), ("T102", 2), ("T103", 1), ("T106", 3), ("T107", 2), ("T108", 1), ("T101", 2),
    ("T105", 4), ("T102", 5), ("T103", 6), ("T104", 4), ("T106", 3), ("T108", 6), ("T101", 7), ("T107", 2),
]
PRODUCTS = [
    ("T101", "Streetwear", "Logo minimaliste", "M", "Noir"), ("T102", "Streetwear", "Art graphique", "L", "Blanc"),
    ("T103", "Sport", "DryFit imprimé", "M", "Bleu"), ("T104", "Casual", "Vintage rétro", "XL", "Gris"),
    ("T105", "Fashion", "Design floral", "S", "Rose"), ("T106", "Streetwear", "Graffiti Coloré", "L", "Noir"),
    ("T107", "Sport", "Performance Fit", "M", "Vert"), ("T108", "Casual", "Minimal chic", "M", "Beige"),
]
CAMPAIGNS = [
    ("MK001", (25, 4), "Facebook", 50, 77, 5, 12000, 4000), ("MK002", (28, 4), "Instagram", 20, 60, 4, 16000, 7000),
    ("MK003", (1, 5), "TikTok", 10, 30, 6, 20000, 15000), ("MK004", (5, 5), "Email", 30, 41, 7, 30000, 8000),
    ("MK005", (10, 5), "GoogleAds", 50, 28, 1, 15000, 3100), ("MK006", (15, 5), "Facebook", 40, 30, 2, 14000, 5000),
    ("MK007", (20, 5), "Instagram", 20, 36, 3, 12000, 10000),
]
BASE_PRICE = 30000
# k-means segment of C001..C024
SEGMENTS = [2] * 7 + [4] * 3 + [0] * 6 + [3, 1, 1, 3, 3, 1, 1, 3]
# recency quintile score of C001..C024; frequency and monetary scores are all 3
R_SCORES = [1] * 5 + [2] * 5 + [3] * 4 + [4] * 5 + [5] * 5


def day(pair):
    return dt.date(2025, pair[1], pair[0])


def customers(spark):
    data = [(f"C{i + 1:03d}", f"name {i + 1}", a, g, c, day(s)) for i, (a, g, c, s) in enumerate(CUSTOMERS)]
    return spark.createDataFrame(data, "customer_id string, name string, age int, gender string, city string, signup_date date")


def orders(spark):
    data = [
        (f"O{1001 + i}", f"C{i + 1:03d}", p, q, None, dt.date(2025, 5, i + 1)) for i, (p, q) in enumerate(ORDERS)
    ]
    return spark.createDataFrame(
        data, "order_id string, customer_id string, product_id string, quantity int, price double, order_date date"
    )


def products(spark):
    data = [(*p, BASE_PRICE) for p in PRODUCTS]
    return spark.createDataFrame(
        data, "product_id string, category string, style string, size string, color string, base_price int"
    )


def marketing(spark):
    data = [(c, day(d), *rest) for c, d, *rest in CAMPAIGNS]
    return spark.createDataFrame(
        data,
        "campaign_id string, date date, channel string, impressions int, clicks int, conversions int, spend int, revenue int",
    )


def segments(spark):
    data = [(f"C{i + 1:03d}", s) for i, s in enumerate(SEGMENTS)]
    return spark.createDataFrame(data, "customer_id string, segment int")
