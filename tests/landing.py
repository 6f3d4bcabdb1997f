"""Hand-made landing files with the defects the layers have to deal with."""

from __future__ import annotations

import csv
import pathlib

PREFIX = "shop_"

# Two sellers: s5 sells in five orders, s4 in four. February 2018 is missing and the revenue of
# December 2017 is zero.
GOOD_ORDERS = [
    # order_id, customer_id, status, purchase, delivered, estimated
    ("o1", "c1", "delivered", "2017-11-03 10:00:00", "2017-11-10 00:01:00", "2017-11-20 00:00:00"),
    ("o2", "c2", "delivered", "2017-12-05 23:59:00", "2017-12-06 00:01:00", "2017-12-30 00:00:00"),
    ("o3", "c3", "delivered", "2018-01-07 08:00:00", "2018-01-30 09:00:00", "2018-01-20 00:00:00"),
    ("o4", "c4", "delivered", "2018-01-09 08:00:00", "2018-01-19 08:00:00", ""),
    ("o5", "c5", "shipped", "2018-03-01 12:00:00", "", "2018-03-20 00:00:00"),
    ("o6", "c6", "delivered", "2018-03-05 12:00:00", "2018-03-01 12:00:00", "2018-03-25 00:00:00"),
    ("o7", "c7", "delivered", "2018-03-06 12:00:00", "", "2018-03-25 00:00:00"),
]

GOOD_ITEMS = [
    # order_id, item, product, seller, limit, price, freight
    ("o1", "1", "p1", "s5", "2017-11-06 00:00:00", "10.00", "1.50"),
    ("o1", "2", "p2", "s5", "2017-11-06 00:00:00", "30.00", "2.50"),
    ("o2", "1", "p1", "s5", "2017-12-08 00:00:00", "0.00", "1.00"),
    ("o3", "1", "p1", "s5", "2018-01-10 00:00:00", "20.00", "1.00"),
    ("o3", "2", "p3", "s4", "2018-01-10 00:00:00", "5.00", "1.00"),
    ("o4", "1", "p1", "s5", "2018-01-12 00:00:00", "1.005", "1.00"),
    ("o4", "2", "p3", "s4", "2018-01-12 00:00:00", "7.00", "1.00"),
    ("o5", "1", "p2", "s5", "2018-03-04 00:00:00", "50.00", "1.00"),
    ("o6", "1", "p3", "s4", "2018-03-08 00:00:00", "8.00", "1.00"),
    ("o7", "1", "p3", "s4", "2018-03-09 00:00:00", "9.00", "1.00"),
]

GOOD_REVIEWS = [
    # review_id, order_id, score, comment, created, answered
    ("r1", "o1", "5", 'said "great",\nwould buy again', "2017-11-12 00:00:00", "2017-11-13 00:00:00"),
    ("r2", "o1", "4", "second\nreview", "2017-11-14 00:00:00", "2017-11-15 00:00:00"),
    ("r3", "o3", "1", "late", "2018-02-01 00:00:00", "2018-02-02 00:00:00"),
    ("r4", "o4", "2", "", "2018-01-21 00:00:00", "2018-01-22 00:00:00"),
    ("r5", "o5", "x", "no number", "2018-03-10 00:00:00", "2018-03-11 00:00:00"),
]

# Rows that break a rule of the cleaned or business layer.
DIRTY_ORDERS = [
    ("o1", "c1", "unavailable", "2017-11-03 10:00:00", "2017-11-10 00:01:00", "2017-11-20 00:00:00"),
    ("o8", "c8", "delivered", "not a date", "2018-03-11 12:00:00", "2018-03-25 00:00:00"),
    ("", "c9", "delivered", "2018-03-06 12:00:00", "", ""),
    ("", "c9", "canceled", "2018-03-06 12:00:00", "", ""),
]

DIRTY_ITEMS = [
    ("o1", "1", "p1", "s5", "2017-11-06 00:00:00", "11.00", "1.50"),
    ("o8", "1", "p1", "s5", "2018-03-09 00:00:00", "123456789.12", "1.00"),
    ("o9", "1", "p1", "s5", "2018-03-09 00:00:00", "3.00", "1.00"),
    ("", "1", "p1", "s5", "2018-03-09 00:00:00", "4.00", "1.00"),
]

DIRTY_REVIEWS = [
    ("r1", "o1", "1", "copy", "2017-11-12 00:00:00", "2017-11-13 00:00:00"),
    ("r9", "o2", "9", "too high", "2017-13-01", "2017-12-11 00:00:00"),
]


def _write(folder: pathlib.Path, file: str, header: str, rows) -> None:
    with open(folder / file, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(header.split())
        writer.writerows(rows)


def write_landing(folder: pathlib.Path, dirty: bool) -> None:
    """The nine landing files; with `dirty`, including the rows that fail checks."""
    folder.mkdir(parents=True, exist_ok=True)
    orders = GOOD_ORDERS + (DIRTY_ORDERS if dirty else [])
    _write(
        folder,
        f"{PREFIX}orders_dataset.csv",
        "order_id customer_id order_status order_purchase_timestamp order_approved_at "
        "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date",
        [(o, c, s, bought, bought, "", delivered, due) for o, c, s, bought, delivered, due in orders],
    )
    _write(
        folder,
        f"{PREFIX}order_items_dataset.csv",
        "order_id order_item_id product_id seller_id shipping_limit_date price freight_value",
        GOOD_ITEMS + (DIRTY_ITEMS if dirty else []),
    )
    _write(
        folder,
        f"{PREFIX}order_reviews_dataset.csv",
        "review_id order_id review_score review_comment_message review_creation_date "
        "review_answer_timestamp",
        GOOD_REVIEWS + (DIRTY_REVIEWS if dirty else []),
    )
    _write(
        folder,
        f"{PREFIX}customers_dataset.csv",
        "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state",
        [
            (f"c{i}", f"u{i}", "01310", " São Paulo ", " sp " if i % 2 else "SP")
            for i in range(1, 9)
        ]
        + [("c1", "u1", "01310", "\tItu", "RJ")],
    )
    _write(
        folder,
        f"{PREFIX}sellers_dataset.csv",
        "seller_id seller_zip_code_prefix seller_city seller_state",
        [("s5", "01310", "CURITIBA", "pr"), ("s4", "01310", "\tItu ", " sp")],
    )
    _write(
        folder,
        f"{PREFIX}order_payments_dataset.csv",
        "order_id payment_installments payment_value",
        [("o1", "1", "44.00"), ("o1", "1", "44.00"), ("o2", " 7 ", "n/a"), ("o3", "", "27.00")],
    )
    with open(folder / f"{PREFIX}products_dataset.csv", "w", encoding="utf-8") as out:
        out.write(
            "product_id,product_category_name,product_name_lenght,product_description_lenght,"
            "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,"
            "product_width_cm\n"
            "p1,,40,287,1,225,16,10,14\n"
            'p2,"",x,276,1,heavy,30,18,20\n'
            'p3," ",58,402,4,1000,16,10,14\n'
            "p4, Perfumaria ,46,250,1,154.5,18,9,15\n"
        )
    _write(
        folder,
        f"{PREFIX}geolocation_dataset.csv",
        "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city "
        "geolocation_state",
        [
            ("01310", "-23.5", "-46.5", " São Paulo", "sp"),
            ("01310", "-23.7", "-46.7", "sao paulo", "SP "),
            ("01310", "south", "-46.9", "", "SP"),
            ("20000", "-22.9", "-43.2", "", "rj"),
        ],
    )
    _write(
        folder,
        "product_category_name_translation.csv",
        "product_category_name product_category_name_english",
        [("Perfumaria", "Perfumery"), (" perfumaria ", " health"), ("moveis", "Furniture")],
    )
