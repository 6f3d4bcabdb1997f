"""The given tables seen through the engine's schema.

Typed views stand for cleaned tables; raw views stand for all-text landing tables and carry the
defects that the cleaning operators deal with (unparsable values, NULL keys, copies, padding).
Every view covers its whole source table. `view_sql.py` states the same views for another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlayers.operators.dedup import keep_first
from cartlayers.operators.rules import flag_inconsistent_dates
from cartlayers.registry import MONEY, ORDER_ITEMS

# Every tenth review goes to the order of the next one, so some orders have two.
_REVIEW_ORDER = "event_id + if(event_id % 10 = 0, 1, 0)"


def _stamp(moment: str) -> str:
    return f"date_format({moment}, 'yyyy-MM-dd HH:mm:ss')"


def _later(moment: str, days: str) -> str:
    return f"timestampadd(DAY, int({days}), {moment})"


def _money(name: str) -> str:
    return f"string(cast({name} AS {MONEY}))"


class Views:
    """Views over the tables of one folder; each is built when it is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._scans: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._scans:
            self._scans[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._scans[name]

    # Typed views.

    def orders(self) -> DataFrame:
        shipped = (
            self.table("lineitem")
            .selectExpr("l_orderkey AS o_orderkey", "l_shipdate")
            .groupBy("o_orderkey")
            .agg(F.max("l_shipdate").alias("shipped"))
        )
        rows = self.table("orders").join(shipped, "o_orderkey", "left")
        return flag_inconsistent_dates(
            rows.selectExpr(
                "o_orderkey AS order_id",
                "o_custkey AS customer_id",
                "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' "
                "ELSE 'processing' END AS order_status",
                "timestamp(o_orderdate) AS order_purchase_timestamp",
                "timestamp(shipped) AS order_delivered_customer_date",
                f"CASE WHEN o_orderkey % 50 <> 0 THEN timestamp({_later('o_orderdate', '720')}) END "
                "AS order_estimated_delivery_date",
            )
        )

    def order_items_raw(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_linenumber AS order_item_id",
            "l_partkey AS product_id",
            "l_suppkey AS seller_id",
            "timestamp(l_shipdate) AS shipping_limit_date",
            f"cast(l_extendedprice AS {MONEY}) AS price",
            f"cast(l_quantity AS {MONEY}) AS freight_value",
        )

    def order_items(self) -> DataFrame:
        return keep_first(self.order_items_raw(), ORDER_ITEMS.dedup_key)

    def _places(self, table: str, nation_key: str) -> DataFrame:
        nation = self.table("nation").selectExpr(f"n_nationkey AS {nation_key}", "n_name")
        return self.table(table).join(nation, nation_key)

    def customers(self) -> DataFrame:
        return self._places("customer", "c_nationkey").selectExpr(
            "c_custkey AS customer_id", "n_name AS customer_state", "c_mktsegment AS customer_city"
        )

    def sellers(self) -> DataFrame:
        return self._places("supplier", "s_nationkey").selectExpr(
            "s_suppkey AS seller_id", "n_name AS seller_state", "s_name AS seller_city"
        )

    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS product_id",
            "CASE WHEN p_partkey % 20 <> 0 THEN p_type END AS product_category_name",
        )

    def payments(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS order_id",
            f"cast(o_totalprice AS {MONEY}) AS payment_value",
            "int(1 + o_orderkey % 10) AS payment_installments",
        )

    def reviews(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS review_id",
            f"{_REVIEW_ORDER} AS order_id",
            "int(1 + user_id % 5) AS review_score",
            "timestamp(ts) AS review_creation_date",
        )

    # Raw views: every column is text.

    def _with_copies(
        self, rows: DataFrame, copied: str, column: str, value: str
    ) -> DataFrame:
        """The rows plus a second copy of those that satisfy `copied`, with one column changed."""
        copies = rows.filter(copied).withColumn(column, F.lit(value))
        return rows.union(copies).drop("k")

    def raw_orders(self) -> DataFrame:
        rows = self.table("orders").selectExpr(
            "CASE WHEN o_orderkey % 1009 <> 5 THEN string(o_orderkey) END AS order_id",
            "string(o_custkey) AS customer_id",
            "if(o_orderstatus = 'F', 'delivered', 'shipped') AS order_status",
            "CASE WHEN o_orderkey % 97 = 0 THEN 'abc' WHEN o_orderkey % 89 = 0 THEN '' "
            "WHEN o_orderkey % 83 = 0 THEN '2017-13-01' "
            f"ELSE {_stamp('o_orderdate')} END AS order_purchase_timestamp",
            f"CASE WHEN o_orderkey % 13 <> 0 THEN {_stamp(_later('o_orderdate', '1'))} END "
            "AS order_approved_at",
            f"{_stamp(_later('o_orderdate', '2'))} AS order_delivered_carrier_date",
            "CASE WHEN o_orderkey % 31 <> 0 "
            f"THEN {_stamp(_later('o_orderdate', 'o_orderkey % 45 - 4'))} END "
            "AS order_delivered_customer_date",
            f"CASE WHEN o_orderkey % 50 <> 0 THEN {_stamp(_later('o_orderdate', '20'))} END "
            "AS order_estimated_delivery_date",
            "o_orderkey AS k",
        )
        return self._with_copies(rows, "k % 11 = 0", "order_status", "canceled")

    def raw_order_items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "string(l_orderkey) AS order_id",
            "string(l_linenumber) AS order_item_id",
            "string(l_partkey) AS product_id",
            "string(l_suppkey) AS seller_id",
            f"if(l_orderkey % 97 = 0, 'no date', {_stamp('l_shipdate')}) AS shipping_limit_date",
            "CASE WHEN l_orderkey % 101 = 0 THEN 'abc' WHEN l_orderkey % 103 = 0 THEN '1.005' "
            "WHEN l_orderkey % 107 = 0 THEN '123456789.12' "
            f"ELSE {_money('l_extendedprice')} END AS price",
            f"if(l_orderkey % 109 = 0, '', {_money('l_quantity')}) AS freight_value",
        )

    def raw_payments(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "string(o_orderkey) AS order_id",
            "CASE WHEN o_orderkey % 61 = 0 THEN 'n/a' WHEN o_orderkey % 67 = 0 "
            f"THEN '123456789.12' ELSE {_money('o_totalprice')} END AS payment_value",
            "CASE WHEN o_orderkey % 71 = 0 THEN '' WHEN o_orderkey % 73 = 0 THEN ' 7 ' "
            "ELSE string(1 + o_orderkey % 10) END AS payment_installments",
        )

    def raw_reviews(self) -> DataFrame:
        rows = self.table("events").selectExpr(
            "string(event_id) AS review_id",
            f"string({_REVIEW_ORDER}) AS order_id",
            "CASE WHEN event_id % 41 = 0 THEN '9' WHEN event_id % 43 = 0 THEN 'x' "
            "WHEN event_id % 47 = 0 THEN '' ELSE string(1 + user_id % 5) END AS review_score",
            f"if(event_id % 53 = 0, '2017-13-01', {_stamp('ts')}) AS review_creation_date",
            f"{_stamp(_later('ts', '1'))} AS review_answer_timestamp",
            "event_id AS k",
        )
        return self._with_copies(rows, "k % 9 = 0", "review_score", "1")

    def raw_products(self) -> DataFrame:
        rows = self.table("part").selectExpr(
            "string(p_partkey) AS product_id",
            "CASE WHEN p_partkey % 20 = 0 THEN NULL WHEN p_partkey % 21 = 0 THEN ' ' "
            "WHEN p_partkey % 22 = 0 THEN concat('  ', upper(p_type), ' ') ELSE p_type END "
            "AS product_category_name",
            "string(length(p_name)) AS product_name_lenght",
            "if(p_partkey % 37 = 0, 'many', string(p_size * 10)) AS product_description_lenght",
            "string(p_size % 7) AS product_photos_qty",
            f"if(p_partkey % 41 = 0, 'heavy', {_money('p_retailprice')}) AS product_weight_g",
            "concat(p_size, '.5') AS product_length_cm",
            "concat(p_size % 9, '.25') AS product_height_cm",
            "CASE WHEN p_partkey % 43 <> 0 THEN string(p_size) END AS product_width_cm",
            "p_partkey AS k",
        )
        return self._with_copies(rows, "k % 15 = 0", "product_category_name", "AAA copy")

    def raw_customers(self) -> DataFrame:
        rows = self._places("customer", "c_nationkey").selectExpr(
            "string(c_custkey) AS customer_id",
            "c_name AS customer_unique_id",
            "string(c_nationkey) AS customer_zip_code_prefix",
            "concat(' ', c_mktsegment, '  ') AS customer_city",
            "concat(lower(n_name), ' ') AS customer_state",
            "c_custkey AS k",
        )
        return self._with_copies(rows, "k % 10 = 0", "customer_city", "\tZ copy")

    def raw_sellers(self) -> DataFrame:
        rows = self._places("supplier", "s_nationkey").selectExpr(
            "string(s_suppkey) AS seller_id",
            "string(s_nationkey) AS seller_zip_code_prefix",
            "concat(' ', s_name, ' ') AS seller_city",
            "concat(' ', lower(n_name)) AS seller_state",
            "s_suppkey AS k",
        )
        return self._with_copies(rows, "k % 4 = 0", "seller_city", "São Copy")

    def raw_geolocation(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "string(c_nationkey) AS geolocation_zip_code_prefix",
            f"if(c_custkey % 29 = 0, 'bad', {_money('c_acctbal')}) AS geolocation_lat",
            f"{_money('c_acctbal')} AS geolocation_lng",
            "CASE WHEN c_custkey % 17 <> 0 THEN concat(c_mktsegment, ' ') END AS geolocation_city",
            "concat(' ', lower(c_name)) AS geolocation_state",
        )

    def raw_category_translation(self) -> DataFrame:
        return self.table("part").selectExpr(
            "CASE p_partkey % 3 WHEN 0 THEN concat(' ', p_type) WHEN 1 THEN lower(p_type) "
            "ELSE concat(p_type, '  ') END AS product_category_name",
            "concat(' ', p_type, ' ', p_brand) AS product_category_name_english",
        )
