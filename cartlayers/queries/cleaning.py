"""Typing, row rules, text, dates, deduplication, profiling and the cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlayers import registry as r
from cartlayers.functions.dates import days_between, month_label, month_start
from cartlayers.operators.combine import union_all
from cartlayers.operators.dedup import dedup_report, distinct_values, keep_first
from cartlayers.operators.profile import profile_tables
from cartlayers.operators.rules import (
    FLAG,
    fill_defaults,
    flag_inconsistent_dates,
    inconsistent_date_count,
    normalize_text,
    outside_range,
    outside_range_count,
    require,
)
from cartlayers.operators.typing import apply_types
from cartlayers.plans.gold import delivered_orders, on_time_percent
from cartlayers.plans.layers import typing_report
from cartlayers.plans.silver import clean
from cartlayers.queries.entry import Query
from cartlayers.queries.view_sql import half_up, with_views
from cartlayers.queries.views import Views
from cartlayers.sources.landing import INGEST_TIME, SOURCE_FILE, with_audit

# Raw view in SQL of each declared table.
RAW_SQL = {
    "orders": "r_orders",
    "customers": "r_customers",
    "order_items": "r_items",
    "payments": "r_payments",
    "reviews": "r_reviews",
    "products": "r_products",
    "sellers": "r_sellers",
    "geolocation": "r_geolocation",
    "category_translation": "r_category",
}

RAW_COLUMNS = {
    "orders": (
        "order_id customer_id order_status order_purchase_timestamp order_approved_at "
        "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"
    ).split(),
    "customers": (
        "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state"
    ).split(),
    "order_items": (
        "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"
    ).split(),
    "payments": "order_id payment_value payment_installments".split(),
    "reviews": (
        "review_id order_id review_score review_creation_date review_answer_timestamp"
    ).split(),
    "products": (
        "product_id product_category_name product_name_lenght product_description_lenght "
        "product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm"
    ).split(),
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state".split(),
    "geolocation": (
        "geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city "
        "geolocation_state"
    ).split(),
    "category_translation": "product_category_name product_category_name_english".split(),
}

SQL_TYPES = {
    "timestamp": "TIMESTAMP",
    "decimal(10,2)": "DECIMAL(10,2)",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
}


def raw_tables(v: Views) -> dict[str, DataFrame]:
    return {name: getattr(v, f"raw_{name}")() for name in r.TABLES}


def cast_sql(column: str, kind: str) -> str:
    return f"TRY_CAST({column} AS {SQL_TYPES[kind]})"


def typed_sql(table: str) -> str:
    """The raw view with the declared casts, in column order."""
    types = r.TABLES[table].types
    columns = [
        f"{cast_sql(c, types[c])} AS {c}" if c in types else c for c in RAW_COLUMNS[table]
    ]
    return f"SELECT {', '.join(columns)} FROM {RAW_SQL[table]}"


def first_sql(source: str, key: tuple[str, ...], columns: list[str]) -> str:
    """One row per key: the smallest under the other columns, NULL first."""
    order = ", ".join(f"{c} NULLS LAST" for c in columns if c not in key)
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY {', '.join(key)} ORDER BY {order}) = 1"
    )


def fold_sql(function: str, column: str) -> str:
    return f"{function}(trim({column}, ' '))"


def clean_sql(table: str) -> str:
    """The cleaned table as a SELECT over the raw view, money as double."""
    spec = r.TABLES[table]
    columns = RAW_COLUMNS[table]
    source = f"({typed_sql(table)})"
    if spec.text_first:
        folded = [f"{fold_sql('lower', c)} AS {c}" if c in spec.lower else c for c in columns]
        source = f"(SELECT {', '.join(folded)} FROM {source})"
    if spec.dedup_key:
        source = f"({first_sql(source, spec.dedup_key, columns)})"
    out = []
    for c in columns:
        e = f"coalesce({c}, '{spec.defaults[c]}')" if c in spec.defaults else c
        if not spec.text_first:
            e = fold_sql("lower", e) if c in spec.lower else e
            e = fold_sql("upper", e) if c in spec.upper else e
        if spec.types.get(c) == r.MONEY:
            e = f"CAST({e} AS DOUBLE)"
        out.append(f"{e} AS {c}" if e != c else c)
    if table == "orders":
        out.append(
            "coalesce(order_delivered_customer_date < order_purchase_timestamp, false) "
            f"AS {FLAG}"
        )
    where = " AND ".join(f"{c} IS NOT NULL" for c in spec.required)
    return f"SELECT {', '.join(out)} FROM {source}" + (f" WHERE {where}" if where else "")


def cleaned(table: str) -> Query:
    spec = r.TABLES[table]
    return Query(
        lambda v: clean(spec, getattr(v, f"raw_{table}")()),
        with_views(clean_sql(table), RAW_SQL[table]),
    )


def _typed_columns(table: str, keep: list[str], kind: str) -> Query:
    """The key columns and every declared column of one type, cast."""
    types = {c: k for c, k in r.TABLES[table].types.items() if k == kind}
    casts = [
        f"CAST({cast_sql(c, k)} AS DOUBLE) AS {c}" if k == r.MONEY else f"{cast_sql(c, k)} AS {c}"
        for c, k in types.items()
    ]
    return Query(
        lambda v: apply_types(getattr(v, f"raw_{table}")(), types).select(*keep, *types),
        with_views(f"SELECT {', '.join([*keep, *casts])} FROM {RAW_SQL[table]}", RAW_SQL[table]),
    )


def _cast_failure_sql() -> str:
    parts = [
        f"SELECT '{name}' AS tabela, '{c}' AS coluna, '{k}' AS tipo, "
        f"count(*) FILTER (WHERE {c} IS NOT NULL AND {cast_sql(c, k)} IS NULL) AS falhas "
        f"FROM {RAW_SQL[name]}"
        for name, spec in r.TABLES.items()
        for c, k in spec.types.items()
    ]
    return with_views(
        " UNION ALL ".join(parts), *[RAW_SQL[n] for n, s in r.TABLES.items() if s.types]
    )


DEDUPLICATED = [name for name, spec in r.TABLES.items() if spec.dedup_key and not spec.text_first]


def _dedup_report(v: Views) -> DataFrame:
    return union_all(
        [
            dedup_report(getattr(v, f"raw_{name}")(), name, r.TABLES[name].dedup_key)
            for name in DEDUPLICATED
        ]
    )


def _dedup_report_sql() -> str:
    parts = []
    for name in DEDUPLICATED:
        key = r.TABLES[name].dedup_key
        parts.append(
            f"SELECT '{name}' AS tabela, '{','.join(key)}' AS chave, "
            f"CAST(sum(n) AS BIGINT) AS linhas, count(*) AS chaves, "
            f"CAST(sum(n) - count(*) AS BIGINT) AS removidas FROM "
            f"(SELECT count(*) AS n FROM {RAW_SQL[name]} GROUP BY {', '.join(key)})"
        )
    return with_views(" UNION ALL ".join(parts), *[RAW_SQL[n] for n in DEDUPLICATED])


def _null_profile_sql() -> str:
    parts = []
    for name, columns in RAW_COLUMNS.items():
        for position, c in enumerate(columns, start=1):
            missing = f"count(*) FILTER (WHERE {c} IS NULL OR {c} = '')"
            parts.append(
                f"SELECT '{name}' AS tabela, {position} AS posicao, '{c}' AS campo, "
                f"'string' AS tipo, {half_up(f'({missing} * 100)', 'count(*)')} AS pct_nulos "
                f"FROM {RAW_SQL[name]}"
            )
    return with_views(" UNION ALL ".join(parts), *RAW_SQL.values())


def _delivered(v: Views) -> DataFrame:
    return delivered_orders(v.orders()).select(
        "order_id", "mes", "dias_entrega", F.col("no_prazo").cast("int").alias("no_prazo")
    )


def _month_bucket(v: Views) -> DataFrame:
    months = v.orders().groupBy(month_start("order_purchase_timestamp").alias("month"))
    return months.agg(F.count(F.lit(1)).alias("pedidos")).select(
        month_label("month").alias("mes"), "pedidos"
    )


def _audited(v: Views) -> DataFrame:
    return with_audit(v.raw_customers(), "customers_dataset.csv").select(
        "customer_id", SOURCE_FILE, F.col(INGEST_TIME).isNotNull().alias("ingest_known")
    )


def _typed_reviews(v: Views) -> DataFrame:
    return apply_types(v.raw_reviews(), r.REVIEWS.types)


def _typed_orders(v: Views) -> DataFrame:
    return apply_types(v.raw_orders(), r.ORDERS.types)


_SCORE = cast_sql("review_score", "int")
_EARLY = (
    f"coalesce({cast_sql('order_delivered_customer_date', 'timestamp')} < "
    f"{cast_sql('order_purchase_timestamp', 'timestamp')}, false)"
)

QUERIES: dict[str, Query] = {
    # Typing
    "try_cast_timestamp": _typed_columns("orders", ["order_id", "customer_id"], "timestamp"),
    "try_cast_decimal": _typed_columns("order_items", ["order_id", "order_item_id"], r.MONEY),
    "try_cast_int": _typed_columns("payments", ["order_id"], "int"),
    "try_cast_double": _typed_columns("products", ["product_id"], "double"),
    "cast_failure_report": Query(lambda v: typing_report(raw_tables(v)), _cast_failure_sql()),
    # Row rules
    "drop_null_key": Query(
        lambda v: require(v.raw_orders(), ["order_id"]),
        with_views("SELECT * FROM r_orders WHERE order_id IS NOT NULL", "r_orders"),
    ),
    "delivered_orders": Query(
        _delivered,
        with_views(
            """SELECT order_id, mes, CAST(dias_entrega AS INTEGER) AS dias_entrega,
                      CAST(no_prazo AS INTEGER) AS no_prazo FROM v_delivered""",
            "v_delivered",
        ),
    ),
    "score_out_of_domain": Query(
        lambda v: outside_range(_typed_reviews(v), "review_score", 1, 5).select(
            "review_id", "review_score"
        ),
        with_views(
            f"""SELECT review_id, {_SCORE} AS review_score FROM r_reviews
                WHERE {_SCORE} NOT BETWEEN 1 AND 5""",
            "r_reviews",
        ),
    ),
    "score_out_of_domain_count": Query(
        lambda v: outside_range_count(_typed_reviews(v), "review_score", 1, 5),
        with_views(
            f"""SELECT count(*) AS qtd_fora_do_dominio FROM r_reviews
                WHERE {_SCORE} NOT BETWEEN 1 AND 5""",
            "r_reviews",
        ),
    ),
    "flag_inconsistent_date": Query(
        lambda v: flag_inconsistent_dates(_typed_orders(v)).select("order_id", "customer_id", FLAG),
        with_views(f"SELECT order_id, customer_id, {_EARLY} AS {FLAG} FROM r_orders", "r_orders"),
    ),
    "inconsistent_date_count": Query(
        lambda v: inconsistent_date_count(flag_inconsistent_dates(_typed_orders(v))),
        with_views(f"SELECT count(*) AS qtd_inconsistentes FROM r_orders WHERE {_EARLY}", "r_orders"),
    ),
    "default_category": Query(
        lambda v: fill_defaults(v.raw_products(), r.PRODUCTS.defaults).select(
            "product_id", "product_category_name"
        ),
        with_views(
            """SELECT product_id,
                      coalesce(product_category_name, 'nao_informado') AS product_category_name
               FROM r_products""",
            "r_products",
        ),
    ),
    # Text and dates
    "normalize_text": Query(
        lambda v: normalize_text(v.raw_customers(), r.CUSTOMERS.lower, r.CUSTOMERS.upper).select(
            "customer_id", "customer_city", "customer_state"
        ),
        with_views(
            f"""SELECT customer_id, {fold_sql('lower', 'customer_city')} AS customer_city,
                       {fold_sql('upper', 'customer_state')} AS customer_state
                FROM r_customers""",
            "r_customers",
        ),
    ),
    "month_bucket": Query(
        _month_bucket,
        with_views(
            """SELECT strftime(order_purchase_timestamp, '%Y-%m') AS mes, count(*) AS pedidos
               FROM v_orders GROUP BY 1""",
            "v_orders",
        ),
    ),
    "delivery_days": Query(
        lambda v: v.orders().select(
            "order_id",
            days_between("order_purchase_timestamp", "order_delivered_customer_date").alias(
                "dias_entrega"
            ),
        ),
        with_views(
            """SELECT order_id, CAST(date_diff('day', order_purchase_timestamp,
                      order_delivered_customer_date) AS INTEGER) AS dias_entrega FROM v_orders""",
            "v_orders",
        ),
    ),
    "on_time_rate": Query(
        lambda v: delivered_orders(v.orders()).agg(
            on_time_percent("no_prazo").alias("pct_entregas_no_prazo")
        ),
        with_views(
            f"""SELECT {half_up('(100 * count(*) FILTER (WHERE no_prazo))', 'count(no_prazo)')}
                       AS pct_entregas_no_prazo FROM v_delivered""",
            "v_delivered",
        ),
    ),
    # Deduplication
    "dedup_single_key": Query(
        lambda v: keep_first(v.raw_customers(), r.CUSTOMERS.dedup_key),
        with_views(
            first_sql("r_customers", r.CUSTOMERS.dedup_key, RAW_COLUMNS["customers"]), "r_customers"
        ),
    ),
    "dedup_composite_key": Query(
        lambda v: v.order_items(),
        with_views(
            """SELECT * REPLACE (CAST(price AS DOUBLE) AS price,
                                 CAST(freight_value AS DOUBLE) AS freight_value) FROM v_items""",
            "v_items",
        ),
    ),
    "dedup_report": Query(_dedup_report, _dedup_report_sql()),
    "distinct_values": Query(
        lambda v: distinct_values(v.products(), "product_category_name"),
        with_views("SELECT DISTINCT product_category_name FROM v_products", "v_products"),
    ),
    "category_dimension": cleaned("category_translation"),
    # Cleaned tables
    "silver_orders": cleaned("orders"),
    "silver_order_items": cleaned("order_items"),
    "silver_reviews": cleaned("reviews"),
    "silver_payments": cleaned("payments"),
    "silver_products": cleaned("products"),
    "silver_customers": cleaned("customers"),
    "silver_sellers": cleaned("sellers"),
    "geolocation_centroid": Query(
        lambda v: clean(r.GEOLOCATION, v.raw_geolocation()).withColumns(
            {c: F.round(c, 6) for c in ("latitude", "longitude")}
        ),
        with_views(
            f"""SELECT t.geolocation_zip_code_prefix, latitude, longitude,
                       {fold_sql('lower', 'geolocation_city')} AS cidade,
                       {fold_sql('upper', 'geolocation_state')} AS estado
                FROM (SELECT geolocation_zip_code_prefix,
                             round(avg(geolocation_lat), 6) AS latitude,
                             round(avg(geolocation_lng), 6) AS longitude
                      FROM typed GROUP BY ALL) t
                JOIN (SELECT geolocation_zip_code_prefix, geolocation_city, geolocation_state
                      FROM typed
                      GROUP BY geolocation_zip_code_prefix, geolocation_city, geolocation_state
                      QUALIFY row_number() OVER (
                        PARTITION BY geolocation_zip_code_prefix
                        ORDER BY geolocation_city IS NULL OR geolocation_state IS NULL,
                          count(*) DESC, geolocation_city NULLS LAST,
                          geolocation_state NULLS LAST) = 1) p
                  ON p.geolocation_zip_code_prefix = t.geolocation_zip_code_prefix""",
            "r_geolocation",
            typed=typed_sql("geolocation"),
        ),
    ),
    # Profiling and audit
    "null_profile": Query(lambda v: profile_tables(raw_tables(v)), _null_profile_sql()),
    "bronze_audit_columns": Query(
        _audited,
        with_views(
            f"""SELECT customer_id, 'customers_dataset.csv' AS {SOURCE_FILE}, true AS ingest_known
                FROM r_customers""",
            "r_customers",
        ),
    ),
}
