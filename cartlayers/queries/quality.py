"""Quality checks over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlayers import registry as r
from cartlayers.operators import checks as c
from cartlayers.operators.combine import union_all
from cartlayers.plans import gold as g
from cartlayers.plans.silver import clean_all, row_counts, silver_checks
from cartlayers.queries import business as b
from cartlayers.queries.cleaning import RAW_SQL, clean_sql, raw_tables
from cartlayers.queries.entry import Query
from cartlayers.queries.view_sql import with_views
from cartlayers.queries.views import Views

_ROWS_SQL = "(SELECT count(*) FROM {})"


def verdict_sql(layer: str, table: str, check: str, ok: str, detail: str, source: str) -> str:
    return (
        f"SELECT '{layer}' AS camada, '{table}' AS tabela, '{check}' AS checagem, "
        f"CASE WHEN {ok} THEN 'PASSOU' ELSE 'FALHOU' END AS status, {detail} AS detalhe "
        f"FROM ({source})"
    )


def row_count_sql(table: str, source: str, stored: str) -> str:
    return verdict_sql(
        "bronze",
        table,
        "contagem_linhas_vs_origem",
        "a = b",
        "'origem=' || a || ', gravado=' || b",
        f"SELECT {_ROWS_SQL.format(source)} AS a, {_ROWS_SQL.format(stored)} AS b",
    )


def unique_sql(layer: str, table: str, column: str, source: str) -> str:
    return verdict_sql(
        layer,
        table,
        f"chave_unica_{column}",
        "a = b",
        "a || ' vs ' || b",
        f"SELECT CAST(sum(n) AS BIGINT) AS a, count(*) AS b FROM "
        f"(SELECT count(*) AS n FROM {source} GROUP BY {column})",
    )


def reference_sql(
    child: str, column: str, parent: str, key: str, child_source: str, parent_source: str
) -> str:
    return verdict_sql(
        "silver",
        child,
        f"integridade_{column}_para_{parent}",
        "a = 0",
        "a || ' órfãos'",
        f"SELECT count(*) AS a FROM {child_source} c WHERE NOT EXISTS "
        f"(SELECT 1 FROM {parent_source} p WHERE p.{key} = c.{column})",
    )


def sum_sql(table: str, gold_total: str) -> str:
    return verdict_sql(
        "gold",
        table,
        "reconciliacao_com_silver",
        "abs(a - b) < 0.01",
        "'gold=' || a || ', silver=' || b",
        f"SELECT ({gold_total}) AS a, (SELECT sum(price) FROM v_items) AS b",
    )


def broken_sql(table: str, check: str, broken: str, noun: str, source: str) -> str:
    return verdict_sql(
        "gold",
        table,
        check,
        "a = 0",
        f"a || ' {noun}'",
        f"SELECT count(*) FILTER (WHERE {broken}) AS a FROM {source}",
    )


def category_sql(source: str) -> str:
    return verdict_sql(
        "gold",
        "satisfacao_entrega",
        "categorias_esperadas",
        "a > 0 AND b > 0 AND n = 0",
        "'[' || concat_ws(', ', CASE WHEN a > 0 THEN 'no_prazo' END, "
        "CASE WHEN b > 0 THEN 'atrasado' END) || '] fora da lista: ' || n",
        "SELECT count(*) FILTER (WHERE status_entrega = 'no_prazo') AS a, "
        "count(*) FILTER (WHERE status_entrega = 'atrasado') AS b, "
        "count(*) FILTER (WHERE status_entrega IS NULL "
        f"OR status_entrega NOT IN ('no_prazo', 'atrasado')) AS n FROM {source}",
    )


def _all(*parts: str) -> str:
    return " UNION ALL ".join(parts)


# Row counts: landed rows of every table against what is left of them after cleaning, so both
# outcomes occur.
def _row_counts(v: Views) -> DataFrame:
    return c.row_count_verdicts(row_counts(raw_tables(v)), "bronze")


def _unique_keys(v: Views) -> DataFrame:
    return union_all(
        [
            c.unique_key(v.raw_orders(), "bronze", "orders", "order_id"),
            c.unique_key(v.raw_customers(), "bronze", "customers", "customer_id"),
            c.unique_key(v.products(), "silver", "products", "product_id"),
            c.unique_key(b.seller_ranking(v), "gold", "ranking_vendedores", "seller_id"),
        ]
    )


# The parents of order references are the landed orders, some of which lost their key, so that there
# are orphans to find. All rows of every table are children.
def _references(v: Views) -> DataFrame:
    children = {
        "orders": v.orders(),
        "order_items": v.order_items(),
        "payments": v.payments(),
        "reviews": v.reviews(),
    }
    parents = {
        "orders": v.raw_orders().select(F.col("order_id").cast("bigint").alias("order_id")),
        "customers": v.customers(),
        "products": v.products(),
        "sellers": v.sellers(),
    }
    return union_all(
        [
            c.referential_integrity(
                children[spec.name],
                fk.column,
                parents[fk.parent],
                fk.parent_key,
                "silver",
                spec.name,
                fk.parent,
            )
            for spec in r.TABLES.values()
            for fk in spec.parents
        ]
    )


_CHILD_SOURCES = {
    "orders": "v_orders",
    "order_items": "v_items",
    "payments": "v_payments",
    "reviews": "v_reviews",
}
_PARENT_SOURCES = {
    "orders": "(SELECT CAST(order_id AS BIGINT) AS order_id FROM r_orders)",
    "customers": "v_customers",
    "products": "v_products",
    "sellers": "v_sellers",
}


def _references_sql(children: dict[str, str], parents: dict[str, str]) -> str:
    return _all(
        *[
            reference_sql(
                spec.name, fk.column, fk.parent, fk.parent_key, children[spec.name], parents[fk.parent]
            )
            for spec in r.TABLES.values()
            for fk in spec.parents
        ]
    )


def _reconciliation(v: Views) -> DataFrame:
    checks = [
        c.sum_check("receita_mensal", "receita_produtos", "silver"),
        c.sum_check("receita_por_estado", "receita_total", "silver"),
    ]
    total = v.order_items().agg(F.sum("price").alias("silver"))
    return c.verdicts_of(checks, _gold_tables(v), "gold", total)


_RECONCILIATION_SQL = _all(
    sum_sql("receita_mensal", "SELECT sum(price) FROM v_sales"),
    sum_sql(
        "receita_por_estado", "SELECT sum(price) FROM v_sales JOIN v_customers USING (customer_id)"
    ),
)


def _rules(v: Views, table: str, build, *rules: c.RowRule) -> DataFrame:
    return c.row_rules(build(v), "gold", table, rules)


def _non_negative(v: Views) -> DataFrame:
    return union_all(
        [
            _rules(
                v,
                "receita_mensal",
                b.monthly_revenue,
                c.RowRule("sem_valores_negativos", c.negative("receita_produtos"), "negativos"),
            ),
            _rules(
                v,
                "performance_entrega_mensal",
                b.delivery_performance,
                c.RowRule(
                    "tempo_entrega_nao_negativo", c.negative("tempo_medio_entrega_dias"), "negativos"
                ),
            ),
        ]
    )


_NEGATIVE_REVENUE_SQL = broken_sql(
    "receita_mensal", "sem_valores_negativos", "receita_produtos < 0", "negativos", "m"
)
_NEGATIVE_DAYS_SQL = broken_sql(
    "performance_entrega_mensal",
    "tempo_entrega_nao_negativo",
    "tempo_medio_entrega_dias < 0",
    "negativos",
    "d",
)
_NULL_STATE_SQL = broken_sql(
    "receita_por_estado", "sem_estado_nulo", "estado IS NULL", "nulos", "s"
)
_PCT_RANGE_SQL = broken_sql(
    "performance_entrega_mensal",
    "percentual_no_intervalo_0_100",
    "pct_entregas_no_prazo < 0 OR pct_entregas_no_prazo > 100",
    "fora do intervalo",
    "d",
)
_SCORE_RANGE_SQL = broken_sql(
    "satisfacao_entrega",
    "nota_media_no_intervalo_1_5",
    "nota_media < 1 OR nota_media > 5",
    "fora do intervalo",
    "sat",
)


def _min_orders_sql(minimum: int) -> str:
    return broken_sql(
        "ranking_vendedores",
        "filtro_minimo_pedidos_respeitado",
        f"qtd_pedidos < {minimum}",
        "abaixo do mínimo",
        "rank",
    )


def _ranges(v: Views) -> DataFrame:
    return union_all(
        [
            _rules(
                v,
                "performance_entrega_mensal",
                b.delivery_performance,
                c.RowRule(
                    "percentual_no_intervalo_0_100",
                    c.outside("pct_entregas_no_prazo", 0, 100),
                    "fora do intervalo",
                ),
            ),
            _rules(
                v,
                "satisfacao_entrega",
                b.delivery_satisfaction,
                c.RowRule(
                    "nota_media_no_intervalo_1_5", c.outside("nota_media", 1, 5), "fora do intervalo"
                ),
            ),
        ]
    )


def _gold_tables(v: Views) -> dict[str, DataFrame]:
    sales = g.order_sales(v.orders(), v.order_items())
    return {
        "receita_mensal": g.monthly_revenue_of(sales),
        "receita_por_estado": g.revenue_by_state_of(sales, v.customers()),
        "performance_entrega_mensal": b.delivery_performance(v),
        "satisfacao_entrega": b.delivery_satisfaction(v),
        "ranking_vendedores": b.seller_ranking(v),
    }


_GOLD_VIEWS = ("v_sales", "v_customers", "v_delivered", "v_reviews", "v_sellers")
_GOLD_TABLES = {
    "m": b.REVENUE_SQL,
    "s": b.STATE_SQL,
    "d": b.DELIVERY_SQL,
    "sat": b.SATISFACTION_SQL,
    "rank": b.ranking_sql(5),
}

_GOLD_SQL = with_views(
    _all(
        _RECONCILIATION_SQL,
        _NEGATIVE_REVENUE_SQL,
        _NULL_STATE_SQL,
        _PCT_RANGE_SQL,
        _NEGATIVE_DAYS_SQL,
        _SCORE_RANGE_SQL,
        category_sql("sat"),
        unique_sql("gold", "ranking_vendedores", "seller_id", "rank"),
        _min_orders_sql(5),
    ),
    *_GOLD_VIEWS,
    **_GOLD_TABLES,
)

_SILVER_NAMES = {name: f"clean_{name}" for name in r.TABLES}
_SILVER_TABLES = {f"clean_{name}": clean_sql(name) for name in r.TABLES if name != "geolocation"}
_SILVER_TABLES["clean_geolocation"] = (
    "SELECT DISTINCT geolocation_zip_code_prefix FROM r_geolocation"
)


def _silver_sql(select: str) -> str:
    verdicts = _all(
        *[
            unique_sql("silver", name, spec.unique, _SILVER_NAMES[name])
            for name, spec in r.TABLES.items()
            if spec.unique
        ],
        _references_sql(_SILVER_NAMES, _SILVER_NAMES),
    )
    return with_views(
        select.format(verdicts=f"({verdicts})"), *RAW_SQL.values(), **_SILVER_TABLES
    )


def _silver_verdicts(v: Views) -> DataFrame:
    return silver_checks(clean_all(raw_tables(v)))


QUERIES: dict[str, Query] = {
    "quality_row_count": Query(
        _row_counts,
        with_views(
            _all(
                *[row_count_sql(n, RAW_SQL[n], _SILVER_NAMES[n]) for n in r.TABLES],
            ),
            *RAW_SQL.values(),
            **_SILVER_TABLES,
        ),
    ),
    "quality_unique_key": Query(
        _unique_keys,
        with_views(
            _all(
                unique_sql("bronze", "orders", "order_id", "r_orders"),
                unique_sql("bronze", "customers", "customer_id", "r_customers"),
                unique_sql("silver", "products", "product_id", "v_products"),
                unique_sql("gold", "ranking_vendedores", "seller_id", "rank"),
            ),
            "r_orders",
            "r_customers",
            "v_products",
            *b.RANKING_VIEWS,
            rank=b.ranking_sql(5),
        ),
    ),
    "quality_referential_integrity": Query(
        _references,
        with_views(
            _references_sql(_CHILD_SOURCES, _PARENT_SOURCES),
            "r_orders",
            "v_orders",
            "v_customers",
            "v_items",
            "v_payments",
            "v_reviews",
            "v_products",
            "v_sellers",
        ),
    ),
    "quality_revenue_reconciliation": Query(
        _reconciliation, with_views(_RECONCILIATION_SQL, "v_sales", "v_customers")
    ),
    "quality_non_negative": Query(
        _non_negative,
        with_views(
            _all(_NEGATIVE_REVENUE_SQL, _NEGATIVE_DAYS_SQL),
            "v_sales",
            "v_delivered",
            m=b.REVENUE_SQL,
            d=b.DELIVERY_SQL,
        ),
    ),
    "quality_no_null_state": Query(
        lambda v: _rules(
            v,
            "receita_por_estado",
            b.revenue_by_state,
            c.RowRule("sem_estado_nulo", c.missing("estado"), "nulos"),
        ),
        with_views(_NULL_STATE_SQL, "v_sales", "v_customers", s=b.STATE_SQL),
    ),
    "quality_range_pct": Query(
        _ranges,
        with_views(
            _all(_PCT_RANGE_SQL, _SCORE_RANGE_SQL),
            "v_delivered",
            "v_reviews",
            d=b.DELIVERY_SQL,
            sat=b.SATISFACTION_SQL,
        ),
    ),
    "quality_category_set": Query(
        lambda v: c.category_set(
            b.delivery_satisfaction(v), "status_entrega", (g.ON_TIME, g.LATE), "gold", "satisfacao_entrega"
        ),
        with_views(category_sql("sat"), "v_delivered", "v_reviews", sat=b.SATISFACTION_SQL),
    ),
    # Checked against the raised minimum, so that some sellers break the rule.
    "quality_min_orders": Query(
        lambda v: _rules(
            v,
            "ranking_vendedores",
            b.seller_ranking,
            c.RowRule(
                "filtro_minimo_pedidos_respeitado",
                c.below("qtd_pedidos", b.RAISED_MIN_ORDERS),
                "abaixo do mínimo",
            ),
        ),
        with_views(
            _min_orders_sql(b.RAISED_MIN_ORDERS), *b.RANKING_VIEWS, rank=b.ranking_sql(5)
        ),
    ),
    "gold_check_verdicts": Query(
        lambda v: g.gold_checks(_gold_tables(v), v.order_items()), _GOLD_SQL
    ),
    "silver_check_verdicts": Query(_silver_verdicts, _silver_sql("SELECT * FROM {verdicts}")),
    "quality_log_summary": Query(
        lambda v: c.log_summary(c.stamp(_silver_verdicts(v), "query"), "silver"),
        _silver_sql(
            'SELECT tabela, status, count(*) AS "count" FROM {verdicts} GROUP BY tabela, status'
        ),
    ),
}
