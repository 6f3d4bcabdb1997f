"""Incremental operations over the given tables; each must give what a full run gives."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlayers import registry as r
from cartlayers.operators import checks as c
from cartlayers.operators.combine import union_all
from cartlayers.operators.merge import merge_first
from cartlayers.operators.skew import left_join
from cartlayers.plans import gold as g
from cartlayers.plans import maintained as m
from cartlayers.plans.layers import quarantine
from cartlayers.plans.silver import after_dedup, before_dedup
from cartlayers.queries import business as b
from cartlayers.queries.cleaning import RAW_COLUMNS, RAW_SQL, cast_sql, clean_sql, raw_tables
from cartlayers.queries.entry import Query
from cartlayers.queries.quality import verdict_sql
from cartlayers.queries.view_sql import with_views
from cartlayers.queries.views import Views
from cartlayers.settings import Settings
from cartlayers.sources.arrivals import land
from cartlayers.sources.landing import AUDIT_COLUMNS
from cartlayers.sources.releases import ReleaseStore
from cartlayers.sources.scratch import scratch_folder

BATCHES, BUCKETS = 5, 16


def _store(v: Views) -> ReleaseStore:
    return ReleaseStore(v.spark, scratch_folder(v.spark))


def _merged(table: str, v: Views) -> DataFrame:
    """The cleaned table after its raw rows have come in five batches, copies of a key in several of them."""
    spec, store = r.TABLES[table], _store(v)
    raw = before_dedup(spec, getattr(v, f"raw_{table}")())
    batch = F.pmod(F.xxhash64(*raw.columns), F.lit(BATCHES))
    for n in range(BATCHES):
        base = store.current()
        done = merge_first(store, table, raw.where(batch == n), spec.dedup_key, spec.dedup_order, BUCKETS, base)
        store.commit({table: done.stored}, f"batch {n}", based_on=base)
    return after_dedup(spec, store.open(store.current().tables[table]))


def merged(table: str) -> Query:
    return Query(partial(_merged, table), with_views(clean_sql(table), RAW_SQL[table]))


def _versions(v: Views, store: ReleaseStore) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """An earlier state of the cleaned tables and the tables: some orders were missing, some had other rows,
    some customers lived elsewhere, and some orders were there that have been deleted since.

    Views that shuffle are stored, as cleaned tables are, since both states are read several times."""
    orders, items = (store.open(store.write(getattr(v, n)(), n)) for n in ("orders", "order_items"))
    after = {
        "orders": orders, "order_items": items, "customers": v.customers(),
        "reviews": v.reviews(), "sellers": v.sellers(),
    }
    key = F.col("order_id")
    gone = [t.where(key % 23 == 7).withColumn("order_id", -key) for t in (after["orders"], after["order_items"])]
    status = F.when(key % 17 == 3, F.lit("shipped")).otherwise(F.col("order_status"))
    price = F.when(key % 19 == 4, F.lit(1).cast(r.MONEY)).otherwise(F.col("price"))
    state = F.when(F.col("customer_id") % 29 == 0, F.lit("ELSEWHERE")).otherwise(F.col("customer_state"))
    before = {
        "orders": after["orders"].withColumn("order_status", status).unionByName(gone[0]).where(key % 13 != 5),
        "order_items": after["order_items"].withColumn("price", price).unionByName(gone[1]).where(key % 13 != 5),
        "customers": after["customers"].withColumn("customer_state", state),
        "reviews": after["reviews"].where(key % 31 != 2),
        "sellers": after["sellers"],
    }
    return before, after


def _maintained(table: str, v: Views) -> DataFrame:
    """A business table from the totals of the earlier state and the orders that have changed since."""
    store = _store(v)
    before, after = _versions(v, store)
    held = store.open(store.write(m.totals(before)[table], table))
    affected = store.open(store.write(m.changed_orders(before, after), "affected"))
    gone, come = (m.totals(state, affected)[table] for state in (before, after))
    sums = store.open(store.write(m.updated(held, gone, come, m.GROUPS[table]), table))
    return g.present(table, m.shown({table: sums}, after["sellers"])[table])


def maintained(table: str, like: str) -> Query:
    return Query(partial(_maintained, table), b.QUERIES[like].sql)


def _landed(v: Views) -> DataFrame:
    """Raw rows of customers that landed as files at two times, with an idle run in between."""
    folder = scratch_folder(v.spark)
    settings = Settings(raw_path=f"{folder}/landing", storage_path=folder)
    spec = r.TABLES["customers"]
    store = ReleaseStore.of(v.spark, settings, "bronze")
    rows, early = v.raw_customers(), F.pmod(F.xxhash64("customer_id"), F.lit(2)) == 0
    stem = settings.landing_path(spec.file).removesuffix(".csv")
    for n, part in enumerate((rows.where(early), rows.where(~early))):
        written = f"{folder}/written{n}"
        options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        part.write.options(**options).csv(written)
        for i, file in enumerate(x for x in store.files.names(written) if x.endswith(".csv")):
            store.files.move(f"{written}/{file}", f"{stem}_{n}_{i}.csv")
        land(v.spark, settings, spec, f"run {n}")
        land(v.spark, settings, spec, f"idle {n}")
    return store.open(store.current().tables["customers"]).drop(*AUDIT_COLUMNS)


def _heavy_states(v: Views) -> DataFrame:
    """Every nation with its customers: 25 keys hold all rows of the right side."""
    nations = v.table("nation").select(F.upper("n_name").alias("customer_state"), "n_regionkey")
    more = nations.limit(1).select(F.lit("NOWHERE").alias("customer_state"), "n_regionkey")
    return left_join(nations.unionByName(more.withColumn("n_regionkey", F.lit(0))), v.customers(), "customer_state")


_HEAVY_SQL = with_views(
    """SELECT customer_state, n_regionkey, customer_id, customer_city
       FROM (SELECT upper(n_name) AS customer_state, n_regionkey FROM nation UNION ALL SELECT 'NOWHERE', 0)
       LEFT JOIN v_customers USING (customer_state)""",
    "v_customers",
)


def _quarantine_sql() -> str:
    parts = []
    for name, spec in r.TABLES.items():
        named = ", ".join(f"'{k}', {k}" for k in spec.naming)
        parts += [
            f"SELECT '{name}' AS tabela, CAST(json_object({named}) AS VARCHAR) AS chave, '{col}' AS coluna, "
            f"'{kind}' AS tipo, {col} AS valor FROM {RAW_SQL[name]} "
            f"WHERE {col} IS NOT NULL AND {cast_sql(col, kind)} IS NULL"
            for col, kind in spec.types.items()
        ]
    return with_views(" UNION ALL ".join(parts), *[RAW_SQL[n] for n, s in r.TABLES.items() if s.types])


#: Tables whose stored rows differ: in orders two cells of a row change places, of sellers a copy is lost.
def _damaged(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    bought, sent = "order_purchase_timestamp", "order_delivered_carrier_date"
    swap = F.col("customer_id") == "7"
    orders = raw["orders"].withColumns(
        {bought: F.when(swap, F.col(sent)).otherwise(F.col(bought)), sent: F.when(swap, F.col(bought)).otherwise(F.col(sent))}
    )
    return {**raw, "orders": orders, "sellers": raw["sellers"].distinct().where(F.col("seller_id") != "4")}


def _content(v: Views) -> DataFrame:
    raw = raw_tables(v)
    stored = _damaged(raw)
    return union_all([c.content_match(raw[n], stored[n], "bronze", n) for n in r.TABLES])


def _content_sql() -> str:
    swapped = ", ".join(
        {
            "order_purchase_timestamp": "CASE WHEN customer_id = '7' THEN order_delivered_carrier_date "
            "ELSE order_purchase_timestamp END AS order_purchase_timestamp",
            "order_delivered_carrier_date": "CASE WHEN customer_id = '7' THEN order_purchase_timestamp "
            "ELSE order_delivered_carrier_date END AS order_delivered_carrier_date",
        }.get(col, col)
        for col in RAW_COLUMNS["orders"]
    )
    stored = {**RAW_SQL, "orders": "damaged_orders", "sellers": "damaged_sellers"}
    parts = []
    for name, source in RAW_SQL.items():
        columns = ", ".join(RAW_COLUMNS[name])
        other = f"SELECT {columns} FROM {stored[name]}"
        own = f"SELECT {columns} FROM {source}"
        differing = f"((SELECT count(*) FROM ({own} EXCEPT ALL {other})) + (SELECT count(*) FROM ({other} EXCEPT ALL {own})))"
        parts.append(
            verdict_sql(
                "bronze", name, "conteudo_vs_origem", "d = 0",
                "n || CASE WHEN d = 0 THEN ' linhas iguais' ELSE ' linhas, conteúdo diferente' END",
                f"SELECT {differing} AS d, (SELECT count(*) FROM {stored[name]}) AS n",
            )
        )
    return with_views(
        " UNION ALL ".join(parts),
        *RAW_SQL.values(),
        damaged_orders=f"SELECT {swapped} FROM r_orders",
        damaged_sellers="SELECT DISTINCT * FROM r_sellers WHERE seller_id <> '4'",
    )


QUERIES: dict[str, Query] = {
    "merged_orders": merged("orders"),
    "merged_order_items": merged("order_items"),
    "merged_category_translation": merged("category_translation"),
    "maintained_monthly_revenue": maintained("receita_mensal", "monthly_revenue"),
    "maintained_revenue_by_state": maintained("receita_por_estado", "revenue_by_state"),
    "maintained_delivery_performance": maintained("performance_entrega_mensal", "delivery_performance"),
    "maintained_satisfaction": maintained("satisfacao_entrega", "delivery_satisfaction"),
    "maintained_seller_ranking": maintained("ranking_vendedores", "seller_ranking"),
    "landed_customers": Query(_landed, with_views("SELECT * FROM r_customers", "r_customers")),
    "join_left_heavy": Query(_heavy_states, _HEAVY_SQL),
    "quarantined_values": Query(lambda v: quarantine(raw_tables(v)), _quarantine_sql()),
    "quality_content": Query(_content, _content_sql()),
}
