"""One declaration per data set: where it lands, how it is typed, cleaned and validated."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

MONEY = "decimal(10,2)"


@dataclass(frozen=True)
class ForeignKey:
    """`column` of the declaring table must exist as `parent_key` of `parent`."""

    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class TableSpec:
    """Everything the engine knows about one data set.

    `types` maps a raw text column to the type it is safely cast to; other columns stay text.
    `dedup_key` is empty for tables that keep all rows; `dedup_order` names the columns whose smallest
    values stay, by default all others. `points` are reduced to their centroids, `dated` tables get the
    date-consistency flag. `lower` and `upper` list the columns whose
    text is trimmed and case-folded, before deduplication when `text_first` is set, else after it.
    """

    name: str
    file: str
    types: Mapping[str, str] = field(default_factory=dict)
    reader: Mapping[str, str] = field(default_factory=dict)
    dedup_key: tuple[str, ...] = ()
    dedup_order: tuple[str, ...] = ()
    points: bool = False
    dated: bool = False
    required: tuple[str, ...] = ()
    defaults: Mapping[str, str] = field(default_factory=dict)
    lower: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    text_first: bool = False
    unique: str | None = None
    parents: tuple[ForeignKey, ...] = ()

    @property
    def naming(self) -> tuple[str, ...]:
        """Columns that tell which row it is: the key, or else the columns that refer to others."""
        return self.dedup_key or ((self.unique,) if self.unique else tuple(fk.column for fk in self.parents))


# Table names, landing file names, reader options, column names, column types, keys
# and the default category are part of the data set's contract.
ORDERS = TableSpec(
    name="orders",
    file="{prefix}orders_dataset.csv",
    types={
        "order_purchase_timestamp": "timestamp",
        "order_approved_at": "timestamp",
        "order_delivered_carrier_date": "timestamp",
        "order_delivered_customer_date": "timestamp",
        "order_estimated_delivery_date": "timestamp",
    },
    dedup_key=("order_id",),
    dated=True,
    required=("order_id",),
    unique="order_id",
    parents=(ForeignKey("customer_id", "customers", "customer_id"),),
)

CUSTOMERS = TableSpec(
    name="customers",
    file="{prefix}customers_dataset.csv",
    dedup_key=("customer_id",),
    lower=("customer_city",),
    upper=("customer_state",),
    unique="customer_id",
)

ORDER_ITEMS = TableSpec(
    name="order_items",
    file="{prefix}order_items_dataset.csv",
    types={"shipping_limit_date": "timestamp", "price": MONEY, "freight_value": MONEY},
    dedup_key=("order_id", "order_item_id"),
    parents=(
        ForeignKey("order_id", "orders", "order_id"),
        ForeignKey("product_id", "products", "product_id"),
        ForeignKey("seller_id", "sellers", "seller_id"),
    ),
)

PAYMENTS = TableSpec(
    name="payments",
    file="{prefix}order_payments_dataset.csv",
    types={"payment_value": MONEY, "payment_installments": "int"},
    parents=(ForeignKey("order_id", "orders", "order_id"),),
)

REVIEWS = TableSpec(
    name="reviews",
    file="{prefix}order_reviews_dataset.csv",
    # Free-text comments hold line breaks and doubled quotes.
    reader={"multiLine": "true", "quote": '"', "escape": '"'},
    types={
        "review_creation_date": "timestamp",
        "review_answer_timestamp": "timestamp",
        "review_score": "int",
    },
    dedup_key=("review_id",),
    unique="review_id",
    parents=(ForeignKey("order_id", "orders", "order_id"),),
)

PRODUCTS = TableSpec(
    name="products",
    file="{prefix}products_dataset.csv",
    # "lenght" is how the data set itself spells these two columns.
    types={
        "product_weight_g": "double",
        "product_length_cm": "double",
        "product_height_cm": "double",
        "product_width_cm": "double",
        "product_name_lenght": "int",
        "product_description_lenght": "int",
        "product_photos_qty": "int",
        "product_category_name": "string",
    },
    dedup_key=("product_id",),
    defaults={"product_category_name": "nao_informado"},
    lower=("product_category_name",),
    unique="product_id",
)

SELLERS = TableSpec(
    name="sellers",
    file="{prefix}sellers_dataset.csv",
    dedup_key=("seller_id",),
    lower=("seller_city",),
    upper=("seller_state",),
    unique="seller_id",
)

GEOLOCATION = TableSpec(
    name="geolocation",
    file="{prefix}geolocation_dataset.csv",
    types={
        "geolocation_lat": "double",
        "geolocation_lng": "double",
        "geolocation_city": "string",
        "geolocation_state": "string",
    },
    points=True,
    unique="geolocation_zip_code_prefix",
)

CATEGORY_TRANSLATION = TableSpec(
    name="category_translation",
    file="product_category_name_translation.csv",
    dedup_key=("product_category_name",),
    lower=("product_category_name", "product_category_name_english"),
    text_first=True,
    unique="product_category_name",
)

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        ORDERS,
        CUSTOMERS,
        ORDER_ITEMS,
        PAYMENTS,
        REVIEWS,
        PRODUCTS,
        SELLERS,
        GEOLOCATION,
        CATEGORY_TRANSLATION,
    )
}
