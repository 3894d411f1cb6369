"""Declared schemas and constraints of the shop tables and the product listing."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ForeignKey:
    """Columns of a table whose values must occur as keys of a parent table.

    ``where`` (a SQL predicate) says which rows of the parent count, ``named`` what the
    constraint is called in place of the default.
    """

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    where: str | None = None
    named: str | None = None

    @property
    def name(self) -> str:
        return self.named or f"{'_'.join(self.columns)}_to_{self.parent}"


@dataclass(frozen=True)
class TableRules:
    """What a table promises about its rows.

    ``checks`` maps a constraint name to a SQL predicate; a row breaks it only when
    the predicate is false, so a NULL passes. ``defaults`` are SQL expressions for
    columns that an insert leaves out, ``schema`` is the DDL text of its columns.
    """

    name: str
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)
    schema: str | None = None


# Column names, types and rules of the four shop tables.
CUSTOMERS = TableRules(
    name="customers",
    schema=(
        "customer_id INT, first_name STRING, last_name STRING, email STRING, "
        "city STRING, state STRING, join_date DATE, is_premium BOOLEAN"
    ),
    primary_key=("customer_id",),
    unique=(("email",),),
    not_null=("first_name", "last_name", "email", "city", "state", "join_date"),
    defaults={"is_premium": "false"},
)

PRODUCTS = TableRules(
    name="products",
    schema=(
        "product_id INT, product_name STRING, category STRING, brand STRING, "
        "unit_price DECIMAL(10,2), stock_qty INT"
    ),
    primary_key=("product_id",),
    not_null=("product_name", "category", "brand", "unit_price", "stock_qty"),
    checks={"unit_price_positive": "unit_price > 0", "stock_not_negative": "stock_qty >= 0"},
    defaults={"stock_qty": "0"},
)

ORDERS = TableRules(
    name="orders",
    schema=(
        "order_id INT, customer_id INT, order_date DATE, status STRING, "
        "total_amount DECIMAL(12,2)"
    ),
    primary_key=("order_id",),
    not_null=("customer_id", "order_date", "status", "total_amount"),
    checks={
        "status_known": "status IN ('Pending', 'Shipped', 'Delivered', 'Cancelled')",
        "total_not_negative": "total_amount >= 0",
    },
    foreign_keys=(ForeignKey(("customer_id",), "customers", ("customer_id",)),),
    defaults={"status": "'Pending'"},
)

ORDER_ITEMS = TableRules(
    name="order_items",
    schema=(
        "item_id INT, order_id INT, product_id INT, quantity INT, "
        "unit_price DECIMAL(10,2), discount_pct DECIMAL(5,2)"
    ),
    primary_key=("item_id",),
    not_null=("order_id", "product_id", "quantity", "unit_price"),
    checks={
        "quantity_positive": "quantity > 0",
        "unit_price_positive": "unit_price > 0",
        "discount_is_percent": "discount_pct BETWEEN 0 AND 100",
    },
    foreign_keys=(
        ForeignKey(("order_id",), "orders", ("order_id",)),
        ForeignKey(("product_id",), "products", ("product_id",)),
    ),
    defaults={"discount_pct": "0"},
)

SHOP = {rules.name: rules for rules in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS)}

# The listing columns that are known by name, and those filled as text.
LISTING_SCHEMA = (
    "product_id STRING, title STRING, category STRING, rating DOUBLE, "
    "ratings_count BIGINT, initial_price DOUBLE, discount DOUBLE, final_price STRING, "
    "what_customers_said STRING, seller_name STRING, seller_information STRING, "
    "videos STRING, variations STRING"
)
LISTING_TEXT_COLUMNS = (
    "what_customers_said", "seller_name", "seller_information", "videos", "variations",
)
