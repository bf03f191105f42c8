"""What the raw files must look like: nine tables, text columns, fixed headers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql.types import StringType, StructField, StructType

_IDENTIFIER = re.compile(r"^[a-z_][a-z0-9_]*$")

# Columns of every raw table.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
    "geolocation": (
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ),
    "order_items": (
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
    "order_payments": (
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ),
    "order_reviews": (
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ),
    "orders": (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "products": (
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "sellers": (
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    ),
    "product_category_name_translation": (
        "product_category_name",
        "product_category_name_english",
    ),
}


@dataclass(frozen=True)
class SourceFiles:
    """Where each raw table's file lies under the landing folder.

    ``pattern`` builds a file name from a table name; ``names`` overrides it
    for single tables.
    """

    pattern: str = "{table}.csv"
    names: tuple[tuple[str, str], ...] = ()

    def file_name(self, table: str) -> str:
        return dict(self.names).get(table, self.pattern.format(table=table))

    def all(self) -> dict[str, str]:
        """File name by table; two tables cannot share one."""
        names = {table: self.file_name(table) for table in RAW_COLUMNS}
        for name in sorted(set(names.values())):
            tables = [t for t, n in names.items() if n == name]
            if len(tables) > 1:
                raise ValueError(f"{name} stands for {', '.join(tables)}")
        return names


def raw_schema(columns: list[str] | tuple[str, ...]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


class HeaderError(ValueError):
    """One or more landing files do not have the header their table needs."""


def clean_header(header: Sequence[str] | None) -> list[str]:
    return [name.strip() for name in header or ()]


def header_faults(header: Sequence[str]) -> list[str]:
    """What makes a header unusable as column names; nothing if it can be used."""
    if not header:
        return ["is empty"]
    unsafe = [name for name in header if not _IDENTIFIER.match(name)]
    repeated = sorted({name for name in header if header.count(name) > 1})
    return [f"has the unsafe column name {name!r}" for name in unsafe] + [
        f"repeats the column {name}" for name in repeated
    ]


def difference(header: Sequence[str], wanted: Sequence[str], ordered: bool) -> list[str]:
    """How a header departs from the wanted columns; their order counts if ``ordered``."""
    found = [f"lacks the column {name}" for name in wanted if name not in header]
    found += [f"has the extra column {name}" for name in header if name not in wanted]
    if ordered and not found and list(header) != list(wanted):
        found.append("has its columns in another order than the table")
    return found


def require_headers(faults: Mapping[str, Sequence[str]]) -> None:
    """Raise one error that names every fault of every file."""
    told = [f"{file_name} {fault}" for file_name, found in faults.items() for fault in found]
    if told:
        raise HeaderError("; ".join(told))
