"""What each raw table must look like. All entries are fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Contract:
    """Columns in load order with their types, and how the table is stored.

    Types are Spark types; ``varchar(n)`` is text whose length is checked.
    ``multiline`` marks files with line breaks inside quotes. Such files cannot be
    split, so it is set only where free text occurs.
    """

    columns: dict[str, str]
    required: str | None = None
    partition_by: str | None = None
    sort_key: str | None = None
    multiline: bool = False
    lengths: dict[str, int] = field(init=False)

    def __post_init__(self) -> None:
        lengths = {
            name: int(kind[len("varchar(") : -1])
            for name, kind in self.columns.items()
            if kind.startswith("varchar(")
        }
        object.__setattr__(self, "lengths", lengths)

    def spark_type(self, column: str) -> str:
        kind = self.columns[column]
        return "string" if kind.startswith("varchar(") else kind

    @property
    def has_rules(self) -> bool:
        """Whether a row can break the contract."""
        return bool(self.lengths or self.required)

    @property
    def timestamps(self) -> list[str]:
        return [c for c, kind in self.columns.items() if kind == "timestamp_ntz"]


CONTRACTS: dict[str, Contract] = {
    "orders": Contract(
        {
            "order_id": "varchar(64)",
            "customer_id": "varchar(64)",
            "order_status": "varchar(32)",
            "order_purchase_timestamp": "timestamp_ntz",
            "order_approved_at": "timestamp_ntz",
            "order_delivered_carrier_date": "timestamp_ntz",
            "order_delivered_customer_date": "timestamp_ntz",
            "order_estimated_delivery_date": "timestamp_ntz",
        },
        required="order_id",
        partition_by="order_purchase_timestamp",
        sort_key="order_purchase_timestamp",
    ),
    "customers": Contract(
        {
            "customer_id": "varchar(64)",
            "customer_unique_id": "varchar(64)",
            "customer_zip_code_prefix": "varchar(16)",
            "customer_city": "varchar(128)",
            "customer_state": "varchar(8)",
        },
        required="customer_id",
        sort_key="customer_id",
    ),
    "order_items": Contract(
        {
            "order_id": "varchar(64)",
            "order_item_id": "int",
            "product_id": "varchar(64)",
            "seller_id": "varchar(64)",
            "shipping_limit_date": "timestamp_ntz",
            "price": "decimal(10,2)",
            "freight_value": "decimal(10,2)",
        },
        required="order_id",
        sort_key="order_id",
    ),
    "payments": Contract(
        {
            "order_id": "varchar(64)",
            "payment_sequential": "int",
            "payment_type": "varchar(32)",
            "payment_installments": "int",
            "payment_value": "decimal(10,2)",
        },
        required="order_id",
        sort_key="order_id",
    ),
    "reviews": Contract(
        {
            "review_id": "varchar(64)",
            "order_id": "varchar(64)",
            "review_score": "int",
            "review_comment_title": "varchar(256)",
            "review_comment_message": "varchar(1024)",
            "review_creation_date": "timestamp_ntz",
            "review_answer_timestamp": "timestamp_ntz",
        },
        required="review_id",
        partition_by="review_creation_date",
        sort_key="review_creation_date",
        multiline=True,
    ),
    "products": Contract(
        {
            "product_id": "varchar(64)",
            "product_category_name": "varchar(128)",
            "product_name_lenght": "int",
            "product_description_lenght": "int",
            "product_photos_qty": "int",
            "product_weight_g": "decimal(10,2)",
            "product_length_cm": "decimal(10,2)",
            "product_height_cm": "decimal(10,2)",
            "product_width_cm": "decimal(10,2)",
        },
        required="product_id",
        sort_key="product_id",
    ),
    "sellers": Contract(
        {
            "seller_id": "varchar(64)",
            "seller_zip_code_prefix": "varchar(16)",
            "seller_city": "varchar(128)",
            "seller_state": "varchar(8)",
        },
        required="seller_id",
        sort_key="seller_id",
    ),
    "geolocation": Contract(
        {
            "geolocation_zip_code_prefix": "varchar(16)",
            "geolocation_lat": "decimal(18,15)",
            "geolocation_lng": "decimal(18,15)",
            "geolocation_city": "varchar(128)",
            "geolocation_state": "varchar(8)",
        },
    ),
    "category_translation": Contract(
        {
            "product_category_name": "varchar(128)",
            "product_category_name_english": "varchar(128)",
        },
        required="product_category_name",
        sort_key="product_category_name",
    ),
}
