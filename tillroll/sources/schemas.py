"""Named schema registry for the star schema (CSV ingestion)."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I, _DT, _TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.DateType(), T.TimestampType()


def _struct(fields: list[tuple[str, T.DataType, bool]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


CUSTOMERS = _struct([
    ("customer_id", _S, False), ("first_name", _S, True), ("last_name", _S, True),
    ("email", _S, True), ("phone", _S, True), ("registration_date", _DT, True),
    ("country", _S, True), ("city", _S, True), ("age_group", _S, True),
    ("customer_segment", _S, True),
])

PRODUCTS = _struct([
    ("product_id", _S, False), ("product_name", _S, True), ("category", _S, True),
    ("subcategory", _S, True), ("brand", _S, True), ("price", _D, True),
    ("cost", _D, True), ("launch_date", _DT, True),
])

TRANSACTIONS = _struct([
    ("transaction_id", _S, False), ("customer_id", _S, False), ("product_id", _S, False),
    ("quantity", _I, True), ("unit_price", _D, True), ("discount_amount", _D, True),
    ("total_amount", _D, True), ("transaction_date", _TS, True),
    ("payment_method", _S, True), ("channel", _S, True), ("status", _S, True),
])

_REGISTRY = {"customers": CUSTOMERS, "products": PRODUCTS, "transactions": TRANSACTIONS}


def retail_schemas() -> dict[str, T.StructType]:
    """All registered schemas by name."""
    return dict(_REGISTRY)


def schema_for(name: str) -> T.StructType:
    """The registered schema; an unknown name raises ``KeyError``."""
    try:
        return _REGISTRY[name]
    except KeyError:
        raise KeyError(f"Schema '{name}' not found; known: {sorted(_REGISTRY)}") from None
