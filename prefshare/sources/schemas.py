"""File layouts: header in the file, name in our frames, type.

Quantities are doubles: shares are, and a fractional quantity stays what it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    header: str
    name: str
    type: T.DataType
    # Text that is no such value ends the job instead of becoming null.
    strict: bool = False


TEXT = T.StringType()
NUMBER = T.DoubleType()

# Headers are fixed by the files.
TRANSACTIONS = (
    Field("analytic_id", "analytic_id", TEXT),
    Field("package_id", "package_id", TEXT),
    Field("total_transaction", "total_transaction", NUMBER, strict=True),
)
OLD_TARIFF = (
    Field("Promotion Code", "promotion_code", TEXT),
    Field("Package Name", "package_name", TEXT),
)
NEW_TARIFF = (
    Field("PromotionCode", "promotion_code", TEXT),
    Field("PackageName", "package_name", TEXT),
)
ATTRIBUTES = (
    Field("Package_Name", "package_name", TEXT),
    Field("Package_Duration", "duration", NUMBER),
    Field("Price", "price", NUMBER),
    Field("Package_Size", "size", TEXT),
)
