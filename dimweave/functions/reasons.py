"""Reject reasons: one text fragment per failed check, in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fragment texts.
NO_ORDER_ID = "Missing OrderID; "
NO_LINE = "Missing OrderDetails row for OrderID; "
LINE_WITHOUT_ORDER_ID = "Missing OrderID in OrderDetails; "
LINE_WITHOUT_ORDER = "Invalid OrderID_NK in OrderDetails, matching Orders row is missing; "
NO_PRODUCT = "Missing ProductID; "
BAD_PRODUCT = "Invalid ProductID_NK, product is missing or not current; "
ORDER_KEY_TEXTS = {
    "CustomerID_NK": ("Missing CustomerID; ", "Invalid CustomerID_NK; "),
    "EmployeeID_NK": ("Missing EmployeeID; ", "Invalid EmployeeID_NK, employee is missing; "),
    "ShipperID_NK": ("Missing ShipVia/ShipperID; ", "Invalid ShipVia/ShipperID_NK; "),
    "TerritoryID_NK": ("Missing TerritoryID; ", "Invalid TerritoryID_NK; "),
}


def unresolved(nk: str, fk: str, missing: str, invalid: str) -> Column:
    """``missing`` for a NULL natural key, ``invalid`` for one that found no surrogate key."""
    return F.when(F.col(nk).isNull(), F.lit(missing)).when(F.col(fk).isNull(), F.lit(invalid))


def join_reasons(*fragments: Column) -> Column:
    """All fragments that apply, NULL when none does."""
    return F.nullif(F.concat_ws("", *fragments), F.lit(""))
