"""Declared source schemas and the load policy of each dimension.

Column names, text lengths and the system-of-record list are fixed values of the data
model; everything else (target schemas, tracked columns) is derived from them.
Identifier columns are 64-bit so that keys do not run out on large loads.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

ROW_ID = "staging_raw_id_sk"
LINEAGE_ROW = "staging_raw_id_nk"
LINEAGE_SOURCE = "SOR_SK"

MONEY = T.DecimalType(19, 4)
RATE = T.DecimalType(10, 4)


def _ident(name):
    return T.StructField(name, T.LongType())


def _count(name):
    return T.StructField(name, T.IntegerType())


def _text(name, length=None):
    return T.StructField(name, T.StringType(), True, {"max_length": length} if length else {})


def _date(name):
    return T.StructField(name, T.DateType())


def _decimal(name, kind):
    return T.StructField(name, kind)


_COMPANY_CONTACT = [
    _text("CompanyName", 100), _text("ContactName", 100), _text("ContactTitle", 100),
    _text("Address", 200), _text("City", 100), _text("Region", 100), _text("PostalCode", 30),
    _text("Country", 100), _text("Phone", 50), _text("Fax", 50),
]

# The ten source sheets and their columns.
STAGING = {
    "Categories": T.StructType([
        _ident("CategoryID"), _text("CategoryName", 100), _text("Description", 500)]),
    "Customers": T.StructType([_text("CustomerID", 10), *_COMPANY_CONTACT]),
    "Employees": T.StructType([
        _ident("EmployeeID"), _text("LastName", 50), _text("FirstName", 50), _text("Title", 100),
        _text("TitleOfCourtesy", 50), _date("BirthDate"), _date("HireDate"), _text("Address", 200),
        _text("City", 100), _text("Region", 100), _text("PostalCode", 30), _text("Country", 100),
        _text("HomePhone", 50), _text("Extension", 20), _text("Notes"), _ident("ReportsTo"),
        _text("PhotoPath", 300)]),
    "OrderDetails": T.StructType([
        _ident("OrderID"), _ident("ProductID"), _decimal("UnitPrice", MONEY), _count("Quantity"),
        _decimal("Discount", RATE)]),
    "Orders": T.StructType([
        _ident("OrderID"), _text("CustomerID", 10), _ident("EmployeeID"), _date("OrderDate"),
        _date("RequiredDate"), _date("ShippedDate"), _ident("ShipVia"), _decimal("Freight", MONEY),
        _text("ShipName", 100), _text("ShipAddress", 200), _text("ShipCity", 100),
        _text("ShipRegion", 100), _text("ShipPostalCode", 30), _text("ShipCountry", 100),
        _text("TerritoryID", 20)]),
    "Products": T.StructType([
        _ident("ProductID"), _text("ProductName", 100), _ident("SupplierID"), _ident("CategoryID"),
        _text("QuantityPerUnit", 100), _decimal("UnitPrice", MONEY), _count("UnitsInStock"),
        _count("UnitsOnOrder"), _count("ReorderLevel"),
        T.StructField("Discontinued", T.BooleanType())]),
    "Region": T.StructType([
        _ident("RegionID"), _text("RegionDescription", 100), _text("RegionCategory", 50),
        _text("RegionImportance", 50)]),
    "Shippers": T.StructType([_ident("ShipperID"), _text("CompanyName", 100), _text("Phone", 50)]),
    "Suppliers": T.StructType([_ident("SupplierID"), *_COMPANY_CONTACT, _text("HomePage")]),
    "Territories": T.StructType([
        _text("TerritoryID", 20), _text("TerritoryDescription", 100), _text("TerritoryCode", 20),
        _ident("RegionID")]),
}

# Sources in ingest order; the system-of-record key is the 1-based position.
SOURCES = list(STAGING)


def source_key(source: str) -> int:
    """System-of-record key of a source table; raises for an unknown source."""
    if source not in SOURCES:
        raise ValueError(f"{source!r} is not a registered source table")
    return SOURCES.index(source) + 1


SOR_TABLE = "Dim_SOR"
SOR = T.StructType([T.StructField("SOR_SK", T.IntegerType()), T.StructField("staging_raw_table_name", T.StringType())])


def sor_rows() -> list[tuple[int, str]]:
    """The system-of-record table: every source, whatever its sheet holds."""
    return [(source_key(s), s) for s in SOURCES]


def staged_schema(source: str) -> T.StructType:
    return T.StructType([T.StructField(ROW_ID, T.LongType()), *STAGING[source].fields])


@dataclass(frozen=True)
class Reference:
    """A source column resolved to the surrogate key of another dimension."""

    column: str
    dimension: str
    fk: str


@dataclass(frozen=True)
class DimensionPolicy:
    """How one dimension follows its source."""

    source: str
    target: str
    method: str  # "overwrite", "versions", "prior_value" or "history_table"
    key: str
    surrogate: str
    renames: dict = field(default_factory=dict)
    references: tuple[Reference, ...] = ()
    drop_vanished: bool = False
    durable: str | None = None
    close_vanished: bool = False
    new_version_needs_difference: bool = False
    prior: str | None = None
    history: str | None = None
    history_key: str | None = None

    @property
    def nk(self) -> str:
        return f"{self.key}_NK"

    @property
    def prior_value(self) -> str:
        return f"{self.prior}_Prev1"

    @property
    def prior_valid_to(self) -> str:
        return f"{self.prior}_Prev1_ValidTo"

    @property
    def attributes(self) -> list[T.StructField]:
        """Dimension attributes taken from the source, references included, under their own names."""
        fk_of = {ref.column: ref.fk for ref in self.references}
        out = []
        for f in STAGING[self.source].fields:
            if f.name == self.key:
                continue
            out.append(T.StructField(self.renames.get(f.name, f.name), f.dataType, True, f.metadata))
            if f.name in fk_of:
                out.append(T.StructField(fk_of[f.name], T.LongType()))
        return out

    @property
    def source_columns(self) -> list[T.StructField]:
        """Columns a prepared source row carries into the dimension."""
        key = STAGING[self.source][self.key]
        return [
            T.StructField(self.nk, key.dataType, True, key.metadata), *self.attributes,
            T.StructField(LINEAGE_SOURCE, T.IntegerType()), T.StructField(LINEAGE_ROW, T.LongType()),
        ]

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(self.surrogate, T.LongType())]
        if self.durable:
            fields.append(T.StructField(self.durable, T.LongType()))
        for f in self.source_columns:
            fields.append(f)
            if f.name == self.prior:
                fields.append(T.StructField(self.prior_value, T.StringType(), True, f.metadata))
                fields.append(T.StructField(self.prior_valid_to, T.DateType()))
        if self.method == "versions":
            fields += [T.StructField("ValidFrom", T.DateType()), T.StructField("ValidTo", T.DateType()),
                       T.StructField("IsCurrent", T.BooleanType())]
        if self.method == "history_table":
            fields.append(T.StructField("ValidFrom", T.DateType()))
        return T.StructType(fields)

    @property
    def history_schema(self) -> T.StructType:
        body = [f for f in self.schema.fields if f.name != self.surrogate]
        return T.StructType([T.StructField(self.history_key, T.LongType()), *body,
                             T.StructField("ValidTo", T.DateType())])


# Dimensions in load order: territories need regions, products need categories and suppliers.
POLICIES = {
    p.target: p
    for p in [
        DimensionPolicy("Categories", "DimCategories", "overwrite", "CategoryID", "CategoryID_SK",
                        drop_vanished=True),
        DimensionPolicy("Region", "DimRegion", "overwrite", "RegionID", "RegionID_SK"),
        DimensionPolicy("Shippers", "DimShippers", "overwrite", "ShipperID", "ShipperID_SK"),
        DimensionPolicy("Suppliers", "DimSuppliers", "history_table", "SupplierID", "SupplierID_SK",
                        history="DimSuppliers_History", history_key="SupplierHistoryID_SK"),
        DimensionPolicy("Employees", "DimEmployees", "overwrite", "EmployeeID", "EmployeeID_SK",
                        renames={"ReportsTo": "ReportsToEmployeeID_NK"}, drop_vanished=True),
        DimensionPolicy("Customers", "DimCustomers", "versions", "CustomerID", "CustomerID_TABLE_SK",
                        durable="CustomerID_DURABLE_SK", new_version_needs_difference=True),
        DimensionPolicy("Territories", "DimTerritories", "prior_value", "TerritoryID", "TerritoryID_SK",
                        renames={"RegionID": "RegionID_NK"}, prior="TerritoryCode",
                        references=(Reference("RegionID", "DimRegion", "RegionID_SK_FK"),)),
        DimensionPolicy("Products", "DimProducts", "versions", "ProductID", "ProductID_TABLE_SK",
                        renames={"SupplierID": "SupplierID_NK", "CategoryID": "CategoryID_NK"},
                        references=(Reference("SupplierID", "DimSuppliers", "SupplierID_SK_FK"),
                                    Reference("CategoryID", "DimCategories", "CategoryID_SK_FK")),
                        durable="ProductID_DURABLE_SK", close_vanished=True),
    ]
}


@dataclass(frozen=True)
class FactKey:
    """A dimension the fact refers to: source column, dimension and the fact's key columns."""

    column: str
    dimension: str
    fk: str
    nk: str


ORDER_KEYS = (
    FactKey("CustomerID", "DimCustomers", "CustomerID_TABLE_SK_FK", "CustomerID_NK"),
    FactKey("EmployeeID", "DimEmployees", "EmployeeID_SK_FK", "EmployeeID_NK"),
    FactKey("ShipVia", "DimShippers", "ShipperID_SK_FK", "ShipperID_NK"),
    FactKey("TerritoryID", "DimTerritories", "TerritoryID_SK_FK", "TerritoryID_NK"),
)
LINE_KEYS = (FactKey("ProductID", "DimProducts", "ProductID_TABLE_SK_FK", "ProductID_NK"),)

# Staged tables that meet by one key, and are laid out by it.
COLOCATED = {"Orders": "OrderID", "OrderDetails": "OrderID"}

# Columns of the staged tables that rows are joined on, where a few values may own many rows.
KEY_COLUMNS = {
    "Orders": ("OrderID", *(k.column for k in ORDER_KEYS)), "OrderDetails": ("OrderID", *(k.column for k in LINE_KEYS)),
    **{p.source: tuple(r.column for r in p.references) for p in POLICIES.values() if p.references},
}

ORDERS_ROW = "Orders_staging_raw_id_nk"
LINES_ROW = "OrderDetails_staging_raw_id_nk"
ORDERS_SOURCE = "Orders_SOR_SK"
LINES_SOURCE = "OrderDetails_SOR_SK"

_LINEAGE = [T.StructField(ORDERS_SOURCE, T.IntegerType()), T.StructField(ORDERS_ROW, T.LongType()),
            T.StructField(LINES_SOURCE, T.IntegerType()), T.StructField(LINES_ROW, T.LongType())]

_DATES = [_date("OrderDate"), _date("RequiredDate"), _date("ShippedDate")]
_MEASURES = [_decimal("Freight", MONEY), _decimal("UnitPrice", MONEY), _count("Quantity"),
             _decimal("Discount", RATE)]

# FactOrders: the grain is the pair of natural keys.
FACT_GRAIN = ["OrderID_NK", "ProductID_NK"]
FACT_COMPARED = T.StructType(
    [_ident(k.fk) for k in (*ORDER_KEYS, *LINE_KEYS)] + _DATES + _MEASURES + [_decimal("SalesAmount", MONEY)]
    + [f for f in STAGING["Orders"].fields if f.name.startswith("Ship") and isinstance(f.dataType, T.StringType)]
    + _LINEAGE)
FACT_SOURCE = T.StructType([_ident(c) for c in FACT_GRAIN] + FACT_COMPARED.fields)
FACT = T.StructType([_ident("FactOrder_SK"), *FACT_SOURCE.fields, _date("SnapshotDate"),
                     T.StructField("LoadDate", T.TimestampNTZType())])

# FactOrders_Error: natural keys as they came, no surrogate keys.
REJECT_SOURCE = T.StructType(
    [_ident("OrderID_NK"), _ident("ProductID_NK"), _text("CustomerID_NK", 10), _ident("EmployeeID_NK"),
     _ident("ShipperID_NK"), _text("TerritoryID_NK", 20)] + _DATES + _MEASURES + _LINEAGE
    + [_text("ErrorReason", 500)])
REJECT = T.StructType([_ident("FactOrder_Error_SK"), *REJECT_SOURCE.fields,
                       T.StructField("RejectedDate", T.TimestampNTZType())])

FACT_TABLE = "FactOrders"
REJECT_TABLE = "FactOrders_Error"


# Columns that may not be NULL and keys that may occur once only: in a table, or among the current rows of one with versions.
REQUIRED = {
    **{p.target: [p.surrogate, p.nk, LINEAGE_SOURCE, LINEAGE_ROW, *(["ValidFrom", "IsCurrent"] if p.method == "versions" else [])] for p in POLICIES.values()},
    **{p.history: [p.history_key, p.nk] for p in POLICIES.values() if p.history},
    FACT_TABLE: ["FactOrder_SK", *FACT_GRAIN, *[k.fk for k in (*ORDER_KEYS, *LINE_KEYS)], "SnapshotDate", "LoadDate"],
    REJECT_TABLE: ["FactOrder_Error_SK", "RejectedDate"],
}
UNIQUE = {
    **{p.target: [(p.surrogate,), (p.nk,)] for p in POLICIES.values()},
    FACT_TABLE: [tuple(FACT_GRAIN)],
    REJECT_TABLE: [("FactOrder_Error_SK",)],
}


def table_schema(name: str) -> T.StructType:
    """Schema of a warehouse table: staged source, dimension, history, fact, rejects or sources."""
    if name in STAGING:
        return staged_schema(name)
    if name in POLICIES:
        return POLICIES[name].schema
    for p in POLICIES.values():
        if p.history == name:
            return p.history_schema
    return {FACT_TABLE: FACT, REJECT_TABLE: REJECT, SOR_TABLE: SOR}[name]
