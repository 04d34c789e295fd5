"""Fixed schemas: listing, raw fields, export columns, ledger, state, logs."""

from __future__ import annotations

from pyspark.sql import types as T

# Export columns in order (also the listing's fields).
EXPORT_COLUMNS = (
    "property_id", "url", "title", "price", "price_currency",
    "location", "description", "images",
    "total_area", "internal_area", "number_of_bedrooms", "floor",
    "status", "type", "furnished", "mortgage", "elevator",
    "number_of_toilets", "characteristics",
)
REQUIRED_FIELDS = ("property_id", "url", "title")

# raw field name -> listing field name, where the two differ
FIELD_RENAMES = {
    "price_raw": "price",
    "statusi": "status",
    "lloji": "type",
    "mobilimi": "furnished",
    "ka_hipoteke": "mortgage",
    "ashensor": "elevator",
    "karakteristikat": "characteristics",
}
RAW_FIELDS = tuple(
    {new: old for old, new in FIELD_RENAMES.items()}.get(name, name) for name in EXPORT_COLUMNS
)


def _field_type(name: str) -> T.DataType:
    return {"price": T.DoubleType(), "images": T.ArrayType(T.StringType())}.get(name, T.StringType())


LISTING = T.StructType([T.StructField(name, _field_type(name)) for name in EXPORT_COLUMNS])
EXPORT = T.StructType(
    [T.StructField(n, T.DoubleType() if n == "price" else T.StringType()) for n in EXPORT_COLUMNS]
)
RAW_LISTING = T.StructType([T.StructField(name, _field_type(name)) for name in RAW_FIELDS])

def struct_of(**fields: T.DataType) -> T.StructType:
    """Schema of nullable fields; needs no session, unlike DDL text."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


STRING, LONG, INT, DOUBLE, TIME, FLAG = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType(), T.BooleanType(),
)

PAGES = struct_of(page_id=LONG, url=STRING, html=STRING)
FAILURE_LEDGER = struct_of(url=STRING, error=STRING, attempts=INT, ts=TIME)
STATE = struct_of(key=STRING, value_json=STRING, updated_at=TIME)
REQUEST_LOG = struct_of(
    seq=LONG, ts=TIME, host=STRING, url=STRING, phase=STRING, status=INT,
    error=STRING, duration_secs=DOUBLE, worker_id=INT,
)
METRICS = struct_of(ts=TIME, kind=STRING, name=STRING, labels=T.MapType(STRING, STRING), value=DOUBLE)
LOG_LINES = struct_of(ts=STRING, level=STRING, logger=STRING, msg=STRING, file=STRING, exc=STRING)
