"""Data model of the property graph: labels, endpoint map, staged schemas.

Vertices are kept per label in fixed-schema staged tables (``name`` plus
properties) and, once ids are assigned, with a leading ``id`` column.
Edges are kept as ``(label, start_id, end_id, mgm)``; only CALL edges carry
``mgm``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the source graph's schema) -------------------
# Vertex labels, upper case (the source store is case-insensitive, the
# target is case-sensitive, so everything is upper-cased on the way in).
MOBILE = "MOBILE"
DEVICE = "DEVICE"
WIFI = "WIFI"
VERTEX_LABELS = (DEVICE, MOBILE, WIFI)

# Edge labels and their (start label, end label).
CALL = "CALL"
HAS = "HAS"
USE = "USE"
USE_WIFI = "USE_WIFI"
EDGE_ENDPOINTS = {
    CALL: (MOBILE, MOBILE),
    USE: (MOBILE, DEVICE),
    HAS: (DEVICE, MOBILE),
    USE_WIFI: (MOBILE, WIFI),
}
EDGE_LABELS = tuple(EDGE_ENDPOINTS)

# Staged mobile columns, in order; the last three are integers.
MOBILE_COLUMNS = (
    "name", "nm_pass", "nm_sha1", "is_register", "is_risk", "is_internal",
    "is_service", "merchant_name", "status", "suspect_risk", "overdue_status",
)
MOBILE_INT_COLUMNS = ("status", "suspect_risk", "overdue_status")
# Staged device and wifi columns (shared schema).
DEVICE_COLUMNS = ("name", "is_exception", "is_white")
# Properties a mobile vertex carries in the export (the digest columns are
# derived by the loader, not stored in the source).
MOBILE_EXPORT_COLUMNS = (
    "name", "is_register", "is_risk", "is_internal", "is_service",
    "merchant_name", "status", "suspect_risk", "overdue_status",
)
# Label codes used in exported vertex lines, ``label[code.local]{json}``.
EXPORT_LABEL_CODES = {DEVICE: 10, MOBILE: 11, WIFI: 12}
# Tags used when names of the three labels are checked for conflicts.
LABEL_TAGS = {DEVICE: "d", WIFI: "w", MOBILE: "m"}
# Null marker in exported edge text.
NULL_MARK = "\\N"
# Separators of the adjacency line: fields, vertex/in/out sections, edges.
FIELD_SEP = ","
SECTION_SEP = "\t"
EDGE_SEP = "|"
# --- end of fixed values ----------------------------------------------------

# Wide vertex schema: every property of every label; absent ones are null.
WIDE_VERTEX_COLUMNS = MOBILE_COLUMNS + ("is_exception", "is_white")


def _fields(cols, ints=()):
    return [T.StructField(c, T.IntegerType() if c in ints else T.StringType(), True) for c in cols]


MOBILE_SCHEMA = T.StructType(_fields(MOBILE_COLUMNS, MOBILE_INT_COLUMNS))
DEVICE_SCHEMA = T.StructType(_fields(DEVICE_COLUMNS))
CALL_SCHEMA = T.StructType([
    T.StructField("start_name", T.StringType(), True),
    T.StructField("end_name", T.StringType(), True),
    T.StructField("mgm", T.IntegerType(), True),
])
EDGE_SCHEMA = T.StructType([
    T.StructField("start_name", T.StringType(), True),
    T.StructField("end_name", T.StringType(), True),
])
ID_MAP_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), True),
])
RESOLVED_EDGE_SCHEMA = T.StructType([
    T.StructField("label", T.StringType(), False),
    T.StructField("start_id", T.LongType(), False),
    T.StructField("end_id", T.LongType(), True),
    T.StructField("mgm", T.IntegerType(), True),
])
WIDE_VERTEX_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType(), False), T.StructField("label", T.StringType(), False)]
    + _fields(WIDE_VERTEX_COLUMNS, MOBILE_INT_COLUMNS)
)


def columns_for(label: str) -> tuple[str, ...]:
    """Staged property columns of a vertex label."""
    return MOBILE_COLUMNS if label == MOBILE else DEVICE_COLUMNS
