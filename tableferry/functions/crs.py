"""Geometry tags on columns, and the reference-system number inside CRS texts."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Metadata keys, extension name, column names taken for geometry, default.
NAME_KEY = "ARROW:extension:name"
META_KEY = "ARROW:extension:metadata"
WKB_EXTENSION = "geoarrow.wkb"
GEOMETRY_COLUMN_NAMES = ("GEOM", "GEOMETRY", "GEOM_WKB", "WKB_GEOMETRY")
DEFAULT_SRID = 4326


def crs_metadata(srid: int | None) -> dict[str, str]:
    """Column metadata that marks WKB; an unknown system gives an empty claim."""
    claim = "{}" if not srid else '{"crs":"EPSG:%d"}' % srid
    return {NAME_KEY: WKB_EXTENSION, META_KEY: claim}


def is_geometry_field(field: T.StructField) -> bool:
    """Plain binary, tagged as WKB or named like a geometry column."""
    if not isinstance(field.dataType, T.BinaryType):
        return False
    tagged = (field.metadata or {}).get(NAME_KEY) == WKB_EXTENSION
    return tagged or field.name.upper() in GEOMETRY_COLUMN_NAMES


def srid_of(crs: Column) -> Column:
    """Number of the reference system in an extension-metadata text, else the default.

    Accepted are ``{"crs":"EPSG:n"}`` and ``{"crs":{"id":{"authority":"EPSG","code":n}}}``
    with EPSG in any case.
    """
    claim = F.get_json_object(crs, "$.crs")
    short = F.regexp_extract(claim, r"(?i)^EPSG:([+-]?[0-9]+)$", 1).try_cast("bigint")
    authority = F.get_json_object(crs, "$.crs.id.authority")
    code = F.get_json_object(crs, "$.crs.id.code")
    whole = F.when(code.rlike(r"^-?[0-9]+$"), code.try_cast("bigint"))
    nested = F.when(F.upper(authority) == "EPSG", whole)
    return F.coalesce(F.nullif(short, F.lit(0)), F.nullif(nested, F.lit(0)), F.lit(DEFAULT_SRID))


def field_srid(field: T.StructField) -> int:
    """The same rule for one schema field, on the driver."""
    try:
        claim = json.loads((field.metadata or {}).get(META_KEY) or "{}").get("crs")
        if isinstance(claim, str):
            head, _, number = claim.partition(":")
            found = int(number) if head.upper() == "EPSG" else 0
        elif claim:
            ident = claim["id"]
            found = ident["code"] if ident["authority"].upper() == "EPSG" else 0
        else:
            found = 0
    except (ValueError, KeyError, AttributeError, TypeError):
        found = 0
    return found if isinstance(found, int) and found else DEFAULT_SRID
