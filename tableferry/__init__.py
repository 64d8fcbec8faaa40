"""Typed table transfer, column planning and geometry columns on Spark DataFrames."""

from .errors import InvalidArgument, InvalidState, LoadStopped, NotFound, TableExists, TransferError
from .functions.crs import crs_metadata, srid_of
from .functions.likes import like
from .operators.apply import apply_many, finish_change
from .operators.changes import Affine
from .operators.conform import conform, map_source_types, normalise_names, to_load_form
from .operators.geometry import (
    decode_geometry, encode_geometry, expand_rectangles, explode_rings, explode_vertices,
    geometry_columns, geometry_errors, geometry_facts, geometry_report, linearise,
    orient_rings, tag_crs, vertex_count,
)
from .operators.groups import ingest_groups
from .operators.ingest import IngestResult, ingest
from .operators.inventory import (
    catalog_inventory, inventory_of, list_catalogs, list_columns, list_schemas, list_tables, object_tree,
    table_schema, table_types,
)
from .operators.profiles import StoredProfile, plan_stored, profile_stored
from .operators.query import ManyResult, run_many, run_query, run_update
from .operators.sizing import (
    batch_bind_kind, plan_columns, plan_frame, profile_text, record_bytes, scan_window, violations,
)
from .plans.columns import ColumnPlan, LoadPlan, ddl_frame, render_ddl, target_types
from .plans.options import LoadOptions
from .session import apply_settings
from .sources.jdbc import load_jdbc, write_jdbc
from .sources.scans import ScanReport, load_parquet, measure_scan, preview, scan_geometry
from .sources.splits import Split, plan_splits, split_number
from .streaming.ingest_stream import compact_stream, ingest_stream, loaded_rows, rejected_rows
