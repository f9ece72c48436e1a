"""Table extracts on Spark: select, normalise, write, describe and reconcile tables."""

from tablex.functions.celltext import csv_text
from tablex.functions.declared import actual_kinds, declared, expected_kinds, with_numeric_type
from tablex.functions.equality import same
from tablex.functions.names import quoted, unique_columns, unique_names
from tablex.functions.normalize import normalize
from tablex.functions.temporal import encode_temporal
from tablex.operators.estimate import estimated_rows
from tablex.operators.extract import extract, limit, ordered, project, where
from tablex.operators.position import diff_rows, numbered
from tablex.operators.profile import (
    catalog_dictionary,
    dictionary,
    extract_count,
    info_json,
    preview,
    profile,
    sample,
    search_columns,
)
from tablex.operators.reconcile import (
    diff_cells,
    diff_counts,
    diff_report,
    diff_schema,
    fingerprint,
    reconcile,
    verdict,
)
from tablex.plans.export import dry_run, export
from tablex.operators.search import search_index, write_search_index
from tablex.session import configure
from tablex.sinks.copytext import write_copy
from tablex.sinks.files import write, write_csv, write_parquet
from tablex.sinks.layout import clustered
from tablex.sinks.ranges import diff_exports, read_ranges, write_ranges
from tablex.sinks.versions import read_version, vacuum, versions, write_version
from tablex.sources.copytext import read_copy, read_copy_stream, read_types
from tablex.sources.jdbc import query_jdbc, scan_jdbc
from tablex.sources.tables import query, read_export, register, scan
from tablex.streaming.export import export_stream

__all__ = [
    "actual_kinds",
    "catalog_dictionary",
    "clustered",
    "configure",
    "csv_text",
    "declared",
    "dictionary",
    "diff_cells",
    "diff_counts",
    "diff_exports",
    "diff_report",
    "diff_rows",
    "diff_schema",
    "dry_run",
    "encode_temporal",
    "estimated_rows",
    "expected_kinds",
    "export",
    "export_stream",
    "extract",
    "extract_count",
    "fingerprint",
    "info_json",
    "limit",
    "normalize",
    "numbered",
    "ordered",
    "preview",
    "profile",
    "project",
    "query",
    "query_jdbc",
    "quoted",
    "read_copy",
    "read_copy_stream",
    "read_export",
    "read_ranges",
    "read_types",
    "read_version",
    "reconcile",
    "register",
    "same",
    "sample",
    "scan",
    "scan_jdbc",
    "search_columns",
    "search_index",
    "unique_columns",
    "unique_names",
    "vacuum",
    "verdict",
    "versions",
    "where",
    "with_numeric_type",
    "write",
    "write_copy",
    "write_csv",
    "write_parquet",
    "write_ranges",
    "write_search_index",
    "write_version",
]
