"""Sources and sinks: CSV landing/loading, the source registry, constants,
and the derivation of the talent tables from the driver's test tables."""

from traitmatch.sources.dims import DIMENSIONS, dimension_frames
from traitmatch.sources.files import (
    constants,
    discover_tables,
    landed_tables,
    load_all,
    land_raw,
    load_audit,
    load_table,
    materialize,
    read_csv,
    register_sources,
)
from traitmatch.sources.fixtures import TalentTables, benchmark_ids, load_talent_tables

__all__ = [
    "DIMENSIONS", "dimension_frames", "constants", "discover_tables", "land_raw",
    "load_audit", "load_table", "materialize", "read_csv", "register_sources",
    "TalentTables", "benchmark_ids", "load_talent_tables",
]
