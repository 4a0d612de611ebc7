"""Named queries; importing the package registers all of them."""

from tempora.plans import assembly_queries, calibration_queries, clock_queries, fusion_queries, row_queries, scan_queries, search_queries, sensor_queries, stream_queries, time_queries  # noqa: F401
from tempora.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
