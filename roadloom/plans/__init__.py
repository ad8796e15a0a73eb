"""All queries over the driver's tables, by name."""

from . import anchor_queries, arc_queries, assembly_queries, audit_queries, cell_queries, evidence_queries, more_queries, network_queries, report_queries, search_queries, source_queries, stitching_queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "anchor_queries", "arc_queries", "assembly_queries", "audit_queries", "cell_queries", "evidence_queries", "more_queries", "network_queries", "report_queries", "search_queries", "source_queries", "stitching_queries"]
