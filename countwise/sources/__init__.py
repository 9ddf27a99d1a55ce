"""Scans: text lines, edge lists, item streams, and the driver tables."""

from countwise.sources.readers import (
    canonical_edges,
    document_lines,
    edges_from_text,
    read_documents,
    read_edges,
    read_item_lines,
    read_lines,
    rejected_edges,
)
from countwise.sources.tables import (
    documents,
    edges_partsupp,
    items_parts,
    items_users,
    table,
)

__all__ = [
    "canonical_edges", "document_lines", "edges_from_text", "read_documents", "read_edges", "read_item_lines",
    "read_lines", "rejected_edges", "documents", "edges_partsupp", "items_parts", "items_users", "table",
]
