"""Readers, schemas and generated dimension tables."""

from claimspan.sources.readers import (
    dim_date,
    enrich_registry,
    read_claims_csv,
    read_inbound_claims,
    read_json,
    read_json_lines,
    table,
)

__all__ = [
    "dim_date",
    "enrich_registry",
    "read_claims_csv",
    "read_inbound_claims",
    "read_json",
    "read_json_lines",
    "table",
]
