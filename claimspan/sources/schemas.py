"""Table schemas of the claims model, as DDL text that every reader accepts."""

from __future__ import annotations

from pyspark.sql import types as T


RUN_LOG = (
    "package_name string, run_timestamp timestamp, rows_inserted bigint, rows_rejected bigint, status string"
)

# The columns of the inbound claims file, in file order.
INBOUND_COLUMNS = (
    "claim_id",
    "member_id",
    "provider_id",
    "service_date",
    "admit_date",
    "discharge_date",
    "diagnosis_code",
    "procedure_code",
    "billed_amount",
    "allowed_amount",
    "paid_amount",
    "claim_status",
    "denial_reason",
)
INBOUND_CLAIMS = T.StructType([T.StructField(c, T.StringType()) for c in INBOUND_COLUMNS])

# The fields of a parsed enrollment record.
ENROLLMENT_FIELDS = (
    "member_id",
    "first_name",
    "last_name",
    "line_of_business",
    "plan_code",
    "phone",
    "coverage_effective_date",
    "term_date",
)

REGISTRY_PAYLOAD = (
    "results array<struct<basic: struct<credential: string, status: string>,"
    " taxonomies: array<struct<`desc`: string>>,"
    " addresses: array<struct<address_purpose: string, city: string, state: string>>>>"
)
