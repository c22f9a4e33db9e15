"""Declared schemas of the delivered files and ledgers. Nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T



def all_text(*columns: str) -> T.StructType:
    """Every column as text, to be cast one by one after cleaning."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


AGENTS = ("agent_id", "agent_name", "town", "division", "registered_on", "agent_type", "float_limit_xaf", "status")
SERVICES = ("service_code", "service_name", "category", "base_fee_pct")
TRANSACTIONS = ("txn_id", "agent_id", "service_code", "txn_ts", "amount_xaf", "fee_xaf", "status", "customer_msisdn")
CONTAINERS = (
    "container_id", "vessel_id", "importer_id", "broker_id", "hs_chapter", "goods_description", "container_type",
    "origin_port", "gross_weight_kg", "declared_value_xaf", "inspection_selected", "arrived_on", "days_to_clear", "delayed",
)
BROKERS = ("broker_id", "licence_year", "staff")
IMPORTERS = ("importer_id", "registered_year")
VESSELS = ("vessel_id", "arrived_on", "teu_discharged")


def raw(columns: tuple[str, ...]) -> str:
    """DDL of a raw delivery: all columns text."""
    return ", ".join(f"{c} string" for c in columns)


PROMISES = (
    "promise_id string, account_id bigint, loan_id bigint, officer_name string, amount_fcfa double, promise_date date, "
    "phone string, channel string, notes string, status string, created_at timestamp_ntz, resolved_at timestamp_ntz, "
    "resolution_note string"
)
SCHEDULE_STEP = "struct<step:int, day_offset:int, scheduled_at:timestamp_ntz, status:string, sent_at:timestamp_ntz>"
SEQUENCES = (
    "seq_id string, account_id bigint, loan_id bigint, phone string, overdue_fcfa double, client_name string, "
    f"officer_name string, status string, created_at timestamp_ntz, schedule array<{SCHEDULE_STEP}>, "
    "messages_sent array<struct<step:int, sent:boolean>>"
)
CONTACT_OUTCOMES = (
    "account_id bigint, loan_id bigint, officer_name string, contact_outcome string, promise_date date, "
    "promise_amount double, recommended_channel string, is_vulnerable boolean, notes string, created_at timestamp_ntz"
)
PAYMENT_LOG = (
    "reference_id string, account_id bigint, loan_id bigint, amount_fcfa double, phone string, status string, "
    "provider string, created_at timestamp_ntz"
)
INSTALMENTS = (
    "SK_ID_CURR bigint, SK_ID_PREV bigint, NUM_INSTALMENT_NUMBER int, DAYS_INSTALMENT int, DAYS_ENTRY_PAYMENT int, "
    "AMT_INSTALMENT decimal(18,2), AMT_PAYMENT decimal(18,2)"
)
