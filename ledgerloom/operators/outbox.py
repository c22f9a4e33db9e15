"""Campaign outbox: each message of a campaign is claimed, sent and logged once, however often the campaign runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import path_exists
from ..sources.sinks import insert_if_absent

OUTBOX = ("message_id", "campaign", "channel", "account_id", "loan_id", "is_vulnerable", "overdue", "sent_at")


def message_id(campaign: str, key: Sequence[str]) -> Column:
    """One message for each campaign and key; the channel is no part of it, so a changed channel does not send again."""
    return F.sha2(F.concat_ws("|", F.lit(campaign), *[F.col(k).cast("string") for k in key]), 256)


def dispatch(spark: SparkSession, path: str, messages: DataFrame, campaign: str, sent_at: str, key: Sequence[str] = ("account_id", "loan_id")) -> tuple[int, int]:
    """Claim the deliverable messages that no earlier run has claimed, then log what is claimed and not logged; how many of each.

    ``messages`` has the key, ``channel``, ``is_vulnerable``, ``overdue`` and
    ``deliverable``; of rows alike in the key the one of the least channel and
    amount counts. The claim commits first. A run that stops between the two is
    repaired by the next, which claims nothing again and logs what is lacking. A
    message that cannot be delivered is not claimed, so a later run may try it.
    """
    ready = messages.filter("deliverable").select(
        message_id(campaign, key).alias("message_id"), F.lit(campaign).alias("campaign"), "channel", "account_id", "loan_id", "is_vulnerable", "overdue",
        F.lit(sent_at).cast("timestamp_ntz").alias("sent_at"))
    claimed = insert_if_absent(spark, f"{path}/outbox", ready, "message_id", ["channel", "overdue"], OUTBOX)
    logged = 0
    if path_exists(spark, f"{path}/outbox"):
        rows = audit_rows(spark.read.parquet(f"{path}/outbox"))
        logged = insert_if_absent(spark, f"{path}/audit", rows, "message_id", ["created_at"], rows.columns)
    return claimed, logged


def audit_rows(outbox: DataFrame) -> DataFrame:
    """One contact outcome per message of the outbox."""
    note = F.concat(F.lit("Dispatched via bulk campaign: '"), F.col("campaign"), F.lit("'"))
    return outbox.select(
        "message_id", "account_id", "loan_id", F.lit("Campaign Automation").alias("officer_name"), F.lit("CAMPAIGN_MESSAGE_SENT").alias("contact_outcome"),
        F.col("channel").alias("recommended_channel"), F.coalesce("is_vulnerable", F.lit(False)).alias("is_vulnerable"), note.alias("notes"), F.col("sent_at").alias("created_at"))
