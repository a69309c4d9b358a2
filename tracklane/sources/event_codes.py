"""The event-code dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Play-by-play message type of each event code. Codes not listed
# (clock syncs, replays, single plays) have no message type of their own.
MESSAGE_TYPES = {
    1: 3,
    2: 3,
    3: 1,
    4: 2,
    5: 4,
    6: 4,
    7: 5,
    8: 6,
    9: 7,
    10: 8,
    11: 9,
    12: 10,
    13: 11,
    14: 12,
    15: 13,
}


def event_codes(events: DataFrame) -> DataFrame:
    """One lower-case row per detail; an event without details gives one row with
    NULL subcode. ``events`` has (id, text, detail array of (id, text))."""
    return events.select("id", "text", F.explode_outer("detail").alias("d")).select(
        F.col("id").cast("int").alias("event_code"),
        F.lower("text").alias("event_action"),
        F.col("d.id").cast("int").alias("event_subcode"),
        F.lower("d.text").alias("event_subaction"),
    )


def event_code_names(events: DataFrame) -> DataFrame:
    """Event id → text, as written in the file."""
    return events.select(F.col("id").cast("string").alias("id"), "text")


def event_codes_legacy(events: DataFrame) -> DataFrame:
    """The older table: original case, -1 and 'None' where there is no detail."""
    return events.select("id", "text", F.explode_outer("detail").alias("d")).select(
        F.col("id").cast("int").alias("event_id"),
        F.col("text").alias("event_description"),
        F.coalesce(F.col("d.id").cast("int"), F.lit(-1)).alias("detail_id"),
        F.coalesce("d.text", F.lit("None")).alias("detail_description"),
    )


def with_message_type(codes: DataFrame) -> DataFrame:
    """Add ``eventmsgtype`` unless the dictionary already has it."""
    if "eventmsgtype" in codes.columns:
        return codes
    pairs = [F.lit(v) for pair in MESSAGE_TYPES.items() for v in pair]
    return codes.withColumn(
        "eventmsgtype", F.try_element_at(F.create_map(*pairs), F.col("event_code"))
    )
