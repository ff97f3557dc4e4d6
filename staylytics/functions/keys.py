"""Deterministic keys and lookups as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylytics import constants as C

NULL_TOKEN = "None"  # one fixed rendering of NULL inside hashed text


def joined(columns: Iterable[Column | str]) -> Column:
    """Pipe-joined text of the columns with NULL rendered as a fixed token."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.concat_ws("|", *parts)


def hash63(text: Column) -> Column:
    """First 8 bytes of SHA-256, big-endian, masked to 63 bits so it fits a signed BIGINT."""
    digest = F.sha2(text, 256)
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").bitwiseAND(F.lit(2**31 - 1))
    low = F.conv(F.substring(digest, 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def guest_key() -> Column:
    """Profile-cluster key (it groups similar bookings; it does not identify a person)."""
    return hash63(joined(C.GUEST_FIELDS))


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def lookup(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def hotel_key(name: Column) -> Column:
    """Closed lookup: an unknown hotel fails the job."""
    return F.coalesce(
        F.element_at(lookup(C.HOTEL_KEYS), name),
        F.raise_error(F.concat(F.lit("unknown hotel: "), F.coalesce(name, F.lit("NULL")))).cast("int"),
    )


def room_tier(code: Column) -> Column:
    """Letter to tier id; unknown letters share tier 0."""
    return F.coalesce(F.element_at(lookup(C.ROOM_TIERS), F.upper(F.trim(code))), F.lit(C.UNMAPPED_TIER))


def nights() -> Column:
    zero = F.lit(0)
    return (
        F.coalesce(F.col("stays_in_weekend_nights"), zero) + F.coalesce(F.col("stays_in_week_nights"), zero)
    ).cast("int")
