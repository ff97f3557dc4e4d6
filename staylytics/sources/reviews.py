"""Guest reviews derived from the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.sources.lake import Lake

PHRASES = [p for _, good, _ in C.PHRASE_BANK for p in good] + [p for _, _, bad in C.PHRASE_BANK for p in bad]


def reviews(lake: Lake) -> DataFrame:
    """Two bank phrases followed by the whole document text; hotel from source, language from lang."""
    bank = F.array(*[F.lit(p) for p in PHRASES])
    doc = F.col("doc_id")

    def phrase(position):
        return F.element_at(bank, (position % len(PHRASES) + 1).cast("int"))

    return lake.table("documents").select(
        doc, F.concat_ws(" ", phrase(doc), phrase(doc * 7 + 3), F.col("text")).alias("review"),
        (doc * 7 % 5 + 1).alias("rating"), F.date_add(F.lit("2024-01-01").cast("date"), (doc % 365).cast("int")).alias("date"),
        F.col("source").alias("hotel_id"), F.col("lang").alias("language"),
    )
