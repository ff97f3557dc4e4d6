"""Text chunking: documents stay rows, chunks are array elements, nothing is shuffled."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from staylytics import constants as C
from staylytics.operators.cleaning import strip


def squeeze(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"[ \t]+", " "))


def fixed_width(text: Column, size: int = C.CHUNK_SIZE) -> Column:
    """Consecutive windows of ``size`` characters covering the whole text, in one pass over it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


SEPARATORS = ("\n\n", "\n", ". ", " ")


def separator_spans(text: str, size: int) -> list[tuple[int, int]]:
    """Places of the pieces of ``text``: each ends at the last separator that keeps it within ``size``.

    The places of a separator are looked up once per text and cuts found by binary search. Spans still too long go on
    to the next separator, at last to windows. A separator at a cut, or at the start of a span, belongs to no piece.
    """
    spans = [(0, len(text))] if text else []
    for separator in SEPARATORS:
        long = [(a, b) for a, b in spans if b - a > size]
        if not long:
            break
        width, places = len(separator), np.array([m.start() for m in re.finditer(re.escape(separator), text)], dtype=np.int64)
        cut = []
        for a, b in spans:
            inside = places[np.searchsorted(places, a) : np.searchsorted(places, b - width, "right")] if b - a > size else places[:0]
            ends = np.append(inside, b)
            while a < b:
                at = np.searchsorted(ends, a)
                if len(inside) and at < len(inside) and ends[at] == a:
                    a += width
                    continue
                end = int(ends[max(at, np.searchsorted(ends, a + size, "right") - 1)])
                cut.append((a, end))
                a = end + width
        spans = cut
    return [(i, min(i + size, b)) for a, b in spans for i in range(a, b, size)]


def _separator_chunker(size: int):
    """Row by row and not as an Arrow function: of those a Python worker holds 10,000 whole texts and their pieces at once."""

    @F.udf("array<string>", useArrow=False)
    def chunker(text: str | None) -> list[str] | None:
        return None if text is None else [text[a:b] for a, b in separator_spans(text, size)]

    return chunker


def by_separators(df: DataFrame, text: str, out: str = "chunks", size: int = C.CHUNK_SIZE) -> DataFrame:
    """Split at ever finer separators until every piece fits, filling each as far as it goes; then hard windows."""
    return df.withColumn(out, F.coalesce(_separator_chunker(size)(text), F.array().cast("array<string>")))


class SeparatorChunks:
    """Table function over (text, size): the pieces of ``separator_spans`` one by one, with their places in the text."""

    @staticmethod
    def analyze(text: AnalyzeArgument, size: AnalyzeArgument) -> AnalyzeResult:
        if not isinstance(text.dataType, (T.StringType, T.NullType)):
            raise ValueError(f"separator_chunks takes a text, not {text.dataType.simpleString()}")
        if not isinstance(size.dataType, T.IntegralType) or size.isConstantExpression and (size.value is None or size.value < 1):
            raise ValueError("separator_chunks takes a positive whole size")
        return AnalyzeResult(T.StructType().add("chunk_index", T.IntegerType()).add("begin", T.IntegerType()).add("end", T.IntegerType()).add("chunk", T.StringType()))

    def eval(self, text: str | None, size: int):
        for index, (begin, end) in enumerate(separator_spans(text or "", size)):
            yield index, begin, end, text[begin:end]


def separator_chunks():
    """``SeparatorChunks`` as a function for ``DataFrame.lateralJoin`` or, registered, for SQL."""
    return F.udtf(SeparatorChunks)


def lateral_chunks(df: DataFrame, text: str, size: int = C.CHUNK_SIZE) -> DataFrame:
    """Every row of ``df`` once per piece of ``text``, with chunk_index, begin, end and chunk; rows without pieces go."""
    return df.lateralJoin(separator_chunks()(F.col(text).outer(), F.lit(size)))


def with_overlap(chunks: Column, overlap: int = C.CHUNK_OVERLAP) -> Column:
    """Prefix every chunk after the first with the tail of the one before it.

    The neighbour comes in through ``zip_with``: a lambda must not refer to the chunk column itself, since the
    optimizer may inline that column's expression and so evaluate it once per element.
    """
    first = F.array(F.lit(None).cast("string"))
    previous = F.slice(F.concat(first, chunks), F.lit(1), F.size(chunks))
    joined = lambda c, p: F.when(p.isNull(), c).otherwise(strip(F.concat(F.right(p, F.lit(overlap)), F.lit(" "), c)))
    return F.zip_with(chunks, previous, joined)


def chunk_text(df: DataFrame, text: str, size: int = C.CHUNK_SIZE, overlap: int = C.CHUNK_OVERLAP) -> DataFrame:
    """Add ``chunks``: squeezed, separator-split and overlapped pieces of ``text``."""
    out = by_separators(df.withColumn("_t", squeeze(F.col(text))), "_t", size=size).drop("_t")
    return out if overlap <= 0 else out.withColumn("chunks", with_overlap(F.col("chunks"), overlap))


def chunk_rows(df: DataFrame, key: str, chunks: str = "chunks", metadata: str = "metadata") -> DataFrame:
    """One row per chunk, the document's metadata extended by the chunk's position."""
    rows = df.select(key, metadata, F.posexplode_outer(chunks).alias("chunk_index", "text")).where("text is not null")
    position = F.create_map(F.lit("chunk_index"), F.col("chunk_index").cast("string"))
    return rows.withColumn(metadata, F.map_concat(metadata, position))


def heading_sections(df: DataFrame, text: str, heading: str, title: str) -> DataFrame:
    """Split at headings. ``heading`` matches a heading's start, ``title`` captures its text in group 1.

    Text before the first heading is dropped; a text without headings stays whole, with a NULL heading.
    """
    pieces = F.split(F.col(text), f"(?={heading})")
    starts = F.filter(pieces, lambda p: p.rlike(f"^(?:{heading})"))
    sections = F.when(F.size(starts) > 0, starts).otherwise(F.array(text))
    out = df.select("*", F.posexplode_outer(sections).alias("section", "section_text"))
    found = F.regexp_extract("section_text", title, 1)
    return out.withColumns({
        "heading": F.when(F.col("section_text").rlike(f"^(?:{heading})"), strip(found)),
        "section_text": strip(F.col("section_text")),
    }).where("section_text <> ''")


def markdown_sections(df: DataFrame, text: str) -> DataFrame:
    return heading_sections(df, text, r"(?m)^#{1,3}\s+\S", r"^#{1,3}\s+(.*)")


def html_sections(df: DataFrame, text: str) -> DataFrame:
    return heading_sections(df, text, r"<h[1-3][ >]", r"^<h[1-3][^>]*>(.*?)</h[1-3]>")
