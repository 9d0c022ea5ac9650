"""Small helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The six ASCII white-space characters that separate words, as a character class body.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def clean_text(name: str = "text") -> Column:
    """The text, a missing one counting as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def smaller_than(df: DataFrame, limit: int, row_bytes: int) -> bool:
    """Whether a written table of narrow rows has at most ``limit`` bytes, ``row_bytes`` a row."""
    return df.count() * row_bytes <= limit


#: Largest table that is copied to every executor.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, marked for a broadcast join only if its rows fit into ``limit`` bytes."""
    return F.broadcast(df) if smaller_than(df, limit, row_bytes) else df
