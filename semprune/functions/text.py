"""Token and chunk expressions over text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from semprune.functions.vectors import bind


def whitespace_tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda token: token != "")


def token_chunks(tokens: Column, content: int, head: list[str] | None = None, tail: list[str] | None = None) -> Column:
    """ARRAY of chunks with at most ``content`` tokens each, framed by ``head`` and ``tail``.

    A text without tokens has one chunk, so that no document is lost.
    """
    if content < 1:
        raise ValueError("chunk size leaves no room for text")

    def frame(part: Column) -> Column:
        parts = [F.array(*map(F.lit, side)) if side else None for side in (head, tail)]
        pieces = [p for p in (parts[0], part, parts[1]) if p is not None]
        return F.concat(*pieces) if len(pieces) > 1 else part

    def cut(all_tokens: Column) -> Column:
        last = F.greatest(F.ceil(F.size(all_tokens) / content) - 1, F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: frame(F.slice(all_tokens, i * content + 1, content)))

    return bind(tokens, cut)


def character_chunks(text: Column, width: int) -> Column:
    """ARRAY of consecutive pieces of ``width`` characters; the empty text has one empty piece."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{width}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(pieces)


def sample_hash(key: Column, seed: int) -> Column:
    """60-bit non-negative hash of a row key that orders rows at random for one seed."""
    text = F.concat_ws(":", key.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
