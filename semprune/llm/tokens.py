"""Byte-level BPE ids of texts, fast enough for whole corpora.

Words recur, so the ids of ``" word"`` are kept in a table of bounded size for each Python worker. A
text may be cut before any single space between two non-space characters: no token of this
vocabulary spans such a place, so the ids of the pieces are the ids of the text (tests hold this
against the tokenizer on whole texts). Other places are never cut.
"""

from __future__ import annotations

import base64
import functools
import re
import struct

#: Words whose ids a worker keeps; words beyond are encoded each time.
KEPT_WORDS = 300_000
SPECIAL = "<|endoftext|>"
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Unsafe(Exception):
    """The text has spaces at which it may not be cut."""


class _Words(dict):
    """Word -> ids of a space and the word."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace() or SPECIAL in word:
            raise _Unsafe
        ids = self.encode(" " + word)
        if len(self) < KEPT_WORDS:
            self[word] = ids
        return ids


class Encoder:
    """``encode(text)`` -> little-endian unsigned 32-bit ids."""

    def __init__(self, json_path: str, ranks_path: str | None):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(json_path)
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            same = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._piece = lambda text: _pack(same.encode_ordinary(text))
        else:
            self._piece = self.whole
        self._words = _Words(self._piece)

    def whole(self, text: str) -> bytes:
        return _pack(self._whole.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        try:
            words = text.split(" ")
            first = words[0]
            if not first or first[-1].isspace() or SPECIAL in first:
                raise _Unsafe
            ids = map(self._words.__getitem__, words[1:])
            return self._piece(first) + b"".join(ids)
        except _Unsafe:
            return self._encode_uneven(text)

    def _encode_uneven(self, text: str) -> bytes:
        """Cut at safe places only, each piece encoded as it is."""
        out, begin, length = [], 0, len(text)
        while begin < length:
            end = length
            if length - begin > 20_000 and (cut := _SAFE.search(text, begin + 10_000)):
                end = cut.start()
            out.append(self.whole(text[begin:end]))
            begin = end
        return b"".join(out)


@functools.lru_cache(maxsize=4)
def encoder(json_path: str | None = None, ranks_path: str | None = None) -> Encoder:
    """One for each worker; without paths, those of the installed 50k byte-level vocabulary."""
    if json_path is None:
        import public_tokenizers

        json_path, ranks_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return Encoder(json_path, ranks_path)
