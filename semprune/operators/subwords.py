"""A subword tokenizer plug-in: greedy longest match over a vocabulary, as BERT-like models use it.

Spark cuts texts at white space; a task sees the distinct strings of a batch, and remembers those it has met. Each is cleaned, stripped of
accents, lower-cased and cut at punctuation, and every word is taken apart from the left into the longest pieces that the vocabulary
has, the first of a word as it is and later ones with a prefix. A word that cannot be taken apart is unknown as a whole.

The vocabulary is read through Spark, so it may lie in any store, and goes to the tasks; it is bounded by ``VOCABULARY_BYTES``.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from semprune.operators.chunk import Tokenizer, runs_within

VOCABULARY_BYTES = 64 << 20
#: Strings between white space whose pieces a task remembers before it starts anew.
KNOWN_STRINGS = 1 << 18
#: Strings of the rows that are taken apart at once, a longer row by itself.
STRING_BATCH = 1 << 18
#: Longer words are unknown.
LONGEST_WORD = 100
CONTINUED = "##"
UNKNOWN = "[UNK]"
START, END = "[CLS]", "[SEP]"
WORD_START = "▁"
#: Blocks of ideographs, each a word of its own. Fixed values.
IDEOGRAPHS = (
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2A6DF),
    (0x2A700, 0x2B73F), (0x2B740, 0x2B81F), (0x2B920, 0x2CEAF), (0x2F800, 0x2FA1F),
)
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


# --- vocabulary ------------------------------------------------------------------------------


def read_vocabulary(spark: SparkSession, path: str) -> list[str]:
    """Pieces of a vocabulary file: one a line; or ``model.vocab`` of a JSON file; or a SentencePiece model.

    Pieces of a SentencePiece model that begin a word carry a mark there; here those that do not are prefixed.
    """
    content = spark.read.format("binaryFile").load(path).select("length", "content").first()
    if content.length > VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {VOCABULARY_BYTES} bytes")
    data = bytes(content.content)
    if path.endswith(".json"):
        return list(json.loads(data)["model"]["vocab"])
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        whole = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        pieces = [model.id_to_piece(i) for i in whole]
        return [p[1:] if p.startswith(WORD_START) else CONTINUED + p for p in pieces if p != WORD_START]
    return data.decode().splitlines()


# --- words of a string -----------------------------------------------------------------------


def _is_ideograph(c: str) -> bool:
    return c > "㏿" and any(low <= ord(c) <= high for low, high in IDEOGRAPHS)


def _is_punctuation(c: str) -> bool:
    return c in _PUNCTUATION if c < "\x80" else unicodedata.category(c)[0] == "P"


def words_of(text: str, lower: bool = True) -> list[str]:
    """Words and single punctuation characters of a string without white space, but for rare kinds of it."""
    if text.isascii() and text.isalnum():
        return [text.lower() if lower else text]
    seen = []
    for c in text:
        if c.isspace() and c not in "\x0b\x0c\x1c\x1d\x1e\x1f\x85":
            seen.append(" ")
        elif unicodedata.category(c)[0] != "C" and c != "�":
            seen.append(f" {c} " if _is_ideograph(c) else c)
    text = "".join(seen)
    if lower:
        text = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
        text = "".join(c.lower() for c in text)
    return "".join(f" {c} " if _is_punctuation(c) else c for c in text).split()


class Pieces:
    """The vocabulary as a trie: a node maps a character to the next node, and ``None`` to its piece."""

    def __init__(self, vocabulary: list[str], prefix: str = CONTINUED, unknown: str = UNKNOWN, longest: int = LONGEST_WORD):
        self.first: dict = {}
        self.later: dict = {}
        self.unknown, self.longest = unknown, longest
        for piece in vocabulary:
            continued = piece.startswith(prefix) and len(piece) > len(prefix)
            self._add(self.later if continued else self.first, piece[len(prefix) :] if continued else piece, piece)

    @staticmethod
    def _add(node: dict, text: str, piece: str) -> None:
        for c in text:
            node = node.setdefault(c, {})
        node[None] = piece

    def of(self, word: str) -> list[str]:
        if len(word) > self.longest:
            return [self.unknown]
        out, at, root = [], 0, self.first
        while at < len(word):
            node, i, end, piece = root, at, 0, None
            while i < len(word) and word[i] in node:
                node = node[word[i]]
                i += 1
                if None in node:
                    end, piece = i, node[None]
            if piece is None:
                return [self.unknown]
            out.append(piece)
            at, root = end, self.later
        return out


# --- plug-in ---------------------------------------------------------------------------------


def _piece_lists(strings: pa.ListArray, known: dict[str, list[str]], find: Callable[[str], list[str]]) -> pa.ListArray:
    """The pieces of all strings of each row; every distinct string is looked up once."""
    if len(known) > KNOWN_STRINGS:
        known.clear()
    offsets = strings.offsets.to_numpy()
    coded = strings.flatten().dictionary_encode()
    lists = []
    for s in coded.dictionary.to_pylist():
        if s not in known:
            known[s] = find(s)
        lists.append(known[s])
    sizes = np.array([len(x) for x in lists], np.int64)
    begins = np.cumsum(sizes) - sizes
    index = coded.indices.to_numpy().astype(np.int64)
    n = sizes[index] if len(index) else np.zeros(0, np.int64)
    after = np.concatenate([[0], np.cumsum(n)])
    place = np.repeat(begins[index] - after[:-1], n) + np.arange(after[-1]) if len(index) else np.zeros(0, np.int64)
    pieces = pa.array([p for x in lists for p in x], pa.string()).take(pa.array(place))
    return pa.ListArray.from_arrays(pa.array(after[offsets - offsets[0]].astype(np.int32)), pieces)


@dataclass(frozen=True)
class WordPieces(Tokenizer):
    """``Tokenizer`` for a broadcast vocabulary."""

    vocabulary: Broadcast | None = None
    lower: bool = True
    prefix: str = CONTINUED
    unknown: str = UNKNOWN

    def _finder(self) -> Callable[[str], list[str]]:
        pieces, lower = Pieces(self.vocabulary.value, self.prefix, self.unknown), self.lower
        return lambda s: [p for w in words_of(s, lower) for p in pieces.of(w)]

    def tokens(self, text: Column) -> Column:
        finder = self._finder

        @F.arrow_udf("array<string>")
        def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            find, known = finder(), {}
            for strings in batches:
                for run in runs_within(np.diff(strings.offsets.to_numpy()), STRING_BATCH):
                    yield _piece_lists(strings[run], known, find)

        return pieces(F.filter(F.split(text, "[ \t\n\r]+"), lambda s: s != ""))

    def instruction(self, text: str) -> list[str]:
        find = self._finder()
        return [p for s in text.split() for p in find(s)]


def word_pieces(spark: SparkSession, path: str, lower: bool = True, start: tuple[str, ...] = (START,), end: tuple[str, ...] = (END,)) -> WordPieces:
    """The tokenizer of a vocabulary file, with the special tokens around each chunk."""
    return WordPieces(start=start, end=end, vocabulary=spark.sparkContext.broadcast(read_vocabulary(spark, path)), lower=lower)
