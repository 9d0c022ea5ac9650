"""Rows that every operator on documents must take: nulls, empty and long texts, ties, copies, clashing columns."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, shard string, slot int, quality string, kept int, "
    "removed_lines string, n_replaced int, ids int, component string, `a.b` string"
)
LONG = " ".join(f"word{i % 977} and" for i in range(30_000))
TEXTS = [
    None,
    "",
    " \n\t\n ",
    "one",
    "Two  words",
    "Line one has quite a few words in it, all different.\nshort\nLine one has quite a few words in it, all different.",
    "é ü ß 汉字 \u00a0 emoji 😀 \u2028 end",
    "<|endoftext|> ### <|turn|> \\ <\\| </turn>",
    LONG,
    "a b c d e f g h i j " * 30,
]


def documents(spark, texts=TEXTS, extra=()):
    """Each text three times: two ids and a repeated row; and a row without an id."""
    rows = []
    for i, t in enumerate([*texts, *extra]):
        rows += [(2 * i, t), (2 * i + 1, t), (2 * i + 1, t)]
    rows += [(None, None), (None, "Two  words")]
    filler = ("en", "s", 1, "x", 2, "q", 3, "r", 4, 5, "c", "dotted")
    return spark.createDataFrame([r + filler for r in rows], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
