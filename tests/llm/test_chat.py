from pyspark.sql import functions as F

from semprune.llm import chat

SCHEMA = "node string, parent string, role string, text string, score double, root string, `a.b` int"


def tree(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def read(df):
    rows = df.select("root", "leaf", "score", "n_turns", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_texts(F.col("formatted"), F.col("loss")).alias("learned")).collect()
    return {r.leaf: r for r in rows}


NASTY = ["\\", "<|", "<\\|", "\\<|", "<|end|>", "<|turn|>user<|text|>x<|end|>", "\\\\<\\\\|", "", "\n", r"\### Assistant: </turn> ok", "<", "|>"]


def test_texts_come_back(spark):
    rows = [(f"n{i}", f"n{i - 1}" if i else None, "assistant" if i % 2 else "us<|er\\", t, None) for i, t in enumerate(NASTY * 3)]
    got = read(chat.format_reply_trees(tree(spark, rows)))
    (row,) = got.values()
    assert [(t.role, t.text) for t in row.turns] == [(r[2], r[3]) for r in rows]
    assert list(row.learned) == [r[3] for r in rows if r[2] == "assistant"]
    assert row.n_turns == len(rows)


def test_best_branch_and_all_branches(spark):
    rows = [
        ("r", None, "user", "q", 1.0), ("a", "r", "assistant", "A", 2.0), ("b", "r", "assistant", "B", 3.0),
        ("c", "a", "user", "C", 2.0), ("d", "b", "user", "D", 0.5), ("e", "b", "user", "E", 1.0),
        ("s", "gone", "user", "single", None),
    ]
    # c and e have the same score of 5; the smaller leaf id is taken
    best = read(chat.format_reply_trees(tree(spark, rows)))
    assert {k: [t.text for t in v.turns] for k, v in best.items()} == {"c": ["q", "A", "C"], "s": ["single"]}
    every = read(chat.format_reply_trees(tree(spark, rows), None))
    assert {k: (v.root, v.score, [t.text for t in v.turns]) for k, v in every.items()} == {
        "c": ("r", 5.0, ["q", "A", "C"]), "d": ("r", 4.5, ["q", "B", "D"]), "e": ("r", 5.0, ["q", "B", "E"]), "s": ("s", 0.0, ["single"]),
    }
    assert set(read(chat.format_reply_trees(tree(spark, rows), 2))) == {"c", "e", "s"}


def test_nulls_circles_and_repeats(spark):
    rows = [
        ("x", "y", "user", "circle", None), ("y", "x", "user", "circle", None), ("z", "x", "user", "below", None),
        (None, None, "user", "no id", None), ("r", None, None, None, None), ("r", None, None, None, None), ("k", "r", "assistant", None, 1.0),
        ("self", "self", "user", "me", None),
    ]
    got = read(chat.format_reply_trees(tree(spark, rows)))
    assert {k: [(t.role, t.text) for t in v.turns] for k, v in got.items()} == {"k": [("", ""), ("assistant", "")]}
    assert list(got["k"].learned) == [""]


def test_long_path_and_broad_tree(spark):
    rows = [(f"{i:04d}", f"{i - 1:04d}" if i else None, "assistant", f"t{i}" * 10, None) for i in range(300)]
    rows += [(f"leaf{i}", "0003", "user", str(i), float(i)) for i in range(500)]
    got = read(chat.format_reply_trees(tree(spark, rows)))
    assert list(got) == ["leaf499"] and got["leaf499"].n_turns == 5
    got = read(chat.format_reply_trees(tree(spark, rows), None))
    assert len(got) == 501 and [t.text for t in got["0299"].turns] == [f"t{i}" * 10 for i in range(300)]


def test_no_messages(spark):
    assert chat.format_reply_trees(tree(spark, [])).count() == 0
