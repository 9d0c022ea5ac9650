"""Reply trees as training conversations.

Messages name their parent. The paths from a root to its leaves come from iterative self-joins
(pointer doubling, so a path of n messages takes log2(n) rounds), branches are ranked by the score
of their path, and each chosen path becomes one formatted conversation with a loss mask.
All steps are DataFrame operations.

Template: ``<|turn|>role<|text|>text<|end|>`` for each turn. Inside roles and texts ``\\`` becomes
``\\\\`` and ``<|`` becomes ``<\\|``, so no content can look like a control string and
:func:`read_back` restores it exactly.

Defined cases: a missing text, role or score is empty, empty and zero; a parent that is no message
makes its child a root; of repeated node ids the smallest (parent, score, role, text) is taken;
messages without an id or on a circle of parents have no path from a root and are left out; equal
scores are ranked by leaf id. No limit is set on lengths. Columns besides the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semprune.session import materialize

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    opened = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def _jump_tables(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of (node, up) for 1, 2, 4, ... steps up, and (node, root, score, depth) of every path.

    A round joins the table with itself: the ancestor at twice the distance is the ancestor's ancestor.
    """
    known = nodes.select(F.col("node").alias("up"))
    linked = nodes.join(known, nodes.parent == known.up, "left")
    table = linked.select("node", "up", F.col("node").alias("far"), F.col("score").alias("gain"), F.lit(1).alias("steps"))
    table = materialize(table, "replies-up")
    jumps, rows = [], table.count()
    while table.where("up IS NOT NULL").limit(1).count() and 1 << len(jumps) <= rows:
        jumps.append(table.where("up IS NOT NULL").select("node", "up"))
        above = table.select(
            F.col("node").alias("up"),
            F.col("up").alias("next"),
            F.col("far").alias("top"),
            F.col("gain").alias("more"),
            F.col("steps").alias("further"),
        )
        doubled = table.where("up IS NOT NULL").join(above, "up").select(
            "node",
            F.col("next").alias("up"),
            F.col("top").alias("far"),
            (F.col("gain") + F.col("more")).alias("gain"),
            (F.col("steps") + F.col("further")).alias("steps"),
        )
        table = materialize(table.where("up IS NULL").unionByName(doubled), "replies-up")
    paths = table.where("up IS NULL").select("node", F.col("far").alias("root"), F.col("gain").alias("score"), F.col("steps").alias("depth"))
    return jumps, paths


def root_to_leaf_paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """(root, leaf, score, depth, node, step) of the ``branches`` best paths of each tree, all if None.

    ``step`` counts up from the leaf, which is 0. ``nodes`` has node, parent and score, and is read often:
    pass a written table.
    """
    jumps, paths = _jump_tables(nodes)
    leaves = paths.join(nodes.select(F.col("parent").alias("node")).where("node IS NOT NULL").distinct(), "node", "left_anti")
    chosen = leaves.select("root", F.col("node").alias("leaf"), "score", "depth")
    if branches is not None:
        best = Window.partitionBy("root").orderBy(F.col("score").desc(), F.col("leaf"))
        chosen = chosen.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= branches).drop("_rank")
    chosen = materialize(chosen, "replies-chosen")
    reached = chosen.select("leaf", F.col("leaf").alias("node"), F.lit(0).alias("step"))
    for k, jump in enumerate(jumps):
        # rows at 0 to 2^k - 1 steps, each moved up by 2^k
        moved = reached.join(jump, "node").select("leaf", F.col("up").alias("node"), (F.col("step") + (1 << k)).alias("step"))
        reached = reached.unionByName(materialize(moved, "replies-path"))
    return reached.join(chosen, "leaf")


def format_reply_trees(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """(root, leaf, score, n_turns, formatted, loss) of the best paths.

    ``messages`` has node, parent, role, text and optionally score. ``loss`` lists (start, length) in code
    points of ``formatted``: the escaped text of every assistant turn, without markers.
    """
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0)) if "score" in messages.columns else F.lit(0.0)
    content = F.struct("parent", score.alias("score"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    single = messages.where("node IS NOT NULL").groupBy("node").agg(F.min(content).alias("m"))
    nodes = materialize(single.select("node", "m.parent", "m.score", "m.role", "m.text"), "replies")
    paths = root_to_leaf_paths(nodes.select("node", "parent", "score"), branches)
    turns = paths.join(nodes.select("node", "role", "text"), "node")
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    body = escape(F.col("text"))
    turns = turns.select(
        "root", "leaf", "score",
        (F.col("depth") - F.col("step")).alias("turn"),
        (F.col("role") == LEARNED_ROLE).alias("learned"),
        F.length(head).alias("head"),
        F.length(body).alias("body"),
        F.concat(head, body, F.lit(END)).alias("piece"),
    )
    earlier = Window.partitionBy("leaf").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum(F.length("piece").cast("long")).over(earlier), F.lit(0)))
    span = F.when(F.col("learned"), F.struct((F.col("start") + F.col("head")).alias("start"), F.col("body").cast("long").alias("length")))
    whole = turns.groupBy("leaf").agg(
        F.min("root").alias("root"),
        F.min("score").alias("score"),
        F.count("*").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("turn", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(span)).alias("loss"),
    )
    return whole.select("root", "leaf", "score", "n_turns", F.array_join("pieces.piece", "").alias("formatted"), "loss")


def read_back(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of (role, text), unescaped."""
    parts = F.split(formatted, r"<\|turn\|>")

    def turn(part: Column) -> Column:
        text = F.substring_index(F.substring_index(part, TEXT, -1), END, 1)
        return F.struct(unescape(F.substring_index(part, TEXT, 1)).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def loss_texts(formatted: Column, loss: Column) -> Column:
    """What the loss mask covers, unescaped, a text for each span."""
    return F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
