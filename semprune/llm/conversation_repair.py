"""Repair of the turn structure of conversations at least cost, ties going to the ASCII-least list of edits.

A conversation must read ``(s?(ua)+)?`` in role initials. Its rows are kept (0), given the role user or
assistant (3) or deleted (4, the only edit of blank and repeated rows), and empty user or assistant turns
are inserted anywhere (3); a truncated row that is not deleted adds 3.

The edits are the shortest path through a graph with four nodes behind each row (nothing yet, system, user,
assistant). The weight of a path is one integer: its cost in the high digits, below it one digit of eight bits for each
edit, the first edit in the highest, so that unused digits at the end are zero. The smaller integer is the cheaper path or, at
equal cost, the one whose letters come first, and the minimum of integers at each node decides everything. Two
paths into one node never leave the choice open: if one list of letters began with the other, the rest would be
insertions, which cost.

No conversation is one group. Rows get their place by a range-partitioned sort, and repeated rows are found by the smallest place of equal
ones. A conversation is cut into segments of ``SEGMENT_ROWS`` rows; a task finds the best path through a segment
from each node to each node, and neighbouring segments are joined ``JOINED`` at a time. Equal segments are solved once in a
task. What a conversation has in one piece is one byte for each edit, as the result is one string. A digest of a whole repaired
conversation is a chain by definition: its rows pass through one task in order, one batch in memory.

Defined cases: a missing role or text counts as one space, so that a missing role fits nowhere and a missing text is blank;
so does an empty role. Rows of one turn are taken by role and text; a missing turn comes first. Rows without
``conv_id`` are one conversation. No rows give no conversations. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semprune.llm.common import SPACE
from semprune.operators.positions import position_by_order
from semprune.session import materialize

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
#: Costs of the edits; what a truncated row that stays adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Adjacent role initials that may follow each other.
LEGAL = ("su", "ua", "au")
SEGMENT_ROWS = 512
JOINED = 64
#: Rows a task hands on at once.
BATCH = 4096
KEY = ["conv", "missing"]


# --- least edits -----------------------------------------------------------------------------

Path = tuple[int, int]  # weight, and the lowest bit of the digit that the next letter takes


def _edge(path: Path, letter: str, cost: int, high: int) -> Path:
    weight, bit = path
    return weight + (cost << high) + (ord(letter) << bit), bit - 8


def _relax(layer: dict[int, Path], state: int, path: Path) -> None:
    if state not in layer or path < layer[state]:
        layer[state] = path


def _after(state: int) -> int:
    """The node that a new user or assistant turn leads to."""
    return ASSISTANT if state == USER else USER


def _insertions(layer: dict[int, Path], high: int) -> dict[int, Path]:
    """None, one or two inserted turns; two lead from any node to every node that a third could reach."""
    for _ in range(2):
        grown = dict(layer)
        for state, path in layer.items():
            _relax(grown, _after(state), _edge(path, "I", INSERT, high))
        layer = grown
    return layer


def _row(layer: dict[int, Path], code: str, high: int) -> dict[int, Path]:
    """Behind one row; ``code`` is s, u, a or x (any other role), a capital for a truncated row, d for one that must go."""
    out: dict[int, Path] = {}
    more, role = (TRUNCATED, code.lower()) if code.isupper() else (0, code)
    for state, path in layer.items():
        _relax(out, state, _edge(path, "D", DELETE, high))
        if role == "d":
            continue
        _relax(out, _after(state), _edge(path, "R", REROLE + more, high))
        if role == "s" and state == START:
            _relax(out, SYSTEM, _edge(path, "K", KEEP + more, high))
        elif (role == "u" and state != USER) or (role == "a" and state == USER):
            _relax(out, _after(state), _edge(path, "K", KEEP + more, high))
    return out


def _read(layer: dict[int, Path], width: int) -> dict[int, tuple[int, str]]:
    """(cost, letters) of each weight."""
    low = (1 << 8 * width) - 1
    return {s: (w >> 8 * width, (w & low).to_bytes(width, "big").rstrip(b"\0").decode()) for s, (w, _) in layer.items()}


def weight_of(cost: int, letters: str, width: int) -> int:
    return (cost << 8 * width) + int.from_bytes(letters.encode().ljust(width, b"\0"), "big")


@lru_cache(1 << 16)
def segment_paths(codes: str, start: int) -> dict[int, tuple[int, str]]:
    """Node behind the last row -> (cost, letters) of the best path there; insertions come before their row."""
    width = 3 * len(codes)
    layer: dict[int, Path] = {start: (0, 8 * width - 8)}
    for code in codes:
        layer = _row(_insertions(layer, 8 * width), code, 8 * width)
    return _read(layer, width)


def ended(paths: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The best path that ends with nothing or with an assistant turn."""
    width = max(len(letters) for _, letters in paths.values()) + 2
    layer = {s: (weight_of(cost, letters, width), 8 * (width - len(letters)) - 8) for s, (cost, letters) in paths.items()}
    last = _insertions(layer, 8 * width)
    best = min(last[s] for s in (START, ASSISTANT) if s in last)
    return _read({START: best}, width)[START]


def joined(first: dict, second: dict) -> dict:
    """Best paths through two neighbouring segments, each (from, to) -> (cost, letters)."""
    out: dict[tuple[int, int], tuple[int, str]] = {}
    width = max(len(x) for _, x in first.values()) + max(len(x) for _, x in second.values())
    for (a, m), (cost, letters) in first.items():
        for (n, b), (more, rest) in second.items():
            if m == n:
                new = (cost + more, letters + rest)
                if (a, b) not in out or weight_of(*new, width) < weight_of(*out[a, b], width):
                    out[a, b] = new
    return out


# --- rows and their faults -------------------------------------------------------------------


def placed_rows(rows: DataFrame) -> DataFrame:
    """(conv, missing, pos, turn, role, text): rows in order; ``missing`` marks the conversation without an id."""
    plain = rows.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("conv_id").isNull().alias("missing"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    return position_by_order(plain, KEY, order, "pos").select(*KEY, "pos", "turn", "role", "text")


def faults(placed: DataFrame) -> DataFrame:
    """(conv, missing, pos, turn, initial, fault) of written ``placed`` rows; the first fault of a row counts."""
    last = F.regexp_extract("text", rf"([^{SPACE}])[{SPACE}]*\z", 1)
    own = placed.select(*KEY, "pos", "turn", "role", last.alias("last"), F.sha2(F.col("text").cast("binary"), 256).alias("same"))
    own = materialize(own, "rows-judged")
    firsts = own.groupBy(*KEY, "role", "same").agg(F.min("pos").alias("pos")).select(*KEY, "pos", F.lit(True).alias("first"))
    fault = F.when(F.col("last") == "", "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated")
    return own.join(firsts, [*KEY, "pos"], "left").select(*KEY, "pos", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def segments(found: DataFrame, rows: int = SEGMENT_ROWS) -> DataFrame:
    """(conv, missing, segment, codes, illegal) of written ``found`` faults, at most ``rows`` rows each.

    The first row of a segment is also shown to the one before, for the pair that they form.
    """
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    at = F.floor(F.col("pos") / rows).cast("long")
    seen = F.when((F.col("pos") % rows == 0) & (F.col("pos") > 0), F.array(at, at - 1)).otherwise(F.array(at))
    shown = found.select(*KEY, "pos", "initial", code.alias("code"), at.alias("own"), F.explode(seen).alias("segment"))
    code = F.when(F.col("own") == F.col("segment"), F.col("code")).otherwise("")
    lists = shown.groupBy(*KEY, "segment").agg(F.sort_array(F.collect_list(F.struct("pos", "initial", code.alias("code")))).alias("rows"))
    n = F.size("rows") - 1
    pairs = F.zip_with(F.slice("rows", 1, n), F.slice("rows", 2, n), lambda x, y: F.concat(x["initial"], y["initial"]))
    illegal = F.size(F.filter(pairs, lambda x: ~x.isin(*LEGAL))).cast("long")
    return lists.select(*KEY, "segment", F.array_join(F.transform("rows", lambda x: x["code"]), "").alias("codes"), illegal.alias("illegal"))


# --- edits -----------------------------------------------------------------------------------

_PATHS = "array<struct<first int, last int, cost long, letters string>>"
_PATHS_TYPE = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())]))


def _as_list(paths: dict) -> list[dict]:
    return [{"first": a, "last": b, "cost": cost, "letters": x} for (a, b), (cost, x) in sorted(paths.items())]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of segments; the only segment of a conversation is entered at the start alone."""
    for batch in batches:
        alone = batch.column("segments").to_pylist()
        paths = [
            _as_list({(a, b): x for a in ((START,) if n == 1 else range(4)) for b, x in segment_paths(codes, a).items()})
            for codes, n in zip(batch.column("codes").to_pylist(), alone, strict=True)
        ]
        columns = [batch.column(c) for c in (*KEY, "segment", "segments")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(paths, _PATHS_TYPE)], [*KEY, "segment", "segments", "paths"])


def _join(table: pa.Table) -> pa.Table:
    """Neighbouring segments as one."""
    rows = sorted(table.to_pylist(), key=lambda r: r["segment"])
    whole = None
    for row in rows:
        paths = {(p["first"], p["last"]): (p["cost"], p["letters"]) for p in row["paths"]}
        whole = paths if whole is None else joined(whole, paths)
    first = rows[0]
    columns = [pa.array([first["conv"]]), pa.array([first["missing"]]), pa.array([first["segment"] // JOINED]), pa.array([_as_list(whole)], _PATHS_TYPE)]
    return pa.table(columns, names=[*KEY, "segment", "paths"])


def _end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best = [ended({p["last"]: (p["cost"], p["letters"]) for p in paths if p["first"] == START}) for paths in batch.column("paths").to_pylist()]
        columns = [batch.column(c) for c in KEY]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([c for c, _ in best], pa.int64()), pa.array([x for _, x in best], pa.string())], [*KEY, "cost", "audit"])


def least_edits(cut: DataFrame) -> DataFrame:
    """(conv, missing, cost, audit) for each conversation of written ``segments``; only those of several segments are joined."""
    schema = f"conv long, missing boolean, segment long, paths {_PATHS}"
    counts = cut.groupBy(*KEY).agg(F.count("*").alias("segments"))
    known = cut.select(*KEY, "segment", "codes").join(counts, KEY)
    solved = materialize(known.mapInArrow(_solve, schema.replace("segment long", "segment long, segments long")), "segment-paths")
    whole = solved.where("segments = 1").select(*KEY, "paths")
    parts, last = solved.where("segments > 1").drop("segments"), solved.agg(F.max("segment")).first()[0] or 0
    while last > 0:
        neighbours = F.floor(F.col("segment") / JOINED)
        parts = materialize(parts.groupBy(*KEY, neighbours.alias("part")).applyInArrow(_join, schema), "segment-paths")
        last //= JOINED
    return whole.unionByName(parts.select(*KEY, "paths")).mapInArrow(_end, "conv long, missing boolean, cost long, audit string")


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What becomes of each row: roles inserted before it, and the role it gets (none: it goes).

    With an odd number of turns the first is the system turn; the others take turns.
    """
    schema = pa.schema([("conv", pa.int64()), ("missing", pa.bool_()), ("pos", pa.int64()), ("inserted", pa.list_(pa.string())), ("edit", pa.string()), ("new_role", pa.string())])
    out: list[tuple] = []
    for batch in batches:
        for conv, missing, audit in zip(*(batch.column(c).to_pylist() for c in (*KEY, "audit")), strict=True):
            odd, turn = (len(audit) - audit.count("D")) % 2, 0
            for pos, found in enumerate(re.finditer("I*[DKR]|I+", audit)):
                roles: list[str | None] = []
                for letter in found.group():
                    place = turn - odd
                    roles.append(None if letter == "D" else ROLES[SYSTEM if place < 0 else USER if place % 2 == 0 else ASSISTANT])
                    turn += letter != "D"
                letter = found.group()[-1]
                out.append((conv, missing, pos, *((roles, None, None) if letter == "I" else (roles[:-1], letter, roles[-1]))))
                if len(out) >= BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                    out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)


def repaired_rows(placed: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv, missing, pos, part, role, text): the turns of the repaired conversations, in order of (pos, part)."""
    done = edits.mapInArrow(_edits, "conv long, missing boolean, pos long, inserted array<string>, edit string, new_role string")
    both = done.join(placed.select(*KEY, "pos", "role", "text"), [*KEY, "pos"], "left")
    turn = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
    new = F.transform("inserted", lambda role: turn(role, F.lit("")))
    role = F.when(F.col("edit") == "R", F.col("new_role")).otherwise(F.col("role"))
    own = F.when(F.col("edit").isin("K", "R"), F.array(turn(role, F.col("text")))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    return both.select(*KEY, "pos", F.posexplode(F.concat(new, own)).alias("part", "turn")).select(*KEY, "pos", "part", "turn.role", "turn.text")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the newline-joined lines of each conversation; rows come in order."""
    key, running = None, None
    for batch in batches:
        keys: list[tuple[int, bool]] = []
        digests: list[str] = []
        for conv, missing, line in zip(*(batch.column(c).to_pylist() for c in (*KEY, "line")), strict=True):
            if (conv, missing) != key:
                if running is not None:
                    keys.append(key)
                    digests.append(running.hexdigest())
                key, running = (conv, missing), hashlib.sha256()
            else:
                running.update(b"\n")
            running.update(line.encode())
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.bool_()), pa.array(digests, pa.string())], [*KEY, "sha256"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.bool_()), pa.array([running.hexdigest()], pa.string())], [*KEY, "sha256"])


def digests(turns: DataFrame) -> DataFrame:
    """(conv, missing, sha256) of the ``role:text`` lines of repaired conversations that have turns."""
    lines = turns.select(*KEY, "pos", "part", F.concat_ws(":", "role", "text").alias("line"))
    ordered = lines.repartition(*KEY).sortWithinPartitions(*KEY, "pos", "part")
    return ordered.select(*KEY, "line").mapInArrow(_digest, "conv long, missing boolean, sha256 string")


# --- whole repair ----------------------------------------------------------------------------


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Facts of each conversation of ``rows(conv_id, turn, role, text)``, and its repaired turns.

    Facts: conv, missing, gaps (turn numbers left out between the lowest and the highest), blank, duplicate, truncated,
    illegal (adjacent pairs of roles that may not follow each other), cost, audit.
    """
    placed = materialize(placed_rows(rows), "turns-placed")
    found = materialize(faults(placed), "turn-faults")
    cut = materialize(segments(found, segment_rows), "segments")
    edits = materialize(least_edits(cut), "edits")
    span = F.max("turn") - F.min("turn") + 1
    counts = found.groupBy(*KEY).agg(
        F.coalesce(span - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *[F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")],
    )
    illegal = cut.groupBy(*KEY).agg(F.sum("illegal").alias("illegal"))
    return counts.join(illegal, KEY).join(edits, KEY), repaired_rows(placed, edits)


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` damaged by a checksum of conversation and turn: dropped, emptied, cut of its ends, repeated or made a user's."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate: Column = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), name("role").alias("role"), name("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))
    hurt = plain.where("fate <> 0").select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times))
    return hurt.drop("col")
