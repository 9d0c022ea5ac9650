import hashlib
import math
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from semprune.llm import queries, sql
from semprune.llm import vector_codes as codes

MOST = 2**63 - 1
SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, `a.b` string"


def brute(rows, parts=8, entries=16, rounds=6):
    """Python integers and all distances."""
    good = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], tuple(float(np.float32(x)) for x in v), label) for i, v, label in rows if good(v)]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = {}
    for i, v, raw, _ in kept:
        if i not in first or raw < first[i][0]:
            first[i] = (raw, v)
    ids = sorted(first, key=lambda i: (i is None, i or 0))[:entries]
    books = [[cut(first[i][1], p) for i in ids] for p in range(parts)]

    def assign(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v, _, _ in kept:
            for p in range(parts):
                members[p, assign(v, p)[1]].append(cut(v, p))
        for (p, k), got in members.items():
            books[p][k] = [sum(c) // len(got) for c in zip(*got, strict=True)]
    coded = [(i, label, [assign(v, p) for p in range(parts)]) for i, v, _, label in kept]
    by_label = Counter()
    for _, label, found in coded:
        by_label[label] += min(sum(d for d, _ in found), MOST)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{k:02x}" for _, k in found), min(sum(d for d, _ in found), MOST), min(by_label[label], MOST), digest) for i, label, found in coded]


def compressed(spark, rows, **options):
    table = spark.createDataFrame([(i, v, label, "c", "e", "dotted") for i, v, label in rows], SCHEMA).repartition(3)
    found = codes.compress(table, **options)
    return Counter(map(tuple, found.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()))


def vectors(seed, n, dim=16, low=-1.0, high=1.0):
    r = np.random.default_rng(seed)
    return [(int(i), r.uniform(low, high, dim).astype(np.float32).tolist(), int(r.integers(4))) for i in r.permutation(n)]


def test_rows_equal_brute_force(spark):
    rows = vectors(1, 300)
    rows += [(i, rows[3][1], None) for i in range(500, 600)] + [rows[5], rows[5], (None, rows[6][1], 2), (0, rows[7][1], 1)]
    bad = [(-5, None, 1), (-4, [0.5] * 15 + [None], 1), (-3, [math.nan] * 16, 1), (-2, [math.inf] + [0.0] * 15, 1), (-1, [], None)]
    assert compressed(spark, rows + bad) == Counter(brute(rows + bad))


def test_few_rows_and_ties(spark):
    for rows in ([(7, [0.1] * 8, None)], [(i, [float(i % 3)] * 8, i % 2) for i in range(10)], [(None, [1.0] * 8, 1), (None, [0.5] * 8, 1)], [(i, [0.25] * 8, 1) for i in range(40)]):
        assert compressed(spark, rows) == Counter(brute(rows))


def test_numbers_beyond_64_bits(spark):
    for high in (3e5, 3e7):
        rows = vectors(2, 60, 8, -high, high)
        assert compressed(spark, rows) == Counter(brute(rows))
    mixed = rows + vectors(3, 100, 8)
    assert compressed(spark, mixed) == Counter(brute(mixed))


def test_too_large_or_uneven_vectors_fail(spark):
    for rows in ([(1, [1e30] * 8, 1)], [(1, [1.0] * 9, 1)], [(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)]):
        with pytest.raises(Exception, match="too large|equal parts|components"):
            compressed(spark, rows)


def test_no_rows(spark):
    assert not compressed(spark, []) and not compressed(spark, [(1, None, 1)])


@pytest.mark.parametrize("width,spread,n", [(1, 3, 16), (2, 2, 16), (3, 50, 16), (8, 8000, 16), (4, 5, 200), (8, 400, 1000)])
def test_tree_finds_the_nearest_with_ties(width, spread, n):
    r = np.random.default_rng(width * n)
    entries = r.integers(-spread, spread, (n, width))
    entries[n // 2] = entries[0]
    asked = r.integers(-spread, spread, (700, width))
    for kind in (np.int64, object):
        e, q = entries.astype(kind), asked.astype(kind)
        number, square = codes.nearest(q, e, codes.build_tree(e))
        away = ((asked[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (number == away.argmin(axis=1)).all() and (square == away.min(axis=1)).all()


def test_distances_rule_out_subtrees():
    r = np.random.default_rng(8)
    centers = r.normal(size=(40, 6)) * 4000
    entries = np.floor(np.concatenate([c + r.normal(size=(25, 6)) * 50 for c in centers])).astype(np.int64)
    asked = entries[::7] + 3
    met = []
    codes.nearest(asked, entries, codes.build_tree(entries), met)
    assert sum(met) < 0.35 * len(asked) * len(entries)


def test_whole_numbers_round_down():
    column = pa.array([[-0.0001, 0.0001, 1.0, -1.0]], pa.list_(pa.float32()))
    assert codes.whole_numbers(column, 2).tolist() == [[[-1, 0], [4096, -4096]]]


@pytest.mark.parametrize("part", ["small", "odd", "none"])
def test_query_equals_sql(spark, tmp_path, part):
    if part == "small":
        table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    else:
        rows = vectors(5, 80) + [(200, None, 1), (201, [math.nan] * 16, 1), (202, [0.5] * 15 + [None], None), (3, [0.5] * 16, None)] if part == "odd" else []
        table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    table.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    result = con.execute(sql.vector_codes())
    names = [c[0] for c in result.description]
    found = queries.op13_vector_codes(spark, str(tmp_path))
    assert Counter(map(tuple, found.select(*names).collect())) == Counter(result.fetchall())
