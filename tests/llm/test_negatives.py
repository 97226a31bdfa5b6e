"""Hard negatives against brute force in whole numbers, and their odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettermill.llm import negatives

ROWS = "vec_id bigint, embedding array<float>, label int, rank string, anchor_id string, no int"


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, y, "r", "a", 1) for i, v, y in rows], ROWS).repartition(parts)


def brute_force(rows, anchor):
    kept = []
    for i, v, y in rows:
        if y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (i, tuple(math.floor(256 * float(np.float32(x))) for x in v), y)
        if row not in kept and sum(x * x for x in row[1]) < 1 << 55:
            kept.append(row)
    first = lambda found, k: sorted(found, key=lambda r: (-r[1], r[0] is None, r[0] or 0))[:k]
    out = []
    for i, v, y in kept:
        if i is None or not anchor(i):
            continue
        met = [(j, sum(a * b for a, b in zip(v, w)), z) for j, w, z in kept if len(w) == len(v)]
        for p, score, _ in first([m for m in met if m[2] == y and m[0] != i], 5):
            for n, (j, low, _) in enumerate(first([m for m in met if m[2] != y and 30 * score <= 100 * m[1] <= 90 * score], 10), 1):
                out.append((i, p, n, j, score, low))
    return sorted(out, key=str)


@pytest.mark.parametrize("dims, size", [(1, 0), (40, 0), (64, 9), (1500, 3), (3, 24)])
def test_residues_give_exact_scores(dims, size):
    rng = np.random.default_rng(dims)
    a, b = (rng.integers(-(1 << size), (1 << size) + 1, (n, dims)) for n in (7, 11))
    bound = int(max((a.astype(object) ** 2).sum(1).max(), (b.astype(object) ** 2).sum(1).max()))
    primes = negatives.primes_for(dims, bound)
    assert math.prod(primes) > 2 * bound and all(min(dims, negatives.DIMS) * (p // 2) ** 2 < 1 << 24 for p in primes)
    assert all(p > 2 and all(p % d for d in range(2, p)) for p in primes) and len(set(primes)) == len(primes)
    parts = [negatives.residues(x, primes) for x in (a, b)]
    assert all(x.dtype == np.float32 for x in parts[0])
    assert (negatives.scores(*parts, primes) == (a.astype(object) @ b.astype(object).T)).all()


def test_equals_brute_force(spark, monkeypatch):
    draw = random.Random(3)
    base = [[draw.uniform(-1, 1) for _ in range(6)] for _ in range(9)]
    rows = [(i, [x + draw.choice([0, 0, 0.01, -0.3]) for x in draw.choice(base)], draw.choice([0, 1, 1, 1, 2])) for i in range(300)]
    rows += [(400, None, 1), (500, [0.1] * 6, None), (600, [0.1] * 5 + [None], 1), (700, [0.1] * 5 + [float("nan")], 1), (800, [float("inf")] * 6, 0),
             (900, [1e30] * 6, 1), (None, rows[0][1], 1), (None, rows[0][1], 0), (None, rows[1][1], 1), rows[10], rows[20], (20, rows[30][1], 1), (20, rows[31][1], 2),
             (1000, [0.5, 0.25], 1), (1001, [0.5, 0.3], 1), (1002, [0.25, 0.2], 2), (1100, [], 1), (1101, [], 1), (1102, [], 0), (1200, [0.0] * 6, 3),
             (1201, [0.0] * 6, 3), (-40, rows[5][1], 1)]
    want = brute_force(rows, lambda i: i % 10 == 0)
    assert len(want) > 200
    monkeypatch.setattr(negatives, "TILE", (7, 13))
    for cells in ((1 << 20, 1 << 23), (40, 300)):
        monkeypatch.setattr(negatives, "ANCHOR_CELLS", cells[0])
        monkeypatch.setattr(negatives, "ROW_CELLS", cells[1])
        found = negatives.hard_negatives(vectors(spark, rows), F.col("id") % 10 == 0)
        assert sorted((tuple(r) for r in found.collect()), key=str) == want


def test_equal_scores_come_by_key(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(30)] + [(100 + i, [0.5, 0.0], 1) for i in range(40)]
    got = negatives.hard_negatives(vectors(spark, rows), F.col("id") == 7).collect()
    assert sorted({r["positive_id"] for r in got}) == [0, 1, 2, 3, 4]
    assert sorted(r["negative_id"] for r in got if r["positive_id"] == 3) == list(range(100, 110))


def test_empty_tables(spark):
    assert negatives.hard_negatives(vectors(spark, [(1, [0.5], 1)]).limit(0), F.col("id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(vectors(spark, [(1, [0.5], 1), (2, [0.5], 1)]), F.col("id") % 10 == 0).count() == 0


def test_query_equals_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    df, want = negatives.op12_negatives(spark, sf), db.execute(negatives.OP12_SQL)
    assert df.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.fetchall()))
