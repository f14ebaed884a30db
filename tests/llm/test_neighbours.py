"""Nearest neighbours: the query against its SQL, odd rows by brute force, recall and reranked share of the codes."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.llm import neighbours as nn
from strandlake.llm import registry

D = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<double>, label int, dim string, block string, score string, rank int"


def exact(rows, k, asked):
    """Brute force over one vector for each id."""
    held = {}
    for i, e in rows:
        if i is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            held[i] = min(held.get(i, e), e)
    out = []
    for q in sorted(held):
        if asked(q):
            scores = []
            for i, e in held.items():
                if i != q and len(e) == len(held[q]):
                    s = 0.0
                    for x, y in zip(held[q], e, strict=True):
                        s += x * y
                    scores.append((-s, i))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{D}/embeddings.parquet'")
    found = nn.op13_neighbours(spark, D)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "int", "bigint", "double"]
    got, want = (sorted(map(tuple, df[["query_id", "rank", "vec_id", "score"]].values.tolist())) for df in (found.toPandas(), con.sql(registry.ORACLE_SQL["op13_neighbours"]).df()))
    assert got == want


@pytest.mark.parametrize(("block", "queries"), [(1 << 22, 1024), (4000, 7)])
def test_odd_rows(spark, block, queries):
    rng = random.Random(1)
    one = lambda n: [rng.gauss(0, 1) for _ in range(n)]
    rows = [(i, one(16)) for i in range(300)] + [(i, one(3)) for i in range(300, 340)] + [(i, [float(rng.randint(-1, 1))]) for i in range(340, 360)]
    rows += [(400 + i, rows[10][1]) for i in range(60)] + rows[:9]  # ties, repeated rows
    rows += [(5, one(16)), (None, one(16)), (501, None), (502, []), (503, [0.0] * 16), (504, [1.0, None] * 8), (505, [float("nan")] + one(15)), (510, [float("inf")] + one(15)), (515, one(7))]
    frame = spark.createDataFrame([(i, e, 1, "d", "b", "s", 0) for i, e in rows], ROWS)
    found = nn.nearest(frame, F.pmod("vec_id", F.lit(5)) == 0, 4, block, queries)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())
    assert got == exact(rows, 4, lambda i: i % 5 == 0)
    assert nn.nearest(frame.limit(0), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize(("dim", "kind"), [(64, "even"), (64, "groups"), (100, "offset"), (9, "groups"), (2, "even")])
def test_recall_of_the_codes(dim, kind):
    """Far fewer than all are reranked, and hardly a neighbour is missed."""
    rng = np.random.default_rng(3)
    n, k = 12_000, 20
    v = rng.standard_normal((n, dim)) * rng.uniform(0.5, 2, (n, 1)) if kind != "groups" else rng.standard_normal((40, dim))[rng.integers(0, 40, n)] + 0.4 * rng.standard_normal((n, dim))
    v += 3.0 * (kind == "offset")
    q, ids = v[::20], np.arange(n)
    bits, scale, slack = nn.encode(v, v.mean(axis=0), nn.rotation(dim))
    assert bits.nbytes == n * ((dim + 7) // 8)
    owner, found, score, reranked = nn.search((ids[::20], q), {"ids": ids, "bits": bits, "scale": scale, "slack": slack, "mean": v.mean(axis=0), "vectors": v}, k)
    all_scores = q @ v.T
    all_scores[np.arange(len(q)), ids[::20]] = -np.inf
    want = np.argsort(-all_scores, axis=1)[:, :k]
    recall = np.mean([len(np.intersect1d(found[owner == i], want[i])) / k for i in range(len(q))])
    print(f"{kind} {dim}: recall {recall:.4f}, reranked {reranked / all_scores.size:.3f}")
    assert recall >= 0.99 and np.allclose(score, all_scores[owner, found])
    assert dim < 64 or reranked < 0.5 * all_scores.size


def test_bounds_hold():
    rng = np.random.default_rng(5)
    v, q = rng.standard_normal((4000, 48)), rng.standard_normal((200, 48))
    bits, scale, slack = nn.encode(v, v.mean(axis=0), nn.rotation(48))
    signs = np.unpackbits(bits, axis=1, count=48) * 2.0 - 1
    estimate = (q @ nn.rotation(48).T) @ signs.T * scale + (q @ v.mean(axis=0))[:, None]
    outside = np.abs(estimate - q @ v.T) > np.linalg.norm(q, axis=1)[:, None] * slack
    assert outside.mean() < 3e-4
