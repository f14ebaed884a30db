"""Nearest neighbours by inner product, from randomly rotated one-bit codes with error bounds.

Codes: the vectors of a block are taken relative to the block's mean c and turned by one random rotation for their
length. Of a residual o of length r only the signs of its turned components are kept, one bit each, besides two numbers.
With the unit vector x of the signs and a = <x, o / r>, <q, x> / a estimates <q, o / r>: what it leaves out is
sqrt(1 - a^2) / a times the part of q along a random direction orthogonal to x. So
    <q, v> = <q, c> + r <q, x> / a, within SURE * |q| * r * sqrt(1 - a^2) / (a * sqrt(D - 1)),
and the rotation makes that error nearly normal with standard deviation 1 / SURE of the bound (under 8 components the
bound is what Cauchy-Schwarz says). A vector whose upper bound is below the least of a query's best found so far is
left alone; all others are reranked by their exact product with the original vectors. SURE = 4 leaves out one in some
30,000 of those vectors that would just have come in; recall is measured in the tests.

Spark deals the work: vectors are dealt by hash of their id into blocks of about BLOCK bytes, queries into blocks of
QUERIES, both packed to one row. Each pair of blocks is one group of a cogroup, in which codes are unpacked slice by
slice; it gives back the best k of each query, and the best k of these are the result. All queries meet all vectors,
but no pair of vectors is ever a row: a query sends k rows for each block. Nothing is broadcast or collected but the
number of vectors by their lengths.

Whatever reaches a query's best has its product summed component by component in double precision. Equal products go to the smaller vec_id. Vectors that
are null or zero, or hold a null, NaN or infinite component, and rows without a vec_id take no part. Vectors of one
length meet each other only. Of rows that share a vec_id the one with the least vector takes part, so repeated rows are
one and a query never finds its own id. Fewer than k candidates are all found. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

K = 20
SEED = 42
SURE = 4.0
#: Bytes of vectors in a block, queries in a block, bytes of a slice's estimates, pairs reranked at once.
BLOCK, QUERIES, SLICE, PAIRS = 1 << 22, 2048, 1 << 25, 1 << 15
_CODES = "dim int, block int, ids binary, bits binary, scale binary, slack binary, mean binary, vectors binary"


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray, sure: float = SURE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, and by which factors <q, signs> gives the estimate (scale) and |q| the bound (slack)."""
    dim = vectors.shape[1]
    turned = (vectors - mean) @ turn.T
    size = np.linalg.norm(turned, axis=1)
    a = np.abs(turned).sum(axis=1) / np.sqrt(dim) / np.where(size > 0, size, 1)
    a = np.where(size > 0, a, 1)
    # under 8 components there are too few directions for a random error; then what the product and its estimate may be
    slack = size * (sure * np.sqrt(np.maximum(0, 1 - a * a)) / a / np.sqrt(dim - 1) if dim >= 8 else 1 + 1 / a)
    # and a little for rounding, in these and in single precision
    scale = size / a / np.sqrt(dim)
    return np.packbits(turned > 0, axis=1), scale, slack + 1e-6 * (dim * scale + np.linalg.norm(vectors, axis=1) + np.linalg.norm(mean))


def _valid(vector: Column) -> Column:
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.forall(vector, good) & F.exists(vector, lambda x: x != 0)


def _number(rows: DataFrame) -> type:
    return np.float32 if rows.schema["vector"].dataType.elementType.typeName() == "float" else np.float64


def packed(rows: DataFrame, blocks: DataFrame, count: str) -> DataFrame:
    """A row of _CODES for each block of rows (vec_id, vector); blocks (dim, and in column count their number) deals them.
    Vectors stay in the precision they come in."""
    kind = _number(rows)
    dealt = rows.withColumn("dim", F.size("vector")).join(blocks.select("dim", F.col(count).alias("n")), "dim").select("vec_id", "vector", "dim", F.pmod(F.xxhash64("vec_id"), F.col("n")).cast("int").alias("block"))

    def pack(found: pa.Table) -> pa.Table:
        dim, block = found.column("dim")[0].as_py(), found.column("block")[0].as_py()
        ids = found.column("vec_id").to_numpy()
        order = np.argsort(ids)
        exact = found.column("vector").combine_chunks().values.to_numpy().astype(kind).reshape(-1, dim)[order]
        vectors = exact.astype(np.float64)
        mean = vectors.mean(axis=0)
        bits, scale, slack = encode(vectors, mean, rotation(dim))
        one = {"dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int32())}
        return pa.table(one | {name: pa.array([x.tobytes()], pa.binary()) for name, x in {"ids": ids[order], "bits": bits, "scale": scale, "slack": slack, "mean": mean, "vectors": exact}.items()})

    return dealt.groupBy("dim", "block").applyInArrow(pack, _CODES)


def products(queries: np.ndarray, vectors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of pairs, summed in the order of components; queries and vectors come as (components, rows)."""
    out = np.zeros(len(i))
    for q, v in zip(queries, vectors, strict=True):
        out += q[i] * v[j]
    return out


def best(owner: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the first k of their owner: highest score, then smallest id; owners ascend in the result."""
    order = np.lexsort((ids, -score, owner))
    owner = owner[order]
    first = np.searchsorted(owner, owner)
    return order[np.arange(len(owner)) - first < k]


def search(queries: tuple[np.ndarray, np.ndarray], block: dict[str, np.ndarray], k: int, size: int = SLICE) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query number, vec_id, score) of the best k of a block for each query (ids, vectors), and how many were reranked."""
    q_ids, q = queries
    dim, ids = q.shape[1], block["ids"]
    across, down = np.ascontiguousarray(q.T), np.ascontiguousarray(block["vectors"].T)
    turned, length, centre = (q @ rotation(dim).T).astype(np.float32), np.linalg.norm(q, axis=1).astype(np.float32), q @ block["mean"]
    vectors, margin = block["vectors"], 1e-14 * dim * np.linalg.norm(q, axis=1) * np.linalg.norm(block["vectors"], axis=1).max()
    scale, slack = block["scale"].astype(np.float32), block["slack"].astype(np.float32)
    owner, found, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    least = np.full(len(q), -np.inf)
    at, step, reranked = 0, 2 * k, 0
    while at < len(ids):
        end = min(len(ids), at + step)
        signs = np.unpackbits(block["bits"][at:end], axis=1, count=dim).astype(np.float32) * 2 - 1
        mask = (turned @ signs.T) * scale[at:end] + length[:, None] * slack[at:end] >= np.nextafter((least - centre).astype(np.float32), np.float32(-np.inf))[:, None]
        mask &= q_ids[:, None] != ids[None, at:end]
        reranked += np.count_nonzero(mask)
        # exact products: of the whole slice at once where many are left, else of the pairs left
        if 8 * np.count_nonzero(mask) > mask.size:
            mask &= q @ vectors[at:end].T >= (least - margin)[:, None]
            i, j = np.nonzero(mask)
        else:
            i, j = np.nonzero(mask)
            keep = np.concatenate([np.einsum("ij,ij->i", q[i[x : x + PAIRS]], vectors[at + j[x : x + PAIRS]]) >= (least - margin)[i[x : x + PAIRS]] for x in range(0, len(i), PAIRS)] or [np.zeros(0, bool)])
            i, j = i[keep], j[keep]
        new = products(across, down, i, j + at)
        owner, found, score = np.concatenate((owner, i)), np.concatenate((found, ids[at:end][j])), np.concatenate((score, new))
        top = best(owner, found, score, k)
        owner, found, score = owner[top], found[top], score[top]
        # the k-th best so far, where there are as many
        full = np.bincount(owner, minlength=len(q)) == k
        last = np.searchsorted(owner, np.arange(len(q)), side="right") - 1
        least = np.where(full, score[np.maximum(last, 0)] if len(score) else -np.inf, -np.inf)
        at, step = end, max(k, min(step * 2, size // (8 * len(q))))
    return owner, found, score, reranked


def nearest(vectors: DataFrame, is_query: Column, k: int = K, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score: for each row of vectors (vec_id, embedding) that is_query holds for, its k nearest
    among all others."""
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    clean = vectors.select("vec_id", F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector")).where(F.col("vec_id").isNotNull() & _valid(F.col("vector")))
    rows = staged(clean.groupBy("vec_id").agg(F.min("vector").alias("vector")), "neighbours-vectors")
    dims = rows.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_query).alias("asked")).where("asked > 0")
    blocks = staged(dims.select("dim", F.ceil(F.col("rows") * F.col("dim") * (4 if single else 8) / block).cast("int").alias("n_blocks"), F.ceil(F.col("asked") / queries).cast("int").alias("n_queries")), "neighbours-blocks")
    codes = staged(packed(rows, blocks, "n_blocks"), "neighbours-codes")
    asked = packed(rows.where(is_query), blocks, "n_queries").select("dim", "block", "ids", "vectors")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = codes.join(blocks, "dim").withColumn("asked", every("n_queries")).select("dim", "asked", "block", "ids", "bits", "scale", "slack", "mean", "vectors")
    right = staged(asked, "neighbours-queries").withColumnRenamed("block", "asked").join(blocks, "dim").withColumn("block", every("n_blocks")).select("dim", "asked", "block", "ids", "vectors")

    kind = _number(rows)

    def compare(one: pa.Table, other: pa.Table) -> pa.Table:
        none = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not one.num_rows or not other.num_rows:
            return none
        dim = one.column("dim")[0].as_py()
        value = lambda t, name, kind: np.frombuffer(t.column(name)[0].as_buffer(), kind)
        q_ids, q = value(other, "ids", np.int64), value(other, "vectors", kind).reshape(-1, dim).astype(np.float64)
        held = {"ids": value(one, "ids", np.int64), "bits": value(one, "bits", np.uint8).reshape(-1, (dim + 7) // 8), "vectors": value(one, "vectors", kind).reshape(-1, dim).astype(np.float64)}
        held |= {name: value(one, name, np.float64) for name in ("scale", "slack", "mean")}
        owner, found, score, _ = search((q_ids, q), held, k)
        return pa.table({"query_id": q_ids[owner], "vec_id": found, "score": score})

    at = ["dim", "asked", "block"]
    found = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(compare, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


SQL = """with v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) e from embeddings where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
  p as (select q.vec_id query_id, c.vec_id, list_reduce(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]), lambda a, b: a + b) score from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 20 = 0),
  r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from p)
  select query_id, cast(rank as integer) rank, vec_id, score from r where rank <= 20"""
