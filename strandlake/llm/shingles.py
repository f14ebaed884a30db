"""Near-duplicates by SimHash candidates and measured similarity: documents whose sets of five-word runs have a Jaccard
similarity of 0.8 or more.

Words are as in simhash; a set holds the XXH64 hashes of all runs of `width` words (the whole sequence where there are
fewer; none without words), and sets are compared by these. Documents with equal sets are one node (by a 64-bit hash of
the set), so a group of copies of any size is one row.

Candidates: a pair at 0.8 has a fifth of its runs apart but few words, so the fingerprints are taken of the words: each
distinct word votes on 64 bits with the root of its count. PRINTS fingerprints under as many hash functions go through
the covering tables of simhash, which connect all that differ in RADIUS or fewer bits of one fingerprint: a cluster is
what such links join. Every node is in one cluster, and that takes no pairs.

Links: within a cluster all pairs whose fingerprints are within the radius are measured on the two whole sets, and those
at or above the limit link. A task does that for the nodes of two cells at once, with an index from runs to nodes, and
gives back a spanning forest of the links only. Cells hold about CELL nodes and CELL_RUNS runs; most clusters are one
cell, and one of k cells sends its sets k - 1 times. So no pair within the radius is left out, and no list of pairs is made.

Null and blank texts have the empty set and are alike. Texts of any length are read whole. Rows without a doc_id stay.
Of a component stays the row with the least (doc_id, hash of the text): rows that share a doc_id with unlike texts are
judged apart, of rows with equal doc_id and text one stays. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_slices, small, staged
from .simhash import _LOWER, RADIUS, components, hooked, keep_heads, near_links

WIDTH, LIMIT = 5, 0.8
PRINTS = 5
#: Nodes and runs of a cell, about.
CELL, CELL_RUNS = 2048, 500_000
#: Nodes that a task puts into the tables.
SPREAD = 8192
_BLOCK = 4096
_SALTS = np.random.default_rng(42).integers(0, 1 << 64, PRINTS, np.uint64)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct hashes of a text's runs of words."""
    words = _words(text)
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    n = max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(width, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[i:j], 42) for i, j in zip(starts, stops, strict=True)], np.uint64))


def node_of(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), 7)).view(np.int64))


def _mixed(h: np.ndarray, salt: np.uint64) -> np.ndarray:
    """Another hash of each hash."""
    h = (h ^ salt) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def word_prints(text: str | None) -> np.ndarray:
    """PRINTS fingerprints of a text's words; a bit is 1 if over half the weight votes for it."""
    counts = Counter(_words(text))
    base = np.fromiter(map(xxhash.xxh64_intdigest, counts), np.uint64, len(counts))
    weight = np.rint(1024 * np.sqrt(np.fromiter(counts.values(), np.float64, len(counts))))  # whole numbers, so that sums are exact
    out = []
    for salt in _SALTS:
        votes = np.zeros(64, np.float64)
        for at in range(0, len(base), _BLOCK):
            bits = np.unpackbits(_mixed(base[at : at + _BLOCK], salt).view(np.uint8).reshape(-1, 8), axis=1)
            votes += weight[at : at + _BLOCK] @ bits.astype(np.float64)
        out.append(np.packbits(2 * votes > weight.sum()).view(np.uint64)[0])
    return np.array(out, np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def forest(sets: list[np.ndarray], prints: np.ndarray, limit: float, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that join what pairs within the radius (of a row of prints) and at or above the limit join: breadth first, with
    the sizes of all intersections of a set from an index of runs at once."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    _, run = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(run, kind="stable")
    owner, at = np.repeat(np.arange(n), sizes)[order], np.searchsorted(run[order], np.arange(int(run.max(initial=-1)) + 2))
    first = np.concatenate(([0], np.cumsum(sizes)))
    links, left = [], np.ones(n, bool)
    for start in range(n):
        if not left[start]:
            continue
        left[start], front = False, [start]
        while front and left.any():
            x = front.pop()
            own = run[first[x] : first[x + 1]]
            low, size = at[own], at[own + 1] - at[own]
            places = np.repeat(low - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            both = np.bincount(owner[places], minlength=n)
            alike = left & (both >= limit * (sizes[x] + sizes - both) - 1e-9)
            alike = np.flatnonzero(alike)
            alike = alike[(np.bitwise_count(prints[alike] ^ prints[x]) <= radius).any(axis=1)]
            left[alike] = False
            links += [(x, int(y)) for y in alike]
            front += alike.tolist()
    return links


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)))


def _marked(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, h (the hash of the text), node, m (the size of the set) and prints of every row."""

    def measure(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(it):
            texts = batch.column("text").to_pylist()
            sets = [shingles(t, width) for t in texts]
            columns = [pa.array([node_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), _lists([word_prints(t) for t in texts])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), *columns], ["doc_id", "h", "node", "m", "prints"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(measure, f"doc_id {kind}, h long, node long, m int, prints array<long>")


def clusters(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(node, cluster): what fingerprints within the radius join, for nodes that aren't alone."""
    # sets of fewer than 4 runs are alike only if equal
    each = nodes.where("m >= 4").select("node", F.posexplode("prints").alias("j", "fp"))
    shared = staged(each.groupBy("j", "fp").agg(F.min("node").alias("head"), F.max("node").alias("other")), "print-values")
    # every fingerprint becomes 31 rows, so tasks begin with few
    values = shared.select("j", "fp")
    near = hooked(near_links(values.repartition(max(1, values.count() // SPREAD)), radius, by=("j",), star=True), ("j",))
    head = shared.select("j", F.col("fp"), "head")
    pairs = near.join(head.withColumnsRenamed({"fp": "a", "head": "x"}), ["j", "a"]).join(head.withColumnsRenamed({"fp": "b", "head": "y"}), ["j", "b"]).select("x", "y")
    equal = each.join(shared.where("head < other"), ["j", "fp"]).where("node != head").select(F.col("head").alias("x"), F.col("node").alias("y"))
    found = components(hooked(pairs.unionByName(equal).select(F.col("x").alias("a"), F.col("y").alias("b"))))
    return found.select("node", F.col("root").alias("cluster")).unionByName(found.select(F.col("root").alias("node"), F.col("root").alias("cluster")).distinct())


def links_of(docs: DataFrame, nodes: DataFrame, width: int, limit: float, cell: int = CELL, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between nodes (node, m, prints, first_id, h), all at or above the limit, that connect what all pairs within
    the radius and at or above it connect."""
    grouped = clusters(nodes, radius)
    sizes = nodes.join(grouped, "node").groupBy("cluster").agg(F.ceil(F.greatest(F.count(F.lit(1)) / cell, F.sum("m") / CELL_RUNS)).alias("cells"))
    members = staged(nodes.join(grouped, "node").join(sizes, "cluster").select("node", "prints", "cluster", "cells", F.col("first.doc_id").alias("doc_id"), F.col("first.h").alias("h")), "shingle-members")

    def sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(it, 128):
            yield pa.RecordBatch.from_arrays([batch.column("node"), _lists([shingles(t, width) for t in batch.column("text").to_pylist()])], ["node", "set"])

    # one row of each node gives its set: rows that are equal in doc_id and text have equal ones
    wanted = small(members.select("node", "doc_id", "h"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"), "text").join(wanted, ["doc_id", "h"]).select("node", "text")
    found = texts.mapInArrow(sets, "node long, set array<long>")
    # the cells of a cluster in twos; a lone cell by itself
    mine = F.pmod(F.xxhash64("node"), F.col("cells"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1), lambda x: (x != mine) | (F.col("cells") == 1))
    twos = F.explode(F.transform(others, lambda x: F.struct(F.least(x, mine).alias("i"), F.greatest(x, mine).alias("j"))))
    dealt = members.join(found, "node").select("cluster", twos.alias("at"), "node", "prints", "set").select("cluster", "at.i", "at.j", "node", "prints", "set")

    def join(rows: pa.Table) -> pa.Table:
        values = lambda name: rows.column(name).combine_chunks()
        nodes_of = values("node").to_numpy()
        _, one = np.unique(nodes_of, return_index=True)
        all_sets = values("set")
        prints = values("prints").flatten().to_numpy().view(np.uint64).reshape(len(nodes_of), -1)[one]
        pairs = forest([all_sets[k].values.to_numpy() for k in one.tolist()], prints, limit, radius)
        ends = nodes_of[one][np.array(pairs, np.int64).reshape(-1, 2)]
        return pa.table({"a": ends.min(axis=1), "b": ends.max(axis=1)})

    return dealt.groupBy("cluster", "i", "j").applyInArrow(join, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, limit: float = LIMIT, cell: int = CELL) -> DataFrame:
    """doc_id, h (the hash of the text) and root (the same for all of a component) of every row; doc_id is not null."""
    marked = staged(_marked(docs, width), "shingle-marks")
    nodes = staged(marked.groupBy("node").agg(F.first("m").alias("m"), F.first("prints").alias("prints"), F.min(F.struct("doc_id", "h")).alias("first")), "shingle-nodes")
    roots = staged(components(links_of(docs, nodes, width, limit, cell)), "shingle-components")
    return marked.join(roots, "node", "left").select("doc_id", "h", F.coalesce("root", "node").alias("root"))


def keep_first(docs: DataFrame, **how: float) -> DataFrame:
    """One document of each component, that with the least (doc_id, hash of the text), with all its columns."""
    return keep_heads(docs, near_duplicates(docs.where("doc_id is not null"), **how))
