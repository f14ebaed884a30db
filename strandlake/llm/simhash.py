"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: the text with A-Z in lower case is cut into words; each run of `width` words (joined by one space,
repeats included; the whole sequence where there are fewer; none without words) is hashed by XXH64 with seed 42. A bit
of the fingerprint is 1 if it is set in over half of the hashes. No words: fingerprint zero, linked like any other.

Linking: give each of the 64 bits a vector m(b) of radius + 1 bits. For each nonzero vector v the table v keeps the
bits b with <m(b), v> odd and clears the others. Fingerprints that differ in r <= radius bits are equal in some table:
the r vectors m(b) leave a nonzero v that is orthogonal to all of them (a covering code), so no pair is missed. There
are 2^(radius+1) - 1 tables, each of which keeps about half the bits.

Only distinct fingerprints enter the tables, so a group of copies of any size is one row. Buckets of two are their own
candidate pair. Larger ones up to CELL are searched in one task for a spanning forest of their links, and larger ones
yet go through midpoints: two members differ in at most radius cleared bits, so both are within radius / 2 flips of some
common value; every member names all values within radius / 2 flips, and each value links those who name it to the
least of them. That is linear in the bucket, exact, and never lists all pairs of a group.

Null text counts as empty; texts of any length are read whole. Nodes of the graph are fingerprints: rows that share a doc_id
have each their own, and with it its component, so two such rows can be in two components. A row without a doc_id takes
the component of its fingerprint, but names none. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_rows, in_slices, restaged, staged, table

RADIUS = 4
WIDTH = 4
#: Members up to which a bucket is searched within one task (8 bytes each).
CELL = 2048
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLOCK = 1 << 16


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(width, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[i:j], 42) for i, j in zip(starts, stops, strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        part = hashes[at : at + _BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row."""

    def measure(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(it):
            fps = np.array([fingerprint(t, width) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The masks of kept bits, as signed longs. m(b) runs through all nonzero vectors in turn, so that the masks are even."""
    n = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, n + 1):
        kept = sum(1 << b for b in range(64) if ((b % n + 1) & v).bit_count() % 2)
        masks.append(kept - (1 << 64) if kept >> 63 else kept)
    return masks


def _near(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def _forest(values: np.ndarray, radius: int, star: bool = False) -> list[tuple[int, int]]:
    """Links that join all members of a cell who are reachable over near pairs: breadth first from each unseen member. As a
    star they all begin at that member, the least one, so that buckets with the same members give the same links."""
    links, left = [], np.sort(values)
    while len(left) > 1:
        front, left = left[:1], left[1:]
        least = int(front[0])
        while len(front) and len(left):
            x, front = front[0], front[1:]
            near = np.bitwise_count(left.view(np.uint64) ^ x.view(np.uint64)) <= radius
            links += [(least if star else int(x), int(y)) for y in left[near]]
            front, left = np.concatenate((front, left[near])), left[~near]
    return links


def near_links(fps: DataFrame, radius: int = RADIUS, cell: int = CELL, by: tuple[str, ...] = (), star: bool = False) -> DataFrame:
    """Links (by, a, b) between distinct fingerprints that connect what all near pairs connect: each within the radius, or
    as stars (see _forest), which are fewer.

    fps has distinct rows of fp and the columns `by`, which tell apart fingerprints that aren't compared."""
    if radius < 2 or radius % 2:
        raise ValueError("the radius must be even and at least 2")
    masks = covering_masks(radius)
    tables = F.explode(F.array(*(F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks))))
    rows = fps.select(*by, "fp", tables.alias("at")).select(*by, "at.t", "at.key", "fp")
    at = [*by, "t", "key"]
    sizes = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("n > 1")
    sizes = staged(sizes.where((F.col("n") > 2) | _near(F.col("lo"), F.col("hi"), radius)), "simhash-buckets")
    links = sizes.where("n = 2").select(*by, F.col("lo").alias("a"), F.col("hi").alias("b"))
    many = rows.join(sizes.where("n > 2").select(*at, "n"), at)

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [(k, *x) for k, members in enumerate(batch.column("members")) for x in _forest(np.array(members.values), radius, star)]
            whose = pa.array([x[0] for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(whose) for c in by), *(pa.array([x[k] for x in found], pa.int64()) for k in (1, 2))], [*by, "a", "b"])

    cells = many.where(F.col("n") <= cell).groupBy(*at).agg(F.collect_list("fp").alias("members"))
    kinds = "".join(f"{c} {fps.schema[c].dataType.simpleString()}, " for c in by)
    links = links.unionByName(cells.select(*by, "members").mapInArrow(search, kinds + "a long, b long"))

    # beyond a cell: every member names the values within radius / 2 flips of its cleared bits
    cleared = F.array(*(F.lit(~m) for m in masks))
    flips = [0, *(sum(1 << b for b in c) for k in range(1, radius // 2 + 1) for c in combinations(range(64), k))]
    flips = F.array(*(F.lit(x - (1 << 64) if x >> 63 else x) for x in flips))
    large = many.where(F.col("n") > cell).select(*at, "fp", F.element_at(cleared, F.col("t") + 1).alias("free"))
    named = large.select(*at, "fp", F.explode(F.filter(flips, lambda x: x.bitwiseAND(F.col("free")) == x)).alias("flip"))
    named = named.select(*at, F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"), "fp")
    centres = named.groupBy(*at, "middle").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stars = named.join(centres, [*at, "middle"]).where(F.col("a") != F.col("fp")).select(*by, "a", F.col("fp").alias("b"))
    return links.unionByName(stars).distinct()


def hooked(links: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Links (by, a, b) with a < b that connect what the given ones do: all smaller ends of a b hang on the least of them. Where
    many tables name the same few centres, this leaves about one link for each b. A b has at most as many ends as it has
    stars: a row or 529 for each table."""
    each = links.where("a != b").groupBy(*by, F.greatest("a", "b").alias("b")).agg(F.collect_set(F.least("a", "b")).alias("ends"))
    each = each.withColumn("low", F.array_min("ends"))
    hung = F.transform(F.filter("ends", lambda x: x != F.col("low")), lambda x: F.struct(F.col("low").alias("a"), x.alias("b")))
    return each.select(*by, F.explode(F.concat(F.array(F.struct(F.col("low").alias("a"), "b")), hung)).alias("e")).select(*by, "e.a", "e.b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root (its component's least node) of every node in links (a, b): large-star, small-star rounds.

    Each round is two aggregations; the number of rounds grows with the logarithm of the longest chain."""
    edges, path = restaged(links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u < v"), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("low").alias("u"), "v").where("u < v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("low"))
        small = large.join(low, "v").select("low", "u", "v")
        # v and all its smaller neighbours hang on the least of them
        small = small.select(F.explode(F.array(F.struct("low", F.col("v").alias("x")), F.struct("low", F.col("u").alias("x")))).alias("e")).select(F.col("e.low").alias("u"), F.col("e.x").alias("v")).where("u < v").distinct()
        edges, path = restaged(small, "links", path)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = WIDTH, cell: int = CELL) -> DataFrame:
    """doc_id, fp and component_id (the least doc_id reachable over links) of every row."""
    marked = staged(fingerprints(docs, width), "simhash")
    values = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-values")
    links = near_links(values.select("fp"), radius, cell)
    roots = components(links)
    # documents with equal fingerprints are linked: their least id stands for them, and the least of those for a component
    member = values.join(roots, values.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    heads = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    final = staged(member.join(heads, "root").select("fp", "component_id"), "simhash-components")
    return marked.join(final, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, radius: int = RADIUS, width: int = WIDTH, cell: int = CELL) -> DataFrame:
    """One document of each group that links join, that with the least (doc_id, hash of the text), with all its columns.

    Rows that share a doc_id are judged by their own fingerprints. Rows without one can't be named; they stay."""
    known = docs.where("doc_id is not null")
    marked = staged(fingerprints(known.withColumn("doc_id", F.struct("doc_id", F.xxhash64("text").alias("h"))), width), "simhash")
    roots = components(near_links(staged(marked.select("fp").distinct(), "simhash-values"), radius, cell))
    grouped = marked.join(roots, marked.fp == roots.node, "left").select("doc_id.doc_id", "doc_id.h", F.coalesce("root", "fp").alias("root"))
    return keep_heads(docs, grouped)


def keep_heads(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """One row of docs for each root of grouped (doc_id, h, root): that with the least (doc_id, h); and those without a doc_id."""
    rows = staged(grouped.groupBy("doc_id", "h", "root").agg(F.count(F.lit(1)).alias("n")), "groups")
    heads = rows.groupBy("root").agg(F.min(F.struct("doc_id", "h")).alias("head"))
    told = staged(rows.join(heads, "root").select("doc_id", "h", "n", (F.struct("doc_id", "h") == F.col("head")).alias("first")).where("not first or n > 1"), "groups-told")
    kept = drop_rows(docs.where("doc_id is not null"), told.where("not first"), told.where("first"))
    return kept.unionByName(docs.where("doc_id is null")).select(*docs.columns)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
