"""Genome relations: tiles, sequences by locus, genes and their exons. Loci are 1-based and inclusive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions import codes
from strandlake.functions.sequence import reverse_complement

from .bloom import contains
from .joins import merged

TILE = 4096
#: Bases of the next tile that a tile also holds: windows of up to OVERLAP + 1 lie within one tile.
OVERLAP = 255
BEYOND = "an interval reaches beyond its chromosome"
#: Windows cut from one piece of a tile; a window is looked for in its piece only.
STRIP = 128


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out by (chr, tile) to as many partitions as shuffles have; a number that Spark then doesn't lower for small
    inputs, since each row is about to become many. Both sides of a join are, so that it needs no other exchange."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "chr", "tile")


def tile_genome(chromosomes: DataFrame, size: int = TILE, overlap: int = OVERLAP) -> DataFrame:
    """(chr, tile, sequence) from (chr, sequence): each long string is cut once, in linear time."""

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for name, seq in zip(batch.column("chr").to_pylist(), batch.column("sequence"), strict=True):
                s = seq.as_py() or ""
                for low in range(0, len(s), size * 256):
                    at = range(low, min(low + size * 256, len(s)), size)
                    pieces = pa.array([s[i : i + size + overlap] for i in at], pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array([i // size for i in at], pa.int64()), pieces], ["chr", "tile", "sequence"])

    return chromosomes.select("chr", "sequence").mapInArrow(cut, "chr string, tile long, sequence string")


def tiles_of_lines(lines: DataFrame, size: int = TILE, overlap: int = OVERLAP) -> DataFrame:
    """(chr, tile, sequence) as of tile_genome, from the lines (file, record, name, at, sequence) of FASTA files: each line goes
    to the tiles that it touches, where the pieces come together in order. No row is above a tile and a line. Two records
    of one name are an error."""
    at, n = F.col("at"), F.length("sequence")
    # a tile holds the first `overlap` bases of what comes after it
    first = F.greatest(F.floor((at - overlap) / size), F.lit(0).cast("long"))
    each = lines.where(n > 0).select(F.col("name").alias("chr"), F.struct("file", "record").alias("of"), at.alias("at"), "sequence", F.explode(F.sequence(first, F.floor((at + n - 1) / size))).alias("tile"))
    low = F.greatest(F.col("tile") * size - F.col("at"), F.lit(0).cast("long"))
    piece = F.substring("sequence", (low + 1).cast("int"), (F.col("tile") * size + (size + overlap) - F.col("at") - low).cast("int"))
    each = each.select("chr", "of", "tile", (F.col("at") + low).alias("at"), piece.alias("piece")).where(F.length("piece") > 0)
    whole = each.groupBy("chr", "tile").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]), "").alias("sequence"), F.min("of").alias("a"), F.max("of").alias("b"))
    # the last tile of a record is one only if it has bases of its own
    one = F.when(F.col("a") == F.col("b"), F.col("sequence")).otherwise(F.raise_error(F.concat(F.lit("two records are named "), "chr")))
    return whole.select("chr", "tile", one.alias("sequence"))


def tile_windows(tiles: DataFrame, k: int, size: int = TILE) -> DataFrame:
    """Tiles as records (sequence) with each window of k once: what lies in the next tile goes, but for its first k - 1 bases.
    Counting these counts the whole genome."""
    if k > OVERLAP + 1:
        raise ValueError(f"k must be in 1..{OVERLAP + 1}")
    return tiles.select("chr", "tile", F.substring("sequence", 1, size + k - 1).alias("sequence"))


def checked_strand(strand: Column) -> Column:
    return F.when(strand.isin("+", "-"), strand).otherwise(F.raise_error(F.concat(F.lit("strand must be + or -, not "), F.coalesce(strand, F.lit("null")))))


def stranded(seq: Column, strand: Column) -> Column:
    return F.when(strand == "-", reverse_complement(seq)).otherwise(seq)


def sequences_of(loci: DataFrame, tiles: DataFrame, keys: list[str], size: int = TILE) -> DataFrame:
    """loci (keys, chr, start, end, strand; keys tell loci apart) with their sequence, of any length, strand-aware. A locus
    beyond its chromosome, or on one that isn't there, is an error.

    Each locus meets the tiles it touches by equality; its pieces come back together in order."""
    parts = loci.withColumn("tile", F.explode(F.sequence(F.floor((F.col("start") - 1) / size), F.floor((F.col("end") - 1) / size))))
    first = F.greatest(F.col("start") - 1 - F.col("tile") * size, F.lit(0))
    last = F.least(F.col("end") - 1 - F.col("tile") * size, F.lit(size - 1))
    parts = merged(spread(parts), spread(tiles.withColumnRenamed("sequence", "tile_sequence")), ["chr", "tile"], "left")
    piece = F.substring("tile_sequence", (first + 1).cast("int"), (last - first + 1).cast("int"))
    pieces = F.transform(F.sort_array(F.collect_list(F.struct("tile", F.coalesce(piece, F.lit("")).alias("s")))), lambda x: x["s"])
    whole = parts.groupBy(*keys, "chr", "start", "end", "strand").agg(F.array_join(pieces, "").alias("sequence"))
    fits = F.length("sequence") == F.col("end") - F.col("start") + 1
    return whole.withColumn("sequence", F.when(fits, stranded(F.col("sequence"), checked_strand(F.col("strand")))).otherwise(F.raise_error(F.lit(BEYOND))))


def windows_of(intervals: DataFrame, tiles: DataFrame, k: int, size: int = TILE) -> DataFrame:
    """Every window of k within each interval (.., chr, start, end, strand): interval columns, w_start, w_end, w_offset and
    sequence. Windows run in ascending coordinates on both strands; only the sequence turns with the strand.

    Windows are cut from tiles, so no chromosome or gene is ever one string, and within a tile from strips, so the cost of
    a window doesn't grow with the tile. The parts of the intervals are dealt out by (chr, tile) before they grow to
    windows, so that a chromosome's windows are many tasks' work, however small the tables are that they come from. An
    interval on a chromosome that isn't there, or beyond its end, is an error."""
    if not 1 <= k <= OVERLAP + 1:
        raise ValueError(f"k must be in 1..{OVERLAP + 1}")
    fitting = intervals.where(F.col("end") - F.col("start") + 1 >= k)
    parts = fitting.withColumn("tile", F.explode(F.sequence(F.floor((F.col("start") - 1) / size), F.floor((F.col("end") - k) / size))))
    parts = merged(spread(parts), spread(tiles.withColumnRenamed("sequence", "tile_sequence")), ["chr", "tile"], "left")
    low = F.greatest(F.col("start"), F.col("tile") * size + 1)
    high = F.least(F.col("end") - k + 1, (F.col("tile") + 1) * size)
    # whether the tile is there and long enough is asked once for all its windows
    fits = F.length("tile_sequence") >= high - F.col("tile") * size + k - 1
    strips = parts.withColumn("w_last", high).withColumn("w_first", F.explode(F.when(fits, F.sequence(low, high, F.lit(STRIP).cast("long"))).otherwise(F.raise_error(F.lit(BEYOND)))))
    strips = strips.select(*intervals.columns, "w_first", "w_last", F.substring("tile_sequence", (F.col("w_first") - F.col("tile") * size).cast("int"), F.lit(STRIP + k - 1)).alias("strip"))
    # a strip turns once, and its windows are then cut from its end
    strand = checked_strand(F.col("strand"))
    place = F.when(strand == "-", F.col("w_first") + F.length("strip") - k + 1).otherwise(1 - F.col("w_first"))
    strips = strips.select(*intervals.columns, "w_first", "w_last", stranded(F.col("strip"), strand).alias("strip"), place.alias("place"), F.when(strand == "-", -1).otherwise(1).alias("step"))
    each = strips.withColumn("w_start", F.explode(F.sequence(F.col("w_first"), F.least(F.col("w_first") + (STRIP - 1), F.col("w_last")))))
    seq = F.substring("strip", (F.col("place") + F.col("step") * F.col("w_start")).cast("int"), F.lit(k))
    return each.select(
        *intervals.columns, "w_start", (F.col("w_start") + k - 1).alias("w_end"), (F.col("w_start") - F.col("start")).alias("w_offset"),
        seq.alias("sequence"),
    )


def genome_codes(tiles: DataFrame, k: int, size: int = TILE, unknown: int = 0, wanted: np.ndarray | None = None) -> DataFrame:
    """(chr, pos, code, sequence) of all plus-strand windows of k <= 31 of a genome, from its tiles alone: two-bit codes with a
    null sequence. Windows with 1 to `unknown` other bases come with their sequence and a null code, those with more not
    at all. Linear in bases whatever the tile size; tiles are dealt out, so that one chromosome is many tasks' work. With
    a filter of wanted codes (see bloom), known windows that aren't in it are left out."""
    if not 1 <= k <= codes.MOST:
        raise ValueError(f"codes have k of 1..{codes.MOST}")
    passing = None if wanted is None else tiles.sparkSession.sparkContext.broadcast(wanted)

    def roll(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            data, ends = codes.flat(batch.column("sequence"))
            first = batch.column("tile").to_numpy() * size + 1
            bad = np.concatenate(([0], np.cumsum(codes.is_unknown(data)))) if unknown else None
            for w in codes.windows(data, ends, k):
                mine = w.at < size  # the rest is the next tile's
                if unknown:
                    start = ends[w.row] + w.at
                    mine &= bad[start + k] - bad[start] <= unknown
                else:
                    mine &= w.known
                if passing is not None:
                    mine &= ~w.known | contains(passing.value, w.code)
                row, at, known = w.row[mine], w.at[mine], w.known[mine]
                odd = np.flatnonzero(~known)
                texts = np.full(len(row), None, object)
                texts[odd] = [data[a : a + k].tobytes().decode() for a in (ends[row] + at)[odd]]
                text = pa.array(texts, pa.string()) if len(odd) else pa.nulls(len(row), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("chr").take(pa.array(row)), pa.array(first[row] + at), pa.array(w.code[mine], mask=~known), text], ["chr", "pos", "code", "sequence"])

    return spread(tiles.select("chr", "tile", "sequence")).mapInArrow(roll, "chr string, pos long, code long, sequence string")


def _exactly(genes: DataFrame, what: str, most: int | None) -> DataFrame:
    n = genes.limit((most or 1) + 1).count()
    if n == 0 or (most and n > most):
        raise ValueError(f"{'no' if n == 0 else 'more than one'} gene with {what}")
    return genes


def gene_by_id(genes: DataFrame, gene_id: str) -> DataFrame:
    return _exactly(genes.where(F.col("gene_id") == gene_id), f"id {gene_id}", None)


def gene_by_name(genes: DataFrame, name: str) -> DataFrame:
    return _exactly(genes.where(F.col("gene_name") == name), f"name {name}", 1)


def distinct_exons(exons: DataFrame, genes: DataFrame) -> DataFrame:
    """Each exon locus of a gene once, whichever transcripts have it; exons lie on their genes."""
    return merged(exons, genes.select("gene_id", "gene_name"), "gene_id").select("gene_id", "gene_name", "chr", F.col("e_start").alias("start"), F.col("e_end").alias("end"), "strand").distinct()


def gene_sequences(genes: DataFrame, tiles: DataFrame, size: int = TILE) -> DataFrame:
    """gene_id and the pre-mRNA sequence of each gene."""
    loci = genes.select("gene_id", "chr", F.col("g_start").alias("start"), F.col("g_end").alias("end"), "strand")
    return sequences_of(loci, tiles, ["gene_id"], size).select("gene_id", "sequence")
